"""Reader and writer options: defaults, early checks, and how Spark's own XML source calls them."""

from __future__ import annotations

import codecs
from dataclasses import dataclass, field, fields

#: Option keys that need another spelling or several; all keys are matched without case.
_ALIASES = {"codec": "compression", "encoding": "charset", "timezone": "timezone"}


@dataclass
class XmlOptions:
    """All options with their defaults.  ``extra`` is passed on to Spark unchanged."""

    charset: str = "UTF-8"
    compression: str | None = None
    row_tag: str = "ROW"
    root_tag: str = "ROWS"
    declaration: str = 'version="1.0" encoding="UTF-8" standalone="yes"'
    array_element_name: str = "item"
    sampling_ratio: float = 1.0
    exclude_attribute: bool = False
    treat_empty_values_as_nulls: bool = False
    attribute_prefix: str = "_"
    value_tag: str = "_VALUE"
    null_value: str | None = None
    column_name_of_corrupt_record: str = "_corrupt_record"
    ignore_surrounding_spaces: bool = False
    mode: str = "PERMISSIVE"
    infer_schema: bool = True
    row_validation_xsd_path: str | None = None
    wildcard_col_name: str = "xs_any"
    ignore_namespace: bool = False
    timestamp_format: str | None = None
    date_format: str | None = None
    timezone: str | None = None
    locale: str = "en-US"
    extra: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        def need(ok: bool, message: str) -> None:
            if not ok:
                raise ValueError(f"requirement failed: {message}")

        for name, text in (("rowTag", self.row_tag), ("rootTag", self.root_tag)):
            need(bool(text), f"'{name}' option should not be an empty string.")
            need(not text.startswith("<") and not text.endswith(">"), f"'{name}' should not include angle brackets")
        need(not self.declaration.startswith("<") and not self.declaration.endswith(">"), "'declaration' should not include angle brackets")
        need(bool(self.value_tag), "'valueTag' option should not be empty string.")
        need(self.value_tag != self.attribute_prefix, "'valueTag' and 'attributePrefix' options should not be the same.")
        need(self.sampling_ratio > 0, f"samplingRatio ({self.sampling_ratio}) should be greater than 0")
        self.mode = self.mode.upper()
        if self.mode not in ("PERMISSIVE", "DROPMALFORMED", "FAILFAST"):
            self.mode = "PERMISSIVE"  # as Spark does with an unknown mode
        codecs.lookup(self.charset)  # LookupError before any task starts

    @classmethod
    def of(cls, **given: object) -> XmlOptions:
        """From options in either spelling: ``rowTag`` or ``row_tag``, in any case."""
        own = {f.name.replace("_", ""): f for f in fields(cls) if f.name != "extra"}
        values: dict[str, object] = {}
        extra: dict[str, str] = {}
        by_key = {k.lower().replace("_", ""): v for k, v in given.items() if v is not None}
        if "compression" in by_key:  # of the two, this key wins
            by_key.pop("codec", None)
        for key, value in by_key.items():
            spec = own.get(_ALIASES.get(key, key))
            if spec is None:
                extra[next(k for k in given if k.lower().replace("_", "") == key)] = str(value)
                continue
            if spec.type == "bool":
                value = str(value).lower() == "true"
            elif spec.type == "float":
                value = float(value)
            else:
                value = str(value)
            values[spec.name] = value
        return cls(**values, extra=extra)

    def _common(self) -> dict[str, str]:
        out = {
            "rowTag": self.row_tag,
            "encoding": self.charset,
            "attributePrefix": self.attribute_prefix,
            "valueTag": self.value_tag,
            "columnNameOfCorruptRecord": self.column_name_of_corrupt_record,
        }
        if self.null_value is not None:
            out["nullValue"] = self.null_value
        return out

    def reading(self) -> dict[str, str]:
        """Options of Spark's reader: the record-wise parser, spaces kept, zone-less times in UTC."""
        flag = lambda x: str(x).lower()
        out = self._common() | {
            "useLegacyXMLParser": "true",
            "mode": self.mode,
            "samplingRatio": str(self.sampling_ratio),
            "excludeAttribute": flag(self.exclude_attribute),
            "ignoreSurroundingSpaces": flag(self.ignore_surrounding_spaces),
            "inferSchema": flag(self.infer_schema),
            "wildcardColName": self.wildcard_col_name,
            "ignoreNamespace": flag(self.ignore_namespace),
            "timeZone": self.timezone or "UTC",
        }
        if self.treat_empty_values_as_nulls and self.null_value is None:
            out["nullValue"] = ""
        if self.row_validation_xsd_path:
            out["rowValidationXSDPath"] = self.row_validation_xsd_path
        return out | self.extra

    def writing(self) -> dict[str, str]:
        """Options of Spark's writer: times as instants with full precision."""
        if not self.attribute_prefix:
            raise ValueError("'attributePrefix' option should not be empty string when writing")
        out = self._common() | {
            "rootTag": self.root_tag,
            "declaration": self.declaration,
            "arrayElementName": self.array_element_name,
            "timestampFormat": self.timestamp_format or "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX",
            "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
            "timeZone": self.timezone or "UTC",
        }
        if self.date_format:
            out["dateFormat"] = self.date_format
        if self.compression:
            out["compression"] = self.compression
        return out | self.extra
