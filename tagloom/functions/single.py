"""One record text to one Row in plain Python, for code without a session, such as a UDF.

The rules are those of ``from_xml``; formats of dates and times other than ISO need a session.
"""

from __future__ import annotations

import datetime as dt
import re
import struct
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation
from xml.parsers import expat

from pyspark.sql import Row
from pyspark.sql import types as T

from tagloom.functions.casts import COMMA_DECIMALS
from tagloom.functions.parsing import MALFORMED
from tagloom.sources.options import XmlOptions

#: Bits of the integral types.
_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_NUMBER = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[+-]?(?i:nan|inf|infinity)")
_OFFSET = r"(Z|[+-]\d\d:?\d\d)"


class _Element:
    def __init__(self, name: str, attributes: dict[str, str]):
        self.name, self.attributes, self.children = name, attributes, []

    def elements(self) -> list[_Element]:
        return [x for x in self.children if not isinstance(x, str)]

    def text(self) -> str:
        """The text of a leaf; the markup within, not escaped again, of anything else."""
        return "".join(x if isinstance(x, str) else x.markup() for x in self.children)

    def markup(self) -> str:
        return f"<{self.name}" + "".join(f' {k}="{v}"' for k, v in self.attributes.items()) + f">{self.text()}</{self.name}>"


class _Ended(Exception):
    pass


def _tree(text: str) -> _Element | None:
    """The first element of a text, whatever follows; None if it is not well formed."""
    parser, stack, found = expat.ParserCreate(), [], []

    def start(name: str, attributes: dict[str, str]) -> None:
        node = _Element(name, attributes)
        if stack:
            stack[-1].children.append(node)
        stack.append(node)

    def end(_: str) -> None:
        node = stack.pop()
        if not stack:
            found.append(node)
            raise _Ended

    def data(x: str) -> None:
        if stack:
            stack[-1].children.append(x)

    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, data
    try:
        parser.Parse(text, True)
    except _Ended:
        return found[0]
    except expat.ExpatError:
        pass
    return None


def _null_if_empty(text: str, options: XmlOptions) -> str | None:
    if options.ignore_surrounding_spaces:
        text = text.strip(" ")
    if text == options.null_value or (options.treat_empty_values_as_nulls and not text.strip(" ")):
        return None
    return text


def _float(text: str, options: XmlOptions) -> float | None:
    plain = text.strip()
    if _NUMBER.fullmatch(plain):
        return float(plain)
    if not re.fullmatch(r"[+-]?[\d.,\s]+", text):
        return None
    if options.locale.lower().replace("_", "-").split("-")[0] in COMMA_DECIMALS:
        plain = re.sub(r"[.\s]", "", text).replace(",", ".")
    else:
        plain = text.replace(",", "").strip()
    return float(plain) if _NUMBER.fullmatch(plain) else None


def _decimal(text: str, kind: T.DecimalType) -> Decimal | None:
    try:
        value = None if re.search(r"\s", text) else Decimal(text.replace(",", ""))
        value = value if value is None or not value.is_finite() else value.quantize(Decimal(1).scaleb(-kind.scale), ROUND_HALF_UP)
    except InvalidOperation:
        return None
    return value if value is not None and value.is_finite() and len(value.as_tuple().digits) <= kind.precision else None


def _cast(text: str, kind: T.DataType, options: XmlOptions):
    """The value of a leaf; None where the text does not fit."""
    if isinstance(kind, (T.StringType, T.NullType)):
        return text
    if isinstance(kind, T.BooleanType):
        return {"true": True, "1": True, "false": False, "0": False}.get(text.lower())
    if type(kind) in _BITS:
        half = 1 << _BITS[type(kind)] - 1
        return int(text) if re.fullmatch(r"[+-]?\d+", text, re.ASCII) and -half <= int(text) < half else None
    if isinstance(kind, T.DoubleType):
        return _float(text, options)
    if isinstance(kind, T.FloatType):
        value = _float(text, options)
        return None if value is None else struct.unpack("f", struct.pack("f", value))[0]
    if isinstance(kind, T.DecimalType):
        return _decimal(text, kind)
    try:
        if isinstance(kind, T.DateType):
            if options.date_format:
                raise NotImplementedError("dateFormat needs a session")
            return dt.date.fromisoformat(text[:10]) if re.fullmatch(rf"\d{{4}}-\d\d-\d\d{_OFFSET}?", text) else None
        if isinstance(kind, T.TimestampType):
            if options.timestamp_format:
                raise NotImplementedError("timestampFormat needs a session")
            if not re.fullmatch(rf"\d{{4}}-\d\d-\d\d[ T]\d\d:\d\d(:\d\d(\.\d{{1,9}})?)?{_OFFSET}?", text):
                return None
            value = dt.datetime.fromisoformat(text)
            value = value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)
            return value.astimezone().replace(tzinfo=None)  # as collect() gives it
        if isinstance(kind, T.TimestampNTZType):
            return dt.datetime.fromisoformat(text).replace(tzinfo=None)
    except ValueError:
        return None
    raise ValueError(f"unsupported type: {kind.simpleString()}")


def _leaf(text: str | None, kind: T.DataType, options: XmlOptions, attribute: bool) -> tuple[object, bool]:
    text = None if text is None else _null_if_empty(text, options)
    if text is None or (text == "" and not attribute and not isinstance(kind, T.StringType)):
        return None, False
    value = _cast(text, kind, options)
    return value, value is None


def _convert(node: _Element, kind: T.DataType, options: XmlOptions) -> tuple[object, bool]:
    """(value, whether a leaf below did not fit) of an element."""
    if isinstance(kind, T.StructType):
        values, bad = _fields(node, kind, options)
        return (None, True) if any(bad) else (Row(*kind.names)(*values), False)
    if isinstance(kind, T.MapType):
        found = [(f"{options.attribute_prefix}{k}", _leaf(v, kind.valueType, options, False)) for k, v in node.attributes.items() if not options.exclude_attribute]
        found += [(x.name, _convert(x, kind.valueType, options)) for x in node.elements()]
        return (None, True) if any(b for _, (_, b) in found) else ({k: v for k, (v, _) in found}, False)
    return _leaf(node.text(), kind, options, False)


def _fields(node: _Element, kind: T.StructType, options: XmlOptions) -> tuple[list, list[bool]]:
    local = lambda name: name.rpartition(":")[2] if options.ignore_namespace else name
    children: dict[str, list[_Element]] = {}
    for x in node.elements():
        children.setdefault(local(x.name), []).append(x)
    out = []
    for f in kind.fields:
        own = children.get(f.name, [])
        if f.name == options.value_tag:
            text = "".join(x for x in node.children if isinstance(x, str))
            out.append(_leaf(text if text.strip() else None, f.dataType, options, False))
        elif f.name.startswith(options.attribute_prefix) and not options.exclude_attribute and f.name.removeprefix(options.attribute_prefix) in map(local, node.attributes):
            text = next(v for k, v in node.attributes.items() if local(k) == f.name.removeprefix(options.attribute_prefix))
            out.append(_leaf(text, f.dataType, options, True))
        elif isinstance(f.dataType, T.ArrayType):
            items = [_convert(x, f.dataType.elementType, options) for x in own]
            out.append(([v for v, b in items if not b] if own else None, any(b for _, b in items)))
        else:
            out.append(_convert(own[-1], f.dataType, options) if own else (None, False))
    return [v for v, _ in out], [b for _, b in out]


def parse_text(xml: str | None, schema: T.StructType, options: XmlOptions) -> Row | None:
    """The Row of a record text under the mode of ``options``."""
    if xml is None:
        return None
    corrupt = options.column_name_of_corrupt_record
    wanted = T.StructType([f for f in schema.fields if f.name != corrupt])
    node = _tree(xml)
    values, bad = _fields(node, wanted, options) if node else ([None] * len(wanted), [True])
    if any(bad) and options.mode == "FAILFAST":
        raise ValueError(MALFORMED)
    if any(bad) and (options.mode == "DROPMALFORMED" or corrupt not in schema.names):
        return None
    lost = node and any(b for f, b in zip(wanted.fields, bad) if f.name.startswith(options.attribute_prefix) and f.name != options.value_tag and not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)))
    found = dict.fromkeys(wanted.names) if lost else dict(zip(wanted.names, values))
    found[corrupt] = xml if any(bad) else None
    return Row(*schema.names)(*(found[n] for n in schema.names))
