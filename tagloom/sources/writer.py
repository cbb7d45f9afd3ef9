"""Writing DataFrames as XML files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.sources.options import XmlOptions

#: Characters that XML 1.0 cannot hold.
_ILLEGAL = r"[^\x09\x0A\x0D\x20-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]"
_NAME = re.compile(r"[^\W\d][\w.\-:]*$")


def _check_names(kind: T.DataType, options: XmlOptions) -> None:
    """Field names that are no XML names fail before any task starts."""
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            name = f.name.removeprefix(options.attribute_prefix) if f.name != options.value_tag else "value"
            if not _NAME.match(name):
                raise ValueError(f"'{f.name}' is not a valid XML name")
            _check_names(f.dataType, options)
    elif isinstance(kind, T.ArrayType):
        _check_names(kind.elementType, options)
    elif isinstance(kind, T.MapType):
        _check_names(kind.keyType, options)
        _check_names(kind.valueType, options)
    elif isinstance(kind, (T.BinaryType, T.DayTimeIntervalType, T.YearMonthIntervalType, T.CalendarIntervalType, T.VariantType)):
        raise ValueError(f"unsupported type: {kind.simpleString()}")


def _legal(value: Column, kind: T.DataType) -> Column:
    """The value without characters that XML cannot hold, at any depth."""
    if isinstance(kind, T.StringType):
        return F.regexp_replace(value, _ILLEGAL, "")
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*(_legal(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields)))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _legal(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, x: _legal(x, kind.valueType))
    return value


def write_xml(df: DataFrame, path: str, mode: str = "errorifexists", strict: bool = False, strip_illegal: bool = False, **options: object) -> None:
    """Writes a directory of XML files.

    ``strict`` refuses to append.  ``strip_illegal`` drops characters that XML cannot hold from
    strings at any depth; without it they fail when read back.
    """
    if strict and mode.lower() == "append":
        raise ValueError("append mode is not supported; use overwrite instead.")
    parsed = XmlOptions.of(**options)
    native = parsed.writing()
    _check_names(df.schema, parsed)
    if strip_illegal:
        df = df.select(*(_legal(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields))
    df.write.format("xml").options(**native).mode(mode).save(path)


def save_as_xml_file(df: DataFrame, path: str, parameters: dict | None = None, compression_codec: str | None = None) -> None:
    """The one-call writer; a ``codec`` among the parameters wins over the argument."""
    given = {k: v for k, v in (parameters or {}).items()}
    if compression_codec and not {"codec", "compression"} & {k.lower() for k in given}:
        given["compression"] = compression_codec
    write_xml(df, path, **given)
