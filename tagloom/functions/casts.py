"""Casts of XML text to typed values, as Column expressions: null where the text does not fit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.sources.options import XmlOptions

#: Languages that write a comma before decimals, by ISO 639-1 code (fixed values).
COMMA_DECIMALS = frozenset("bg cs da de el es et fi fr hr hu id is it lt lv nl no pl pt ro ru sk sl sr sv tr uk vi".split())
_OFFSET = r"(Z|[+-]\d\d:?\d\d|[+-]\d\d:\d\d:\d\d)"
_INTEGER = r"^[+-]?\d+$"
_ZONE_LETTERS = frozenset("VzOXxZ")


def is_boolean(text: Column) -> Column:
    return F.lower(text).isin("true", "false")


def is_long(text: Column) -> Column:
    return text.rlike(_INTEGER) & text.try_cast("bigint").isNotNull()


def is_integer(text: Column) -> Column:
    return text.rlike(_INTEGER) & text.try_cast("int").isNotNull()


def is_double(text: Column) -> Column:
    return text.rlike(r"^[+-]?(\d|\.)") & ~text.rlike("[dDfF]$") & text.try_cast("double").isNotNull()


def is_timestamp(text: Column, options: XmlOptions | None = None) -> Column:
    return to_timestamp(text, options or XmlOptions()).isNotNull()


def is_date(text: Column, options: XmlOptions | None = None) -> Column:
    return to_date(text, options or XmlOptions()).isNotNull()


def to_boolean(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.isin("true", "1"), True).when(low.isin("false", "0"), False)


def to_integral(text: Column, kind: T.DataType) -> Column:
    return F.when(text.rlike(_INTEGER), text.try_cast(kind))


def to_floating(text: Column, kind: T.DataType, options: XmlOptions) -> Column:
    """Java's reading (without its type suffixes), else the locale's grouped one."""
    plain = F.when(~text.rlike(r"[dDfF]$") | text.rlike("(?i)inf"), text.try_cast(kind))
    if options.locale.lower().replace("_", "-").split("-")[0] in COMMA_DECIMALS:
        grouped = F.replace(F.regexp_replace(text, r"[.\s]", ""), F.lit(","), F.lit("."))
    else:
        grouped = F.replace(text, F.lit(","), F.lit(""))
    return F.coalesce(plain, F.when(text.rlike(r"^[+-]?[\d.,\s]+$"), grouped.try_cast(kind)))


def to_decimal(text: Column, kind: T.DecimalType) -> Column:
    return F.when(~text.rlike(r"\s"), F.replace(text, F.lit(","), F.lit("")).try_cast(kind))


def to_date(text: Column, options: XmlOptions) -> Column:
    """An ISO date, with an offset that is dropped, or one in ``dateFormat``."""
    iso = F.when(text.rlike(rf"^\d{{4}}-\d\d-\d\d{_OFFSET}?$"), F.substring(text, 1, 10).try_cast("date"))
    if not options.date_format:
        return iso
    return F.coalesce(iso, F.try_to_date(text, options.date_format))


def to_timestamp(text: Column, options: XmlOptions) -> Column:
    """Date and time with a blank or T between (UTC without an offset), else in ``timestampFormat``.

    A format without a zone is read in ``timezone``; without that either, it matches nothing.
    """
    shape = rf"^\d{{4}}-\d\d-\d\d[ T]\d\d:\d\d(:\d\d(\.\d{{1,9}})?)?{_OFFSET}?$"
    iso = F.replace(text, F.lit(" "), F.lit("T"))
    zoned = F.when(text.rlike(rf"{_OFFSET}$") & text.rlike(r"T|\d\d:\d\d.*[Z+-]"), iso).otherwise(F.concat(iso, F.lit("Z")))
    out = F.when(text.rlike(shape), zoned.try_cast("timestamp"))
    form = options.timestamp_format
    if not form:
        return out
    bare = "".join(form.split("'")[::2])
    if _ZONE_LETTERS & set(bare):
        own = F.try_to_timestamp(text, F.lit(form))
    elif options.timezone:
        own = F.try_to_timestamp(F.concat(text, F.lit(f" {options.timezone}")), F.lit(f"{form} VV"))
    else:
        return out
    return F.coalesce(out, own)


def null_if_empty(text: Column, options: XmlOptions) -> Column:
    """Null where the text is the ``nullValue``, or blank under ``treatEmptyValuesAsNulls``."""
    if options.ignore_surrounding_spaces:
        text = F.trim(text)
    if options.null_value is not None:
        text = F.when(text != options.null_value, text)
    if options.treat_empty_values_as_nulls:
        text = F.when(F.trim(text) != "", text)
    return text


def cast_to(text: Column, kind: T.DataType, options: XmlOptions | None = None) -> Column:
    """A text as a value of ``kind``; null for null, for the null value, and for what does not fit."""
    options = options or XmlOptions()
    return cast_checked(null_if_empty(text, options), kind, options)


def cast_checked(text: Column, kind: T.DataType, options: XmlOptions) -> Column:
    if isinstance(kind, (T.StringType, T.NullType)):
        return text
    if isinstance(kind, T.BooleanType):
        return to_boolean(text)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return to_integral(text, kind)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return to_floating(text, kind, options)
    if isinstance(kind, T.DecimalType):
        return to_decimal(text, kind)
    if isinstance(kind, T.DateType):
        return to_date(text, options)
    if isinstance(kind, T.TimestampType):
        return to_timestamp(text, options)
    if isinstance(kind, T.TimestampNTZType):
        return text.try_cast(kind)
    raise ValueError(f"unsupported type: {kind.simpleString()}")
