"""Typed values from all-string parses, leaf by leaf.

Records are first parsed with every leaf a string, which cannot fail on a type; then each leaf is
cast.  A leaf that does not fit is null and marks its record, and all other leaves keep their value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions import casts
from tagloom.sources.options import XmlOptions


def string_schema(kind: T.DataType) -> T.DataType:
    """The same shape with strings for leaves."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, string_schema(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(string_schema(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(T.StringType(), string_schema(kind.valueType))
    if isinstance(kind, (T.BinaryType, T.DayTimeIntervalType, T.YearMonthIntervalType, T.VariantType)):
        raise ValueError(f"unsupported type: {kind.simpleString()}")
    return T.StringType()


def all_strings(kind: T.DataType) -> bool:
    return string_schema(kind).simpleString() == kind.simpleString()


def any_of(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, flags, F.lit(False))


def convert(raw: Column, kind: T.DataType, options: XmlOptions, attribute: bool = False) -> tuple[Column, Column]:
    """(value, whether a leaf below did not fit) of an all-string value.

    A struct with a misfit is null, an array leaves the item out, a map is null.  An empty element
    is null for any type but string; an empty attribute is a misfit.
    """
    if isinstance(kind, T.StructType):
        parts = [(f, *convert(raw.getField(f.name), f.dataType, options, f.name.startswith(options.attribute_prefix) and f.name != options.value_tag)) for f in kind.fields]
        bad = raw.isNotNull() & any_of([b for _, _, b in parts])
        value = F.when(raw.isNotNull() & ~bad, F.struct(*(v.alias(f.name) for f, v, _ in parts)))
        return value, F.coalesce(bad, F.lit(False))
    if all_strings(kind) and not isinstance(kind, (T.ArrayType, T.MapType)):
        return casts.null_if_empty(raw, options), F.lit(False)
    if isinstance(kind, T.ArrayType):
        item = lambda x: (lambda v, b: F.struct(v.alias("v"), b.alias("b")))(*convert(x, kind.elementType, options))
        items = F.transform(raw, item)
        value = F.transform(F.filter(items, lambda x: ~x["b"]), lambda x: x["v"])
        return value, F.coalesce(F.exists(items, lambda x: x["b"]), F.lit(False))
    if isinstance(kind, T.MapType):
        item = lambda x: convert(x, kind.valueType, options)
        bad = F.coalesce(F.exists(F.map_values(raw), lambda x: item(x)[1]), F.lit(False))
        return F.when(~bad, F.transform_values(raw, lambda _, x: item(x)[0])), bad
    text = casts.null_if_empty(raw, options)
    if not attribute:
        text = F.when(text != "", text)
    value = casts.cast_checked(text, kind, options)
    return value, text.isNotNull() & value.isNull()


def root_misfit(get, schema: T.StructType, options: XmlOptions) -> Column | None:
    """Whether an attribute of the record itself does not fit; None where no attribute can be."""
    flags = [convert(get(f.name), f.dataType, options, True)[1] for f in schema.fields if _is_attribute(f, options) and not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.StringType))]
    return any_of(flags) if flags else None


def _is_attribute(f: T.StructField, options: XmlOptions) -> bool:
    return f.name.startswith(options.attribute_prefix) and f.name != options.value_tag


def typed_fields(get, schema: T.StructType, options: XmlOptions, root: Column | None) -> tuple[list[Column], Column]:
    """Typed top-level fields and whether the record has a misfit; ``get(name)`` is the raw field.

    A misfit in an attribute of the record itself leaves no field: ``root`` is a column that holds
    ``root_misfit``, so that it is not computed for each field again.
    """
    parts = [(f, *convert(get(f.name), f.dataType, options, _is_attribute(f, options))) for f in schema.fields]
    values = [(v if root is None else F.when(~root, v)).cast(f.dataType).alias(f.name) for f, v, _ in parts]
    return values, any_of([b for _, _, b in parts])


MALFORMED = "Malformed line in FAILFAST mode"
