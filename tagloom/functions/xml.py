"""Column functions: XML text to structs and back."""

from __future__ import annotations

from pyspark.sql import Column, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions import parsing
from tagloom.functions.single import parse_text
from tagloom.sources.options import XmlOptions


def _schema(schema: T.DataType | str) -> T.DataType:
    return schema if isinstance(schema, T.DataType) else T._parse_datatype_string(schema)


def raw_struct(xml: Column, schema: T.StructType, options: XmlOptions) -> Column:
    """The text as a struct of strings; its corrupt-record field is set where it is no such XML."""
    corrupt = options.column_name_of_corrupt_record
    wanted = T.StructType([f for f in schema.fields if f.name != corrupt])
    strings = T.StructType([*parsing.string_schema(wanted).fields, T.StructField(corrupt, T.StringType())])
    native = options.reading() | {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false"}
    for other in ("useLegacyXMLParser", "nullValue", "samplingRatio", "inferSchema"):
        native.pop(other, None)
    return F.from_xml(xml, strings, native)


def typed_struct(xml: Column, raw: Column, schema: T.StructType, options: XmlOptions) -> Column:
    """The typed struct of a text and its ``raw_struct``, by the rules of ``from_xml``."""
    corrupt = options.column_name_of_corrupt_record
    wanted = T.StructType([f for f in schema.fields if f.name != corrupt])
    broken = raw.getField(corrupt).isNotNull()
    values, misfit = parsing.typed_fields(raw.getField, wanted, options, parsing.root_misfit(raw.getField, wanted, options))
    bad = xml.isNotNull() & (broken | misfit)
    fields = {f.name: v for f, v in zip(wanted.fields, values)} | {corrupt: F.lit(None).cast("string").alias(corrupt)}
    if options.mode == "PERMISSIVE" and corrupt in schema.names:
        fields = {f.name: F.when(~broken, v).alias(f.name) for f, v in zip(wanted.fields, values)} | {corrupt: F.when(bad, xml).alias(corrupt)}
        return F.when(xml.isNotNull(), F.struct(*(fields[n] for n in schema.names)))
    whole = F.struct(*(fields[n] for n in schema.names))
    if options.mode == "FAILFAST":
        return F.when(bad, F.raise_error(F.lit(parsing.MALFORMED)).cast(schema)).when(xml.isNotNull(), whole)
    return F.when(xml.isNotNull() & ~bad, whole)


def _parsed(xml: Column, schema: T.StructType, options: XmlOptions) -> Column:
    return typed_struct(xml, raw_struct(xml, schema, options), schema, options)


def from_xml(xml: Column | str, schema: T.DataType | str, options: dict | None = None) -> Column:
    """A string column to structs, or an array of strings to an array of structs.

    Null stays null.  A malformed text is null unless the schema has the corrupt-record field, which
    then holds it beside the fields that fit; FAILFAST raises; rows are never dropped.
    """
    xml = F.col(xml) if isinstance(xml, str) else xml
    kind, parsed = _schema(schema), XmlOptions.of(**(options or {}))
    if isinstance(kind, T.ArrayType):
        return F.transform(xml, lambda x: _parsed(x, kind.elementType, parsed))
    return _parsed(xml, kind, parsed)


def from_xml_string(spark: SparkSession | None, xml: str | None, schema: T.StructType | str, options: dict | None = None) -> Row | None:
    """One text to one Row.  Without a session, such as inside a UDF, plain Python reads it; the
    schema is then a StructType."""
    if spark is None:
        return parse_text(xml, schema, XmlOptions.of(**(options or {})))
    frame = spark.createDataFrame([(xml,)], "xml string")
    return frame.select(from_xml("xml", schema, options).alias("row")).first()["row"]


def to_xml(struct: Column | str, options: dict | None = None) -> Column:
    """Structs to XML text."""
    native = XmlOptions.of(**(options or {})).writing()
    for unused in ("rootTag", "declaration", "encoding", "columnNameOfCorruptRecord"):
        native.pop(unused, None)
    return F.to_xml(struct, native)
