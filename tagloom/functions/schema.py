"""Schemas from XML text in columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.sources.options import XmlOptions


def schema_of_xml_df(frame: DataFrame, **options: object) -> T.StructType:
    """The merged schema of all texts in a one-column frame (a pass over all of them)."""
    from tagloom.sources.reader import without_mixed_text

    if len(frame.columns) != 1:
        raise ValueError("the frame must have one column of XML text")
    parsed = XmlOptions.of(**options)
    native = parsed.reading() | {"mode": "PERMISSIVE"}
    spark = frame.sparkSession
    texts = frame.where(F.col(frame.columns[0]).isNotNull())
    reader = spark.read.options(**native)._jreader
    found = T._parse_datatype_json_string(reader.xml(getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())).schema().json())
    return T.StructType(sorted(without_mixed_text(found, parsed).fields, key=lambda f: f.name))


def schema_of_xml(frame: DataFrame, column: str, **options: object) -> T.StructType:
    """The merged schema of a string column."""
    return schema_of_xml_df(frame.select(column), **options)


def schema_of_xml_array(frame: DataFrame, column: str | None = None, **options: object) -> T.ArrayType:
    """The merged schema of the texts in a column of string arrays."""
    return T.ArrayType(schema_of_xml_df(frame.select(F.explode(column or frame.columns[0]).alias("xml")), **options))
