"""XML folders as streams."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tagloom.functions import parsing
from tagloom.sources import reader, records
from tagloom.sources.options import XmlOptions


def read_xml_stream(spark: SparkSession, path: str, schema: T.StructType | str, **options: object) -> DataFrame:
    """A stream of the records of new files in ``path``, typed as a batch read types them, in all
    modes and with the text of malformed records where the schema asks for it."""
    parsed = XmlOptions.of(**options)
    if parsed.timezone is None:
        parsed = replace(parsed, timezone=spark.conf.get("spark.sql.session.timeZone"))
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if parsed.column_name_of_corrupt_record in kind.names:
        return reader._rows(records.whole_records(spark, path, parsed.row_tag, parsed.charset, stream=True), kind, parsed)
    raw = spark.readStream.format("xml").options(**reader.string_scan(parsed)).schema(parsing.string_schema(kind)).load(path)
    return reader.typed_rows(raw, kind, parsed)
