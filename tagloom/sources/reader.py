"""Reading XML files into typed DataFrames."""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions import parsing
from tagloom.functions import xml as xml_functions
from tagloom.sources.options import XmlOptions
from tagloom.sources.records import is_utf8, paths, xml_records


def without_mixed_text(kind: T.DataType, options: XmlOptions) -> T.DataType:
    """Drops inferred text fields beside child elements: mixed text is not data."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(without_mixed_text(kind.elementType, options), kind.containsNull)
    if not isinstance(kind, T.StructType):
        return kind
    children = [f for f in kind.fields if f.name != options.value_tag and not f.name.startswith(options.attribute_prefix)]
    kept = [f for f in kind.fields if f.name != options.value_tag or not (children or isinstance(f.dataType, T.ArrayType))]
    return T.StructType([T.StructField(f.name, without_mixed_text(f.dataType, options), f.nullable) for f in kept])


def infer_schema(spark: SparkSession, path: str | list[str], **options: object) -> T.StructType:
    """The inferred schema: fields by name; a corrupt-record field only where a record is malformed
    and the mode is PERMISSIVE.  No mode fails here."""
    parsed = XmlOptions.of(**options)
    native = parsed.reading() | {"mode": "PERMISSIVE"}
    for key, value in (("timestampFormat", parsed.timestamp_format), ("dateFormat", parsed.date_format)):
        if value:
            native[key] = value
    found = without_mixed_text(spark.read.format("xml").options(**native).load(paths(path)).schema, parsed)
    corrupt = parsed.column_name_of_corrupt_record
    keep = lambda f: f.name != corrupt or parsed.mode == "PERMISSIVE"
    return T.StructType(sorted((f for f in found.fields if keep(f)), key=lambda f: f.name))


def read_xml(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, engine: str = "auto", **options: object) -> DataFrame:
    """A typed DataFrame of all records; ``path`` may be a glob, a list, or a text with commas.

    ``engine``: ``auto`` scans files that one task can hold with Spark's source, and cuts records
    out of larger ones with many tasks (see ``xml_records``); where the schema asks for the text of
    malformed records these are always cut out, so that text and fields come from one pass.
    ``split`` cuts flat records out without looking ahead, ``records`` whole ones with one task a
    file; ``stream`` is Spark's one-pass parser with its own semantics.  Without the option
    ``timezone`` the session's time zone holds.
    """
    if not path:
        raise ValueError("'path' must be specified for XML data.")
    path = paths(path)
    parsed = XmlOptions.of(**options)
    if parsed.timezone is None:
        parsed = replace(parsed, timezone=spark.conf.get("spark.sql.session.timeZone"))
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    if engine == "stream":
        reader = spark.read.format("xml").options(**(parsed.reading() | {"useLegacyXMLParser": "false"}))
        return (reader.schema(schema) if schema else reader).load(path)
    if schema is None:
        schema = infer_schema(spark, path, **options)
    if engine != "auto":
        return _rows(xml_records(spark, path, parsed.row_tag, engine, parsed.charset), _nullable(schema), parsed)
    if parsed.column_name_of_corrupt_record in schema.names or (is_utf8(parsed.charset) and _large(spark, path)):
        return _rows(xml_records(spark, path, parsed.row_tag, "auto", parsed.charset), _nullable(schema), parsed)
    return _scan(spark, path, _nullable(schema), parsed)


def _large(spark: SparkSession, path: list[str]) -> bool:
    """Whether a file is larger than what a task should read."""
    files = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return files > size


def _nullable(kind: T.DataType) -> T.DataType:
    """Nullability of a schema is not enforced, at any depth."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _nullable(kind.valueType), True)
    return kind


def _rows(texts: DataFrame, schema: T.StructType, options: XmlOptions) -> DataFrame:
    """Records with their text at hand.  In PERMISSIVE mode every record is a row."""
    corrupt = options.column_name_of_corrupt_record
    wanted = T.StructType([f for f in schema.fields if f.name != corrupt])
    per_record = replace(options, mode="PERMISSIVE")
    # parsed in a projection of its own: each field below reads the one parse
    rows = texts.select("xml", xml_functions.raw_struct(F.col("xml"), wanted, per_record).alias("raw"))
    get = lambda name: F.col("raw").getField(name)
    root = parsing.root_misfit(get, wanted, options)
    lost = get(corrupt).isNotNull() if root is None else get(corrupt).isNotNull() | root
    rows = rows.withColumn("lost", lost)
    values, misfit = parsing.typed_fields(get, wanted, options, F.col("lost"))
    bad = get(corrupt).isNotNull() | misfit
    fields = dict(zip(wanted.names, values)) | {corrupt: F.when(bad, F.col("xml")).alias(corrupt)}
    return _kept(rows, bad, options).select(*(fields[n] for n in schema.names))


def _kept(rows: DataFrame, bad: Column, options: XmlOptions) -> DataFrame:
    """The rows that the mode keeps.  A filter, so that it holds whatever columns are read."""
    if options.mode == "DROPMALFORMED":
        return rows.where(~bad)
    if options.mode == "FAILFAST":
        return rows.where(F.when(bad, F.raise_error(F.lit(parsing.MALFORMED)).cast("boolean")).otherwise(True))
    return rows


def typed_rows(raw: DataFrame, schema: T.StructType, options: XmlOptions) -> DataFrame:
    """Typed rows of an all-string scan."""
    if parsing.all_strings(schema) and options.null_value is None and not options.treat_empty_values_as_nulls and not options.ignore_surrounding_spaces:
        return raw
    get = lambda name: F.col(f"`{name}`")
    root = parsing.root_misfit(get, schema, options)
    if root is not None:
        lost = next(n for n in ("lost", *(f"lost{i}" for i in range(len(schema)))) if n not in schema.names)
        raw, root = raw.withColumn(lost, root), F.col(lost)
    values, misfit = parsing.typed_fields(get, schema, options, root)
    return _kept(raw, misfit, options).select(*values)


def _scan(spark: SparkSession, path: list[str], schema: T.StructType, options: XmlOptions) -> DataFrame:
    return typed_rows(spark.read.format("xml").options(**string_scan(options)).schema(parsing.string_schema(schema)).load(path), schema, options)


def string_scan(options: XmlOptions) -> dict[str, str]:
    """Options of Spark's source under which all leaves are read as they stand."""
    native = options.reading() | {"ignoreSurroundingSpaces": "false"}
    native.pop("nullValue", None)
    return native


def xml_file(spark: SparkSession, path: str, row_tag: str = "ROW", fail_fast: bool = False, **options: object) -> DataFrame:
    """The one-call reader; ``fail_fast`` is the FAILFAST mode."""
    if fail_fast:
        options["mode"] = "FAILFAST"
    return read_xml(spark, path, rowTag=row_tag, **options)


def xml_dataset(frame: DataFrame, schema: T.StructType | str | None = None, column: str | None = None, **options: object) -> DataFrame:
    """Typed rows from a column of record texts; without a schema it is inferred from all of them."""
    from tagloom.functions.schema import schema_of_xml_df

    texts = frame.select(F.col(column or frame.columns[0]).alias("xml"))
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    return _rows(texts, _nullable(kind or schema_of_xml_df(texts, **options)), XmlOptions.of(**options))


def xml_rdd(spark: SparkSession, rdd, schema: T.StructType | str | None = None, **options: object) -> DataFrame:
    """Typed rows from an RDD of record texts."""
    return xml_dataset(spark.createDataFrame(rdd.map(lambda x: (x,)), "xml string"), schema, **options)


class XmlReader:
    """A builder with one setter to an option."""

    def __init__(self, schema: T.StructType | None = None, options: dict | None = None):
        self.schema, self.options = schema, dict(options or {})

    def _with(self, key: str, value: object) -> XmlReader:
        self.options[key] = value
        return self

    def with_schema(self, schema: T.StructType) -> XmlReader:
        self.schema = schema
        return self

    def with_fail_fast(self, on: bool) -> XmlReader:
        return self._with("mode", "FAILFAST" if on else "PERMISSIVE")

    def xml_file(self, spark: SparkSession, path: str) -> DataFrame:
        return read_xml(spark, path, self.schema, **self.options)

    def xml_dataset(self, spark: SparkSession, frame: DataFrame) -> DataFrame:
        return xml_dataset(frame, self.schema, **self.options)

    def xml_rdd(self, spark: SparkSession, rdd) -> DataFrame:
        return xml_rdd(spark, rdd, self.schema, **self.options)


for _key in ("charset", "compression", "rowTag", "samplingRatio", "excludeAttribute", "treatEmptyValuesAsNulls", "parseMode", "attributePrefix", "valueTag", "columnNameOfCorruptRecord", "ignoreSurroundingSpaces", "rowValidationXSDPath"):
    _name = "with_" + re.sub(r"([a-z])([A-Z])|([A-Z])([A-Z][a-z])", r"\1\3_\2\4", _key).lower()

    def _setter(self: XmlReader, value: object, _key: str = "mode" if _key == "parseMode" else _key) -> XmlReader:
        return self._with(_key, value)

    _setter.__name__, _setter.__doc__ = _name, f"Sets ``{_key}``."
    setattr(XmlReader, _name, _setter)
    setattr(XmlReader, f"with{_key[0].upper()}{_key[1:]}", _setter)
XmlReader.withSchema = XmlReader.with_schema
XmlReader.withFailFast = XmlReader.with_fail_fast
