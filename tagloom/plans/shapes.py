"""Registered queries of record shapes, schemas, options, entry points and large files."""

from __future__ import annotations

import bz2
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import xsd
from tagloom.functions.xml import to_xml
from tagloom.plans.queries import _broken, _fields, _payloads, parquet, register, stored, texts
from tagloom.sources.reader import XmlReader, infer_schema, read_xml, xml_dataset, xml_file, xml_rdd
from tagloom.sources.records import Pieces, is_flat, xml_records
from tagloom.sources.writer import save_as_xml_file, write_xml
from tagloom.workspace import scratch_path


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def settled(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` computed now, under the settings of now."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lines_of(spark: SparkSession, sf_dir: str, table: str, text: str, name: str) -> str:
    return texts(spark, parquet(spark, sf_dir, table).selectExpr(text), name)


# ---------------------------------------------------------------- large files in many tasks


#: A large file has very many cuts of a few kilobytes: about so many tasks, or four to a core, share them.
TASKS = 64


@contextmanager
def small_cuts(spark: SparkSession):
    """Files are cut every few kilobytes, and a task takes as many cuts as come to it."""
    tasks = max(TASKS, 4 * spark.sparkContext.defaultParallelism)
    with setting(spark, "spark.sql.files.maxPartitionBytes", "2k"), setting(spark, "spark.sql.files.maxPartitionNum", str(tasks)):
        yield


def _in_tasks(spark: SparkSession, path: str, schema: str, name: str, tell: bool = True, **options: object) -> DataFrame:
    """A read of files that are cut every few kilobytes, and with ``tell`` whether a task other than the first found text in a later cut of a file (tasks)."""
    is_flat(spark, [path], "row")  # remembered; what it finds doesn't depend on the cuts
    with small_cuts(spark):
        rows = settled(spark, read_xml(spark, path, schema, rowTag="row", **options), name)
        if not tell:
            return rows
        # the first task has a first cut, which always has text; the scan ends at the first such text of another
        later = (F.spark_partition_id() > 0) & (F.col("_metadata.file_block_start") > 0)
        one = Pieces("row").read(spark, path).where(later).limit(1).isEmpty()
    return rows.withColumn("tasks", F.lit(not one))


_NESTED = "format_string('<row id=\"%d\"><k>%d</k><row x=\"2\"><s>%s</s><row y=\"1\"/></row><row>%s</row></row>', o_orderkey, o_custkey, o_orderstatus, repeat('z', int(o_orderkey % 50)))"


@register("SELECT o_orderkey AS id, o_custkey AS k, true AS tasks FROM orders")
def nested_in_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = texts(spark, parquet(spark, sf_dir, "orders").coalesce(1).selectExpr(_NESTED), "nested")
    return _in_tasks(spark, path, "_id bigint, k bigint", "nested").selectExpr("_id AS id", "k", "tasks")


#: Records that one task writes as one file; of more, several tasks write files of about so many.
FILE_ROWS = 1_000_000


@register("SELECT o_orderkey AS id, o_custkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS s FROM orders")
def empty_records_in_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "CASE WHEN o_orderkey % 3 = 0 THEN format_string('<row id=\"%d\" k=\"%d\"><s>%s</s></row>', o_orderkey, o_custkey, o_orderstatus) ELSE format_string('<row id=\"%d\" k=\"%d\"/>', o_orderkey, o_custkey) END"
    orders = parquet(spark, sf_dir, "orders")
    path = texts(spark, orders.coalesce(max(1, -(-orders.count() // FILE_ROWS))).selectExpr(text), "empty")
    return _in_tasks(spark, path, "_id bigint, _k bigint, s string", "empty", tell=False).selectExpr("_id AS id", "_k AS k", "s")


#: Packing takes a task some seconds for so many rows; a file of them has about 40 blocks.
BZIP2_ROWS = 25_000

#: A stream of nothing, which may follow any other in a file.
EMPTY_BZIP2 = bz2.compress(b"")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All lines of a task as one stream, in blocks of 900 kB; null is an empty line."""
    packer, parts = bz2.BZ2Compressor(9), []
    for batch in batches:
        parts += [packer.compress((x or b"") + b"\n") for x in batch.column(0).cast(pa.binary()).to_pylist()]
    yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts) + packer.flush()], pa.binary())], ["value"])


def bzip2_texts(spark: SparkSession, df: DataFrame, name: str) -> str:
    """As ``texts``, a bzip2 file to a task.  On text that repeats itself the library of C is faster
    than Hadoop's codec and packs smaller."""
    path = scratch_path(spark, name)
    # a file is one row, and the separator behind it is a stream too; the encoding is that of the separator only
    streams = df.mapInArrow(_pack, "value binary").select(F.col("value").cast("string"))
    streams.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_BZIP2.decode("latin-1")).text(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for file in files.listStatus(folder):
        if file.getPath().getName().endswith(".txt"):
            files.rename(file.getPath(), file.getPath().suffix(".bz2"))
    return path


@register("SELECT o_orderkey AS id, o_custkey AS k, true AS tasks FROM orders")
def bzip2_in_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a block of bzip2 holds 900 kB of text, so records get some that does not shrink by its runs
    padded = f"replace({_NESTED}, '<k>', concat('<pad>', repeat(md5(string(o_orderkey)), 40), '</pad><k>'))"
    orders = parquet(spark, sf_dir, "orders")
    files = -(-orders.count() // BZIP2_ROWS)
    orders = orders.repartition(files) if files > 1 else orders.coalesce(1)
    path = bzip2_texts(spark, orders.selectExpr(f"{padded} AS value"), "bz")
    return _in_tasks(spark, path, "_id bigint, k bigint", "bz").selectExpr("_id AS id", "k", "tasks")


@register("SELECT count(*) AS n, sum((o_orderkey % 10 = 0 OR o_orderkey % 7 = 0)::INT)::BIGINT AS bad, true AS whole FROM orders")
def corrupt_text_in_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _in_tasks(spark, _broken(spark, sf_dir), "k bigint, p bigint, s string, _corrupt_record string", "corrupt")
    bad = F.col("_corrupt_record")
    return rows.agg(F.count("*").alias("n"), F.count(bad).alias("bad"), F.min(F.coalesce(bad.startswith("<row>") & bad.endswith("</row>"), F.lit(True))).alias("whole"))


@register("SELECT n_nationkey AS k, '<row><k>' || n_nationkey || '</k><row><name>' || n_name || '</name></row></row>' AS xml FROM nation")
def record_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = lines_of(spark, sf_dir, "nation", "format_string('<row><k>%d</k><row><name>%s</name></row></row>', n_nationkey, n_name)", "texts")
    return xml_records(spark, path, "row").select(F.regexp_extract("xml", "<k>(.*?)</k>", 1).cast("int").alias("k"), "xml")


# ---------------------------------------------------------------- inference

_MERGED = {
    "num": ("<num>1</num>", "<num>2.5</num>"),
    "day": ("<day>2021-02-03</day>", "<day>2022-03-04</day>"),
    "flag": ("<flag>true</flag>", "<flag>1</flag>"),
    "when": ("<when>2021-02-03T04:05:06Z</when>", "<when>17</when>"),
    "wide": ("<wide>12345678901234567890</wide>", "<wide>0.5</wide>"),
    "none": ("<none/>", "<none>5</none>"),
    "many": ("<many>1</many><many>2</many>", "<many>3</many>"),
    "part": ("<part><x>1</x></part>", "<part><y>a</y></part>"),
    "val": ("<val>1</val>", "<val unit=\"k\">2.5</val>"),
    "mixed": ("<mixed>text <f>1</f> more</mixed>", "<mixed><f>2</f></mixed>"),
    "blank": ("<blank/>", "<blank></blank>"),
    "obj": ("<obj at=\"1\"><p>1</p><p>2</p></obj>", "<obj/>"),
}
_MERGED_TYPES = {
    "num": "double",
    "day": "date",
    "flag": "string",
    "when": "string",
    "wide": "double",
    "none": "bigint",
    "many": "array<bigint>",
    "part": "struct<x:bigint,y:string>",
    "val": "struct<_VALUE:double,_unit:string>",
    "mixed": "struct<f:bigint>",
    "blank": "string",
    "obj": "struct<_at:bigint,p:array<bigint>>",
}


@register("SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in _MERGED_TYPES.items()) + ") t(name, type)")
def infer_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    one, two = ("<row>" + "".join(x[i] for x in _MERGED.values()) + "</row>" for i in (0, 1))
    path = lines_of(spark, sf_dir, "nation", f"if(n_nationkey % 2 = 0, '{one}', '{two}')", "merges")
    return _fields(spark, infer_schema(spark, path, rowTag="row"))


@register("SELECT * FROM (VALUES ('n_name', 'string'), ('n_nationkey', 'bigint'), ('n_regionkey', 'bigint')) t(name, type)")
def infer_with_xsd(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.plans.queries import nation_xsd

    path = stored(spark, parquet(spark, sf_dir, "nation"), "inferxsd")
    return _fields(spark, infer_schema(spark, path, rowTag="row", mode="DROPMALFORMED", rowValidationXSDPath=nation_xsd(spark)))


@register("SELECT n_nationkey AS k, 'v' || n_nationkey AS f FROM nation")
def mixed_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = lines_of(spark, sf_dir, "nation", "format_string('<row>lead <k>%d</k> mid <s>x<f>v%d</f>y</s> tail</row>', n_nationkey, n_nationkey)", "mixed")
    return read_xml(spark, path, rowTag="row").selectExpr("int(k) AS k", "s.f AS f")


# ---------------------------------------------------------------- shapes of records


@register("SELECT n_nationkey AS k, n_nationkey % 3 <> 0 AS there, CASE WHEN n_nationkey % 3 = 2 THEN n_regionkey END AS x FROM nation")
def empty_or_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "format_string('<row><k>%d</k>%s</row>', n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN '' WHEN 1 THEN '<s></s>' ELSE format_string('<s><x>%d</x></s>', n_regionkey) END)"
    rows = read_xml(spark, lines_of(spark, sf_dir, "nation", text, "missing"), "k int, s struct<x: int>", rowTag="row")
    return rows.selectExpr("k", "s IS NOT NULL AS there", "s.x AS x")


@register("SELECT n_nationkey AS k, CASE WHEN n_nationkey % 2 = 0 THEN n_regionkey END AS r, CASE WHEN n_nationkey % 2 = 0 THEN n_name END AS s FROM nation")
def blank_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "format_string('<row r=\"%s\" s=\"%s\"><k>%d</k></row>', if(n_nationkey % 2 = 0, string(n_regionkey), ' '), if(n_nationkey % 2 = 0, n_name, ''), n_nationkey)"
    rows = read_xml(spark, lines_of(spark, sf_dir, "nation", text, "blank"), "k int, _r int, _s string", rowTag="row", treatEmptyValuesAsNulls=True)
    return rows.selectExpr("k", "_r AS r", "_s AS s")


@register("SELECT n_nationkey AS k, '<b at=\"1\">' || n_name || '</b> and <i>more</i>' AS d FROM nation")
def element_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "format_string('<row><k>%d</k><d><b at=\"1\">%s</b><!-- gone --> and <i>more</i></d></row>', n_nationkey, n_name)"
    return read_xml(spark, lines_of(spark, sf_dir, "nation", text, "element"), "k int, d string", rowTag="row")


@register("SELECT n_nationkey AS k, n_name || ' <&> ' || n_name AS d FROM nation")
def comments_and_cdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "format_string('<!-- a --><row><!-- b --><k>%d</k><d><![CDATA[%s <&> ]]>%s</d></row>', n_nationkey, n_name, n_name)"
    return read_xml(spark, lines_of(spark, sf_dir, "nation", text, "cdata"), "k int, d string", rowTag="row")


@register("SELECT n_nationkey AS k, n_name AS v FROM nation")
def trailing_junk(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = lines_of(spark, sf_dir, "nation", "format_string('junk <row><k>%d</k><v>%s</v></row> & junk > <other/>', n_nationkey, n_name)", "junk")
    return read_xml(spark, path, "k int, v string", rowTag="row")


@register("SELECT n_nationkey AS k, CASE WHEN n_nationkey % 2 = 0 THEN n_regionkey END AS r, n_nationkey % 2 = 1 AS bad FROM nation")
def blank_leaf(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "format_string('<row><k>%d</k><r>%s</r></row>', n_nationkey, if(n_nationkey % 2 = 0, string(n_regionkey), ' '))"
    rows = read_xml(spark, lines_of(spark, sf_dir, "nation", text, "leaf"), "k int, r int, _corrupt_record string", rowTag="row")
    return rows.selectExpr("k", "r", "_corrupt_record IS NOT NULL AS bad")


@register("SELECT o_orderkey AS k, o_custkey AS c FROM orders")
def nested_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "orders").selectExpr("named_struct('a', named_struct('k', o_orderkey, 's', o_orderstatus), 'b', named_struct('c', o_custkey, 'p', o_totalprice)) AS o")
    rows = read_xml(spark, stored(spark, df, "projection"), df.schema, rowTag="row")
    return rows.selectExpr("o.a.k AS k", "o.b.c AS c")


# ---------------------------------------------------------------- options with other values


@register("SELECT n_nationkey AS id, n_name AS name, n_regionkey AS region FROM nation")
def other_prefix_and_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "nation").selectExpr("n_nationkey AS `@id`", "named_struct('#', n_name, '@region', n_regionkey) AS name")
    names = {"attributePrefix": "@", "valueTag": "#"}
    path = stored(spark, df, "prefix", rootTag="all", **names)
    rows = read_xml(spark, path, df.schema, rowTag="row", **names)
    return rows.select(F.col("@id").alias("id"), F.col("name").getField("#").alias("name"), F.col("name").getField("@region").alias("region"))


@register("SELECT n_nationkey, [n_name, n_regionkey::VARCHAR] AS rest FROM nation")
def other_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return read_xml(spark, stored(spark, df, "rest"), "n_nationkey int, rest array<string>", rowTag="row", wildcardColName="rest")


@register("SELECT o_orderkey AS k, o_orderdate::DATE AS d, o_orderdate AS t, o_orderdate - INTERVAL 3 HOUR AS z FROM orders")
def formats_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, time = "dd.MM.yyyy", "yyyy/MM/dd HH:mm:ss"
    df = parquet(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.date_format("o_orderdate", day).alias("d"), F.date_format("o_orderdate", time).alias("t"))
    path = stored(spark, df, "formats")
    read = lambda zone: read_xml(spark, path, "k bigint, d date, t timestamp", rowTag="row", dateFormat=day, timestampFormat=time, timezone=zone)
    zoned = read("Etc/GMT-3").select(F.col("k").alias("_k"), F.col("t").cast("timestamp_ntz").alias("z"))
    return read("UTC").join(zoned, F.col("k") == F.col("_k")).select("k", "d", F.col("t").cast("timestamp_ntz").alias("t"), "z")


@register("SELECT o_orderkey AS k, o_orderdate - INTERVAL 3 HOUR AS t FROM orders")
def session_time_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = "yyyy/MM/dd HH:mm:ss"
    df = parquet(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.date_format("o_orderdate", time).alias("t"))
    path = stored(spark, df, "zone")
    with setting(spark, "spark.sql.session.timeZone", "Etc/GMT-3"):
        rows = read_xml(spark, path, "k bigint, t timestamp", rowTag="row", timestampFormat=time)
    return rows.select("k", F.to_utc_timestamp(F.col("t"), "UTC").cast("timestamp_ntz").alias("t"))


@register("SELECT o_orderkey AS k, o_orderdate::DATE AS d FROM orders")
def date_format_on_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").cast("date").alias("d"))
    path = stored(spark, df, "days", dateFormat="yyyy.DDD")
    rows = read_xml(spark, path, "k bigint, d string", rowTag="row")
    return rows.select("k", F.expr("date_add(make_date(int(substring(d, 1, 4)), 1, 1), int(substring(d, 6, 3)) - 1)").alias("d"))


@register("SELECT n_nationkey AS k, CASE WHEN n_nationkey % 2 = 0 THEN n_name END AS s, n_nationkey % 2 <> 0 AS written FROM nation")
def null_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "nation").selectExpr("n_nationkey AS k", "CASE WHEN n_nationkey % 2 = 0 THEN n_name END AS s", "CAST(NULL AS STRING) AS _a")
    plain, named = stored(spark, df, "omitted"), stored(spark, df, "named", nullValue="nil")
    omitted = read_xml(spark, plain, "k int, s string", rowTag="row")
    shown = read_xml(spark, named, "k int, s string", rowTag="row").selectExpr("k AS _k", "s = 'nil' AS written")
    return omitted.join(shown, F.col("k") == F.col("_k")).select("k", "s", "written")


@register("SELECT n_nationkey AS k, 'Ünï ' || n_name AS s FROM nation")
def other_charset(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "nation").selectExpr("n_nationkey AS k", "concat('Ünï ', n_name) AS s")
    path = stored(spark, df, "latin", charset="iso-8859-1", declaration='version="1.0" encoding="iso-8859-1"')
    return read_xml(spark, path, df.schema, rowTag="row", charset="iso-8859-1")


@register("SELECT true AS declared, true AS rooted, count(*) AS n FROM nation")
def declaration_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stored(spark, parquet(spark, sf_dir, "nation").coalesce(1), "declared", declaration='version="1.1"', rootTag="all")
    lines = spark.read.text(path)
    line = F.trim("value")
    return lines.agg(F.max(line == '<?xml version="1.1"?>').alias("declared"), (F.max(line == "<all>") & F.max(line == "</all>")).alias("rooted"), F.count(F.when(line == "<row>", 1)).alias("n"))


# ---------------------------------------------------------------- entry points


@register("SELECT n_nationkey AS k, n_name AS name FROM nation")
def builder_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "nation").selectExpr("n_nationkey AS k", "concat(' ', n_name, ' ') AS name", "n_regionkey AS _r")
    reader = XmlReader().withRowTag("row").withExcludeAttribute(True).withIgnoreSurroundingSpaces(True).withCharset("UTF-8").withSamplingRatio(1.0).withTreatEmptyValuesAsNulls(True)
    reader = reader.withParseMode("PERMISSIVE").withAttributePrefix("_").withValueTag("_VALUE").withColumnNameOfCorruptRecord("bad").withFailFast(False).withCompression("none")
    return reader.xml_file(spark, stored(spark, df, "builder")).selectExpr("int(k) AS k", "name")


@register("SELECT n_nationkey AS k, n_name AS name FROM nation")
def one_call_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "nation").selectExpr("n_nationkey AS k", "n_name AS name")
    path = scratch_path(spark, "onecall")
    save_as_xml_file(df, path, {"rowTag": "nation"}, "gzip")
    return xml_file(spark, path, "nation", fail_fast=True).selectExpr("int(k) AS k", "name")


@register("SELECT o_orderkey AS k, o_totalprice AS p, o_orderstatus AS s FROM orders")
def dataset_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xml_dataset(_payloads(spark, sf_dir).select("payload"), rowTag="o")


@register("SELECT n_nationkey AS k, n_name AS s FROM nation")
def rdd_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parquet(spark, sf_dir, "nation").select(to_xml(F.struct(F.col("n_nationkey").alias("k"), F.col("n_name").alias("s")), {"rowTag": "o"}).alias("x"))
    return xml_rdd(spark, rows.rdd.map(lambda r: r["x"]), "k int, s string", rowTag="o")


@register("SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT r_regionkey + 100, r_name, NULL FROM region")
def path_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = stored(spark, parquet(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"), "list")
    regions = stored(spark, parquet(spark, sf_dir, "region").selectExpr("r_regionkey + 100 AS n_nationkey", "r_name AS n_name"), "list")
    return read_xml(spark, f"{nations}/*.xml,{regions}", "n_nationkey int, n_name string, n_regionkey int", rowTag="row")


@register("SELECT 0::BIGINT AS n, count(*) AS m FROM nation")
def empty_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "nation")
    none = read_xml(spark, stored(spark, df.limit(0), "none"), df.schema, rowTag="row").agg(F.count("n_name").alias("n"))
    sparse = df.repartitionByRange(40, "n_nationkey")  # some partitions are empty
    return none.join(read_xml(spark, stored(spark, sparse, "sparse"), df.schema, rowTag="row").agg(F.count("n_name").alias("m")), F.lit(True))


def _fails(action: Callable[[], object]) -> bool:
    try:
        action()
    except Exception:  # noqa: BLE001  the query reports that there was one
        return True
    return False


@register("SELECT * FROM (VALUES ('append, strict', true), ('duplicate save', true), ('failfast', true), ('failfast count', true), ('interval in a map', true), ('missing path', true), ('nested split', true), ('no path', true), ('option', true), ('sound', false)) t(name, failed)")
def early_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "nation")
    path, broken = stored(spark, df, "errors"), _broken(spark, sf_dir)
    nested = lines_of(spark, sf_dir, "nation", "'<row><row><k>1</k></row></row>'", "nestederr")
    failfast = lambda: read_xml(spark, broken, "k bigint, p bigint", rowTag="row", mode="FAILFAST")
    cases = {
        "append, strict": lambda: write_xml(df, path, "append", strict=True, rowTag="row"),
        "duplicate save": lambda: write_xml(df, path, rowTag="row"),
        "failfast": lambda: failfast().collect(),
        "failfast count": lambda: failfast().count(),
        "interval in a map": lambda: write_xml(df.selectExpr("map('a', make_dt_interval(1)) AS m"), f"{path}-m"),
        "missing path": lambda: read_xml(spark, f"{path}-none", df.schema, rowTag="row"),
        "nested split": lambda: read_xml(spark, nested, "k int", engine="split", rowTag="row").collect(),
        "no path": lambda: read_xml(spark, "", df.schema),
        "option": lambda: read_xml(spark, path, df.schema, rowTag="<row>"),
        "sound": lambda: read_xml(spark, path, df.schema, rowTag="row").collect(),
    }
    return spark.createDataFrame([(k, _fails(f)) for k, f in cases.items()], "name string, failed boolean")


@register("SELECT n_nationkey AS tag, n_regionkey AS v FROM nation")
def readers_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = [(r[0], r[1]) for r in parquet(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey").collect()]

    def read(nation: tuple[int, int]) -> tuple[int, int]:
        tag, value = nation
        path = scratch_path(spark, f"tag{tag}")
        spark.createDataFrame([(f"<t{tag}><v{tag}>{value}</v{tag}></t{tag}>",)], "x string").write.text(path)
        return tag, read_xml(spark, path, rowTag=f"t{tag}").first()[f"v{tag}"]

    with ThreadPoolExecutor(20) as pool:
        return spark.createDataFrame(list(pool.map(read, nations)), "tag int, v int")


# ---------------------------------------------------------------- SQL tables


@register("SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey = 1 UNION ALL SELECT n_nationkey + 100, n_name, n_regionkey FROM nation WHERE n_regionkey = 2")
def insert_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CREATE TABLE with columns, INSERT INTO, INSERT OVERWRITE, and again INSERT INTO."""
    path, name = scratch_path(spark, "inserted"), f"tagloom_{scratch_path(spark, 't').rsplit('-', 1)[1]}"
    spark.sql(f"CREATE TABLE {name} (n_nationkey INT, n_name STRING, n_regionkey INT) USING xml OPTIONS (rowTag 'row') LOCATION '{path}'")
    parquet(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey").createOrReplaceTempView(f"{name}_src")
    for verb, columns, region in (("INTO", "n_nationkey", 0), ("OVERWRITE", "n_nationkey", 1), ("INTO", "n_nationkey + 100", 2)):
        spark.sql(f"INSERT {verb} {name} SELECT CAST({columns} AS INT), n_name, n_regionkey FROM {name}_src WHERE n_regionkey = {region}")
    spark.sql(f"DROP TABLE {name}")  # its files stay where they are
    return read_xml(spark, path, "n_nationkey int, n_name string, n_regionkey int", rowTag="row")


@register("SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1")
def sql_ddl_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, name = stored(spark, parquet(spark, sf_dir, "nation"), "ddlinfer"), f"tagloom_{scratch_path(spark, 'v').rsplit('-', 1)[1]}"
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} USING xml OPTIONS (path '{path}', rowTag 'row')")
    return spark.sql(f"SELECT CAST(n_regionkey AS INT) AS n_regionkey, count(*) AS n FROM {name} GROUP BY n_regionkey")


# ---------------------------------------------------------------- XSD shapes

_SHAPES = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema" xmlns:o="urn:own" targetNamespace="urn:own">
  <xs:complexType name="base"><xs:sequence><xs:element name="x" type="xs:int"/></xs:sequence></xs:complexType>
  <xs:simpleType name="date"><xs:restriction base="xs:string"/></xs:simpleType>
  <xs:element name="v" type="xs:long"/>
  <xs:element name="simple"><xs:complexType><xs:simpleContent><xs:extension base="xs:float"><xs:attribute name="c" use="required"/></xs:extension></xs:simpleContent></xs:complexType></xs:element>
  <xs:element name="extended"><xs:complexType><xs:complexContent><xs:extension base="o:base"><xs:sequence><xs:element name="y" type="xs:dateTime"/></xs:sequence></xs:extension></xs:complexContent></xs:complexType></xs:element>
  <xs:element name="every"><xs:complexType><xs:all><xs:element name="p" type="xs:boolean" minOccurs="0"/><xs:element name="q" type="xs:short"/></xs:all></xs:complexType></xs:element>
  <xs:element name="either"><xs:complexType><xs:choice><xs:element name="a" type="xs:integer"/><xs:element name="b" type="xs:date"/><xs:any/></xs:choice></xs:complexType></xs:element>
  <xs:element name="listed"><xs:complexType><xs:sequence><xs:element ref="o:v" maxOccurs="unbounded"/><xs:element name="day" type="o:date"/><xs:any maxOccurs="3"/></xs:sequence></xs:complexType></xs:element>
</xs:schema>"""
_SHAPE_TYPES = {
    "v": "bigint",
    "simple": "struct<_VALUE:float,_c:string>",
    "extended": "struct<x:int,y:timestamp>",
    "every": "struct<p:boolean,q:smallint>",
    "either": "struct<a:int,b:date,xs_any:string>",
    "listed": "struct<v:array<bigint>,day:string,xs_any:array<string>>",
    "unsupported": "error",
    "recursive": "error",
}


@register("SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in _SHAPE_TYPES.items()) + ") t(name, type)")
def xsd_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = [(f.name, f.dataType.simpleString()) for f in xsd.schema_of_xsd(_SHAPES).fields]
    wrap = lambda body: f'<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">{body}</xs:schema>'
    odd = {
        "unsupported": '<xs:element name="r"><xs:complexType><xs:sequence><xs:sequence/></xs:sequence></xs:complexType></xs:element>',
        "recursive": '<xs:complexType name="t"><xs:sequence><xs:element name="t" type="t"/></xs:sequence></xs:complexType><xs:element name="r" type="t"/>',
    }
    for name, body in odd.items():
        try:
            found.append((name, xsd.schema_of_xsd(wrap(body)).simpleString()))
        except ValueError:
            found.append((name, "error"))
    return spark.createDataFrame(found, "name string, type string")
