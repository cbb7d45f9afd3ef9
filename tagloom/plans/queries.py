"""The registered queries: tables go to XML and back through the engine, then through Spark SQL.

Each entry pairs a query with the DuckDB SQL that gives the same rows from the Parquet tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions import casts, xsd
from tagloom.functions.schema import schema_of_xml, schema_of_xml_array
from tagloom.functions.xml import from_xml, to_xml
from tagloom.operators.joins import asof_join, range_join
from tagloom.sources.options import XmlOptions
from tagloom.sources.reader import infer_schema, read_xml
from tagloom.sources.records import xml_records
from tagloom.sources.writer import write_xml
from tagloom.workspace import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(sql: str | None, name: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        key = name or query.__name__
        QUERIES[key] = query
        if sql is not None:
            SQL[key] = sql
        return query

    return add


def parquet(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(spark: SparkSession, df: DataFrame, name: str, **options: object) -> str:
    path = scratch_path(spark, name)
    write_xml(df, path, **({"rowTag": "row"} | options))
    return path


def over_xml(spark: SparkSession, sf_dir: str, table: str, columns: list[str] | None = None) -> DataFrame:
    """A table as a scan of XML files with its own schema."""
    df = parquet(spark, sf_dir, table)
    df = df.select(*columns) if columns else df
    return read_xml(spark, stored(spark, df, table), df.schema, rowTag="row")


def texts(spark: SparkSession, df: DataFrame, name: str) -> str:
    """A folder of text files with one record text a line."""
    path = scratch_path(spark, name)
    df.write.text(path)
    return path


# ---------------------------------------------------------------- scans and sinks

for _table in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "conversations", "benchmark", "labels"):
    register(f"SELECT * FROM {_table}", f"scan_roundtrip_{_table}")(lambda spark, sf_dir, _table=_table: over_xml(spark, sf_dir, _table))


@register("SELECT l_returnflag, l_linestatus, sum(l_quantity)::DOUBLE AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem GROUP BY ALL")
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = over_xml(spark, sf_dir, "lineitem")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@register("SELECT l_returnflag, sum(l_quantity)::DOUBLE AS sum_qty, count(*) AS n FROM lineitem GROUP BY ALL")
def split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "lineitem")
    rows = read_xml(spark, stored(spark, df, "split"), df.schema, engine="split", rowTag="row")
    return rows.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("sum_qty"), F.count("*").alias("n"))


@register("SELECT l_returnflag, sum(l_quantity)::DOUBLE AS sum_qty, count(*) AS n FROM lineitem GROUP BY ALL")
def stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "lineitem")
    rows = read_xml(spark, stored(spark, df, "stream"), df.schema, engine="stream", rowTag="row", timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return rows.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("sum_qty"), F.count("*").alias("n"))


@register("SELECT n_nationkey AS _id, n_name AS name, n_regionkey AS _region FROM nation")
def scan_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "nation").selectExpr("n_nationkey AS _id", "n_name AS name", "n_regionkey AS _region")
    return read_xml(spark, stored(spark, df, "attributes"), df.schema, rowTag="row")


@register("SELECT n_nationkey AS id, n_name AS name, n_regionkey AS region FROM nation")
def scan_value_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "nation").selectExpr("named_struct('_id', n_nationkey, '_region', n_regionkey, '_VALUE', n_name) AS nation")
    rows = read_xml(spark, stored(spark, df, "value"), df.schema, rowTag="row")
    return rows.selectExpr("nation._id AS id", "nation._VALUE AS name", "nation._region AS region")


@register("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def scan_nested_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "orders").selectExpr("o_orderkey", "named_struct('key', o_custkey, 'bill', named_struct('total', o_totalprice)) AS customer")
    rows = read_xml(spark, stored(spark, df, "nested"), df.schema, rowTag="row")
    return rows.selectExpr("o_orderkey", "customer.key AS o_custkey", "customer.bill.total AS o_totalprice")


def _orders_with_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = parquet(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity"))).alias("item"))
    df = items.select(F.col("l_orderkey").alias("orderkey"), "item")
    return read_xml(spark, stored(spark, df, "items", rowTag="order"), df.schema, rowTag="order")


@register("SELECT l_orderkey AS orderkey, count(*)::INT AS n, sum(l_quantity)::DOUBLE AS qty FROM lineitem GROUP BY 1")
def scan_array_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders_with_items(spark, sf_dir)
    return rows.select("orderkey", F.size("item").alias("n"), F.aggregate("item", F.lit(0.0), lambda a, x: a + x["l_quantity"]).alias("qty"))


@register("SELECT l_orderkey AS orderkey, l_linenumber, l_quantity FROM lineitem")
def explode_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_with_items(spark, sf_dir).selectExpr("orderkey", "inline(item)")


@register("SELECT n_nationkey AS id, n_name AS name, n_regionkey AS region FROM nation")
def scan_map_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "nation").selectExpr("n_nationkey AS id", "map('_region', CAST(n_regionkey AS STRING), 'name', n_name) AS m")
    rows = read_xml(spark, stored(spark, df, "map"), df.schema, rowTag="row")
    return rows.selectExpr("id", "m['name'] AS name", "CAST(m['_region'] AS INT) AS region")


@register("SELECT vec_id, label, len(embedding)::INT AS n, embedding[1] AS first, embedding[len(embedding)] AS last FROM embeddings")
def scan_embeddings_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = over_xml(spark, sf_dir, "embeddings")
    return rows.select("vec_id", "label", F.size("embedding").alias("n"), F.element_at("embedding", 1).alias("first"), F.element_at("embedding", -1).alias("last"))


@register("SELECT n_name AS name, [n_nationkey, n_regionkey]::BIGINT[] AS keys FROM nation")
def array_element_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "nation").selectExpr("n_name AS name", "array(array(CAST(n_nationkey AS BIGINT), CAST(n_regionkey AS BIGINT))) AS a")
    path = stored(spark, df, "element", arrayElementName="key")
    rows = read_xml(spark, path, "name string, a array<struct<key: array<bigint>>>", rowTag="row")
    return rows.selectExpr("name", "a[0].key AS keys")


@register("SELECT count(*) AS n, true AS has_root FROM nation")
def root_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stored(spark, parquet(spark, sf_dir, "nation").coalesce(1), "root", rootTag="nations version='1' kind='all'")
    whole = spark.read.text(path, wholetext=True)
    rows = read_xml(spark, path, "n_name string", rowTag="row")
    return rows.agg(F.count("n_name").alias("n")).crossJoin(whole.agg(F.max(F.col("value").contains('<nations version="1" kind="all">')).alias("has_root")))


@register("SELECT 2 * count(*) AS n FROM nation")
def save_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "nation")
    path = stored(spark, df, "modes")
    for mode in ("ignore", "overwrite", "append"):
        write_xml(df, path, mode, rowTag="row")
    return read_xml(spark, path, df.schema, rowTag="row").agg(F.count("n_name").alias("n"))


@register("SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1")
def sql_ddl_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stored(spark, parquet(spark, sf_dir, "nation"), "ddl")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW tagloom_nation (n_regionkey INT, n_name STRING) USING xml OPTIONS (path '{path}', rowTag 'row')")
    return spark.sql("SELECT n_regionkey, count(n_name) AS n FROM tagloom_nation GROUP BY n_regionkey")


def _compressed(codec: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = parquet(spark, sf_dir, "customer")
        return read_xml(spark, stored(spark, df, codec, codec=codec), df.schema, rowTag="row").groupBy("c_mktsegment").agg(F.count("c_custkey").alias("n"))

    return query


for _codec in ("gzip", "bzip2", "deflate"):
    register("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1", f"record_{_codec}")(_compressed(_codec))

# ---------------------------------------------------------------- projection and options


@register("SELECT o_orderkey, o_orderstatus FROM orders")
def column_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return over_xml(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")


@register("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'")
def filter_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return over_xml(spark, sf_dir, "orders").where("o_totalprice > 100000 AND o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")


@register("SELECT n_nationkey, n_name AS xs_any FROM nation")
def wildcard_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return read_xml(spark, stored(spark, df, "wild"), "n_nationkey int, xs_any string", rowTag="row")


@register("SELECT n_nationkey, 2 AS n FROM nation")
def wildcard_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_xml(spark, stored(spark, parquet(spark, sf_dir, "nation"), "wild"), "n_nationkey int, xs_any array<string>", rowTag="row")
    return rows.select("n_nationkey", F.size("xs_any").alias("n"))


@register("SELECT n_name AS name FROM nation")
def exclude_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "nation").selectExpr("n_nationkey AS _id", "n_name AS name")
    return read_xml(spark, stored(spark, df, "exclude"), rowTag="row", excludeAttribute=True)


@register("SELECT n_nationkey AS id, n_name AS name FROM nation")
def ignore_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = parquet(spark, sf_dir, "nation").selectExpr("format_string('<row><x:id>%d</x:id><y:name>%s</y:name></row>', n_nationkey, n_name)")
    return read_xml(spark, texts(spark, lines, "namespace"), "id int, name string", rowTag="row", ignoreNamespace=True)


@register("SELECT o_orderkey, nullif(o_orderstatus, 'F') AS o_orderstatus FROM orders")
def null_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return read_xml(spark, stored(spark, df, "nulls"), df.schema, rowTag="row", nullValue="F")


@register("SELECT n_nationkey, CASE WHEN n_nationkey % 3 <> 0 THEN n_name END AS n_name, CASE WHEN n_nationkey % 2 <> 0 THEN n_regionkey END AS n_regionkey FROM nation")
def treat_empty_as_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = parquet(spark, sf_dir, "nation").selectExpr("format_string('<row><n_nationkey>%d</n_nationkey><n_name>%s</n_name><n_regionkey>%s</n_regionkey></row>', n_nationkey, if(n_nationkey % 3 = 0, '', n_name), if(n_nationkey % 2 = 0, '  ', string(n_regionkey)))")
    return read_xml(spark, texts(spark, lines, "empty"), "n_nationkey int, n_name string, n_regionkey int", rowTag="row", treatEmptyValuesAsNulls=True)


@register("SELECT n_nationkey, n_name, '  ' || n_name || ' ' AS kept FROM nation")
def ignore_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = parquet(spark, sf_dir, "nation").selectExpr("format_string('<row><n_nationkey> %d </n_nationkey><n_name>  %s </n_name></row>', n_nationkey, n_name)")
    path = texts(spark, lines, "spaces")
    trimmed = read_xml(spark, path, "n_nationkey int, n_name string", rowTag="row", ignoreSurroundingSpaces=True)
    kept = read_xml(spark, path, "n_nationkey string, n_name string", rowTag="row")
    return trimmed.join(kept.selectExpr("int(trim(n_nationkey)) AS n_nationkey", "n_name AS kept"), "n_nationkey")


# ---------------------------------------------------------------- malformed records


def _broken(spark: SparkSession, sf_dir: str) -> str:
    """Orders as record texts; every tenth is cut in the middle, every seventh has a word for a number."""
    lines = parquet(spark, sf_dir, "orders").selectExpr(
        "CASE WHEN o_orderkey % 10 = 0 THEN format_string('<row><k>%d</k><p></row>', o_orderkey) "
        "ELSE format_string('<row><k>%d</k><p>%s</p><s>%s</s></row>', o_orderkey, if(o_orderkey % 7 = 0, 'zz', string(o_custkey)), o_orderstatus) END"
    )
    return texts(spark, lines, "broken")


@register("SELECT CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey END AS k, CASE WHEN o_orderkey % 10 <> 0 AND o_orderkey % 7 <> 0 THEN o_custkey END AS p, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderstatus END AS s FROM orders")
def mode_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_xml(spark, _broken(spark, sf_dir), "k bigint, p bigint, s string", rowTag="row")


@register("SELECT o_orderkey AS k, o_custkey AS p, o_orderstatus AS s FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 7 <> 0")
def mode_dropmalformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_xml(spark, _broken(spark, sf_dir), "k bigint, p bigint, s string", rowTag="row", mode="DROPMALFORMED")


@register("SELECT CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey END AS k, CASE WHEN o_orderkey % 10 <> 0 AND o_orderkey % 7 <> 0 THEN o_custkey END AS p, CASE WHEN o_orderkey % 10 = 0 THEN '<row><k>' || o_orderkey || '</k><p></row>' WHEN o_orderkey % 7 = 0 THEN '<row><k>' || o_orderkey || '</k><p>zz</p><s>' || o_orderstatus || '</s></row>' END AS bad FROM orders")
def mode_corrupt_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_xml(spark, _broken(spark, sf_dir), "k bigint, p bigint, bad string", rowTag="row", columnNameOfCorruptRecord="bad")


@register("SELECT o_orderkey AS k, o_custkey AS p, o_orderstatus AS s FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 7 <> 0")
def split_dropmalformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_xml(spark, _broken(spark, sf_dir), "k bigint, p bigint, s string", engine="split", rowTag="row", mode="DROPMALFORMED")


@register("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS v, CASE WHEN o_orderkey % 5 = 0 THEN [1, 2]::BIGINT[] ELSE [1, 7, 2]::BIGINT[] END AS a, o_orderstatus AS z FROM orders")
def partial_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = parquet(spark, sf_dir, "orders").selectExpr("format_string('<row><k>%d</k><n><v>%s</v></n><a>1</a><a>%s</a><a>2</a><z>%s</z></row>', o_orderkey, if(o_orderkey % 7 = 0, 'zz', string(o_custkey)), if(o_orderkey % 5 = 0, 'zz', '7'), o_orderstatus)")
    rows = read_xml(spark, texts(spark, lines, "partial"), "k bigint, n struct<v: bigint>, a array<bigint>, z string", rowTag="row")
    return rows.selectExpr("k", "n.v AS v", "a", "z")


@register("SELECT count(*) AS n FROM orders")
def failfast_count_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "orders")
    return read_xml(spark, stored(spark, df, "failfast"), df.schema, rowTag="row", mode="FAILFAST").agg(F.count("o_orderkey").alias("n"))


@register("SELECT count(*) AS n FROM pages")
def html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = parquet(spark, sf_dir, "pages").select(from_xml("html", "body string, _corrupt_record string").alias("x"))
    return pages.agg(F.count("x._corrupt_record").alias("n"))


# ---------------------------------------------------------------- schemas


def _fields(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields], "name string, type string")


@register("SELECT * FROM (VALUES ('o_custkey', 'bigint'), ('o_orderdate', 'timestamp'), ('o_orderkey', 'bigint'), ('o_orderpriority', 'string'), ('o_orderstatus', 'string'), ('o_totalprice', 'double')) t(name, type)")
def infer_schema_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fields(spark, infer_schema(spark, stored(spark, parquet(spark, sf_dir, "orders"), "infer"), rowTag="row"))


@register("SELECT * FROM (VALUES ('n_name', 'string'), ('n_nationkey', 'string'), ('n_regionkey', 'string')) t(name, type)")
def infer_all_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fields(spark, infer_schema(spark, stored(spark, parquet(spark, sf_dir, "nation"), "infer"), rowTag="row", inferSchema=False))


@register("SELECT * FROM (VALUES ('l_quantity', 'double'), ('l_shipdate', 'timestamp')) t(name, type)")
def infer_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "lineitem").select("l_quantity", "l_shipdate")
    return _fields(spark, infer_schema(spark, stored(spark, df, "sample"), rowTag="row", samplingRatio=0.5))


@register("SELECT * FROM (VALUES ('k', 'bigint'), ('p', 'string'), ('s', 'string')) t(name, type)")
def infer_failfast_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fields(spark, infer_schema(spark, _broken(spark, sf_dir), rowTag="row", mode="FAILFAST"))


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parquet(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", to_xml(F.struct(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("p"), F.col("o_orderstatus").alias("s")), {"rowTag": "o"}).alias("payload"))


@register("SELECT * FROM (VALUES ('k', 'bigint'), ('p', 'double'), ('s', 'string')) t(name, type)", "schema_of_xml")
def _schema_of_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fields(spark, schema_of_xml(_payloads(spark, sf_dir), "payload", rowTag="o"))


@register("SELECT * FROM (VALUES ('k', 'bigint'), ('p', 'double'), ('s', 'string')) t(name, type)", "schema_of_xml_array")
def _schema_of_xml_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrays = _payloads(spark, sf_dir).groupBy("o_custkey").agg(F.collect_list("payload").alias("payloads"))
    return _fields(spark, schema_of_xml_array(arrays, "payloads", rowTag="o").elementType)


# ---------------------------------------------------------------- column functions


@register("SELECT o_orderkey AS k, o_totalprice AS p, o_orderstatus AS s FROM orders")
def from_xml_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _payloads(spark, sf_dir).select(from_xml("payload", "k bigint, p double, s string", {"rowTag": "o"}).alias("x")).select("x.*")


@register("SELECT o_custkey, count(*)::INT AS n, max(o_orderkey) AS k FROM orders GROUP BY 1")
def from_xml_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrays = _payloads(spark, sf_dir).groupBy("o_custkey").agg(F.collect_list("payload").alias("payloads"))
    rows = arrays.select("o_custkey", from_xml("payloads", "array<struct<k: bigint, p: double>>", {"rowTag": "o"}).alias("xs"))
    return rows.select("o_custkey", F.size("xs").alias("n"), F.array_max(F.transform("xs", lambda x: x["k"])).alias("k"))


@register("SELECT o_orderkey, o_orderkey % 10 <> 0 AND o_orderkey % 7 <> 0 AS ok FROM orders")
def from_xml_null_on_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parquet(spark, sf_dir, "orders").selectExpr("o_orderkey", "CASE WHEN o_orderkey % 10 = 0 THEN '<o><k>' WHEN o_orderkey % 7 = 0 THEN '<o><k>zz</k></o>' ELSE '<o><k>1</k></o>' END AS payload")
    parsed = from_xml("payload", "k int", {"rowTag": "o", "mode": "DROPMALFORMED"})
    return rows.select("o_orderkey", parsed.isNotNull().alias("ok"))


@register("SELECT n_nationkey, '<n id=\"' || n_nationkey || '\">' || chr(10) || '    <name>' || n_name || '</name>' || chr(10) || '</n>' AS xml FROM nation")
def to_xml_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "nation")
    return df.select("n_nationkey", to_xml(F.struct(F.col("n_nationkey").alias("_id"), F.col("n_name").alias("name")), {"rowTag": "n"}).alias("xml"))


@register("SELECT o_orderkey, o_totalprice AS p, o_orderstatus AS s FROM orders")
def xpath_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = lambda x: F.lit(f"o/{x}")
    return _payloads(spark, sf_dir).select("o_orderkey", F.xpath_double("payload", path("p")).alias("p"), F.xpath_string("payload", path("s")).alias("s"))


@register("SELECT l_orderkey, l_linenumber, l_shipdate AS spaced, l_shipdate - INTERVAL 5 HOUR AS offset_, l_shipdate AS custom FROM lineitem")
def cast_timestamp_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parquet(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    form = lambda x: F.date_format("l_shipdate", x)
    options = XmlOptions(timestamp_format="dd/MM/yyyy HH:mm:ss", timezone="UTC")
    plain = lambda x, o=None: casts.cast_to(x, T.TimestampType(), o).cast("timestamp_ntz")
    return rows.select("l_orderkey", "l_linenumber", plain(form("yyyy-MM-dd HH:mm:ss")).alias("spaced"), plain(F.concat(form("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:00"))).alias("offset_"), plain(form("dd/MM/yyyy HH:mm:ss"), options).alias("custom"))


@register("SELECT o_orderkey, o_orderdate::DATE AS iso, o_orderdate::DATE AS with_offset, o_orderdate::DATE AS custom FROM orders")
def cast_date_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = lambda form, suffix="": F.concat(F.date_format("o_orderdate", form), F.lit(suffix))
    cast = lambda x, o=None: casts.cast_to(x, T.DateType(), o)
    return parquet(spark, sf_dir, "orders").select("o_orderkey", cast(day("yyyy-MM-dd")).alias("iso"), cast(day("yyyy-MM-dd", "+06:00")).alias("with_offset"), cast(day("dd.MM.yyyy"), XmlOptions(date_format="dd.MM.yyyy")).alias("custom"))


@register("SELECT p_partkey, p_retailprice::DECIMAL(12, 2) AS price FROM part")
def cast_decimal_commas(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.format_number(F.col("p_retailprice").cast("decimal(12,2)"), 2)
    return parquet(spark, sf_dir, "part").select("p_partkey", casts.cast_to(text, T.DecimalType(12, 2)).alias("price"))


@register("SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false END AS flag FROM orders")
def cast_boolean_01(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.element_at(F.array(*map(F.lit, ("1", "0", "TRUE", "False", "yes"))), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return parquet(spark, sf_dir, "orders").select("o_orderkey", casts.cast_to(text, T.BooleanType()).alias("flag"))


@register("SELECT o_orderkey, o_orderkey AS plus, -o_orderkey AS minus, CASE WHEN o_orderkey <= 127 THEN o_orderkey::TINYINT END AS small, o_totalprice AS price FROM orders")
def cast_signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    cast = lambda x, k: casts.cast_to(x, k)
    return parquet(spark, sf_dir, "orders").select("o_orderkey", cast(F.concat(F.lit("+"), key), T.LongType()).alias("plus"), cast(F.concat(F.lit("-"), key), T.LongType()).alias("minus"), cast(key, T.ByteType()).alias("small"), cast(F.col("o_totalprice").cast("string"), T.DoubleType()).alias("price"))


@register("SELECT * FROM (VALUES ('boolean', false, false, true, false), ('date', false, false, false, false), ('double', false, true, false, false), ('long', true, true, false, false), ('string', false, false, false, false), ('timestamp', false, false, false, true)) t(kind, is_long, is_double, is_boolean, is_timestamp)")
def type_testers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([("long", "+12"), ("double", "1.5e3"), ("boolean", "True"), ("date", "2020-01-01"), ("timestamp", "2020-01-01T10:00:00Z"), ("string", "1.5d")], "kind string, x string")
    x = F.col("x")
    flag = lambda c: F.coalesce(c, F.lit(False))
    return rows.select("kind", flag(casts.is_long(x)).alias("is_long"), flag(casts.is_double(x)).alias("is_double"), flag(casts.is_boolean(x)).alias("is_boolean"), flag(casts.is_timestamp(x)).alias("is_timestamp"))


# ---------------------------------------------------------------- XSD

_NATION_XSD = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">
  <xs:element name="row"><xs:complexType><xs:sequence>
    <xs:element name="n_nationkey" type="xs:integer"/>
    <xs:element name="n_name" type="xs:string"/>
    <xs:element name="n_regionkey"><xs:simpleType><xs:restriction base="xs:int"><xs:maxInclusive value="2"/></xs:restriction></xs:simpleType></xs:element>
    <xs:element name="note" type="xs:decimal" minOccurs="0" maxOccurs="unbounded"/>
  </xs:sequence><xs:attribute name="id" type="xs:long"/></xs:complexType></xs:element>
</xs:schema>"""


@register("SELECT * FROM (VALUES ('n_nationkey', 'int', false), ('n_name', 'string', false), ('n_regionkey', 'int', false), ('note', 'array<decimal(38,18)>', true), ('_id', 'bigint', true)) t(name, type, nullable)")
def xsd_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = xsd.schema_of_xsd(_NATION_XSD).fields[0].dataType
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable) for f in row.fields], "name string, type string, nullable boolean")


def nation_xsd(spark: SparkSession) -> str:
    """The name of the schema among the files that all tasks get."""
    import tempfile
    from pathlib import Path

    name = f"tagloom-nation-{spark.sparkContext.applicationId}.xsd"
    if name not in {Path(x).name for x in spark.sparkContext.listFiles}:
        place = Path(tempfile.gettempdir()) / name
        place.write_text(_NATION_XSD)
        spark.sparkContext.addFile(str(place))
    return name


@register("SELECT * FROM nation WHERE n_regionkey <= 2")
def xsd_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parquet(spark, sf_dir, "nation")
    return read_xml(spark, stored(spark, df, "xsd"), df.schema, rowTag="row", rowValidationXSDPath=nation_xsd(spark), mode="DROPMALFORMED")


# ---------------------------------------------------------------- raw records


@register("SELECT count(*) AS n FROM lineitem")
def record_split_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stored(spark, parquet(spark, sf_dir, "lineitem"), "records")
    return xml_records(spark, path, "row", "split").agg(F.count("xml").alias("n"))


@register("SELECT n_nationkey AS k, n_name AS inner_name FROM nation")
def record_nested_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = parquet(spark, sf_dir, "nation").selectExpr("format_string('<row><k>%d</k><row><name>%s</name></row></row>', n_nationkey, n_name)")
    records = xml_records(spark, texts(spark, lines, "same"), "row")
    return records.select(from_xml("xml", "k int, row struct<name: string>", {"rowTag": "row"}).alias("x")).selectExpr("x.k AS k", "x.row.name AS inner_name")


# ---------------------------------------------------------------- Spark SQL over XML scans


def _sql(text: str, *tables: str, name: str, oracle: str | None = None) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(text, **{t: over_xml(spark, sf_dir, t) for t in tables})

    register(oracle or text.replace("{", "").replace("}", ""), name)(query)


_sql("SELECT o_orderkey, c_name, o_totalprice FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE o_totalprice > 150000", "orders", "customer", name="join_inner")
_sql("SELECT c_custkey, count(o_orderkey) AS n FROM {customer} LEFT JOIN {orders} ON c_custkey = o_custkey GROUP BY c_custkey", "orders", "customer", name="join_left")
_sql("SELECT c_custkey, c_name FROM {customer} LEFT SEMI JOIN {orders} ON c_custkey = o_custkey", "orders", "customer", name="join_semi", oracle="SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
_sql("SELECT c_custkey, c_name FROM {customer} LEFT ANTI JOIN {orders} ON c_custkey = o_custkey AND o_totalprice > 400000", "orders", "customer", name="join_anti", oracle="SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
_sql("SELECT c_custkey, n_name, r_name FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey", "customer", "nation", "region", name="join_broadcast")
_sql("SELECT o_orderstatus, o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS customers, round(avg(o_totalprice), 4) AS mean FROM {orders} GROUP BY o_orderstatus, o_orderpriority", "orders", name="agg_groupby")
_sql("SELECT count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM {lineitem}", "lineitem", name="agg_distinct")
_sql("SELECT l_returnflag, l_linestatus, count(*) AS n FROM {lineitem} GROUP BY ROLLUP (l_returnflag, l_linestatus)", "lineitem", name="agg_rollup")
_sql("SELECT l_returnflag, l_linestatus, count(*) AS n FROM {lineitem} GROUP BY CUBE (l_returnflag, l_linestatus)", "lineitem", name="agg_cube")
_sql("SELECT p_brand, p_size, count(*) AS n FROM {part} GROUP BY GROUPING SETS ((p_brand), (p_size), ())", "part", name="agg_grouping_sets")
_sql("SELECT c_custkey, c_nationkey, rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey)::INT AS place FROM {customer}", "customer", name="window_rank")
_sql("SELECT user_id, event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 4) AS running FROM {events}", "events", name="window_running_sum")
_sql("SELECT event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM {events}", "events", name="window_lag")
_sql("SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 20", "orders", name="sort_limit_topk")
_sql("SELECT c_nationkey AS k FROM {customer} UNION SELECT s_nationkey FROM {supplier}", "customer", "supplier", name="set_union")
_sql("SELECT c_nationkey AS k FROM {customer} INTERSECT SELECT s_nationkey FROM {supplier}", "customer", "supplier", name="set_intersect")
_sql("SELECT o_custkey AS k FROM {orders} EXCEPT SELECT c_custkey FROM {customer} WHERE c_acctbal < 0", "orders", "customer", name="set_except")
_sql("WITH big AS (SELECT o_custkey, sum(o_totalprice) AS total FROM {orders} GROUP BY o_custkey) SELECT c_name, round(total, 2) AS total FROM big JOIN {customer} ON o_custkey = c_custkey WHERE total > (SELECT avg(total) FROM big)", "orders", "customer", name="cte_subquery")


@register("SELECT p.p_partkey, q.p_partkey AS other FROM part p JOIN part q ON p.p_retailprice BETWEEN q.p_retailprice - 0.5 AND q.p_retailprice + 0.5 AND p.p_partkey < q.p_partkey")
def join_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = over_xml(spark, sf_dir, "part", ["p_partkey", "p_retailprice"])
    other = rows.selectExpr("p_partkey AS other", "p_retailprice - 0.5 AS low", "p_retailprice + 0.5 AS high")
    return range_join(rows, other, F.col("p_retailprice"), F.col("low"), F.col("high"), 1.0).where("p_partkey < other").select("p_partkey", "other")


@register("SELECT e.event_id, p.ts AS bought FROM (SELECT * FROM events WHERE event_type <> 'purchase') e ASOF LEFT JOIN (SELECT user_id, ts FROM events WHERE event_type = 'purchase') p ON e.user_id = p.user_id AND e.ts >= p.ts")
def join_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = over_xml(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    bought = rows.where("event_type = 'purchase'").selectExpr("user_id", "ts AS bought")
    return asof_join(rows.where("event_type <> 'purchase'"), bought, "ts", "bought", ["user_id"], ["bought"]).select("event_id", "bought")


from tagloom.plans import relational, shapes  # noqa: E402, F401  these register further queries


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
