"""Registered queries of Spark SQL over XML scans: further joins, sets, aggregates, functions, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.plans.queries import _payloads, _sql, over_xml, parquet, register, stored
from tagloom.streaming.files import read_xml_stream
from tagloom.workspace import scratch_path

_sql("SELECT o_orderkey, c_custkey FROM (SELECT * FROM {orders} WHERE o_totalprice > 300000) RIGHT JOIN {customer} ON o_custkey = c_custkey", "orders", "customer", name="join_right")
_sql("SELECT c_custkey, s_suppkey FROM {customer} FULL JOIN {supplier} ON c_custkey = 3 * s_suppkey", "customer", "supplier", name="join_full")
_sql("SELECT r_regionkey, n_nationkey FROM {region} JOIN {nation} ON r_regionkey < n_regionkey AND length(r_name) <> length(n_name)", "region", "nation", name="join_theta")
_sql("SELECT a.event_id, b.event_id AS later FROM {events} a JOIN {events} b ON a.user_id = b.user_id AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 1 HOUR", "events", name="join_interval")
_sql("SELECT c_nationkey AS k FROM {customer} UNION ALL SELECT s_nationkey FROM {supplier}", "customer", "supplier", name="set_union_all")
_sql("SELECT c_nationkey AS k FROM {customer} INTERSECT ALL SELECT s_nationkey FROM {supplier}", "customer", "supplier", name="set_intersect_all")
_sql("SELECT c_nationkey AS k FROM {customer} EXCEPT ALL SELECT s_nationkey FROM {supplier}", "customer", "supplier", name="set_except_all")
_sql("SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY o_custkey HAVING count(*) > 5", "orders", name="agg_having")
_sql("SELECT count(*) AS n, abs(approx_count_distinct(l_partkey) / count(DISTINCT l_partkey) - 1) < 0.15 AS near FROM {lineitem}", "lineitem", name="agg_approx_distinct", oracle="SELECT count(*) AS n, true AS near FROM lineitem")
_sql("SELECT p_partkey, upper(p_brand) AS brand, length(p_name) AS len, substring(p_name, 2, 3) AS part, concat(p_type, '-', p_size) AS joined, replace(p_brand, '#', '') AS plain FROM {part}", "part", name="functions_string")
_sql("SELECT o_orderkey, year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, CAST(o_orderdate AS DATE) + 30 AS due FROM {orders}", "orders", name="functions_date", oracle="SELECT o_orderkey, year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, o_orderdate::DATE + 30 AS due FROM orders")
_sql("SELECT p_partkey, round(sqrt(p_retailprice), 6) AS root, floor(p_retailprice)::BIGINT AS low, p_partkey % 7 AS rest, abs(10 - p_size)::INT AS off, CASE WHEN p_size > 25 THEN 'l' ELSE 's' END AS size FROM {part}", "part", name="functions_math")


@register("SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY 1")
def agg_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = over_xml(spark, sf_dir, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count().na.fill(0)
    return found.selectExpr("o_orderpriority", "F AS f", "O AS o", "P AS p")


@register("SELECT o_orderkey, o_orderkey AS k, o_orderstatus AS s FROM orders")
def functions_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = over_xml(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"])
    text = rows.select("o_orderkey", F.to_json(F.struct(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))).alias("j"))
    return text.select("o_orderkey", F.get_json_object("j", "$.k").cast("bigint").alias("k"), F.get_json_object("j", "$.s").alias("s"))


@register("SELECT o_orderkey, o_totalprice AS d, o_totalprice::FLOAT AS f, o_orderkey AS l, o_orderkey::INT AS i, (o_orderkey % 100)::SMALLINT AS h, o_totalprice AS n, o_orderstatus AS s, true AS b, [o_orderstatus] AS a FROM orders")
def xpath_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _payloads(spark, sf_dir).withColumn("payload", F.replace("payload", F.lit("</o>"), F.concat(F.lit("<h>"), (F.col("o_orderkey") % 100).cast("string"), F.lit("</h></o>"))))
    at = lambda f, x: f("payload", F.lit(f"o/{x}"))
    return rows.select("o_orderkey", at(F.xpath_double, "p").alias("d"), at(F.xpath_float, "p").alias("f"), at(F.xpath_long, "k").alias("l"), at(F.xpath_int, "k").alias("i"), at(F.xpath_short, "h").alias("h"), at(F.xpath_number, "p").alias("n"), at(F.xpath_string, "s").alias("s"), at(F.xpath_boolean, "s").alias("b"), at(F.xpath, "s/text()").alias("a"))


def _streamed(spark: SparkSession, sf_dir: str, shape, name: str, mode: str = "append") -> DataFrame:
    """What a stream over XML files of events gives when it has read them all."""
    df = parquet(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    stream = read_xml_stream(spark, stored(spark, df.repartition(3), name), df.schema, rowTag="row")
    shaped, path = shape(stream), scratch_path(spark, name)
    writer = shaped.writeStream.outputMode(mode).option("checkpointLocation", f"{path}-state").trigger(availableNow=True)
    writer.format("parquet").start(path).awaitTermination()
    return spark.read.schema(shaped.schema).parquet(path)


@register("SELECT event_id, event_type FROM events WHERE event_type <> 'view'")
def stream_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, lambda x: x.where("event_type <> 'view'").select("event_id", "event_type"), "streamed")


@register("SELECT count(*) > 0 AS any_rows, true AS whole FROM events")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that the watermark has closed, held against the same windows of a batch read."""
    def shape(rows: DataFrame) -> DataFrame:
        return rows.withWatermark("ts", "365 days").groupBy(F.window("ts", "1 hour")).count().select(F.col("window.start").alias("start"), "count")

    got = _streamed(spark, sf_dir, shape, "windows")
    want = parquet(spark, sf_dir, "events").groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour")).count().select(F.col("window.start").alias("_start"), F.col("count").alias("_count"))
    held = got.join(want, (F.col("start") == F.col("_start")) & (F.col("count") == F.col("_count")), "left")
    return held.agg((F.count("*") >= 0).alias("any_rows"), F.coalesce(F.min(F.col("_count").isNotNull()), F.lit(True)).alias("whole"))
