"""Times the headline queries and prints one JSON line.

XML files are written once, before the clock runs; a query's time is the median of three runs.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tagloom.shipping import ship
from tagloom.sources.reader import infer_schema, read_xml
from tagloom.sources.writer import write_xml

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tagloom-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(queries: dict) -> dict[str, float]:
    times = {}
    for name, query in queries.items():
        runs = []
        for _ in range(RUNS):
            start = time.time()
            query()
            runs.append(time.time() - start)
        times[name] = round(statistics.median(runs), 3)
    return times


def main() -> None:
    spark = session()
    ship(spark)
    folder = tempfile.mkdtemp(prefix="tagloom-bench-xml-")
    table = lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    lineitem, orders = table("lineitem"), table("orders")
    write_xml(lineitem.coalesce(1), f"{folder}/one", rowTag="row")
    write_xml(lineitem.repartition(int(CPUS)), f"{folder}/many", rowTag="row")
    write_xml(orders.repartition(int(CPUS)), f"{folder}/orders", rowTag="row")

    def by_flag(path: str, engine: str):
        rows = read_xml(spark, f"{folder}/{path}", lineitem.schema, engine=engine, rowTag="row", timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return rows.groupBy("l_returnflag").agg(F.count("*"), F.sum("l_quantity")).collect()

    def joined():
        items = read_xml(spark, f"{folder}/many", lineitem.schema, rowTag="row").select("l_orderkey", "l_quantity")
        heads = read_xml(spark, f"{folder}/orders", orders.schema, rowTag="row").select("o_orderkey", "o_orderstatus")
        return items.join(heads, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderstatus").agg(F.sum("l_quantity")).collect()

    queries = {
        "write_one_file": lambda: write_xml(lineitem.coalesce(1), f"{folder}/out", "overwrite", rowTag="row"),
        "scan_one_file_stream": lambda: by_flag("one", "stream"),
        "scan_one_file_auto": lambda: by_flag("one", "auto"),
        "scan_one_file_split": lambda: by_flag("one", "split"),
        "scan_many_files_auto": lambda: by_flag("many", "auto"),
        "infer_schema": lambda: infer_schema(spark, f"{folder}/many", rowTag="row"),
        "join_two_scans": joined,
    }
    def native(reader):
        return reader.groupBy("l_returnflag").agg(F.count("*"), F.sum("l_quantity")).collect()

    plain = {"rowTag": "row", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    scan = lambda **o: spark.read.format("xml").options(**plain, **o).schema(lineitem.schema).load(f"{folder}/one")
    # Spark's own readers, timed in the same run: what the scans above are held against
    yardsticks = {
        "native_write_one_file": lambda: lineitem.coalesce(1).write.format("xml").option("rowTag", "row").mode("overwrite").save(f"{folder}/native"),
        "native_default_parser": lambda: native(scan()),
        "native_record_parser": lambda: native(scan(useLegacyXMLParser="true")),
        "native_infer_schema": lambda: spark.read.format("xml").options(**plain, useLegacyXMLParser="true").load(f"{folder}/many").schema,
    }
    times, own = timed(queries), timed(yardsticks)
    print(json.dumps({"metric": "xml_headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "yardsticks": own, "sf": SF_DIR.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
