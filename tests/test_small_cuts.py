import os
import uuid

import duckdb
import pytest

import __spark_entry__ as entry
from tagloom.plans.shapes import TASKS
from tagloom.sources.records import nested_records

SF = "/root/testdata/sf0.01"
NAMES = ["corrupt_text_in_tasks", "empty_records_in_tasks", "nested_in_tasks", "bzip2_in_tasks"]


def most_tasks(spark, action):
    """The result of ``action`` and the most tasks of one of its stages."""
    context, group = spark.sparkContext, uuid.uuid4().hex
    context.setJobGroup(group, "")
    try:
        result = action()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return result, max(s.numTasks for s in stages if s)


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
@pytest.mark.parametrize("name", NAMES)
def test_tasks_share_the_cuts_of_a_large_file(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW orders AS SELECT * FROM '{SF}/orders.parquet'")
    got, tasks = most_tasks(spark, lambda: (lambda df: (df.columns, df.collect()))(entry.queries()[name](spark, SF)))
    want = con.sql(f"SELECT {', '.join(got[0])} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got[1])
    assert 1 < tasks <= 1.25 * TASKS  # the files have hundreds of cuts
    assert spark.conf.get("spark.sql.files.maxPartitionNum", None) is None


def test_nested_records_are_scanned_once(spark, tmp_path):
    (tmp_path / "in.xml").write_text("<rows><row><row>1</row></row><row>2</row></rows>")
    got = nested_records(spark, [str(tmp_path / "in.xml")], "row")
    assert sorted(r["xml"] for r in got.collect()) == ["<row>2</row>", "<row><row>1</row></row>"]
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan text") == 1
