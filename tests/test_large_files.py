import bz2
import glob

from tagloom.plans import shapes


def test_empty_records_are_written_by_several_tasks_and_read_once(spark, tmp_path, monkeypatch):
    orders = spark.range(0, 40, 1, 4).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "'F' AS o_orderstatus")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    written, texts = [], shapes.texts
    monkeypatch.setattr(shapes, "texts", lambda *a: written.append(texts(*a)) or written[-1])
    monkeypatch.setattr(shapes, "Pieces", None)  # nothing but the rows is read: the query returns no ``tasks``
    for most, files in ((10, 4), (100, 1)):
        monkeypatch.setattr(shapes, "FILE_ROWS", most, raising=False)
        rows = shapes.empty_records_in_tasks(spark, str(tmp_path)).collect()
        assert sorted(tuple(r) for r in rows) == [(i, i % 7, "F" if i % 3 == 0 else None) for i in range(40)]
        assert len(glob.glob(written[-1].removeprefix("file://") + "/part-*")) == files


def test_bzip2_files_are_packed_by_the_library_of_c(spark, tmp_path, monkeypatch):
    orders = spark.range(0, 400, 1, 4).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "'F' AS o_orderstatus")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    made, scratch_path = [], shapes.scratch_path
    monkeypatch.setattr(shapes, "scratch_path", lambda *a: made.append(scratch_path(*a)) or made[-1])
    for most, files in ((100, 4), (1000, 1)):
        monkeypatch.setattr(shapes, "BZIP2_ROWS", most)
        made.clear()
        rows = shapes.bzip2_in_tasks(spark, str(tmp_path)).select("id", "k").collect()
        assert sorted(tuple(r) for r in rows) == [(i, i % 7) for i in range(400)]
        packed = [open(x, "rb").read() for x in glob.glob(made[0].removeprefix("file://") + "/part-*.bz2")]
        texts = [bz2.decompress(x) for x in packed]
        assert packed == [bz2.compress(x) + bz2.compress(b"") for x in texts] and len(texts) == files
        assert sorted(x.split(b'"')[1] for x in b"".join(texts).splitlines()) == sorted(b"%d" % i for i in range(400))


def test_bzip2_texts_keep_odd_lines(spark):
    lines = ["", "<row>\u00e9</row>", None, "a" * 3_000_000, "\u20ac"]
    path = shapes.bzip2_texts(spark, spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1), "odd")
    assert [r["value"] for r in spark.read.text(path).collect()] == [x or "" for x in lines]
    none = shapes.bzip2_texts(spark, spark.createDataFrame([], "value string"), "none")
    assert spark.read.text(none).count() == 0
