import bz2
import datetime as dt
import gzip
import random
import re
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions import casts
from tagloom.functions.schema import schema_of_xml, schema_of_xml_array
from tagloom.functions.xml import from_xml, from_xml_string
from tagloom.functions.xsd import schema_of_xsd
from tagloom.operators.joins import asof_join
from tagloom.sources.options import XmlOptions
from tagloom.sources.reader import XmlReader, infer_schema, read_xml, xml_dataset, xml_file
from tagloom.sources.records import Pieces, xml_records
from tagloom.sources.writer import save_as_xml_file, write_xml
from tagloom.streaming.files import read_xml_stream

PEOPLE = """<people>
  <p id="1"><name>Ann</name><age born="1971-11-03">53</age><tag>a</tag><tag>b</tag></p>
  <p id="2"><name>Bob</name><age born="2004-07-19">21</age></p>
  <!-- a comment --><p id="3"><name><![CDATA[C <c>]]></name></p>
</people>"""
BROKEN = """<rows><row id="1"><a>1</a><b>x</b></row><row id="2"><a>zz</a><b>y</b></row>
<row id="3"><a>5</a><b></row><row id="x"><a>6</a><b>w</b></row><row id="5"><a>7</a><b>v</b></row></rows>"""


@pytest.fixture
def put(tmp_path):
    def write(text, name="in.xml", encoding="utf-8"):
        path = tmp_path / name
        path.write_bytes(text.encode(encoding))
        return str(path)

    return write


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_inferred_schema(spark, put):
    found = infer_schema(spark, put(PEOPLE), rowTag="p")
    assert found.simpleString() == "struct<_id:bigint,age:struct<_VALUE:bigint,_born:date>,name:string,tag:array<string>>"
    assert infer_schema(spark, put(PEOPLE), rowTag="p", excludeAttribute=True).simpleString() == "struct<age:bigint,name:string,tag:array<string>>"


def test_read_types(spark, put):
    got = read_xml(spark, put(PEOPLE), rowTag="p").orderBy("_id").collect()
    assert [r["name"] for r in got] == ["Ann", "Bob", "C <c>"]
    assert got[0]["age"]["_born"] == dt.date(1971, 11, 3) and got[0]["tag"] == ["a", "b"] and got[2]["age"] is None


def test_modes(spark, put):
    path, schema = put(BROKEN), "_id int, a int, b string"
    assert rows(read_xml(spark, path, schema, rowTag="row")) == [(1, 1, "x"), (2, None, "y"), (None, None, None), (None, None, None), (5, 7, "v")]
    assert rows(read_xml(spark, path, schema, rowTag="row", mode="DROPMALFORMED")) == [(1, 1, "x"), (5, 7, "v")]
    with pytest.raises(Exception, match="FAILFAST"):
        read_xml(spark, path, schema, rowTag="row", mode="FAILFAST").collect()
    kept = read_xml(spark, path, f"{schema}, _corrupt_record string", rowTag="row").collect()
    assert [r["_corrupt_record"] is None for r in kept] == [True, False, False, False, True]
    assert kept[1]["_corrupt_record"] == '<row id="2"><a>zz</a><b>y</b></row>' and kept[1]["b"] == "y"


def test_partial_results_by_shape(spark, put):
    text = "<r><row><s><x>1</x><y>q</y></s><n>3</n><a>1</a><a>z</a><a>2</a><m><k>1</k><l>z</l></m></row></r>"
    got = read_xml(spark, put(text), "s struct<x:int,y:int>, n int, a array<int>, m map<string,int>", rowTag="row").first()
    assert got["s"] is None and got["n"] == 3 and got["a"] == [1, 2] and got["m"] is None


def test_blank_and_empty_numbers(spark, put):
    path = put('<r><row a=" "><b> </b><c/></row></r>')
    schema = "b int, c int, _corrupt_record string"
    assert read_xml(spark, path, schema, rowTag="row").first()["_corrupt_record"] is not None
    assert rows(read_xml(spark, path, schema, rowTag="row", treatEmptyValuesAsNulls=True)) == [(None, None, None)]


def test_empty_file_missing_path_and_path_option(spark, put, tmp_path):
    assert read_xml(spark, put(""), "a int", rowTag="row").count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_xml(spark, str(tmp_path / "none.xml"), "a int", rowTag="row")
    with pytest.raises(ValueError, match="'path' must be specified"):
        read_xml(spark, "", "a int")


@pytest.mark.parametrize("bad", [{"rowTag": ""}, {"rowTag": "<a>"}, {"rootTag": "<a>"}, {"declaration": "<?x?>"}, {"valueTag": ""}, {"valueTag": "_", "attributePrefix": "_"}, {"samplingRatio": 0}])
def test_option_errors(bad):
    with pytest.raises(ValueError, match="requirement failed"):
        XmlOptions.of(**bad)


def test_option_spellings():
    assert XmlOptions.of(ROWTAG="a", row_tag=None).row_tag == "a"
    assert XmlOptions.of(codec="gzip").compression == "gzip"
    assert XmlOptions.of(codec="gzip", compression="bzip2").compression == "bzip2"
    with pytest.raises(LookupError):
        XmlOptions.of(charset="no-such-charset")


def test_charset_and_gzip(spark, put, tmp_path):
    assert rows(read_xml(spark, put("<r><row><a>é</a></row></r>", encoding="iso-8859-1"), "a string", rowTag="row", charset="iso-8859-1")) == [("é",)]
    (tmp_path / "z.xml.gz").write_bytes(gzip.compress(PEOPLE.encode()))
    assert read_xml(spark, str(tmp_path / "z.xml.gz"), "_id int", rowTag="p").agg(F.sum("_id")).first()[0] == 6


def test_same_named_child_and_self_closing(spark, put):
    text = "<r><row><row><c>1</c></row><d>2</d></row><row x='1'/></r>"
    for engine in ("auto", "records"):
        assert sorted(r[0] for r in xml_records(spark, put(text), "row", engine).collect()) == ["<row x='1'/>", "<row><row><c>1</c></row><d>2</d></row>"]
    assert rows(read_xml(spark, put(text), "row struct<c:int>, d int, _x int", rowTag="row")) == [((1,), 2, None), (None, None, 1)]


@pytest.mark.parametrize("size", [500, 8342])
def test_split_engine_keeps_every_record(spark, put, size):
    path = put("<r>\n" + "".join(f"<row><a>{i}</a><b>{'x' * (i % 40)}</b></row>\n" for i in range(740)) + "</r>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        df = read_xml(spark, path, "a int, b string", engine="split", rowTag="row")
        assert df.rdd.getNumPartitions() > 1
        assert df.agg(F.count("a"), F.sum("a")).first() == (740, 740 * 739 // 2)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.fixture
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "700")
    yield
    spark.conf.set(key, before)


def odd_records(n):
    """Records of all kinds: flat, with a child of their name, two deep, empty, with tags of like names."""
    kinds = [
        "<row><a>{0}</a><b>x</b></row>",
        "<row><row><a>7</a></row><a>{0}</a>" + "<b>" + "y" * 300 + "</b></row>",
        "<row id='>'><row z='/>'><row q='1'/><row><b>deep</b></row ></row><a>{0}</a></row >",
        "<row a='{0}' b=\"1/>2\"/>",
        "<row\n><rows>{0}</rows><rowset/><a>{0}</a></row>",
    ]
    return [kinds[i % 5].format(i) for i in range(n)]


@pytest.mark.parametrize("codec", ["", ".bz2", ".gz"])
def test_records_that_nest_their_own_name_are_read_by_many_tasks(spark, put, tmp_path, small_splits, codec):
    records = odd_records(400)
    text = "<?xml version='1.0'?>\n<rows><!-- -->\n" + "\n  ".join(records) + "\n</rows>\n"
    path = put(text)
    if codec:
        pack = {".bz2": bz2.compress, ".gz": gzip.compress}[codec]
        (tmp_path / f"in.xml{codec}").write_bytes(pack(text.encode()))
        path = f"{path}{codec}"
    got = xml_records(spark, path, "row")
    assert sorted(r["xml"] for r in got.collect()) == sorted(re.sub(r"</row\s+>", "</row>", x) for x in records)
    pieces = Pieces("row").read(spark, path)
    assert pieces.rdd.getNumPartitions() > 1 or codec == ".gz"
    df = read_xml(spark, path, "a int, _a int", rowTag="row")
    assert df.select(F.sum(F.coalesce("a", "_a"))).first()[0] == sum(range(400))


def test_flat_and_empty_records_in_many_tasks(spark, put, small_splits):
    text = "<rows>" + "".join(f"<row><a>{i}</a></row><row a='{i}'/>\n" for i in range(300)) + "</rows>"
    for engine in ("auto", "split"):
        df = read_xml(spark, put(text), "a int, _a int", engine=engine, rowTag="row")
        assert df.agg(F.sum("a"), F.sum("_a"), F.count("*")).first() == (44850, 44850, 600)
    got = read_xml(spark, put(text.replace("<a>7</a>", "<a>7</b>")), "a int, _a int, _corrupt_record string", rowTag="row")
    assert [r["_corrupt_record"] for r in got.where("_corrupt_record is not null").collect()] == ["<row><a>7</b></row>"]


def test_split_engine_refuses_what_it_cannot_read(spark, put):
    nested = put("<rows><row><row><a>1</a></row></row></rows>")
    with pytest.raises(Exception, match="flat records only"):
        read_xml(spark, nested, "a int", engine="split", rowTag="row").collect()
    with pytest.raises(ValueError, match="UTF-8"):
        read_xml(spark, nested, "a int", engine="split", rowTag="row", charset="iso-8859-1")


def test_a_record_that_the_file_cuts_off(spark, put, small_splits):
    text = "<rows>" + "".join(odd_records(50)) + "<row><a>1</a><b>"
    got = [r["xml"] for r in xml_records(spark, put(text), "row").collect()]
    assert len(got) == 51 and "<row><a>1</a><b>" in got


def test_lists_of_paths(spark, put):
    one, two = put("<r><row><a>1</a></row></r>", "a.xml"), put("<r><row><a>2</a></row></r>", "b.xml")
    for path in (f"{one},{two}", [one, two], one.replace("a.xml", "{a,b}.xml")):
        assert sorted(rows(read_xml(spark, path, "a int", rowTag="row"))) == [(1,), (2,)]
        assert infer_schema(spark, path, rowTag="row").simpleString() == "struct<a:bigint>"


def test_failfast_holds_whatever_is_read(spark, put):
    df = read_xml(spark, put("<r><row><a>1</a></row><row><a>z</a></row></r>"), "a int, b string", rowTag="row", mode="FAILFAST")
    for query in (df.count, df.select("b").collect, df.collect):
        with pytest.raises(Exception, match="FAILFAST"):
            query()


def test_session_time_zone(spark, put):
    path = put("<r><row><t>12/10/2017 07:21</t></row></r>")
    before = spark.conf.get("spark.sql.session.timeZone")
    read = lambda **o: read_xml(spark, path, "t timestamp", rowTag="row", timestampFormat="dd/MM/yyyy HH:mm", **o).select(F.unix_timestamp("t")).first()[0]
    utc = int(dt.datetime(2017, 10, 12, 7, 21, tzinfo=dt.timezone.utc).timestamp())
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert read() == utc - 7200 and read(timezone="UTC") == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert read() == utc


def test_twenty_readers_at_once(spark, put):
    texts = [put("<r>" + f"<t{i}><v{i}>{i}</v{i}></t{i}>" * 50 + "</r>", f"c{i}.xml") for i in range(20)]
    with ThreadPoolExecutor(20) as pool:
        found = list(pool.map(lambda i: read_xml(spark, texts[i], rowTag=f"t{i}").agg(F.sum(f"v{i}")).first()[0], range(20)))
    assert found == [50 * i for i in range(20)]


def test_mixed_content_is_no_data(spark, put):
    path = put("<r><root>text <foo>1</foo> more <bar><baz>x</baz> tail</bar></root></r>")
    assert infer_schema(spark, path, rowTag="root").simpleString() == "struct<bar:struct<baz:string>,foo:bigint>"


def test_round_trip_of_all_types(spark, tmp_path):
    schema = "s string, z boolean, b byte, h short, i int, l bigint, f float, d double, c decimal(25,3), dt date, ts timestamp, m map<string,string>, a array<struct<k:int>>, n string"
    data = [("a<&>\"'", True, 1, 2, -3, 4, 1.5, 2.25, Decimal("12345678901234567890.123"), dt.date(2020, 2, 29), dt.datetime(2020, 1, 2, 3, 4, 5, 678901), {"x": "y"}, [(1,), (2,)], None)]
    df = spark.createDataFrame(data, schema)
    write_xml(df, str(tmp_path / "o"), rowTag="row")
    assert rows(read_xml(spark, str(tmp_path / "o"), schema, rowTag="row")) == rows(df)


def test_writer_checks(spark, tmp_path):
    df = spark.range(3).withColumnRenamed("id", "a")
    save_as_xml_file(df, str(tmp_path / "o"), {"rowTag": "row", "codec": "gzip"}, "bzip2")
    assert any(p.name.endswith(".gz") for p in (tmp_path / "o").iterdir())
    with pytest.raises(ValueError, match="append"):
        write_xml(df, str(tmp_path / "o"), "append", strict=True)
    with pytest.raises(ValueError, match="attributePrefix"):
        write_xml(df, str(tmp_path / "p"), attributePrefix="")
    with pytest.raises(ValueError, match="not a valid XML name"):
        write_xml(df.withColumnRenamed("a", "a b"), str(tmp_path / "q"))
    bad = spark.createDataFrame([("x\x01y",)], "s string")
    write_xml(bad, str(tmp_path / "r"), strip_illegal=True, rowTag="row")
    assert rows(read_xml(spark, str(tmp_path / "r"), "s string", rowTag="row")) == [("xy",)]


def test_column_functions(spark):
    df = spark.createDataFrame([("<a><x>1</x></a>", ["<a><x>1</x></a>", "<a>", None]), ("<a><x>q</x></a>", []), ("<a>", None), (None, None)], "p string, q array<string>")
    assert [r[0] and r[0]["x"] for r in df.select(from_xml("p", "x int")).collect()] == [1, None, None, None]
    assert df.select(from_xml("p", "x int, _corrupt_record string")).collect()[1][0]["_corrupt_record"] == "<a><x>q</x></a>"
    got = df.select(from_xml("q", "array<struct<x:int>>")).collect()
    assert [x and x["x"] for x in got[0][0]] == [1, None, None] and got[1][0] == [] and got[3][0] is None
    with pytest.raises(Exception, match="FAILFAST"):
        df.select(from_xml("p", "x int", {"mode": "FAILFAST"})).collect()
    assert from_xml_string(spark, "<a><x>3</x></a>", "x int")["x"] == 3
    assert schema_of_xml(df.limit(1), "p", rowTag="a").simpleString() == "struct<x:bigint>"
    assert schema_of_xml_array(df.limit(2).select(F.slice("q", 1, 1).alias("q")), rowTag="a").simpleString() == "array<struct<x:bigint>>"


def test_reader_api(spark, put):
    reader = XmlReader().with_row_tag("p").withExcludeAttribute(True).with_parse_mode("DROPMALFORMED")
    assert reader.options == {"rowTag": "p", "excludeAttribute": True, "mode": "DROPMALFORMED"}
    assert reader.xml_file(spark, put(PEOPLE)).columns == ["age", "name", "tag"]
    assert xml_file(spark, put(PEOPLE), "p").count() == 3
    texts = spark.createDataFrame([("<p><a>1</a></p>",), ("<p><a>2</a></p>",)], "t string")
    assert rows(xml_dataset(texts, rowTag="p")) == [(1,), (2,)]
    assert rows(XmlReader().with_row_tag("p").xml_rdd(spark, texts.rdd.map(lambda r: r[0]))) == [(1,), (2,)]


@pytest.mark.parametrize(
    "text, kind, want, options",
    [
        ("1,000.50", "decimal(7,2)", Decimal("1000.50"), {}),
        ("+10", "int", 10, {}),
        ("300", "tinyint", None, {}),
        ("1.5", "int", None, {}),
        ("1,00", "double", 100.0, {}),
        ("1,00", "double", 1.0, {"locale": "fr"}),
        ("TRUE", "boolean", True, {}),
        ("0", "boolean", False, {}),
        ("yes", "boolean", None, {}),
        ("2019-03-08+06:00", "date", dt.date(2019, 3, 8), {}),
        ("08.03.2019", "date", dt.date(2019, 3, 8), {"date_format": "dd.MM.yyyy"}),
        ("2017-10-12 07:21:09", "timestamp", dt.datetime(2017, 10, 12, 7, 21, 9), {}),
        ("2017-10-12T07:21:09+06:00", "timestamp", dt.datetime(2017, 10, 12, 1, 21, 9), {}),
        ("2017-10-12T07:21:09.1234Z", "timestamp", dt.datetime(2017, 10, 12, 7, 21, 9, 123400), {}),
        ("10/12/2017 07:21", "timestamp", None, {"timestamp_format": "MM/dd/yyyy HH:mm"}),
        ("10/12/2017 07:21", "timestamp", dt.datetime(2017, 10, 12, 5, 21), {"timestamp_format": "MM/dd/yyyy HH:mm", "timezone": "Europe/Berlin"}),
        ("", "string", "", {}),
        ("", "string", None, {"treat_empty_values_as_nulls": True}),
        ("n/a", "int", None, {"null_value": "n/a"}),
    ],
)
def test_casts(spark, text, kind, want, options):
    got = spark.createDataFrame([(text,)], "x string").select(casts.cast_to(F.col("x"), T._parse_datatype_string(kind), XmlOptions(**options))).first()[0]
    assert got == want


def xsd(body):
    return f'<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">{body}</xs:schema>'


def test_xsd_shapes(tmp_path):
    basket = xsd('<xs:element name="basket"><xs:complexType><xs:sequence><xs:element name="entry" maxOccurs="unbounded"><xs:complexType><xs:sequence><xs:element name="key" type="xs:string"/><xs:element ref="v"/></xs:sequence></xs:complexType></xs:element><xs:any maxOccurs="2"/></xs:sequence></xs:complexType></xs:element><xs:element name="v" type="xs:long"/>')
    found = schema_of_xsd(basket)
    assert found.names == ["basket", "v"]
    assert found["basket"].dataType.simpleString() == "struct<entry:array<struct<key:string,v:bigint>>,xs_any:array<string>>" and not found["basket"].nullable
    price = xsd('<xs:element name="p"><xs:complexType><xs:simpleContent><xs:extension base="xs:float"><xs:attribute name="c" use="required" type="xs:string"/></xs:extension></xs:simpleContent></xs:complexType></xs:element>')
    assert schema_of_xsd(price)["p"].dataType.simpleString() == "struct<_VALUE:float,_c:string>"
    choice = xsd('<xs:element name="e"><xs:complexType><xs:choice><xs:element name="a" type="xs:integer"/><xs:element name="b" type="xs:date"/></xs:choice></xs:complexType></xs:element>')
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema_of_xsd(choice)["e"].dataType] == [("a", "int", True), ("b", "date", True)]
    decimal = xsd('<xs:element name="d"><xs:simpleType><xs:restriction base="xs:decimal"><xs:totalDigits value="12"/><xs:fractionDigits value="6"/></xs:restriction></xs:simpleType></xs:element><xs:element name="e" type="xs:decimal"/>')
    assert schema_of_xsd(decimal).simpleString() == "struct<d:decimal(12,6),e:decimal(38,18)>"
    extension = xsd('<xs:complexType name="base"><xs:sequence><xs:element name="x" type="xs:int"/></xs:sequence></xs:complexType><xs:element name="r"><xs:complexType><xs:complexContent><xs:extension base="base"><xs:sequence><xs:element name="y" type="xs:dateTime"/></xs:sequence></xs:extension></xs:complexContent></xs:complexType></xs:element>')
    assert schema_of_xsd(extension)["r"].dataType.simpleString() == "struct<x:int,y:timestamp>"
    with pytest.raises(ValueError, match="Unsupported item"):
        schema_of_xsd(xsd('<xs:element name="r"><xs:complexType><xs:sequence><xs:sequence/></xs:sequence></xs:complexType></xs:element>'))


def test_stream(spark, put, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_text(BROKEN)
    stream = read_xml_stream(spark, str(tmp_path / "in"), "_id int, a int", rowTag="row", mode="DROPMALFORMED")
    query = stream.writeStream.format("memory").queryName("tagloom_stream").start()
    try:
        query.processAllAvailable()
        assert sorted(rows(spark.table("tagloom_stream"))) == [(1, 1), (5, 7)]
    finally:
        query.stop()


def streamed(spark, path, name, schema, **options):
    query = read_xml_stream(spark, path, schema, **options).writeStream.format("memory").queryName(name).start()
    try:
        query.processAllAvailable()
        return spark.table(name).collect()
    finally:
        query.stop()


def test_stream_modes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_text(BROKEN)
    path = str(tmp_path / "in")
    got = streamed(spark, path, "tagloom_permissive", "_id int, a int, _corrupt_record string", rowTag="row")
    assert sorted((r["_id"] or 0, r["a"] or 0, r["_corrupt_record"] is not None) for r in got) == [(0, 0, True), (0, 0, True), (1, 1, False), (2, 0, True), (5, 7, False)]
    with pytest.raises(Exception, match="FAILFAST"):
        streamed(spark, path, "tagloom_failfast", "_id int, a int", rowTag="row", mode="FAILFAST")


def test_stream_windows_and_late_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put = lambda name, *times: (tmp_path / "in" / name).write_text("<r>" + "".join(f"<e><t>2024-01-01T{t}Z</t></e>" for t in times) + "</r>")
    events = read_xml_stream(spark, str(tmp_path / "in"), "t timestamp", rowTag="e").withWatermark("t", "10 minutes")
    counts = events.groupBy(F.window("t", "5 minutes")).count().select(F.minute("window.start").alias("m"), F.hour("window.start").alias("h"), "count")
    query = counts.writeStream.outputMode("append").format("memory").queryName("tagloom_windows").start()
    try:
        for name, times in (("a.xml", ("10:01:00", "10:02:00", "10:06:00")), ("b.xml", ("10:40:00",)), ("c.xml", ("10:03:00", "11:30:00")), ("d.xml", ("12:30:00",))):
            put(name, *times)
            query.processAllAvailable()
        got = sorted((r["h"], r["m"], r["count"]) for r in spark.table("tagloom_windows").collect())
        assert got[:3] == [(10, 0, 2), (10, 5, 1), (10, 40, 1)]  # the late row of c.xml is not counted
    finally:
        query.stop()


def test_asof_join_over_slices(spark):
    draw = random.Random(3)
    left = [(i, draw.choice("aaab"), draw.choice([None, *range(-50, 1100)])) for i in range(400)]
    right = [(draw.choice("aac"), t, t * 10) for t in draw.sample(range(1000), 90)]
    got = {r["i"]: r["v"] for r in asof_join(spark.createDataFrame(left, "i int, k string, t int"), spark.createDataFrame(right, "k string, u int, v int"), "t", "u", ["k"], ["v"], slices=16).collect()}
    want = {i: max(((u, v) for key, u, v in right if key == k and t is not None and u <= t), default=(None, None))[1] for i, k, t in left}
    assert got == want


SINGLE = "_id int, s string, z boolean, i int, h smallint, d double, f float, c decimal(8,2), dt date, t timestamp, a array<int>, o struct<x:int,_y:string,_VALUE:string>, m map<string,int>, _corrupt_record string"
TEXTS = [
    None,
    "<r/>",
    "<r id='3'><s>a&amp;b<!-- c --></s><z>TRUE</z><i>-7</i><h>9</h><d>1,000.5</d><f>1.1</f><c>1,234.567</c><dt>2019-03-08+06:00</dt><t>2017-10-12 07:21:09.5</t></r> junk",
    "<r><a>1</a><a>2</a><o y='k'>text</o><m q='1'><w>2</w></m><s><b>x</b> y</s></r>",
    "<r><a>1</a><a>z</a><a>3</a><s>kept</s></r>",
    "<r><o y='k'><x>q</x></o><m><w>zz</w></m><i>1</i></r>",
    "<r id='x'><s>lost</s></r>",
    "<r><i>99999999999</i><h>40000</h><z>maybe</z><d>1d</d><c> 1 </c></r>",
    "<r><i></i><s></s><d> </d></r>",
    "<r><i>1</r>",
    "no xml",
    "<r><s><![CDATA[<&>]]></s><t>2017-10-12T07:21:09+02:00</t><f>nan</f></r>",
]


@pytest.mark.parametrize("text", TEXTS)
def test_one_text_without_a_session(spark, text):
    schema = T._parse_datatype_string(SINGLE)
    for options in ({}, {"treatEmptyValuesAsNulls": True}, {"mode": "DROPMALFORMED"}):
        assert repr(from_xml_string(None, text, schema, options)) == repr(from_xml_string(spark, text, schema, options))


def test_one_text_inside_a_udf(spark):
    schema = T._parse_datatype_string("x int, a array<string>")
    read = F.udf(lambda x: from_xml_string(None, x, schema), schema)
    got = spark.createDataFrame([("<r><x>1</x><a>p</a><a>q</a></r>",), ("<r><x>z</x></r>",), (None,)], "t string").select(read("t").alias("r")).collect()
    assert [r["r"] and tuple(r["r"]) for r in got] == [(1, ["p", "q"]), None, None]
    with pytest.raises(ValueError, match="FAILFAST"):
        from_xml_string(None, "<r>", schema, {"mode": "FAILFAST"})


def test_pruned_scan(spark, put):
    plan = read_xml(spark, put(PEOPLE), "tag array<string>, name string", rowTag="p").select("name")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<name:string>" in plan
