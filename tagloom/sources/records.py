"""Raw record texts of XML files, one row for each.

Large files are read by many tasks: Spark's text source cuts them at the start of every tag that
begins with the record's name, so a piece runs from behind one such start to the next.  A piece is
plain if it is one whole record, or nothing of one.  Files of plain pieces need no more; in others a
record nests records of its own name, and its pieces are put together again by their depth, which
comes from running sums in each split and a small table of the splits.
"""

from __future__ import annotations

import re
import tempfile
from collections import OrderedDict
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.sources.options import XmlOptions

#: A schema that no record satisfies: its one element has a name that no data uses.
_REJECT_ALL = '<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="tagloom-none" type="xs:string"/></xs:schema>'
_RAW, _REST = "tagloom_raw", "tagloom_rest"
#: What is left of a start tag that closes itself, behind the name.
_EMPTY = r"""^(?:[^"'<>/]++|"[^"<]*+"|'[^'<]*+'|/(?!>))*+/>"""
NOT_FLAT = "a record holds a tag of its own name or is not closed; the split engine reads flat records only"


def paths(path: str | list[str]) -> list[str]:
    """Paths of a list, or of a text with commas between them (but not those in braces)."""
    if not isinstance(path, str):
        return list(path)
    return [x.strip() for x in re.split(r",(?![^{]*\})", path) if x.strip()]


def is_utf8(charset: str) -> bool:
    return charset.replace("-", "").replace("_", "").lower() in ("utf8", "usascii", "ascii")


def _reject_all(spark: SparkSession) -> str:
    """The name of the rejecting schema among the files that the driver hands to all tasks."""
    folder = Path(tempfile.gettempdir())
    name = f"tagloom-none-{spark.sparkContext.applicationId}.xsd"
    if name not in {Path(x).name for x in spark.sparkContext.listFiles}:
        (folder / name).write_text(_REJECT_ALL)
        spark.sparkContext.addFile(str(folder / name))
    return name


def whole_records(spark: SparkSession, path: str | list[str], row_tag: str, charset: str, stream: bool = False) -> DataFrame:
    """Records as Spark's own source delimits them, one task a file, for batches and streams."""
    schema = T.StructType([T.StructField(_RAW, T.StringType()), T.StructField(_REST, T.StringType())])
    options = XmlOptions.of(rowTag=row_tag, charset=charset, columnNameOfCorruptRecord=_RAW, rowValidationXSDPath=_reject_all(spark))
    reader = (spark.readStream if stream else spark.read).format("xml").options(**options.reading()).schema(schema)
    # a query of the corrupt column alone is refused, so the second column takes part
    return reader.load(path).select(F.concat(_RAW, F.coalesce(_REST, F.lit(""))).alias("xml"))


class Pieces:
    """What a piece of text behind ``<rowTag`` holds, as expressions over the column ``value``."""

    def __init__(self, row_tag: str):
        self.open, self.close = f"<{row_tag}", f"</{row_tag}>"
        value = F.col("value")
        #: the tag's name ends here, and it is not empty without attributes
        self.starts = F.substring(value, 1, 1).isin(" ", "\t", "\n", "\r", ">")
        self.empty = self.starts & value.rlike(_EMPTY)
        self.ahead = F.substring_index(value, self.close, 1)
        closed = self.ahead != value
        once = F.substring_index(value, self.close, 2) == F.concat(self.ahead, F.lit(self.close), F.substring_index(value, self.close, -1))
        self.plain = self.starts & F.when(self.empty, ~closed).otherwise(closed & once)
        self.nothing = ~self.starts & ~closed & ~value.rlike(f"</{re.escape(row_tag)}\\s+>")

    def read(self, spark: SparkSession, path: str | list[str]) -> DataFrame:
        return spark.read.text(path, lineSep=self.open)

    def record(self) -> Column:
        """The record of a plain piece."""
        value = F.col("value")
        return F.concat(F.lit(self.open), F.when(self.empty, F.regexp_extract(value, _EMPTY, 0)).otherwise(F.concat(self.ahead, F.lit(self.close))))


#: What the last looks ahead have found, by files and tag, so that the same files are not read ahead again.
_looked: OrderedDict[tuple, bool] = OrderedDict()
LOOKS_KEPT = 256


def is_flat(spark: SparkSession, path: str | list[str], row_tag: str) -> bool:
    """Whether all pieces are plain or hold nothing (a scan that ends at the first other one)."""
    files = spark.read.format("binaryFile").load(path)
    state = files.agg(F.count("*"), F.sum("length"), F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)"))).first()
    key = (row_tag, *state)
    if key not in _looked:
        p = Pieces(row_tag)
        _looked[key] = p.read(spark, path).where(~p.plain & ~p.nothing).limit(1).isEmpty()
        while len(_looked) > LOOKS_KEPT:
            _looked.popitem(last=False)
    return _looked[key]


def flat_records(spark: SparkSession, path: str | list[str], row_tag: str) -> DataFrame:
    """The records of flat files; another piece fails the query."""
    p = Pieces(row_tag)
    kept = F.when(p.plain, True).when(p.nothing, False).otherwise(F.raise_error(F.lit(NOT_FLAT)).cast("boolean"))
    return p.read(spark, path).where(kept).select(p.record().alias("xml"))


def nested_records(spark: SparkSession, path: str | list[str], row_tag: str) -> DataFrame:
    """The outermost records of any files: pieces put together by depth.

    A record that the file's end cuts off is given as far as it goes.  End tags without a start are
    passed over, as is a start tag that closes itself and has no attributes.
    """
    p = Pieces(row_tag)
    at = ["file", "split"]
    rows = p.read(spark, path).select(F.regexp_replace("value", f"</{re.escape(row_tag)}\\s+>", p.close).alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id"))
    opens = (p.starts & ~p.empty).cast("int")
    closes = F.regexp_count("value", F.lit(re.escape(p.close)))
    rows = rows.select(*at, F.array(F.struct("id", "value", p.starts.alias("starts"), opens.alias("opens"), (opens - closes).alias("delta"))).alias("piece"))
    # dealt out once: behind element_at no column is pruned, so all readers below share one scan and its shuffle
    rows = rows.repartition(*at).select(*at, *(F.element_at("piece", 1)[x].alias(x) for x in ("id", "value", "starts", "opens", "delta")))
    inside = Window.partitionBy(*at).orderBy("id")
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("sum", F.sum("delta").over(inside))
    splits = rows.groupBy(*at).agg(F.sum("delta").alias("net"), F.min("sum").alias("low"))
    splits = splits.withColumn("base", F.coalesce(F.sum("net").over(earlier), F.lit(0)))
    splits = splits.withColumn("floor", F.coalesce(F.min(F.col("base") + F.col("low")).over(earlier), F.lit(0)))
    placed = rows.join(splits.select(*at, "base", "floor"), at)
    before = F.col("base") + F.col("sum") - F.col("delta")
    low = F.coalesce(F.min(F.col("base") + F.col("sum")).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = placed.withColumn("depth", before - F.least(F.lit(0), F.col("floor"), low))
    first = F.when(F.col("starts") & (F.col("depth") == 0), F.struct("split", "id"))
    placed = placed.withColumn("own", F.last(first, ignorenulls=True).over(inside))
    lasts = placed.groupBy(*at).agg(F.max("own").alias("own")).withColumn("carried", F.last("own", ignorenulls=True).over(earlier))
    placed = placed.join(lasts.select(*at, "carried"), at).withColumn("record", F.coalesce("own", "carried"))
    placed = placed.where(F.col("record").isNotNull() & ((F.col("depth") > 0) | F.col("starts")))
    # what stands behind the tag that ends the record is not part of it
    needed = F.col("depth") + F.col("opens")
    text = F.when(needed == 0, F.regexp_extract("value", _EMPTY, 0)).when(needed + F.col("delta") - F.col("opens") <= 0, F.concat(F.call_function("substring_index", F.col("value"), F.lit(p.close), needed.cast("int")), F.lit(p.close))).otherwise(F.col("value"))
    parts = placed.select("file", "record", F.struct("split", "id", text.alias("text")).alias("part"))
    whole = parts.groupBy("file", "record").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return whole.select(F.concat(F.lit(p.open), F.array_join(F.transform("parts", lambda x: x["text"]), p.open)).alias("xml"))


def xml_records(spark: SparkSession, path: str | list[str], row_tag: str = "ROW", engine: str = "auto", charset: str = "UTF-8") -> DataFrame:
    """A row (xml) for each record, from its start tag to the matching end tag.

    ``auto``: many tasks a file, with or without nested tags of the same name, told apart by a scan
    ahead.  ``split``: the same for flat records only, without that scan; a record that is not flat
    fails the query.  ``records``: one task a file, any charset; ``auto`` takes it where the charset
    is not UTF-8.
    """
    path = paths(path)
    if engine not in ("auto", "split", "records"):
        raise ValueError(f"unknown record engine: {engine}")
    if engine == "split":
        if not is_utf8(charset):
            raise ValueError(f"the split engine reads UTF-8, not {charset}")
        return flat_records(spark, path, row_tag)
    if engine == "records" or not is_utf8(charset):
        return whole_records(spark, path, row_tag, charset)
    return (flat_records if is_flat(spark, path, row_tag) else nested_records)(spark, path, row_tag)
