"""Shards by extendible hashing: a directory over hash prefixes in which only oversized buckets split.

A document's key is 60 bits of the md5 of its id and text.  A bucket of depth d holds the keys with
one prefix of d bits; the root has depth 0.  Buckets above the byte limit split on the next bit, the
others stay, so shards differ in depth.  The directory comes from sums by prefix: all depths of the
first few bits at once, then further bits for the keys of buckets that are still too large.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

KEY_BITS = 60
#: Bits that a round adds to the directory's depth.
STEP_BITS = 8
SEPARATOR = "\x1f"


def hash_key(ident: Column, text: Column) -> Column:
    """60 bits of md5 over id and text, as a non-negative long."""
    digest = F.md5(F.concat_ws(SEPARATOR, ident.cast("string"), text).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def prefix(key: Column, depth: Column) -> Column:
    """The first ``depth`` bits of a key."""
    return F.call_function("shiftright", key, (F.lit(KEY_BITS) - depth).cast("int"))


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """Buckets (depth, prefix, bytes, docs) from keyed rows (key, bytes).

    A bucket is in the directory if it fits, or cannot split, and its parent does not fit.
    """
    total = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    low, high = 0, min(24, max(2, math.ceil(math.log2(max(1, total / limit))) + 3))
    leaves, part = None, rows
    while True:
        cells = part.groupBy(prefix(F.col("key"), F.lit(high)).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("docs"))
        nodes = cells.select("*", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")).groupBy("depth", F.call_function("shiftright", F.col("cell"), F.lit(high) - F.col("depth")).alias("prefix"))
        nodes = C.to_table(nodes.agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs")), "shard-nodes")
        splits = (F.col("bytes") > limit) & (F.col("docs") > 1) & (F.col("depth") < KEY_BITS)
        parents = nodes.where(splits).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("above"))
        children = nodes.withColumn("above", F.shiftright("prefix", 1)).join(parents, ["depth", "above"], "left_semi").drop("above")
        if low == 0:
            children = children.unionByName(nodes.where("depth = 0"))
        new = children.where(~splits)
        leaves = new if leaves is None else leaves.unionByName(new)
        open_ = nodes.where(splits & (F.col("depth") == high)).select(F.col("prefix").alias("cell"))
        if high >= KEY_BITS or open_.isEmpty():
            return C.to_table(leaves, "shard-directory")
        part = part.withColumn("cell", prefix(F.col("key"), F.lit(high))).join(open_, "cell", "left_semi").drop("cell")
        low, high = high, min(KEY_BITS, high + STEP_BITS)


def assign_shards(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row with its shard: (row, shard, depth, page, bytes), where ``row`` holds the document's
    own columns, whatever their names, and ``shard`` is the bucket's prefix in binary digits.

    A row counts its text's UTF-8 bytes (null: 0).  A text above the limit has a shard to itself.
    Repeated rows have one key and cannot be told apart by any bit; a bucket of them that is above
    the limit goes on in overflow pages, numbered from 1 (``page``; 0 elsewhere).  One bucket of
    depth 0 holds everything that fits the limit; an empty table gives no rows.
    """
    keyed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        hash_key(F.col(id_col), F.col(text_col)).alias("key"),
        F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("bytes"),
    )
    rows = C.to_table(keyed.select("key", "bytes"), "shard-keys")
    leaves = directory(rows, limit)
    depths = leaves.agg(F.min("depth"), F.max(F.when((F.col("depth") == KEY_BITS) & (F.col("bytes") > limit) & (F.col("docs") > 1), 1))).first()
    base = depths[0] or 0
    # the directory by its shallowest depth; a deeper bucket is found among those below one entry
    below = leaves.groupBy(F.call_function("shiftright", F.col("prefix"), F.col("depth") - base).alias("cell"))
    entries = C.to_table(below.agg(F.collect_list(F.struct("depth", "prefix", "bytes", "docs")).alias("below")), "shard-entries")
    placed = keyed.withColumnRenamed("bytes", "size").withColumn("cell", prefix(F.col("key"), F.lit(base))).join(entries, "cell")
    placed = placed.withColumn("at", F.filter("below", lambda x: prefix(F.col("key"), x["depth"]) == x["prefix"])[0])
    digits = F.when(F.col("at.depth") == 0, F.lit("")).otherwise(F.call_function("lpad", F.bin("at.prefix"), F.col("at.depth"), F.lit("0")))
    placed = placed.select("row", "key", "size", digits.alias("shard"), F.col("at.depth").alias("depth"), F.col("at.bytes").alias("bytes"), F.col("at.docs").alias("docs"))
    names = ["row", "shard", "depth", "page", "bytes"]
    if not depths[1]:
        return placed.withColumn("page", F.lit(0).cast("long")).select(names)
    too_large = (F.col("depth") == KEY_BITS) & (F.col("bytes") > limit) & (F.col("docs") > 1)
    fits = placed.where(~too_large).withColumn("page", F.lit(0).cast("long"))
    return fits.select(names).unionByName(_paged(placed.where(too_large), limit).select(names))


def _paged(rows: DataFrame, limit: int) -> DataFrame:
    """Overflow pages of repeated rows, numbered within each task's share of a key and then in all."""
    seen = C.to_table(rows.withColumn("seq", F.monotonically_increasing_id()), "shard-overflow").withColumn("task", F.shiftright("seq", 33))
    shares = seen.groupBy("key", "task").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("key").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = seen.withColumn("rank", F.row_number().over(Window.partitionBy("key", "task").orderBy("seq"))).join(shares.select("key", "task", before.alias("before")), ["key", "task"])
    each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("size"))).cast("long")
    ranked = ranked.withColumn("each", each).withColumn("page", (F.floor((F.col("rank") + F.col("before") - 1) / F.col("each")) + 1).cast("long"))
    held = F.least(F.col("each"), F.col("docs") - (F.col("page") - 1) * F.col("each"))
    return ranked.withColumn("bytes", (held * F.col("size")).cast("long"))
