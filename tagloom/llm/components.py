"""Connected components of links in a DataFrame: few links in one task, many by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: So many links (16 bytes each) one task joins by itself; more go through rounds of stars.
ALONE = 1 << 20


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, label) of the components of a task's links (a, b)."""
    links = [np.stack([x.to_numpy() for x in batch.columns]) for batch in batches if batch.num_rows]
    if not links:
        return
    nodes, ends = np.unique(np.concatenate(links, axis=1), return_inverse=True)
    x, y = ends.reshape(2, -1)
    label = np.arange(len(nodes))  # ascending as the nodes are
    while len(x):
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
        x, y = label[x], label[y]
        x, y = x[x != y], y[x != y]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], ["node", "label"])


def _starred(edges: DataFrame, centre: DataFrame) -> DataFrame:
    """Edges (u, v) with the centre m of u."""
    return edges.join(centre.withColumnRenamed("u", "_u"), F.col("u") == F.col("_u")).drop("_u")


def _stars(edges: DataFrame) -> bool:
    """Whether every node but the centres has one edge, and that to a centre."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(links: DataFrame, count: int | None = None) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b): the smallest node it is connected with.
    ``count``: how many links there are, where that is known.

    Up to ALONE links meet in one task.  Of more, each round joins a node's larger neighbours to its smallest one, then its smaller neighbours,
    until stars are left.  Neighbourhoods are never gathered: their minimum is a partial aggregate,
    joined back to the edges.  Tables are written each round, so lost executors cost no more than a
    round.
    """
    a, b = F.col("a"), F.col("b")
    if (links.count() if count is None else count) <= ALONE:
        return links.where(a != b).select("a", "b").repartition(1).mapInArrow(_forest, "node long, label long")
    edges = C.to_table(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "cc-edges")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = C.to_table(_starred(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-large")
        C.free(edges)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _starred(large, least).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = C.to_table(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "cc-edges")
        C.free(large)
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) after further ``links``: only the components that these join are looked at."""
    ends = links
    for side in ("a", "b"):
        own = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
        ends = ends.join(own, F.col(side) == F.col("_node"), "left").withColumn(side, F.coalesce("_label", side)).drop("_node", "_label")
    joined = C.to_table(components(ends, links.count()), "cc-joined").withColumnsRenamed({"node": "_node", "label": "_label"})
    old = labels.join(joined, F.col("label") == F.col("_node"), "left").select("node", F.coalesce("_label", "label").alias("label"))
    new = joined.join(labels.select("node"), F.col("_node") == F.col("node"), "left_anti").select(F.col("_node").alias("node"), F.col("_label").alias("label"))
    return old.unionByName(new)
