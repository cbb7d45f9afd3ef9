"""A training-data pipeline over ``documents`` from five of the corpus operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next one reads it back from
Parquet.  All but the last return the columns of ``documents``, whatever others there are beside the
ones that a stage reads.  Null and empty texts pass all stages (the classifier judges them as empty
texts); null ids stay; of repeated rows the second stage keeps one; empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import common as C
from tagloom.llm import decontamination, jaccard_join, mixing, quality, sharding
from tagloom.llm.queries import SHARD_BYTES
from tagloom.shipping import ship


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps."""
    ship(spark)
    return quality.good_documents(docs, C.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each class of similar ones."""
    ship(spark)
    return jaccard_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without copies of benchmark items."""
    ship(spark)
    return decontamination.decontaminated(docs, C.table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    ship(spark)
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row with its shard, depth, page and bytes; an own column of such a name stays, and the
    new one has an underscore ahead."""
    ship(spark)
    names = ("shard", "depth", "page", "bytes")
    added = [F.col(n).alias(to) for n, to in zip(names, C.fresh(docs.columns, *names))]
    return sharding.assign_shards(docs, SHARD_BYTES).select("row.*", *added)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("sharding", shard),
]

#: A learnt classifier and the tilt of the mix have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = C.to_table(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
