"""Joins that Spark SQL has no operator for, composed from ones it has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _number(time: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(time.cast("timestamp")).cast("double")
    return time.cast("double")


def asof_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str, by: list[str], keep: list[str], slices: int = 256) -> DataFrame:
    """Each left row with the latest right row of the same key that is not later; nulls without one.

    Time is cut in even slices.  Both sides go through one sort in each key and slice, so a key with
    very many rows is shared by many tasks and no pair is made that is not in the result; what a
    slice takes over from earlier ones comes from a table with one row for each key and slice.
    Left rows without a time or key have no partner; of right rows at the same time any one counts.
    """
    kinds = left.schema[left_time].dataType, right.schema[right_time].dataType
    ends = right.agg(F.min(_number(F.col(right_time), kinds[1])).alias("low"), F.max(_number(F.col(right_time), kinds[1])).alias("high")).first()
    low, width = ends["low"] or 0.0, max(((ends["high"] or 0.0) - (ends["low"] or 0.0)) / slices, 1e-9)
    cell = lambda time, kind: F.coalesce(F.least(F.lit(slices), F.greatest(F.lit(-1), F.floor((_number(F.col(time), kind) - low) / width))), F.lit(-1)).cast("int")
    kept = F.struct(*(F.col(c).alias(c) for c in keep))
    none = F.lit(None).cast(right.select(kept).schema[0].dataType)
    own = F.struct(*left.columns)
    tagged = left.select(*by, cell(left_time, kinds[0]).alias("_slice"), F.col(left_time).alias("_time"), F.lit(1).alias("_side"), own.alias("_left"), none.alias("_right"))
    other = right.select(*by, cell(right_time, kinds[1]).alias("_slice"), F.col(right_time).alias("_time"), F.lit(0).alias("_side"), F.lit(None).cast(left.select(own).schema[0].dataType).alias("_left"), kept.alias("_right")).where(F.col("_time").isNotNull())
    so_far = Window.partitionBy(*by, "_slice").orderBy("_time", "_side").rowsBetween(Window.unboundedPreceding, 0)
    placed = tagged.unionByName(other).withColumn("_last", F.last("_right", ignorenulls=True).over(so_far)).where("_side = 1")
    lasts = other.groupBy(*by, "_slice").agg(F.max_by("_right", "_time").alias("_newest"))
    # every slice from the next one on starts with the newest row before it
    starts = lasts.select(*by, (F.col("_slice") + 1).alias("_from"), (F.coalesce(F.lead("_slice").over(Window.partitionBy(*by).orderBy("_slice")), F.lit(slices))).alias("_to"), "_newest")
    starts = starts.select(*(F.col(k).alias(f"_by_{k}") for k in by), F.explode(F.sequence("_from", F.greatest("_from", "_to"))).alias("_at"), "_newest")
    same = F.col("_slice") == F.col("_at")
    for k in by:
        same = same & (F.col(k) == F.col(f"_by_{k}"))
    found = F.when(F.col("_time").isNotNull(), F.coalesce("_last", "_newest"))
    joined = placed.join(starts, same, "left").withColumn("_found", found)
    return joined.select("_left.*", *(F.col("_found").getField(c).alias(c) for c in keep))


def range_join(left: DataFrame, right: DataFrame, point: Column, low: Column, high: Column, width: float) -> DataFrame:
    """Left rows with the right rows whose [low, high] holds the point, by an equi-join on cells of
    ``width``: a right row is in each cell that its range touches."""
    cells = right.withColumn("_cell", F.explode(F.sequence(F.floor(low / width).cast("long"), F.floor(high / width).cast("long"))))
    return left.withColumn("_cell", F.floor(point / width).cast("long")).join(cells, "_cell").where((point >= low) & (point <= high)).drop("_cell")
