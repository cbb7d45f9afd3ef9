"""Mixing sources to target weights by entropy balancing, in DataFrame functions throughout.

Of all document rates r in [0, 3], the mix takes those of least relative entropy (the sum of
r log r - r) under which each source gives its target of words.  The solution is an exponential
tilt, r = min(3, exp(lambda_s size)); lambda_s solves the source's convex dual, by safeguarded Newton
steps on the logarithm of the words taken.  A rate depends on source and size alone, so the steps
run over exact counts of documents by (source, size).

Rates become copies by a threshold hashed from the document.  Each source's threshold then moves to
where the words taken meet the target: the documents' distances to their next copy are summed in ever
finer histograms, as many as it takes for a bin to hold about one document, which finds the place
without ordering a source's rows.

Tables of sources are written and read back, so Spark knows their size and broadcasts them only
where that is under its own threshold.  Sources are ranked range by range, so there may be as many
as there are hosts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

#: A document's, and with that a source's, largest multiple; weights of the sources in turn.
CAP, WEIGHTS = 3, (1, 2, 3)
NEWTON_STEPS, TOLERANCE = 60, 1e-6
#: Bits of a distance between copies, and of each histogram over it.
DISTANCE_BITS, BIN_BITS = 40, 10


def _running(rows: DataFrame, order: list[Column], **sums: Column) -> DataFrame:
    """``rows`` with <name>_ahead, the sum of each of ``sums`` over the rows before in ``order``, and
    <name>_all, that over all rows.

    Rows are dealt to ranges of the order and written, which fixes the ranges.  Sums run within each
    range, and what the ranges before it hold is added; there are no more ranges than shuffle
    partitions, so no task sees all rows.
    """
    ranged = C.to_table(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "mix-ranges")
    preceding = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0)
    held = ranged.groupBy("range").agg(*(F.sum(x).alias(n) for n, x in sums.items()))
    earlier, within = preceding(Window.orderBy("range")), preceding(Window.partitionBy("range").orderBy(*order))
    held = held.select("range", *(F.coalesce(F.sum(n).over(earlier), none).alias(f"{n}_before") for n in sums), *(F.sum(n).over(Window.partitionBy()).alias(f"{n}_all") for n in sums))
    out = ranged.select("*", *(F.coalesce(F.sum(x).over(within), none).alias(f"{n}_within") for n, x in sums.items())).join(F.broadcast(held), "range")
    return out.select(*rows.columns, *((F.col(f"{n}_before") + F.col(f"{n}_within")).alias(f"{n}_ahead") for n in sums), *(f"{n}_all" for n in sums))


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, null last, weigh 1, 2, 3, 1, ...; they share all words by weight, none
    above 3 times its size; what one cannot take goes to the others by weight, until none is above.
    In order of size to weight, a source is held at 3 times its size as long as its share of what
    the ones before it leave is above that.
    """
    by_name, room = F.col("source").asc_nulls_last(), F.col("source_size") / F.col("weight")
    numbered = _running(sizes, [by_name], ranks=F.lit(1))
    turn = (F.pmod(F.col("ranks_ahead"), F.lit(len(WEIGHTS))) + 1).cast("int")
    weighed = numbered.select("source", "source_size", F.element_at(F.array(*map(F.lit, WEIGHTS)), turn).cast("double").alias("weight"))
    ranked = _running(weighed, [room.asc(), by_name], words=F.col("source_size"), weights=F.col("weight"))
    left_words = F.col("words_all").cast("double") - CAP * F.col("words_ahead")
    left_weight = F.col("weights_all") - F.col("weights_ahead")
    ranked = ranked.withColumn("share", left_words / left_weight).withColumn("held", F.col("weight") * F.col("share") > CAP * F.col("source_size"))
    first = F.min(F.struct(room.alias("room"), F.col("source").isNull().alias("none"), "source", "share")).alias("first")
    free = ranked.where(~F.col("held")).agg(first).first()["first"]  # one row
    share = F.lit(free["share"] if free else None).cast("double")
    target = F.when(F.col("held"), CAP * F.col("source_size").cast("double")).otherwise(F.col("weight") * share)
    return ranked.select("source", "source_size", target.alias("target"))


def _with(rows: DataFrame, state: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` beside the columns of their source in ``state``."""
    other = state.withColumnRenamed("source", "_of")
    return rows.join(other, F.col("source").eqNullSafe(F.col("_of")), how).drop("_of")


def _tilt() -> Column:
    return F.least(F.exp(F.col("lam") * F.col("size")), F.lit(float(CAP)))


def solve_dual(groups: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, lam) of each source with words, from exact counts (source, size, n).

    A source that has not met TOLERANCE after NEWTON_STEPS goes on with its last rate; its copies
    are placed to meet the target all the same.
    """
    least = groups.groupBy("source").agg((F.log(F.lit(float(CAP))) / F.min("size")).alias("most"))
    full = F.col("target") >= CAP * F.col("source_size") * (1 - 1e-9)  # every document at the cap
    nothing = F.lit(None).cast("double")
    state = _with(least, targets).select("source", "target", "most", F.when(full, F.col("most")).otherwise(0.0).alias("lam"), nothing.alias("low"), F.col("most").alias("high"), full.alias("done"))
    state = C.to_table(state, "mix-dual")
    for _ in range(NEWTON_STEPS):
        if state.where(~F.col("done")).isEmpty():
            break
        bent = F.when(_tilt() < CAP, F.col("size") * F.col("size") * _tilt()).otherwise(0.0)
        got = (
            _with(groups, state)
            .groupBy("source", "target", "most", "lam", "low", "high", "done")
            .agg(F.sum(F.col("n") * F.col("size") * _tilt()).alias("g"), F.sum(F.col("n") * bent).alias("h"))
        )
        off = F.log(F.col("g") / F.col("target"))
        got = (
            got.withColumn("low", F.when(off < 0, F.col("lam")).otherwise(F.col("low")))
            .withColumn("high", F.when(off > 0, F.col("lam")).otherwise(F.col("high")))
            .withColumn("to", F.when(F.col("h") > 0, F.col("lam") - off * F.col("g") / F.col("h")))
            .withColumn("done", F.col("done") | (F.abs(off) < TOLERANCE))
        )
        inside = (F.col("to") < F.col("high")) & (F.col("low").isNull() | (F.col("to") > F.col("low")))
        halved = F.when(F.col("low").isNull(), 2 * F.col("lam") - F.col("most")).otherwise((F.col("low") + F.col("high")) / 2)
        lam = F.when(F.col("done"), F.col("lam")).when(inside, F.col("to")).otherwise(halved)
        state = C.to_table(got.select("source", "target", "most", lam.alias("lam"), "low", "high", "done"), "mix-dual")
    return state.select("source", "lam")


def _distance(rows: DataFrame) -> DataFrame:
    """Adds copies and the distances to one copy more and one less (null where there is none).

    Distances are integers, so that all histograms agree on where a document lies.
    """
    one = 1 << DISTANCE_BITS
    draw = F.shiftrightunsigned(F.xxhash64(F.col("key")), 64 - DISTANCE_BITS)
    place = F.floor(_tilt() * one).cast("long") + draw
    rows = rows.withColumn("place", place).withColumn("copies", F.least(F.shiftright("place", DISTANCE_BITS), F.lit(CAP)).cast("long"))
    up = F.when(F.col("copies") < CAP, (F.col("copies") + 1) * F.lit(one).cast("long") - F.col("place"))
    down = F.when((F.col("copies") > 0) & (F.col("place") < F.lit((CAP + 1) * one).cast("long")), F.col("place") - F.col("copies") * F.lit(one).cast("long"))
    return rows.withColumn("up", up).withColumn("down", down).drop("place")


def _nearer(rows: DataFrame, state: DataFrame, shift: int) -> DataFrame:
    """Narrows the place where a source's threshold stops to a bin of 2**shift.

    ``state``: (source, more, gap, place); ``rows`` have the distances.  The first bin that would
    pass the gap is the new place; without one every document that can move does.
    """
    span = shift + BIN_BITS
    d = F.when(F.col("more"), F.col("up")).otherwise(F.col("down"))
    near = _with(rows, state).withColumn("d", d).where((F.col("d") >= F.col("start")) & (F.shiftright(F.col("d") - F.col("start"), span) == 0))
    sums = near.groupBy("source", "gap", F.shiftright(F.col("d") - F.col("start"), shift).alias("bin")).agg(F.sum("size").alias("words"))
    sums = sums.withColumn("so_far", F.sum("words").over(Window.partitionBy("source").orderBy("bin")))
    found = sums.groupBy("source").agg(F.min(F.when(F.col("so_far") > F.col("gap"), F.struct("bin", "words", "so_far"))).alias("at"))
    out = _with(state, found, "left")
    used = F.col("at.so_far") - F.col("at.words")
    start = F.col("start") + F.shiftleft(F.col("at.bin"), shift)
    return out.select(
        "source",
        "more",
        F.when(F.col("at").isNull(), F.col("gap")).otherwise(F.col("gap") - used).alias("gap"),
        F.when(F.col("at").isNull(), F.lit(2 << DISTANCE_BITS).cast("long")).otherwise(start).alias("start"),
        F.col("at.words").alias("words"),
    )


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """How often the mix takes each document: (row, size, source_size, target, copies, taken), where
    ``row`` holds the document's own columns, whatever their names.

    The null source counts as one source.  Null and empty texts have size 0 and weigh nothing: they
    are taken once.  A source without words has target 0.  Repeated rows move together.  A source
    ends within about one document of its target, or one group of documents with equal ids.  Very
    long texts count by all their words.  Reruns agree.  An empty table gives no rows.
    """
    sized = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(source_col).alias("source"),
        C.word_count(F.col(text_col)).alias("size"),
        F.col(id_col).cast("string").alias("key"),
    )
    rows = C.to_table(sized.drop("row"), "mix-rows")
    groups = C.to_table(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-groups")
    sizes = groups.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = C.to_table(source_targets(sizes), "mix-targets")
    weighty = groups.where("size > 0")
    lam = C.to_table(_with(targets, solve_dual(weighty, targets), "left").select("source", "source_size", "target", F.coalesce("lam", F.lit(0.0)).alias("lam")), "mix-rates")
    far = C.to_table(_distance(_with(rows, lam)).select("source", "size", "target", "copies", "up", "down"), "mix-distances")
    gap = far.groupBy("source", "target").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")).withColumn("gap", F.col("target") - F.col("taken"))
    state = C.to_table(gap.select("source", (F.col("gap") > 0).alias("more"), F.abs("gap").alias("gap"), F.lit(0).cast("long").alias("start")), "mix-gap")
    weighty = far.where("size > 0").drop("target")
    levels = min(DISTANCE_BITS // BIN_BITS, max(2, -(-rows.count().bit_length() // BIN_BITS)))
    for level in range(1, levels + 1):
        fine = DISTANCE_BITS - level * BIN_BITS
        state = C.to_table(_nearer(weighty, state, fine), "mix-gap")
    # the last bin goes too where that comes nearer to the target
    stop = F.when(F.col("words") - F.col("gap") < F.col("gap"), F.col("start") + (1 << fine)).otherwise(F.col("start"))
    plan = C.to_table(_with(lam, state.select("source", "more", stop.alias("stop")), "left"), "mix-plan")
    placed = _distance(_with(sized, plan))
    moves = F.when(F.col("more") & (F.col("up") < F.col("stop")), 1).when(~F.col("more") & (F.col("down") < F.col("stop")), -1).otherwise(0)
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("copies") + F.coalesce(moves, F.lit(0))).cast("long")
    return placed.withColumn("copies", copies).select("row", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **columns: str) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken (``mix_sources`` has the odd cases:
    null and empty texts stay once)."""
    taken = mix_sources(docs, **columns).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_")).select("row.*")
