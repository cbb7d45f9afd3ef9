import random
import uuid

import numpy as np
import pytest

from tagloom.llm import components, jaccard_join
from tagloom.plans.shapes import setting


def jobs_of(spark, action):
    """The result of ``action`` and how many jobs it took."""
    context, group = spark.sparkContext, uuid.uuid4().hex
    context.setJobGroup(group, "")
    try:
        result = action()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return result, len(context.statusTracker().getJobIdsForGroup(group))


def test_the_filter_of_texts_takes_few_jobs_however_many_partitions(spark):
    with setting(spark, "spark.sql.shuffle.partitions", "60"), setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        hashes = spark.range(5000).selectExpr("xxhash64(id) text_hash")
        got, jobs = jobs_of(spark, lambda: jaccard_join._filter(hashes))
    low = np.array([r[0] for r in hashes.collect()]) & (8 * len(got) - 1)
    want = np.zeros(8 * len(got), bool)
    want[low] = True
    assert (got == np.packbits(want, bitorder="little")).all()
    assert jobs <= 10


@pytest.mark.parametrize("alone", [0, components.ALONE])  # by rounds of stars, and in one task
def test_components_either_way(spark, monkeypatch, alone):
    monkeypatch.setattr(components, "ALONE", alone)
    draw = random.Random(3)
    links = [(draw.randrange(-300, 300), draw.randrange(-300, 300)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(40)] + [(9, 9)]
    above = {}

    def root(x):
        while x in above:
            x = above[x]
        return x

    for a, b in links:
        if (a := root(a)) != (b := root(b)):
            above[max(a, b)] = min(a, b)
    frame = spark.createDataFrame(links, "a long, b long").repartition(5)
    rows, jobs = jobs_of(spark, lambda: components.components(frame).collect())
    assert len(rows) == len({r["node"] for r in rows})
    assert {r["node"]: r["label"] for r in rows} == {x: root(x) for a, b in links if a != b for x in (a, b)}
    assert not alone or jobs <= 6  # no rounds
    assert components.components(frame.limit(0)).count() == 0
