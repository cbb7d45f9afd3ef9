import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.llm import common as C
from tagloom.llm import decontamination, jaccard_join, language_id, quality

SF = "/root/testdata/sf0.1"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def _area(score, good):
    """The chance that a good row scores above a bad one."""
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n = good.sum()
    return (rank[good].sum() - n * (n + 1) / 2) / (n * (len(good) - n))


@needs_tables
def test_quality_catches_toxic_and_poor_rows_that_it_did_not_see(spark, monkeypatch):
    fitted, fit = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda *a: fitted.append(fit(*a)) or fitted[-1])
    labels = C.table(spark, SF, "labels")
    hidden = F.col("doc_id") % 4 == 0
    docs = C.table(spark, SF, "documents")
    found = quality.classify(docs, labels.where(~hidden)).select("row.doc_id", "score", F.col("keep").cast("int").alias("keep"))
    held = found.join(labels.where(hidden), "doc_id").toPandas()
    share = lambda of: held[of(held)].keep.mean()
    assert share(lambda x: (x.quality > 0) & (x.toxic == 0)) > 0.94
    assert share(lambda x: x.quality == 0) < 0.1
    assert share(lambda x: x.toxic == 1) < 0.3 and share(lambda x: (x.toxic == 1) & (x.quality > 0)) < 0.3
    assert _area(held.score.to_numpy(), ((held.quality > 0) & (held.toxic == 0)).to_numpy()) > 0.95
    models = fitted[0]
    assert len(models) == 2
    for m in models:  # either view has labelled documents of both classes for the other, with some weight
        assert (m.given[:, :, 0] > 0).all() and (m.given[:, :, 1] > 0).all()
    # scores and decisions by plain sums over the fitted weights
    some = docs.where("doc_id % 97 = 0").toPandas()
    got = {r["doc_id"]: r for r in found.where("doc_id % 97 = 0").collect()}
    for row in some.itertuples():
        p = [one_probability(m, row) for m in models]
        assert abs(got[row.doc_id]["score"] - p[0] * p[1]) < 1e-6
        if all(abs(x - m.threshold) > 1e-6 for x, m in zip(p, models)):
            assert got[row.doc_id]["keep"] == all(x >= m.threshold for x, m in zip(p, models))


def one_probability(model, row):
    data, offsets = C.text_buffers(pa.array([row.text]))
    text = quality.text_view(data, offsets)[0]
    metadata = quality.metadata_view(row.source, row.lang, row.n_chars)
    z = model.mix[2]
    for features, w, (a, b), share in ((text, model.text, model.platt[0], model.mix[0]), (metadata, model.metadata, model.platt[1], model.mix[1])):
        z += share * (a * (sum(float(w[k]) for k in features.tolist()) + float(w[-1])) + b)
    return 1 / (1 + np.exp(-z))


def test_quality_with_clashing_names(spark):
    frame = spark.createDataFrame([(k, f"text {k} " * (k % 7), "en", "src", k, "x", "y") for k in range(60)], "doc_id long, text string, lang string, source string, n_chars int, `my-col` string, _id string")
    labels = spark.createDataFrame([(k, k % 2, k % 3 // 2) for k in range(40)], "doc_id long, quality int, toxic int")
    out = quality.good_documents(frame, labels)
    assert out.columns == frame.columns and out.count() <= 60


def test_one_of_each_with_repeated_and_null_ids(spark):
    texts = [" ".join(f"{g}{i}" for i in range(60)) for g in "abc"]
    near = lambda text, k: text + f" tail{k}"
    data = [(1, near(texts[0], k)) for k in range(4)] + [(None, near(texts[1], k)) for k in range(5)] + [(None, near(texts[2], 0)), (9, near(texts[2], 1)), (9, near(texts[2], 1))]
    blank = [(3, ""), (3, ""), (None, None), (None, None), (4, " \n")]
    kept = jaccard_join.one_of_each(spark.createDataFrame(data + blank, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r["text"][0], str(r["doc_id"])) for r in kept if (r["text"] or "").strip()) == [("a", "1"), ("b", "None"), ("c", "9")]
    assert sum(not (r["text"] or "").strip() for r in kept) == len(blank)


def test_contamination_of_an_item_half_of_which_is_common(spark):
    item = [f"q{k}" for k in range(40)]
    copies = 300
    data = [(k, f"before{k} " + " ".join(item[:21]) + f" after{k}") for k in range(copies)] + [(copies, " ".join(item[:12]))]
    found = decontamination.contaminated(spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(copies)) and all(r["score"] >= 0.5 for r in found)


def test_languages_beyond_sixty_four_are_learnt(spark):
    langs = [f"x{k}" for k in range(66)]
    data = [(10 * k + i, " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}{w}" for w in "qabc") * 3, lang) for k, lang in enumerate(langs) for i in range(3)]
    got = language_id.identify(spark.createDataFrame(data, "doc_id long, text string, lang string"))
    assert len({r["lang_pred"] for r in got.collect()} & set(langs)) > 64
