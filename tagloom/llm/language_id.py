"""Hierarchical language identification: the family first, then linear support vector machines
between each two languages of the family.

Features are hashed byte trigrams of the whole text, lower-cased, with all ASCII that is no letter as
one space.  Models are fitted on the driver from a bounded sample of labelled rows (PER_LANGUAGE of
each language, those with the least hash, or fewer where ROWS do not give every language as many).
One scan counts the languages, one takes the sample, one scores every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

PARTS, TEST_PART = 5, 0
#: Labelled rows of each language that are learnt from, rows of all languages together, rows that
#: each language has at least; dimensions of the features.
PER_LANGUAGE, ROWS, FEWEST, DIMS = 800, 51200, 8, 1 << 12
#: Families of languages by ISO 639-1 code.  A language that is not here is a family
#: of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "indic": "as bn gu hi mr ne or pa sa si ur",
    "uralic": "et fi hu se",
    "turkic": "az kk ky tk tr tt ug uz",
    "semitic": "am ar he mt",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def family_of(lang: str) -> str:
    return _FAMILY.get(lang.lower().split("-")[0].split("_")[0], lang)


def features(data: np.ndarray) -> np.ndarray:
    """Square roots of trigram shares of one text, of unit length."""
    x = _FOLD[data].astype(np.uint32)
    x = np.concatenate([[np.uint32(32)], x, [np.uint32(32)]])
    x = x[np.concatenate([[True], (x[1:] != 32) | (x[:-1] != 32)])]
    if len(x) < 3:
        return np.zeros(DIMS, np.float32)
    code = ((x[:-2] << 16 | x[1:-1] << 8 | x[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(20)
    n = np.sqrt(np.bincount(code, minlength=DIMS).astype(np.float32))
    return n / np.sqrt((n * n).sum())


def linear_svm(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, rounds: int = 30, cost: float = 1.0) -> np.ndarray:
    """Weights (bias last) of a linear SVM with labels -1 and 1, by dual coordinate descent.

    ``x``: (features, their values) of each row.
    """
    n = len(y)
    w, alpha = np.zeros(DIMS + 1), np.zeros(n)
    norm = np.array([float(v @ v) for _, v in x]) + 1.0
    share = np.where(y > 0, n / max(1, 2 * (y > 0).sum()), n / max(1, 2 * (y < 0).sum())) * cost
    draw = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in draw.permutation(n):
            at, value = x[i]
            g = y[i] * (value @ w[at] + w[-1]) - 1
            new = min(max(alpha[i] - g / norm[i], 0.0), share[i])
            if (step := new - alpha[i]) != 0:
                w[at] += step * y[i] * value
                w[-1] += step * y[i]
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w


class Model:
    """One machine to a family against the rest, one to each pair of languages in a family."""

    def __init__(self, x: list[tuple[np.ndarray, np.ndarray]], langs: list[str]):
        named = np.array([family_of(z) for z in langs])
        langs = np.array(langs)
        self.families = sorted(set(named))
        self.members = {f: sorted(set(langs[named == f])) for f in self.families}
        if len(self.families) == 2:  # one machine tells two families apart
            w = linear_svm(x, np.where(named == self.families[0], 1.0, -1.0))
            rows = [w, -w]
        else:
            rows = [linear_svm(x, np.where(named == f, 1.0, -1.0)) for f in self.families] if len(self.families) > 1 else [np.zeros(DIMS + 1)] * len(self.families)
        self.pairs = []
        for f in self.families:
            own = self.members[f]
            for i in range(len(own)):
                for j in range(i + 1, len(own)):
                    of = (langs == own[i]) | (langs == own[j])
                    self.pairs.append((f, i, j))
                    rows.append(linear_svm([x[k] for k in np.flatnonzero(of)], np.where(langs[of] == own[i], 1.0, -1.0)))
        self.weights = np.array(rows).reshape(-1, DIMS + 1).astype(np.float32)

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        """Language and score: the family's share of the families' softmax, times the mean margin
        of the language's duels as a probability."""
        margin = self.weights[:, :-1] @ x + self.weights[:, -1]
        lead = margin[: len(self.families)]
        share = np.exp(4 * (lead - lead.max()))
        best = int(lead.argmax())
        family = self.families[best]
        score, votes = share[best] / share.sum(), {}
        own = self.members[family]
        wins, sure = np.zeros(len(own)), np.zeros(len(own))
        for (f, i, j), m in zip(self.pairs, margin[len(self.families) :]):
            if f == family:
                wins[i if m >= 0 else j] += 1
                p = 1 / (1 + np.exp(-4 * m))
                sure[i] += p
                sure[j] += 1 - p
        k = max(range(len(own)), key=lambda z: (wins[z], sure[z], -z))
        if len(own) > 1:
            score *= sure[k] / (len(own) - 1)
        return own[k], float(min(1.0, max(0.0, score)))


def sample(docs: DataFrame) -> DataFrame:
    """(lang, text) of the rows to learn from, out of (doc_id, text, lang, part).

    Different rows, those with the least hash in each language.  A bar on the hash, from the number
    of different rows of the language, lets about twice as many through as are taken, so no more are
    ranked, however many rows a language has or repeats.
    """
    known = docs.where((F.col("part") != TEST_PART) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    known = known.select("lang", "text", F.xxhash64(F.col("doc_id").cast("string"), "text").alias("hash"))
    langs = C.to_table(known.groupBy("lang").agg(F.approx_count_distinct("hash").alias("rows")), "lang-counts")
    each = min(PER_LANGUAGE, max(FEWEST, ROWS // max(1, langs.count())))
    bar = langs.select(F.col("lang").alias("_lang"), F.when(F.col("rows") > 2 * each, -(2.0**63) + 2.0**64 * (2 * each / F.col("rows"))).alias("bar"))
    near = known.join(bar, F.col("lang") == F.col("_lang")).where(F.col("bar").isNull() | (F.col("hash") < F.col("bar"))).dropDuplicates(["lang", "hash"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    return near.withColumn("rank", rank).where(F.col("rank") <= each).select("lang", "text")


def fit(docs: DataFrame) -> Model | None:
    """A model from (doc_id, text, lang, part): rows outside the test part with a language."""
    rows = sample(docs).mapInArrow(_featurise, "lang string, at binary, value binary")
    with C.tidy(docs.sparkSession):
        rows = sorted(map(tuple, rows.collect()))  # the same however rows arrive
    if not rows:
        return None
    x = [(np.frombuffer(at, np.uint16), np.frombuffer(value, np.float32)) for _, at, value in rows]
    return Model(x, [lang for lang, _, _ in rows])


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = C.text_buffers(batch.column(1))
        found = [features(data[a:b]) for a, b in zip(offsets, offsets[1:])]
        at = [np.flatnonzero(z).astype(np.uint16) for z in found]
        columns = [[k.tobytes() for k in at], [z[k].tobytes() for z, k in zip(found, at)]]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(z, pa.binary()) for z in columns)], ["lang", "at", "value"])


def _predicted(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        for batch in batches:
            data, offsets = C.text_buffers(batch.column(2))
            lang, score = [], []
            for a, b, letters in zip(offsets, offsets[1:], batch.column(3).to_pylist()):
                name, p = fitted.predict(features(data[a:b])) if fitted and letters else ("und", 0.0)
                lang.append(name)
                score.append(p)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every text.

    Learns from rows with a language whose crc32(id) mod 5 is not 0 (a null id is never held out).
    Null texts and texts without a letter are ``und`` with score 0, as is everything when there is
    nothing to learn from.  Of families with equal margins the first by name is taken, of languages
    with equal duels the first by code.  Long texts are read whole.  Repeated rows are each predicted
    and learnt from once; an empty table gives no rows; other columns, whatever their names, are not
    read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), C.crc_mod(F.col(id_col), PARTS).alias("part"))
    model = docs.sparkSession.sparkContext.broadcast(fit(rows))
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    kind = rows.schema["doc_id"].dataType.simpleString()
    asked = rows.select("doc_id", (F.col("part") == TEST_PART).alias("held_out"), F.coalesce("text", F.lit("")), letters)
    return asked.mapInArrow(_predicted(model), f"doc_id {kind}, held_out boolean, lang_pred string, score double")
