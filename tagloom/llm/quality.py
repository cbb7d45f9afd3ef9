"""A quality classifier by co-training: one view of a document's text, one of its metadata.

Low quality and toxicity are two targets, each with its own two views and its own threshold.

Both views are logistic models, fitted first on labelled documents.  In each round either view
scores all unlabelled documents and labels those that it ranks first and last; these join the other
view's training rows, each with the weight of how much more than the base rate the giving view knows
of it.  In the end each view is calibrated on labelled documents that were set aside, and a logistic
model of the two calibrated views scores all documents.

Models are fitted on the driver from a bounded sample of LABELLED labelled documents, those with the
least hash of their id, and the pseudo-labels of the rounds.  Candidates for these come from a scan of
the whole corpus; scoring reads every text whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

#: Labelled rows that the models are fitted on, rounds, and pseudo-labels that a view gives in a round.
LABELLED, ROUNDS, GIVEN = 5000, 3, 150
#: Hashed words of the text view, hashed values of the metadata view, share of labels set aside.
WORDS, METADATA, ASIDE = 1 << 16, 4096, 0.3
#: Standard deviations by which a feature's count among fine rows must be off to have a say in the
#: text view, and rows that must have it; share of fine documents set aside that a threshold may lose.
SIGNIFICANT, SEEN, LOST = 4.0, 3, 0.015

_CLASSES = {"upper": range(65, 91), "digit": range(48, 58), "mark": b"!?", "pipe": b"|<>{}[]", "odd": b"#$%&*+=@^_~\\/", "line": b"\n"}
_CLASS = np.zeros(256, np.int64)
for _i, _members in enumerate(_CLASSES.values(), 1):
    _CLASS[list(_members)] = _i
_STATS = len(_CLASSES) + 4
TEXT = WORDS + _STATS * 12


def _buckets(x: float, cuts: int = 12) -> int:
    """Half octaves of a share, so that a linear model can bend."""
    return min(cuts - 1, int(-2 * np.log2(max(x, 2.0**-6))))


def text_view(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Active features of each text: its distinct words, hashed, and bucketed shares of characters,
    of repeated words and of word lengths."""
    out = []
    for a, b in C.pieces(offsets):
        words, counts = C.hash_tokens(data, offsets[a : b + 1], C.NOT_WORDY)
        stops = np.cumsum(counts)
        for row in range(a, b):
            raw = data[offsets[row] : offsets[row + 1]]
            own = np.unique(words[stops[row - a] - counts[row - a] : stops[row - a]])
            size, n = max(1, len(raw)), max(1, int(counts[row - a]))
            shares = np.bincount(_CLASS[raw], minlength=len(_CLASSES) + 1)[1:] / size
            stats = [_buckets(x) for x in shares] + [_buckets(len(own) / n), min(11, size // n), min(11, int(np.log2(n))), int(len(own) == 0)]
            dense = WORDS + np.arange(_STATS) * 12 + np.array(stats)
            out.append(np.concatenate([dense, np.unique(own >> np.uint64(48)).astype(np.int64)]).astype(np.int32))
    return out


def metadata_view(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    """Source, language and size, coarse and fine, and their pairs."""
    size, fine = (None, None) if n_chars is None else (int(np.log2(max(1, n_chars)) * 2), int(np.log2(max(1, n_chars)) * 8))
    named = [("source", source), ("lang", lang), ("size", size), ("fine", fine), ("source lang", f"{source} {lang}"), ("source size", f"{source} {size}"), ("lang size", f"{lang} {size}")]
    return np.array([zlib.crc32(f"{k}={v}".encode()) % METADATA for k, v in named], np.int32)


class Sparse:
    """Rows of active features, each with the value that ``scale`` gives its column (1 if None).  A
    feature's value is the same in a long text as in a short one."""

    def __init__(self, rows: list[np.ndarray], width: int, scale: np.ndarray | None = None):
        self.n, self.width = len(rows), width
        self.col = np.concatenate([np.zeros(0, np.int32), *rows])
        self.row = np.repeat(np.arange(self.n), [len(x) for x in rows])
        self.value = np.ones(len(self.col)) if scale is None else scale[self.col]

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col] * self.value, self.n) + w[-1]

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(self.col, r[self.row] * self.value, self.width), r.sum())


def log_ratios(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, width: int) -> np.ndarray:
    """Each feature's log odds of a fine row against those of all rows; 0 where chance explains it."""
    col = np.concatenate([np.zeros(0, np.int32), *rows])
    many = [len(x) for x in rows]
    seen = np.bincount(col, np.repeat(weight, many), width)
    fine = np.bincount(col, np.repeat(weight * y, many), width)
    base = (weight * y).sum() / weight.sum()
    off = (np.abs(fine - seen * base) - 0.5) / np.sqrt(np.maximum(1, seen) * base * (1 - base))
    return np.where((off > SIGNIFICANT) & (seen >= SEEN), np.log((fine + 0.5) / (seen - fine + 0.5) * (1 - base) / base), 0.0)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x, y: np.ndarray, weight: np.ndarray, start: np.ndarray, steps: int = 120, ridge: float = 0.02) -> np.ndarray:
    """Weights of a logistic model, by diagonally scaled gradient steps (AdaGrad)."""
    w, seen = start.copy(), np.full(len(start), 1e-6)
    total = max(1e-9, weight.sum())
    for _ in range(steps):
        g = x.back(weight * (_sigmoid(x.dot(w)) - y)) / total
        g[:-1] += ridge / total * w[:-1]
        seen += g * g
        w -= 0.5 * g / np.sqrt(seen)
    return w


def _even(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights under which both classes count the same."""
    total, good = weight.sum(), (weight * y).sum()
    return weight * np.where(y > 0, total / (2 * max(1e-9, good)), total / (2 * max(1e-9, total - good)))


class _Columns:
    """A few dense columns with the interface of Sparse."""

    def __init__(self, *columns: np.ndarray):
        self.x = np.stack(columns, 1)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return self.x @ w[:-1] + w[-1]

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.append(self.x.T @ r, r.sum())


class Model:
    """The views of one target, their calibration and mix, and the target's threshold."""

    def __init__(self, text: np.ndarray, metadata: np.ndarray, platt: list, mix: np.ndarray, threshold: float, given: np.ndarray):
        self.text, self.metadata, self.platt, self.mix, self.threshold = text.astype(np.float32), metadata.astype(np.float32), platt, mix, threshold
        #: pseudo-labels given by (text, metadata): how many for (bad, good) rows, and their weight in all
        self.given = given

    def score(self, texts: list[np.ndarray], metadata: list[np.ndarray]) -> np.ndarray:
        views = [Sparse(rows, len(w) - 1).dot(w) for rows, w in ((texts, self.text), (metadata, self.metadata))]
        calibrated = [v * a + b for v, (a, b) in zip(views, self.platt)]
        return _sigmoid(_Columns(*calibrated).dot(self.mix))


def cut(p: np.ndarray, fine: np.ndarray) -> float:
    """The threshold of ``p`` that catches the most of the rows that are not fine, less what it loses
    of the fine ones, of which it loses LOST at most; 0 where nothing is gained."""
    values = np.unique(p)
    at = np.append(0.0, (values[1:] + values[:-1]) / 2)
    below = lambda x: np.searchsorted(np.sort(x), at) / max(1, len(x))
    lost = below(p[fine > 0])
    gain = np.where(lost <= LOST, below(p[fine <= 0]) - lost, -1.0)
    return float(at[int(gain.argmax())])


def _fit_text(rows: list, y: np.ndarray, weight: np.ndarray, start: np.ndarray, steps: int) -> np.ndarray:
    scale = log_ratios(rows, y, weight, TEXT)
    fitted = logistic(Sparse(rows, TEXT, scale), y, _even(y, weight), np.append(np.where(scale, start[:-1] / np.where(scale, scale, 1), 0), start[-1]), steps)
    return fitted * np.append(scale, 1)


def _fit_metadata(rows: list, y: np.ndarray, weight: np.ndarray, start: np.ndarray, steps: int) -> np.ndarray:
    return logistic(Sparse(rows, METADATA), y, _even(y, weight), start, steps)


class Trainer:
    """The two views of a target while they teach each other; 1 in ``y`` for fine rows."""

    def __init__(self, texts: list, metadata: list, y: np.ndarray):
        # set aside of each class alike, so that a rare one is there to be calibrated on
        aside = np.zeros(len(y), bool)
        for k in (0, 1):
            of = np.flatnonzero(y == k)
            aside[of] = np.arange(len(of)) % 10 < 10 * ASIDE
        if len(set(y[aside].tolist())) < 2 or len(set(y[~aside].tolist())) < 2:
            aside = np.zeros(len(y), bool)  # too few labels: the same rows fit and calibrate
        fit_on, check_on = np.flatnonzero(~aside), np.flatnonzero(aside) if aside.any() else np.arange(len(y))
        self.rows = [[v[i] for i in fit_on] for v in (texts, metadata)]
        self.labels = [list(y[fit_on]) for _ in range(2)]
        self.weight = [[1.0] * len(fit_on) for _ in range(2)]
        self.aside = [[v[i] for i in check_on] for v in (texts, metadata)]
        self.target, self.base = y[check_on].astype(float), float(y.mean())
        self.views = [np.zeros(TEXT + 1), np.zeros(METADATA + 1)]
        self.platt: list[np.ndarray] = []
        self.given = np.zeros((2, 2, 2))

    def fit(self, steps: int) -> None:
        """Fits both views to what they have, and calibrates them."""
        for v, fit_view in enumerate((_fit_text, _fit_metadata)):
            self.views[v] = fit_view(self.rows[v], np.array(self.labels[v], float), np.array(self.weight[v]), self.views[v], steps)
        ones = np.ones(len(self.target))
        margins = [Sparse(rows, len(w) - 1).dot(w) for rows, w in zip(self.aside, self.views)]
        self.platt = [logistic(_Columns(m), self.target, ones, np.array([1.0, 0.0]), 400, 0.1) for m in margins]

    def teach(self, by: int, good: int, features: tuple[np.ndarray, np.ndarray]) -> None:
        """A label from view ``by`` for the other one, weighed by what it knows beyond the base rate."""
        z = Sparse([features[by]], len(self.views[by]) - 1).dot(self.views[by])[0]
        a, b = self.platt[by]
        p = float(_sigmoid(np.array([z * a + b]))[0])
        sure = (p - self.base) / (1 - self.base) if good else (self.base - p) / self.base
        if sure > 0:
            self.rows[1 - by].append(features[1 - by])
            self.labels[1 - by].append(good)
            self.weight[1 - by].append(sure)
            self.given[by, good] += (1, sure)

    def model(self) -> Model:
        margins = [Sparse(rows, len(w) - 1).dot(w) for rows, w in zip(self.aside, self.views)]
        calibrated = [m * a + b for m, (a, b) in zip(margins, self.platt)]
        mix = logistic(_Columns(*calibrated), self.target, np.ones(len(self.target)), np.array([1.0, 0.0, 0.0]), 400, 0.1)
        model = Model(*self.views, self.platt, mix, 0.0, self.given)
        model.threshold = cut(model.score(*self.aside), self.target)
        return model


def judged(models: list[Model], texts: list[np.ndarray], metadata: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(score, keep): the product of the targets' probabilities, and whether each reaches its threshold."""
    score, keep = np.ones(len(texts)), np.ones(len(texts), bool)
    for model in models:
        p = model.score(texts, metadata)
        score *= p
        keep &= p >= model.threshold
    return score, keep


def _viewed(batch: pa.RecordBatch, names: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    text, source, lang, n_chars = (batch.column(batch.schema.get_field_index(n)) for n in names)
    return text_view(*C.text_buffers(text)), [metadata_view(*x) for x in zip(source.to_pylist(), lang.to_pylist(), n_chars.to_pylist())]


_VIEW = ["_text", "_source", "_lang", "_n_chars"]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut to a bounded size of text (or one row), so that features of few rows are held."""
    for batch in batches:
        _, offsets = C.text_buffers(batch.column(batch.schema.get_field_index(_VIEW[0])))
        for a, b in C.pieces(offsets):
            yield batch.slice(a, b - a)


def _views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = _viewed(batch, _VIEW)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.tobytes() for x in a], pa.binary()), pa.array([x.tobytes() for x in b], pa.binary())], ["_label", "_id", "text", "metadata"])


def _inputs(docs: DataFrame, text_col: str, source_col: str, lang_col: str, size_col: str) -> list:
    return [F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.col(source_col).cast("string").alias("_source"), F.col(lang_col).cast("string").alias("_lang"), F.col(size_col).cast("long").alias("_n_chars")]


def _margins(views):
    """(id, margin of each of the given views); views: (0 text or 1 metadata, weights)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            seen = _viewed(batch, _VIEW)
            found = [Sparse(seen[v], len(w) - 1).dot(w) for v, w in views.value]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.float64()) for x in found)], ["_id", *(f"m{k}" for k in range(len(found)))])

    return run


def _surest(own: DataFrame, known: DataFrame, trainers: list[Trainer]) -> list:
    """Of all documents without a label, those that a view ranks first and last: (slot, _id) rows.

    A slot is 4 * trainer + 2 * view + class.  Every document's margins are written as one short row;
    tasks hand on no more than GIVEN rows of a slot.
    """
    spark = own.sparkSession
    views = spark.sparkContext.broadcast([(v, w.astype(np.float32)) for t in trainers for v, w in enumerate(t.views)])
    many = 2 * len(trainers)
    ident = T.StructField("_id", own.schema["_id"].dataType)
    margins = own.where("_id is not null").mapInArrow(_margins(views), T.StructType([ident, *(T.StructField(f"m{k}", T.DoubleType()) for k in range(many))]))
    free = margins.join(known.select("_id"), "_id", "left_anti").dropDuplicates(["_id"])
    slots = F.array(*(F.struct(F.lit(2 * k + good).alias("slot"), (F.col(f"m{k}") * (1 if good else -1)).alias("sure")) for k in range(many) for good in (0, 1)))
    asked = free.select("_id", F.explode(slots).alias("at")).select("_id", "at.*")
    rank = F.row_number().over(Window.partitionBy("slot").orderBy(F.desc("sure"), F.xxhash64(F.col("_id").cast("string")), "_id"))
    with C.tidy(spark):
        found = asked.withColumn("rank", rank).where(F.col("rank") <= GIVEN).collect()
    share = [int(round(GIVEN * (t.base if good else 1 - t.base))) for t in trainers for _ in (0, 1) for good in (0, 1)]
    return [(r["slot"], r["_id"]) for r in sorted(found, key=lambda r: (r["slot"], r["rank"])) if r["rank"] <= max(1, share[r["slot"]])]


def _featured(own: DataFrame, picked: DataFrame) -> list:
    """(_label, _id, text, metadata) of the documents in ``picked`` (_id, _label), a bounded table."""
    one = F.min(F.struct(*_VIEW)).alias("row")  # of rows with one id always the same
    rows = own.join(F.broadcast(picked), "_id").groupBy("_id", "_label").agg(one).select("_label", "_id", "row.*")
    kind = T.StructType([T.StructField("_label", T.IntegerType()), T.StructField("_id", own.schema["_id"].dataType), T.StructField("text", T.BinaryType()), T.StructField("metadata", T.BinaryType())])
    with C.tidy(own.sparkSession):
        return [(r["_label"], r["_id"], np.frombuffer(r["text"], np.int32), np.frombuffer(r["metadata"], np.int32)) for r in rows.mapInArrow(_views, kind).collect()]


def fit(docs: DataFrame, labels: DataFrame, id_col: str, columns: list) -> list[Model]:
    """A model of each target of which both classes are labelled."""
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).alias("_id"), *columns)
    # an id with several labels is good, or clean, only if all of them say so; bits 1 and 2 of the label
    good = F.min(F.when(F.col("quality") > 0, 1).otherwise(0))
    clean = F.min(F.when(F.coalesce("toxic", F.lit(0)) <= 0, 2).otherwise(0))
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("_id")).agg((good + clean).alias("_label"))
    first = F.xxhash64(F.col("_id").cast("string"))
    chosen = C.to_table(known.orderBy(first, "_id").limit(LABELLED), "quality-labels")
    rows = sorted(_featured(own, chosen), key=lambda r: (zlib.crc32(str(r[1]).encode()), str(r[1])))
    texts, metadata, y = [r[2] for r in rows], [r[3] for r in rows], np.array([r[0] for r in rows], np.int64)
    trainers = [Trainer(texts, metadata, y >> bit & 1) for bit in (0, 1) if len(set((y >> bit & 1).tolist())) == 2]
    if not trainers:
        return []
    pair = T.StructType([T.StructField("_id", own.schema["_id"].dataType), T.StructField("_label", T.IntegerType())])
    taken: set = set()
    for step in range(ROUNDS):
        for t in trainers:
            t.fit(120 if step == 0 else 40)
        given = spark.createDataFrame([(i, 0) for i in sorted(taken)], pair)  # GIVEN rows of each slot and round
        asked = _surest(own, known.select("_id").unionByName(given.select("_id")), trainers)
        if not asked:
            break
        ids = sorted({i for _, i in asked})
        features = {i: (text, meta) for _, i, text, meta in _featured(own, spark.createDataFrame([(i, 0) for i in ids], pair))}
        for slot, i in asked:
            trainers[slot // 4].teach(slot // 2 % 2, slot % 2, features[i])
        taken.update(ids)
    for t in trainers:
        t.fit(40)
    return [t.model() for t in trainers]


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", size_col: str = "n_chars") -> DataFrame:
    """(row, score, keep) of each document, where ``row`` holds its own columns, whatever their names.

    A document is good if its label has quality 1 and is not toxic; ``score`` is the product of the
    calibrated probabilities of both and ``keep`` whether each of them reaches its threshold.  Null
    texts count as empty, null metadata is a value of its own.  Long texts are read whole.  Repeated
    rows are each scored; where rows of one id differ, models see the least of them.  A score that
    ties with a threshold is kept.  A target of which only one class is labelled scores 1 and drops
    nothing.  An empty table gives no rows.
    """
    columns = _inputs(docs, text_col, source_col, lang_col, size_col)
    models = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, columns))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            score, keep = judged(models.value, *_viewed(batch, _VIEW))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64()), pa.array(keep, pa.bool_())], ["row", "score", "keep"])

    rows = docs.select(row, *columns)
    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("keep", T.BooleanType())]))


def good_documents(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps: ``classify`` says what becomes of odd ones."""
    return classify(docs, labels, **columns).where("keep").select("row.*")
