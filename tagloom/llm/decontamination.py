"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Items and documents are compared as words without case and ASCII punctuation.  An item's seeds are
its word trigrams; how often each occurs in the whole corpus decides which are rare.  Where a
document holds a rare seed, the passage around it is aligned with the item, word by word, so that
copies with changed, missing or added words score as well.  A passage with common seeds only is
aligned if enough of its words are the item's for the score to be reached, so none is lost.  A
passage reaches as far from a seed as an alignment with enough score can: it may have as many words
more than the item as the item has words.

One scan of the corpus counts the seeds of all items, in a table of fixed size (seeds that share a
cell look more common than they are, which loses nothing, see above).  The items are then taken in
blocks of bounded size, each broadcast to all documents: nothing of a document is shuffled, and a
passage that very many documents share costs each of them its own alignment only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Words of a seed; text bytes of a block of items (each counts ITEM_BYTES more; a worker holds about
#: ten times as much); bits of the table of counts; occurrences for each document of the corpus up
#: to which a seed is rare whatever its item.
SEED, BLOCK_BYTES, ITEM_BYTES, COUNT_BITS, RARE = 3, 4 << 20, 64, 22, 1e-3
#: Scores of a word that agrees, that differs, and that only one side has; share of the best
#: possible score from which a passage counts as a copy.
MATCH, MISMATCH, GAP, THRESHOLD = 2, -1, 1, 0.5

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _grams(words: np.ndarray, n: int) -> np.ndarray:
    value = np.full(max(0, len(words) - n + 1), n, np.uint64)
    for k in range(n):
        value = C.mix(value * _ODD + words[k : k + len(value)])
    return value


def _cell(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def _whole_grams(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams that lie within one text, and where they begin."""
    value = _grams(words, n)
    at = np.flatnonzero(np.arange(len(value)) + n <= np.repeat(np.cumsum(counts), counts)[: len(value)])
    return value[at], at


class Items:
    """A block of benchmark items: their words, and all their seeds by length."""

    def __init__(self, ids: list, texts: list[str]):
        data, offsets = C.text_buffers(pa.array(texts, pa.string()))
        words, counts = C.hash_tokens(data, offsets, C.NOT_WORDY)
        stops = np.cumsum(counts)
        self.ids = ids
        self.words = [words[b - n : b] for b, n in zip(stops, counts)]
        found = [(min(SEED, len(w)), g, i, p) for i, w in enumerate(self.words) if len(w) for p, g in enumerate(_grams(w, min(SEED, len(w))))]
        self.lengths = sorted({x[0] for x in found})
        self.seeds = np.array([x[1] for x in found], np.uint64)
        self.item = np.array([x[2] for x in found], np.int64)
        self.place = np.array([x[3] for x in found], np.int64)
        self.sort()

    def sort(self) -> None:
        order = np.argsort(self.seeds, kind="stable")
        self.seeds, self.item, self.place = self.seeds[order], self.item[order], self.place[order]
        self.values, self.first, self.many = np.unique(self.seeds, return_index=True, return_counts=True)

    def mark_rare(self, half_octaves: np.ndarray, documents: int) -> None:
        """Marks an item's seeds that are rare, and those no more common than its median seed."""
        of = half_octaves[_cell(self.seeds)]
        middle = pd.Series(of).groupby(self.item).transform("median").to_numpy() if len(of) else of
        self.rare = (of <= 2 * np.log2(RARE * documents + 1)) | (of <= middle)

    def hits(self, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, seed's index) of all seeds in the documents' words."""
        at, which = [], []
        for n in self.lengths if len(self.values) else ():
            value, start = _whole_grams(words, counts, n)
            k = np.minimum(np.searchsorted(self.values, value), len(self.values) - 1)
            hit = np.flatnonzero(self.values[k] == value)
            at.append(start[hit])
            which.append(k[hit])
        return tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in (at, which))


def align(item: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Best local alignment score of an item with each row of ``windows`` (0: no word)."""
    ramp = GAP * np.arange(windows.shape[1])
    above = np.zeros(windows.shape, np.int32)
    best = np.zeros(len(windows), np.int32)
    for word in item:
        row = np.maximum(above - GAP, 0)
        row[:, 1:] = np.maximum(row[:, 1:], above[:, :-1] + np.where(windows[:, 1:] == word, MATCH, MISMATCH))
        row[:, 0] = np.maximum(row[:, 0], np.where(windows[:, 0] == word, MATCH, 0))
        above = np.maximum.accumulate(row + ramp, axis=1) - ramp  # gaps along the window
        best = np.maximum(best, above.max(axis=1))
    return best


def _passages(items: Items, words: np.ndarray, counts: np.ndarray):
    """Aligned passages of a piece of documents: (document, item, score, first word, end word)."""
    at, which = items.hits(words, counts)
    if not len(at):
        return
    reps = items.many[which]
    position = np.repeat(at, reps)
    entry = np.repeat(items.first[which] - np.cumsum(reps) + reps, reps) + np.arange(len(position))
    item, place, rare = items.item[entry], items.place[entry], items.rare[entry]
    stops = np.cumsum(counts)
    doc = np.searchsorted(stops, position, side="right")
    length = np.fromiter(map(len, items.words), np.int64, len(items.words))[item]
    slack = length  # at a score of half the best one, matches make up for so many gaps at most
    start = np.maximum(position - place - slack, (stops - counts)[doc])
    end = np.minimum(position - place + length + slack, stops[doc])
    order = np.lexsort((start, doc, item))
    doc, item, start, end, rare = doc[order], item[order], start[order], end[order], rare[order]
    # overlapping windows of one document and item are one passage
    reach = np.maximum.accumulate(end + (item * len(counts) + doc) * (len(words) + 1)) - (item * len(counts) + doc) * (len(words) + 1)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (start[1:] >= reach[:-1])
    heads = np.flatnonzero(new)
    doc, item, start = doc[heads], item[heads], start[heads]
    end, rare = np.maximum.reduceat(end, heads), np.logical_or.reduceat(rare, heads)
    padded = np.concatenate([words, np.zeros(int((end - start).max()), np.uint64)])
    for i in np.unique(item):
        mine = np.flatnonzero(item == i)
        mine = mine[np.argsort(end[mine] - start[mine], kind="stable")]
        at_ = 0
        while at_ < len(mine):  # windows of like width together, in bounded memory
            width = int((end - start)[mine[min(len(mine) - 1, at_ + 255)]])
            part = mine[at_ : at_ + max(1, min(256, 2_000_000 // max(1, width)))]
            width = int((end - start)[part].max())
            at_ += len(part)
            cell = start[part][:, None] + np.arange(width)
            window = np.where(cell < end[part][:, None], padded[cell], np.uint64(0))
            if not rare[part].all():  # a score takes so many words in common at least
                able = rare[part] | (np.isin(window, items.words[i]).sum(1) >= THRESHOLD * len(items.words[i]))
                part, window = part[able], window[able]
            score = align(items.words[i], window)
            share = score / (MATCH * len(items.words[i]))
            for k in np.flatnonzero(share >= THRESHOLD):
                d = doc[part[k]]
                yield int(d), int(i), float(share[k]), int(start[part[k]] - (stops - counts)[d]), int(end[part[k]] - (stops - counts)[d])


def _seed_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(length, cell) of all seeds of items."""
    for batch in batches:
        data, offsets = C.text_buffers(batch.column(0))
        for a, b in C.pieces(offsets):
            words, counts = C.hash_tokens(data, offsets[a : b + 1], C.NOT_WORDY)
            for n in range(1, SEED + 1):
                of = counts >= n if n == SEED else counts == n
                value, _ = _whole_grams(words[np.repeat(of, counts)], counts[of], n)
                cells = np.unique(_cell(value))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cells), n, np.int32)), pa.array(cells.astype(np.int32))], ["length", "cell"])


def _counted(wanted):
    """How often grams in the wanted cells of each length occur in documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = wanted.value
        total, seen = np.zeros(1 << COUNT_BITS, np.uint32), False
        for batch in batches:
            data, offsets = C.text_buffers(batch.column(0))
            for a, b in C.pieces(offsets):
                words, counts = C.hash_tokens(data, offsets[a : b + 1], C.NOT_WORDY)
                for n, marks in cells.items():
                    at = _cell(_whole_grams(words, counts, n)[0])
                    np.add.at(total, at[marks[at]], np.uint32(1))
                    seen = True
        if seen:
            yield C.count_slices(total)

    return run


def _aligned(items, names: list[str], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = items.value
        for batch in batches:
            data, offsets = C.text_buffers(batch.column(1))
            for a, b in C.pieces(offsets):
                best = {}
                for d, i, *found in _passages(block, *C.hash_tokens(data, offsets[a : b + 1], C.NOT_WORDY)):
                    if found[0] > best.get((d, i), (0,))[0]:
                        best[d, i] = found
                rows = pa.array([a + d for d, _ in best], pa.int64())
                columns = [batch.column(0).take(rows), pa.array([block.ids[i] for _, i in best], schema.field(0).type)]
                columns += [pa.array(list(x), t) for x, t in zip(zip(*best.values()) if best else ([],) * 3, (pa.float64(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Copies of benchmark items in documents: (doc_id, item_id, score, first_word, end_word).

    One row for each document and item with a passage that reaches half the best possible alignment
    score; the best passage is given, of equals the first, in words of the document, with the text
    around it that an alignment could reach.  Null, empty and wordless texts and items match
    nothing; long texts are read whole; repeated documents and items are each reported; an item of
    fewer than three words is one seed.  Empty tables give no rows; other columns, whatever their
    names, are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    tests = benchmark.select(F.col(item_col).alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    names = ["doc_id", "item_id", "score", "first_word", "end_word"]
    ddl = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, item_id {tests.schema['item_id'].dataType.simpleString()}, score double, first_word long, end_word long"
    cells: dict[int, np.ndarray] = {}
    for row in tests.select("text").mapInArrow(_seed_cells, "length int, cell int").distinct().toLocalIterator():
        cells.setdefault(row["length"], np.zeros(1 << COUNT_BITS, bool))[row["cell"]] = True
    common = C.half_octaves(rows.select("text").mapInArrow(_counted(spark.sparkContext.broadcast(cells)), C.COUNTED), COUNT_BITS)
    documents = rows.count()
    weight = tests.agg(F.coalesce(F.sum(F.octet_length("text") + ITEM_BYTES), F.lit(0))).first()[0]
    blocks, out = max(1, -(-weight // BLOCK_BYTES)), None
    for k in range(blocks):
        part = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").toArrow()
        items = Items(part.column(0).to_pylist(), part.column(1).to_pylist())
        items.mark_rare(common, documents)
        found = rows.mapInArrow(_aligned(spark.sparkContext.broadcast(items), names, part.schema), ddl)
        out = found if out is None else out.unionByName(found)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without copies of benchmark items.

    Null, empty and wordless texts stay; repeated rows stay or go together; an empty benchmark drops
    nothing; other columns stay as they are, whatever their names.
    """
    mine, ident, text_hash = C.fresh(docs.columns, "text_hash", "id", "hash")
    marked = docs.withColumn(mine, F.xxhash64(F.col(text_col)))
    found = contaminated(marked.select(F.struct(F.col(id_col).alias("id"), F.col(mine).alias("hash")).alias("key"), F.col(text_col).alias("text")), benchmark, "key", "text")
    bad = C.to_table(found.select(F.col("doc_id.id").alias(ident), F.col("doc_id.hash").alias(text_hash)).distinct(), "contaminated")
    return marked.join(bad, F.col(id_col).eqNullSafe(F.col(ident)) & (F.col(mine) == F.col(text_hash)), "left_anti").drop(mine)
