"""Deleted-interpolation language model, trained on and scoring a whole corpus.

p(w | v) = l2[b] c(v w) / c(v) + l1[b] c(w) / N + l0[b] / (V + 1), with b a bucket of the context's
frequency c(v).  The mixture weights l come from expectation-maximisation on a held-out (deleted)
part of the training texts, under counts from which that part is taken out; the final model then
uses all training counts.

How it runs: a task encodes its documents in blocks of bounded size (a block's distinct words and
the texts as indices into them).  Each block then asks for the corpus counts of its distinct words
and word pairs: the keys are dealt by hash to buckets, each bucket sums what all blocks hold, and
answers each block in the order it asked.  A very frequent word or pair is one entry of each block,
so no key can overload a task.  For EM the held-out tokens are summed in cells of (context bucket,
bigram ratio, unigram ratio) on a logarithmic grid from 1 down to below 1 / N; the number of cells
grows with the square of the logarithm of N.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from . import common as C

#: Of seven parts of the documents by crc32 of the id, the one never learnt from, and the deleted one.
PARTS, TEST_PART, DELETED_PART = 7, 2, 3
#: Text bytes of a block; keys that a counting task should hold at a time.
BLOCK_BYTES, BUCKET_KEYS = 4 << 20, 500_000
#: Context buckets: none, then one for each power of two of a 64-bit count.  Cells to an octave of a ratio.
CONTEXT_BUCKETS, GRID = 65, 4

_START = np.uint64(0x5BD1E9955BD1E994)
_END = np.uint64(0x27D4EB2F165667C4)
_U1 = np.uint64(1)

_BLOCKS = "block long, ids binary, parts binary, vocab binary, spans binary, tokens binary"
_ANSWERS = "block long, bucket int, counts binary, types long, tokens long, deleted long, kept_types long"


def _frozen(column: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([column], ["ids"])
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _thawed(data: bytes) -> pa.Array:
    return C.only_chunk(pa.ipc.open_stream(data).read_all(), "ids")


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seq = TaskContext.get().partitionId(), 0
    for chunk in C.gather_batches(batches, "text", BLOCK_BYTES):
        data, offsets = C.text_buffers(C.only_chunk(chunk, "text"))
        hashes, counts = [], []
        for a, b in C.pieces(offsets):
            h, n = C.hash_tokens(data, offsets[a : b + 1])
            hashes.append(h & ~_U1)  # even: a word; odd: a pair
            counts.append(n)
        words, n = np.concatenate(hashes), np.concatenate(counts)
        vocab, ids, many = np.unique(words, return_inverse=True, return_counts=True)
        order = np.argsort(-many, kind="stable")  # frequent words get small numbers, which pack well
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        vocab, ids = vocab[order], rank[ids]
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "block": part << 32 | seq,
                    "ids": _frozen(C.only_chunk(chunk, "doc_id")),
                    "parts": C.pack(C.only_chunk(chunk, "part").to_numpy(zero_copy_only=False).astype(np.int8)),
                    "vocab": vocab.tobytes(),
                    "spans": C.pack(n.astype(np.int64)),
                    "tokens": C.pack(C.planes(ids)),
                }
            ],
            schema=pa.schema([("block", pa.int64()), *((x, pa.binary()) for x in ("ids", "parts", "vocab", "spans", "tokens"))]),
        )
        seq += 1


class _Block:
    """A decoded block: every token with its context, and the distinct keys in ascending order."""

    def __init__(self, row: dict):
        self.ids = row["ids"]
        (self.part,) = C.unpack(row["parts"], np.int8)
        vocab = np.frombuffer(row["vocab"], np.uint64)
        (self.spans,) = C.unpack(row["spans"], np.int64)
        ids = C.unplanes(C.unpack(row["tokens"], np.uint8)[0], np.uint32)
        v = len(vocab)
        names = np.concatenate([vocab, [_END, _START]])
        docs = len(self.spans)
        stops = np.cumsum(self.spans + 1)  # each text with its end token
        self.last = stops - 1
        word = np.empty(int(stops[-1]) if docs else 0, np.int32)
        rest = np.ones(len(word), bool)
        rest[self.last] = False
        word[rest] = ids
        word[self.last] = v
        context = np.empty_like(word)
        context[1:] = word[:-1]
        context[stops - self.spans - 1] = v + 1
        self.doc = np.repeat(np.arange(docs, dtype=np.int32), self.spans + 1)
        pairs, pair = np.unique(context.astype(np.int64) * (v + 2) + word, return_inverse=True)
        self.pair = pair.astype(np.int32)
        del pair, rest, ids
        left, right = np.divmod(pairs, v + 2)
        hashes = C.mix(names[left] * np.uint64(0xC2B2AE3D27D4EB4F) + names[right]) | _U1
        self.word, self.context = word, context
        keys = np.concatenate([names, hashes])
        # a word of the text may hash like another; equal keys then share one entry
        self.keys, place = np.unique(keys, return_inverse=True)
        self.place = place.astype(np.int32)
        self.v = v

    def counts(self, mask: np.ndarray) -> np.ndarray:
        """How often each key occurs in the documents of ``mask``; a start counts once for each."""
        of = mask[self.doc]
        n = np.zeros(len(self.place), np.int64)
        n[: self.v + 1] = np.bincount(self.word[of], minlength=self.v + 1)
        n[self.v + 1] = mask.sum()
        n[self.v + 2 :] = np.bincount(self.pair[of], minlength=len(self.place) - self.v - 2)
        return np.bincount(self.place, n, len(self.keys)).astype(np.uint32)

    def bounds(self, buckets: int) -> np.ndarray:
        """Where the keys of each bucket begin and end."""
        return np.searchsorted(((self.keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32), np.arange(buckets + 1))


def _packed_keys(keys: np.ndarray, *counts: np.ndarray) -> bytes:
    """Ascending keys as differences, and their counts."""
    return C.pack(C.planes(np.diff(keys, prepend=np.uint64(0))), *map(C.planes, counts))


def _unpacked_keys(blob: bytes) -> tuple[np.ndarray, ...]:
    keys, *counts = C.unpack(blob, np.uint8, np.uint8, np.uint8)
    return np.cumsum(C.unplanes(keys, np.uint64), dtype=np.uint64), *(C.unplanes(x, np.uint32) for x in counts)


def _ask(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = _Block(row)
                learnt = b.part != TEST_PART
                full, deleted = b.counts(learnt), b.counts(b.part == DELETED_PART)
                at = b.bounds(buckets)
                out = [(k, _packed_keys(b.keys[x:y], full[x:y], deleted[x:y])) for k, (x, y) in enumerate(zip(at, at[1:])) if y > x]
                del b, full, deleted
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]] * len(out), pa.int64()), pa.array([k for k, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["block", "bucket", "payload"])

    return run


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    asked = [_unpacked_keys(x) for x in pdf["payload"]]
    keys, place = np.unique(np.concatenate([x[0] for x in asked]), return_inverse=True)
    full = np.bincount(place, np.concatenate([x[1] for x in asked]), len(keys)).astype(np.int64)
    deleted = np.bincount(place, np.concatenate([x[2] for x in asked]), len(keys)).astype(np.int64)
    cuts = np.cumsum([0, *(len(x[0]) for x in asked)])
    word = (keys & _U1 == 0) & (keys != _START)
    rows = [(int(b), int(k), C.pack(C.planes(full[place[x:y]]), C.planes(deleted[place[x:y]])), 0, 0, 0, 0) for b, k, x, y in zip(pdf["block"], pdf["bucket"], cuts, cuts[1:])]
    rows.append((-1, int(pdf["bucket"].iloc[0]), b"", int((full[word] > 0).sum()), int(full[word].sum()), int(deleted[word].sum()), int((full[word] > deleted[word]).sum())))
    return pd.DataFrame(rows, columns=["block", "bucket", "counts", "types", "tokens", "deleted", "kept_types"])


def _looked_up(left: pa.Table, right: pa.Table):
    """A block's row with the answers to it, as the block and its keys' counts."""
    b = _Block(left.to_pylist()[0])
    got = [C.unpack(x, np.uint8, np.uint8) for x in right.sort_by("bucket").column("counts").to_pylist()]
    full, deleted = (np.concatenate([C.unplanes(x[i], np.int64) for x in got])[b.place] for i in (0, 1))
    return b, full, deleted


def _bucket(context_count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2 of its count)."""
    return np.where(context_count > 0, 1 + np.floor(np.log2(np.maximum(context_count, 1))), 0).astype(np.int64)


def _parts(b: _Block, counts: np.ndarray, of: np.ndarray, total: int):
    """Context bucket, bigram and unigram estimate of the tokens ``of``."""
    c_pair = counts[b.v + 2 :][b.pair[of]]
    c_word = counts[b.word[of]]
    c_context = counts[b.context[of]]
    return _bucket(c_context), c_pair / np.maximum(c_context, 1), c_word / max(total, 1)


def grid_cells(total: int) -> int:
    """Cells along one ratio: 0 for nothing, then from 1 down to below 1 / total."""
    return GRID * (max(1, total).bit_length() + 1) + 1


def grid_step(x: np.ndarray, cells: int) -> np.ndarray:
    with np.errstate(divide="ignore"):
        z = cells - 1 + np.floor(np.log2(x) * GRID)
    return np.where(x > 0, np.clip(z, 1, cells - 1), 0).astype(np.int64)


def grid_value(z: np.ndarray, cells: int) -> np.ndarray:
    """The middle of a cell; the last one holds ratios of 1."""
    return np.where(z > 0, 2.0 ** (np.minimum(z + 0.5 - (cells - 1), 0) / GRID), 0.0)


def _cells_of(total: int):
    cells = grid_cells(total)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"cell": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        b, full, deleted = _looked_up(left, right)
        of = np.flatnonzero((b.part == DELETED_PART)[b.doc])
        k, two, one = _parts(b, full - deleted, of, total)
        found, n = np.unique((k * cells + grid_step(two, cells)) * cells + grid_step(one, cells), return_counts=True)
        return pa.table({"cell": found.astype(np.int64), "n": n.astype(np.int64)})

    return run


def fit_weights(found: np.ndarray, n: np.ndarray, types: int, total: int, rounds: int = 200) -> np.ndarray:
    """Mixture weights (bucket x [uniform, unigram, bigram]) by expectation-maximisation.

    Buckets without held-out tokens keep even weights; an unseen context has no bigram estimate, so
    its bucket splits the weight between the other two.  A small prior keeps every weight above 0.
    """
    cells = grid_cells(total)
    k, rest = np.divmod(found, cells * cells)
    two, one = np.divmod(rest, cells)
    return mixture_weights(k, np.stack([np.full(len(found), 1.0 / (types + 1)), grid_value(one, cells), grid_value(two, cells)], 1), n, rounds)


def mixture_weights(k: np.ndarray, f: np.ndarray, n: np.ndarray, rounds: int = 200) -> np.ndarray:
    """The weights under which ``n`` tokens each of bucket ``k`` with estimates ``f`` are likeliest."""
    weights = np.full((CONTEXT_BUCKETS, 3), 1 / 3)
    weights[0] = (0.5, 0.5, 0)
    allowed = weights > 0
    for _ in range(rounds):
        share = weights[k] * f
        share *= (n / share.sum(1))[:, None]
        sums = np.stack([np.bincount(k, share[:, i], CONTEXT_BUCKETS) for i in range(3)], 1) + 0.01 * allowed
        new = sums / sums.sum(1, keepdims=True)
        if np.abs(new - weights).max() < 1e-9:
            break
        weights = new
    return weights


def _score(weights: np.ndarray, total: int, types: int, kind: pa.DataType):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kinds = [kind, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        b, full, _ = _looked_up(left, right)
        every = np.arange(len(b.word))
        k, two, one = _parts(b, full, every, total)
        p = weights[k, 2] * two + weights[k, 1] * one + weights[k, 0] / (types + 1)
        known = full[b.word]
        docs = len(b.spans)
        per_doc = lambda x: np.bincount(b.doc, x, docs)
        columns = [
            b.part == TEST_PART,
            b.spans + 1,
            per_doc((known > 0).astype(float)).astype(np.int64),
            np.full(docs, total, np.int64),
            per_doc(np.log10((known + 1) / (total + types + 1))),
            per_doc(np.log10(p)),
        ]
        return pa.table([_thawed(b.ids).cast(kind), *(pa.array(x, k) for x, k in zip(columns, kinds[1:]))], names=names)

    return run


def score_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Log10 probability of each text under the corpus's own deleted-interpolation bigram model.

    Texts whose crc32(id) mod 7 is 2 are scored but not learnt from.  A null or empty text is one
    end token; a very long text is a block of its own; a null id belongs to a training part and
    stays null; ids keep their type; repeated rows count and are scored one by one; an empty table
    gives no rows.  Other columns, whatever their names, are not read.  Scores do not depend on any
    order, so ties need no rule.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), C.crc_mod(F.col(id_col), PARTS).cast("int").alias("part"))
    blocks = C.to_table(rows.mapInArrow(_encode, _BLOCKS), "lm-blocks")
    size = blocks.agg(F.sum(F.length("vocab")), F.sum(F.length("tokens")), F.count("*")).first()
    # distinct keys of a block: its words, and at most as many pairs as tokens
    buckets = max(1, int(((size[0] or 0) / 8 + (size[1] or 0)) / BUCKET_KEYS) + 1)
    asked = blocks.mapInArrow(_ask(buckets), "block long, bucket int, payload binary")
    answers = C.to_table(asked.groupBy("bucket").applyInPandas(_answer, _ANSWERS), "lm-counts")
    sums = answers.where("block = -1").agg(*(F.coalesce(F.sum(x), F.lit(0)) for x in ("types", "tokens", "deleted", "kept_types"))).first()
    types, total, deleted, kept_types = map(int, sums)
    counts = answers.where("block >= 0").select("block", "bucket", "counts")
    pair = blocks.groupBy("block").cogroup(counts.groupBy("block"))
    with C.tidy(docs.sparkSession):
        cells = pair.applyInArrow(_cells_of(total - deleted), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    weights = fit_weights(cells["cell"].to_numpy(np.int64), cells["n"].to_numpy(float), kept_types, total - deleted)
    field = rows.select("doc_id").schema
    kind = to_arrow_schema(field).field(0).type
    return pair.applyInArrow(_score(weights, total, types, kind), f"doc_id {field[0].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
