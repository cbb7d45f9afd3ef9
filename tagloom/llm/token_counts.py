"""Token counts by byte-pair merging with a heap and a linked list, without emitting identifiers.

A segment's characters start as symbols.  The adjacent pair whose joined piece ranks lowest (of
equal ranks the leftmost) is merged again and again; the count is the initial symbols less the
merges, and a character that no piece covers counts its UTF-8 bytes.  No piece of the vocabulary
has a space mark after another character, so texts fall apart into independent segments at the
start of each run of spaces; segments repeat, and a bounded cache keeps their counts.
"""

from __future__ import annotations

import heapq
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Segments whose counts a Python worker keeps, and the longest one kept.
CACHE_SEGMENTS, CACHED_LENGTH = 1_000_000, 48
MARK = "▁"


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Numbered fields of a protobuf message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            n, at = {1: (8, at), 5: (4, at)}.get(kind) or _varint(data, at)
            value = data[at : at + n]
            at += n
        yield tag >> 3, value


def load_pieces(path: str) -> dict[str, float]:
    """Rank of each mergeable piece of a piece model: the negated score, lowest first.

    Only what this method can reproduce is accepted: a BPE model with byte fallback and the
    identity normaliser, which puts one space before a text and keeps all others.
    """
    ranks, spec = {}, {}
    with open(path, "rb") as f:
        for number, value in _fields(f.read()):
            if number == 1:
                piece = dict(_fields(value))
                kind = piece.get(3, 1)
                if kind in (4, 5):
                    raise ValueError("user-defined and unused pieces are not supported")
                if kind == 1:
                    ranks[piece[1].decode().replace(MARK, " ")] = -struct.unpack("<f", piece.get(2, bytes(4)))[0]
            elif number in (2, 3):
                spec[number] = dict(_fields(value))
    trainer, normalizer = spec[2], spec[3]
    if trainer.get(3) != 2 or not trainer.get(35) or normalizer.get(2) or not normalizer.get(3, 1) or normalizer.get(4, 1):
        raise ValueError(f"not a byte-fallback BPE model without normalisation: {path}")
    if any(re.search("[^ ] |[^\n]\n|\n[^\n]", piece) for piece in ranks):
        raise ValueError("a piece spans a word boundary")
    return ranks


class Counter(dict):
    """Counts by segment; a missing one is computed."""

    _SEGMENTS = re.compile(r" *[^ \n]+| +|\n+")

    def __init__(self, ranks: dict[str, float]):
        super().__init__()
        self.ranks = ranks
        self.known = {piece for piece in ranks if len(piece) == 1}

    def __missing__(self, segment: str) -> int:
        n = self.merged(segment)
        if len(segment) <= CACHED_LENGTH:
            if len(self) >= CACHE_SEGMENTS:
                self.clear()
            self[segment] = n
        return n

    def merged(self, segment: str) -> int:
        rank_of, n = self.ranks.get, len(segment)
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := rank_of(segment[i : i + 2])) is not None]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        ends, before = list(range(1, n + 2)), list(range(-1, n))  # the list's links; a dead symbol's end is 0
        merges = 0
        while heap:
            _, left, end = pop(heap)
            right = ends[left]
            if not right or right >= n or ends[right] != end:
                continue  # one of the two has been merged since
            ends[right] = 0
            ends[left] = end
            merges += 1
            if end < n:
                before[end] = left
                after = ends[end]
                if (rank := rank_of(segment[left:after])) is not None:
                    push(heap, (rank, left, after))
            prior = before[left]
            if prior >= 0 and (rank := rank_of(segment[prior:end])) is not None:
                push(heap, (rank, prior, end))
        out = n - merges
        if not self.known.issuperset(segment):
            out += sum(len(c.encode()) - 1 for i, c in enumerate(segment) if ends[i] == i + 1 and c not in self.known)
        return out

    def count(self, text: str) -> int:
        if not text:
            return 0
        if MARK in text:
            text = text.replace(MARK, " ")
        return sum(map(self.__getitem__, self._SEGMENTS.findall(" " + text)))


_counters: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """Tokens of each text under the piece model at ``model`` (a path on the driver).

    Null and empty texts have 0 tokens; very long texts are counted whole; of pairs with equal ranks
    the leftmost is merged first; repeated rows and null ids stay as they are; an empty table gives
    no rows; other columns, whatever their names, are not read.
    """
    known_as, vocabulary = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(load_pieces(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counters.get(known_as)
        if counter is None:
            _counters.clear()
            counter = _counters[known_as] = Counter(vocabulary.value)
        for batch in batches:
            n = [counter.count(x.as_py() or "") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_bytes"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
