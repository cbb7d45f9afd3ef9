"""Exact n-gram Jaccard join by parity sketches.

A document's set is its distinct word shingles.  Sets of similarity t = 3/4 or more differ in at most
(|A| + |B|) / 7 shingles.  A sketch deals a set's shingles to k cells and keeps the XOR of the hashes
in each: a differing shingle disturbs one cell, so the number of cells in which two sketches differ
is a lower bound of the symmetric difference.  k is twice the lower end of the set's size band (a
factor of two); a set that can have partners in the next band gets a sketch there too.

Pigeonhole: of k cells at most D = (|A| + |B|) / 7 differ, so under any one order of cell values the
first D + 1 of either sketch have a value in common.  The order puts rare values first, by a table of
counts of fixed size over the whole corpus, and empty cells last: passages that many documents share
are looked at only where a set consists of little else.

Values are dealt to buckets in packed blocks; a value that two sets share makes a run.  Values that
more than HOT sets may have are dealt as single rows instead, so that no task holds all of them.  Near copies
share many values: runs whose two least members agree are joined into one bundle, so a group is
compared a few times and not once for each of its values.  Each set is first held against one
leader, which joins groups of near copies without listing their pairs.  Exact verification gives
links, links give components, and only bundles that still span components go on.

These are cut in blocks of bounded weight, and a task compares two blocks at a time: first by the
bits of the sketches, which leaves the sets that may have a link, then shingle by shingle.  Pairs
stay within the task; it gives out only links that join two components, fewer than it has sets.  A
bundle's main component is held against the others but not against itself.

Hashes: equal sets are named by 64 bits, shingles are compared by 48 bits of their hashes.  Of m
different sets a pair is taken for equal with a probability of at most m * m / 2**65; two sets of n
shingles get a wrong count of what they share with one of n * n / 2**48 (under 10**-7 for 5,000).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .components import components, merged

#: Words of a shingle, and the similarity as a share of 100.
WIDTH, PERCENT = 5, 75
#: Bits of the table of counts (a byte a cell when broadcast: 16 MiB at most) and of the filter of
#: texts (128 MiB at most).  Both grow with the corpus up to the upper bound; beyond it they tell
#: less, so more is looked at, and results stay the same.
COUNT_BITS, FILTER_BITS = (20, 24), (26, 30)
#: Bits of the filter that come to the driver at once (16 MiB), by a job for each.
FILTER_PART = 27
#: Values that a bucket task should hold; text bytes of a packed block; from which count (by the
#: table) a value's sets are too many for a task and go through shuffles of single rows.
BUCKET_VALUES, BLOCK_BYTES, HOT = 2_000_000, 8 << 20, 1 << 21
#: Bits of a rank (twice the logarithm of a count) before a cell value.
RANK_BITS = 7
#: Shingles of a block of a bundle, what a set counts besides its shingles, columns of a product.
BLOCK_WEIGHT, SET_WEIGHT, COLUMNS = 1 << 17, 256, 4096

_EMPTY = np.uint64(0x8CB92BA72F3D8DD7)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each document's distinct shingles in ascending order, and how many there are.

    With fewer words than a shingle has, the whole sequence is one; without words there is none.
    """
    n = np.where(counts >= WIDTH, counts - WIDTH + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(len(counts)), n)
    first = np.repeat(np.cumsum(counts) - counts - np.cumsum(n) + n, n) + np.arange(len(doc))
    size = np.minimum(counts, WIDTH)[doc]
    value = size.astype(np.uint64)
    padded = np.concatenate([words, np.zeros(WIDTH, np.uint64)])
    for k in range(WIDTH):
        value = np.where(k < size, value * _ODD + padded[first + k], value)
    value = C.mix(value)
    stops = np.cumsum(n)
    for i in np.flatnonzero(n > 1):
        value[stops[i] - n[i] : stops[i]].sort()
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return value[new], np.bincount(doc[new], minlength=len(counts)).astype(np.int64)


def node_of(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set, equal for equal sets (0 for the empty one)."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(C.mix(values * _ODD), dtype=np.uint64)])
    stops = np.cumsum(counts)
    out = C.mix((sums[stops] - sums[stops - counts]) + counts.astype(np.uint64) * _ODD)
    return np.where(counts > 0, out | np.uint64(1), np.uint64(0)).view(np.int64)


def _sets(batch: pa.RecordBatch, column: int = 1):
    """(first row, end row, shingle hashes, set sizes, nodes) of pieces of a batch."""
    data, offsets = C.text_buffers(batch.column(column))
    for a, b in C.pieces(offsets):
        words, counts = C.hash_tokens(data, offsets[a : b + 1])
        values, sizes = shingles(words, counts)
        yield a, b, values, sizes, node_of(values, sizes)


def _bits(values: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    """Each set's bit sketch: parities in a power of two of bits, one to two for each shingle.

    The hash's low bits choose the position, so half a sketch XOR its other half is the sketch of
    half the length.
    """
    out, stop = [], np.cumsum(sizes)
    for n, end in zip(sizes, stop):
        if not n:
            out.append(None)
            continue
        m = max(64, 2 << int(n).bit_length() - 1)
        hits = np.bincount((values[end - n : end] >> np.uint64(7)).astype(np.int64) & (m - 1), minlength=m)
        out.append(np.packbits((hits & 1).astype(np.uint8), bitorder="little").tobytes())
    return out


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, values, sizes, nodes in _sets(batch):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(nodes), pa.array(sizes), pa.array(_bits(values, sizes), pa.binary())], ["doc_id", "text_hash", "node", "n", "bits"])


def _cells(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sketches of sets: for each document and band the values of its cells that are not empty.

    Returns (entry's sketch number, entry's value hash) and for each sketch (document, prefix length).
    """
    docs = np.flatnonzero(sizes)
    n = sizes[docs]
    band = np.floor(np.log2(n)).astype(np.int64)  # 2**band <= n < 2**(band + 1)
    upper = np.int64(2) << band
    # partners in the own band are below its upper end; those above it are met in the next band
    own = (n + np.minimum(4 * n // 3, upper - 1)) // 7
    further = 4 * n // 3 >= upper
    sketch_doc = np.concatenate([docs, docs[further]])
    sketch_band = np.concatenate([band, band[further] + 1])
    prefix = np.concatenate([own, (n + 4 * n // 3)[further] // 7]) + 1
    lower = np.concatenate([np.zeros(len(docs), bool), np.ones(int(further.sum()), bool)])
    # a set of this band may have its partner from the band below: that one is smaller
    starts = np.cumsum(sizes) - sizes
    length = sizes[sketch_doc]
    sketch = np.repeat(np.arange(len(sketch_doc)), length)
    at = np.repeat(starts[sketch_doc] - np.cumsum(length) + length, length) + np.arange(len(sketch))
    k = np.uint64(2) << sketch_band.astype(np.uint64)
    value = values[at]
    cell = (value >> np.uint64(7)) & (k[sketch] - np.uint64(1))
    code = sketch.astype(np.int64) << np.int64(34) | cell.astype(np.int64)
    order = np.argsort(code, kind="stable")
    code, value = code[order], value[order]
    heads = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    parity = np.bitwise_xor.reduceat(value, heads) if len(heads) else value
    owner = code[heads] >> np.int64(34)
    where = (code[heads] & np.int64((1 << 34) - 1)).astype(np.uint64)
    return owner, C.mix(parity + C.mix(where * _ODD + sketch_band[owner].astype(np.uint64))), sketch_doc, prefix, lower, sketch_band


def _grown(n: int, bounds: tuple[int, int], spare: int) -> int:
    """Bits for a table of about ``n`` entries, within the bounds."""
    return min(bounds[1], max(bounds[0], int(n).bit_length() + spare))


def _count_cells(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        seen = False
        for batch in batches:
            for _, _, values, sizes, _ in _sets(batch, 0):
                _, keys, *_ = _cells(values, sizes)
                np.add.at(counts, (keys >> np.uint64(64 - bits)).astype(np.int64), np.uint32(1))
                seen = True
        if seen:
            yield C.count_slices(counts)

    return run


def _value_counts(texts: DataFrame, bits: int) -> np.ndarray:
    """Half octaves of how often cell values occur, by the leading bits of their hashes."""
    return C.half_octaves(texts.mapInArrow(_count_cells(bits), C.COUNTED), bits)


def _prefixes(values: np.ndarray, sizes: np.ndarray, commonness: np.ndarray):
    """(document, value) of the first values of every sketch in the corpus-wide order.

    The order is that of one word, the rank before the value's leading bits; these are all that
    comes back of a value.
    """
    owner, keys, sketch_doc, prefix, lower, band = _cells(values, sizes)
    bits = len(commonness).bit_length() - 1
    rank = commonness[(keys >> np.uint64(64 - bits)).astype(np.int64)]
    placed = rank.astype(np.uint64) << np.uint64(64 - RANK_BITS) | keys >> np.uint64(RANK_BITS)
    have = np.bincount(owner, minlength=len(sketch_doc))
    stops, kept = np.cumsum(have), np.minimum(have, prefix)
    for i in np.flatnonzero(have > kept):
        placed[stops[i] - have[i] : stops[i]].partition(kept[i] - 1)
    first = np.repeat(stops - have - np.cumsum(kept) + kept, kept) + np.arange(int(kept.sum()))
    doc, key = [np.repeat(sketch_doc, kept)], [placed[first] << np.uint64(RANK_BITS)]
    # sketches with fewer full cells than their prefix go on with empty ones, in the order of cells
    for s in np.flatnonzero(have < prefix):
        full = np.zeros(2 << int(band[s]), bool)
        d = sketch_doc[s]
        start = int(sizes[:d].sum())
        full[((values[start : start + sizes[d]] >> np.uint64(7)) & np.uint64(len(full) - 1)).astype(np.int64)] = True
        empty = np.flatnonzero(~full)[: int(prefix[s] - have[s])]
        doc.append(np.full(len(empty), d))
        key.append(C.mix(C.mix(empty.astype(np.uint64) * _ODD + np.uint64(band[s])) ^ _EMPTY) >> np.uint64(RANK_BITS) << np.uint64(RANK_BITS))
    return np.concatenate(doc), np.concatenate(key)


def _hot_rank() -> int:
    return int(2 * np.log2(HOT))


def _hot_values(commonness):
    """(value, node, n) of the values that are too common for one task, once for each set of a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, bar = commonness.value
        for batch in batches:
            for _, _, values, sizes, nodes in _sets(batch, 0):
                of, keys = _prefixes(values, sizes, ranks)
                hot = keys >> np.uint64(64 - RANK_BITS) >= np.uint64(bar)
                found = np.unique(np.stack([keys[hot].view(np.int64), nodes[of[hot]], sizes[of[hot]]], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found.T], ["value", "node", "n"])

    return run


def _hot_bundles(texts: DataFrame, commonness) -> DataFrame:
    """Bundles of the runs of hot values, by aggregates and joins on the few hot values."""
    rows = C.to_table(texts.mapInArrow(_hot_values(commonness), "value long, node long, n long").distinct(), "join-hot")
    draw = F.struct(F.xxhash64("node").alias("draw"), F.col("node").alias("node"))
    lead = rows.groupBy(F.col("value").alias("_value")).agg(F.min(draw).alias("lead"))
    led = rows.join(lead.select("_value", F.col("lead.node").alias("lead")), F.col("value") == F.col("_value")).drop("_value")
    second = led.where(F.col("node") != F.col("lead")).groupBy(F.col("value").alias("_value")).agg(F.min(draw).alias("second"))
    out = led.join(second.select("_value", F.col("second.node").alias("second")), F.col("value") == F.col("_value"))
    return out.select(F.xxhash64("lead", "second").alias("bundle"), "lead", "node", "n")


def _bucketed(buckets: int, commonness):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, bar = commonness.value
        for table in C.gather_batches(batches, "text", BLOCK_BYTES):
            names, sizes_of, of, keys = [], [], [], []
            at = 0
            for batch in table.to_batches():
                for _, _, values, sizes, nodes in _sets(batch, 0):
                    d, k = _prefixes(values, sizes, ranks)
                    cool = k >> np.uint64(64 - RANK_BITS) < np.uint64(bar)
                    d, k = d[cool], k[cool]
                    names.append(nodes), sizes_of.append(sizes), of.append(d + at), keys.append(k)
                    at += len(nodes)
            # equal sets in a block count once
            names, owner = np.unique(np.concatenate(names), return_inverse=True)
            sizes = np.zeros(len(names), np.int64)
            sizes[owner] = np.concatenate(sizes_of)
            of, keys = owner[np.concatenate(of)].astype(np.uint32), np.concatenate(keys)
            order = np.lexsort((of, keys))
            of, keys = of[order], keys[order]
            new = np.ones(len(of), bool)
            new[1:] = (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])
            of, keys = of[new], keys[new]
            cuts = np.searchsorted(((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32), np.arange(buckets + 1))
            out = []
            for b, (x, y) in enumerate(zip(cuts, cuts[1:])):
                if y > x:
                    used, local = np.unique(of[x:y], return_inverse=True)
                    out.append((b, C.pack(_steps(keys[x:y]), local.astype(np.uint16 if len(used) < 65536 else np.uint32).view(np.uint8), names[used], sizes[used].astype(np.uint32)), int(len(used) < 65536)))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], ["bucket", "short", "payload"])

    return run


def _steps(keys: np.ndarray) -> np.ndarray:
    """Ascending keys as byte planes of the differences of their leading 48 bits."""
    lead = keys >> np.uint64(16)
    steps = np.diff(lead, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :6].T).ravel()


def _unsteps(planes: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(planes) // 6, 8), np.uint8)
    wide[:, :6] = planes.reshape(6, -1).T
    return np.cumsum(wide.view(np.uint64).ravel(), dtype=np.uint64)


def _bundles(pdf: pd.DataFrame) -> pd.DataFrame:
    """Members (bundle, lead, node, n) of the runs of a bucket: of all values that two or more sets share."""
    keys, nodes, n = [], [], []
    for short, blob in zip(pdf["short"], pdf["payload"]):
        planes, local, names, sizes = C.unpack(blob, np.uint8, np.uint8, np.int64, np.uint32)
        local = local.view(np.uint16 if short else np.uint32)
        keys.append(_unsteps(planes)), nodes.append(names[local]), n.append(sizes[local])
    keys, nodes, n = map(np.concatenate, (keys, nodes, n))
    # the order of a run's members is that of their scrambled names, so runs agree on their first ones
    draw = C.mix(nodes.view(np.uint64))
    order = np.lexsort((draw, keys))
    keys, nodes, n = keys[order], nodes[order], n[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
    keys, nodes, n = keys[new], nodes[new], n[new]
    same = keys[1:] == keys[:-1]
    shared = np.zeros(len(keys), bool)
    shared[1:] |= same
    shared[:-1] |= same
    keys, nodes, n = keys[shared], nodes[shared], n[shared]
    if not len(keys):
        return pd.DataFrame({x: np.zeros(0, np.int64) for x in ("bundle", "lead", "node", "n")})
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    length = np.diff([*start, len(keys)])
    lead = nodes[start]
    bundle = np.repeat(C.mix(lead.view(np.uint64) * _ODD + nodes[start + 1].view(np.uint64)).view(np.int64), length)
    lead = np.repeat(lead, length)
    order = np.lexsort((nodes, bundle))
    bundle, nodes = bundle[order], nodes[order]
    new = np.ones(len(nodes), bool)
    new[1:] = (bundle[1:] != bundle[:-1]) | (nodes[1:] != nodes[:-1])
    return pd.DataFrame({"bundle": bundle[new], "lead": lead[order][new], "node": nodes[new], "n": n[order][new].astype(np.int64)})


def _best(pairs: DataFrame) -> DataFrame:
    """Of directed pairs (x, y, far), each x with its y of least ``far``, as distinct pairs a < b."""
    best = pairs.groupBy("x").agg(F.min(F.struct("far", "y")).alias("at"))
    return best.select(F.least("x", "at.y").alias("a"), F.greatest("x", "at.y").alias("b")).distinct()


def _folded(x: np.ndarray, length: int) -> np.ndarray:
    while x.shape[1] > length:
        x = x[:, : x.shape[1] // 2] ^ x[:, x.shape[1] // 2 :]
    return x


def _apart(bits_a: list[bytes], bits_b: list[bytes], n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """In how many bits the sketches of pairs differ; -1 where these are too many for a link."""
    size_a, size_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (bits_a, bits_b))
    out = np.full(len(n_a), -1, np.int64)
    for la, lb in set(zip(size_a.tolist(), size_b.tolist())):
        of = np.flatnonzero((size_a == la) & (size_b == lb))
        for at in range(0, len(of), 4096):
            part = of[at : at + 4096]
            x = np.frombuffer(b"".join(bits_a[i] for i in part), np.uint8).reshape(len(part), la)
            y = np.frombuffer(b"".join(bits_b[i] for i in part), np.uint8).reshape(len(part), lb)
            low = min(la, lb)
            differ = np.bitwise_count(_folded(x, low) ^ _folded(y, low)).sum(1, dtype=np.int64)
            out[part] = np.where((100 + PERCENT) * differ <= (100 - PERCENT) * (n_a[part] + n_b[part]), differ, -1)
    return out


def _sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, bits_a, bits_b, n_a, n_b, text_a, text_b = batch.columns
        ok = _apart(bits_a.to_pylist(), bits_b.to_pylist(), n_a.to_numpy(), n_b.to_numpy()) >= 0
        yield pa.RecordBatch.from_arrays([x.filter(pa.array(ok)) for x in (a, b, text_a, text_b)], ["a", "b", "text_a", "text_b"])


def _beside(pairs: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) with ``columns`` of both nodes, as <column>_a and <column>_b."""
    for side in ("a", "b"):
        own = rows.select(F.col("node").alias(f"_{side}"), *(F.col(c).alias(f"{c}_{side}") for c in columns))
        pairs = pairs.join(own, F.col(side) == F.col(f"_{side}")).drop(f"_{side}")
    return pairs


def _filter(hashes: DataFrame) -> np.ndarray:
    """A bitmap with the low bits of all ``text_hash``, of a size within FILTER_BITS."""
    bits = _grown(hashes.count(), FILTER_BITS, 3)
    low = (F.col("text_hash").bitwiseAND((1 << bits) - 1) + 1).cast("long")
    parts = hashes.select(F.bitmap_bucket_number(low).alias("part"), F.bitmap_bit_position(low).alias("bit")).groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    # a partition is a job: as few as its size asks for, however many the shuffle has
    for row in parts.coalesce(max(1, 1 << bits >> FILTER_PART)).toLocalIterator():
        piece = np.frombuffer(row["bits"], np.uint8)
        start = (row["part"] - 1) * 4096
        out[start : start + 4096] = piece[: len(out) - start]
    return out


def _wanted_sets(bitmap):
    """Sets of the texts whose hash is in the bitmap; no other text is looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = bitmap.value, set()
        for batch in batches:
            low = batch.column(1).to_numpy() & np.int64(8 * len(wanted) - 1)
            hit = (wanted[low >> 3] >> (low & 7).astype(np.uint8)) & 1 == 1
            for _, _, values, sizes, nodes in _sets(batch.filter(pa.array(hit)), 0):
                stops = np.cumsum(sizes)
                out = []
                for i in np.flatnonzero(sizes > 0):
                    if (node := int(nodes[i])) not in seen:
                        seen.add(node)
                        out.append((node, C.pack(_steps(values[stops[i] - sizes[i] : stops[i]]))))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], ["node", "shingles"])

    return run


def _sets_of(texts: DataFrame, hashes: DataFrame) -> DataFrame:
    """(node, shingles) of the texts with the given hashes, and perhaps of some others."""
    bitmap = texts.sparkSession.sparkContext.broadcast(_filter(hashes))
    sets = texts.mapInArrow(_wanted_sets(bitmap), "node long, shingles binary")
    return C.to_table(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "join-sets")


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, left, right = batch.columns
        keep, last = [], (None, None)
        for x, l, r in zip(a.to_pylist(), left, right):
            if x != last[0]:
                last = (x, _unsteps(C.unpack(l.as_py(), np.uint8)[0]))
            other = _unsteps(C.unpack(r.as_py(), np.uint8)[0])
            both = np.concatenate([last[1], other])
            both.sort(kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            keep.append(100 * common >= PERCENT * (len(both) - common))
        yield pa.RecordBatch.from_arrays([x.filter(pa.array(keep, pa.bool_())) for x in (a, b)], ["a", "b"])


def _links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that are linked: sifted by their bit sketches, then compared shingle by shingle."""
    beside = _beside(pairs, nodes, ["bits", "n", "text_hash"]).select("a", "b", "bits_a", "bits_b", "n_a", "n_b", "text_hash_a", "text_hash_b")
    sifted = C.to_table(beside.mapInArrow(_sift, "a long, b long, text_a long, text_b long"), "join-sifted")
    sets = _sets_of(texts, sifted.select(F.col("text_a").alias("text_hash")).union(sifted.select("text_b")))
    both = _beside(sifted.select("a", "b"), sets, ["shingles"]).select("a", "b", "shingles_a", "shingles_b")
    out = C.to_table(both.mapInArrow(_verified, "a long, b long"), "join-links")
    C.free(sifted, sets)
    return out


# ---------------------------------------------------------------- bundles that span components


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    own = labels.select(F.col("node").alias("_node"), "label")
    return rows.join(own, F.col("node") == F.col("_node"), "left").withColumn("label", F.coalesce("label", "node")).drop("_node")


def _dealt(rows: DataFrame, beside: DataFrame, column: str) -> DataFrame:
    """Rows (bundle, i, j, block, node, label, n, ``column``) of the bundles with more than one
    label, once for each pair of blocks that they are in, those of a pair (bundle, i, j) together.

    A bundle of at most BLOCK_WEIGHT is one block.  Of a larger one, a component with half of the
    weight has blocks of its own, numbered last, which are not paired with each other.
    """
    weight = F.sum(F.col("n") + SET_WEIGHT)
    by_label = rows.groupBy("bundle", "label").agg(weight.alias("weight"))
    shape = by_label.groupBy("bundle").agg(F.max(F.struct("weight", "label")).alias("most"), F.sum("weight").alias("weight"), F.count("*").alias("labels")).where("labels > 1")
    main = (F.col("weight") > BLOCK_WEIGHT) & (2 * F.col("most.weight") >= F.col("weight"))
    blocks = lambda x: F.ceil(x / F.lit(BLOCK_WEIGHT)).cast("int")
    shape = shape.select(
        F.col("bundle").alias("_bundle"),
        F.when(main, F.col("most.label")).alias("main"),
        blocks(F.when(main, F.col("weight") - F.col("most.weight")).otherwise(F.col("weight"))).alias("others"),
        F.when(main, blocks(F.col("most.weight"))).otherwise(0).alias("mains"),
    )
    shape = C.to_table(shape, "join-shape")
    mine, draw = F.coalesce(F.col("label") == F.col("main"), F.lit(False)), F.xxhash64("node")
    rows = rows.join(shape, F.col("bundle") == F.col("_bundle"))
    rows = rows.withColumn("block", F.when(mine, F.col("others") + F.pmod(draw, F.greatest("mains", F.lit(1)))).otherwise(F.pmod(draw, "others")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(mine, F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1)))
    rows = rows.select("bundle", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "label", "n")
    own = beside.select(F.col("node").alias("_node"), column)
    rows = rows.join(own, F.col("node") == F.col("_node")).drop("_node")
    parts = max(1, rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(parts, "bundle", "i", "j").sortWithinPartitions("bundle", "i", "j")


class _Meeting:
    """The sets of a pair of blocks: those of the first one, and those they are held against."""

    def __init__(self, batches: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(batches)
        column = lambda k: rows.column(k).to_numpy()
        i, j, block = column("i")[0], column("j")[0], column("block")
        self.bundle, self.node, self.label, self.n = rows.column("bundle")[0].as_py(), column("node"), column("label"), column("n")
        self.left = np.flatnonzero(block == i)
        self.right = self.left if i == j else np.flatnonzero(block == j)
        self.data = rows.column(7)

    def able(self, labels: np.ndarray) -> np.ndarray:
        """Whether labels differ and sizes allow a link, for left by right."""
        a, b = self.n[self.left][:, None], self.n[self.right][None, :]
        return (labels[self.left][:, None] != labels[self.right][None, :]) & (100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b))


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[_Meeting]:
    """Rows sorted by (bundle, i, j), as one meeting for each."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)], 1)
        cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1), len(key)]
        for a, b in zip(cuts, cuts[1:]):
            if held and (key[a] != last).any():
                yield _Meeting(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key[a]
    if held:
        yield _Meeting(held)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members (bundle, node) that, by their bit sketches, may have a link to another component."""
    for m in _meetings(batches):
        able = m.able(m.label)
        if not able.any():
            continue
        bits = [x.as_buffer() for x in m.data]
        size = np.fromiter((x.size for x in bits), np.int64, len(bits))
        left_hit, right_hit = np.zeros(len(m.left), bool), np.zeros(len(m.right), bool)

        def sketch(of: np.ndarray, length: int, low: int) -> np.ndarray:
            """Sketches of one length, folded to ``low`` bytes, as +1 and -1."""
            x = np.frombuffer(b"".join(bits[k] for k in of), np.uint8).reshape(len(of), length)
            return 1 - 2 * np.unpackbits(_folded(x, low), axis=1).astype(np.float32)

        for la in np.unique(size[m.left]):
            for lb in np.unique(size[m.right]):
                x, y = np.flatnonzero(size[m.left] == la), np.flatnonzero(size[m.right] == lb)
                low = int(min(la, lb))
                if max(la, lb) > 2 * low or not able[np.ix_(x, y)].any():
                    continue
                p, q = sketch(m.left[x], int(la), low), sketch(m.right[y], int(lb), low)
                differ = (8 * low - p @ q.T) / 2
                fit = able[np.ix_(x, y)] & ((100 + PERCENT) * differ <= (100 - PERCENT) * (m.n[m.left[x]][:, None] + m.n[m.right[y]][None, :]))
                left_hit[x] |= fit.any(axis=1)
                right_hit[y] |= fit.any(axis=0)
        hit = np.union1d(m.left[left_hit], m.right[right_hit])
        if len(hit):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hit), m.bundle)), pa.array(m.node[hit])], ["bundle", "node"])


def _in_common(m: _Meeting) -> np.ndarray:
    """How many shingles the left sets share with the right ones."""
    sets = [_unsteps(C.unpack(x.as_py(), np.uint8)[0]) for x in m.data]
    count = np.fromiter(map(len, sets), np.int64, len(sets))
    owner = np.repeat(np.arange(len(sets)), count)
    values, column, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = many > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(m.left), len(m.right)), np.float32)
    width = int(shared.sum())
    for at in range(0, width, COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        has = np.zeros((len(sets), min(COLUMNS, width - at)), np.float32)
        has[owner[a:b], column[a:b] - at] = 1
        out += has[m.left] @ has[m.right].T
    return out.astype(np.int64)


def _joining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) between components' first members: only such as join what no earlier link of
    the task has joined, so fewer than the task has components."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := above.get(x, x)) != x:
            above[x] = x = above.get(y, y)
        return x

    for m in _meetings(batches):
        labels = np.fromiter(map(root, m.label.tolist()), np.int64, len(m.label)) if above else m.label
        able = m.able(labels)
        if not able.any():
            continue
        common = _in_common(m)
        total = m.n[m.left][:, None] + m.n[m.right][None, :] - common
        x, y = np.nonzero(able & (100 * common >= PERCENT * total))
        ends = np.unique(np.stack([labels[m.left[x]], labels[m.right[y]]], 1), axis=0)
        out = []
        for a, b in ends.tolist():
            a, b = root(a), root(b)
            if a != b:
                above[max(a, b)] = min(a, b)
                out.append((a, b))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(z, pa.int64()) for z in zip(*out)], ["a", "b"])


def _across(bundles: DataFrame, labels: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links that join components within bundles."""
    named = C.to_table(_labelled(bundles.select("bundle", "node", "n"), labels), "join-named")
    near = C.to_table(_dealt(named, nodes, "bits").mapInArrow(_near, "bundle long, node long").distinct(), "join-near")
    rows = C.to_table(named.join(near, ["bundle", "node"], "left_semi"), "join-open")
    hashes = nodes.join(near.select("node"), "node", "left_semi").select("text_hash")
    sets = _sets_of(texts, hashes)
    out = C.to_table(_dealt(rows, sets, "shingles").mapInArrow(_joining, "a long, b long").distinct(), "join-links")
    C.free(named, near, rows, sets)
    return out


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's class under links of similar 5-word shingle sets: (doc_id, n_shingles,
    component_id, text_hash).

    Links are exact up to hashes (see above): 100 * intersection >= 75 * union, so a tie at 75 links.
    ``component_id`` is the smallest id that can be reached by links.  Null, empty and blank texts
    have no shingles and link with nothing, not even each other; a null id is never the smallest, so
    it stands only for classes without another.  Repeated rows are linked as equal texts are.  Long
    texts are read whole.  An empty table gives no rows; other columns, whatever their names, are
    not read.
    """
    return _classes(docs, id_col, text_col).drop("label")


def _classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The columns of ``jaccard_components`` and ``label``, which names the class."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.xxhash64(F.col(text_col)).alias("text_hash"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    texts = rows.select("text", "text_hash")
    members = C.to_table(rows.mapInArrow(_nodes, f"doc_id {kind}, text_hash long, node long, n long, bits binary"), "join-members")
    nodes = C.to_table(members.where("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.first("bits").alias("bits"), F.min("text_hash").alias("text_hash")), "join-nodes")
    total = members.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranks = _value_counts(texts.select("text"), _grown(total, COUNT_BITS, -6))
    commonness = spark.sparkContext.broadcast((ranks, _hot_rank()))
    buckets = max(1, int(total * 0.5 / BUCKET_VALUES) + 1)
    packed = texts.select("text").mapInArrow(_bucketed(buckets, commonness), "bucket int, short int, payload binary")
    found = packed.groupBy("bucket").applyInPandas(_bundles, "bundle long, lead long, node long, n long")
    if ranks.max() >= _hot_rank():
        found = found.unionByName(_hot_bundles(texts.select("text"), commonness))
    bundles = C.to_table(found.distinct(), "join-bundles")
    led = bundles.where(F.col("node") != F.col("lead")).select(F.col("node").alias("x"), F.col("lead").alias("y"), F.xxhash64("lead").alias("far"))
    tried = C.to_table(_best(led), "join-pairs")
    links = _links(tried, nodes, texts)
    labels = C.to_table(components(links), "join-labels")
    more = _across(bundles, labels, nodes, texts)
    if not more.isEmpty():
        labels = C.to_table(merged(labels, more), "join-labels")
    placed = C.to_table(_labelled(members.drop("bits"), labels), "join-placed")
    least = C.to_table(placed.where("n > 0").groupBy(F.col("label").alias("_label")).agg(F.min("doc_id").alias("least")), "join-least")
    C.free(members, nodes, bundles, tried, links, more, labels)
    out = placed.join(least, (F.col("label") == F.col("_label")) & (F.col("n") > 0), "left")
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "text_hash", "label")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each class, that with the least (id, text hash), nulls last.

    Texts without words (null, empty, blank) are in no class and all stay.  Of repeated rows one
    stays; an empty table stays empty; other columns stay as they are, whatever their names.
    """
    found = C.to_table(_classes(docs, id_col, text_col).where("n_shingles > 0"), "join-classes")
    least = found.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("least"))
    ident, text_hash, mine = C.fresh(docs.columns, "id", "hash", "text_hash")
    kept = C.to_table(least.select(F.col("least.doc_id").alias(ident), F.col("least.text_hash").alias(text_hash)), "join-kept")
    rows = docs.withColumn(mine, F.xxhash64(F.col(text_col)))
    worded = F.coalesce(F.col(text_col).rlike(C.WORD), F.lit(False))
    same = F.col(id_col).eqNullSafe(F.col(ident)) & (F.col(mine) == F.col(text_hash))
    stay = rows.where(worded).join(kept, same, "left_semi")
    repeated = found.join(kept, F.col("doc_id").eqNullSafe(F.col(ident)) & (F.col("text_hash") == F.col(text_hash)), "left_semi").groupBy("doc_id", "text_hash").count().where("count > 1")
    if not repeated.isEmpty():
        stay = stay.dropDuplicates([id_col, mine])
    return stay.unionByName(rows.where(~worded)).drop(mine)
