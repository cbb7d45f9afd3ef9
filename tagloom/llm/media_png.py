"""PNG pictures in binary columns: a lossless writer, a checking reader and cosine-transform hashes.

The writer gives each row the filter that leaves the fewest different values, with a bias towards
differences.  The reader undoes
filters in numpy along diagonals: a pixel depends on those to its left, above and above left, so all
pixels of one diagonal, in all pictures of a batch, are restored together.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Fixed values of the PNG format: signature, and samples to a pixel by colour type (8 bits each).
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}

#: A text's bytes lie in rows of 64 red-green-blue pixels.
ROW_BYTES, WIDTH = 192, 64
#: Compressed bytes to a data chunk; side of the picture that is transformed, and of the part kept.
CHUNK, SIDE, KEPT = 1 << 16, 32, 8
#: What a value left by each filter counts: differences half, as they lie close together.
VALUE_COST = (1.0, 0.5, 0.5, 0.5, 0.5)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(body, zlib.crc32(kind)))


def _paeth(left: np.ndarray, up: np.ndarray, corner: np.ndarray) -> np.ndarray:
    """The neighbour nearest to left + up - corner; of equals the first in this order (int16 arrays)."""
    a, b, c = abs(up - corner), abs(left - corner), abs(left + up - 2 * corner)
    return np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))


def filtered(rows: np.ndarray, first: np.ndarray, bpp: int, kind: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Filter kinds and filtered rows of stacked pictures; ``first`` marks a picture's first row.

    Without a ``kind``, each row has the one that leaves the fewest different values, of equals the
    lowest: what matters for text is how few symbols are left, not how small they are.
    """
    wide = np.zeros((len(rows) + 1, rows.shape[1] + bpp), np.int16)
    wide[1:, bpp:] = rows
    left, up, corner = wide[1:, :-bpp], np.where(first[:, None], 0, wide[:-1, bpp:]), np.where(first[:, None], 0, wide[:-1, :-bpp])
    expected = (np.zeros_like(left), left, up, (left + up) >> 1, _paeth(left, up, corner))
    if kind is not None:
        return np.full(len(rows), kind, np.uint8), (rows - expected[kind]).astype(np.uint8)
    tried = np.stack([(rows - e).astype(np.uint8) for e in expected])
    left_over = np.empty(tried.shape[:2])
    for k, cost in enumerate(VALUE_COST):
        seen = np.zeros((len(rows), 256), bool)
        seen.ravel()[(tried[k] + (np.arange(len(rows)) << 8)[:, None]).ravel()] = True
        left_over[k] = cost * seen.sum(axis=1)
    kinds = left_over.argmin(axis=0)
    return kinds.astype(np.uint8), tried[kinds, np.arange(len(rows))]


def unfiltered(kinds: np.ndarray, rows: np.ndarray, heights: np.ndarray, bpp: int) -> np.ndarray:
    """Undoes the row filters of stacked pictures of equal width and the given heights."""
    if len(kinds) and kinds.max() > 4:
        raise ValueError(f"unknown row filter {kinds.max()}")
    total, pixels = len(rows), rows.shape[1] // bpp
    y = np.arange(total) - np.repeat(np.cumsum(heights) - heights, heights)
    order = np.argsort(y, kind="stable")  # rows of like height together, so a diagonal is a range
    place = np.empty(total, np.int64)
    place[order] = np.arange(total)
    y = y[order]
    above = np.where(y > 0, place[order - 1], total)  # of a first row, the row of zeros at the end
    line = rows[order].reshape(total * pixels, bpp).astype(np.int16)
    kind = kinds[order][:, None]
    wide = pixels + 1  # a pixel of zeros ahead of each row
    out = np.zeros(((total + 1) * wide, bpp), np.int16)
    tallest = int(heights.max()) if len(heights) else 0
    bounds = np.searchsorted(y, np.arange(tallest + 1))
    for d in range(tallest + pixels - 1):
        lo, hi = bounds[max(0, d - pixels + 1)], bounds[min(tallest, d + 1)]
        if lo == hi:
            continue
        r, x, k = np.arange(lo, hi), d - y[lo:hi], kind[lo:hi]
        to, over = r * wide + x, above[lo:hi] * wide + x
        left, up, corner = out[to], out[over + 1], out[over]
        expected = np.where(k == 1, left, np.where(k == 2, up, np.where(k == 3, (left + up) >> 1, np.where(k == 4, _paeth(left, up, corner), 0))))
        out[to + 1] = (line[r * pixels + x] + expected) & 255
    return out.reshape(total + 1, wide * bpp)[place, bpp:].astype(np.uint8)


def _file(kinds: np.ndarray, rows: np.ndarray, channels: int, level: int = 4) -> bytes:
    """The bytes of a picture from its filtered rows."""
    data = zlib.compress(np.concatenate([kinds[:, None], rows], axis=1).tobytes(), level)
    colour = next(k for k, n in CHANNELS.items() if n == channels)
    parts = [SIGNATURE, _chunk(b"IHDR", struct.pack(">IIBBBBB", rows.shape[1] // channels, len(rows), 8, colour, 0, 0, 0))]
    parts += [_chunk(b"IDAT", data[i : i + CHUNK]) for i in range(0, len(data), CHUNK)]
    return b"".join([*parts, _chunk(b"IEND", b"")])


def encode_png(samples: np.ndarray, filter_kind: int | None = None) -> bytes:
    """A picture of (height, width, channels) 8-bit samples; each row has its best filter, or the given one."""
    height, width, channels = samples.shape
    kinds, rows = filtered(samples.reshape(height, width * channels), np.arange(height) == 0, channels, filter_kind)
    return _file(kinds, rows, channels)


def opened(data: bytes) -> tuple[np.ndarray, int]:
    """Filtered lines, each behind its filter's number, and samples to a pixel of a non-interlaced
    8-bit picture; every chunk's checksum is tested, and damage raises ValueError."""
    if data[:8] != SIGNATURE:
        raise ValueError("no PNG signature")
    at, head, body, ended = 8, None, [], False
    while at + 12 <= len(data) and not ended:
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        content, crc = data[at + 8 : at + 8 + n], data[at + 8 + n : at + 12 + n]
        if len(crc) < 4 or zlib.crc32(content, zlib.crc32(kind)) != struct.unpack(">I", crc)[0]:
            raise ValueError(f"checksum of {kind!r}")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", content)
        elif kind == b"IDAT":
            body.append(content)
        ended = kind == b"IEND"
        at += 12 + n
    if head is None or not ended or head[2] != 8 or head[3] not in CHANNELS or head[6]:
        raise ValueError("unfinished or unsupported PNG")
    width, height, channels = head[0], head[1], CHANNELS[head[3]]
    return np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, width * channels + 1), channels


def decode_pngs(files: list[bytes]) -> list[np.ndarray]:
    """Samples (height, width, channels) of each picture; those of one width and kind are undone together."""
    found = [opened(x) for x in files]
    out: list[np.ndarray] = [np.zeros((0, 0, 0), np.uint8)] * len(files)
    for width, channels in {(x.shape[1] - 1, c) for x, c in found}:
        of = [i for i, (x, c) in enumerate(found) if (x.shape[1] - 1, c) == (width, channels)]
        heights = np.array([len(found[i][0]) for i in of])
        lines = np.concatenate([found[i][0] for i in of])
        rows = unfiltered(lines[:, 0], lines[:, 1:], heights, channels)
        for i, part in zip(of, np.split(rows, np.cumsum(heights)[:-1])):
            out[i] = part.reshape(len(part), width // channels, channels)
    return out


def decode_png(data: bytes) -> np.ndarray:
    """Samples (height, width, channels) of one picture."""
    return decode_pngs([data])[0]


def _cosines() -> np.ndarray:
    k, x = np.mgrid[:KEPT, :SIDE]
    return np.cos(np.pi * k * (2 * x + 1) / (2 * SIDE))


_COSINES = _cosines()


def _shrunk(x: np.ndarray) -> np.ndarray:
    """Means of SIDE even slices along the first axis (a short axis is repeated)."""
    cuts = np.arange(SIDE + 1) * len(x) // SIDE
    if len(x) < SIDE:
        return x[np.arange(SIDE) * len(x) // SIDE]
    return np.add.reduceat(x, cuts[:-1], axis=0) / np.diff(cuts).reshape(-1, *[1] * (x.ndim - 1))


def cosine_hash(samples: np.ndarray) -> str:
    """64 bits in hex: which low frequencies of the shrunken grey picture exceed their median."""
    grey = _shrunk(_shrunk(samples.mean(axis=2)).T).T
    low = (_COSINES @ grey @ _COSINES.T).round(6)
    bits = (low > np.median(low.ravel()[1:])).ravel()
    return np.packbits(bits).tobytes().hex()


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = C.text_buffers(batch.column(1))
        for start, stop in C.pieces(offsets):
            sizes = np.diff(offsets[start : stop + 1])
            heights = np.maximum(1, -(-sizes // ROW_BYTES))
            last = np.cumsum(heights)
            samples = np.full(int(last[-1]) * ROW_BYTES, 32, np.uint8)
            for i, (n, end, height) in enumerate(zip(sizes, last, heights)):
                at = (end - height) * ROW_BYTES
                samples[at : at + n] = data[offsets[start + i] : offsets[start + i + 1]]
            first = np.zeros(int(last[-1]), bool)
            first[last - heights] = True
            kinds, rows = filtered(samples.reshape(-1, ROW_BYTES), first, 3)
            media = [_file(kinds[b - h : b], rows[b - h : b], 3) for b, h in zip(last, heights)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    for batch in batches:
        sizes = np.concatenate([[0], np.cumsum(batch.column(1).to_numpy())])  # of the texts, not of the files
        for start, stop in C.pieces(sizes):
            files = [x.as_py() for x in batch.column(2).slice(start, stop - start)]
            out = []
            for media, samples in zip(files, decode_pngs(files)):
                payload = samples.tobytes()
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), cosine_hash(samples)))
            own = [batch.column(i).slice(start, stop - start) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(x, k) for x, k in zip(zip(*out), kinds))], ["doc_id", "n_bytes", *names])


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text as a picture: (doc_id, n_bytes, media).

    The UTF-8 bytes, filled with spaces to a positive multiple of 192, are the samples.  Null counts
    as empty (one row of spaces); a very long text is one tall picture; repeated rows and null ids
    stay; an empty table gives no rows; other columns, whatever their names, are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_store, f"doc_id {kind}, n_bytes long, media binary")


def read_features(media: DataFrame) -> DataFrame:
    """Digests and features of what ``store_texts`` stored, from the stored bytes alone."""
    kind = media.schema["doc_id"].dataType.simpleString()
    return media.select("doc_id", "n_bytes", "media").mapInArrow(_read, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
