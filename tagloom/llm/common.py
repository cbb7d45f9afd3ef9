"""What the corpus operators share: scratch tables, byte-level tokenising, packed arrays."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but these bytes.
WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes that a Python task turns into arrays at a time (a longer document stands alone).
CHUNK_BYTES = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


# ---------------------------------------------------------------- scratch tables


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share; a temporary one where it
    is unset and the session runs on one machine, such as in a test."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tagloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it goes when the driver ends, if not before."""
    path = f"{shared_dir(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"
    atexit.register(drop_path, spark, path)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session may be gone
        pass


@contextlib.contextmanager
def tidy(spark: SparkSession):
    """Executions within leave no shuffle files behind when they end."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def to_table(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with tidy(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_at = path
    return out


def free(*tables: DataFrame) -> None:
    """Deletes tables of ``to_table`` whose last reader has run."""
    for df in tables:
        drop_path(df.sparkSession, df.scratch_at)


def fresh(names: list[str], *wanted: str) -> list[str]:
    """The wanted column names, each with as many underscores ahead as make it new among ``names``."""
    taken, out = {x.lower() for x in names}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(ident: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; -1 for a null id."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % F.lit(mod), F.lit(-1))


def word_count(text: Column) -> Column:
    """Words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# ---------------------------------------------------------------- tokens as hashes


def separators(extra: str = "") -> np.ndarray:
    """A table of 256 flags, true at white space and at the ASCII characters of ``extra``."""
    out = np.zeros(256, bool)
    out[[0x20, *range(0x09, 0x0E), *extra.encode("ascii")]] = True
    return out


SPACES = separators()
#: White space and all ASCII punctuation, for matching that forgives changed punctuation.
NOT_WORDY = separators("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _power(which: int, n: int) -> np.ndarray:
    if len(_powers[which]) < n:
        steps = np.full(max(n, 1 << 16), (_MULTIPLIER, _INVERSE)[which], np.uint64)
        steps[0] = 1
        _powers[which] = np.multiply.accumulate(steps)
    return _powers[which]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (the splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hash_tokens(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all tokens, ASCII letters lower-cased, and how many each document has.

    ``data`` holds the documents' UTF-8 bytes, ``offsets`` (n + 1) where they begin and end.  A
    token's hash is a polynomial in its bytes, taken from one running sum over all bytes.
    """
    base = int(offsets[0])
    data = data[base : int(offsets[-1])]
    at = (offsets - base).astype(np.int64)
    docs, size = len(at) - 1, len(data)
    if not size:
        return np.zeros(0, np.uint64), np.zeros(docs, np.int64)
    inside = ~sep[data]
    edge = np.zeros(size + 1, bool)  # a document starts here
    edge[at] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:size]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:size]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends)
    running = np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * _power(0, size)[:size], dtype=np.uint64)
    value = running[last]
    before = first > 0
    value[before] -= running[first[before] - 1]
    value *= _power(1, size)[first]
    value = mix(value + (last - first + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return value, np.diff(np.searchsorted(first, at))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def pieces(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Consecutive row ranges of at most ``limit`` bytes each, or of one row."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(n, max(start + 1, stop))
        yield start, stop
        start = stop


def gather_batches(batches, column: str, limit: int):
    """Arrow batches cut or joined into tables of about ``limit`` text bytes."""
    held, size = [], 0
    for batch in batches:
        at = batch.schema.get_field_index(column)
        _, offsets = text_buffers(batch.column(at))
        for start, stop in pieces(offsets, limit):
            nbytes = int(offsets[stop] - offsets[start])
            if held and size + nbytes > limit:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
            held.append(batch.slice(start, stop - start))
            size += nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def only_chunk(table_: pa.Table, name: str) -> pa.Array:
    column = table_.column(name)
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


# ---------------------------------------------------------------- packed arrays


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed byte string."""
    raw = b"".join(len(x).to_bytes(8, "little") + np.ascontiguousarray(x).tobytes() for x in arrays)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for kind in kinds:
        n = int.from_bytes(raw[at : at + 8], "little")
        out.append(np.frombuffer(raw, kind, n, at + 8))
        at += 8 + n * np.dtype(kind).itemsize
    return out


def planes(x: np.ndarray) -> np.ndarray:
    """Unsigned integers as their bytes, all lowest ones first: what is small packs to little."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).ravel()


def unplanes(x: np.ndarray, kind) -> np.ndarray:
    return np.ascontiguousarray(x.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


# ---------------------------------------------------------------- counts in a table of fixed size

#: Bits of a slice of the table when it is summed.
SLICE_BITS = 14
COUNTED = "slice int, payload binary"


def count_slices(counts: np.ndarray) -> pa.RecordBatch:
    """A task's counts (2**bits, unsigned 32 bits) as rows of COUNTED."""
    slices = counts.reshape(-1, 1 << SLICE_BITS)
    return pa.RecordBatch.from_arrays([pa.array(range(len(slices)), pa.int32()), pa.array([pack(x) for x in slices], pa.binary())], ["slice", "payload"])


def _sum_slice(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(1 << SLICE_BITS, np.int64)
    for x in pdf["payload"]:
        total += unpack(x, np.uint32)[0]
    return pd.DataFrame({"slice": [int(pdf["slice"].iloc[0])], "payload": [np.floor(2 * np.log2(total + 1)).astype(np.uint8).tobytes()]})


def half_octaves(counted: DataFrame, bits: int) -> np.ndarray:
    """The sums of COUNTED rows as a byte for each cell: twice the logarithm of one more, rounded down."""
    parts = counted.groupBy("slice").applyInPandas(_sum_slice, COUNTED)
    out = np.zeros((1 << (bits - SLICE_BITS), 1 << SLICE_BITS), np.uint8)
    with tidy(counted.sparkSession):
        for row in parts.collect():
            out[row["slice"]] = np.frombuffer(row["payload"], np.uint8)
    return out.ravel()
