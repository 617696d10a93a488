"""Helpers shared by the operators: table access, written tables, text kernels.

Text kernels work on the UTF-8 bytes of an Arrow string column, a bounded
number of bytes at a time, so no Python object is made per word.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text handled at once by the numpy kernels.
CHUNK_BYTES = 1 << 20

WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session;
    only a local session without it (tests) gets a folder of its own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder on shared storage")
    path = tempfile.mkdtemp(prefix="llm-shared-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    return path


_written: list[str] = []


def track(folder: str, name: str) -> str:
    """``folder/name``, for a working table in a folder that :func:`recorded` reports."""
    _written.append(folder)
    return f"{folder}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, and
    a lost executor costs a re-read, not a recomputation."""
    path = track(f"{shared_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}", name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """Collects the folders that ``stored`` writes inside the block."""
    first, paths = len(_written), []
    yield paths
    paths += _written[first:]


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders of ``stored``; for callers that have written the results that were read from them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)


#: Rows of an Arrow batch in :func:`small_batches`.
BATCH_ROWS = 512
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside the block hand Python workers rows in batches of at most
    ``BATCH_ROWS``: rows here hold whole texts or arrays, of which the default of 10,000
    fills both sides' buffers. Batches never change a result."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


#: Bits of a hash filter, unless a caller asks for others.
FILTER_BITS = 1 << 23


def filter_bit(col, bits: int = FILTER_BITS):
    return F.pmod(F.xxhash64(col), F.lit(bits)).cast("int")


def hash_filter(keys: DataFrame, name: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap of the hashes of a column, ``bits`` long: a row whose bit isn't set
    has no equal in it. Rows that can't match are left out before a shuffle."""
    bit = keys.select(filter_bit(F.col(name), bits).alias("b"))
    words = bit.groupBy((F.col("b") / 32).cast("int").alias("w")).agg(F.expr("bit_or(shiftleft(1L, b % 32))").alias("v"))
    return filled(words, bits // 32)


def filled(words: DataFrame, n: int) -> np.ndarray:
    """``n`` 32-bit words, 0 where the columns w (place) and v (word) name none.
    Fetched as Arrow: a Row object for each of them would take the driver far more memory."""
    found = words.select("w", "v").toArrow()
    out = np.zeros(n, np.uint32)
    out[found.column("w").to_numpy()] = found.column("v").to_numpy().astype(np.uint32)
    return out


def in_filter(bitmap: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (bitmap[bits >> 5] >> (bits & 31).astype(np.uint32)) & 1 == 1


def with_fields(df: DataFrame, ddl: str) -> StructType:
    """The schema of ``df`` and further fields."""
    return StructType(df.schema.fields + StructType.fromDDL(ddl).fields)


def lower_ascii(col):
    return F.translate(col, UPPER, LOWER)


def text_or_empty(col):
    return F.coalesce(col, F.lit(""))


# --- byte kernels ---------------------------------------------------------

_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUES = _rng.integers(0, 2**64, 256, dtype=np.uint64, endpoint=False)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser (bijective on 64 bits)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^i modulo 2^64 for i < n, not to be written to: those of a chunk of text are kept."""
    kept = _powers.get(int(base))
    if kept is not None and n <= len(kept):
        return kept[:n]
    size = CHUNK_BYTES + 1
    run = np.full(max(n, size), base, np.uint64)
    run[0] = 1
    run = np.cumprod(run, dtype=np.uint64)
    if n <= size:
        run.flags.writeable = False
        _powers[int(base)] = run
    return run[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with hash(data[s:e]) = (H[e] - H[s]) * BASE^-s, all modulo 2^64."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers(BASE, len(data)), dtype=np.uint64, out=out[1:])
    return out


def texts_of(batch: pa.RecordBatch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    col = batch.column(batch.schema.get_field_index(name))
    if not (pa.types.is_string(col.type) or pa.types.is_large_string(col.type)):
        col = col.cast(pa.string())
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offsets, values = col.buffers()
    if offsets is None or len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(offsets, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def chunks(data: np.ndarray, offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole rows of about ``limit`` bytes; a longer row comes alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and each row's first word (len rows + 1). Words don't cross rows."""
    mask = is_word[data]
    before = np.empty(len(mask), bool)
    if len(mask):
        before[0] = False
        before[1:] = mask[:-1]
        cut = offsets[1:-1]
        before[cut[cut < len(mask)]] = False
    starts = np.flatnonzero(mask & ~before)
    after = np.empty(len(mask), bool)
    if len(mask):
        after[-1] = False
        after[:-1] = mask[1:]
        cut = offsets[1:-1]
        after[cut[cut > 0] - 1] = False
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, limit: int = 4 * CHUNK_BYTES) -> np.ndarray:
    """64-bit hash of the bytes of each span; spans ascend and don't overlap."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        base = int(starts[lo])
        hi = max(lo + 1, int(np.searchsorted(ends, base + limit, "right")))
        part = data[base : int(ends[hi - 1])]
        run = prefix_hash(part)
        s, e = starts[lo:hi] - base, ends[lo:hi] - base
        down = powers(BASE_INVERSE, len(part) + 1)
        out[lo:hi] = mix64((run[e] - run[s]) * down[s] + (e - s).astype(np.uint64))
        lo = hi
    return out


def windows_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes (len - n + 1 of them)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:m].copy()
    for k in range(1, n):
        out = mix64(out * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + m])
    return out


def sequence_hash(hashes: np.ndarray) -> np.uint64:
    out = hashes[:1].copy()
    for k in range(1, len(hashes)):
        out = mix64(out * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + 1])
    return out[0]
