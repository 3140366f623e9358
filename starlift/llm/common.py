"""Shared helpers: reading documents, scratch tables on the shared folder, Arrow text buffers and word hashes."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlift.session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Text bytes hashed at once; bounds the working arrays of one Python worker.
SEGMENT_BYTES = 1 << 19
#: Texts of one Arrow batch to a Python worker.
BATCH_ROWS = 1000

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: Byte ranges are hashed as polynomials modulo two primes; modulo a power of two, Thue-Morse words would collide.
_PRIMES = (2**31 - 1, 2**31 - 19)
_BASES = (0x4F1BBCDD, 0x1B873593)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def bounded_batches(spark: SparkSession) -> None:
    """Whole texts go to Python workers in smaller batches than Spark's default."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text) of the whole table; a null text counts as empty."""
    df = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    return texts(df)


def texts(df: DataFrame) -> DataFrame:
    """Only the columns that operators read, whatever else the frame carries."""
    bounded_batches(df.sparkSession)
    return df.select(F.col("doc_id").cast("long").alias("doc_id"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/starlift-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Cut lineage with a table written to the shared folder; lost executors lose nothing of it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete scratch tables whose content nobody reads any more."""
    jvm = spark.sparkContext._jvm
    for df in frames:
        for f in {os.path.dirname(x) for x in df.inputFiles()}:
            p = jvm.org.apache.hadoop.fs.Path(f)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1) and UTF-8 bytes of an Arrow string or binary array without nulls, without a copy."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    large = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64 if large else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets, raw


def mix64(h: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS: dict[tuple[int, int], np.ndarray] = {}


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """Powers 0 to n - 1 of ``base`` modulo ``prime``; n is a power of two."""
    if (base, n) not in _POWERS:
        p = np.ones(n, np.uint64)
        k = 1
        while k < n:
            p[k:2 * k] = p[:k] * np.uint64(pow(base, k, prime)) % np.uint64(prime)
            k *= 2
        _POWERS[base, n] = p
    return _POWERS[base, n]


def byte_digests(seg: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges of one segment (at most 4 * SEGMENT_BYTES long)."""
    n = 1 << max(10, len(seg).bit_length())
    letter = seg.astype(np.uint64) + np.uint64(1)
    out = np.zeros(len(starts), np.uint64)
    total = np.zeros(len(seg) + 1, np.uint64)
    for base, prime in zip(_BASES, _PRIMES):
        np.cumsum(letter * _powers(base, prime, n)[:len(seg)], out=total[1:])
        own = (total[ends] - total[starts]) % np.uint64(prime) * _powers(pow(base, -1, prime), prime, n)[starts] % np.uint64(prime)
        out = out << np.uint64(32) | own
    return mix64(out + (ends - starts).astype(np.uint64) * _STEP)


def _long_word(raw: np.ndarray) -> np.uint64:
    """``byte_digests`` of one range of any length, piece by piece."""
    h, step, n = 0, SEGMENT_BYTES, len(raw)
    for base, prime in zip(_BASES, _PRIMES):
        own = 0
        for i in range(0, n, step):
            part = raw[i:i + step].astype(np.uint64) + np.uint64(1)
            own += int((part * _powers(base, prime, 2 * step)[:len(part)]).sum(dtype=np.uint64)) % prime * pow(base, i, prime)
        h = h << 32 | own % prime
    return mix64(np.array([(h + n * int(_STEP)) & (2**64 - 1)], np.uint64))[0]


def _hash_segment(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    raw = _FOLD[raw]
    if len(raw) >= 4 * SEGMENT_BYTES:  # a word longer than a segment
        return np.array([_long_word(raw[s:e]) for s, e in zip(starts, ends)], np.uint64)
    return byte_digests(raw, starts, ends)


def word_hashes(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` (A-Z folded) of all texts, and the first word of each text.

    Returns (hashes, bounds): the words of text i are ``hashes[bounds[i]:bounds[i + 1]]``.
    Works segment by segment, so the arrays stay small whatever the length of a text.
    """
    parts, at = [], []
    lo, end = int(offsets[0]), int(offsets[-1])
    cuts = set(offsets.tolist())
    while lo < end:
        hi = min(end, lo + SEGMENT_BYTES)
        while hi < end and hi not in cuts and not _IS_SPACE[raw[hi]]:  # never cut inside a word
            step = raw[hi:hi + 4096]
            gap = np.flatnonzero(_IS_SPACE[step])
            limit = int(offsets[np.searchsorted(offsets, hi, "right")]) if hi < end else end
            hi = min(hi + (int(gap[0]) if len(gap) else len(step)), limit, end)
        seg = raw[lo:hi]
        space = _IS_SPACE[seg]
        edge = np.ones(len(seg) + 1, bool)
        edge[1:-1] = space[:-1]
        inner = offsets[np.searchsorted(offsets, lo, "left"):np.searchsorted(offsets, hi, "right")] - lo
        edge[inner] = True
        starts = np.flatnonzero(edge[:-1] & ~space)
        stop = np.ones(len(seg) + 1, bool)
        stop[:-1] = space
        stop[inner] = True
        ends = np.flatnonzero(stop[1:] & ~space) + 1
        parts.append(_hash_segment(seg, starts, ends))
        at.append(starts + lo)
        lo = hi
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    where = np.concatenate(at)
    return np.concatenate(parts), np.searchsorted(where, offsets, "left")


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of one text (not distinct); fewer words than k: the whole sequence as one."""
    n = len(words)
    if n == 0:
        return words
    width = min(k, n)
    acc = words[:n - width + 1].copy()
    for j in range(1, width):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + words[j:n - width + 1 + j]
    return mix64(acc + np.uint64(width))


def doc_groups(offsets: np.ndarray, limit: int = SEGMENT_BYTES):
    """Runs [i, j) of texts of about ``limit`` bytes together, at least one text each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def long_array(x: np.ndarray) -> pa.Array:
    """int64 view of unsigned hashes for Spark."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def pack_columns(fields, cols: dict) -> bytes:
    """Columns as byte planes, compressed: the planes that barely change cost next to nothing."""
    planes = [np.ascontiguousarray(cols[c], t).view(np.uint8).reshape(-1, np.dtype(t).itemsize).T.tobytes() for c, t in fields]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack_columns(fields, blob: bytes, n: int) -> dict:
    raw, out, at = zstandard.ZstdDecompressor().decompress(blob), {}, 0
    for c, t in fields:
        width = np.dtype(t).itemsize
        out[c] = np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T).reshape(-1).view(t)
        at += n * width
    return out
