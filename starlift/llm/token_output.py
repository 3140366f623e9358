"""Token-ID output: training-order materialisation.

Every document becomes token ids plus an end id, cut into sequences of SEQUENCE ids. All sequences have a number: the
documents in order of their key, the sequences of one in order. A keyed Feistel permutation over the next power of
four, walked along its cycle until it falls below the number of sequences, turns the number into a global slot; it is a
bijection, can be inverted, and needs only key and count. Documents that come with a place of their own (the order of a
mix) are numbered by it, and permuted within windows of so many sequences, so each window of slots keeps its share of
every source. Slots are dense, so slot ranges are equal range partitions,
with no sampling pass: partition p holds the slots [p * STRIDE_SLOTS, ...) of whole shards in order, each record of
the same width. A reader finds slot s in shard s // SHARD_SLOTS at record s % SHARD_SLOTS and goes on from there.

Token ids are made once, compressed, and written to the shared folder; what follows moves only those. Defined results:
null text counts as empty and gives one sequence holding the end id; equal rows are numbered one after the other;
null ids come first; an empty table gives no sequences.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starlift.llm.common import bounded_batches, mix64, written
from starlift.llm.token_counts import encode, encoding

SEQUENCE = 512
#: Slots of one shard.
SHARD_SLOTS = 4096
KEY = 20240607
ROUNDS = 6


def _round(half: np.ndarray, key: np.ndarray, r: int, bits: int) -> np.ndarray:
    salt = key * np.uint64(0x9E3779B97F4A7C15) + np.uint64((r * 0xD1B54A32D192ED03 + 1) % 2**64)
    return mix64(half + salt) & np.uint64((1 << bits) - 1)


def _feistel(x: np.ndarray, key: np.ndarray, bits: int, back: bool) -> np.ndarray:
    mask = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & mask
    for r in (range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)):
        if back:
            left, right = right ^ _round(left, key, r, bits), left
        else:
            left, right = right, left ^ _round(right, key, r, bits)
    return (left << np.uint64(bits)) | right


def permute(x: np.ndarray, n: int, key: int | np.ndarray = KEY, back: bool = False) -> np.ndarray:
    """Slot of each number below ``n`` (or, ``back``, the number of each slot): cycle-walking stays below n.

    ``key``: one for all, or one for each number.
    """
    x = np.asarray(x, np.uint64)
    key = np.broadcast_to(np.atleast_1d(np.asarray(key)).astype(np.uint64), x.shape)
    bits = max(1, -(-max(1, int(n) - 1).bit_length() // 2))
    out = _feistel(x, key, bits, back)
    while (far := np.flatnonzero(out >= np.uint64(n))).size:
        out[far] = _feistel(out[far], key[far], bits, back)
    return out.astype(np.int64)


def permute_windows(x: np.ndarray, n: int, window: int, key: int = KEY) -> np.ndarray:
    """Slot of each number below ``n``, permuted within windows of so many numbers, each with a key of its own."""
    x = np.asarray(x, np.int64)
    at, out = x // window, np.empty(len(x), np.int64)
    for these, size in ((at < n // window, window), (at == n // window, n % window)):
        if these.any():
            out[these] = at[these] * window + permute(x[these] % window, size, key + at[these])
    return out


def _tokenise(path: str, sequence: int, end_id: int):
    def run(batches):
        enc, pack = encoding(path), zstandard.ZstdCompressor(level=1)
        for b in batches:
            sizes, blobs = [], []
            for x in b.column("text"):
                ids = np.asarray([*encode(enc, x.as_py()), end_id], "<u4" if enc.n_vocab > 65536 else "<u2")
                sizes.append(len(ids))
                blobs.append(pack.compress(ids.tobytes()))
            yield pa.RecordBatch.from_arrays([b.column("place"), b.column("doc_id"), b.column("tie"), pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary())],
                                             names=["place", "doc_id", "tie", "n_ids", "ids"])
    return run


def numbered(rows: DataFrame, sequence: int) -> tuple[DataFrame, int]:
    """``row`` -> number of its first sequence, in order of (place, doc_id, tie, row), and the number of sequences.

    A range-sorted copy is written, its partitions counted, and the counts summed up before each: no window over
    all rows, and what is summed is a row per partition.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = rows.select("place", "doc_id", "tie", "row", F.expr(f"(n_ids + {sequence - 1}) div {sequence}").alias("k"))
    kept = written(narrow.repartitionByRange(n, "place", "doc_id", "tie", "row").sortWithinPartitions("place", "doc_id", "tie", "row")
                   .withColumn("at", F.monotonically_increasing_id()), "order").withColumn("part", F.shiftright("at", 33))
    sums = kept.groupBy("part").agg(F.sum("k").alias("n"))
    inner = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("zero"))
    total = sums.agg(F.sum("n")).first()[0] or 0
    out = kept.join(F.broadcast(starts), "part")  # a row per range partition
    return out.select("row", (F.col("zero") + F.coalesce(F.sum("k").over(inner), F.lit(0))).alias("first")), int(total)


def _cut(sequence: int, total: int, key: int, width: int, window: int):
    dtype = "<u2" if width == 2 else "<u4"

    def run(batches):
        unpack, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        for b in batches:
            first = b.column("first").to_numpy(zero_copy_only=False)
            rows = []
            for d, f, blob in zip(b.column("doc_id"), first.tolist(), b.column("ids")):
                ids = np.frombuffer(unpack.decompress(blob.as_py()), dtype)
                d = d.as_py()
                for k in range(0, len(ids), sequence):
                    part = ids[k:k + sequence]
                    rows.append((f + k // sequence, d, k // sequence, len(part), pack.compress(part.tobytes())))
            cols = list(zip(*rows)) or [[]] * 5
            slot = permute_windows(np.array(cols[0], np.int64), total, window, key) if rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                                              pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.binary())],
                                             names=["slot", "doc_id", "sequence", "n_ids", "ids"])
    return run


def _records(sequence: int, width: int, pad_id: int, shard_slots: int):
    pad = np.array([pad_id], "<u2" if width == 2 else "<u4").tobytes()

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            records = []
            for blob in b.column("ids"):
                raw = unpack.decompress(blob.as_py())
                records.append(raw + pad * ((sequence * width - len(raw)) // width))
            slot = b.column("slot").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [b.column("slot"), pa.array(slot // shard_slots), pa.array(slot % shard_slots * sequence * width),
                 b.column("doc_id"), b.column("sequence"), b.column("n_ids"), pa.array(records, pa.binary())],
                names=["slot", "shard", "byte_offset", "doc_id", "sequence", "n_ids", "record"])
    return run


def materialise(docs: DataFrame, path: str, key: int = KEY, sequence: int = SEQUENCE, shard_slots: int = SHARD_SLOTS,
                place: str | None = None, window: int | None = None) -> DataFrame:
    """One row per sequence, range-partitioned and sorted by slot.

    slot, shard, byte_offset (of the record in its shard), doc_id, sequence (its number in the document), n_ids,
    record (``sequence`` little-endian ids; the end id fills the rest). ``place``: a column that the documents
    are ordered by; ``window``: sequences permuted among each other, all when None.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    enc = encoding(path)
    end_id, width = max(enc._special_tokens.values()), 4 if enc.n_vocab > 65536 else 2
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       (F.col(f"`{place}`").cast("long") if place else F.lit(0).cast("long")).alias("place")).withColumn("tie", F.xxhash64("text"))
    ids = rows.mapInArrow(_tokenise(path, sequence, end_id), "place long, doc_id long, tie long, n_ids long, ids binary")
    ids = written(ids.withColumn("row", F.monotonically_increasing_id()), "tokens")
    order, total = numbered(ids, sequence)
    cut = ids.select("doc_id", "row", "ids").join(order, "row").select("doc_id", "first", "ids").mapInArrow(
        _cut(sequence, max(1, total), key, width, window or max(1, total)), "slot long, doc_id long, sequence long, n_ids int, ids binary")
    shards = max(1, -(-total // shard_slots))
    n = max(1, min(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    lane = F.expr(f"cast(slot div {shard_slots} * {n} div {shards} as int)")  # whole shards, in order
    placed = cut.withColumn("lane", lane).repartitionById(n, F.col("lane")).sortWithinPartitions("slot").drop("lane")
    return placed.mapInArrow(_records(sequence, width, end_id, shard_slots),
                             "slot long, shard long, byte_offset long, doc_id long, sequence long, n_ids int, record binary")


def write_shards(records: DataFrame, path: str) -> None:
    """Write the records, one folder per shard, each file in slot order; a repeated write replaces whole shards."""
    records.write.mode("overwrite").option("compression", "none").partitionBy("shard").parquet(path)


def read_from(spark: SparkSession, path: str, slot: int, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The records from a slot on, in order: earlier shards are pruned, the first one is entered at its record."""
    return spark.read.parquet(path).where((F.col("shard") >= slot // shard_slots) & (F.col("slot") >= slot)).orderBy("slot")
