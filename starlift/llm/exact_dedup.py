"""Exact dedup: tree-merge of sorted digest runs.

Every scan partition folds its documents into one sorted run of digests per digest range. A run entry holds a
digest, the length of the text, a second independent hash (the verification), the smallest and the largest
identifier, and the row count. Runs of one range then meet in rounds: in round r the runs whose numbers agree after
dropping r * log2(FAN_IN) low bits are merged by one multiway merge, so after ceil(log_FAN_IN(partitions)) rounds one
run per range is left. A hot text is one entry per run from the first step on, so it weighs as much as any other.

Defined results: null text counts as empty; null doc_id rows join their group and never stay unless all ids are
null; equal (doc_id, text) rows count as copies of each other; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlift.llm.common import lower_ascii, texts, written

#: Runs merged at once in a round.
FAN_IN = 16
#: Expected distinct digests in the last run of one range.
RUN_ENTRIES = 1 << 18

_RUN = "part long, run long, digests binary, lengths binary, checks binary, lows binary, highs binary, counts binary"
_NO_ID = np.iinfo(np.int64).min


def _fold(part, run, words, lengths, checks, lows, highs, counts) -> dict:
    """One sorted run out of entries in any order; equal verified keys become one entry."""
    keys = np.column_stack([words, lengths.astype(np.uint64), checks.astype(np.uint64)])
    order = np.lexsort(keys.T[::-1])
    keys, lows, highs, counts = keys[order], lows[order], highs[order], counts[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    at = np.flatnonzero(first)
    kept = keys[at]
    return {"part": part, "run": run, "digests": kept[:, :4].astype(">u8").tobytes(),
            "lengths": kept[:, 4].astype(np.int64).tobytes(), "checks": kept[:, 5].tobytes(),
            "lows": np.minimum.reduceat(lows, at).tobytes(), "highs": np.maximum.reduceat(highs, at).tobytes(),
            "counts": np.add.reduceat(counts, at).tobytes()}


def _first_runs(bits: int):
    """Runs of one scan partition: numbered by the partition, one row per digest range and batch group."""
    def make(batches):
        from pyspark import TaskContext
        run = TaskContext.get().partitionId()
        for b in batches:
            if b.num_rows == 0:
                continue
            digests = b.column("digest").combine_chunks() if isinstance(b.column("digest"), pa.ChunkedArray) else b.column("digest")
            raw = b"".join(digests.to_pylist())
            words = np.frombuffer(raw, ">u8").reshape(-1, 4).astype(np.uint64)
            part = (words[:, 0] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(words), np.int64)
            lengths = b.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
            checks = b.column("check").to_numpy(zero_copy_only=False).astype(np.int64)
            ids = b.column("doc_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.argsort(part, kind="stable")
            edges = np.flatnonzero(np.diff(part[order])) + 1
            rows = [_fold(int(part[g[0]]), run, words[g], lengths[g], checks[g], ids[g], ids[g], np.ones(len(g), np.int64))
                    for g in np.split(order, edges)]
            yield pa.RecordBatch.from_pylist(rows, schema=_RUN_SCHEMA)
    return make


_RUN_SCHEMA = pa.schema([("part", pa.int64()), ("run", pa.int64())]
                        + [(c, pa.binary()) for c in ("digests", "lengths", "checks", "lows", "highs", "counts")])


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    cat = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in pdf[c]])
    words = cat("digests", ">u8").reshape(-1, 4).astype(np.uint64)
    return pd.DataFrame([_fold(int(pdf["part"].iloc[0]), int(pdf["run"].iloc[0]), words, cat("lengths", np.int64),
                               cat("checks", np.int64), cat("lows", np.int64), cat("highs", np.int64),
                               cat("counts", np.int64))])


def _entries(batches):
    for b in batches:
        for r in b.to_pylist():
            digest = np.frombuffer(r["digests"], "S1").reshape(-1, 32) if r["digests"] else np.zeros((0, 32), "S1")
            n = len(digest)
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest[i].tobytes() for i in range(n)], pa.binary())]
                + [pa.array(np.frombuffer(r[c], np.int64)) for c in ("lengths", "checks", "lows", "highs", "counts")],
                names=["digest", "n", "check", "low_id", "high_id", "group_size"])


def digest_rows(docs: DataFrame) -> DataFrame:
    """doc_id, SHA-256 of the normalised text, its length and a second hash."""
    norm = lower_ascii(F.col("text"))
    return (texts(docs).select("doc_id", norm.alias("t"))
            .select("doc_id", F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("digest"),
                    F.octet_length("t").cast("long").alias("n"), F.xxhash64("t").alias("check")))


def merge_runs(rows: DataFrame, fan_in: int = FAN_IN, run_entries: int = RUN_ENTRIES) -> DataFrame:
    """Groups of equal texts: digest, n, check, low_id, high_id, group_size; one row per distinct text."""
    n = rows.count()
    bits = max(0, int(np.ceil(np.log2(max(1, n / run_entries)))))
    runs = rows.mapInArrow(_first_runs(bits), _RUN)
    parts = max(1, rows.rdd.getNumPartitions())
    shift = int(np.log2(fan_in))
    while True:
        runs = runs.withColumn("run", F.shiftright("run", shift)).groupBy("part", "run").applyInPandas(_merge, _RUN)
        parts = -(-parts // fan_in)
        if parts <= 1:
            break
    return runs.mapInArrow(_entries, "digest binary, n long, check long, low_id long, high_id long, group_size long")


def exact_dedup(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep``: "largest" or "smallest" identifier of a group stays. The digests are written once to the shared
    folder; groups come back to the rows by an equi-join that adaptive execution splits where a text is hot.
    """
    rows = written(digest_rows(docs), "digests")
    groups = merge_runs(rows)
    best = F.col("high_id") if keep == "largest" else F.col("low_id")
    groups = groups.select("digest", "n", "check", F.when(best != _NO_ID, best).alias("keep_id"), "group_size")
    out = rows.join(groups, ["digest", "n", "check"], "inner")
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"))
