"""SimHash near-duplicates by pivot distance tables.

A text's fingerprint has bit i set when more than half of the 64-bit hashes of its word shingles (repeats included) have
it set. Fingerprints link when they differ in at most RADIUS bits; documents with one fingerprint are one node.

* References: per byte of the fingerprint a family of eight reference fingerprints (the Walsh patterns of that byte, zero
  elsewhere), and the zero fingerprint. A pivot table holds the Hamming distances of a fingerprint to all of them.
  By the triangle inequality no coordinate of a linked pair differs by more than RADIUS.
* A coordinate less the distance to the zero reference depends on one byte only, so RADIUS differing bits leave the
  coordinates of all but RADIUS families unchanged. Every fingerprint is therefore sent once for each choice of
  FAMILIES - RADIUS families, under a key made of their coordinates: linked fingerprints meet under one key at least, and
  at most 2 ** (8 * RADIUS) different fingerprints can share one, however many documents there are and whatever
  they hold. No key needs splitting, no group is cut.
* Within a key pairs are taken in order of the distance to the zero reference, which ends a fingerprint's partners where
  it has grown by more than RADIUS; pairs are discarded by the largest difference of their coordinates, survivors are
  verified bit by bit. A task returns spanning forests of the links, never the pairs.

Defined results: null text counts as empty; a text without words has fingerprint zero and links like any other; fewer
words than a shingle has give one hash of the whole sequence; repeated rows share a fingerprint; a null id never
becomes a component's id unless the component has no other; an empty table has no rows.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlift.llm.common import LOWER, UPPER, buffers, doc_groups, long_array, mix64, texts, written
from starlift.llm.components import CHUNK_EDGES, components, forest

WORDS = 3
SEED = 42
RADIUS = 2
FAMILIES = 8
#: Bytes of a text that are cut into words at once.
PIECE_BYTES = 1 << 20
#: Rows that a task compares at once, besides the rest of their last key.
HELD_ROWS = 1 << 18
#: Pairs whose coordinates are compared at once.
PAIR_ROWS = 1 << 16

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_BITS = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.int64)


def _references() -> np.ndarray:
    """The zero reference, then eight per byte: all ones, and the seven patterns of bits i with an odd overlap with r."""
    rows = [0xFF] + [sum(((i & r).bit_count() & 1) << i for i in range(8)) for r in range(1, 8)]
    return np.array([0] + [p << (8 * g) for g in range(FAMILIES) for p in rows], np.uint64)


REFERENCES = _references()


def shingle_hashes(text: bytes, words: int = WORDS):
    """Arrays of the XXH64 hashes of the shingles of one text, piece by piece."""
    last: list[bytes] = []
    lo, some = 0, False
    while lo < len(text):
        gap = _GAP.search(text, min(len(text), lo + PIECE_BYTES))
        hi = gap.start() if gap else len(text)
        run = last + text[lo:hi].translate(_FOLD).split()
        lo = hi + 1
        if len(run) >= words:
            grams = map(b" ".join, zip(*(run[j:] for j in range(words))))
            yield np.fromiter(map(xxhash.xxh64_intdigest, grams, itertools.repeat(SEED)), np.uint64, len(run) - words + 1)
            some = True
        last = run[max(0, len(run) - words + 1):]
    if last and not some:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(last), SEED)], np.uint64)


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, fp) of every row; ``fp`` holds the 64 bits as a long."""
    def run(batches):
        for b in batches:
            offsets, raw = buffers(b.column("text"))
            for i, j in doc_groups(offsets):
                n = np.zeros(j - i, np.int64)
                set_bits = np.zeros((j - i, 8, 8), np.int64)
                held: list[np.ndarray] = []
                owner: list[int] = []

                def count():
                    doc = np.repeat(owner, [len(h) for h in held])
                    planes = np.concatenate(held).astype("<u8").view(np.uint8).reshape(-1, 8)
                    for k in range(8):
                        seen = np.bincount(doc * 256 + planes[:, k], minlength=(j - i) * 256)
                        set_bits[:, k] += seen.reshape(j - i, 256) @ _BITS
                    n[:] += np.bincount(doc, minlength=j - i)
                    held.clear()
                    owner.clear()

                for d in range(i, j):
                    for h in shingle_hashes(raw[offsets[d]:offsets[d + 1]].tobytes(), words):
                        held.append(h)
                        owner.append(d - i)
                        if len(h) >= PIECE_BYTES // 16:
                            count()
                if held:
                    count()
                bits = (2 * set_bits.reshape(j - i, 64) > n[:, None]).astype(np.uint8)
                fp = np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(-1)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), long_array(fp)], names=["doc_id", "fp"])
    return texts(docs).mapInArrow(run, "doc_id long, fp long")


def pivot_table(fp: np.ndarray) -> np.ndarray:
    """Hamming distances (n, references) of fingerprints to the references."""
    return np.stack([np.bitwise_count(fp ^ r) for r in REFERENCES], axis=1).astype(np.int8)


def keys(table: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """(n, choices): for each choice of FAMILIES - radius families a hash of their coordinates."""
    own = (table[:, 1:] - table[:, :1] + 8).astype(np.uint64).reshape(len(table), FAMILIES, -1)
    code = (own * np.uint64(17) ** np.arange(own.shape[2], dtype=np.uint64)).sum(axis=2, dtype=np.uint64)
    out = []
    for c, choice in enumerate(itertools.combinations(range(FAMILIES), FAMILIES - radius)):
        h = np.full(len(table), c + 1, np.uint64)
        for g in choice:
            h = mix64(h ^ code[:, g])
        out.append(h)
    return np.stack(out, axis=1)


def _send(radius: int):
    def run(batches):
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for a in range(0, len(fp), 1 << 13):
                part = fp[a:a + (1 << 13)]
                k = keys(pivot_table(part), radius)
                yield pa.RecordBatch.from_arrays([long_array(k.reshape(-1)), long_array(np.repeat(part, k.shape[1]))], names=["key", "fp"])
    return run


def linked_pairs(key: np.ndarray, fp: np.ndarray, radius: int):
    """Index pairs (arrays i, j) of rows of one key whose fingerprints differ in at most ``radius`` bits."""
    zero = np.bitwise_count(fp).astype(np.int64)  # distance to the zero reference
    order = np.lexsort((zero, key))
    key, zero = key[order], zero[order]
    left, step = np.arange(len(key)), 0
    while len(left):
        step += 1
        left = left[left + step < len(key)]
        right = left + step
        left = left[(key[right] == key[left]) & (zero[right] - zero[left] <= radius)]
        for a in range(0, len(left), PAIR_ROWS):
            i, j = order[left[a:a + PAIR_ROWS]], order[left[a:a + PAIR_ROWS] + step]
            near = np.abs(pivot_table(fp[i]) - pivot_table(fp[j])).max(axis=1) <= radius
            i, j = i[near], j[near]
            same = np.bitwise_count(fp[i] ^ fp[j]) <= radius
            yield i[same], j[same]


def _meet(radius: int):
    """Spanning forests of the links of rows sorted by key."""
    def run(batches):
        edges: list[tuple] = []
        found = 0

        def links(key, fp):
            nonlocal found
            for i, j in linked_pairs(key, fp, radius):
                if len(i):
                    edges.append((fp[i].view(np.int64), fp[j].view(np.int64)))
                    found += len(i)
                if found >= CHUNK_EDGES:
                    shrink()

        def shrink():
            nonlocal found
            kept = forest(*(np.concatenate(x) for x in zip(*edges)))
            edges[:] = [kept]
            found = len(kept[0])

        def out():
            a, b = forest(*(np.concatenate(x) for x in zip(*edges)))
            edges.clear()
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        held_key, held_fp, size = [], [], 0
        for b in batches:
            held_key.append(b.column("key").to_numpy(zero_copy_only=False))
            held_fp.append(b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64))
            size += b.num_rows
            if size < HELD_ROWS:
                continue
            key, fp = np.concatenate(held_key), np.concatenate(held_fp)
            cut = int(np.searchsorted(key, key[-1]))
            links(key[:cut], fp[:cut])
            held_key, held_fp, size = [key[cut:]], [fp[cut:]], len(key) - cut
            if found >= CHUNK_EDGES // 2:
                yield out()
                found = 0
        if size:
            links(np.concatenate(held_key), np.concatenate(held_fp))
        if edges:
            yield out()
    return run


def near_links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) whose components are those of all links among the different fingerprints ``nodes`` (fp)."""
    sent = nodes.select("fp").mapInArrow(_send(radius), "key long, fp long")
    return sent.repartition("key").sortWithinPartitions("key").mapInArrow(_meet(radius), "a long, b long")


def simhash_components(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, group_size (rows of the same fingerprint) for every row."""
    rows = written(fingerprints(docs, words), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("group_size")), "fingerprint-nodes")
    labels = components(near_links(nodes, radius))
    # the smallest node of a component labels itself
    labels = written(labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct()), "fingerprint-labels")
    joined = nodes.join(labels, nodes["fp"] == labels["node"], "left").select("fp", "low", "group_size", "label")
    joined = written(joined, "fingerprint-joined")
    first = joined.where("label is not null").groupBy("label").agg(F.min("low").alias("first"))
    named = joined.where("label is not null").join(first, "label").select("fp", "first", "group_size")
    named = written(named.unionByName(joined.where("label is null").select("fp", F.col("low").alias("first"), "group_size")), "fingerprint-components")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id"), "group_size")
