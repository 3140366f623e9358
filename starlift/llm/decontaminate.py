"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

Test items are taken in blocks of at most BLOCK_WORDS words (a stated query set against all documents); the seeds of
one block are broadcast, and their size is that bound. Two passes over the documents per block: the first counts in
how many documents each seed occurs, over all documents; the second looks the seeds up again. A passage with one seed
that is rare in the corpus, or with any two seeds of an item, is aligned word by word, unless it holds too few of the
item's words to reach the score at all. Score: best local alignment (match 2, other word -1, gap -1) over twice the
length of the item.

Items with frequent seeds only use all of them, so an item leaked into a third of all documents is found like any
other. Not found: a passage in which no seed survives (an edit in every third word), or one frequent seed only. Defined
results: null texts count as empty and match nothing; items shorter than a seed match by their whole word sequence;
equal items and equal documents are reported each; empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlift.llm.common import buffers, doc_groups, shingles, texts, word_hashes

SEED_WORDS = 3
MIN_SCORE = 0.5
BLOCK_WORDS = 1 << 19
#: Starting points of one passage lie at most so many words apart.
SLACK = 8
#: A seed in more than so many documents, and in more than this share of all, is frequent.
FREQUENT, FREQUENT_SHARE = 16, 0.001

_BITS = 22


class Items:
    """Seeds of one block of items: sorted distinct hashes, where they stand, and which are rare."""

    def __init__(self, ids: list, words: list[np.ndarray]):
        self.ids, self.words = ids, words
        rows = [(s, k, p) for k, w in enumerate(words) if len(w) for p, s in enumerate(shingles(w, SEED_WORDS).tolist())]
        rows.sort()
        self.seeds = np.array(sorted({r[0] for r in rows}), np.uint64)
        seed = np.searchsorted(self.seeds, np.array([r[0] for r in rows], np.uint64))
        self.first = np.searchsorted(seed, np.arange(len(self.seeds) + 1))
        self.item = np.array([r[1] for r in rows], np.int64)
        self.place = np.array([r[2] for r in rows], np.int64)
        self.rare = np.ones(len(rows), bool)
        self.widths = sorted({min(SEED_WORDS, len(w)) for w in words if len(w)})
        self.filter = np.zeros(1 << _BITS, bool)
        self.filter[(self.seeds >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def set_rare(self, documents: np.ndarray, total: int) -> None:
        """Seeds that are not frequent among all documents; all seeds of an item that has no other."""
        seed = np.repeat(np.arange(len(self.seeds)), np.diff(self.first))
        rare = documents[seed] <= max(FREQUENT, FREQUENT_SHARE * total)
        some = np.zeros(len(self.ids), bool)
        some[self.item[rare & (documents[seed] > 0)]] = True
        self.rare = rare | ~some[self.item]

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in the text and the seeds found there."""
        at, found = [], []
        for k in self.widths:
            if len(words) < k:
                continue
            h = shingles(words, k)
            near = np.flatnonzero(self.filter[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
            seed = np.searchsorted(self.seeds, h[near])
            hit = self.seeds[np.minimum(seed, len(self.seeds) - 1)] == h[near]
            at.append(near[hit])
            found.append(seed[hit])
        if not at:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(at), np.concatenate(found)


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: its score and the last word of it in item and text (row by row, whole rows at once)."""
    step = np.arange(1, len(text) + 1)
    row, best = np.zeros(len(text) + 1, np.int64), (0, 0, 0)
    for i in range(len(item)):
        new = np.maximum(row[:-1] + np.where(text == item[i], 2, -1), np.maximum(row[1:] - 1, 0))
        row = np.concatenate([[0], np.maximum.accumulate(new + step) - step])
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), i, j - 1)
    return best


def passages(items: Items, words: np.ndarray, min_score: float = MIN_SCORE):
    """(item, score, first word, last word) of the best passage of each item in one text."""
    at, seed = items.find(words)
    if not len(at):
        return
    n = items.first[seed + 1] - items.first[seed]
    entry = np.repeat(items.first[seed], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    item, start = items.item[entry], np.repeat(at, n) - items.place[entry]
    order = np.lexsort((start, item))
    item, start, entry = item[order], start[order], entry[order]
    # a passage: hits of one item whose starting points lie less than the slack apart
    edge = np.flatnonzero(np.concatenate([[True], (np.diff(item) != 0) | (np.diff(start) > SLACK)]))
    best: dict[int, tuple] = {}
    for a, b in zip(edge, np.append(edge[1:], len(item))):
        k = int(item[a])
        if not items.rare[entry[a:b]].any() and (entry[a:b] == entry[a]).all():
            continue
        query = items.words[k]
        # each gap costs 1, so an alignment of the least score drifts by no more than this
        drift = max(SLACK, int(2 * len(query) * (1 - min_score)))
        lo, hi = max(0, int(start[a]) - drift), min(len(words), int(start[b - 1]) + len(query) + drift)
        if np.isin(query, words[lo:hi]).sum() < min_score * len(query):
            continue
        score, i, j = align(query, words[lo:hi])
        value = score / (2 * len(query))
        if value >= min_score and (k not in best or value > best[k][0]):
            _, _, back = align(query[:i + 1][::-1], words[lo:lo + j + 1][::-1])
            best[k] = (value, lo + j - back, lo + j)
    for k, v in sorted(best.items()):
        yield k, *v


def _each(batches):
    for b in batches:
        offsets, raw = buffers(b.column("text"))
        ids = b.column("doc_id")
        for i, j in doc_groups(offsets):
            words, bounds = word_hashes(offsets[i:j + 1], raw)
            for k in range(i, j):
                yield ids[k], words[bounds[k - i]:bounds[k - i + 1]]


def _blocks(benchmark: DataFrame, block_words: int):
    """Blocks of items, pulled one after the other; each is at most ``block_words`` words (one item at least)."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids, words, size = [], [], 0
    for r in rows.toLocalIterator():
        data = r["text"].encode()
        w, _ = word_hashes(np.array([0, len(data)]), np.frombuffer(data, np.uint8))
        if ids and size + len(w) > block_words:
            yield Items(ids, words)
            ids, words, size = [], [], 0
        ids.append(r["item_id"])
        words.append(w)
        size += len(w)
    if any(len(w) for w in words):
        yield Items(ids, words)


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, score, first_word, last_word: the best passage of each leaked item in each document."""
    spark, rows, out = docs.sparkSession, texts(docs), None
    schema = "doc_id long, item_id long, score double, first_word long, last_word long"
    for items in _blocks(benchmark, block_words):
        if not len(items.seeds):
            continue
        shared = spark.sparkContext.broadcast(items)

        def count(batches, shared=shared):
            block = shared.value
            n = np.zeros(len(block.seeds) + 1, np.int64)  # the last: all documents
            for _, words in _each(batches):
                n[np.unique(block.find(words)[1])] += 1
                n[-1] += 1
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["seed", "n"])

        counted = rows.mapInArrow(count, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).toPandas()
        documents = np.zeros(len(items.seeds) + 1, np.int64)
        documents[counted["seed"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
        items.set_rare(documents[:-1], int(documents[-1]))
        ranked = spark.sparkContext.broadcast(items)

        def search(batches, ranked=ranked):
            block = ranked.value
            for doc_id, words in _each(batches):
                found = [(doc_id.as_py(), block.ids[k], round(s, 6), a, z) for k, s, a, z in passages(block, words, min_score)]
                if found:
                    yield pa.RecordBatch.from_pylist([dict(zip(_OUT.names, f)) for f in found], schema=_OUT)

        part = rows.mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


_OUT = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())])


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, columns unchanged, that hold no passage of a test item; rows without an id stay."""
    bad = written_ids(find_leaks(docs, benchmark))
    return docs.join(bad, docs["doc_id"].cast("long") == bad["__leak_id"], "left_anti")


def written_ids(leaks: DataFrame) -> DataFrame:
    return leaks.select(F.col("doc_id").alias("__leak_id")).distinct()
