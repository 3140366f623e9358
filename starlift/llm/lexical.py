"""Ranked lexical search with per-term geometric blocking; exact top-k of every query over all documents.

A term's weight is ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``; a document holding it ``tf`` times adds
``w * ratio`` with ``ratio = (1000000000 * tf) div (1000 * tf + 20 * m)`` and ``m = 50 + ((50 * n * N) div L)``. N, L, df
and n are counted over all documents and whole texts.

1. Queries are taken in blocks of at most ITEM_BLOCK items and TERM_BOUND terms (a single larger item is a block of its
   own); a block is broadcast, its size is thus bounded, and further blocks are further passes.
2. One pass over the texts writes a vector per document: the block's terms it holds, with counts. N, L and df follow.
3. First thresholds: documents holding one of an item's rarest terms are scored; the k-th best of them bounds the item's
   k-th best from below. The same pass finds the largest ratio of each term. An item's lists are taken from the heaviest
   term down until the largest scores of the lists left add up to less than its threshold: a document in none of the lists taken
   cannot be among its k best. Only these posting lists are needed.
4. Index: documents are range-sorted by their heaviest terms and dealt into clusters of neighbours. In a cluster every
   posting list is ordered by document similarity (nearest representative by cosine, then the cosine) and cut into blocks
   where the representative changes or after BLOCK documents. A block stores the coordinatewise maximum of its
   documents' ratios over the terms of all items that use the list. Written to the shared folder.
5. Search: a block is skipped for an item only if the item's score on the block's summary, an exact upper bound in
   integers, is below the item's threshold; the documents of all other blocks are scored exactly. A task keeps the k
   best of each item, which raises its thresholds; the k best over all tasks are the result.

A hot term, a hot group of copies or a very long list only means more clusters and blocks: no list is gathered in one task.
Defined results: null text has no terms; documents and items without terms have no results; a row of a repeated id
is a document of its own; equal scores rank by ascending doc_id, null ids last; scores of 0 are left out; empty tables
have no results.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starlift.llm.common import LOWER, UPPER, bounded_batches, buffers, pack_columns, texts, unpack_columns, written

TOP = 50
#: Items and distinct terms of one pass.
ITEM_BLOCK = 4096
TERM_BOUND = 1 << 18
#: Documents of one posting block, and of one cluster.
BLOCK = 16
CLUSTER = 1024
#: Cells of a cluster's matrix; wide clusters hold fewer documents.
CELLS = 1 << 22
#: Documents that the rarest terms of an item should have together for its first threshold, as a multiple of k.
SEEDS = 4
PIECE_BYTES = 1 << 20

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def term_counts(text: bytes) -> Counter:
    """Occurrences of every term of one text, counted piece by piece."""
    found, lo = Counter(), 0
    while lo < len(text):
        gap = _GAP.search(text, min(len(text), lo + PIECE_BYTES))
        hi = gap.start() if gap else len(text)
        found.update(_TERM.findall(text[lo:hi].translate(_FOLD)))
        lo = hi + 1
    return found


def _item_terms(batches):
    for b in batches:
        offsets, raw = buffers(b.column("text"))
        terms = [sorted(term_counts(raw[offsets[i]:offsets[i + 1]].tobytes())) for i in range(b.num_rows)]
        yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.array(terms, pa.list_(pa.binary()))], names=["item_id", "terms"])


def _vectors(shared):
    """Per text with terms: its length in terms, and the broadcast terms it holds with their counts."""
    def run(batches):
        number = shared.value["number"]
        known = number.keys()
        for b in batches:
            offsets, raw = buffers(b.column("text"))
            rows, n, terms, tfs = [], [], [], []
            for i in range(b.num_rows):
                count = term_counts(raw[offsets[i]:offsets[i + 1]].tobytes())
                if not count:
                    continue
                mine = sorted((number[t], count[t]) for t in count.keys() & known)
                rows.append(i)
                n.append(sum(count.values()))
                terms.append(np.array([t for t, _ in mine], np.int32).tobytes())
                tfs.append(np.array([c for _, c in mine], np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())],
                                             names=["doc_id", "n", "terms", "tfs"])
    return run


_VECTOR = "doc_id long, n long, terms binary, tfs binary"


def _document_counts(size: int):
    def run(batches):
        df = np.zeros(size, np.int64)
        for b in batches:
            for x in b.column("terms"):
                df[np.frombuffer(x.as_py(), np.int32)] += 1
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["term", "df"])
    return run


class Cluster:
    """Some documents as a matrix of ratios (documents x terms that occur)."""

    def __init__(self, doc_id, none, n, terms, tfs, documents: int, total: int):
        self.doc_id, self.none = np.array(doc_id, np.int64), np.array(none, bool)
        doc = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
        self.cols, col = np.unique(np.concatenate(terms), return_inverse=True)
        m = np.array([50 + 50 * int(x) * documents // total for x in n], np.int64)
        tf = np.concatenate(tfs).astype(np.int64)
        self.ratio = np.zeros((len(terms), len(self.cols)), np.int64)
        self.ratio[doc, col] = 1_000_000_000 * tf // (1000 * tf + 20 * m[doc])

    def columns(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among ``terms`` that occur here, and their columns."""
        at = np.minimum(np.searchsorted(self.cols, terms), len(self.cols) - 1)
        here = np.flatnonzero(self.cols[at] == terms)
        return here, at[here]

    def scores(self, rows: np.ndarray, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        _, at = self.columns(terms)
        return self.ratio[np.ix_(rows, at)] @ weight[self.cols[at]]


def _clusters(batches, shared, size: int = CLUSTER) -> Iterator[Cluster]:
    """Consecutive rows of vectors, ``size`` documents and CELLS cells at most (one document at least)."""
    rows: list[tuple] = []
    entries, known = 0, len(shared["weight"])
    for b in batches:
        for d, n, t, c in zip(b.column("doc_id").to_pylist(), b.column("n").to_pylist(), b.column("terms"), b.column("tfs")):
            t = np.frombuffer(t.as_py(), np.int32)
            if not len(t):
                continue
            if rows and (len(rows) == size or (len(rows) + 1) * min(known, entries + len(t)) > CELLS):
                yield Cluster(*zip(*rows), shared["documents"], shared["total"])
                rows, entries = [], 0
            rows.append((d or 0, d is None, n, t, np.frombuffer(c.as_py(), np.int32)))
            entries += len(t)
    if rows:
        yield Cluster(*zip(*rows), shared["documents"], shared["total"])


class Best:
    """The k best documents of each item that a task has seen."""

    def __init__(self, k: int):
        self.k, self.of = k, {}

    def add(self, item: int, score: np.ndarray, doc_id: np.ndarray, none: np.ndarray) -> None:
        good = score > 0
        rows = (score[good], doc_id[good], none[good])
        if item in self.of:
            rows = tuple(np.concatenate(x) for x in zip(self.of[item], rows))
        if len(rows[0]) > self.k:
            kept = np.lexsort((rows[1], rows[2], -rows[0]))[:self.k]
            rows = tuple(x[kept] for x in rows)
        self.of[item] = rows

    def least(self, item: int) -> int:
        """The k-th best score so far, 0 while there are fewer."""
        rows = self.of.get(item)
        return int(rows[0].min()) if rows is not None and len(rows[0]) == self.k else 0

    def batch(self) -> pa.RecordBatch:
        item = np.repeat(np.array(list(self.of), np.int64), [len(r[0]) for r in self.of.values()])
        score, doc_id, none = (np.concatenate([r[j] for r in self.of.values()] or [np.zeros(0, t)]) for j, t in enumerate((np.int64, np.int64, bool)))
        return pa.RecordBatch.from_arrays([pa.array(item), pa.array(doc_id, mask=none), pa.array(score), pa.nulls(len(item), pa.int32())], names=["item", "doc_id", "score", "term"])


_FOUND = "item long, doc_id long, score long, term int"


def _seed(shared, k: int):
    """Scores of the documents with an item's rarest terms; and, per term, its largest ratio (rows with ``term``)."""
    def run(batches):
        q = shared.value
        best, top = Best(k), np.zeros(len(q["weight"]), np.int64)
        for c in _clusters(batches, q):
            top[c.cols] = np.maximum(top[c.cols], c.ratio.max(axis=0))
            wanted: dict[int, list] = {}
            for j, t in enumerate(c.cols):
                for item in q["seeds"].get(int(t), ()):
                    wanted.setdefault(item, []).append(np.flatnonzero(c.ratio[:, j]))
            for item, rows in wanted.items():
                rows = np.unique(np.concatenate(rows))
                best.add(item, c.scores(rows, q["items"][item], q["weight"]), c.doc_id[rows], c.none[rows])
        yield best.batch()
        some = np.flatnonzero(top)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.int64()), pa.array(top[some]), pa.array(some.astype(np.int32))],
                                         names=["item", "doc_id", "score", "term"])
    return run


def _near(shared):
    """Vectors with a list that is needed, and their place in the order of similarity: their four heaviest terms."""
    def run(batches):
        q = shared.value
        needed = np.zeros(len(q["weight"]), bool)
        needed[list(q["lists"])] = True
        for b in batches:
            keep, one, two = [], [], []
            for i, (t, c) in enumerate(zip(b.column("terms"), b.column("tfs"))):
                t, c = np.frombuffer(t.as_py(), np.int32), np.frombuffer(c.as_py(), np.int32)
                if len(t) and needed[t].any():
                    heavy = np.lexsort((t, -(q["weight"][t] * (c / (c + 1.0)))))[:4]
                    a = np.pad(t[heavy], (0, 4 - len(heavy)), constant_values=-1).astype(np.int64) + 1
                    keep.append(i)
                    one.append(int(a[0] << 32 | a[1]))
                    two.append(int(a[2] << 32 | a[3]))
            out = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*[out.column(x) for x in ("doc_id", "n", "terms", "tfs")], pa.array(one, pa.int64()), pa.array(two, pa.int64())],
                                             names=["doc_id", "n", "terms", "tfs", "one", "two"])
    return run


_DOC = (("doc_id", np.int64), ("none", np.uint8))
_COL = (("term", np.int32),)
_ENTRY = (("doc", np.uint16), ("col", np.int32), ("ratio", np.int32))
_BLOCK = (("term", np.int32), ("size", np.int32))
_MEMBER = (("doc", np.uint16),)
_SUMMARY = (("ratio", np.int32),)
_PARTS = (("docs", _DOC), ("cols", _COL), ("entries", _ENTRY), ("blocks", _BLOCK), ("members", _MEMBER), ("summaries", _SUMMARY))
_INDEX = ", ".join(f"n_{name} long, {name} binary" for name, _ in _PARTS)


def similarity_order(c: Cluster, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents ordered by nearest representative and nearness to it, and the representative of each in that order."""
    x = (c.ratio * weight[c.cols]).astype(np.float32)
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    x = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
    chosen = np.arange(0, len(x), max(BLOCK, math.isqrt(len(x))))
    near = x @ x[chosen].T
    nearest = near.argmax(axis=1)
    order = np.lexsort((-near[np.arange(len(x)), nearest], nearest))
    return order, nearest[order]


def blocks_of(c: Cluster, q: dict, block: int = BLOCK) -> dict[str, dict]:
    """The posting lists of one cluster in blocks, with their summaries."""
    order, nearest = similarity_order(c, q["weight"])
    sizes, terms, members, summaries = [], [], [], []
    for j, t in enumerate(c.cols):
        beside = q["beside"].get(int(t))
        if beside is None:
            continue
        place = np.flatnonzero(c.ratio[order, j])
        rows = order[place]
        starts = np.zeros(1, np.int64)
        if len(rows) > block:
            fresh = np.concatenate([[True], nearest[place][1:] != nearest[place][:-1]])
            first = np.maximum.accumulate(np.where(fresh, np.arange(len(rows)), 0))
            starts = np.flatnonzero((np.arange(len(rows)) - first) % block == 0)
        here, at = c.columns(beside)
        top = np.zeros((len(starts), len(beside)), np.int64)
        top[:, here] = np.maximum.reduceat(c.ratio[np.ix_(rows, at)], starts, axis=0)
        sizes.append(np.diff(np.append(starts, len(rows))))
        terms.append(np.full(len(starts), t, np.int32))
        members.append(rows)
        summaries.append(top.reshape(-1))
    join = lambda xs: np.concatenate(xs) if xs else np.zeros(0, np.int64)
    return {"blocks": {"term": join(terms), "size": join(sizes)}, "members": {"doc": join(members)}, "summaries": {"ratio": join(summaries)}}


def _index(shared, block: int = BLOCK):
    def run(batches):
        q = shared.value
        for c in _clusters(batches, q):
            doc, col = np.nonzero(c.ratio)
            parts = {"docs": {"doc_id": c.doc_id, "none": c.none}, "cols": {"term": c.cols}, "entries": {"doc": doc, "col": col, "ratio": c.ratio[doc, col]}, **blocks_of(c, q, block)}
            cells = [x for name, fields in _PARTS for x in (pa.array([len(parts[name][fields[0][0]])], pa.int64()), pa.array([pack_columns(fields, parts[name])], pa.binary()))]
            yield pa.RecordBatch.from_arrays(cells, names=[x for name, _ in _PARTS for x in (f"n_{name}", name)])
    return run


def _restore(row: dict) -> tuple[Cluster, dict]:
    parts = {name: unpack_columns(fields, row[name], row[f"n_{name}"]) for name, fields in _PARTS}
    c = Cluster.__new__(Cluster)
    c.doc_id, c.none, c.cols = parts["docs"]["doc_id"], parts["docs"]["none"] == 1, parts["cols"]["term"]
    c.ratio = np.zeros((len(c.doc_id), len(c.cols)), np.int64)
    c.ratio[parts["entries"]["doc"], parts["entries"]["col"]] = parts["entries"]["ratio"]
    return c, parts


def open_documents(parts: dict, q: dict, least) -> tuple[dict[int, list], int, int]:
    """Per item the documents of the blocks whose bound reaches ``least(item)``; (block, item) pairs seen and kept."""
    term, size = parts["blocks"]["term"], parts["blocks"]["size"].astype(np.int64)
    member, summary = parts["members"]["doc"], parts["summaries"]["ratio"].astype(np.int64)
    wanted: dict[int, list] = {}
    seen = kept = at = low = 0
    edges = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1], [True]])) if len(term) else []
    for a, z in zip(edges[:-1], edges[1:]):
        t = int(term[a])
        items, weights = q["lists"][t], q["bounds"][t]
        top = summary[low:low + (z - a) * weights.shape[0]].reshape(z - a, -1)
        low += top.size
        rows = member[at:at + int(size[a:z].sum())]
        at += len(rows)
        alive = top @ weights >= np.array([max(1, least(i)) for i in items])
        seen += alive.size
        kept += int(alive.sum())
        if alive.any():
            block = np.repeat(np.arange(z - a), size[a:z])
            for j in np.flatnonzero(alive.any(axis=0)):
                wanted.setdefault(items[j], []).append(rows[alive[block, j]])
    return wanted, seen, kept


def _search(shared, k: int):
    def run(batches):
        q, best = shared.value, Best(k)
        least = lambda item: max(q["least"].get(item, 0), best.least(item))
        for b in batches:
            for row in b.to_pylist():
                c, parts = _restore(row)
                wanted, _, _ = open_documents(parts, q, least)
                for item, rows in wanted.items():
                    rows = np.unique(np.concatenate(rows))
                    best.add(item, c.scores(rows, q["items"][item], q["weight"]), c.doc_id[rows], c.none[rows])
        yield best.batch()
    return run


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each item with their rank; tasks have cut their rows to k each already."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def item_blocks(items: DataFrame, size: int = ITEM_BLOCK, bound: int = TERM_BOUND) -> Iterator[dict[int, list[bytes]]]:
    """The queries in blocks: {item: terms}."""
    block, known = {}, set()
    for r in items.where(F.size("terms") > 0).orderBy("item").toLocalIterator():
        terms = [bytes(t) for t in r["terms"]]
        if block and (len(block) == size or len(known.union(terms)) > bound):
            yield block
            block, known = {}, set()
        block[r["item"]] = terms
        known.update(terms)
    if block:
        yield block


def needed_lists(q: dict, k: int) -> None:
    """Sets ``lists`` (term to the items that need it), ``beside`` (terms of these items) and ``bounds`` (their weights)."""
    lists: dict[int, list] = {}
    for item, terms in q["items"].items():
        most = q["weight"][terms] * q["top"][terms]
        order = np.argsort(most, kind="stable")
        rest = np.cumsum(most[order])
        for t in terms[order[rest >= max(1, q["least"].get(item, 0))]]:
            lists.setdefault(int(t), []).append(item)
    q["lists"], q["beside"], q["bounds"] = lists, {}, {}
    for t, items in lists.items():
        beside = np.unique(np.concatenate([q["items"][i] for i in items]))
        q["beside"][t] = beside
        q["bounds"][t] = np.stack([np.where(np.isin(beside, q["items"][i]), q["weight"][beside], 0) for i in items], axis=1)


def prepare(docs: DataFrame, block: dict[int, list[bytes]], k: int) -> tuple[DataFrame, dict]:
    """The documents' vectors for one block of queries, and all that the index and the search need to know."""
    sc = docs.sparkSession.sparkContext
    number = {t: j for j, t in enumerate(sorted({t for ts in block.values() for t in ts}))}
    vectors = written(docs.mapInArrow(_vectors(sc.broadcast({"number": number})), _VECTOR), "vectors")
    whole = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(len(number), np.int64)
    # at most TERM_BOUND rows
    for r in vectors.select("terms").mapInArrow(_document_counts(len(number)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        df[r["term"]] = r["df"]
    n = whole[0]
    q = {"documents": n, "total": whole[1] or 1, "weight": np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(x) + 1))) for x in df], np.int64),
         "items": {i: np.array([number[t] for t in ts], np.int32) for i, ts in block.items()}, "seeds": {}}
    for item, terms in q["items"].items():
        rare = terms[np.lexsort((terms, df[terms]))]
        rare = rare[df[rare] > 0]
        for t in rare[:int(np.searchsorted(np.cumsum(df[rare]), SEEDS * k)) + 1]:
            q["seeds"].setdefault(int(t), []).append(item)
    found = written(vectors.mapInArrow(_seed(sc.broadcast(q), k), _FOUND), "seeds")
    q["top"] = np.zeros(len(number), np.int64)
    for r in found.where("term is not null").groupBy("term").agg(F.max("score").alias("top")).toLocalIterator():
        q["top"][r["term"]] = r["top"]
    last = ranked(found.where("term is null"), k).where(F.col("rank") == k)
    q["least"] = {r["item"]: r["score"] for r in last.select("item", "score").toLocalIterator()}  # one row per item of the block
    needed_lists(q, k)
    return vectors, q


def build_index(vectors: DataFrame, q: dict, block: int = BLOCK) -> DataFrame:
    """One row per cluster of similar documents: their vectors, and the blocks of their posting lists with summaries."""
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(q)
    near = written(vectors.mapInArrow(_near(shared), _VECTOR + ", one long, two long"), "near")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = near.repartitionByRange(parts, "one", "two", "doc_id").sortWithinPartitions("one", "two", "doc_id")
    return written(near.select("doc_id", "n", "terms", "tfs").mapInArrow(_index(shared, block), _INDEX), "index")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, item_block: int = ITEM_BLOCK, term_bound: int = TERM_BOUND, block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents (doc_id, text) of every row of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = texts(docs)
    asked = items.select(F.col("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = asked.schema["item_id"].dataType.simpleString()
    asked = asked.mapInArrow(_item_terms, f"item_id {kind}, terms array<binary>").withColumn("item", F.monotonically_increasing_id())
    asked = written(asked, "items")
    found = None
    for one in item_blocks(asked, item_block, term_bound):
        vectors, q = prepare(docs, one, k)
        index = build_index(vectors, q, block)
        here = written(index.mapInArrow(_search(spark.sparkContext.broadcast(q), k), _FOUND), "found")
        found = here if found is None else found.unionByName(here)
    if found is None:
        found = spark.createDataFrame([], _FOUND)
    return ranked(found, k).join(asked.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
