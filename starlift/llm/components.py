"""Connected components of an edge table by alternating large-star and small-star steps.

Edges are first contracted inside their partitions (union-find over bounded chunks), which leaves spanning forests.
Each step is a map-side combined minimum and an equi-join, so a hub node is split by adaptive execution like any hot
key; each iteration is written to the shared folder. No link, label or component passes through the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlift.llm.common import written

#: Edges that one contraction holds.
CHUNK_EDGES = 1 << 19


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component), without the smallest ones themselves."""
    nodes, idx = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = idx[:len(a)], idx[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[far], nodes[label[far]]


def _contract(batches):
    held, size = [], 0

    def flush():
        a, b = forest(*(np.concatenate(x) for x in zip(*held)))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for t in batches:
        held.append((t.column("a").to_numpy(zero_copy_only=False), t.column("b").to_numpy(zero_copy_only=False)))
        size += t.num_rows
        if size >= CHUNK_EDGES:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of the component, for every node of an edge but the smallest itself."""
    e = edges.where("a <> b").mapInArrow(_contract, "a long, b long").distinct()
    e, seen = written(e, "edges"), None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                                              F.struct("a", F.col("m").alias("b")))).alias("s")).select("s.*")
        e = written(small.where("a <> b").distinct(), "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("label"))
        seen = now
