"""Merkle dataset manifest with nested-interval labels.

Every row is a leaf; the leaves of a group (one tree per ``group`` value) are ranked by ``order``, and every node of a
tree carries the interval [lo, hi) of the leaf ranks that it covers. Runs of FANOUT consecutive nodes become their
parent until one node is left, the group's subroot; the subroots, in the order of the group values, are the leaves of
one more tree, whose last node is the root.

* Ranks come from a range sort with partition offsets, so no group is gathered in one task.
* Nodes are made BAND levels at a time: a bucket is the at most FANOUT ** BAND nodes below one node of the band's top
  level, whatever the size of a group; a dataset of 10 ** 11 rows has five bands.
* Proofs come from level-bucketed containment joins: at each level of a band a node meets the one parent whose
  interval contains its own; both sides carry (tree, level, bucket of the leaf rank at that level) as the join's key. The
  parent's children outside the node's interval, the interval difference, are its siblings: those before it are the
  left part of the proof step, those behind it the right part. Nodes of a band's top level hand their own path down to
  the whole bucket, so a leaf is joined once per level of the lowest band and once for everything above.

Defined results: a null value of a column is part of the leaf as a null; null group values form a tree of their own,
which comes first; rows with equal order values are ordered by their leaf digest, null order values first; equal rows
are leaves of their own; a group of one row has its leaf as subroot, an only subroot is the root; an empty table has no
rows and no root. Columns not named are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlift.llm.common import written
from starlift.llm.ngram_join import running_sum

FANOUT = 2
#: Levels of one band; a bucket holds FANOUT ** BAND nodes of its lowest level at most.
BAND = 8

_NODE = pa.struct([("lo", pa.int64()), ("hi", pa.int64()), ("digest", pa.binary())])
_PARENT = pa.schema([("tree", pa.string()), ("level", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64()), ("digest", pa.binary()), ("children", pa.list_(_NODE))])
_PARENT_DDL = "tree string, level int, lo bigint, hi bigint, digest binary, children array<struct<lo: bigint, hi: bigint, digest: binary>>"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    s = value.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(values: list[Column]) -> Column:
    """Hex SHA-256 of a row's fields."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _grow(level: int, fanout: int, band: int):
    """Parents of up to ``band`` levels above one bucket of nodes of ``level``."""
    def run(batches):
        for b in batches:
            out: list[list] = [[] for _ in _PARENT]
            for tree, size, base in zip(b.column("tree").to_pylist(), b.column("size").to_pylist(), b.column("base")):
                nodes = [(x["lo"], x["hi"], x["digest"]) for x in base.as_py()]
                for step in range(1, band + 1):
                    if fanout ** (level + step - 1) >= size:
                        break
                    runs = [nodes[i:i + fanout] for i in range(0, len(nodes), fanout)]
                    nodes = [(r[0][0], r[-1][1], hashlib.sha256("".join(d.hex() for _, _, d in r).encode()).digest()) for r in runs]
                    for (lo, hi, digest), r in zip(nodes, runs):
                        row = (tree, level + step, lo, hi, digest, [{"lo": a, "hi": z, "digest": d} for a, z, d in r])
                        for column, v in zip(out, row):
                            column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, _PARENT)], schema=_PARENT)
    return run


def grow(leaves: DataFrame, sizes: DataFrame, fanout: int = FANOUT, band: int = BAND) -> list[DataFrame]:
    """Inner nodes over ``leaves`` (tree, lo, hi, digest), one written table per band; ``sizes``: (tree, size)."""
    largest = sizes.agg(F.max("size")).first()[0] or 0
    bands, level, base = [], 0, leaves.select("tree", "lo", "hi", "digest")
    while fanout ** level < largest:
        bucket = F.expr(f"lo div {fanout ** (level + band)}L").alias("bucket")
        groups = base.groupBy("tree", bucket).agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("base"))
        groups = groups.join(sizes, "tree").select("tree", "size", "base")
        bands.append(written(groups.mapInArrow(_grow(level, fanout, band), _PARENT_DDL), "merkle"))
        level += band
        base = bands[-1].where(F.col("level") == level).select("tree", "lo", "hi", "digest")
    return bands


def _beside(keep) -> Column:
    """Digests, in order, of the parent's children that ``keep`` lets through."""
    return F.aggregate(F.filter("children", keep), F.lit(b""), lambda a, c: F.concat(a, c["digest"]))


def paths(leaves: DataFrame, bands: list[DataFrame], payload: list[str], fanout: int = FANOUT, band: int = BAND) -> DataFrame:
    """(tree, lo, hi, *payload, path): per leaf the proof steps (level, left, right), lowest first."""
    upper = None
    path = "array<struct<level: int, left: binary, right: binary>>"
    for k in reversed(range(len(bands))):
        level = k * band
        base = leaves if k == 0 else bands[k - 1].where(F.col("level") == level)
        keep = payload if k == 0 else []
        key = F.expr(f"explode(transform(array({', '.join(f'{fanout ** (level + s)}L' for s in range(1, band + 1))}), (w, i) -> named_struct('at', {level + 1} + i, 'bucket', lo div w)))")
        x = base.select("tree", "lo", "hi", *keep, key.alias("k"))
        # what is handed through travels with the lowest level only
        x = x.select("tree", "lo", "hi", "k.*", *[F.when(F.col("k.at") == level + 1, F.col(c)).alias(c) for c in keep])
        width = F.expr("CASE level " + " ".join(f"WHEN {level + s} THEN lo div {fanout ** (level + s)}L" for s in range(1, band + 1)) + " END")
        parents = bands[k].select(F.col("tree").alias("p_tree"), F.col("level").alias("p_level"), width.alias("p_bucket"),
                                  F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"), "children")
        inside = (F.col("tree") == F.col("p_tree")) & (F.col("at") == F.col("p_level")) & (F.col("bucket") == F.col("p_bucket")) \
            & (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi"))
        step = F.struct((F.col("at") - 1).alias("level"), _beside(lambda c: c["hi"] <= F.col("lo")).alias("left"), _beside(lambda c: c["lo"] >= F.col("hi")).alias("right"))
        met = x.join(parents, inside, "left").select("tree", "lo", "hi", *keep, F.when(F.col("p_level").isNotNull(), step).alias("step"))
        own = met.groupBy("tree", "lo").agg(F.max("hi").alias("hi"), *[F.max(c).alias(c) for c in keep], F.sort_array(F.collect_list("step")).cast(path).alias("path"))
        if upper is not None:
            own = own.withColumn("bucket", F.expr(f"lo div {fanout ** (level + band)}L"))
            own = own.join(upper, ["tree", "bucket"], "left").withColumn("path", F.concat("path", F.coalesce("above", F.array().cast(path)))).drop("bucket", "above")
        if k:
            upper = written(own.select("tree", F.expr(f"lo div {fanout ** level}L").alias("bucket"), F.col("path").alias("above")), "merkle-paths")
        else:
            return own
    return leaves.select("tree", "lo", "hi", *payload, F.array().cast(path).alias("path"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hex) and its proof steps give."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(F.lower(F.hex(s["left"])), acc, F.lower(F.hex(s["right"]))), 256))


def siblings_text(path: Column) -> Column:
    """Hex digests of all siblings of a path, level by level, left to right, concatenated."""
    return F.array_join(F.transform(path, lambda s: F.concat(F.lower(F.hex(s["left"])), F.lower(F.hex(s["right"])))), "")


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    out = running_sum(rows.withColumn("one", F.lit(1).cast("long")), "tree", order, "one", "lo")
    return out.withColumn("hi", F.col("lo") + 1).drop("one")


def manifest(docs: DataFrame, columns: list[str], group: str, order: str, claimed: Column | None = None, fanout: int = FANOUT,
             band: int = BAND) -> DataFrame:
    """One row per row of ``docs``: id (the order column), leaf, subroot, root (hex), rank in its tree (``lo``), path, claimed.

    ``path`` holds the proof steps from the leaf to the root. ``claimed`` is an expression over ``docs`` for a leaf that
    is to be verified in place of the row's own (null: the own leaf).
    """
    value = F.col(group).cast("string")
    rows = docs.select(F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), value)).alias("tree"), F.col(order).alias("id"),
                       F.unhex(leaf_digest([F.col(c) for c in columns])).alias("digest"),
                       F.unhex(claimed if claimed is not None else F.lit(None).cast("string")).alias("claimed"))
    leaves = written(_ranked(written(rows, "leaves"), ["id", "digest"]), "merkle-leaves")
    sizes = leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("size"))
    sizes = written(sizes, "merkle-sizes")
    bands = grow(leaves, sizes, fanout, band)
    whole = [b.select("tree", "lo", "hi", "digest") for b in bands] + [leaves.select("tree", "lo", "hi", "digest")]
    subroots = None
    for nodes in whole:
        top = nodes.where("lo = 0").join(sizes, "tree").where("hi = size").select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
        subroots = top if subroots is None else subroots.unionByName(top)
    subroots = written(_ranked(written(subroots, "subroots"), ["name"]), "subroots")
    counted = written(subroots.groupBy("tree").agg(F.count(F.lit(1)).alias("size")), "merkle-sizes")
    over = grow(subroots, counted, fanout, band)
    # the only row whose interval covers all subroots; none for an empty table
    root = subroots.select("lo", "hi", "digest")
    for b in over:
        root = root.unionByName(b.select("lo", "hi", "digest"))
    root = root.where("lo = 0").orderBy(F.desc("hi")).limit(1).select(F.lower(F.hex("digest")).alias("root"))
    tops = paths(subroots, over, ["name", "digest"], fanout, band)
    tops = tops.crossJoin(F.broadcast(root))  # one row
    tops = written(tops.select(F.col("name").alias("tree"), F.lower(F.hex("digest")).alias("subroot"), "root", F.col("path").alias("last")), "merkle-tops")
    below = paths(leaves, bands, ["id", "digest", "claimed"], fanout, band)
    return below.join(tops, "tree").select(
        "id", F.lower(F.hex("digest")).alias("leaf"), "subroot", "root", "lo", F.concat("path", "last").alias("path"), F.lower(F.hex("claimed")).alias("claimed"))


#: Columns of ``documents`` that make a leaf, in this order.
DOCUMENT_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def tampered_leaf() -> Column:
    """The leaf with 1 added to ``n_chars`` where 7 divides the CRC-32 of the id, null elsewhere."""
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return F.when(hit, leaf_digest([more if c == "n_chars" else F.col(c) for c in DOCUMENT_COLUMNS]))


def verified_manifest(docs: DataFrame, fanout: int = FANOUT, band: int = BAND) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of a documents table."""
    rows = manifest(docs, DOCUMENT_COLUMNS, "lang", "doc_id", tampered_leaf(), fanout, band)
    rows = rows.withColumn("folded_root", fold(F.coalesce("claimed", "leaf"), F.col("path")))
    return rows.select(F.col("id").cast("long").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings_text(F.col("path")), 256).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
