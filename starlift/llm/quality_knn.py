"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

Fit, on a bounded sample: up to PER_LABEL labelled rows of each label, by hash of the id. A text is its counts of
three-character shapes (letters, capitals, digits and bytes outside ASCII fold to one class each; every sign is its
own class) hashed to DIMENSIONS, as log counts times inverse document frequency; the RANK leading singular
directions span the space. Score, over all rows: the labelled vectors are broadcast (at most 2 * PER_LABEL * RANK
floats), exact cosine products are taken block by block, and the NEIGHBOURS nearest vote with weight
similarity ** SHARPNESS, corrected from the sample's label shares to those of all training rows.

Inputs of a score are the text alone. Defined results: null or empty text has no direction and scores the training
share of label 1; ties in similarity vote in sample order; labels of one id are averaged; null labels don't count;
without training rows every score is 0.5; repeated rows give repeated results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlift.llm.common import bounded_batches, buffers, doc_groups, mix64, texts

PER_LABEL = 2000
DIMENSIONS = 1024
RANK = 48
NEIGHBOURS = 24
SHARPNESS = 8.0
THRESHOLD = 0.3
#: Rows of one block of cosine products.
BLOCK = 1024


def _classes() -> np.ndarray:
    c = np.zeros(256, np.int64)
    signs = [b for b in range(128) if not chr(b).isalnum()]
    c[signs] = 4 + np.arange(len(signs))
    c[[b for b in range(128) if chr(b).islower()]] = 0
    c[[b for b in range(128) if chr(b).isupper()]] = 1
    c[48:58] = 2
    c[128:] = 3
    return c


_CLASS = _classes()
_N = int(_CLASS.max()) + 1
_BUCKET = (mix64(np.arange(_N**3, dtype=np.uint64) + np.uint64(77)) % np.uint64(DIMENSIONS)).astype(np.int16)
_TRIPLE = _CLASS.astype(np.int32)


def shape_counts(offsets: np.ndarray, raw: np.ndarray, step: int = 1 << 19) -> np.ndarray:
    """Hashed shape counts of each text; a long text is counted piece by piece."""
    out = np.zeros((len(offsets) - 1, DIMENSIONS), np.float32)
    for i in range(len(offsets) - 1):
        lo, hi = int(offsets[i]), int(offsets[i + 1])
        for a in range(lo, max(lo, hi - 2), step):
            c = _TRIPLE[raw[a:min(hi, a + step + 2)]]
            code = (c[:-2] * _N + c[1:-1]) * _N + c[2:]
            out[i] += np.bincount(_BUCKET[code], minlength=DIMENSIONS)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


def _featured(batches):
    for b in batches:
        offsets, raw = buffers(b.column("text"))
        for i, j in doc_groups(offsets, 1 << 22):
            x = shape_counts(offsets[i:j + 1], raw).astype(np.float32)
            yield pa.RecordBatch.from_arrays([b.column("label").slice(i, j - i), b.column("doc_id").slice(i, j - i),
                                              pa.array([r.tobytes() for r in x], pa.binary())], names=["label", "doc_id", "x"])


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, label) of the rows that may be learned from: crc32 of the id as text, mod 5, is not 0."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("q"))
            .where("doc_id is not null and q is not null")
            .where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
            .groupBy("doc_id").agg(F.avg("q").alias("label")))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> dict:
    """The model: idf, projection, labelled vectors, their labels and vote weights, and the share of label 1."""
    good = training_labels(labels).join(texts(docs).select("doc_id").distinct(), "doc_id", "left_semi")
    side = F.when(F.col("label") >= 0.5, 1).otherwise(0)
    totals = {r[0]: r[1] for r in good.groupBy(side.alias("s")).count().collect()}
    pick = [good.where(side == s).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for s in (0, 1)]
    sample = pick[0].unionByName(pick[1])
    # at most 2 * per_label rows: a bounded broadcast; one text of an id that repeats
    rows = texts(docs).join(F.broadcast(sample), "doc_id").select("label", "doc_id", "text")
    got = rows.mapInArrow(_featured, "label double, doc_id long, x binary").toPandas()
    got = got.sort_values(["doc_id", "x"]).drop_duplicates("doc_id")
    n = sum(totals.values())
    model = {"share": totals.get(1, 0) / n if n else 0.5}
    if not len(got):
        return model | {"idf": np.zeros(DIMENSIONS, np.float32), "axes": np.zeros((DIMENSIONS, 1), np.float32),
                        "z": np.zeros((0, 1), np.float32), "y": np.zeros(0, np.float32), "w": np.zeros(0, np.float32)}
    x = np.stack([np.frombuffer(v, np.float32) for v in got["x"]])
    idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1).astype(np.float32)
    u = _unit(np.log1p(x) * idf)
    _, vec = np.linalg.eigh((u.T @ u).astype(np.float64))
    axes = np.ascontiguousarray(vec[:, ::-1][:, :RANK]).astype(np.float32)
    y = got["label"].to_numpy(np.float32)
    one = y >= 0.5
    w = np.where(one, totals.get(1, 0) / max(1, one.sum()), totals.get(0, 0) / max(1, (~one).sum())).astype(np.float32)
    return model | {"idf": idf, "axes": axes, "z": _unit(u @ axes), "y": y, "w": w}


def vote(model: dict, x: np.ndarray) -> np.ndarray:
    """Scores of shape counts, block by block."""
    out = np.full(len(x), model["share"])
    if not len(model["z"]):
        return out
    for a in range(0, len(x), BLOCK):
        u = _unit(np.log1p(x[a:a + BLOCK]) * model["idf"])
        sim = np.clip(_unit(u @ model["axes"]) @ model["z"].T, 0, 1)
        k = min(NEIGHBOURS, sim.shape[1])
        near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        w = np.take_along_axis(sim, near, axis=1).astype(np.float64) ** SHARPNESS * model["w"][near]
        total = w.sum(axis=1)
        some = total > 1e-12
        out[a:a + BLOCK][some] = ((w * model["y"][near]).sum(axis=1)[some]) / total[some]
    return np.clip(np.round(out, 6), 0, 1)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``quality_score`` (0 to 1); other columns pass unread."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            offsets, raw = buffers(b.column("text"))
            for i, j in doc_groups(offsets, 1 << 22):
                s = vote(shared.value, shape_counts(offsets[i:j + 1], raw))
                yield pa.RecordBatch.from_arrays([b.column("row").slice(i, j - i), pa.array(s)], names=["row", "quality_score"])

    inner = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = inner.select("row").schema.add("quality_score", "double")
    return inner.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    rows = score(texts(docs), fit(docs, labels, per_label))
    held = F.coalesce(F.crc32(F.col("row.doc_id").cast("string")) % 5 == 0, F.lit(False))
    return rows.select("row.doc_id", held.alias("held_out"), F.col("quality_score").alias("score"),
                       F.when(F.col("quality_score") >= threshold, 1).otherwise(0).alias("predicted"))
