"""N-gram Jaccard join by set relations: index-level and answer-level skipping.

Sets are the distinct word shingles of a text as 64-bit hashes; documents with equal sets are one node (identified by
size and two 64-bit sums of differently remixed hashes).

1. One pass sends every distinct shingle of a text once, as compressed runs sorted by hash, one per RUN_TEXTS texts and
   hash range. A range counts, over all documents, in how many texts each shingle occurs, and tells each text how many
   of its shingles another text has too. A set whose shared shingles fall short of the least overlap that the threshold
   allows can link with nothing; only the other sets go on. Counts tell shared from not shared exactly (by 48 bits of
   hash; a collision only keeps a set in).
2. The sets that are left are written once per node. A fixed table of BUCKETS counters over them orders their shingles,
   rarest first, then by hash: a total order. Each set sends its prefix (size - ceil(t * size) + 1 rarest shingles) with
   position and size to the index. Lists come sorted by size, and are read block by block: a gap in sizes wider than
   the threshold ends a segment, and an entry whose position leaves too little to share with the smallest set of its
   segment is skipped. What is left is linked to the segment's first node: linear output, and any pair that can reach
   the threshold is connected by it.
3. Components of these candidate links are cut, in order of size, into blocks of BLOCK_TOKENS shingles. Blocks, and
   pairs of blocks whose sizes are compatible, are verified exactly, every pair of sets in one of them: a leader's
   answers (its intersections with all sets of the task) come from posting lists; the answers of a set similar to it are
   derived from them by the lists of the shingles in which the two differ. Each task returns a spanning forest and, per
   node, the number of documents it links with, never pairs.
4. Components of the verified links, by the smallest document; the link counts of a node are added up.

Memory per task is bounded by two blocks; hot groups become more blocks, not larger ones. Defined results: null text
counts as empty; sets without shingles link with nothing, not even each other; equal rows are copies; a null id never
becomes a component's id unless the component has no other. ``docs`` must be a deterministic frame such as a table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starlift.llm.common import bounded_batches, buffers, doc_groups, long_array, mix64, pack_columns, shingles, unpack_columns, word_hashes, written
from starlift.llm.components import components

BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
#: Texts, and about as many shingles, of one run of the survey.
RUN_TEXTS = 4096
RUN_TOKENS = 3 << 20
#: Shingles of one verification block (a single larger set is a block of its own).
BLOCK_TOKENS = 1 << 19


def _distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    return h[np.concatenate([[True], h[1:] != h[:-1]])] if len(h) else h


def _node(h: np.ndarray) -> tuple[int, int]:
    """128 bits of a set: two sums of remixed hashes."""
    sums = [mix64(h ^ np.uint64(salt)).sum(dtype=np.uint64) + np.uint64(len(h)) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    return tuple(mix64(np.array(sums, np.uint64)).view(np.int64).tolist())


def _sets(batch: pa.RecordBatch, words: int):
    """(row index in the batch, distinct shingle hashes) of each text."""
    offsets, raw = buffers(batch.column("text"))
    for i, j in doc_groups(offsets):
        h, bounds = word_hashes(offsets[i:j + 1], raw)
        for k in range(i, j):
            yield k, _distinct(shingles(h[bounds[k - i]:bounds[k - i + 1]], words))


_RUN = "part int, run long, n long, tokens binary, texts binary"
_TOKEN = (("key", np.uint64), ("text", np.uint16))
_TEXT = (("row", np.int64), ("doc_id", np.int64), ("none", np.uint8), ("n", np.int64), ("one", np.int64), ("two", np.int64))
_COUNT = (("text", np.uint16), ("shared", np.uint32))
_SURVEY = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("one", pa.int64()), ("two", pa.int64()), ("run", pa.int64()), ("texts", pa.binary()),
                     ("k", pa.int64()), ("counts", pa.binary())])


def _runs(words: int, parts: int):
    """Per RUN_TEXTS texts: their rows, and their shingles by hash range (upper 48 bits, and the text's number)."""
    def emit(rows: dict, sets: list):
        n = len(sets)
        key = np.concatenate(sets) >> np.uint64(16)
        text = np.repeat(np.arange(n, dtype=np.uint16), [len(h) for h in sets])
        order = np.argsort(key, kind="stable")
        key, text = key[order], text[order]
        lane = (key >> np.uint64(16)) * np.uint64(parts) >> np.uint64(32)
        edges = np.searchsorted(lane, np.arange(parts + 1, dtype=np.uint64))
        first = int(rows["row"][0])
        here = pack_columns((("row", np.int64),), rows)
        for k in range(parts):
            a, z = int(edges[k]), int(edges[k + 1])
            if z > a:
                yield row_of(k, z - a, pack_columns(_TOKEN, {"key": key[a:z], "text": text[a:z]}), here, first)
        yield row_of(first % parts, n, None, pack_columns(_TEXT, rows), first)

    def row_of(part, n, tokens, texts, first):
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([n], pa.int64()), pa.array([tokens], pa.binary()),
                                           pa.array([texts], pa.binary())], names=["part", "run", "n", "tokens", "texts"])

    def run(batches):
        held: dict[str, list] = {c: [] for c, _ in _TEXT}
        sets: list[np.ndarray] = []
        size = 0
        for b in batches:
            row, ids = b.column("row").to_pylist(), b.column("doc_id").to_pylist()
            for k, h in _sets(b, words):
                for c, x in zip(held, (row[k], ids[k] or 0, ids[k] is None, len(h), *_node(h))):
                    held[c].append(x)
                sets.append(h)
                size += len(h)
                if len(sets) == RUN_TEXTS or size >= RUN_TOKENS:
                    yield from emit({c: np.array(x, t) for (c, t), x in zip(_TEXT, held.values())}, sets)
                    held, sets, size = {c: [] for c, _ in _TEXT}, [], 0
        if sets:
            yield from emit({c: np.array(x, t) for (c, t), x in zip(_TEXT, held.values())}, sets)
    return run


def _shared(batches):
    """One hash range: per run the number of shingles of each text that another text has too (packed), and the rows of texts."""
    keys, runs = [], []
    for b in batches:
        for run, n, tokens, texts in zip(b.column("run").to_pylist(), b.column("n").to_pylist(), b.column("tokens"), b.column("texts")):
            if not tokens.is_valid:
                t = unpack_columns(_TEXT, texts.as_py(), n)
                yield pa.RecordBatch.from_arrays([pa.array(t["row"]), pa.array(t["doc_id"], mask=t["none"] == 1), pa.array(t["n"]), pa.array(t["one"]), pa.array(t["two"]),
                                                  *[pa.nulls(n, f.type) for f in list(_SURVEY)[5:]]], schema=_SURVEY)
                continue
            t = unpack_columns(_TOKEN, tokens.as_py(), n)
            keys.append(t["key"])
            runs.append((t["text"].copy(), run, texts.as_py()))
    if not keys:
        return
    ends = np.cumsum([len(k) for k in keys])
    key = np.concatenate(keys)
    keys.clear()
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    del order, same, key
    for (text, first, blob), a, z in zip(runs, np.concatenate([[0], ends[:-1]]), ends):
        count = np.bincount(text[twice[a:z]])
        some = np.flatnonzero(count)
        if len(some):
            counts = pack_columns(_COUNT, {"text": some, "shared": count[some]})
            yield pa.RecordBatch.from_arrays([*[pa.nulls(1, f.type) for f in list(_SURVEY)[:5]], pa.array([first], pa.int64()), pa.array([blob], pa.binary()),
                                              pa.array([len(some)], pa.int64()), pa.array([counts], pa.binary())], schema=_SURVEY)


def _totals(pdf: pd.DataFrame) -> pd.DataFrame:
    """(row, shared) of the texts of one run, over all hash ranges; bounded by the shingles of a run."""
    raw = zstandard.ZstdDecompressor().decompress(pdf["texts"].iloc[0])
    row = unpack_columns((("row", np.int64),), pdf["texts"].iloc[0], len(raw) // 8)["row"]
    total = np.zeros(len(row), np.int64)
    for k, blob in zip(pdf["k"], pdf["counts"]):
        c = unpack_columns(_COUNT, blob, int(k))
        total[c["text"]] += c["shared"]
    some = np.flatnonzero(total)
    return pd.DataFrame({"row": row[some], "shared": total[some]})


def _counters(batches):
    """(bucket, count) of the shingles of one task's sets."""
    counts = np.zeros(BUCKETS, np.int64)
    for b in batches:
        for x in b.column("tokens"):
            h = (np.frombuffer(x.as_py(), np.uint64) & np.uint64(BUCKETS - 1)).astype(np.int64)
            np.add.at(counts, h, 1)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bucket", "n"])


def _ordered(h: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Shingles renamed one to one so that their order is the corpus order."""
    return np.sort((rank[(h & np.uint64(BUCKETS - 1)).astype(np.int64)] << np.uint64(64 - BUCKET_BITS)) | (h >> np.uint64(BUCKET_BITS)))


def _prefixes(num: int, den: int, shared):
    def run(batches):
        rank = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            sets = [_ordered(np.frombuffer(x.as_py(), np.uint64), rank) for x in b.column("tokens")]
            n = np.array([len(h) for h in sets], np.int32)
            p = n - -(-num * n // den) + 1
            at = np.concatenate([np.arange(k, dtype=np.int32) for k in p])
            yield pa.RecordBatch.from_arrays([long_array(np.concatenate([h[:k] for h, k in zip(sets, p)])), pa.array(at), pa.array(np.repeat(n, p)),
                                              pa.array(np.repeat(b.column("node").to_numpy(zero_copy_only=False), p))], names=["key", "pos", "n", "node"])
    return run


def _lists(num: int, den: int):
    """Candidate links (node, first node of its segment) of index lists sorted by (key, n, node)."""
    def run(batches):
        last = None  # key, n, node of the last entry; first node and first size of its segment
        for b in batches:
            key, pos, n, node = (b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "pos", "n", "node"))
            if not len(key):
                continue
            n, pos = n.astype(np.int64), pos.astype(np.int64)
            prev_key = np.concatenate([[last[0] if last else 0], key[:-1]])
            prev_n = np.concatenate([[last[1] if last else 0], n[:-1]])
            prev_node = np.concatenate([[last[2] if last else 0], node[:-1]])
            fresh = (key != prev_key) | (den * prev_n < num * n)
            if last is None:
                fresh[0] = True
            again = ~fresh & (node == prev_node)
            segment = np.cumsum(fresh)
            at = np.flatnonzero(fresh)
            firsts = np.concatenate([[last[3] if last else 0], node[at]])[segment]
            least = np.concatenate([[last[4] if last else 0], n[at]])[segment]
            # the largest partner that can still share enough after this position
            room = (n - pos) * (num + den) // num - n
            keep = ~fresh & ~again & (room >= least) & (node != firsts)
            last = (key[-1], n[-1], node[-1], firsts[-1], least[-1])
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(firsts[keep])], names=["a", "b"])
    return run


def answers(sizes: np.ndarray, tokens: np.ndarray, bounds: np.ndarray, asking: np.ndarray, num: int, den: int):
    """(x, intersections of set x with every set) for the sets ``asking``.

    A leader's answers are the counts of its posting lists. A set that links with the leader has the leader's answers, plus
    those of the shingles that it adds, less those of the shingles that it lacks, where that reads fewer lists.
    """
    _, token = np.unique(tokens, return_inverse=True)
    token = token.astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(token, kind="stable")
    lists = owner[order]
    start = np.searchsorted(token[order], np.arange(int(token.max()) + 2 if len(token) else 1))

    def of(shingles: np.ndarray) -> np.ndarray:
        """In how many of the lists of these shingles each set stands."""
        n = start[shingles + 1] - start[shingles]
        at = np.repeat(start[shingles] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
        return np.bincount(lists[at], minlength=len(sizes))

    sets = [np.sort(token[bounds[x]:bounds[x + 1]]) for x in range(len(sizes))]
    wait = np.zeros(len(sizes), bool)
    wait[asking] = True
    for lead in asking:
        if not wait[lead]:
            continue
        common = of(sets[lead])
        wait[lead] = False
        yield lead, common
        near = np.flatnonzero(wait & (den * common >= num * (sizes + sizes[lead] - common)))
        wait[near] = False
        for x in near:
            more, less = np.setdiff1d(sets[x], sets[lead], assume_unique=True), np.setdiff1d(sets[lead], sets[x], assume_unique=True)
            yield x, common + of(more) - of(less) if len(more) + len(less) < len(sets[x]) else of(sets[x])


def linked(sizes: np.ndarray, tokens: np.ndarray, bounds: np.ndarray, copies: np.ndarray, group: np.ndarray, side: np.ndarray | None,
           num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Labels of sets after all links among them (equal for linked sets), and per set the documents that it links with.

    ``group``: labels known so far. ``side``: only pairs of different sides count (None: all pairs). ``copies``: documents of a set.
    """
    group, count = group.copy(), np.zeros(len(sizes), np.int64)
    if side is None:
        asking = np.arange(len(sizes))
    else:  # the side with fewer sets asks, and answers for both
        low = side.min()
        asking = np.flatnonzero((side == low) == (2 * (side == low).sum() <= len(side)))
    for x, common in answers(sizes, tokens, bounds, asking, num, den):
        hit = den * common >= num * (sizes + sizes[x] - common)
        hit[x] = False
        if side is not None:
            hit &= side != side[x]
            count[hit] += copies[x]
        count[x] += copies[hit].sum()
        other = np.unique(group[hit])
        if len(other) and (len(other) > 1 or other[0] != group[x]):
            group[np.isin(group, np.append(other, group[x]))] = min(other[0], group[x])
    return group, count


def _verify(num: int, den: int, known: bool):
    """Of one block, or of a pair of blocks whose inner links are known: a spanning forest (a, b), and link counts (a, links)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("node").sort_values(["n", "node"])
        sets = [np.frombuffer(x, np.uint64) for x in pdf["tokens"]]
        sizes = np.array([len(s) for s in sets], np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        nodes = pdf["node"].to_numpy(np.int64)
        before = pdf["known"].to_numpy(np.int64) if known else nodes
        side = pdf["block"].to_numpy(np.int64) if known else None
        after, count = linked(sizes, np.concatenate(sets) if sets else np.zeros(0, np.uint64), bounds, pdf["copies"].to_numpy(np.int64), before, side, num, den)
        new, some = np.flatnonzero(after != before), np.flatnonzero(count)
        edges = pd.DataFrame({"a": before[new], "b": after[new]}).drop_duplicates().assign(links=0)
        counts = pd.DataFrame({"a": nodes[some], "b": nodes[some], "links": count[some]})
        return pd.concat([edges, counts]).astype("int64")
    return run


def running_sum(rows: DataFrame, group: str, order: list[str], weight: str, name: str) -> DataFrame:
    """``rows`` with ``name``: the sum of ``weight`` of the rows of the same group before them.

    Range-sorted and written; partition sums per group are added up before each. A hot group spans partitions.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = rows.repartitionByRange(n, group, *order).sortWithinPartitions(group, *order).withColumn("__at", F.monotonically_increasing_id())
    kept = written(kept, "ranked").withColumn("__part", F.shiftright("__at", 33))
    sums = kept.groupBy(group, "__part").agg(F.sum(weight).alias("__n"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(group, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__zero"))
    inner = Window.partitionBy(group, "__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    out = kept.withColumn("__in", F.coalesce(F.sum(weight).over(inner), F.lit(0)))
    return out.join(starts, [group, "__part"]).withColumn(name, F.col("__in") + F.col("__zero")).drop("__at", "__part", "__in", "__zero")


def jaccard_components(docs: DataFrame, words: int = 3, threshold: tuple[int, int] = (90, 100), block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per input row: row, doc_id, n_shingles, node (class of equal sets), component_id, first_row, n_links.

    Sets link when ``den * intersection >= num * union``; component_id is the smallest doc_id that links reach;
    first_row is the first row, by (doc_id, row), of the component; n_links counts the other documents that the
    document links with, copies included.
    """
    spark, (num, den) = docs.sparkSession, threshold
    bounded_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    runs = rows.mapInArrow(_runs(words, parts), _RUN).repartitionById(parts, F.col("part"))
    survey = written(runs.mapInArrow(_shared, "row long, doc_id long, n long, one long, two long, run long, texts binary, k long, counts binary"), "survey")
    members = survey.where("run is null").select("row", "doc_id", "n", "one", "two")
    common = survey.where("run is not null").select("run", "texts", "k", "counts").groupBy("run").applyInPandas(_totals, "row long, shared long")
    able = members.join(common, "row").where(f"n > 0 and {den} * shared >= {num} * n")
    # a class is known by the first of its rows from here on
    own = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row"))
    able = written(able.groupBy("one", "two").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"), F.min(own).alias("first")), "classes")

    def tokens(batches):
        for b in batches:
            sets = [h for _, h in _sets(b, words)]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array([len(h) for h in sets], pa.int64()), pa.array([h.tobytes() for h in sets], pa.binary())],
                                             names=["node", "n", "tokens"])

    sets = rows.select(F.col("row").alias("node"), "text").join(able.select("node").hint("shuffle_hash"), "node").select("node", "text")
    sets = written(sets.mapInArrow(tokens, "node long, n long, tokens binary"), "sets")
    counted = sets.select("tokens").mapInArrow(_counters, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # at most BUCKETS rows
    total = np.zeros(BUCKETS, np.int64)
    total[counted["bucket"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    rank = np.empty(BUCKETS, np.uint64)
    rank[np.argsort(total, kind="stable")] = np.arange(BUCKETS, dtype=np.uint64)
    shared = spark.sparkContext.broadcast(rank)

    index = sets.select("node", "tokens").mapInArrow(_prefixes(num, den, shared), "key long, pos int, n int, node long")
    lists = index.repartition("key").sortWithinPartitions("key", "n", "node")
    links = lists.mapInArrow(_lists(num, den), "a long, b long")
    near = written(components(links), "near")
    nodes = near.select("node", "label").unionByName(near.select(F.col("label").alias("node"), "label").distinct())
    nodes = nodes.join(sets.select("node", "n"), "node").join(able.select("node", "copies"), "node")
    cut = running_sum(nodes, "label", ["n", "node"], "n", "before").withColumn("block", F.expr(f"before div {block_tokens}"))
    cut = written(cut.select("node", "n", "copies", "label", "block"), "blocks")
    sets = sets.select("node", "tokens").join(cut, "node")
    inside = written(sets.withColumn("known", F.col("node")).groupBy("label", "block").applyInPandas(_verify(num, den, False), "a long, b long, links long"), "inside")
    cut = cut.join(inside.where("a <> b").select(F.col("a").alias("node"), F.col("b").alias("known")), "node", "left").select(
        "node", "label", "block", "n", F.coalesce("known", "node").alias("known"))
    blocks = cut.groupBy("label", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    one, two = blocks.select("label", F.col("block").alias("i"), F.col("high")), blocks.select("label", F.col("block").alias("j"), F.col("low"))
    pairs = one.join(two, "label").where(f"i < j and {den} * high >= {num} * low").select("label", "i", "j")
    meets = pairs.select("label", "i", "j", F.explode(F.array("i", "j")).alias("block"))
    sets = sets.select("node", "n", "copies", "tokens", F.col("block"), "label").join(cut.select("node", "known"), "node")
    across = written(meets.join(sets, ["label", "block"]).groupBy("label", "i", "j").applyInPandas(_verify(num, den, True), "a long, b long, links long"), "across")
    both = inside.unionByName(across)
    found = written(components(both.where("a <> b").select("a", "b")), "found")
    links = both.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))

    # the first document of every component, worked out over classes; then one join with the rows
    found = found.unionByName(found.select(F.col("label").alias("node"), "label").distinct())
    classes = written(able.join(found, "node", "left").join(links, "node", "left").select("one", "two", "node", "copies", "first", "label", F.coalesce("links", F.lit(0)).alias("links")), "named")
    lead = classes.where("label is not null").groupBy("label").agg(F.min("first").alias("lead"))
    joined = classes.where("label is not null").join(lead, "label").drop("label")
    named = joined.unionByName(classes.where("label is null").withColumn("lead", F.col("first")).drop("label"))
    named = named.select("one", "two", "node", (F.col("copies") - 1 + F.col("links")).alias("links"), "lead", F.lit(True).alias("classed"))
    # sets without shingles, and sets that can link with nothing, stay alone
    out = members.join(written(named, "classed"), ["one", "two"], "left")
    return out.select("row", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("node", "row").alias("node"),
                      F.when(F.col("classed"), F.col("lead.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
                      F.when(F.col("classed"), F.col("lead.row")).otherwise(F.col("row")).alias("first_row"),
                      F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))


def without_near_copies(docs: DataFrame, words: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """The first document, by id, of each component; columns unchanged."""
    drop = jaccard_components(docs, words, threshold).where("row <> first_row").select(F.col("row").alias("__join_row"))
    return docs.withColumn("__join_at", F.monotonically_increasing_id()).join(drop, F.col("__join_at") == F.col("__join_row"), "left_anti").drop("__join_at")
