"""Suffix-array dedup of byte strings of LENGTH that also start earlier, across all documents.

A suffix starts at every byte; sorted by their first LENGTH bytes, equal strings are neighbours, and all but the
earliest of a run mark their bytes for removal. Shipping every suffix would multiply the input, so suffixes travel in
bundles: each LENGTH-byte window belongs to its sync point, the place of the smallest hash of GRAM bytes in it
(leftmost on ties). That place depends on the window's bytes only, so equal windows have equal sync points at equal
distances, and bundles (one per sync point, about one per (LENGTH - GRAM) / 2 bytes) lose none.

1. One pass sends, for each bundle, a hash of its sync point's GRAM bytes and a digest of all its bytes, with its
   place. Entries travel as sorted, compressed runs, one per batch and hash range, and meet by gram. Bundles equal in
   all bytes are one from here on: the earliest stands for them, the others are answered. A gram with one kind of
   bundle is settled; the others go on, once per kind.
2. The documents of those cut their bundles: all suffixes of one sync point, as one string. Sampled splitters
   range-partition them by their leading bytes, so each bucket is a range of the sorted order and runs of one gram
   never cross a boundary.
3. A bucket sorts the suffixes of bundles that differ by multikey quicksort over eight-byte characters (ties only go
   on to the next character); in a run all but the earliest are removed.
4. Removed windows come back to their document as byte ranges.

Copies are collapsed before each shuffle: a batch sends one of equal bundles and answers the others on the spot, so a
text in a third of all documents is an entry per batch. Defined results: null text counts as empty; of equal doc_ids the first row
counts as earlier; a null doc_id comes first; texts under LENGTH bytes keep all. ``docs`` must be a deterministic
frame such as a table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlift.llm.common import bounded_batches, buffers, byte_digests, mix64, pack_columns, unpack_columns, written

LENGTH = 100
GRAM = 24
#: Windows hashed at once.
STEP = 1 << 19
#: Text of one run of entries.
RUN_BYTES = 12 << 20
#: Suffixes sorted at once; more only where one gram has more.
SORT_WINDOWS = 1 << 17
#: Rows of one batch that a task returns.
PIECE = 1 << 15

_PLACE = np.uint64((1 << 20) - 1)
_FIRST = np.iinfo(np.int64).min


def _load(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number."""
    return np.ndarray((len(raw) - 7,), "<u8", buffer=np.ascontiguousarray(raw), strides=(1,)).copy()


def _gram_hash(word: np.ndarray) -> np.ndarray:
    n = len(word) - (GRAM - 8)
    h = word[:n] * np.uint64(0x9E3779B97F4A7C15)
    for k in range(8, GRAM, 8):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + word[k:n + k]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    m, k = x, 1
    while 2 * k <= width:
        m = np.minimum(m[:-k], m[k:])
        k *= 2
    return m if k == width else np.minimum(m[:len(m) - (width - k)], m[width - k:])


def bundles(offsets: np.ndarray, raw: np.ndarray, length: int = LENGTH, digests: bool = False):
    """Per step: (document, sync point, first window, last window, hash of the gram, digest); places are in ``raw``.

    The digest covers all bytes of the bundle and the place of the sync point in it.
    """
    begin, end = int(offsets[0]), int(offsets[-1])
    width = length - GRAM + 1
    for c in range(begin, end - length + 1, STEP):
        seg = raw[c:min(end, c + STEP + length - 1)]
        h = _gram_hash(_load(seg))
        place = np.arange(len(h), dtype=np.uint64)
        sync = (_window_min((h & ~_PLACE) | place, width) & _PLACE).astype(np.int64)
        windows = len(seg) - length + 1
        ok = np.ones(windows, bool)
        for e in offsets[np.searchsorted(offsets, c, "left"):np.searchsorted(offsets, c + len(seg), "left")]:
            ok[max(0, int(e) - c - length + 1):max(0, int(e) - c)] = False
        first = ok.copy()
        first[1:] &= (sync[1:windows] != sync[:windows - 1]) | ~ok[:-1]
        lo = np.flatnonzero(first)
        if not len(lo):
            continue
        last = ok.copy()
        last[:-1] &= (sync[1:windows] != sync[:windows - 1]) | ~ok[1:]
        hi = np.flatnonzero(last)
        at = sync[lo]
        digest = byte_digests(seg, lo, hi + length) + (at - lo).astype(np.uint64) if digests else None
        # a sync point's hash is the smallest of many: remixed, it is even over the range
        yield np.searchsorted(offsets, lo + c, "right") - 1, at + c, lo + c, hi + c, mix64(h[at]), digest if digest is None else mix64(digest)


_ENTRY = (("gram", np.uint64), ("digest", np.uint64), ("doc", np.int64), ("row", np.int64), ("at", np.uint32), ("off", np.uint8), ("span", np.uint8))
_ANSWER = (("row", np.int64), ("start", np.uint32), ("end", np.uint32))


def _later(cols: dict, order: np.ndarray) -> np.ndarray:
    """Along ``order``: whether an entry equals the one before it in gram and digest."""
    g, d = cols["gram"][order], cols["digest"][order]
    return np.concatenate([[False], (g[1:] == g[:-1]) & (d[1:] == d[:-1])])


def _answers(cols: dict, which: np.ndarray, length: int) -> dict:
    start = cols["at"][which].astype(np.int64) - cols["off"][which]
    return {"row": cols["row"][which], "start": start, "end": start + cols["span"][which] + length}


def _grams(length: int, parts: int):
    """Runs of entries, one per RUN_BYTES of text and hash range, and the answers that they know already."""
    def run(batches):
        held: list[dict] = []
        size = 0
        for b in batches:
            offsets, raw = buffers(b.column("text"))
            ids = b.column("doc_id").fill_null(_FIRST).to_numpy(zero_copy_only=False)
            row = b.column("row").to_numpy(zero_copy_only=False)
            for doc, at, lo, hi, gram, digest in bundles(offsets, raw, length, True):
                held.append({"gram": gram, "digest": digest, "doc": ids[doc], "row": row[doc], "at": (at - offsets[doc]).astype(np.uint32),
                             "off": (at - lo).astype(np.uint8), "span": (hi - lo).astype(np.uint8)})
            size += int(offsets[-1] - offsets[0])
            if size >= RUN_BYTES and held:
                yield from _sorted_runs(held, length, parts)
                held, size = [], 0
        if held:
            yield from _sorted_runs(held, length, parts)
    return run


def _sorted_runs(held: list[dict], length: int, parts: int):
    cols = {c: np.concatenate([h[c] for h in held]) for c, _ in _ENTRY}
    held.clear()
    order = np.lexsort((cols["at"], cols["row"], cols["doc"], cols["digest"], cols["gram"]))
    later = _later(cols, order)
    known, order = order[later], order[~later]
    lane = (cols["gram"][order] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    edges = np.searchsorted(lane, np.arange(parts + 1, dtype=np.uint64))
    for k in range(parts):
        mine = order[edges[k]:edges[k + 1]]
        if len(mine):
            yield _run(k, len(mine), pack_columns(_ENTRY, {c: x[mine] for c, x in cols.items()}), None)
    if len(known):
        yield _run(int(cols["gram"][known[0]] % np.uint64(parts)), len(known), None, pack_columns(_ANSWER, _answers(cols, known, length)))


def _run(part: int, n: int, entries: bytes | None, answers: bytes | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([entries], pa.binary()), pa.array([answers], pa.binary())],
                                      names=["part", "n", "entries", "answers"])


_SETTLED = pa.schema([("row", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("place", pa.int64())])


def _settle(length: int):
    """One hash range: answers (row, start, end), and the places (row, place) whose bytes must be compared."""
    def rows(row, start=None, end=None, place=None):
        cols = [pa.nulls(len(row), pa.int64()) if x is None else pa.array(np.asarray(x, np.int64)) for x in (start, end, place)]
        return pa.RecordBatch.from_arrays([pa.array(row), *cols], schema=_SETTLED)

    def run(batches):
        runs = []
        for b in batches:
            for n, entries, answers in zip(b.column("n").to_pylist(), b.column("entries"), b.column("answers")):
                if answers.is_valid:
                    got = unpack_columns(_ANSWER, answers.as_py(), n)
                    for i in range(0, n, PIECE):
                        yield rows(**{c: x[i:i + PIECE] for c, x in got.items()})
                else:
                    runs.append(unpack_columns(_ENTRY, entries.as_py(), n))
        if not runs:
            return
        cols = {c: np.concatenate([r[c] for r in runs]) for c, _ in _ENTRY}
        runs.clear()
        order = np.argsort(cols["gram"], kind="stable")
        g = cols["gram"][order]
        same = g[1:] == g[:-1]
        twice = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
        if not len(twice):
            return
        cols = {c: x[twice] for c, x in cols.items()}
        order = np.lexsort((cols["at"], cols["row"], cols["doc"], cols["digest"], cols["gram"]))
        later = _later(cols, order)
        for part in np.array_split(order[later], 1 + int(later.sum()) // PIECE):
            yield rows(**_answers(cols, part, length))
        kinds = order[~later]
        g = cols["gram"][kinds]
        same = g[1:] == g[:-1]
        open_ = kinds[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
        for part in np.array_split(open_, 1 + len(open_) // PIECE):
            yield rows(cols["row"][part], place=cols["at"][part])
    return run


_BUNDLE = pa.schema([("lead", pa.int64()), ("doc", pa.int64()), ("row", pa.int64()),
                     ("lo", pa.int64()), ("span", pa.int32()), ("off", pa.int32()), ("bytes", pa.binary())])


def _cut(length: int):
    """Bundles at the listed places, with their leading eight bytes as an ordered number."""
    def run(batches):
        for b in batches:
            offsets, raw = buffers(b.column("text"))
            row = b.column("row").to_numpy(zero_copy_only=False)
            ids = b.column("doc_id").fill_null(_FIRST).to_numpy(zero_copy_only=False)
            places = b.column("places")
            sizes = places.value_lengths().to_numpy(zero_copy_only=False)
            wanted = np.sort(np.repeat(offsets[:-1], sizes) + places.flatten().to_numpy(zero_copy_only=False))
            for doc, at, lo, hi, _, _ in bundles(offsets, raw, length):
                mine = np.searchsorted(wanted, at)
                hit = np.flatnonzero((mine < len(wanted)) & (wanted[np.minimum(mine, len(wanted) - 1)] == at))
                if not len(hit):
                    continue
                doc, at, lo, hi = doc[hit], at[hit], lo[hit], hi[hit]
                data = [raw[p:q + length].tobytes() for p, q in zip(lo.tolist(), hi.tolist())]
                lead = np.array([int.from_bytes(x[o:o + 8], "big") for x, o in zip(data, (at - lo).tolist())], np.uint64) ^ np.uint64(1 << 63)
                yield pa.RecordBatch.from_arrays([pa.array(lead.view(np.int64)), pa.array(ids[doc]), pa.array(row[doc]), pa.array(lo - offsets[doc]),
                                                  pa.array((hi - lo).astype(np.int32)), pa.array((at - lo).astype(np.int32)), pa.array(data, pa.binary())],
                                                 schema=_BUNDLE)
    return run


def multikey_runs(view: np.ndarray, pos: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes at ``pos`` sorted group by group, character (eight bytes) by character, over ``length`` bytes.

    Returns the suffixes that have an equal, and the number of their run. A suffix without a tie drops out at once.
    """
    live = np.arange(len(pos))
    for k in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        if not len(live):
            break
        word = view[pos[live] + k]
        order = np.lexsort((word, group))
        live, group, word = live[order], group[order], word[order]
        step = np.concatenate([[True], (group[1:] != group[:-1]) | (word[1:] != word[:-1])])
        group = np.cumsum(step)
        tied = np.concatenate([~step[1:], [False]]) | ~step
        live, group = live[tied], group[tied]
    return live, group


def _resolve(t: pa.Table, length: int):
    """(row, start, end) of the bytes covered by removed windows; all bundles of a gram are here."""
    rows, lo, span, off, doc = (t.column(c).to_numpy().astype(np.int64) for c in ("row", "lo", "span", "off", "doc"))
    data = t.column("bytes").to_pylist()
    _, gram = np.unique(np.array([x[o:o + GRAM] for x, o in zip(data, off.tolist())], f"S{GRAM}"), return_inverse=True)
    kept = np.flatnonzero(np.bincount(gram)[gram] > 1)
    if not len(kept):
        return rows[:0], lo[:0], lo[:0]
    order = np.lexsort((lo, rows, doc))
    rank = np.empty(len(rows), np.int64)
    rank[order] = np.arange(len(rows))
    kept = kept[np.argsort(gram[kept], kind="stable")]
    # whole grams, about SORT_WINDOWS suffixes at a time
    windows = np.cumsum(span[kept] + 1)
    ends = np.flatnonzero(np.concatenate([gram[kept][1:] != gram[kept][:-1], [True]])) + 1
    ends = ends[np.concatenate([windows[ends[1:] - 1] // SORT_WINDOWS != windows[ends[:-1] - 1] // SORT_WINDOWS, [True]])]
    out = []
    for part in np.split(kept, ends[:-1]):
        i, a, z = _removed([data[x] for x in part], gram[part], off[part], span[part], rank[part], length)
        out.append((rows[part[i]], lo[part[i]] + a, lo[part[i]] + z + length))
    return [np.concatenate(x) for x in zip(*out)]


def _removed(data: list, gram, off, span, rank, length: int):
    """(bundle, first, last) of the windows that an earlier bundle of the same gram holds too."""
    raw = np.frombuffer(b"".join(data) + bytes(8), np.uint8)
    sizes = span + length
    base = np.cumsum(sizes) - sizes
    count = span + 1
    who = np.repeat(np.arange(len(data)), count)
    j = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    live, run = multikey_runs(_load(raw), base[who] + j, gram[who] * 256 + off[who] - j, length)
    best = np.lexsort((rank[who[live]], run))
    again = run[best][1:] == run[best][:-1]
    removed = np.sort(live[best][1:][again])
    edge = np.concatenate([[True], (np.diff(removed) != 1) | (who[removed[1:]] != who[removed[:-1]])])[:len(removed)]
    a, z = removed[edge], removed[np.concatenate([edge[1:], [True]])[:len(removed)]]
    return who[a], j[a], j[z]


def _buckets(length: int):
    """One range of the sorted order; bundles of one lead are complete when the next lead comes."""
    def run(batches):
        held: list[pa.Table] = []

        def settle():
            r, s, e = _resolve(pa.concat_tables(held), length)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(r), pa.array(s), pa.array(e)], names=["row", "start", "end"])

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            lead = b.column("lead").to_numpy(zero_copy_only=False)
            last = int(np.searchsorted(lead, lead[-1], "left"))
            if held and (last or held[0].column("lead")[-1].as_py() != int(lead[0])):
                held.append(t.slice(0, last))
                yield settle()
            elif last:
                held.append(t.slice(0, last))
                yield settle()
            held.append(t.slice(last))
        if held:
            yield settle()
    return run


def _strip(batches):
    for b in batches:
        out = []
        for text, spans in zip(b.column("text"), b.column("spans")):
            data, spans = text.as_py().encode(), spans.as_py() or []
            removed = n = 0
            kept, at = [], 0
            end = -1
            for s in sorted((x["start"], x["end"]) for x in spans):
                if s[0] > end:  # a new maximal run
                    n += 1
                    kept.append(data[at:s[0]])
                    removed += s[1] - s[0]
                elif s[1] > end:
                    removed += s[1] - end
                end = at = max(end, s[1])
            kept.append(data[at:])
            out.append((len(data), removed, n, hashlib.sha256(b"".join(kept)).hexdigest()))
        cols = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def removed_ranges(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(row, start, end) of bytes to remove, ranges may overlap. ``rows``: row, doc_id, text."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = rows.mapInArrow(_grams(length, n), "part int, n long, entries binary, answers binary")
    settled = runs.repartitionById(n, F.col("part")).mapInArrow(_settle(length), "row long, start long, end long, place long")
    settled = written(settled, "settled")
    # at most one place per sync point of the text
    places = settled.where("place is not null").groupBy("row").agg(F.collect_list("place").alias("places"))
    cut = rows.join(places.hint("shuffle_hash"), "row").mapInArrow(_cut(length), "lead long, doc long, row long, lo long, span int, off int, bytes binary")
    ranges = cut.repartitionByRange(n, "lead").sortWithinPartitions("lead").mapInArrow(_buckets(length), "row long, start long, end long")
    return settled.where("place is null").select("row", "start", "end").unionByName(ranges)


def suffix_dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    if length < GRAM + 8 or length > 250:
        raise ValueError("length must be from GRAM + 8 to 250")
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ranges = removed_ranges(rows, length).groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    out = rows.join(ranges.hint("shuffle_hash"), "row", "left").select("doc_id", "text", "spans")
    return out.mapInArrow(_strip, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
