"""SimHash by pivot tables against plain fingerprints and all pairs."""

import os
import random
import re
import sys

import numpy as np
import pytest
import xxhash

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from starlift.llm import simhash_pivots as sp  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text, k=3):
    ws = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(ws[i:i + k]) for i in range(len(ws) - k + 1)] if len(ws) >= k else [" ".join(ws)] if ws else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps):
    label = {f: f for f in fps}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    fs = sorted(label)
    for i, a in enumerate(fs):
        for b in fs[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                label[find(a)] = find(b)
    return {f: find(f) for f in fs}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = "alpha Beta gamma DELTA the of river stone ÉTÉ naïve 東京 x1".split()
    text = lambda n: " ".join(rng.choice(vocabulary) + str(rng.randrange(30)) for _ in range(n))
    out = []
    for k in range(40):
        t = text(rng.randrange(150, 900))
        out.append((k, t))
        for v in range(rng.randrange(4)):
            w = t.split()
            w[rng.randrange(len(w))] = "edited"
            out.append((100 + 10 * k + v, "\n ".join(w).swapcase()))
    out += [(900, None), (901, ""), (902, "\t \n"), (903, "one"), (904, "one Two"), (905, "z" * 3_000_000), (906, text(5)), (907, text(90000) + " " * 1_100_000 + "end"),
            (None, out[0][1]), (0, out[0][1]), (None, "only null")]
    rng.shuffle(out)
    return out


def test_components_equal_all_pairs(spark, rows):
    docs = spark.createDataFrame([(d, t, 1, "k", 5) for d, t in rows], "doc_id long, text string, fp long, key string, low long").repartition(3)
    got = sp.simhash_components(docs).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    comp = plain_components(fps)
    low = {}
    for (d, _), f in zip(rows, fps):
        ids = low.setdefault(comp[f], [])
        if d is not None:
            ids.append(d)
    want = sorted((str(d), f"{f:016x}", min(low[comp[f]], default=None), fps.count(f)) for (d, _), f in zip(rows, fps))
    assert sorted((str(r[0]), *r[1:]) for r in got) == want
    assert len({r["component_id"] for r in got}) < len({r["fingerprint"] for r in got})  # some links are between different fingerprints


def test_empty_table(spark):
    assert sp.simhash_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pieces_do_not_change_the_shingles(monkeypatch):
    text = " ".join(f"w{k % 97}" for k in range(500)).encode()
    whole = np.concatenate(list(sp.shingle_hashes(text)))
    monkeypatch.setattr(sp, "PIECE_BYTES", 7)
    assert (np.concatenate(list(sp.shingle_hashes(text))) == whole).all()


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_links_of_dense_fingerprints(spark, radius):
    """A ball around one fingerprint, chains and random ones: every link is found, none is invented."""
    rng = np.random.default_rng(radius)
    centre = int(rng.integers(0, 2**63))
    fps = {centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (300, 2))} | {int(x) for x in rng.integers(0, 2**63, 200)}
    chain = int(rng.integers(0, 2**63))
    for b in rng.permutation(64):
        chain ^= 1 << int(b)
        fps.add(chain)
    fps = np.array(sorted(fps), np.uint64)
    table = sp.pivot_table(fps)
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if (int(fps[i]) ^ int(fps[j])).bit_count() <= radius}
    assert all(np.abs(table[i] - table[j]).max() <= radius for i, j in want)
    k = sp.keys(table, radius)
    got = set()
    for c in range(k.shape[1]):
        for i, j in sp.linked_pairs(k[:, c], fps, radius):
            got |= {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())}
    assert got == want
    nodes = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(4)
    edges = [(int(r["a"]), int(r["b"])) for r in sp.near_links(nodes, radius).collect()]
    whole, found = list(range(len(fps))), list(range(len(fps)))
    at = {int(x): i for i, x in enumerate(fps.view(np.int64))}

    def group(label, pairs):
        changed = True
        while changed:
            changed = False
            for a, b in pairs:
                low = min(label[a], label[b])
                if label[a] != low or label[b] != low:
                    label[a] = label[b] = low
                    changed = True
        return label
    assert group(found, [(at[a], at[b]) for a, b in edges]) == group(whole, want)
