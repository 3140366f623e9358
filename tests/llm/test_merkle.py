"""The Merkle manifest against a plain tree on small tables: nulls, ties, repeated rows, one-row groups, an empty table."""

import hashlib
import os
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from starlift.llm import merkle  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, lo long, children string"


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, more=0):
    doc_id, text, lang, source, n = r
    return digest("".join(map(field, (doc_id, source, lang, n if n is None else n + more, text))))


def plain_tree(leaves, fanout):
    paths, members, nodes = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(nodes) > 1:
        up, below = [], []
        for i in range(0, len(nodes), fanout):
            run = nodes[i:i + fanout]
            for j in range(len(run)):
                for m in members[i + j]:
                    paths[m].append((run[:j], run[j + 1:]))
            up.append(digest("".join(run)))
            below.append(sum(members[i:i + fanout], []))
        nodes, members = up, below
    return nodes[0], paths


def brute(rows, fanout):
    leaf = [leaf_of(r) for r in rows]
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    sub, path = {}, {}
    for lang in langs:
        own = sorted((i for i, r in enumerate(rows) if r[2] == lang), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaf[i]))
        sub[lang], paths = plain_tree([leaf[i] for i in own], fanout)
        path |= dict(zip(own, paths))
    root, over = plain_tree([sub[x] for x in langs], fanout)
    over = dict(zip(langs, over))
    out = []
    for i, r in enumerate(rows):
        steps = path[i] + over[r[2]]
        acc = leaf_of(r, 1) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else leaf[i]
        for left, right in steps:
            acc = digest("".join(left) + acc + "".join(right))
        out.append((str(r[0]), leaf[i], sub[r[2]], root, digest("".join("".join(a) + "".join(b) for a, b in steps)), acc, acc == root))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    out = [(k, f"text {k} Ünï", ["en", "de", None, "", "EN"][k % 5] if k % 3 else "en", None if k % 11 == 0 else f"s{k % 4}", None if k % 13 == 0 else k * 7) for k in range(90)]
    out += [(None, "no id", "en", "s", 3), (None, None, None, None, None), (500, "", "fr", "s", 0), (7, "again", "en", "s1", 1), (7, "again", "en", "s1", 1),
            (8, "x" * 70000, "en", "s", 70000), (9_000_000_000_000_000_000, "big", "en", "s", 2 ** 63 - 1)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, "c") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("fanout,band", [(2, 8), (2, 2), (3, 2)])
def test_manifest_equals_plain_tree(spark, rows, fanout, band):
    got = merkle.verified_manifest(frame(spark, rows), fanout, band).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == brute(rows, fanout)


def test_one_row_and_no_row(spark, rows):
    got = merkle.verified_manifest(frame(spark, rows[1:2])).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == brute(rows[1:2], 2)
    assert got[0]["root"] == got[0]["leaf"]
    assert merkle.verified_manifest(frame(spark, rows[:0])).count() == 0


def test_intervals_of_siblings(spark, rows):
    """Every proof step holds the digests of the parent's other children only."""
    docs = frame(spark, rows)
    paths = merkle.manifest(docs, merkle.DOCUMENT_COLUMNS, "lang", "doc_id").select("lo", "path").collect()
    for r in paths:
        assert [s["level"] for s in r["path"]][:1] in ([0], [])
        assert all(len(s["left"]) + len(s["right"]) in (0, 32) for s in r["path"])
