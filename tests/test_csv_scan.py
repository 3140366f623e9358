"""The split CSV scan against Spark's one-task reader: quoted breaks, quotes and separators over many splits and files."""

import csv
import os
import random

import pytest

from starlift.sources import contracts as C

CONTRACT = C.Contract("notes", C.schema_of("id bigint, note string, score double"))


def write(path, rows, columns=("id", "note", "score", "extra")):
    with open(path, "w", newline="", encoding="utf-8") as fh:
        out = csv.writer(fh, lineterminator="\n")
        out.writerow(columns)
        for r in rows:
            out.writerow([r[c] for c in columns])


def some_rows(rng, first, n):
    out = []
    for k in range(first, first + n):
        words = [rng.choice(["plain", 'say "yes"', "a,b", "two\nlines", "\n", '"', "naïve", "x" * rng.randrange(200), "three\n\nlines, \"q\"\n"]) for _ in range(rng.randrange(1, 6))]
        out.append({"id": k, "note": "".join(words).strip(" ") or "empty", "score": k / 4, "extra": rng.choice(["e", "quoted, one", "break\nhere"])})
    return out


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "700")
    spark.conf.set(names[1], "1")
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def whole_reader(spark, path):
    raw = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)
    return sorted((int(r["id"]), r["note"], float(r["score"])) for r in raw.collect())


def test_split_scan_equals_the_whole_reader(spark, tmpdir_path, small_splits):
    rng = random.Random(7)
    os.makedirs(f"{tmpdir_path}/in")
    rows = [some_rows(rng, 1000 * k, n) for k, n in enumerate((150, 1, 40))]
    for k, r in enumerate(rows):
        write(f"{tmpdir_path}/in/part{k}.csv", r)
    # a record much longer than a split, and one that fills the rest of the file
    write(f"{tmpdir_path}/in/part9.csv", [{"id": 9000, "note": "a\n" * 2000 + "end", "score": 1, "extra": "e"}, {"id": 9001, "note": "z\n" * 900, "score": 2, "extra": "e"}])
    text = spark.read.text(f"{tmpdir_path}/in")
    assert text.rdd.getNumPartitions() > 20
    got = sorted(tuple(r) for r in C.read_csv(spark, f"{tmpdir_path}/in", CONTRACT).collect())
    assert got == whole_reader(spark, f"{tmpdir_path}/in")
    assert [r[0] for r in got] == sorted([r["id"] for f in rows for r in f] + [9000, 9001])
    placed = C.read_csv(spark, f"{tmpdir_path}/in", CONTRACT, position="at").orderBy("at").collect()
    assert [r["id"] for r in placed] == [r["id"] for f in rows for r in f] + [9000, 9001]


def test_every_header_is_checked_and_columns_may_be_ordered_freely(spark, tmpdir_path, small_splits):
    rng = random.Random(3)
    os.makedirs(f"{tmpdir_path}/in")
    a, b = some_rows(rng, 0, 12), some_rows(rng, 50, 12)
    write(f"{tmpdir_path}/in/a.csv", a)
    write(f"{tmpdir_path}/in/b.csv", b, ("score", "note", "id"))
    got = sorted(tuple(r) for r in C.read_csv(spark, f"{tmpdir_path}/in", CONTRACT).collect())
    assert [(r[0], r[2]) for r in got] == [(r["id"], r["score"]) for r in a + b]
    write(f"{tmpdir_path}/in/c.csv", a[:2], ("id", "note"))
    with pytest.raises(ValueError, match="score"):
        C.read_csv(spark, f"{tmpdir_path}/in", CONTRACT)


def test_bad_values_null_tokens_and_blank_lines(spark, tmpdir_path):
    with open(f"{tmpdir_path}/x.csv", "w", encoding="utf-8") as fh:
        fh.write('﻿id,note,score\n1,NA,2.5\n\nx,"kept, as is",nope\n3,"",\n')
    got = sorted(C.read_csv(spark, f"{tmpdir_path}/x.csv", CONTRACT).collect(), key=str)
    assert [(r["id"], r["score"]) for r in got] == [(1, 2.5), (3, None), (None, None)]
    assert [r["note"] for r in got] == [None, None, "kept, as is"]


def test_a_file_without_a_header(spark, tmpdir_path):
    open(f"{tmpdir_path}/empty.csv", "w").close()
    with pytest.raises(ValueError, match="missing expected columns"):
        C.read_csv(spark, f"{tmpdir_path}/empty.csv", CONTRACT)
