"""Mixing sources to target weights: Pfair scheduling of source blocks.

A source whose share of the weights is w (an exact fraction) is cut into blocks of ``block_rows`` rows. Block j is
released in slot floor(j / w) and due by slot ceil((j + 1) / w); earliest deadline first gives each slot to the
released block whose deadline is next. On one lane this keeps every source within one block of its target share at
every slot, however long the table. As whole numbers without a common factor, the weights repeat after as many slots
as their sum. If that is short, one period is scheduled and a row's slot is arithmetic on its block number; if it is
longer than the phase, the slots of the phase are scheduled, so that the schedule never has more slots than blocks.
The slots go to a table in the shared folder in pieces of CHUNK.

When a source runs dry, its share goes to the others in proportion (a new phase with its own period); so all rows
stay, once each, and each phase holds the bound for the sources it has.

Defined results: a null source is a source of its own; equal rows are separate rows; ties in the order columns are
broken by position in the written copy; an empty table gives an empty result; columns of the input keep name and
value whatever they are called.
"""

from __future__ import annotations

import heapq
import itertools
import math
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starlift.llm.common import scratch_path, written

#: Scheduled slots that the driver writes at once.
CHUNK = 1 << 18
#: Rows of a block.
BLOCK_ROWS = 16
#: Target weights of the corpus; sources not named weigh 1.
WEIGHTS: dict[str, float] = {"src0": 4, "src1": 2.5, "src2": 0.5}
#: Distinct sources the driver schedules.
MAX_SOURCES = 512

_P = "__mix_"


def shares(weights: dict, period: int | None = None) -> dict:
    """The weights as whole numbers without a common factor, exactly (a float counts as the decimal it prints as).

    With a ``period``: whole shares of it instead (at least 1 each, together ``period``), by largest remainder.
    """
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    if any(w <= 0 for w in exact.values()):
        raise ValueError("shares need weights above 0")
    if period is None:
        scale = math.lcm(*(w.denominator for w in exact.values()))
        whole = {s: int(w * scale) for s, w in exact.items()}
        common = math.gcd(*whole.values())
        return {s: w // common for s, w in whole.items()}
    if len(weights) > period:
        raise ValueError(f"{len(weights)} sources need a period of as many slots")
    total = sum(exact.values())
    exact = {s: w * period / total for s, w in exact.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    rest = sorted(exact, key=lambda s: (out[s] - exact[s], str(s)))
    for s in rest[:max(0, period - sum(out.values()))]:
        out[s] += 1
    while sum(out.values()) > period:
        out[max(out, key=lambda s: (out[s] - exact[s] if out[s] > 1 else -1, str(s)))] -= 1
    return out


def schedule(share: dict):
    """The source of each slot, one after the other, by earliest deadline among released blocks."""
    names = sorted(share, key=str)
    period = sum(share.values())
    due, waiting = [], [(0, k, 0) for k in range(len(names))]  # one block of each source, due or still to be released
    t = 0
    while True:
        while waiting and waiting[0][0] <= t:
            _, k, j = heapq.heappop(waiting)
            heapq.heappush(due, (-(-(j + 1) * period // share[names[k]]), k, j))
        deadline, k, j = heapq.heappop(due)
        if deadline <= t:
            raise AssertionError("missed a deadline")
        yield names[k]
        t += 1
        heapq.heappush(waiting, ((j + 1) * period // share[names[k]], k, j + 1))


def pfair(share: dict, period: int) -> dict:
    """Slots of each source among the first ``period`` slots."""
    slots = {s: [] for s in share}
    for t, s in enumerate(itertools.islice(schedule(share), period)):
        slots[s].append(t)
    return slots


def phases(blocks: dict, weights: dict, period: int | None = None, put=lambda rows: None) -> list[dict]:
    """Successive schedules until every block has a slot.

    Each phase: first slot, slots after which it repeats, source -> (blocks in a period, first block, blocks in this
    phase). ``put`` gets (source, blocks before this phase, place in the period, slot in the period), CHUNK rows at
    most at once. A phase ends with the slot at which the first source places its last block. Sources of weight 0 come
    when all others are dry, at equal shares.
    """
    left, done, base, out, rows = {s: n for s, n in blocks.items() if n > 0}, {s: 0 for s in blocks}, 0, [], []
    while left:
        share = shares({s: weights[s] for s in left if weights[s]} or dict.fromkeys(left, 1), period)
        length, size, end = sum(share.values()), dict.fromkeys(share, 0), None
        for t, s in enumerate(itertools.islice(schedule(share), length)):
            rows.append((s, done[s], size[s], t))
            size[s] += 1
            if len(rows) == CHUNK:
                put(rows)
                rows = []
            if size[s] == left[s]:  # dry within the first period
                end = t + 1
                break
        taken = dict(size)
        if end is None:  # whole periods in which no source runs dry, and the next up to the slot at which one does
            turns = min((left[s] - 1) // n for s, n in share.items())
            taken, end = {s: turns * n for s, n in share.items()}, turns * length
            for s in schedule(share):
                end += 1
                taken[s] += 1
                if taken[s] == left[s]:
                    break
        out.append({"base": base, "period": length, "sources": {s: (size[s], done[s], n) for s, n in taken.items() if n}})
        base += end
        for s, n in taken.items():
            done[s] += n
        left = {s: n - taken.get(s, 0) for s, n in left.items() if n > taken.get(s, 0)}
    if rows:
        put(rows)
    return out


def mix(rows: DataFrame, weights: dict | None = None, source: str = "source", order: tuple[str, ...] = ("doc_id",),
        block_rows: int = BLOCK_ROWS, period: int | None = None, sort_rows: bool = False) -> DataFrame:
    """The rows with ``mix_block`` (number within the source), ``mix_slot`` (global block position) and ``mix_position``.

    ``weights``: source -> target weight, any positive scale; a source without one, and all when None, weigh 1; shares are
    exact, unless ``period`` asks for multiples of 1 / period. ``mix_position`` is slot * block_rows + place in the block.
    With ``sort_rows`` the result is range-partitioned and sorted by it, so files written from it are read in training order. A hot source is spread over range partitions
    by its order columns and numbered by partition counts; nothing is gathered by source.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    src, at, part, phase = (f"{_P}{x}" for x in ("source", "at", "part", "phase"))
    inner = rows.withColumn(src, F.xxhash64(F.coalesce(F.col(source).cast("string"), F.lit("\x00null"))))
    inner = inner.repartitionByRange(n, src, *order).sortWithinPartitions(src, *order)
    # the id holds the partition in its high bits and the row in the low 33; written, it never changes
    kept = written(inner.withColumn(at, F.monotonically_increasing_id()), "mix").withColumn(part, F.shiftright(at, 33))
    counts = kept.groupBy(src, part).agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first"), F.min(source).alias("name"))
    totals = counts.groupBy(src).agg(F.sum("n").alias("n"), F.min("name").alias("name")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    blocks = {r[0]: -(-r["n"] // block_rows) for r in totals}
    weights = weights or {}
    path = scratch_path(spark, "slots")

    def put(slots):
        one = pa.table([pa.array(x, pa.int64()) for x in zip(*slots)], names=[src, f"{_P}first", f"{_P}cell", f"{_P}slot"])
        spark.createDataFrame(one).write.mode("append").parquet(path)

    plan = phases(blocks, {r[0]: weights.get(r["name"], 1) for r in totals}, period, put)
    schema = f"{src} long, {_P}first long, {_P}cell long, {_P}slot long"
    cells = spark.read.schema(schema).parquet(path) if plan else spark.createDataFrame([], schema)
    by_source = _phases(spark, plan)
    before = Window.partitionBy(src).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(src, part, (F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias(f"{_P}zero"))
    index = f"({at} - {_P}zero)"
    # starts: a row per range partition and source in it, about partitions + sources; by_source: a row per source
    out = kept.join(F.broadcast(starts), [src, part]).join(F.broadcast(by_source), src)
    out = out.withColumn("mix_block", F.expr(f"{index} div {block_rows}"))
    out = out.withColumn(phase, F.expr(f"size(filter({_P}firsts, x -> x <= mix_block))"))
    out = out.withColumn(f"{_P}first", F.expr(f"element_at({_P}firsts, {phase})"))
    out = out.withColumn(f"{_P}in", F.expr(f"mix_block - {_P}first"))
    out = out.withColumn(f"{_P}size", F.expr(f"element_at({_P}sizes, {phase})"))
    out = out.withColumn(f"{_P}cell", F.expr(f"{_P}in % {_P}size")).join(cells, [src, f"{_P}first", f"{_P}cell"])
    out = out.withColumn("mix_slot", F.expr(f"element_at({_P}bases, {phase}) + {_P}in div {_P}size * element_at({_P}periods, {phase}) + {_P}slot"))
    out = out.withColumn("mix_position", F.expr(f"mix_slot * {block_rows} + {index} % {block_rows}"))
    if sort_rows:
        # slots are dense, so equal slot ranges are equal shares of the rows: no sampling pass
        lane = F.expr(f"cast(least({n - 1}, mix_slot * {n} div {max(1, sum(blocks.values()))}) as int)")
        out = out.withColumn(part, lane).repartitionById(n, F.col(part)).sortWithinPartitions("mix_position")
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], "mix_block", "mix_slot", "mix_position")


def _phases(spark, plan: list[dict]) -> DataFrame:
    """Per source its phases (arrays, one row); a source without a block in a phase has none there."""
    by: dict = {}
    for ph in plan:
        for s, (size, first, _taken) in ph["sources"].items():
            for x, value in zip(by.setdefault(s, ([], [], [], [])), (first, ph["base"], size, ph["period"])):
                x.append(int(value))
    names = "".join(f", {_P}{x} array<long>" for x in ("firsts", "bases", "sizes", "periods"))
    return spark.createDataFrame([(s, *x) for s, x in by.items()], f"{_P}source long{names}")
