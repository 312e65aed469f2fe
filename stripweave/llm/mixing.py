"""Mixing sources to target weights by Pfair scheduling, in DataFrame and SQL functions.

Time is divided into slots of one block. The j-th block of a source with weight w is
released at floor(j / w) and due at ceil((j + 1) / w); in each slot the released block
with the earliest deadline goes. On one stream that schedule meets every deadline, so at
any point a source is less than one block from its weight's share. Weights are whole
numbers, a source's share being its number over the sum, so all of this is exact, and the
schedule repeats after as many slots as that sum. The driver finds one period of it from
the sources' numbers of blocks; a document's place then follows from its rank in its source.

When a source runs out a new phase begins, with the others' weights in proportion.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted

#: Documents in a block; the sum of the default weights, at least; the most sources.
BLOCK, RESOLUTION, MOST_SOURCES = 32, 1000, 20_000
#: Slots after which a schedule is repeated at the latest; beyond, every block is scheduled.
LONGEST = 100_000
#: Rows of one source that are ranked together, about, and parts whose sizes are summed together.
RANKED, SUMMED = 2_000, 1024
#: A plan of more places isn't broadcast but joined by shuffle.
BROADCAST = 1_000_000
PLACES = ("block", "phase", "slot", "position", "release", "deadline", "deviation")


def whole_numbers(weights: dict) -> dict:
    """The weights as whole numbers in the same proportion. A float is the decimal that it is shown as."""
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    found = {s: int(w * scale) for s, w in exact.items()}
    divisor = math.gcd(*found.values())
    return {s: w // divisor for s, w in found.items()}


def default_weights(counts: dict, resolution: int = RESOLUTION) -> dict:
    """Whole numbers, 1 at least, in proportion to the square roots of the sources' rows; their sum is about ``resolution`` or twice the number of sources."""
    total, wanted = sum(math.sqrt(n) for n in counts.values()), max(resolution, 2 * len(counts))
    return {s: max(1, round(wanted * math.sqrt(n) / total)) for s, n in counts.items()}


def schedule(weights: list[int], blocks: list[int], longest: int = LONGEST) -> tuple[int, list[list[int]]]:
    """``(period, slots)``: the slots of each source's blocks, earliest deadline first among the released.

    The schedule ends with the period, or with the slot in which the first source has no more of its
    ``blocks``; the period is 0 if that comes first or if it is more than ``longest``.
    """
    divisor = math.gcd(*weights)
    weights = [w // divisor for w in weights]
    total = sum(weights)
    period = total if total <= longest else 0
    places: list[list[int]] = [[] for _ in weights]
    waiting, ready, slot = [(0, s) for s in range(len(weights))], [], 0
    while not period or slot < period:
        while waiting and waiting[0][0] <= slot:
            s = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(len(places[s]) + 1) * total // weights[s]), s))
        s = heapq.heappop(ready)[1]
        places[s].append(slot)
        if len(places[s]) == blocks[s]:
            return 0, places
        heapq.heappush(waiting, (len(places[s]) * total // weights[s], s))
        slot += 1
    return period, places


def phases(blocks: dict, weights: dict, longest: int = LONGEST) -> list[tuple]:
    """A row for each phase and source with blocks in it: where they stand. Plain numbers, one set for each source."""
    left, done, base, out = dict(blocks), dict.fromkeys(blocks, 0), 0, []
    number = 0
    while left:
        names = sorted(left, key=lambda s: (s is not None, s))
        given = [weights[s] for s in names]
        divisor = math.gcd(*given)
        period, places = schedule(given, [left[s] for s in names], longest)
        at = lambda i, j: j // len(places[i]) * period + places[i][j % len(places[i])]  # noqa: B023, E731
        end = (min(at(i, left[s] - 1) for i, s in enumerate(names)) if period else max(p[-1] for p in places if p)) + 1
        for i, s in enumerate(names):
            n = end // period * len(places[i]) + sum(x < end % period for x in places[i]) if period else len(places[i])
            if n:
                out.append((s, number, done[s], n, base, period, given[i] // divisor, sum(given) // divisor, places[i][:n]))
            done[s] += n
            left[s] -= n
            if not left[s]:
                del left[s]
        base, number = base + end, number + 1
    return out


PLAN = "plan_source string, phase int, first long, n long, base long, period long, weight decimal(38,0), total decimal(38,0), slots array<long>"


def planned(spark, rows: list[tuple]) -> DataFrame:
    from decimal import Decimal

    return spark.createDataFrame([(*r[:6], Decimal(r[6]), Decimal(r[7]), r[8]) for r in rows], PLAN)


def ranked(docs: DataFrame, count: int) -> DataFrame:
    """``(row, source, rank)``: the rows' order in their source, by a hash of the id, then by all that is in them."""
    fields = [f for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    source, parts = quoted("source").cast("string").alias("source"), max(1, -(-count // RANKED))
    hashed = F.xxhash64(quoted("doc_id"), F.lit("mix"))
    tied = F.xxhash64(*(quoted(f.name) for f in fields))
    dealt = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), source, hashed.alias("hash"), tied.alias("tied"), F.pmod(hashed, F.lit(parts)).alias("part"))
    # Hash buckets of bounded size are ranked apart; the rows in the buckets before come from sums of bounded numbers of buckets.
    sizes = docs.select(source, F.pmod(hashed, F.lit(parts)).alias("part")).groupBy("source", "part").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("group", F.floor(F.col("part") / SUMMED))
    earlier = lambda c, by, *keys: F.sum(c).over(Window.partitionBy("source", *keys).orderBy(by)) - F.col(c)
    groups = sizes.groupBy("source", "group").agg(F.sum("n").alias("n")).select(F.col("source").alias("of"), F.col("group").alias("in"), earlier("n", "group").alias("lower"))
    before = sizes.join(groups.hint("merge"), F.col("source").eqNullSafe(F.col("of")) & (F.col("group") == F.col("in"))).select(
        F.col("source").alias("size_source"), F.col("part").alias("size_part"), (F.col("lower") + earlier("n", "part", "group")).alias("before")
    )
    within = Window.partitionBy("source", "part").orderBy("hash", "tied")
    found = dealt.withColumn("nth", F.row_number().over(within) - 1)
    found = found.join(before, F.col("source").eqNullSafe(F.col("size_source")) & (F.col("part") == F.col("size_part")))
    return found.select("row", "source", (F.col("nth") + F.col("before")).alias("rank"))


def places(docs: DataFrame, weights: dict | None, block: int, resolution: int, longest: int = LONGEST, broadcast: int = BROADCAST) -> DataFrame:
    """``(row, *PLACES)`` for each row of ``docs``, its columns in the struct ``row``."""
    source = quoted("source").cast("string").alias("source")
    counts = {r["source"]: r["count"] for r in docs.groupBy(source).count().limit(MOST_SOURCES + 1).collect()}
    if len(counts) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: group them")
    given = default_weights(counts, resolution) if weights is None else {s: weights.get(s, 0) for s in counts}
    if missing := [s for s, w in given.items() if not w > 0]:
        raise ValueError(f"sources without a positive weight: {missing[:10]}")
    plan = phases({s: -(-n // block) for s, n in counts.items()}, whole_numbers(given) if counts else {}, longest)
    table, each = planned(docs.sparkSession, plan), ranked(docs, sum(counts.values())).withColumn("block", F.floor(F.col("rank") / block))
    j = F.col("block") - F.col("first")
    if sum(len(r[8]) for r in plan) + len(plan) <= broadcast:
        inside = (F.col("block") >= F.col("first")) & (F.col("block") < F.col("first") + F.col("n"))
        each = each.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("plan_source")) & inside)
        each = each.withColumn("slot_", F.get("slots", (j % F.size("slots")).cast("int")))
    else:
        # One row for each block, joined by source and block: a key has a block's documents.
        table = table.select("*", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("plan_block"))
        table = table.withColumn("slot_", F.get("slots", ((F.col("plan_block") - F.col("first")) % F.size("slots")).cast("int"))).withColumn("size", F.size("slots")).drop("slots")
        each = each.join(table.hint("merge"), F.col("source").eqNullSafe(F.col("plan_source")) & (F.col("block") == F.col("plan_block")))
    size: Column = F.size("slots") if "slots" in each.columns else F.col("size")
    # Block j is block j % size of its period, so many periods later.
    each = each.withColumn("j", j).withColumn("slot", F.col("base") + F.floor(j / size) * F.col("period") + F.col("slot_"))
    exact = lambda sql: F.expr(f"cast({sql} as long)")
    release = exact("base + cast(j as decimal(19,0)) * total div weight")
    deadline = exact("base + (cast(j + 1 as decimal(19,0)) * total + weight - 1) div weight")
    share = F.col("weight").cast("double") / F.col("total").cast("double")
    return each.select(
        "row", "block", "phase", "slot", (F.col("slot") * block + F.col("rank") % block).alias("position"), release.alias("release"), deadline.alias("deadline"),
        (F.col("j") + 1 - (F.col("slot") - F.col("base") + 1) * share).alias("deviation"),
    )


def mix(docs: DataFrame, *, weights: dict | None = None, block: int = BLOCK, resolution: int = RESOLUTION) -> DataFrame:
    """``docs`` with ``mix_block, mix_phase, mix_slot, mix_position, mix_release, mix_deadline, mix_deviation``.

    ``mix_position`` orders the stream; ``mix_deviation`` is how far its source is, in blocks, from its
    weight's share after that slot of the phase, always between -1 and 1. No row is dropped or repeated.
    Without ``weights`` a source's weight is a whole number in proportion to the square root of its rows
    (``default_weights``). A null source is a source of its own; rows with null or repeated ids stay, and rows that
    are equal in all columns take each other's places. A source that ``weights`` leaves out is an error, as is a
    weight that isn't positive or more than ``MOST_SOURCES`` sources. Columns of ``docs`` that have one of the new
    names are replaced; others may have any name. Texts aren't read. An empty table gives no rows.
    """
    new = [f"mix_{c}" for c in PLACES]
    kept = [c for c in docs.columns if c.lower() not in new]
    found = places(docs, weights, block, resolution)
    return found.select(*(F.col("row").getField(c).alias(c) for c in kept), *(F.col(c).alias(n) for c, n in zip(PLACES, new)))


def in_order(docs: DataFrame, *, weights: dict | None = None, block: int = BLOCK, resolution: int = RESOLUTION) -> DataFrame:
    """The stream itself: the rows of ``docs``, sorted by their position in the mix over all partitions."""
    found = places(docs, weights, block, resolution).select("row", "position")
    ordered = found.repartitionByRange("position").sortWithinPartitions("position")
    return ordered.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
