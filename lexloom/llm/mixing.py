"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of equal size. While all sources have blocks, the i-th
block of a source of weight w may be placed from slot ``floor((i - 1) / w)`` and before
slot ``ceil(i / w)``; one block is placed in each slot, the one with the earliest deadline
among those released. When a source is used up, the others share its part by their
weights. So after every slot each source is less than one block away from the share that
the given weights call for. All of this is computed in whole numbers from the weights as
they are given: they are not rounded to slots of a period.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, saved

#: Characters of a block.
BLOCK_CHARS = 100_000
#: Blocks of a batch of the schedule.
BATCH = 50_000


def whole_weights(weights: dict[str, float], period: int | None = None) -> dict[str, int]:
    """Whole numbers in the exact proportion of the weights; with a ``period``, that many
    slots by largest remainders instead."""
    if any(not (math.isfinite(w) and w > 0) for w in weights.values()):
        raise ValueError("weights must be positive and finite")
    parts = {x: Fraction(weights[x]) for x in sorted(weights)}
    if period is None:
        scale = math.lcm(*(w.denominator for w in parts.values()))
        return {x: int(w * scale) for x, w in parts.items()}
    total = sum(parts.values())
    exact = {x: period * w / total for x, w in parts.items()}
    slots = {x: int(w) for x, w in exact.items()}
    for x in sorted(parts, key=lambda x: (slots[x] - exact[x], x))[: period - sum(slots.values())]:
        slots[x] += 1
    return slots


def placements(blocks: dict[str, int], weights: dict[str, float]) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block, slot, release, deadline) of every block, by slot.

    A source that is served at the rate of its whole weight w for its n blocks ends at
    n / w. Until v all sources together get ``sum(min(w v, n))`` blocks, which is the slot
    of v: between two ends it is ``gone + rate v``.
    """
    blocks = {x: n for x, n in blocks.items() if n > 0}
    whole = whole_weights({x: weights[x] for x in blocks})
    ends: list[Fraction] = []
    gone, rate = [0], [sum(whole.values())]
    for end, x in sorted((Fraction(n, whole[x]), x) for x, n in blocks.items()):
        if not ends or ends[-1] != end:
            ends.append(end)
            gone.append(gone[-1])
            rate.append(rate[-1])
        gone[-1] += blocks[x]
        rate[-1] -= whole[x]

    over = [(e.numerator, e.denominator) for e in ends]
    stretch = dict.fromkeys(blocks, 0)  # a source's next block begins behind so many ends

    def window(x: str, i: int) -> tuple[int, int]:
        w, a = whole[x], stretch[x]
        b = a
        while b < len(over) and over[b][0] * w < (i + 1) * over[b][1]:
            b += 1
        stretch[x] = b
        return gone[a] + rate[a] * i // w, gone[b] - (-rate[b] * (i + 1) // w)

    waiting = [(*window(x, 0), x, 0) for x in blocks]
    heapq.heapify(waiting)  # (release, deadline, source, block)
    ready: list[tuple[int, str, int, int]] = []
    for slot in range(sum(blocks.values())):
        while waiting and waiting[0][0] <= slot:
            release, deadline, x, i = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, x, i, release))
        deadline, x, i, release = heapq.heappop(ready)
        assert slot < deadline, "a feasible set misses no deadline"
        yield x, i, slot, release, deadline
        if i + 1 < blocks[x]:
            heapq.heappush(waiting, (*window(x, i + 1), x, i + 1))


def schedule(slots: dict[str, int], period: int) -> dict[str, list[int]]:
    """Earliest deadline first over one period: the slots of each source's blocks."""
    placed: dict[str, list[int]] = {x: [] for x in slots}
    for x, _, slot, _, _ in islice(placements(slots, {x: c or 1 for x, c in slots.items()}), period):
        placed[x].append(slot)
    return placed


def segments(blocks: dict[str, int], weights: dict[str, float], period: int | None = None) -> list[tuple]:
    """(source, first block, blocks, first slot, slots) of every source with a block. The
    schedule has no period; the argument is taken for callers that still give one."""
    placed: dict[str, list[int]] = {x: [] for x in sorted(blocks) if blocks[x] > 0}
    for x, _, slot, _, _ in placements(blocks, weights):
        placed[x].append(slot)
    return [(x, 0, len(p), p[0], p) for x, p in placed.items()]


_PLACED = "src string, block long, slot long, release long, deadline long"


def mix(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5, block_chars: int = BLOCK_CHARS, period: int | None = None, seed: int = 13, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row a distinct (doc_id, source, text): doc_id, source, text_hash, copies, size, block, position, slot, release, deadline.

    ``slot`` orders the blocks of all sources from 0 without gaps, ``position`` (a number of
    characters) the documents of a source. Nothing is dropped or repeated: when a source is used
    up the others go on with their weights. ``period`` is no longer used: the weights are
    scheduled as they are given, and ``release`` and ``deadline`` follow from them. Without ``weights`` a source weighs its
    characters to the power ``temperature``; a source missing from ``weights`` weighs as
    much as the least. Documents are shuffled by a hash inside their source. A null
    source (written as null) is a source of its own; a null or empty text has size 0 and goes with its
    place; equal rows share one place; an empty table gives no rows. A document longer than a
    block uses up the blocks it covers.
    """
    src = F.coalesce(F.concat(F.lit("s"), F.col(f"`{source_col}`").cast("string")), F.lit("n"))
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(src.alias("src"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("chars"))
    once = rows.groupBy("src", "doc_id", "text_hash").agg(F.count("*").alias("copies"), F.sum("chars").alias("size"))
    once = saved(once.withColumn("at", F.xxhash64("doc_id", "text_hash", F.lit(seed))), "mixing-rows")
    totals = saved(once.groupBy("src").agg(F.sum("size").alias("chars"), F.count("*").alias("n")), "mixing-sources")
    given = None if weights is None else {("n" if x is None else "s" + x): w for x, w in weights.items()}
    least = min(given.values(), default=1.0) if given is not None else 1.0

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chars = {x: n for batch in batches for x, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)}
        target = {x: max(1, n) ** temperature if given is None else given.get(x, least) for x, n in chars.items()}
        rows = placements({x: max(1, -(-n // block_chars)) for x, n in chars.items()}, target) if chars else iter(())
        while some := list(islice(rows, BATCH)):
            types = [pa.string(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), types, strict=True)], ["src", "block", "slot", "release", "deadline"])

    # The schedule is one task over the sources; its rows are as many as blocks and never pass through the driver.
    own = saved(totals.select("src", "chars").coalesce(1).mapInArrow(plan, _PLACED), "mixing-schedule")
    # Prefix sums in two levels: in ranges of the hash, and over a source's ranges. Their
    # number follows the rows of a source, so that a large source has no large range.
    rows_in_range = max(2000, math.isqrt(totals.agg(F.sum("n")).first()[0] or 0))
    # An empty text at a source's very end would open a block that isn't there.
    last = F.expr(f"greatest(1, (chars + {block_chars - 1}) div {block_chars}) - 1")
    ranges = totals.select("src", F.expr(f"greatest(1, (n + {rows_in_range - 1}) div {rows_in_range})").alias("ranges"), last.alias("last"))
    part = F.floor((F.shiftright(F.col("at"), 33) + F.lit(2**30)) * F.col("ranges") / F.lit(float(2**31))).cast("long")
    dealt = once.join(ranges, "src").select(*once.columns, "last", part.alias("part"))
    inside = Window.partitionBy("src", "part").orderBy("at", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    bases = dealt.groupBy("src", "part").agg(F.sum("size").alias("total")).select("src", "part", F.coalesce(F.sum("total").over(before), zero).alias("base"))
    placed = dealt.withColumn("own", F.coalesce(F.sum("size").over(inside), zero)).join(bases, ["src", "part"])
    position = F.col("base") + F.col("own")
    block = F.expr(f"least((base + own) div {block_chars}, last)")
    numbered = placed.select("src", "doc_id", "text_hash", "copies", "size", position.alias("position"), block.alias("block"))
    met = numbered.join(own, ["src", "block"])
    return met.select("doc_id", F.expr("if(src = 'n', null, substring(src, 2))").alias("source"), "text_hash", "copies", "size", "block", "position", "slot", "release", "deadline")


def mixed(docs: DataFrame, partitions: int | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kwargs) -> DataFrame:
    """``docs`` in the order of the mix: range-partitioned by slot and sorted, so that files
    written from it hold the mix one after the other. Every row stays, with its columns."""
    placed = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **kwargs).select(F.col("doc_id").alias("__mix_id"), F.col("text_hash").alias("__mix_hash"), F.col("source").alias("__mix_source"), F.col("slot").alias("__mix_slot"), F.col("position").alias("__mix_at"))
    keyed = docs.withColumn("__mix_own", F.xxhash64(F.col(f"`{text_col}`").cast("string")))
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("__mix_id")) & (F.col("__mix_own") == F.col("__mix_hash")) & F.col(f"`{source_col}`").cast("string").eqNullSafe(F.col("__mix_source"))
    found = keyed.join(placed, same)
    order = ["__mix_slot", "__mix_source", "__mix_at", "__mix_id"]
    dealt = found.repartitionByRange(partitions, *order) if partitions else found.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document stands when sources are mixed by the root of their size."""
    return mix(documents(spark, sf_dir)).select("doc_id", "source", "size", "block", "position", "slot", "release", "deadline")
