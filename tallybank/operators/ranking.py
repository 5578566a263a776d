"""Marking the n-th and later rows of each group without gathering a large group in one task."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "__slice"


@dataclass(frozen=True)
class RepeatMark:
    """Mark, in column ``out``, the ``nth`` and later rows among rows with equal ``keys``."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    nth: int
    out: str


def mark_repeats(frame: DataFrame, marks: list[RepeatMark]) -> DataFrame:
    """Add one boolean column per mark.

    A group may hold a third of all rows, so it is never sorted whole. Each group is first ranked
    within slices, a slice being the part of the group that sits in one input partition. A row that
    is already n-th in its slice is n-th overall. What is left, at most n-1 rows per slice, is
    ranked again per group, and only those rows meet in one task.

    Rows that tie on every order column are copies. Which copy is marked makes no difference to one
    mark, but with several marks it matters that they agree: a copy that an earlier mark leaves
    alone is also the first that a later mark leaves alone. So the outcome never depends on slicing.
    """
    if not marks:
        return frame
    frame = frame.withColumn(SLICE, F.spark_partition_id())
    shared = [k for k in marks[0].keys if all(k in m.keys for m in marks)]
    if len(marks) > 1 and shared:
        # One exchange serves the slice ranking of every mark.
        frame = frame.repartition(*shared, SLICE)
    ranks = []
    for mark in marks:
        window = Window.partitionBy(*mark.keys, SLICE).orderBy(*mark.order, *ranks)
        ranks.append(f"__in_slice_{mark.out}")
        frame = frame.withColumn(ranks[-1], F.row_number().over(window))
    outs = []
    for mark, rank in zip(marks, ranks):
        settled = F.col(rank) >= mark.nth
        contest = f"__contest_{mark.out}"
        frame = frame.withColumn(contest, F.when(settled, F.col(SLICE)).otherwise(F.lit(-1)))
        window = Window.partitionBy(*mark.keys, contest).orderBy(*mark.order, *outs)
        frame = frame.withColumn(mark.out, settled | (F.row_number().over(window) >= mark.nth))
        outs.append(mark.out)
    return frame.drop(SLICE, *ranks, *[f"__contest_{out}" for out in outs])


def repeats_per_key(frame: DataFrame, keys: list[str], nth: int, out: str = "n") -> DataFrame:
    """How many rows ``mark_repeats`` would mark per group: counting needs no ranking at all."""
    return frame.groupBy(*keys).agg(F.greatest(F.count("*") - (nth - 1), F.lit(0)).alias(out))


#: Bits of the bitmap of one kind of key: 8 MB, whatever the number of rows.
BITMAP_BITS = 1 << 26


@dataclass(frozen=True)
class Recurring:
    """A kind of key of which some rows matter: those with ``keys`` that at least ``least`` rows ``among`` the frame have.
    ``where`` says which rows ask."""

    keys: tuple[str, ...]
    least: int
    among: Column | None = None
    where: Column | None = None


def split_recurring(frame: DataFrame, kinds: list[Recurring]) -> tuple[DataFrame, DataFrame]:
    """(rows that may have a recurring key of some kind, the other rows).

    One pass counts 64-bit hashes of the keys of all kinds, so only whole numbers are shuffled. The hashes that recur come
    back as bitmaps of a fixed size, which each task looks its rows up in; no row is moved for that. A bit set by chance only
    lets a row pass that needs not: the denser the bitmaps, the more do, and none is lost.
    """
    def hashed(kind: Recurring) -> Column:
        return F.xxhash64(*[F.col(f"`{k}`") for k in kind.keys])

    def slot(value: Column) -> Column:
        return F.pmod(value, F.lit(BITMAP_BITS))

    asked = F.array(*[F.when(k.among if k.among is not None else F.lit(True), F.struct(F.lit(i).alias("kind"), hashed(k).alias("hash")))
                      for i, k in enumerate(kinds)])
    least = F.element_at(F.array(*[F.lit(k.least) for k in kinds]), F.col("kind") + 1)
    recurring = frame.select(F.inline(F.filter(asked, lambda a: a.isNotNull()))).groupBy("kind", "hash").agg(
        F.count("*").alias("rows")).where(F.col("rows") >= least).select("kind", slot(F.col("hash")).alias("slot"))
    bitmaps = recurring.groupBy("kind", F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    tested, held = frame, []
    for i, kind in enumerate(kinds):
        own, place = f"__slot_{i}", f"__bits_{i}"
        asks = kind.where if kind.where is not None else F.lit(True)
        tested = tested.withColumn(own, F.when(asks, slot(hashed(kind))))
        # At most BITMAP_BITS / 2^15 rows of 4 kB each.
        bits = F.broadcast(bitmaps.where(F.col("kind") == i).select(F.col("bucket").alias(f"__bucket_{i}"), F.col("bits").alias(place)))
        tested = tested.join(bits, F.bitmap_bucket_number(own) == F.col(f"__bucket_{i}"), "left")
        position = F.bitmap_bit_position(own)
        byte = F.conv(F.hex(F.substring(place, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        held.append(F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False)))
    tested = tested.withColumn("__may", reduce(or_, held))
    return tested.where("__may").select(*frame.columns), tested.where("NOT __may").select(*frame.columns)
