"""Reproducible audit sample: the rows with the smallest seeded hash."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybank.operators.ranking import RepeatMark, mark_repeats

HASH = "__sample_hash"


def sample_hash(columns, seed: int) -> Column:
    """Hash of the seed and the whole row; the same for any file layout or partitioning."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *cells))


def audit_sample(frame: DataFrame, size: int = 25, seed: int = 42, columns=None) -> DataFrame:
    """The sampled rows. Each task keeps its own ``size`` smallest, so nothing is fully sorted."""
    return (frame.withColumn(HASH, sample_hash(columns or frame.columns, seed))
            .orderBy(HASH).limit(size).drop(HASH))


@dataclass(frozen=True)
class SampleCut:
    """Largest hash inside the sample; ``quota`` is set when only that many of its copies belong to it."""

    hash: str | None
    quota: int | None


def sample_cut(frame: DataFrame, size: int, seed: int, columns) -> SampleCut:
    """The cut-off of a sample, from one small job that returns ``size`` + 1 hashes."""
    rows = frame.select(sample_hash(columns, seed).alias("h")).orderBy("h").limit(size + 1).collect()
    hashes = [row["h"] for row in rows]
    if len(hashes) <= size:
        return SampleCut(hashes[-1] if hashes else None, None)
    last = hashes[size - 1]
    return SampleCut(last, hashes[:size].count(last) if hashes[size] == last else None)


def mark_sample(frame: DataFrame, out: str, cut: SampleCut, seed: int, columns, ties=()) -> DataFrame:
    """Mark the sampled rows in boolean column ``out`` by comparing with the cut-off.

    Only when copies of one row straddle the cut-off must they be told apart; they are then ranked,
    in the order of the ``ties`` columns.
    """
    if cut.hash is None:
        return frame.withColumn(out, F.lit(False))
    last = F.lit(cut.hash)
    frame = frame.withColumn(HASH, sample_hash(columns, seed))
    if cut.quota is None:
        return frame.withColumn(out, F.col(HASH) <= last).drop(HASH)
    frame = frame.withColumn("__tied", F.when(F.col(HASH) == last, F.col(HASH)))
    frame = mark_repeats(frame, [RepeatMark(("__tied",), (HASH, *ties), cut.quota + 1, "__beyond")])
    marked = (F.col(HASH) < last) | ((F.col(HASH) == last) & ~F.col("__beyond"))
    return frame.withColumn(out, marked).drop(HASH, "__tied", "__beyond")
