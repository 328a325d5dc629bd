"""Distinct counts that can be added up: bitmaps of numbered values, stored by grain.

``count(distinct order)`` of a coarser grain does not follow from the counts of a
finer one, as an order has lines in several of its cells. Bitmaps do: every
value gets a number, a cell keeps one bitmap for each block of 64 numbers that it
touches, and the bitmaps of many cells are merged by OR. The merged counts are
exact. A bitmap is one long: a cell with few values has no more rows than values, and no
row that is shuffled, sorted or stored is larger than its keys and 16 bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import row_number_by

#: Columns of a stored set: block of numbers, bitmap of the numbers met.
BLOCK, BITS = "_set_block", "_set_bits"


def numbers(values: DataFrame, value: str, out: str = "number") -> DataFrame:
    """``value, out``: the different non-NULL values numbered 1, 2, … in their order (a distributed numbering)."""
    different = values.select(value).where(F.col(value).isNotNull()).distinct()
    return row_number_by(different, [F.col(value).asc()], out=out)


def extended(known: DataFrame, values: DataFrame, value: str, out: str = "number") -> DataFrame:
    """Numbers of the values that ``known`` lacks, after its largest, so that stored bitmaps stay valid."""
    fresh = values.select(value).join(known.select(value), value, "left_anti")
    top = F.broadcast(known.agg(F.coalesce(F.max(out), F.lit(0)).alias("_rf_top")))  # one row
    after = numbers(fresh, value, "_rf_n").join(top)
    return after.select(value, (F.col("_rf_n") + F.col("_rf_top")).cast(known.schema[out].dataType).alias(out))


def distinct_sets(rows: DataFrame, grain: Sequence, number: str) -> DataFrame:
    """The grain with one row per block: ``_set_block, _set_bits`` (numbers are non-negative; NULL counts for nothing).

    Repeated (cell, number) pairs, and the numbers of a block, collapse on the map side.
    """
    cells = [F.col(g) if isinstance(g, str) else g[1].alias(g[0]) for g in grain]
    names = [g if isinstance(g, str) else g[0] for g in grain]
    pairs = rows.where(F.col(number).isNotNull()).select(*cells, F.col(number).cast("bigint").alias("_rf_n"))
    return pairs.groupBy(*names, F.expr("shiftright(_rf_n, 6)").alias(BLOCK)).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(_rf_n & 63 AS INT))")).alias(BITS))


def merged_sets(sets: DataFrame, grain: Sequence) -> DataFrame:
    """Stored sets at a coarser grain (names, or ``(name, Column)`` pairs over the finer grain)."""
    cells = [F.col(g) if isinstance(g, str) else g[1].alias(g[0]) for g in grain]
    return sets.groupBy(*cells, BLOCK).agg(F.bit_or(BITS).alias(BITS))


def set_counts(sets: DataFrame, grain: Sequence, out: str) -> DataFrame:
    """The grain with the number of different values, from stored sets of the same or a finer grain."""
    names = [g if isinstance(g, str) else g[0] for g in grain]
    return merged_sets(sets, grain).groupBy(*names).agg(F.sum(F.bit_count(BITS)).alias(out))


def _same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    cond = F.lit(True)
    for x, y in zip(left, right, strict=True):
        cond = cond & x.eqNullSafe(y)
    return cond


def with_set_counts(totals: DataFrame, sets: DataFrame, grain: Sequence, out: str) -> DataFrame:
    """``totals`` (a row per cell of the grain) with ``out``; cells without a set count 0, NULL cells meet."""
    names = [g if isinstance(g, str) else g[0] for g in grain]
    counts = set_counts(sets, grain, out)
    counts = counts.select(*[F.col(n).alias(f"_rf_g{i}") for i, n in enumerate(names)], F.col(out).alias("_rf_c"))
    met = totals.join(counts, _same([totals[n] for n in names], [counts[f"_rf_g{i}"] for i in range(len(names))]), "left")
    return met.withColumn(out, F.coalesce("_rf_c", F.lit(0)).cast("bigint")).drop("_rf_c", *[f"_rf_g{i}" for i in range(len(names))])
