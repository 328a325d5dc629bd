"""Window-style operators that stay distributed when groups are huge.

``Window.partitionBy(g)`` puts each group into one task and a window without
``partitionBy`` puts the whole table into one task. Both break when one group
(or the table) holds a third of the data, so the numbering below is done with
a range-partitioned sort plus per-partition offsets instead: each task numbers
its own slice, and a small table of slice sizes (one row per task and group)
turns local positions into global ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOW33 = (1 << 33) - 1  # monotonically_increasing_id keeps the row index in the low 33 bits


def _sort_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _range(df: DataFrame, keys: Sequence[Column], num_partitions: int | None) -> DataFrame:
    """Range partitioning on ``keys``. Without an explicit count AQE sizes the
    partitions from the real data (about the advisory partition size each),
    so a hot group is cut into bounded slices and small inputs use few tasks."""
    return df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)


def row_number_by(df: DataFrame, order: Sequence, within: Sequence[str] = (),
                  out: str = "row_number", num_partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by within order by order)`` without
    collecting a group (or the table) into a single task.

    ``order`` must be a total order inside each group (append the key as a
    tie-breaker) so a recomputed partition numbers its rows the same way.
    """
    keys = [F.col(w) for w in within] + [_sort_col(o) for o in order]
    tagged = _materialize(_range(df, keys, num_partitions)
                            .sortWithinPartitions(*keys)
                            .withColumn("_rf_pid", F.spark_partition_id())
                            .withColumn("_rf_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33))))
    # one row per (task, group): where the group starts in the task and how many rows it has
    slices = tagged.groupBy("_rf_pid", *within).agg(
        F.min("_rf_pos").alias("_rf_first"), F.count(F.lit(1)).alias("_rf_n"))
    before = Window.partitionBy(*within).orderBy("_rf_pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_rf_off", F.coalesce(F.sum("_rf_n").over(before), F.lit(0)))
    slices = slices.select(F.col("_rf_pid").alias("_rf_spid"),
                           *[F.col(w).alias(f"_rf_w{i}") for i, w in enumerate(within)],
                           "_rf_first", "_rf_off")
    if not within:
        # at most one row per task: a size bound that does not grow with the data
        slices = F.broadcast(slices)
    cond = tagged["_rf_pid"] == slices["_rf_spid"]
    for i, w in enumerate(within):
        # null-safe: rows whose group key is NULL form a group of their own
        cond = cond & tagged[w].eqNullSafe(slices[f"_rf_w{i}"])
    numbered = tagged.join(slices, cond, "inner")
    return numbered.withColumn(
        out, _checked_int(F.col("_rf_pos") - F.col("_rf_first") + F.col("_rf_off") + F.lit(1))
    ).drop("_rf_pid", "_rf_pos", "_rf_first", "_rf_off", "_rf_spid", *[f"_rf_w{i}" for i in range(len(within))])


def _checked_int(position: Column) -> Column:
    """The declared 32-bit column from a 64-bit position; beyond its range the job fails, it never wraps."""
    return F.when(position <= F.lit(2147483647), position.cast("int")).otherwise(
        F.raise_error(F.lit("row number beyond 32 bits")).cast("int"))


def _materialize(tagged: DataFrame) -> DataFrame:
    """Write the sorted, tagged rows once to the checkpoint folder.

    They are read twice (slice sizes, then the numbering); the checkpoint
    makes both reads see the same rows without sorting twice and cuts the
    lineage, so a lost executor re-reads files instead of re-running the sort.
    The folder is the cluster's ``spark.checkpoint.dir``.
    """
    ensure_checkpoint_dir(tagged.sparkSession)
    return tagged.checkpoint(eager=True)


def rank_within(df: DataFrame, within: Sequence[str], order: Sequence, out: str,
                num_partitions: int | None = None) -> DataFrame:
    """Row number of each row inside its group (1 = first in ``order``)."""
    return row_number_by(df, order, within=within, out=out, num_partitions=num_partitions)


def column_total(df: DataFrame, c) -> object:
    """One scalar aggregate, computed by Spark and returned to the driver."""
    return df.agg(F.sum(_sort_col(c)).alias("t")).first()["t"]


def share_of_total(df: DataFrame, value, out: str) -> DataFrame:
    """``value / sum(value) over ()``, NULL if the total is zero or NULL.

    The total is one distributed aggregate brought back as a scalar, so no task
    ever holds the whole table."""
    total = F.lit(column_total(df, value)).cast("double")  # no rows: no total
    return df.withColumn(out, F.when(total != 0, _sort_col(value) / total))


def abc_curve(df: DataFrame, item: str, value: str, cuts: tuple[float, float] = (0.80, 0.95),
              labels: tuple[str, str, str] = ("A", "B", "C"), out: str = "abc_class",
              num_partitions: int | None = None) -> DataFrame:
    """ABC (Pareto) classes by cumulative share of ``value``.

    Items are ordered by value descending (NULL last), ties by ``item``. An
    item is A while the share of all items *before* it is below ``cuts[0]``, B
    while below ``cuts[1]``, else C. If the total is zero or NULL there are no
    shares: ``cum_share`` is NULL and every item is in the last class. A NULL value adds nothing.

    Spark cuts the order into ranges of (value, item), so many items of one
    value still spread. The sorted rows with the number of their range are written once; the
    sums of the ranges (a row per task) become offsets of the running sums.
    """
    keys = [F.col(value).desc_nulls_last(), F.col(item).asc()]
    rows = _materialize(_range(df, keys, num_partitions).sortWithinPartitions(*keys)
                        .withColumn("_rf_slice", F.spark_partition_id()))
    sums = rows.groupBy("_rf_slice").agg(F.sum(value).alias("_rf_s"))
    # a row per task
    ahead = Window.orderBy("_rf_slice").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_rf_slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total_type = sums.schema["_rf_s"].dataType
    offsets = F.broadcast(sums.select(
        "_rf_slice", F.sum("_rf_s").over(ahead).cast(total_type).alias("_rf_off"),
        F.sum("_rf_s").over(every).cast(total_type).alias("_rf_total")))
    w = Window.partitionBy("_rf_slice").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = F.coalesce(F.col("_rf_off"), F.lit(0)) + F.coalesce(F.col("_rf_run"), F.lit(0))
    total = F.col("_rf_total")
    res = rows.withColumn("_rf_run", F.sum(value).over(w)).join(offsets, "_rf_slice").withColumns({
        "cum_value": cum,
        "cum_share": F.when(total != 0, cum.cast("double") / total.cast("double"))})
    # class bounds compared exactly: prior < cut * total (no division)
    prior = F.col("cum_value") - F.coalesce(F.col(value), F.lit(0))
    cut_a, cut_b = (F.lit(Decimal(str(c))) for c in cuts)
    res = res.withColumn(out, F.when((total != 0) & (prior < total * cut_a), F.lit(labels[0]))
                               .when((total != 0) & (prior < total * cut_b), F.lit(labels[1]))
                               .otherwise(F.lit(labels[2])))
    return res.drop("_rf_slice", "_rf_run", "_rf_off", "_rf_total")
