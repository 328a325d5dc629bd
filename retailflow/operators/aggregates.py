"""Aggregation operators: sales measures, de-duplication, row-count reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zero_dec() -> Column:
    """SQL's ``0.0`` is a decimal literal; using it keeps ratio results decimal."""
    return F.lit(Decimal("0.0"))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sales_measures(lines: DataFrame, grain: Sequence, stock: str | None = "stock_qty") -> DataFrame:
    """Daily-sales measures of the sales lines at ``grain``.

    qty_sold = sum(qty) (bigint); orders = distinct order ids (bigint);
    gross/net/discount totals rounded to 2 places (decimal sums, exact over the
    whole range of the money type); stock_avg =
    round(avg(stock), 2) over the lines (NULLs skipped); stock_final = max(stock);
    discount_pct, unit_value and avg_ticket are computed from the *unrounded*
    sums (the ticket from the rounded net total), with 0.0 / NULL / 0.0 when
    the denominator is not positive.

    Physical plan: partial aggregation by (grain, order_id) on the map side,
    one shuffle on (grain, order_id), merge, a partial count per grain and a
    second shuffle on grain. Both shuffles carry pre-aggregated rows, so a hot
    grain or a hot order does not end up as raw lines in one task.
    """
    aggs = [
        F.sum("qty").alias("qty_sold"),
        F.countDistinct("order_id").alias("orders"),
        F.round(F.sum("gross"), 2).alias("gross_total"),
        F.round(F.sum("net"), 2).alias("net_total"),
        F.round(F.sum("discount"), 2).alias("discount_total"),
        F.sum("gross").alias("_sum_gross"),
        F.sum("discount").alias("_sum_discount"),
    ]
    if stock:
        aggs += [F.round(F.avg(stock), 2).alias("stock_avg"), F.max(stock).alias("stock_final")]
    out = lines.groupBy(*[_c(g) for g in grain]).agg(*aggs)
    return add_ratio_measures(out).drop("_sum_gross", "_sum_discount")


def add_ratio_measures(df: DataFrame) -> DataFrame:
    """Post-aggregate ratios (decimal arithmetic, half-up rounding)."""
    return df.withColumns({
        "discount_pct": F.when(F.col("_sum_gross") > 0,
                               F.round(F.col("_sum_discount") / F.col("_sum_gross"), 4)).otherwise(zero_dec()),
        "unit_value": F.when(F.col("qty_sold") > 0,
                             F.round(F.col("_sum_gross") / F.col("qty_sold"), 2)),
        "avg_ticket": F.when(F.col("orders") > 0,
                             F.round(F.col("net_total") / F.col("orders"), 2)).otherwise(zero_dec()),
    })


def average_ticket(lines: DataFrame, grain: Sequence, net: str = "net", order: str = "order_id") -> DataFrame:
    """Average ticket = net revenue / distinct orders at any grain.

    The ticket is not additive (an order spans several products), so it is
    always recomputed from the lines, never re-aggregated from a finer fact.
    """
    out = lines.groupBy(*[_c(g) for g in grain]).agg(
        F.round(F.sum(net), 2).alias("net_total"),
        F.countDistinct(order).alias("orders"))
    return out.withColumn("avg_ticket", F.when(
        F.col("orders") > 0, F.round(F.col("net_total") / F.col("orders"), 2)).otherwise(zero_dec()))


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence | None = None) -> DataFrame:
    """Keep one row per business key.

    Without ``order`` the survivor is arbitrary (``dropDuplicates``, a hash
    aggregate with map-side reduction). With ``order`` the first row in that
    total order survives, computed as a ``min_by`` over a struct so the
    result is deterministic and still pre-aggregated on the map side (no
    window, so a key with a third of the rows never sits in one task).
    """
    if not order:
        return df.dropDuplicates(list(keys))
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(list(keys))
    ordering = F.struct(*[_c(o) for o in order])
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*others), ordering).alias("_rf_row"))
    return best.select(*keys, *[F.col(f"_rf_row.{c}").alias(c) for c in others]).select(*df.columns)


def latest_first(df: DataFrame, ts: str) -> list[Column]:
    """A total order of a table's rows: newest ``ts`` first (if the table has it), then all other columns."""
    newest = [-F.unix_micros(ts)] if ts in df.columns else []
    return newest + [F.col(c) for c in df.columns if c != ts]


def count_rows(df: DataFrame, label: str, label_col: str = "table_name", count_col: str = "row_count") -> DataFrame:
    """One labelled row-count (a global aggregate; map-side partial counts)."""
    return df.agg(F.count(F.lit(1)).alias(count_col)).select(
        F.lit(label).alias(label_col), F.col(count_col))


def union_counts(tables: Mapping[str, DataFrame], label_col: str = "table_name",
                 count_col: str = "row_count") -> DataFrame:
    """UNION ALL of labelled row counts (the end-of-load report)."""
    parts = [count_rows(df, name, label_col, count_col) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
