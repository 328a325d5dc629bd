"""Gold jobs: star schema (3 dimensions, 2 facts) and business measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns
from ..operators.aggregates import add_ratio_measures, average_ticket, dedup, latest_first, sales_measures, zero_dec
from ..operators.distinct import distinct_sets, with_set_counts
from ..operators.joins import BROADCAST_MAX_BYTES, date_sequence, enrich, enrich_snapshot, enrich_spread
from ..operators.windows import abc_curve
from ..sources.fixtures import load_ts
from .silver import SILVER_PRODUCTS, SILVER_STORES

DIM_STORES = SILVER_STORES + ["gold_ts"]
DIM_PRODUCTS = SILVER_PRODUCTS + ["gold_ts"]
DIM_CALENDAR = ["day", "year", "month", "day_of_month", "quarter", "year_month", "month_name",
                "weekday_num", "weekday_name", "is_weekend", "gold_ts"]
FACT_STOCK = ["stock_date", "store_id", "product_id", "stock_band", "stock_qty", "silver_ts", "gold_ts"]
FACT_SALES_GRAIN = ["sale_date", "store_id", "product_id"]
FACT_SALES_MEASURES = ["qty_sold", "orders", "gross_total", "net_total", "discount_total",
                       "discount_pct", "unit_value", "avg_ticket", "stock_avg", "stock_final"]
SNAPSHOT_ROW_BYTES = 64  # day, store text, product key, quantity as a hashed row, rounded up
STOCK_KEYS = [("sale_date", "stock_date"), ("store_id", "store_id"), ("product_id", "product_id")]


def grain_columns(grain: Sequence) -> tuple[list, list[str]]:
    """Grain items (names or ``(name, Column)`` pairs) -> (columns, names)."""
    cols, names = [], []
    for g in grain:
        if isinstance(g, str):
            cols.append(F.col(g))
            names.append(g)
        else:
            name, expr = g
            cols.append(expr.alias(name))
            names.append(name)
    return cols, names


def _newest(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``keys`` and ``cols`` of one row per key: the newest load, ties by the columns."""
    ts = [c for c in ("silver_ts",) if c in df.columns]
    rows = df.select(*keys, *cols, *ts)
    return dedup(rows, keys, latest_first(rows, "silver_ts")).select(*keys, *cols)


def _attributes(dim: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    return _newest(dim, [key], cols)


def dim_stores(silver: DataFrame, order: Sequence | None = None, as_of=None) -> DataFrame:
    """One row per store id: the newest load, ties by all columns (or the first in ``order``)."""
    return dedup(silver, ["store_id"], order or latest_first(silver, "silver_ts")).withColumn("gold_ts", load_ts(as_of)).select(*DIM_STORES)


def dim_products(silver: DataFrame, order: Sequence | None = None, as_of=None) -> DataFrame:
    """One row per product id: the newest load, ties by all columns (or the first in ``order``)."""
    return dedup(silver, ["product_id"], order or latest_first(silver, "silver_ts")).withColumn("gold_ts", load_ts(as_of)).select(*DIM_PRODUCTS)


def dim_calendar(spark: SparkSession, start, end, locale: str = "en", as_of=None,
                 num_partitions: int | None = None) -> DataFrame:
    """One row per day in [start, end] with its calendar attributes.

    The day list is generated from a one-row frame and spread over
    ``num_partitions`` tasks before the attributes are computed.
    """
    seed = spark.range(1).select(
        F.explode(date_sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day"))
    if num_partitions:
        seed = seed.repartition(num_partitions)
    return seed.withColumns(calendar_columns("day", locale)).withColumn(
        "gold_ts", load_ts(as_of)).select(*DIM_CALENDAR)


def fact_daily_stock(silver_stock: DataFrame, as_of=None) -> DataFrame:
    """Stock fact: the Silver snapshot keyed by day, store and product."""
    return silver_stock.select("stock_date", "store_id", "product_id", "stock_band",
                               "stock_qty", "silver_ts").withColumn(
        "gold_ts", load_ts(as_of)).select(*FACT_STOCK)


def fact_daily_sales(sales: DataFrame, stock: DataFrame | None = None,
                     products: DataFrame | None = None, stores: DataFrame | None = None,
                     grain: Sequence = FACT_SALES_GRAIN, stock_join: str = "auto",
                     stock_rows: int | None = None, as_of=None, spread_hot_keys: bool = False) -> DataFrame:
    """Daily sales fact at ``grain`` (default day x store x product).

    ``grain`` items are column names of the sales lines or of the product /
    store dimensions (then that dimension is left-joined first), or
    ``(name, Column)`` pairs for derived keys (e.g. a month).

    Stock (a snapshot keyed by day, store, product) is matched to sales:

    * ``"line"`` joins it to every sales line before grouping, so at a grain
      coarser than day x store x product the mean stock is weighted by lines;
    * ``"grain"`` groups first and joins afterwards, which needs the grain to
      contain the three stock keys. The join input is then one row per key,
      so a hot key never reaches the join as raw lines;
    * ``"preagg"`` (any grain) groups the lines first by grain + the three
      stock keys (sums and line counts), joins the snapshot one
      row per key, rolls up to the grain with a line-weighted stock mean, and
      counts distinct orders in a separate pre-aggregated branch joined back
      on the grain. Same result as ``"line"``, without shuffling raw lines on
      a business key;
    * ``"auto"`` picks ``"grain"`` when possible; else ``"line"`` when the
      snapshot is broadcast (a broadcast join moves no line, so no key can be
      hot); else ``"preagg"``.

    Both give the same result when the snapshot has one row per key, which is
    ensured by deduplicating it on its key first.

    ``stock_rows`` is a proven upper bound of the snapshot's row count (a
    generated snapshot knows it: stores x products x days). At most
    ``BROADCAST_MAX_BYTES`` bytes -> the snapshot is broadcast; otherwise (or
    unknown) it is sort-merge joined, never broadcast on an estimate.

    ``spread_hot_keys`` joins product and store attributes with the hot keys
    salted (``enrich_spread``): for dimensions too large to broadcast, where a product or
    store with a third of the lines would otherwise be one task's work.
    """
    attach = enrich_spread if spread_hot_keys else enrich
    grain_cols, keys = grain_columns(grain)
    names = set(keys)
    lines = sales.select("sale_date", "order_id", "store_id", "product_id", "qty",
                         "gross", "net", "discount")
    if products is not None:
        want = [c for c in products.columns if c in names and c not in lines.columns]
        if want:
            lines = attach(lines, _attributes(products, "product_id", want), "product_id")
    if stores is not None:
        want = [c for c in stores.columns if c in names and c not in lines.columns]
        if want:
            lines = attach(lines, _attributes(stores, "store_id", want), "store_id")

    if stock is None:
        fact = sales_measures(lines, grain_cols, stock=None).withColumns({
            "stock_avg": F.lit(None).cast("double"), "stock_final": F.lit(None).cast("int")})
    else:
        snap = _newest(stock, ["stock_date", "store_id", "product_id"], ["stock_qty"])
        grain_has_keys = all(k in names for k, _ in STOCK_KEYS)
        strategy = "broadcast" if stock_rows is not None and stock_rows * SNAPSHOT_ROW_BYTES <= BROADCAST_MAX_BYTES else "merge"
        if stock_join == "auto":
            mode = "grain" if grain_has_keys else ("line" if strategy == "broadcast" else "preagg")
        else:
            mode = stock_join
        if mode == "grain":
            if not grain_has_keys:
                raise ValueError("stock_join='grain' needs sale_date, store_id and product_id in the grain")
            fact = sales_measures(lines, grain_cols, stock=None)
            fact = enrich_snapshot(fact, snap, STOCK_KEYS, ["stock_qty"], strategy=strategy)
            fact = fact.withColumns({
                "stock_avg": F.round(F.col("stock_qty").cast("double"), 2),
                "stock_final": F.col("stock_qty")}).drop("stock_qty")
        elif mode == "line":
            lines = enrich_snapshot(lines, snap, STOCK_KEYS, ["stock_qty"], strategy=strategy)
            fact = sales_measures(lines, grain_cols, stock="stock_qty")
        elif mode == "preagg":
            fact = _preaggregated_measures(lines, grain_cols, keys, snap, strategy)
        else:
            raise ValueError(f"unknown stock_join {stock_join!r}")
    return fact.withColumn("gold_ts", load_ts(as_of)).select(*keys, *FACT_SALES_MEASURES, "gold_ts")


def _preaggregated_measures(lines: DataFrame, grain_cols: list, keys: list[str], snap: DataFrame,
                            strategy: str) -> DataFrame:
    """Sales measures at a grain with a line-weighted snapshot, computed from
    pre-aggregated rows only (see ``fact_daily_sales``, mode "preagg")."""
    # a sum of sums keeps the type of the sum
    money = {out: lines.select(F.sum(c).alias("s")).schema["s"].dataType
             for out, c in (("_gross", "gross"), ("_net", "net"), ("_disc", "discount"))}
    stock_keys = [k for k, _ in STOCK_KEYS]
    extra = [F.col(k) for k in stock_keys if k not in keys]
    per_key = lines.groupBy(*grain_cols, *extra).agg(
        F.sum("qty").alias("_qty"),
        F.sum("gross").alias("_gross"), F.sum("net").alias("_net"), F.sum("discount").alias("_disc"),
        F.count(F.lit(1)).alias("_lines"))
    per_key = enrich_snapshot(per_key, snap, STOCK_KEYS, ["stock_qty"], strategy=strategy)
    with_stock = F.col("stock_qty").isNotNull()
    rolled = per_key.groupBy(*keys).agg(
        F.sum("_qty").alias("qty_sold"),
        *[F.sum(c).cast(t).alias(c) for c, t in money.items()],
        F.sum(F.when(with_stock, F.col("stock_qty").cast("bigint") * F.col("_lines"))).alias("_stock_w"),
        F.sum(F.when(with_stock, F.col("_lines"))).alias("_stock_n"),
        F.max("stock_qty").alias("stock_final"))
    orders = lines.groupBy(*grain_cols).agg(F.countDistinct("order_id").alias("orders"))
    orders = orders.select(*[F.col(k).alias(f"_o_{i}") for i, k in enumerate(keys)], "orders")
    # null-safe: a group with a NULL key (e.g. an unknown store) must survive
    cond = None
    for i, k in enumerate(keys):
        t = rolled[k].eqNullSafe(orders[f"_o_{i}"])
        cond = t if cond is None else cond & t
    out = rolled.join(orders, cond, "inner").select(
        *[rolled[k] for k in keys], "qty_sold", "orders",
        F.round("_gross", 2).alias("gross_total"), F.round("_net", 2).alias("net_total"),
        F.round("_disc", 2).alias("discount_total"),
        F.col("_gross").alias("_sum_gross"), F.col("_disc").alias("_sum_discount"),
        F.round(F.col("_stock_w") / F.col("_stock_n"), 2).alias("stock_avg"),
        "stock_final")
    return add_ratio_measures(out).drop("_sum_gross", "_sum_discount")


def ticket_report(sales: DataFrame, grain: Sequence, products: DataFrame | None = None,
                  stores: DataFrame | None = None) -> DataFrame:
    """Average ticket (net / distinct orders) recomputed from the lines."""
    lines = sales
    grain_cols, keys = grain_columns(grain)
    names = set(keys)
    if products is not None:
        want = [c for c in products.columns if c in names and c not in lines.columns]
        if want:
            lines = enrich(lines, _attributes(products, "product_id", want), "product_id")
    if stores is not None:
        want = [c for c in stores.columns if c in names and c not in lines.columns]
        if want:
            lines = enrich(lines, _attributes(stores, "store_id", want), "store_id")
    return average_ticket(lines, grain_cols)


def abc_products(sales: DataFrame, value: str = "net", cuts=(0.80, 0.95),
                 num_partitions: int | None = None) -> DataFrame:
    """ABC revenue classes of products: revenue per product, then the
    cumulative-share classes (see ``abc_curve``)."""
    revenue = sales.groupBy("product_id").agg(F.sum(value).alias("revenue"))
    return abc_curve(revenue, "product_id", "revenue", cuts=cuts, num_partitions=num_partitions).select(
        "product_id", "revenue", "cum_value", "cum_share", "abc_class")


def ticket_sets(sales: DataFrame, grain: Sequence, order_numbers: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """What any coarser ticket needs, at ``grain``: net totals, and the sets of orders as mergeable bitmaps.

    ``order_numbers`` (order_id, number) numbers the orders; without it the
    order ids are non-negative whole numbers themselves.
    """
    grain_cols, keys = grain_columns(grain)
    lines = sales.select(*grain_cols, "order_id", "net")
    totals = lines.groupBy(*keys).agg(F.sum("net").alias("net_sum"))
    if order_numbers is not None:
        lines = enrich(lines, order_numbers, "order_id")
    return totals, distinct_sets(lines, keys, "order_id" if order_numbers is None else "number")


def ticket_from_sets(totals: DataFrame, sets: DataFrame, grain: Sequence) -> DataFrame:
    """Average ticket at ``grain`` from the stored totals and order sets of a finer grain: no line is read again."""
    grain_cols, keys = grain_columns(grain)
    money = totals.schema["net_sum"].dataType
    rolled = totals.groupBy(*grain_cols).agg(F.round(F.sum("net_sum").cast(money), 2).alias("net_total"))
    out = with_set_counts(rolled, sets, grain, "orders")
    return out.withColumn("avg_ticket", F.when(
        F.col("orders") > 0, F.round(F.col("net_total") / F.col("orders"), 2)).otherwise(zero_dec()))
