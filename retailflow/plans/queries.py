"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables of ``sf_dir`` (or data Spark derives from
them) in full. Load timestamps are left out of the returned columns because
they differ on every run; decimals are returned as doubles so that results
compare across engines (see :func:`comparable`).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions import columns as C
from ..operators.aggregates import dedup, union_counts
from ..operators.joins import enrich, threshold_join
from ..operators.windows import share_of_total
from ..sources import catalog as cat
from ..sources import fixtures as fx
from ..sources.tables import read_table
from ..sources import synth, upkeep
from . import gold, quality, refresh, silver


def comparable(df: DataFrame) -> DataFrame:
    """Drop load timestamps, turn decimals into doubles (exact for cents)."""
    out = []
    for f in df.schema.fields:
        if f.name.endswith("_ts"):
            continue
        q = "`" + f.name.replace("`", "``") + "`"
        out.append(f"CAST({q} AS DOUBLE) AS {q}" if isinstance(f.dataType, DecimalType) else q)
    return df.selectExpr(*out)


class Retail:
    """Bronze, Silver and Gold frames of one driver directory (lazy; the few
    scalars the builders need are computed once per instance)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict = {}

    def _memo(self, key, fn):
        if key not in self._cache:
            self._cache[key] = fn()
        return self._cache[key]

    # bronze
    @property
    def b_sales(self):
        return self._memo("b_sales", lambda: fx.bronze_sales(self.spark, self.sf_dir))

    @property
    def b_products(self):
        return self._memo("b_products", lambda: fx.bronze_products(self.spark, self.sf_dir))

    @property
    def b_stores(self):
        return self._memo("b_stores", lambda: fx.bronze_stores(self.spark, self.sf_dir))

    @property
    def date_range(self):
        if "top" in self._cache:
            return self._cache["top"][1]
        return self._memo("range", lambda: fx.sales_date_range(fx.ship_days(self.spark, self.sf_dir)))

    @property
    def top_ids(self):
        """Read before ``date_range`` it gives both from one scan of the lines."""
        return self._memo("top", lambda: fx.top_ids_and_span(self.spark, self.sf_dir))[0]

    @property
    def b_stock(self):
        top, (lo, hi) = self.top_ids, self.date_range
        return self._memo("b_stock", lambda: fx.bronze_stock(top, self.b_stores, lo, hi))

    @property
    def stock_rows(self) -> int:
        """Exact size of the generated snapshot (a bound for the broadcast check)."""
        lo, hi = self.date_range
        n_stores = self._memo("n_stores", lambda: self.b_stores.count())
        return fx.stock_row_bound(self.top_ids, n_stores, lo, hi)

    # silver
    @property
    def sales(self):
        return silver.silver_sales(self.b_sales)

    @property
    def products(self):
        return silver.silver_products(self.b_products, price_cuts=fx.FIXTURE_PRICE_CUTS)

    @property
    def stores(self):
        return silver.silver_stores(self.b_stores, core_cities=fx.FIXTURE_CORE_CITIES,
                                    capital=fx.FIXTURE_CAPITAL)

    @property
    def stock(self):
        return silver.silver_stock(self.b_stock)

    # gold
    def calendar(self, locale: str = "en"):
        lo, hi = self.date_range
        if lo is None:  # no sales, no days
            return gold.dim_calendar(self.spark, "1970-01-01", "1970-01-01", locale=locale).where(F.lit(False))
        return gold.dim_calendar(self.spark, f"{lo.year}-01-01", f"{hi.year}-12-31", locale=locale)


def q_fact_daily_sales(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return comparable(gold.fact_daily_sales(r.sales, r.stock, stock_rows=r.stock_rows))


def q_fact_daily_sales_by_store(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return comparable(gold.fact_daily_sales(r.sales, r.stock, grain=["sale_date", "store_id"],
                                            stock_rows=r.stock_rows))


def q_fact_daily_sales_by_store_preaggregated(spark, sf_dir):
    """The same fact by the plan for snapshots too large to broadcast."""
    r = Retail(spark, sf_dir)
    return comparable(gold.fact_daily_sales(r.sales, r.stock, grain=["sale_date", "store_id"], stock_join="preagg"))


def q_fact_monthly_sales_by_category(spark, sf_dir):
    r = Retail(spark, sf_dir)
    grain = [("year_month", F.date_format("sale_date", "yyyy-MM")), "region", "category"]
    products = fx.product_attributes(spark, sf_dir)
    return comparable(gold.fact_daily_sales(r.sales, r.stock, products=products, stores=r.stores,
                                            grain=grain, stock_rows=r.stock_rows))


def q_silver_sales(spark, sf_dir):
    return comparable(Retail(spark, sf_dir).sales)


def q_silver_products(spark, sf_dir):
    df = comparable(Retail(spark, sf_dir).products)
    return df.withColumn("weight", F.round("weight", 10))


def q_silver_stores(spark, sf_dir):
    return comparable(Retail(spark, sf_dir).stores)


def q_silver_stock(spark, sf_dir):
    return comparable(Retail(spark, sf_dir).stock)


def q_fact_daily_stock(spark, sf_dir):
    return comparable(gold.fact_daily_stock(Retail(spark, sf_dir).stock))


def q_dim_products(spark, sf_dir):
    r = Retail(spark, sf_dir)
    df = comparable(gold.dim_products(r.products))
    return df.withColumn("weight", F.round("weight", 10))


def q_dim_stores(spark, sf_dir):
    return comparable(gold.dim_stores(Retail(spark, sf_dir).stores))


def q_dim_calendar(spark, sf_dir):
    return comparable(Retail(spark, sf_dir).calendar())


def q_dim_calendar_pt(spark, sf_dir):
    return comparable(Retail(spark, sf_dir).calendar("pt"))


def q_dedup_order_lines(spark, sf_dir):
    """Deterministic de-duplication on a business key that really repeats:
    (order, line number) of lineitem; the survivor is the first row by
    (part, supplier, quantity, price, discount, ship date)."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                     "l_extendedprice", "l_discount", "l_shipdate"],
                    spread_by=["l_orderkey", "l_linenumber"])
    order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"]
    out = dedup(li, ["l_orderkey", "l_linenumber"], order)
    return out.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def q_average_ticket(spark, sf_dir):
    r = Retail(spark, sf_dir)
    grain = ["region", ("sale_year", F.year("sale_date"))]
    return comparable(gold.ticket_report(r.sales, grain, stores=r.stores))


def q_abc_products(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return comparable(gold.abc_products(r.sales)).withColumn("cum_share", F.round("cum_share", 10))


def q_load_report(spark, sf_dir):
    r = Retail(spark, sf_dir)
    # counting products needs no ranking
    return union_counts({"products": fx.product_attributes(spark, sf_dir), "stores": r.b_stores,
                         "stock": r.b_stock, "sales": r.b_sales})


def q_dq_null_keys(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return quality.null_check(r.sales, ["sale_date", "order_id", "store_id", "product_id"])


def q_dq_duplicate_keys(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"])
    return quality.duplicate_keys(li, ["l_orderkey", "l_linenumber"])


def q_dq_orphans(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey"])
    part = read_table(spark, sf_dir, "part", ["p_partkey"])
    supp = read_table(spark, sf_dir, "supplier", ["s_suppkey"])
    return quality.orphan_report(li, "lineitem", [
        ("orders", orders, [("l_orderkey", "o_orderkey")]),
        ("part", part, [("l_partkey", "p_partkey")]),
        ("supplier", supp, [("l_suppkey", "s_suppkey")]),
    ])


def q_gold_key_report(spark, sf_dir):
    """The star's key rules, on the star as the Gold jobs build it (column pruning saves the measures, and the
    keys of each table are computed once for all rules)."""
    r = Retail(spark, sf_dir)
    star = {
        "dim_stores": gold.dim_stores(r.stores),
        "dim_products": gold.dim_products(r.products),
        "dim_calendar": r.calendar(),
        "fact_daily_sales": gold.fact_daily_sales(r.sales, r.stock, stock_rows=r.stock_rows),
        "fact_daily_stock": gold.fact_daily_stock(r.stock),
    }
    return quality.gold_key_report(star, materialize=True)


def _synthetic_sales(r: Retail) -> DataFrame:
    lo, hi = r.date_range
    n_orders = read_table(r.spark, r.sf_dir, "orders", ["o_orderkey"]).count()
    tx_per_day = n_orders / float((hi - lo).days + 1)
    return synth.synthetic_sales(r.b_products, r.b_stores, lo, hi, tx_per_day=tx_per_day)


def q_synthetic_sales(spark, sf_dir):
    """The Bronze sales generator chain driven by the data: products (with
    popularity rank and Zipf weight) from part and lineitem, stores from
    region, days from the ship-date range, and a daily transaction volume
    equal to the average number of orders per day."""
    return comparable(_synthetic_sales(Retail(spark, sf_dir)))


def q_synthetic_fact_by_store(spark, sf_dir):
    """Generated Bronze sales through Silver to the fact by day and store, with stock of the same products."""
    r = Retail(spark, sf_dir)
    sales = silver.silver_sales(_synthetic_sales(r))
    return comparable(gold.fact_daily_sales(sales, r.stock, grain=["sale_date", "store_id"], stock_rows=r.stock_rows))


def _generated_products(spark, sf_dir):
    """The product generator over the part keys (each key is a product number)."""
    numbers = read_table(spark, sf_dir, "part", ["p_partkey"]).select((F.col("p_partkey") + 1).cast("int").alias("p"))
    return synth.zipf_products(spark, numbers=numbers)


def q_generated_products(spark, sf_dir):
    return comparable(_generated_products(spark, sf_dir)).withColumn("weight", F.round("weight", 10))


def q_silver_generated_products(spark, sf_dir):
    """Silver products of the generated ones, with the default price bounds."""
    out = comparable(silver.silver_products(_generated_products(spark, sf_dir)))
    return out.withColumn("weight", F.round("weight", 10))


def q_generated_stores(spark, sf_dir):
    """The store generator over the supplier keys (each key is a store number)."""
    numbers = read_table(spark, sf_dir, "supplier", ["s_suppkey"]).select((F.col("s_suppkey") + 1).cast("int").alias("i"))
    return synth.synthetic_stores(spark, numbers=numbers)


def q_written_fact_by_store(spark, sf_dir):
    """The fact by day and store written as a partitioned table, replaced for its last month, and read back."""
    r = Retail(spark, sf_dir)
    fact = gold.fact_daily_sales(r.sales, r.stock, grain=["sale_date", "store_id"], stock_rows=r.stock_rows) \
        .withColumn("month", F.date_format("sale_date", "yyyy-MM"))
    layer = "retail_check"
    cat.ensure_layers(spark, [layer])
    name = cat.qualified(layer, f"fact_by_store_{uuid.uuid4().hex[:12]}")
    load = {"partition_by": ["month"], "spread_key": ["sale_date", "store_id"], "max_records_per_file": 1_000_000,
            "column_comments": {"month": "Partition of the load."}}
    cat.save(fact, name, **load)
    _, hi = r.date_range
    if hi is not None:
        cat.save(fact.where(F.col("month") == f"{hi:%Y-%m}"), name, replace_partitions=True, **load)
    return comparable(cat.read_columns(spark, name)).drop("month")


def _check_name(table: str) -> str:
    """A fresh table name for a query that writes."""
    layer = "retail_check"
    return cat.qualified(layer, f"{table}_{uuid.uuid4().hex[:12]}")


def q_fact_monthly_sales_by_category_spread(spark, sf_dir):
    """The monthly fact with the hot products and stores of the lines salted, as for dimensions too large to broadcast."""
    r = Retail(spark, sf_dir)
    grain = [("year_month", F.date_format("sale_date", "yyyy-MM")), "region", "category"]
    products = fx.product_attributes(spark, sf_dir)
    return comparable(gold.fact_daily_sales(r.sales, r.stock, products=products, stores=r.stores, grain=grain,
                                            stock_rows=r.stock_rows, spread_hot_keys=True))


def q_average_ticket_from_sets(spark, sf_dir):
    """The average ticket by region and year from stored totals and order bitmaps by day and store."""
    r = Retail(spark, sf_dir)
    cat.ensure_layers(spark, ["retail_check"])
    parts = {}
    for kind, df in zip(("totals", "orders"), gold.ticket_sets(r.sales, ["sale_date", "store_id"]), strict=True):
        name = _check_name(f"ticket_{kind}")
        cat.create_or_replace(df, name)
        parts[kind] = enrich(cat.read_columns(spark, name), r.stores.select("store_id", "region"), "store_id")
    grain = ["region", ("sale_year", F.year("sale_date"))]
    return comparable(gold.ticket_from_sets(parts["totals"], parts["orders"], grain))


def q_reloaded_fact_by_store(spark, sf_dir):
    """The fact by day and store: a first load without its last year, then the whole-table reload, read back."""
    r = Retail(spark, sf_dir)
    fact = gold.fact_daily_sales(r.sales, r.stock, grain=["sale_date", "store_id"], stock_rows=r.stock_rows)
    cat.ensure_layers(spark, ["retail_check"])
    name, (_, hi) = _check_name("reloaded_fact"), r.date_range
    cat.save(fact.where(F.year("sale_date") < (hi.year if hi else 0)), name, max_records_per_file=1_000_000,
             column_comments={"orders": "Distinct orders."}, table_comment="Daily sales by store.")
    cat.save(fact, name, max_records_per_file=1_000_000)
    return comparable(cat.read_columns(spark, name))


def q_replaced_sales(spark, sf_dir):
    """Bronze sales written, then replaced by the Silver sales that are read from the same table."""
    cat.ensure_layers(spark, ["retail_check"])
    name = _check_name("replaced_sales")
    cat.create_or_replace(Retail(spark, sf_dir).b_sales, name)
    cat.create_or_replace(silver.silver_sales(cat.read_columns(spark, name)), name)
    return comparable(cat.read_columns(spark, name))


def q_appended_sales(spark, sf_dir):
    """Silver sales appended in batches by year: the odd years, then all years (the odd ones are there already)."""
    cat.ensure_layers(spark, ["retail_check"])
    name = _check_name("appended_sales")
    sales = Retail(spark, sf_dir).sales.withColumn("batch_id", F.year("sale_date"))
    for rows in (sales.where("batch_id % 2 = 1"), sales):
        upkeep.append_batches(rows, name, spread_key=["sale_date", "order_id"], max_records_per_file=1_000_000)
    return comparable(cat.read_columns(spark, name)).drop("batch_id")


def q_refreshed_fact_by_store(spark, sf_dir):
    """The fact by day and store, first built from sales with missing, changed and additional lines, then
    refreshed: only the months whose lines differ are rebuilt."""
    r = Retail(spark, sf_dir)
    cat.ensure_layers(spark, ["retail_check"])
    name = _check_name("refreshed_fact")
    _, hi = r.date_range

    def month(day: str):
        return F.date_format(day, "yyyy-MM")

    # one load time for both loads: rows that are the same in both are no newer in the second
    as_of = dt.datetime.now(dt.timezone.utc)
    sales = silver.silver_sales(fx.bronze_sales(spark, sf_dir, as_of), as_of)
    stock = silver.silver_stock(r.b_stock, as_of=as_of)

    def build(parts):
        fact = gold.fact_daily_sales(parts["sales"], parts["stock"], grain=["sale_date", "store_id"], stock_rows=r.stock_rows)
        return fact.withColumn("month", month("sale_date"))

    def load(lines):
        sources = {"sales": (lines, month("sale_date")), "stock": (stock, month("stock_date"))}
        return refresh.refresh_partitions(spark, name, "month", sources, build, spread_key=["sale_date", "store_id"],
                                          max_records_per_file=1_000_000)

    if hi is None:
        return comparable(build({"sales": sales, "stock": stock})).drop("month")
    # the last month is still missing, one has other quantities, and one that does not exist has lines
    late = month("sale_date") == f"{hi:%Y-%m}"
    first = sales.where("sale_date is not null").withColumns({
        "qty": F.when(~late & (F.month("sale_date") == 2), F.col("qty") + 1).otherwise(F.col("qty")),
        "sale_date": F.when(late, F.add_months("sale_date", 12)).otherwise(F.col("sale_date"))})
    load(first)
    load(sales)
    return comparable(cat.read_columns(spark, name)).drop("month")


def q_refreshed_key_report(spark, sf_dir):
    """The key report from stored key summaries, after the last month of the sales fact was replaced."""
    r = Retail(spark, sf_dir)
    cat.ensure_layers(spark, ["retail_check"])
    _, hi = r.date_range

    def month(day: str):
        return F.date_format(day, "yyyy-MM")

    fact = gold.fact_daily_sales(r.sales, r.stock, stock_rows=r.stock_rows).withColumn("month", month("sale_date"))
    star = {
        "dim_stores": gold.dim_stores(r.stores), "dim_products": gold.dim_products(r.products), "dim_calendar": r.calendar(),
        "fact_daily_sales": fact, "fact_daily_stock": gold.fact_daily_stock(r.stock).withColumn("month", month("stock_date"))}
    names = {t: _check_name(t) for t in star}
    parts = {t: "month" if t.startswith("fact") else None for t in star}
    for t, df in star.items():
        cat.save(df, names[t], partition_by=[parts[t]] if parts[t] else None, max_records_per_file=1_000_000)
        refresh.refresh_keys(spark, names[t], refresh.key_rules(t), parts[t])
    last = [f"{hi:%Y-%m}"] if hi else []
    cat.save(fact.where(F.col("month").isin(last)), names["fact_daily_sales"], partition_by=["month"], replace_partitions=True)
    return refresh.key_report({t: refresh.refresh_keys(spark, names[t], refresh.key_rules(t), parts[t], parts=last) for t in star})


def q_orders_by_revenue_weight(spark, sf_dir):
    """Every order draws the products whose share of revenue, times three, is above its draw: a threshold
    join whose weights are neither sorted nor of a closed form; unsold products have none."""
    revenue = Retail(spark, sf_dir).sales.groupBy("product_id").agg(F.sum("net").cast("double").alias("revenue"))
    part = read_table(spark, sf_dir, "part", ["p_partkey"]).select(F.col("p_partkey").alias("product_id"))
    weighted = share_of_total(part.join(revenue, "product_id", "left"), "revenue", "weight").select("product_id", "weight")
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey"], spread_by=["o_orderkey"]).select(
        F.col("o_orderkey").alias("order_id"), C.uniform("o_orderkey", salt="revenue").alias("u"))
    return threshold_join(orders, "u", weighted, "weight", 3.0).select("order_id", "product_id")


def q_part_key_series(spark, sf_dir):
    """Every number from the least to the largest part key, with the lines sold of that part."""
    part = read_table(spark, sf_dir, "part", ["p_partkey"])
    lo, hi = part.agg(F.min("p_partkey"), F.max("p_partkey")).first()
    series = synth.int_series(spark, lo, hi) if lo is not None else synth.int_series(spark, 0, -1)
    sold = read_table(spark, sf_dir, "lineitem", ["l_partkey"]).groupBy(F.col("l_partkey").cast("int").alias("n")) \
        .agg(F.count(F.lit(1)).alias("lines_sold"))
    return series.join(sold, "n", "left").select("n", F.coalesce("lines_sold", F.lit(0)).alias("lines_sold"))


def q_load_audit(spark, sf_dir):
    """The rows that the Bronze loads say they have written, counted during the writes."""
    r = Retail(spark, sf_dir)
    cat.ensure_layers(spark, ["retail_check"])
    frames = {"products": fx.product_attributes(spark, sf_dir), "stores": r.b_stores, "stock": r.b_stock, "sales": r.b_sales}
    rows = [(t, cat.save(df, _check_name(t), max_records_per_file=1_000_000)) for t, df in frames.items()]
    return spark.createDataFrame(rows, "table_name string, row_count bigint")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "fact_daily_sales": q_fact_daily_sales,
    "fact_daily_sales_by_store": q_fact_daily_sales_by_store,
    "fact_monthly_sales_by_category": q_fact_monthly_sales_by_category,
    "silver_sales": q_silver_sales,
    "silver_products": q_silver_products,
    "silver_stores": q_silver_stores,
    "silver_stock": q_silver_stock,
    "fact_daily_stock": q_fact_daily_stock,
    "dim_products": q_dim_products,
    "dim_stores": q_dim_stores,
    "dim_calendar": q_dim_calendar,
    "dim_calendar_pt": q_dim_calendar_pt,
    "dedup_order_lines": q_dedup_order_lines,
    "average_ticket": q_average_ticket,
    "abc_products": q_abc_products,
    "load_report": q_load_report,
    "dq_null_keys": q_dq_null_keys,
    "dq_duplicate_keys": q_dq_duplicate_keys,
    "dq_orphans": q_dq_orphans,
    "gold_key_report": q_gold_key_report,
    "synthetic_sales": q_synthetic_sales,
    "synthetic_fact_by_store": q_synthetic_fact_by_store,
    "silver_generated_products": q_silver_generated_products,
    "written_fact_by_store": q_written_fact_by_store,
    "fact_daily_sales_by_store_preaggregated": q_fact_daily_sales_by_store_preaggregated,
    "generated_products": q_generated_products,
    "generated_stores": q_generated_stores,
    "fact_monthly_sales_by_category_spread": q_fact_monthly_sales_by_category_spread,
    "average_ticket_from_sets": q_average_ticket_from_sets,
    "reloaded_fact_by_store": q_reloaded_fact_by_store,
    "replaced_sales": q_replaced_sales,
    "appended_sales": q_appended_sales,
    "refreshed_fact_by_store": q_refreshed_fact_by_store,
    "refreshed_key_report": q_refreshed_key_report,
    "orders_by_revenue_weight": q_orders_by_revenue_weight,
    "part_key_series": q_part_key_series,
    "load_audit": q_load_audit,
}
