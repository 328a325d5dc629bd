"""Driver tables -> retail Bronze tables.

The retail pipeline needs products, stores, stock snapshots and sales lines.
They are derived from the driver's TPC-H-style tables so that every job's
work grows with the data:

=================  ===========================================================
retail             derived from
=================  ===========================================================
sales line         lineitem: ship day, order, part, quantity, exact money
store              region (reached through supplier -> nation)
product            part; popularity rank = total quantity sold (desc, key)
stock snapshot     every store x top-N product x day in the sales date range
calendar           whole years around the sales date range
=================  ===========================================================
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import MONEY, RATE, keyed_int, padded_id, to_money
from ..operators.joins import bounded_values, explode_dates, explode_values
from ..operators.windows import row_number_by, share_of_total
from .tables import read_table, spread

from ..fixed import STOCK_BASE, STOCK_SPREAD, STOCK_TOP_RANK  # noqa: F401
from ..fixed import ZIPF_S as ZIPF_EXPONENT

# Our choices for mapping the driver tables (not values of the surveyed pipeline)
STOCK_SALT = "stock"
FIXTURE_PRICE_CUTS = (933, 967)          # part prices run 900..999.9: about thirds
FIXTURE_CORE_CITIES = ("AFRICA", "AMERICA", "ASIA", "EUROPE")
FIXTURE_CAPITAL = "EUROPE"
FIXTURE_STATE = "ES"
SKU_WIDTH = 6


def load_ts(as_of) -> "F.Column":
    """Load timestamp: an explicit ``as_of`` for reproducible reruns, else now."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def bronze_sales(spark: SparkSession, sf_dir: str, as_of=None) -> DataFrame:
    """Sales lines: (sale_date, order_id, store_id, product_id, qty, net, discount, bronze_ts).

    Money is cast to decimal(18,2) before any arithmetic; net and discount are
    each rounded half-up to cents (so gross can exceed the price by a cent on
    an exact half-cent, as in the surveyed generator).
    """
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                     "l_extendedprice", "l_discount", "l_shipdate"])
    # narrow types first (fewer bytes if the scan is spread), then spread on
    # the row-unique (order, line) so no business key decides a task's load
    li = spread(li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                          F.col("l_quantity").cast("int").alias("l_quantity"),
                          "l_extendedprice", "l_discount",
                          F.col("l_shipdate").cast("date").alias("l_shipdate")),
                ["l_orderkey", "l_linenumber"])
    supp = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    # nation has 25 rows by definition of the schema: a fixed-size broadcast
    nation = F.broadcast(read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"]))
    # supplier: no hint. The planner broadcasts it when its scan size is under
    # the broadcast threshold; otherwise it shuffles (and AQE re-plans with the
    # real size, or splits a hot supplier key).
    lines = li.join(supp, li.l_suppkey == supp.s_suppkey, "left")
    lines = lines.join(nation, lines.s_nationkey == nation.n_nationkey, "left")
    lines = lines.withColumn("store_id", F.col("n_regionkey").cast("string"))
    price = to_money("l_extendedprice")
    rate = F.col("l_discount").cast(RATE)
    return lines.select(
        F.col("l_shipdate").alias("sale_date"),
        F.col("l_orderkey").alias("order_id"),
        F.col("store_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("qty"),
        F.round(price * (F.lit(1) - rate), 2).cast(MONEY).alias("net"),
        F.round(price * rate, 2).cast(MONEY).alias("discount"),
        load_ts(as_of).alias("bronze_ts"),
    )


def product_base(spark: SparkSession, sf_dir: str, span: Observation | None = None) -> DataFrame:
    """Parts with their total quantity sold (``_qty``; 0 when never sold).

    ``span`` observes the first and last sale day (``lo``, ``hi``) in the same scan of the lines.
    """
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_retailprice"])
    if span is None:
        sold = (read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_quantity"])
                .groupBy("l_partkey").agg(F.sum("l_quantity").alias("_qty")))
    else:
        day = F.col("l_shipdate").cast("date")
        sold = (read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_quantity", "l_shipdate"])
                .groupBy("l_partkey").agg(F.sum("l_quantity").alias("_qty"), F.min(day).alias("_lo"), F.max(day).alias("_hi"))
                .observe(span, F.min("_lo").alias("lo"), F.max("_hi").alias("hi")))
    base = part.join(sold, part.p_partkey == sold.l_partkey, "left").select(
        F.col("p_partkey").alias("product_id"),
        padded_id("SKU-", "p_partkey", SKU_WIDTH).alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        to_money("p_retailprice").alias("list_price"),
        F.coalesce(F.col("_qty"), F.lit(0.0)).alias("_qty"),
    )
    return base


def _popularity_order():
    """Most sold first; ties (e.g. unsold parts) by product id."""
    return [F.col("_qty").desc(), F.col("product_id").asc()]


def product_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptive product attributes straight from part (no ranking work):
    what a fact needs to group by category or brand."""
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_retailprice"])
    return part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                       F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
                       to_money("p_retailprice").alias("list_price"))


def top_product_ids(spark: SparkSession, sf_dir: str, n: int = STOCK_TOP_RANK) -> list:
    """Ids of the ``n`` most popular products (rank 1..n), best first.

    A top-k (per-task top n, then a merge of n rows per task), not a full
    sort; the list is bounded by ``n``.
    """
    top = product_base(spark, sf_dir).orderBy(*_popularity_order()).limit(n)
    return bounded_values(top, "product_id", n)


def top_ids_and_span(spark: SparkSession, sf_dir: str, n: int = STOCK_TOP_RANK) -> tuple[list, tuple]:
    """``top_product_ids`` and the first and last sale day, from one scan of the lines."""
    span = Observation()
    ids = bounded_values(product_base(spark, sf_dir, span).orderBy(*_popularity_order()).limit(n), "product_id", n)
    found = span.get
    return ids, (found.get("lo"), found.get("hi"))


def bronze_products(spark: SparkSession, sf_dir: str, exponent: float = ZIPF_EXPONENT) -> DataFrame:
    """Products: (rank, product_id, sku, name, category, brand, list_price, weight).

    rank = row number by total quantity sold (desc; unsold parts count 0; ties
    by key) — computed with the distributed numbering, not a one-task window.
    weight = rank**-exponent divided by its total over all products.
    """
    base = product_base(spark, sf_dir)
    ranked = row_number_by(base, _popularity_order(), out="rank")
    ranked = ranked.withColumn("_raw", F.pow(F.lit(1.0) / F.col("rank"), F.lit(float(exponent))))
    weighted = share_of_total(ranked, "_raw", "weight")
    return weighted.select("rank", "product_id", "sku", "name", "category", "brand", "list_price", "weight")


def bronze_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores: (store_id, name, city, state), one per region."""
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return region.select(
        F.col("r_regionkey").cast("string").alias("store_id"),
        F.concat(F.lit("Loja "), F.col("r_regionkey").cast("string")).alias("name"),
        F.col("r_name").alias("city"),
        F.lit(FIXTURE_STATE).alias("state"),
    )


def ship_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sale day of every line (a one-column scan of lineitem)."""
    return read_table(spark, sf_dir, "lineitem", ["l_shipdate"]).select(
        F.col("l_shipdate").cast("date").alias("sale_date"))


def sales_date_range(sales: DataFrame, date_col: str = "sale_date") -> tuple[_dt.date, _dt.date]:
    """(first, last) sale day: one global aggregate, two scalars to the driver."""
    row = sales.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).first()
    return row["lo"], row["hi"]


def calendar_range(sales: DataFrame, date_col: str = "sale_date") -> tuple[_dt.date, _dt.date]:
    """Whole years covering the sales: Jan 1 of the first year .. Dec 31 of the last (no sales: no days)."""
    lo, hi = sales_date_range(sales, date_col)
    if lo is None:
        return None, None
    return _dt.date(lo.year, 1, 1), _dt.date(hi.year, 12, 31)


def stock_row_bound(top_ids: list, n_stores: int, start, end) -> int:
    """Exact row count of ``bronze_stock`` (stores x products x days)."""
    return len(top_ids) * n_stores * ((end - start).days + 1) if start else 0


def bronze_stock(top_ids: list, stores: DataFrame, start, end,
                 num_partitions: int | None = None) -> DataFrame:
    """Stock snapshots: (day, product_id, store_id, stock_qty) for every store,
    every product of ``top_ids`` (the ids with rank <= 40, numbers or text, see
    ``top_product_ids``) and every day in [start, end].

    Built with generators instead of a cross join: each store row explodes the
    short, provably bounded id list, the (store, product) pairs are spread
    over the tasks by a hash of the pair, and each pair explodes the day
    sequence. Quantity = 100 + a keyed draw mod 20, identical on every rerun
    and in any partition layout.
    """
    spark = stores.sparkSession
    # the pair list is tiny before the day explode: spread it over all cores
    n = num_partitions or spark.sparkContext.defaultParallelism
    kind = "string" if top_ids and isinstance(top_ids[0], str) else "bigint"
    if not top_ids or start is None:
        return stores.select(F.lit(None).cast("date").alias("day"), F.lit(None).cast("bigint").alias("product_id"),
                             "store_id", F.lit(None).cast("int").alias("stock_qty")).limit(0)
    grid = explode_values(stores.select("store_id"), top_ids, "product_id", kind)
    grid = explode_dates(grid.repartition(n, "store_id", "product_id"), start, end, "day")
    qty = (F.lit(STOCK_BASE) + keyed_int("product_id", "store_id", "day",
                                         salt=STOCK_SALT, modulus=STOCK_SPREAD)).cast("int")
    return grid.select("day", "product_id", "store_id", qty.alias("stock_qty"))


@dataclass
class Bronze:
    """The four Bronze tables derived from one driver data directory."""
    products: DataFrame
    stores: DataFrame
    sales: DataFrame
    stock: DataFrame
    start: _dt.date
    end: _dt.date


def load_bronze(spark: SparkSession, sf_dir: str, as_of=None, with_stock: bool = True) -> Bronze:
    sales = bronze_sales(spark, sf_dir, as_of)
    products = bronze_products(spark, sf_dir)
    stores = bronze_stores(spark, sf_dir)
    top, (lo, hi) = top_ids_and_span(spark, sf_dir)
    stock = bronze_stock(top, stores, lo, hi) if with_stock else None
    return Bronze(products, stores, sales, stock, lo, hi)
