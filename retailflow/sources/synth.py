"""Synthetic Bronze generators (products, stores, stock, sales) as Spark jobs.

Every random quantity is a keyed draw (``functions.columns.uniform``): the
value depends only on the row's keys and a per-draw salt, never on the
partition layout or on retries, and two draws in one row are independent
(their salts differ). Rows are spread over the tasks right after the small
day x store grid is built, so generation runs on every core.

Generator chain for sales lines:

    days x stores (season factor)  -> transactions per day and store
    -> one row per transaction      -> basket size
    -> one row per basket item      -> popularity draw u
    -> products with 3 * weight > u (see threshold_join)
    -> quantity and discount draws  -> order id, net and discount money
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import season_factor
from ..functions.columns import MONEY, RATE, padded_id, uniform, uniform_below
from ..operators.joins import date_sequence, threshold_join
from ..operators.windows import column_total
from .fixtures import load_ts

from ..fixed import (BASKET_MAX, BRANDS, CATEGORIES, CITIES, DISC_LOW, DISC_P,  # noqa: F401
                     DISC_WIDTH, N_PRODUCTS, N_STORES, PICK_FACTOR, PRICE_BASE, PRICE_MOD,
                     PRICE_SPREAD, QTY_P2, QTY_P3, SEASON_AMPLITUDE, STATE, TX_DIVISOR, TX_LOW,
                     TX_PER_DAY, TX_WIDTH, U_RESOLUTION, ZIPF_S)


# Orders that one row is exploded to, and tasks per core that the blocks are dealt to (a slow task is a small part).
ORDER_BLOCK, TASKS_PER_CORE = 1_000, 4


def _pick(values, idx):
    """``values[idx]`` through a literal map (missing key -> NULL)."""
    m = F.create_map(*[x for i, v in enumerate(values) for x in (F.lit(i), F.lit(v))])
    return F.element_at(m, idx)


def int_series(spark: SparkSession, lo: int, hi: int, name: str = "n") -> DataFrame:
    """Inclusive integer range as rows (``spark.range`` is already distributed)."""
    return spark.range(lo, hi + 1).select(F.col("id").cast("int").alias(name))


def zipf_products(spark: SparkSession, n: int = N_PRODUCTS, s: float = ZIPF_S, salt: str = "price",
                  numbers: DataFrame | None = None) -> DataFrame:
    """Products p = 1..n: id ``P0001``, sku, name, category (p mod 6), brand (p mod 4),
    list price 5 + p mod 20 + U*10, rank = p, weight = p**-s / sum(p**-s).

    ``numbers`` (one positive int column ``p``) gives the products instead of 1..n."""
    p = F.col("p")
    base = (int_series(spark, 1, n, "p") if numbers is None else numbers).select(
        p.alias("rank"),
        padded_id("P", p, 4).alias("product_id"),
        padded_id("SKU-", p, 4).alias("sku"),
        F.concat(F.lit("Produto "), p.cast("string")).alias("name"),
        _pick(CATEGORIES, p % len(CATEGORIES)).alias("category"),
        _pick(BRANDS, p % len(BRANDS)).alias("brand"),
        (F.lit(PRICE_BASE) + p % PRICE_MOD + uniform(p, salt=salt) * PRICE_SPREAD).cast(MONEY).alias("list_price"),
        F.pow(F.lit(1.0) / p, F.lit(float(s))).alias("_w"),
    )
    total = column_total(base, "_w")
    return base.withColumn("weight", F.col("_w") / F.lit(total).cast("double")).drop("_w")


def synthetic_stores(spark: SparkSession, n: int = N_STORES, numbers: DataFrame | None = None) -> DataFrame:
    """Stores i = 1..n (or the column ``i`` of ``numbers``): id as text, name, city by ((i - 1) mod 6) + 1, state."""
    i = F.col("i")
    cities = F.create_map(*[x for k, c in enumerate(CITIES, start=1) for x in (F.lit(k), F.lit(c))])
    return (int_series(spark, 1, n, "i") if numbers is None else numbers).select(
        i.cast("string").alias("store_id"),
        F.concat(F.lit("Loja "), i.cast("string")).alias("name"),
        F.element_at(cities, (i - 1) % len(CITIES) + 1).alias("city"),
        F.lit(STATE).alias("state"),
    )


def transaction_grid(stores: DataFrame, start, end, tx_per_day: float = TX_PER_DAY,
                     divisor: float = TX_DIVISOR, num_partitions: int | None = None) -> DataFrame:
    """(day, store_id, tx): transactions per day and store =
    int(max(1, tx_per_day / divisor * season * U[0.8, 1.2])), truncating.

    The grid is generated from the store rows (each explodes the day
    sequence; no join), then spread over the tasks by (day, store). The
    product is rounded to 9 places before truncation so a last-bit
    difference in ``sin`` cannot change a count.
    """
    spark = stores.sparkSession
    # the day x store grid is small before the explodes: spread it over all cores
    n = num_partitions or spark.sparkContext.defaultParallelism
    grid = stores.select("store_id", F.explode(date_sequence(F.lit(start).cast("date"),
                                                              F.lit(end).cast("date"))).alias("day"))
    grid = grid.repartition(n, "day", "store_id")
    vol = (F.lit(float(tx_per_day)) / F.lit(float(divisor)) * season_factor("day", SEASON_AMPLITUDE)
           * (F.lit(TX_LOW) + uniform("day", "store_id", salt="tx") * F.lit(TX_WIDTH)))
    return grid.select("day", "store_id", F.round(F.greatest(F.lit(1.0), vol), 9).cast("int").alias("tx"))


def explode_transactions(grid: DataFrame) -> DataFrame:
    """One row per transaction: local order number 1..tx.

    Each day and store is first cut into blocks of orders, which are spread
    over the tasks: a day-store with many orders is no single task's work.
    """
    blocks = grid.select("day", "store_id", "tx", F.explode(F.sequence(
        F.lit(0), F.floor((F.col("tx") - 1) / F.lit(ORDER_BLOCK)).cast("int"))).alias("block"))
    blocks = blocks.repartition(TASKS_PER_CORE * grid.sparkSession.sparkContext.defaultParallelism, "day", "store_id", "block")
    first = F.col("block") * F.lit(ORDER_BLOCK) + 1
    last = F.least(F.col("tx"), first + F.lit(ORDER_BLOCK - 1))
    return blocks.select("day", "store_id", F.explode(F.sequence(first, last)).alias("local_order"))


def basket_size(tx: DataFrame) -> DataFrame:
    """Items per transaction: ceil(min(6, 1 + 3 U1 + 2 U2)), two independent draws."""
    keys = ("day", "store_id", "local_order")
    size = F.ceil(F.least(F.lit(float(BASKET_MAX)),
                          F.lit(1.0) + F.lit(3.0) * uniform(*keys, salt="basket1")
                          + F.lit(2.0) * uniform(*keys, salt="basket2"))).cast("int")
    return tx.withColumn("n_items", size)


def explode_items(tx: DataFrame) -> DataFrame:
    """One row per basket item (item_no 1..n_items) with a popularity draw u
    in [0, 1) at 1e-6 resolution, keyed by (day, store, order, item)."""
    items = tx.select("day", "store_id", "local_order",
                      F.posexplode(F.sequence(F.lit(1), F.col("n_items"))).alias("pos", "item_no"))
    u = F.floor(uniform("day", "store_id", "local_order", "item_no", salt="item") * F.lit(U_RESOLUTION)) \
        / F.lit(float(U_RESOLUTION))
    return items.withColumn("u", u).drop("pos")


def pick_products(items: DataFrame, products: DataFrame, factor: float = PICK_FACTOR) -> DataFrame:
    """Each item draw matches every product with ``u < weight * factor``.

    Not weighted sampling: with weights falling in rank, a draw yields the
    rank prefix 1..r(u) (no product for u >= factor * w1, all of them near
    u = 0). Weights may have any form (see ``threshold_join``); products
    without one, and an empty product table, match nothing.
    """
    return threshold_join(items, "u", products.select("rank", "product_id", "list_price", "weight"), "weight", factor)


def item_labels(items: DataFrame) -> DataFrame:
    """``order_id`` (``yyyyMMdd-store-000123``) and ``item_key``, the joined keys of the item's draws, once per
    item: its lines, which are many more, share both."""
    local = F.col("local_order").cast("string")
    return items.withColumns({
        "order_id": F.concat(F.date_format("day", "yyyyMMdd"), F.lit("-"), F.col("store_id"), F.lit("-"),
                             F.when(F.length(local) > 6, local).otherwise(F.lpad(local, 6, "0"))),
        "item_key": F.concat_ws("|", *[F.col(c).cast("string") for c in ("day", "store_id", "local_order", "item_no")])}) \
        .drop("local_order", "item_no")


def price_lines(lines: DataFrame) -> DataFrame:
    """Quantity 1 + [U < .35] + [U < .10]; discount rate U[.05, .20] on 12 %
    of the lines, else 0 (decimal(5,4)). Each draw has its own salt and is keyed by item and product."""
    keys = ("item_key", "product_id")
    qty = (F.lit(1) + uniform_below(*keys, salt="qty2", p=QTY_P2).cast("int")
           + uniform_below(*keys, salt="qty3", p=QTY_P3).cast("int")).cast("int")
    rate = F.when(uniform_below(*keys, salt="disc", p=DISC_P),
                  (F.lit(DISC_LOW) + uniform(*keys, salt="rate") * F.lit(DISC_WIDTH)).cast(RATE)) \
            .otherwise(F.lit(0).cast(RATE))
    return lines.withColumns({"qty": qty, "rate": rate})


def finish_sales(lines: DataFrame, as_of=None) -> DataFrame:
    """Bronze sales columns: net and discount money each rounded half-up to cents (most lines have no discount to round)."""
    amount = F.col("list_price") * F.col("qty")
    plain = (F.col("rate") == 0) & amount.isNotNull()
    return lines.select(
        F.col("day").alias("sale_date"), "order_id", "store_id", "product_id", "qty",
        F.when(plain, amount.cast(MONEY)).otherwise(F.round(amount * (F.lit(1) - F.col("rate")), 2).cast(MONEY)).alias("net"),
        F.when(plain, F.lit(0).cast(MONEY)).otherwise(F.round(amount * F.col("rate"), 2).cast(MONEY)).alias("discount"),
        load_ts(as_of).alias("bronze_ts"),
    )


def synthetic_sales(products: DataFrame, stores: DataFrame, start, end, tx_per_day: float = TX_PER_DAY,
                    divisor: float = TX_DIVISOR, as_of=None, num_partitions: int | None = None) -> DataFrame:
    """The whole chain: Bronze sales lines for every day and store."""
    grid = transaction_grid(stores, start, end, tx_per_day, divisor, num_partitions)
    items = item_labels(explode_items(basket_size(explode_transactions(grid))))
    lines = price_lines(pick_products(items, products))
    return finish_sales(lines, as_of)
