"""Silver jobs: enrich each Bronze table; fixed output column order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.windows import rank_within
from ..sources.fixtures import load_ts

SILVER_PRODUCTS = ["product_id", "sku", "product_name", "category", "brand", "list_price",
                   "price_band", "rank", "price_rank_in_category", "popularity", "is_star",
                   "weight", "est_cost", "margin", "margin_pct", "silver_ts"]
SILVER_STORES = ["store_id", "store_id_int", "store_name", "city", "region", "state",
                 "is_capital", "silver_ts"]
SILVER_STOCK = ["stock_date", "store_id", "product_id", "stock_qty", "stock_band", "silver_ts"]
SILVER_SALES = ["sale_date", "order_id", "store_id", "product_id", "qty", "gross", "net",
                "discount", "discount_pct", "unit_value", "bronze_ts", "silver_ts"]


def silver_products(bronze: DataFrame, price_cuts: Sequence = C.PRICE_CUTS, as_of=None) -> DataFrame:
    """Products with price band, popularity tier, star flag, cost, margins and
    the price rank inside the category (1 = dearest; ties by product id)."""
    df = bronze.select("product_id", "sku", "name", "category", "brand", "list_price", "rank", "weight")
    df = df.withColumns({
        "product_name": F.col("name"),
        "price_band": C.bucketize("list_price", price_cuts, C.BAND_LABELS),
        "popularity": C.tier_by_rank("rank"),
        "is_star": C.flag(F.col("rank") <= C.STAR_RANK),
        **C.cost_and_margin("list_price"),
    })
    df = rank_within(df, ["category"], [F.col("list_price").desc(), F.col("product_id").asc()],
                     out="price_rank_in_category")
    return df.withColumn("silver_ts", load_ts(as_of)).select(*SILVER_PRODUCTS)


def silver_stores(bronze: DataFrame, core_cities: Sequence[str] = C.REGION_CITIES,
                  capital: str = C.CAPITAL_CITY, as_of=None) -> DataFrame:
    """Stores with a numeric id (NULL when not a number), region label and
    capital flag."""
    df = bronze.select("store_id", "name", "city", "state")
    df = df.withColumns({
        "store_name": F.col("name"),
        "store_id_int": C.cast_col("store_id", "int", safe=True),
        "region": C.member_label("city", core_cities, C.REGION_IN_LABEL, C.REGION_OUT_LABEL),
        "is_capital": C.flag(F.col("city") == F.lit(capital)),
        "silver_ts": load_ts(as_of),
    })
    return df.select(*SILVER_STORES)


def silver_stock(bronze: DataFrame, stock_cuts: Sequence = C.STOCK_CUTS, as_of=None) -> DataFrame:
    """Stock snapshots with a stock band."""
    df = bronze.select(F.col("day").alias("stock_date"), "store_id", "product_id", "stock_qty")
    df = df.withColumns({
        "stock_band": C.bucketize("stock_qty", stock_cuts, C.BAND_LABELS),
        "silver_ts": load_ts(as_of),
    })
    return df.select(*SILVER_STOCK)


def silver_sales(bronze: DataFrame, as_of=None) -> DataFrame:
    """Sales lines with gross revenue, discount share and unit value."""
    df = bronze.select("sale_date", "order_id", "store_id", "product_id", "qty", "net",
                       "discount", "bronze_ts")
    df = df.withColumn("gross", C.add_gross("net", "discount"))
    df = df.withColumns({
        "discount_pct": C.safe_ratio("discount", "gross", 4, default=0.0),
        "unit_value": C.safe_ratio("gross", "qty", 2, default=None),
        "silver_ts": load_ts(as_of),
    })
    return df.select(*SILVER_SALES)
