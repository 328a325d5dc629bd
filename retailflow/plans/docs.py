"""Catalog comments, one per output column, written from what our operators guarantee.

Each text states the type, the NULL rule and the rounding that the column has
in this library, so a reader of the catalog need not read the code.
"""

from __future__ import annotations

#: Columns that mean the same in every table.
_EVERYWHERE = {
    "product_id": "Join key to products; same type as in the loaded source; never changed by a job.",
    "store_id": "Join key to stores, always text.",
    "bronze_ts": "Timestamp of the load that wrote the source row.",
    "silver_ts": "Timestamp of the Silver load; newest wins when a key is loaded twice.",
    "gold_ts": "Timestamp of the Gold load.",
}

_PRODUCT = {
    "sku": "Text code: fixed prefix and the zero-padded product number.",
    "product_name": "Text, copied.",
    "category": "Text, copied; groups the ranking of prices.",
    "brand": "Text, copied.",
    "list_price": "decimal(18,2), cast before any arithmetic.",
    "price_band": "Label by strict upper bounds on list_price; NULL prices get the last label.",
    "rank": "1-based position by popularity, a total order without gaps; int.",
    "price_rank_in_category": "1-based position by list_price from the dearest, ties by product_id; int.",
    "popularity": "Label by inclusive upper bounds on rank.",
    "is_star": "Whether rank is within the first tier's bound.",
    "weight": "Double; rank to a negative power over the sum of all products' powers.",
    "est_cost": "Double, 2 places half-up: a fixed rate of list_price.",
    "margin": "Double, 2 places half-up: list_price less est_cost.",
    "margin_pct": "Double, 4 places half-up: margin over list_price; 0.0 unless list_price > 0.",
}

_STORE = {
    "store_id_int": "store_id as int, or NULL if it does not parse.",
    "store_name": "Text, copied.",
    "city": "Text, copied.",
    "region": "One label for the listed cities, another for all others and for NULL.",
    "state": "Text, copied.",
    "is_capital": "city equals the configured capital; NULL for a NULL city.",
}

_STOCK = {
    "stock_date": "Date of the snapshot.",
    "stock_qty": "Int, copied from the snapshot.",
    "stock_band": "Label by strict upper bounds on stock_qty; NULL gets the last label.",
}

_SALE = {
    "sale_date": "Date of the sale.",
    "order_id": "Groups the lines of one order; counted distinct, never summed.",
    "qty": "Int, copied.",
    "gross": "decimal(19,2): net plus discount, each already in cents.",
    "net": "decimal(18,2), rounded half-up once at the source.",
    "discount": "decimal(18,2), rounded half-up once at the source.",
    "discount_pct": "Double, 4 places half-up: discount over gross; 0.0 unless gross > 0.",
    "unit_value": "Decimal, 2 places half-up: gross over qty; NULL unless qty > 0.",
}

_CALENDAR = {
    "day": "Date; one row each, no gaps between the first and last.",
    "year": "Int from day.",
    "month": "Int from day, counted from 1.",
    "day_of_month": "Int from day, counted from 1.",
    "quarter": "Int from day, counted from 1.",
    "year_month": "Text key for monthly grouping; sorts in time order.",
    "month_name": "Text in the locale of the load.",
    "weekday_num": "Int as Spark's dayofweek gives it.",
    "weekday_name": "Text in the locale of the load.",
    "is_weekend": "weekday_num is in the weekend list; never NULL.",
}

_FACT_SALES = {
    "sale_date": "Grain; must exist in dim_calendar (foreign key, reported by the key check).",
    "qty_sold": "Bigint sum of qty.",
    "orders": "Bigint count of distinct order_id; cannot be added over rows.",
    "gross_total": "Exact decimal sum of gross.",
    "net_total": "Exact decimal sum of net.",
    "discount_total": "Exact decimal sum of discount.",
    "discount_pct": "Ratio of the two sums, 4 places half-up; 0.0 unless the gross sum > 0.",
    "unit_value": "Gross sum over qty_sold, 2 places half-up; NULL unless qty_sold > 0.",
    "avg_ticket": "net_total over orders, 2 places half-up; 0.0 without orders; recompute for other grains.",
    "stock_avg": "Line-weighted mean of the matched snapshots, 2 places; NULL if none matched.",
    "stock_final": "Greatest matched snapshot quantity; NULL if none matched.",
}

COLUMNS: dict[str, dict[str, str]] = {
    "products": _PRODUCT,
    "stores": _STORE,
    "stock": _STOCK,
    "sales": _SALE,
    "calendar": _CALENDAR,
    "fact_sales": _FACT_SALES,
    "fact_stock": _STOCK,
}

TABLES = {
    "products": "Silver and dimension grain: a row per product_id.",
    "stores": "Silver and dimension grain: a row per store_id.",
    "stock": "Grain: stock_date, store_id, product_id; only the most popular products.",
    "sales": "Grain: order line as loaded; appending a load twice doubles it.",
    "calendar": "Grain: day, whole years around the sales.",
    "fact_sales": "Grain: sale_date, store_id, product_id; partitioned by sale_date.",
    "fact_stock": "Grain: stock_date, store_id, product_id; partitioned by stock_date.",
}


def comments_for(kind: str, columns) -> dict[str, str]:
    """Texts for the given columns of a table kind; columns without one are left out."""
    known = _EVERYWHERE | COLUMNS.get(kind, {})
    return {c: known[c] for c in columns if c in known}
