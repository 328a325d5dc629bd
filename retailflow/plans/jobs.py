"""End-to-end jobs: Bronze -> Silver -> Gold -> keys, writing catalog tables.

Job order (each step reads the tables the previous one wrote, so a step can
be rerun alone): layers -> Bronze products, stores -> stock, sales -> 4 Silver
tables -> 3 dimensions + 2 facts -> key declarations and key report.

Every write is a committed table, which also cuts the lineage between steps:
a lost executor only recomputes work inside the current step.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import bounded_values
from ..sources import catalog as cat
from ..sources import fixtures as fx
from ..sources import synth
from ..functions import columns as C
from . import docs, gold, quality, silver

# --- table names (one constant per table, used by every step) -----------------
LAYERS = {"bronze": "retail_bronze", "silver": "retail_silver", "gold": "retail_gold"}
BRONZE = {"products": "products", "stores": "stores", "stock": "stock", "sales": "sales"}
SILVER = {"products": "products", "stores": "stores", "stock": "stock", "sales": "sales"}
GOLD = {"dim_stores": "dim_stores", "dim_products": "dim_products", "dim_calendar": "dim_calendar",
        "fact_daily_sales": "fact_daily_sales", "fact_daily_stock": "fact_daily_stock"}
# Silver inputs of each fact, all counted by the load (the dimensions hold for both)
FACT_INPUTS = {"sales": ("sales", "products", "stores", "stock"), "stock": ("stock", "products", "stores")}
# -----------------------------------------------------------------------------


@dataclass
class RunResult:
    rows: dict[str, int] = field(default_factory=dict)
    key_report: DataFrame | None = None


def _name(layers: dict, layer: str, table: str) -> str:
    return cat.qualified(layers[layer], table)


# rows per file of every load: bounds the files however large a task's share is
FILE_ROWS = 5_000_000


def load_synthetic_bronze(spark: SparkSession, start, end, layers=LAYERS, mode: str = "overwrite",
                          n_products: int = synth.N_PRODUCTS, n_stores: int = synth.N_STORES,
                          tx_per_day: float = synth.TX_PER_DAY, as_of=None) -> dict[str, int]:
    """Bronze from the generators: products, stores, stock of the top ranks, and sales from ``start`` to ``end``.

    Sales and stock read the written products and stores, so the tables agree
    with each other whatever the generators' parameters are.
    """
    rows = {}

    def put(key: str, df: DataFrame) -> DataFrame:
        name = _name(layers, "bronze", BRONZE[key])
        rows[f"bronze.{key}"] = cat.create_or_replace(df, name, max_records_per_file=FILE_ROWS) if mode == "overwrite" \
            else cat.save(df, name, mode=mode, max_records_per_file=FILE_ROWS)
        return spark.table(name)

    products = put("products", synth.zipf_products(spark, n_products))
    stores = put("stores", synth.synthetic_stores(spark, n_stores))
    top = bounded_values(products.where(F.col("rank") <= fx.STOCK_TOP_RANK).select("product_id"),
                         "product_id", fx.STOCK_TOP_RANK)
    put("stock", fx.bronze_stock(top, stores, start, end))
    put("sales", synth.synthetic_sales(products, stores, start, end, tx_per_day=tx_per_day, as_of=as_of))
    return rows


def load_bronze_tables(spark: SparkSession, sf_dir: str, layers=LAYERS, mode: str = "overwrite",
                       as_of=None) -> dict[str, int]:
    """Bronze from the driver tables (see ``sources.fixtures``)."""
    b = fx.load_bronze(spark, sf_dir, as_of=as_of)
    rows = {}
    for key, df in (("products", b.products), ("stores", b.stores), ("stock", b.stock), ("sales", b.sales)):
        rows[f"bronze.{key}"] = cat.save(df, _name(layers, "bronze", BRONZE[key]), mode=mode,
                                           max_records_per_file=FILE_ROWS)
    return rows


def load_silver_tables(spark: SparkSession, layers=LAYERS, mode: str = "overwrite", as_of=None,
                       price_cuts=fx.FIXTURE_PRICE_CUTS, core_cities=fx.FIXTURE_CORE_CITIES,
                       capital=fx.FIXTURE_CAPITAL) -> dict[str, int]:
    read = lambda t: cat.read_columns(spark, _name(layers, "bronze", BRONZE[t]))
    frames = {
        "products": silver.silver_products(read("products"), price_cuts=price_cuts, as_of=as_of),
        "stores": silver.silver_stores(read("stores"), core_cities=core_cities, capital=capital, as_of=as_of),
        "stock": silver.silver_stock(read("stock"), as_of=as_of),
        "sales": silver.silver_sales(read("sales"), as_of=as_of),
    }
    rows = {}
    for key, df in frames.items():
        rows[f"silver.{key}"] = cat.save(
            df, _name(layers, "silver", SILVER[key]), mode=mode, max_records_per_file=FILE_ROWS,
            column_comments=docs.comments_for(key, df.columns), table_comment=docs.TABLES[key])
    return rows


def load_gold_tables(spark: SparkSession, layers=LAYERS, mode: str = "overwrite", as_of=None,
                     calendar_range: tuple | None = None, locale: str = "en",
                     replace_partitions: bool = False) -> dict[str, int]:
    read = lambda t: cat.read_columns(spark, _name(layers, "silver", SILVER[t]))
    sales, stock = read("sales"), read("stock")
    start, end = calendar_range or fx.calendar_range(sales)
    # input row audit of the sales fact, counted while it is written (no extra
    # pass). The inputs sit below the fact's aggregation shuffle, so the range
    # layout's sampling pass does not run them again. The stock fact is a 1:1
    # projection: its input count is its output count.
    audits = {k: Observation(f"input_{k}") for k in ("sales_for_sales", "stock_for_sales")}
    count = F.count(F.lit(1)).alias("rows")
    sales_in = sales.observe(audits["sales_for_sales"], count)
    stock_in = stock.observe(audits["stock_for_sales"], count)
    dims_mode = "overwrite"  # a dimension appended twice would break its key
    rows = {}
    plan = [
        ("dim_stores", gold.dim_stores(read("stores"), as_of=as_of), dims_mode, None, "stores"),
        ("dim_products", gold.dim_products(read("products"), as_of=as_of), dims_mode, None, "products"),
        ("dim_calendar", gold.dim_calendar(spark, start, end, locale=locale, as_of=as_of), dims_mode, None,
         "calendar"),
        ("fact_daily_stock", gold.fact_daily_stock(stock, as_of=as_of), mode, ["stock_date"],
         "fact_stock"),
        ("fact_daily_sales", gold.fact_daily_sales(sales_in, stock_in, as_of=as_of), mode, ["sale_date"],
         "fact_sales"),
    ]
    for key, df, m, part, kind in plan:
        spread = ["store_id", "product_id"] if part else None
        rows[f"gold.{key}"] = cat.save(
            df, _name(layers, "gold", GOLD[key]), mode=m, partition_by=part, spread_key=spread,
            replace_partitions=replace_partitions, max_records_per_file=FILE_ROWS,
            column_comments=docs.comments_for(kind, df.columns), table_comment=docs.TABLES[kind])
    for k, obs in audits.items():
        rows[f"gold.input.{k}"] = int(obs.get.get("rows", 0))
    # the other inputs of the facts are written tables: their counts are in the file footers
    for fact, inputs in FACT_INPUTS.items():
        for t in inputs:
            if f"gold.input.{t}_for_{fact}" not in rows:
                rows[f"gold.input.{t}_for_{fact}"] = read(t).count()
    return rows


def apply_gold_keys(spark: SparkSession, layers=LAYERS) -> DataFrame:
    """Declare the star schema's keys and report the data against them.

    Primary keys are declared only when the report finds neither a NULL nor a
    duplicate key; foreign keys are declared regardless of their primary key, as
    informational constraints. The returned report (rule, table_name,
    key_columns, violations, status, declared) also counts duplicate keys
    and orphan rows, which a declaration alone never checks.
    """
    star = {k: spark.table(_name(layers, "gold", t)) for k, t in GOLD.items()}
    report = quality.gold_key_report(star)
    found = {r["rule"]: r for r in report.collect()}  # a row per rule
    declared = {}
    for rule, table, cols in quality.GOLD_PRIMARY_KEYS:
        name = _name(layers, "gold", GOLD[table])
        ok = found[rule]["violations"] == 0 and all(cat.set_not_null(spark, name, c) for c in cols)
        declared[rule] = cat.declare_key(spark, name, rule, cols) if ok else "skipped"
    for rule, table, cols, ref_table, ref_cols in quality.GOLD_FOREIGN_KEYS:
        name = _name(layers, "gold", GOLD[table])
        declared[rule] = cat.declare_key(spark, name, rule, cols, _name(layers, "gold", GOLD[ref_table]),
                                         ref_cols)
    rows = [(*found[rule], state) for rule, state in declared.items()]
    return spark.createDataFrame(rows, "rule string, table_name string, key_columns string, violations bigint, "
                                       "status string, declared string")


def run_pipeline(spark: SparkSession, sf_dir: str, layers=LAYERS, mode: str = "overwrite",
                 as_of=None, locale: str = "en") -> RunResult:
    """The whole pipeline, in job order."""
    cat.ensure_layers(spark, list(layers.values()))
    res = RunResult()
    res.rows.update(load_bronze_tables(spark, sf_dir, layers, mode, as_of))
    res.rows.update(load_silver_tables(spark, layers, mode, as_of))
    res.rows.update(load_gold_tables(spark, layers, mode, as_of, locale=locale))
    res.key_report = apply_gold_keys(spark, layers)
    return res


def run_synthetic_pipeline(spark: SparkSession, start, end, layers=LAYERS, as_of=None, locale: str = "en",
                           **generator) -> RunResult:
    """Generators -> Silver -> Gold -> keys, with the default cuts, cities and capital."""
    cat.ensure_layers(spark, list(layers.values()))
    res = RunResult()
    res.rows.update(load_synthetic_bronze(spark, start, end, layers, as_of=as_of, **generator))
    res.rows.update(load_silver_tables(spark, layers, as_of=as_of, price_cuts=C.PRICE_CUTS,
                                       core_cities=C.REGION_CITIES, capital=C.CAPITAL_CITY))
    res.rows.update(load_gold_tables(spark, layers, as_of=as_of, locale=locale))
    res.key_report = apply_gold_keys(spark, layers)
    return res
