"""Physical-plan shape of the main jobs (what would matter at scale)."""

import contextlib
import io
import re

from decimal import Decimal

from pyspark.sql import functions as F

from retailflow.operators import aggregates as A
from retailflow.operators import windows as W
from retailflow.plans import gold
from retailflow.plans.queries import Retail

SMOKE = "/root/testdata/sf0.001"


def plan(df, mode=None) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode) if mode else df.explain()
    return buf.getvalue()


def test_scan_reads_only_needed_columns(spark):
    p = plan(Retail(spark, SMOKE).sales, "formatted")
    schema = re.search(r"lineitem\.parquet\]\s*ReadSchema: struct<([^>]*)>", p, re.S).group(1)
    assert "l_tax" not in schema and "l_returnflag" not in schema and "l_linestatus" not in schema
    assert "l_extendedprice" in schema


def test_stock_snapshot_join_is_sort_merge_without_broadcast(spark):
    r = Retail(spark, SMOKE)
    p = plan(gold.fact_daily_sales(r.sales, r.stock))
    assert "SortMergeJoin" in p
    smj = p[p.index("SortMergeJoin"):]
    # the fact side of the join is the group-by output: no exchange between them
    fact_side = smj.split("HashAggregate", 1)[0]
    assert "Exchange" not in fact_side
    # the generated snapshot is never broadcast (its size estimate is too low to trust)
    assert "BroadcastExchange" not in p.split("SortMergeJoin", 1)[1].split("+- Sort", 2)[-1]


def test_fact_aggregates_are_partial_before_shuffle(spark):
    r = Retail(spark, SMOKE)
    p = plan(gold.fact_daily_sales(r.sales, None))
    assert p.count("partial_sum") >= 1 and "partial_count(distinct" in p


def test_price_ties_in_a_category_get_distinct_ranks(spark):
    df = spark.createDataFrame([(1, "A", Decimal("5.00")), (2, "A", Decimal("5.00")), (3, "A", Decimal("9.00")),
                                (4, "B", Decimal("5.00"))], "product_id int, category string, list_price decimal(18,2)")
    out = W.rank_within(df, ["category"], [F.col("list_price").desc(), F.col("product_id").asc()], "r")
    got = {x.product_id: x.r for x in out.collect()}
    assert got == {3: 1, 1: 2, 2: 3, 4: 1}


def test_same_product_twice_in_one_order_counts_one_order(spark):
    lines = spark.createDataFrame(
        [("d", 1, 1, Decimal("2.00"), Decimal("2.00"), Decimal("0.00")),
         ("d", 1, 2, Decimal("4.00"), Decimal("4.00"), Decimal("0.00"))],
        "g string, order_id int, qty int, gross decimal(19,2), net decimal(18,2), discount decimal(18,2)")
    r = A.sales_measures(lines, ["g"], stock=None).first()
    assert (r.qty_sold, r.orders, r.avg_ticket) == (3, 1, Decimal("6.00"))


def test_auto_stock_join_modes(spark):
    r = Retail(spark, SMOKE)
    grain = ["sale_date", "store_id"]
    bounded = plan(gold.fact_daily_sales(r.sales, r.stock, grain=grain, stock_rows=r.stock_rows))
    assert "BroadcastHashJoin [sale_date" in bounded and "SortMergeJoin" not in bounded
    unbounded = plan(gold.fact_daily_sales(r.sales, r.stock, grain=grain)).splitlines()
    at = next(i for i, line in enumerate(unbounded) if "SortMergeJoin" in line and "LeftOuter" in line)
    # the sales side of the snapshot join is the (day, store, product) group-by, not raw lines
    assert "Sort [" in unbounded[at + 1]
    assert "HashAggregate(keys=[sale_date" in unbounded[at + 2] and "partial_" not in unbounded[at + 2]


def test_spread_only_touches_under_split_inputs(spark):
    from retailflow.sources.tables import spread
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(0, 1000, numPartitions=cores * 2)
    assert spread(many, "id") is many                       # enough splits: unchanged, no shuffle
    few = spark.range(0, 1000, numPartitions=1)
    spread_few = spread(few, ["id"])
    assert spread_few.rdd.getNumPartitions() == cores
    assert sorted(r.id for r in spread_few.collect()) == list(range(1000))
