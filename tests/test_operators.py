"""Operators against brute-force forms on small inputs, including a hot key."""

from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from retailflow.operators import aggregates as A
from retailflow.operators import joins as J
from retailflow.operators import windows as W


@pytest.fixture()
def skewed(spark):
    # one group ('hot') holds about 2/3 of the rows; values have many ties
    return (spark.range(3000)
            .withColumn("g", F.when(F.col("id") % 3 == 0, F.lit("cold")).otherwise(F.lit("hot")))
            .withColumn("v", (F.col("id") * 7919 % 97).cast("int")))


def test_row_number_global_matches_window(spark, skewed):
    got = W.row_number_by(skewed, [F.col("v").desc(), F.col("id").asc()], out="rn", num_partitions=7)
    ref = skewed.withColumn("rn", F.row_number().over(Window.orderBy(F.col("v").desc(), F.col("id"))))
    assert sorted(map(tuple, got.select("id", "rn").collect())) == sorted(map(tuple, ref.select("id", "rn").collect()))


def test_row_number_within_groups_matches_window(spark, skewed):
    got = W.rank_within(skewed, ["g"], [F.col("v").desc(), F.col("id").asc()], out="rn", num_partitions=5)
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), F.col("id"))
    ref = skewed.withColumn("rn", F.row_number().over(w))
    assert got.count() == skewed.count()
    assert sorted(map(tuple, got.select("id", "rn").collect())) == sorted(map(tuple, ref.select("id", "rn").collect()))


def test_row_number_hot_group_spans_several_tasks(spark, skewed):
    # the hot group must be numbered by more than one task
    n = 6
    keys = [F.col("g"), F.col("v").desc(), F.col("id")]
    pids = (skewed.repartitionByRange(n, *keys).withColumn("pid", F.spark_partition_id())
            .where("g = 'hot'").select("pid").distinct().count())
    assert pids > 1


def window_first(df, keys, order):
    """Reference form of a deterministic dedup: row_number() == 1 per key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def test_dedup_deterministic_survivor_matches_window(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "x"), (2, 5, "w")],
                               "k int, o int, s string")
    got = A.dedup(df, ["k"], ["o", "s"])
    ref = window_first(df, ["k"], ["o", "s"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect())) == [(1, 1, "a"), (2, 5, "w")]
    assert got.columns == df.columns
    assert A.dedup(df, ["k"]).count() == 2


def test_enrich_unmatched_and_fan_out(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, x int")
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b2")], "k int, name string")
    out = J.enrich(fact, dim, "k")
    assert out.columns == ["k", "x", "name"]
    assert out.count() == 4  # duplicate dimension key multiplies the fact row
    assert out.where("k = 3").first().name is None
    assert J.enrich(fact, A.dedup(dim, ["k"], ["name"]), "k").count() == 3


def test_enrich_snapshot_three_keys(spark):
    fact = spark.createDataFrame([("2025-01-01", "1", 7, 2), ("2025-01-01", "2", 7, 1)],
                                 "d string, s string, p int, q int")
    snap = spark.createDataFrame([("2025-01-01", "1", 7, 105)], "sd string, s string, p int, qty int")
    out = J.enrich_snapshot(fact, snap, [("d", "sd"), ("s", "s"), ("p", "p")], ["qty"])
    assert out.columns == ["d", "s", "p", "q", "qty"]
    assert sorted((r.s, r.qty) for r in out.collect()) == [("1", 105), ("2", None)]


def test_bounded_values_raises_over_bound(spark):
    with pytest.raises(ValueError):
        J.bounded_values(spark.range(10), "id", 5)
    assert J.bounded_values(spark.range(3), "id", 5) == [0, 1, 2]


def test_threshold_join_equals_theta_join(spark):
    n, s = 50, 1.1
    prods = spark.range(1, n + 1).select(F.col("id").cast("int").alias("rank"))
    norm = sum((1.0 / r) ** s for r in range(1, n + 1))
    prods = prods.withColumn("weight", F.pow(F.lit(1.0) / F.col("rank"), F.lit(s)) / F.lit(norm))
    items = (spark.range(4000).withColumn("u", F.floor(F.rand(7) * 1e6) / 1e6)
             .union(spark.createDataFrame([(100000, 0.0), (100001, 0.999999)], "id long, u double")))
    got = J.threshold_join(items, "u", prods, "weight", 3.0)
    ref = items.join(prods, F.col("u") < F.col("weight") * F.lit(3.0))
    a = sorted((r.id, r.rank) for r in got.select("id", "rank").collect())
    b = sorted((r.id, r.rank) for r in ref.select("id", "rank").collect())
    assert a == b and len(a) > 0
    assert sum(1 for i, _ in a if i == 100000) == n   # u = 0 matches every product


def test_abc_curve_matches_brute_force(spark):
    vals = [(i, Decimal(v)) for i, v in enumerate([50, 30, 30, 10, 5, 3, 1, 1, 0, 70])]
    df = spark.createDataFrame(vals, "item int, value decimal(10,0)")
    got = {r.item: (r.abc_class, float(r.cum_value)) for r in W.abc_curve(df, "item", "value", num_partitions=3).collect()}
    order = sorted(vals, key=lambda t: (-t[1], t[0]))
    total = sum(v for _, v in vals)
    run = Decimal(0)
    for item, v in order:
        prior = run
        run += v
        cls = "A" if prior < total * Decimal("0.80") else ("B" if prior < total * Decimal("0.95") else "C")
        assert got[item] == (cls, float(run)), item


def test_union_counts_report(spark):
    out = A.union_counts({"a": spark.range(3), "b": spark.range(0), "c": spark.range(5)})
    assert sorted(map(tuple, out.collect())) == [("a", 3), ("b", 0), ("c", 5)]


def test_sales_measures_edge_cases(spark):
    lines = spark.createDataFrame(
        [("d1", 1, 2, Decimal("10.00"), Decimal("9.00"), Decimal("1.00"), 100),
         ("d1", 1, 1, Decimal("5.00"), Decimal("5.00"), Decimal("0.00"), None),
         ("d1", 2, 1, Decimal("0.01"), Decimal("0.01"), Decimal("0.00"), 110),
         ("d2", 3, 0, Decimal("0.00"), Decimal("0.00"), Decimal("0.00"), None)],
        "g string, order_id int, qty int, gross decimal(19,2), net decimal(18,2), discount decimal(18,2), stock_qty int")
    out = {r.g: r for r in A.sales_measures(lines, ["g"]).collect()}
    d1, d2 = out["d1"], out["d2"]
    assert (d1.qty_sold, d1.orders) == (4, 2)
    assert d1.gross_total == Decimal("15.01") and d1.net_total == Decimal("14.01")
    assert d1.discount_pct == Decimal("0.0666")           # 1.00 / 15.01 = 0.06662...
    assert d1.unit_value == Decimal("3.75")               # 15.01 / 4 = 3.7525
    assert d1.avg_ticket == Decimal("7.01")               # 14.01 / 2 = 7.005 -> half up
    assert d1.stock_avg == 105.0 and d1.stock_final == 110
    assert d2.discount_pct == Decimal("0.0000") and d2.unit_value is None and d2.stock_avg is None
    types = dict(A.sales_measures(lines, ["g"]).dtypes)
    assert types["gross_total"] == "decimal(30,2)" and types["net_total"] == "decimal(29,2)"
    assert types["discount_pct"] == "decimal(33,4)" and types["unit_value"] == "decimal(30,2)"
    assert types["qty_sold"] == "bigint" and types["orders"] == "bigint" and types["stock_avg"] == "double"


def test_row_number_keeps_null_group(spark):
    df = spark.createDataFrame([(1, None, 5), (2, None, 7), (3, "a", 1)], "id int, g string, v int")
    got = {r.id: r.rn for r in W.rank_within(df, ["g"], [F.col("v").desc(), F.col("id")], "rn").collect()}
    assert got == {2: 1, 1: 2, 3: 1}
