"""Loads that must not lose data, empty inputs, determinism, and the generator pipeline."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retailflow.operators import aggregates as A
from retailflow.operators import joins as J
from retailflow.operators import windows as W
from retailflow.plans import gold, jobs, quality
from retailflow.sources import catalog as cat
from retailflow.sources import synth as S
from retailflow.sources.tables import read_table


def test_reads_after_an_append_see_the_new_rows(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    spark.range(5).write.parquet(path)
    assert read_table(spark, str(tmp_path), "t").count() == 5
    spark.range(5).write.mode("append").parquet(path)
    assert read_table(spark, str(tmp_path), "t").count() == 10


def _days(spark, n, day, **extra):
    df = spark.range(n).select(F.col("id").alias("k"), F.lit(day).cast("date").alias("d"))
    return df.withColumns({c: F.lit(v) for c, v in extra.items()})


@pytest.mark.parametrize("how", ["append", "partitions"])
def test_new_columns_are_refused_or_kept(spark, db, how):
    name = f"{db}.s"
    load = {"partition_by": ["d"], "mode": "append"} if how == "append" else {"partition_by": ["d"], "replace_partitions": True}
    cat.save(_days(spark, 3, "2025-01-01"), name, partition_by=["d"])
    more = _days(spark, 2, "2025-01-02", extra=7)
    with pytest.raises(ValueError, match="extra"):
        cat.save(more, name, **load)
    cat.save(more, name, merge_schema=True, **load)
    rows = spark.table(name).groupBy("extra").count().collect()
    assert {r.extra: r["count"] for r in rows} == {None: 3, 7: 2}
    cat.save(_days(spark, 1, "2025-01-03"), name, merge_schema=True, **load)
    assert spark.table(name).where("extra is null").count() == 4


def test_comments_cover_partition_columns(spark, db):
    name = f"{db}.c"
    texts = {"k": "it's a key", "d": "day of the load"}
    cat.save(_days(spark, 3, "2025-01-01"), name, partition_by=["d"], column_comments=texts)
    assert cat.read_column_comments(spark, name) == texts
    cat.save(_days(spark, 1, "2025-01-02"), name, partition_by=["d"], mode="append", column_comments=texts)
    assert cat.read_column_comments(spark, name) == texts


def test_failed_replace_keeps_the_table(spark, db):
    name = f"{db}.r"
    cat.create_or_replace(spark.range(4), name)
    with pytest.raises(Exception, match="boom"):
        cat.create_or_replace(spark.range(3).select(F.raise_error(F.lit("boom")).cast("int").alias("x")), name)
    assert spark.table(name).count() == 4


def test_dimensions_do_not_depend_on_the_layout(spark):
    rows = [(f"s{i % 7}", i, f"name{i}", "c", "r", "ES", True, dt.datetime(2025, 1, 1 + i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "store_id string, store_id_int int, store_name string, city string, region string, "
                                     "state string, is_capital boolean, silver_ts timestamp")
    seen = [sorted(gold.dim_stores(df.repartition(n), as_of="2025-01-01").collect()) for n in (1, 4, 16)]
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 7
    assert all(r.silver_ts == dt.datetime(2025, 1, 3) for r in seen[0])


def _theta(items, ranked, factor):
    return sorted((i.id, r.rank) for i in items.collect() for r in ranked.collect()
                  if i.u is not None and r.weight is not None and i.u < r.weight * factor)


def _products(spark, weights):
    return spark.createDataFrame([(k, k, Decimal("1.00"), w) for k, w in enumerate(weights, 1)],
                                 "rank int, product_id int, list_price decimal(18,2), weight double")


@pytest.mark.parametrize("hot,fanout", [(4, 3), (1024, 64)])
@pytest.mark.parametrize("kind", ["zipf", "unsorted", "ties", "odd"])
def test_threshold_join_for_any_weights(spark, kind, hot, fanout, monkeypatch):
    monkeypatch.setattr(J, "RANK_BLOCK", 7)
    weights = {"zipf": [k ** -1.1 / 4 for k in range(1, 61)], "unsorted": [(k * 37 % 61) / 100 for k in range(60)],
               "ties": [(k % 3) / 6 for k in range(60)], "odd": [None, 0.0, -0.5, 0.2, None, 0.2, float("inf"), 0.01, 0.0]}[kind]
    ranked = _products(spark, weights)
    items = spark.range(200).select("id", F.when(F.col("id") != 13, F.col("id") / 200 - 0.1).alias("u"))
    want = _theta(items, ranked, 3.0)
    got = J.threshold_join(items, "u", ranked, "weight", 3.0, hot_ranks=hot, fanout=fanout)
    assert got.columns == ["id", "u", *ranked.columns]
    assert sorted((r.id, r["rank"]) for r in got.collect()) == want
    if hot == 4:
        assert sorted((r.id, r["rank"]) for r in S.pick_products(items, ranked).collect()) == want


def test_threshold_join_with_large_levels_joined_by_the_planner(spark, monkeypatch):
    monkeypatch.setattr(J, "BROADCAST_MAX_BYTES", 0)
    ranked = _products(spark, [(k * 7 % 50) / 60 for k in range(50)])
    items = spark.range(90).select("id", (F.col("id") / 90).alias("u"))
    got = J.threshold_join(items, "u", ranked, "weight", 1.5, hot_ranks=2, fanout=4)
    assert sorted((r.id, r["rank"]) for r in got.collect()) == _theta(items, ranked, 1.5)


def test_threshold_join_without_products(spark):
    items = spark.range(3).select("id", F.lit(0.1).alias("u"))
    assert S.pick_products(items, _products(spark, [0.5]).where("false")).count() == 0
    assert S.pick_products(items, _products(spark, [None])).count() == 0


@pytest.mark.parametrize("slices", [1, 4, 64])
def test_abc_curve_over_slices_with_ties(spark, slices):
    rows = [(f"i{k:03d}", Decimal(k % 4).scaleb(-2)) for k in range(300)]
    df = spark.createDataFrame(rows, "item string, value decimal(18,2)")
    got = {r.item: (r.cum_value, r.abc_class) for r in W.abc_curve(df, "item", "value", num_partitions=slices).collect()}
    total, run = sum(v for _, v in rows), Decimal(0)
    for i, v in sorted(rows, key=lambda r: (-r[1], r[0])):
        want = "A" if run < total * Decimal("0.8") else "B" if run < total * Decimal("0.95") else "C"
        run += v
        assert got[i] == (run, want)


def test_abc_curve_has_no_list_from_the_driver(spark):
    df = spark.range(300).select(F.col("id").alias("item"), F.col("id").cast("decimal(18,2)").alias("value"))
    plan = W.abc_curve(df, "item", "value", num_partitions=3)._jdf.queryExecution().toString()
    assert "Window" in plan and "LocalRelation" not in plan and "LocalTableScan" not in plan
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") <= 2


@pytest.mark.parametrize("values", [[0, 0, 0], [None, None], [5, -5], [0, None]])
def test_totals_of_zero_have_no_shares(spark, values):
    rows = [(f"i{k}", None if v is None else Decimal(v)) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "item string, value decimal(18,2)")
    got = W.abc_curve(df, "item", "value").collect()
    assert len(got) == len(rows) and all(r.cum_share is None and r.abc_class == "C" for r in got)
    assert [r.share for r in W.share_of_total(df, "value", "share").collect()] == [None] * len(rows)


def test_null_values_add_nothing_to_the_curve(spark):
    df = spark.createDataFrame([("a", Decimal(8)), ("b", None), ("c", Decimal(2))], "item string, value decimal(18,2)")
    got = {r.item: (float(r.cum_value), r.cum_share, r.abc_class) for r in W.abc_curve(df, "item", "value", num_partitions=2).collect()}
    assert got == {"a": (8.0, 0.8, "A"), "c": (10.0, 1.0, "B"), "b": (10.0, 1.0, "C")}


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "item string, value decimal(18,2)")
    assert W.abc_curve(none, "item", "value").collect() == []
    assert W.share_of_total(none, "value", "share").collect() == []
    violations = quality.key_violations(none, ["item"]).first()
    assert (violations.null_rows, violations.dup_rows) == (0, 0)


def test_key_checks_in_one_pass(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (9, "z"), (None, "z")], "x int, y string")
    left = spark.createDataFrame([(1,), (2,)], "id int")
    right = spark.createDataFrame([("a",), ("b",)], "id string")
    out = quality.orphan_counts(child, [("x", ["x"], left, ["id"]), ("y", ["y"], right, ["id"])])
    assert {r.rule: r.violations for r in out.collect()} == {"x": 1, "y": 2}
    row = quality.key_violations(child, ["x"]).first()
    assert (row.null_rows, row.dup_rows) == (1, 1)


def test_coarse_stock_join_modes_agree(spark):
    day = dt.date(2025, 1, 1)
    big = Decimal("40499431052480.09")
    sales = spark.createDataFrame(
        [(day, i % 3, "s", i % 2, 1, big + i, big + i, Decimal("0.00")) for i in range(9)],
        "sale_date date, order_id int, store_id string, product_id int, qty int, gross decimal(19,2), net decimal(18,2), "
        "discount decimal(18,2)")
    stock = spark.createDataFrame([(day, "s", 0, 105), (day, "s", 0, 105)], "stock_date date, store_id string, product_id int, stock_qty int")
    out = [gold.fact_daily_sales(sales, stock, grain=["sale_date", "store_id"], stock_join=m, as_of="2025-01-01").collect()
           for m in ("line", "preagg")]
    assert out[0] == out[1] and out[0][0].net_total == sum((big + i for i in range(9)), Decimal(0))


def test_generator_pipeline_end_to_end(spark):
    layers = {"bronze": "gen_bronze", "silver": "gen_silver", "gold": "gen_gold"}
    res = jobs.run_synthetic_pipeline(spark, "2025-01-01", "2025-01-10", layers=layers, as_of="2025-01-11",
                                      n_products=60, n_stores=4, tx_per_day=40, locale="pt")
    assert res.rows["bronze.products"] == 60 and res.rows["bronze.stock"] == 40 * 4 * 10
    assert res.rows["bronze.sales"] == res.rows["silver.sales"] > 100
    audits = {k: v for k, v in res.rows.items() if k.startswith("gold.input.")}
    assert len(audits) == 7 and audits["gold.input.products_for_stock"] == 60
    report = {r.rule: (r.violations, r.declared) for r in res.key_report.collect()}
    assert len(report) == 9 and set(report.values()) == {(0, "declared")}
    bands = {r[0] for r in spark.table("gen_silver.products").select("price_band").distinct().collect()}
    assert len(bands) == 3
    assert spark.table("gen_gold.dim_calendar").where("month_name = 'janeiro'").count() == 31
    total = spark.table("gen_gold.fact_daily_sales").agg(F.sum("net_total")).first()[0]
    assert total == spark.table("gen_silver.sales").agg(F.sum("net")).first()[0]


def test_duplicate_primary_key_is_not_declared(spark):
    layers = {"bronze": "dup_bronze", "silver": "dup_silver", "gold": "dup_gold"}
    jobs.run_synthetic_pipeline(spark, "2025-01-01", "2025-01-02", layers=layers, n_products=5, n_stores=2, tx_per_day=10)
    twice = spark.table("dup_gold.dim_stores")
    rows = twice.unionAll(twice).collect()
    cat.create_or_replace(spark.createDataFrame(rows, twice.schema), "dup_gold.dim_stores")
    report = {r.rule: (r.violations, r.declared) for r in jobs.apply_gold_keys(spark, layers).collect()}
    assert report["pk_dim_stores"] == (2, "skipped")


def test_latest_row_survives(spark):
    df = spark.createDataFrame([(1, "old", dt.datetime(2025, 1, 1)), (1, "new", dt.datetime(2025, 1, 2))],
                               "k int, v string, ts timestamp")
    assert A.dedup(df, ["k"], A.latest_first(df, "ts")).first().v == "new"
