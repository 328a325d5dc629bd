"""Catalog loads, comments and key declarations in a temporary warehouse."""

import datetime as dt

from pyspark.sql import functions as F

from retailflow.plans import jobs
from retailflow.sources import catalog as cat

SMOKE = "/root/testdata/sf0.001"


def _frame(spark, n, day="2025-01-01"):
    return spark.range(n).select(F.col("id").alias("k"), F.lit(day).cast("date").alias("d"),
                                 (F.col("id") * 2).alias("v"))


def test_first_load_reload_append(spark, db):
    name = f"{db}.t"
    assert not cat.table_exists(spark, name)
    assert not cat.table_exists(spark, "no_such_layer.t")
    assert cat.save(_frame(spark, 5), name, column_comments={"v": "twice k"}, table_comment="test") == 5
    assert cat.table_exists(spark, name)
    assert cat.save(_frame(spark, 5), name, mode="overwrite") == 5
    assert spark.table(name).count() == 5                      # overwrite twice: idempotent
    cat.save(_frame(spark, 5), name, mode="append")
    assert spark.table(name).count() == 10                     # append twice: rows double


def test_comments_reapplied_after_overwrite(spark, db):
    name = f"{db}.c"
    cat.save(_frame(spark, 3), name, column_comments={"v": "it's twice k"}, table_comment="first")
    cat.save(_frame(spark, 3), name, column_comments={"v": "it's twice k"}, table_comment="second")
    assert cat.read_column_comments(spark, name)["v"] == "it's twice k"
    assert cat.table_comment(spark, name) == "second"
    cat.comment_table(spark, name, 42)                         # non-text: no-op
    assert cat.table_comment(spark, name) == "second"


def test_partitioned_write_and_partition_replace(spark, db):
    name = f"{db}.p"
    df = _frame(spark, 6, "2025-01-01").unionByName(_frame(spark, 4, "2025-01-02"))
    cat.save(df, name, partition_by=["d"], spread_key=["k"], num_partitions=3)
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {cat.current(spark, name)}").collect()}
    assert parts == {"d=2025-01-01", "d=2025-01-02"}
    cat.save(_frame(spark, 2, "2025-01-02"), name, partition_by=["d"], replace_partitions=True)
    counts = {str(r.d): r["count"] for r in spark.table(name).groupBy("d").count().collect()}
    assert counts == {"2025-01-01": 6, "2025-01-02": 2}         # only the touched day was replaced
    cat.save(_frame(spark, 1, "2025-01-03"), name, partition_by=["d"])
    assert spark.table(name).count() == 1                      # plain overwrite replaces the table


def test_max_records_per_file_splits_files(spark, db):
    import os
    name = f"{db}.m"
    cat.save(_frame(spark, 50).coalesce(1), name, max_records_per_file=10)
    loc = spark.sql(f"DESCRIBE TABLE EXTENDED {cat.current(spark, name)}").where("col_name = 'Location'").first().data_type
    files = [f for f in os.listdir(loc.replace("file:", "")) if f.endswith(".parquet")]
    assert len(files) == 5 and spark.table(name).count() == 50


def test_silver_append_twice_doubles_rows(spark):
    layers = {"bronze": "app_bronze", "silver": "app_silver", "gold": "app_gold"}
    cat.ensure_layers(spark, list(layers.values()))
    jobs.load_bronze_tables(spark, SMOKE, layers)
    first = jobs.load_silver_tables(spark, layers, mode="append")
    jobs.load_silver_tables(spark, layers, mode="append")
    assert spark.table("app_silver.stores").count() == 2 * first["silver.stores"]
    # the Gold dimension deduplicates, so the doubled Silver rows keep its key unique
    jobs.load_gold_tables(spark, layers)
    assert spark.table("app_gold.dim_stores").count() == first["silver.stores"]


def test_create_or_replace_changes_schema(spark, db):
    name = f"{db}.r"
    cat.create_or_replace(_frame(spark, 2), name)
    cat.create_or_replace(spark.range(3).withColumnRenamed("id", "z"), name)
    assert spark.table(name).columns == ["z"] and spark.table(name).count() == 3


def test_keys_declared_idempotent_and_validated(spark, db):
    name = f"{db}.k"
    cat.save(_frame(spark, 3), name)
    assert cat.set_not_null(spark, name, "k")
    assert cat.declare_key(spark, name, "pk_k", "k") == "declared"
    assert cat.declare_key(spark, name, "pk_k", ["k"]) == "exists"
    assert cat.key_exists(spark, name, "pk_k")
    assert cat.declare_key(spark, name, "fk_bad", ["k", "d"], f"{db}.other", ["x"]) == "invalid"
    assert cat.declare_key(spark, name, "fk_bad2", 7) == "invalid"
    assert cat.declare_key(spark, name, "fk_kd", ["k", "d"], f"{db}.other", ["x", "y"]) == "declared"
    keys = cat.declared_keys(spark, name)
    assert keys["pk_k"]["type"] == "primary_key" and keys["fk_kd"]["ref_columns"] == ["x", "y"]
    nul = f"{db}.n"
    cat.save(spark.createDataFrame([(1,), (None,)], "k int"), nul)
    assert cat.set_not_null(spark, nul, "k") is False


def test_end_to_end_pipeline(spark):
    layers = {"bronze": "e2e_bronze", "silver": "e2e_silver", "gold": "e2e_gold"}
    res = jobs.run_pipeline(spark, SMOKE, layers=layers, as_of=dt.datetime(2025, 1, 1))
    assert res.rows["bronze.sales"] == res.rows["silver.sales"] > 0
    assert res.rows["gold.dim_stores"] == 5
    # inputs were counted during the fact writes
    assert res.rows["gold.input.sales_for_sales"] == res.rows["silver.sales"]
    assert res.rows["gold.input.stock_for_sales"] == res.rows["silver.stock"]
    assert res.rows["gold.fact_daily_stock"] == res.rows["silver.stock"]
    rep = {r.rule: (r.violations, r.status, r.declared) for r in res.key_report.collect()}
    assert len(rep) == 9
    assert all(v == 0 and s == "ok" for v, s, _ in rep.values()), rep
    assert all(d == "declared" for _, _, d in rep.values())
    again = {r.rule: r.declared for r in jobs.apply_gold_keys(spark, layers).collect()}
    assert set(again.values()) == {"exists"}
    fact = spark.table("e2e_gold.fact_daily_sales")
    assert fact.count() == res.rows["gold.fact_daily_sales"]
    assert cat.read_column_comments(spark, "e2e_gold.fact_daily_sales")["avg_ticket"].startswith("net_total over")
    # sums survive the whole chain
    a = fact.agg(F.sum("net_total")).first()[0]
    b = spark.table("e2e_silver.sales").agg(F.sum("net")).first()[0]
    assert a == b
