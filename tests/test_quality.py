"""Data-quality checks with seeded bad rows."""

from pyspark.sql import functions as F

from retailflow.plans import quality as Q


def test_null_check_one_row_per_column(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = {r.column_name: r.null_count for r in Q.null_check(df, ["a", "b"]).collect()}
    assert got == {"a": 1, "b": 2}


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (2, 1), (2, 1)], "k int, l int")
    got = sorted(map(tuple, Q.duplicate_keys(df, ["k", "l"]).collect()))
    assert got == [(1, 1, 2), (2, 1, 3)]


def test_orphans_skip_null_keys_and_count_rows(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (9,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (3,)], "pk int")
    assert Q.orphan_count(child, ["fk"], parent, ["pk"]).first().violations == 3


def test_gold_key_report_materialized_equals_lazy(spark):
    stores = spark.createDataFrame([("1",), ("2",)], "store_id string")
    products = spark.createDataFrame([(10,)], "product_id long")
    cal = spark.sql("SELECT explode(sequence(date'2025-01-01', date'2025-01-02')) AS day")
    sales = spark.sql("SELECT date'2025-01-01' AS sale_date, '3' AS store_id, 10L AS product_id, 5 AS qty_sold")
    stock = spark.sql("SELECT date'2025-01-09' AS stock_date, '1' AS store_id, 11L AS product_id, 100 AS stock_qty")
    star = {"dim_stores": stores, "dim_products": products, "dim_calendar": cal,
            "fact_daily_sales": sales, "fact_daily_stock": stock}
    a = sorted(map(tuple, Q.gold_key_report(star).collect()))
    b = sorted(map(tuple, Q.gold_key_report(star, materialize=True).collect()))
    assert a == b and sum(r[3] for r in a) == 3


def test_gold_key_report_flags_each_rule(spark):
    stores = spark.createDataFrame([("1",), ("1",), (None,)], "store_id string")
    products = spark.createDataFrame([(10,), (11,)], "product_id long")
    cal = spark.sql("SELECT explode(sequence(date'2025-01-01', date'2025-01-03')) AS day")
    sales = spark.createDataFrame([("2025-01-01", "1", 10), ("2025-02-01", "7", 99)],
                                  "sale_date string, store_id string, product_id long") \
        .selectExpr("cast(sale_date as date) sale_date", "store_id", "product_id")
    stock = spark.createDataFrame([("2025-01-02", "1", 10)], "d string, store_id string, product_id long") \
        .selectExpr("cast(d as date) stock_date", "store_id", "product_id")
    rep = {r.rule: (r.violations, r.status) for r in Q.gold_key_report({
        "dim_stores": stores, "dim_products": products, "dim_calendar": cal,
        "fact_daily_sales": sales, "fact_daily_stock": stock}).collect()}
    assert rep["pk_dim_stores"] == (2, "violated")      # one NULL key + one duplicate
    assert rep["pk_dim_products"] == (0, "ok")
    assert rep["fk_fact_sales_dim_calendar"] == (1, "violated")
    assert rep["fk_fact_sales_dim_stores"] == (1, "violated")
    assert rep["fk_fact_sales_dim_products"] == (1, "violated")
    assert rep["fk_fact_stock_dim_calendar"] == (0, "ok")
    assert len(rep) == 9


def test_registered_key_report_sees_the_star_as_built(spark, monkeypatch):
    from retailflow.plans import gold, queries

    smoke = "/root/testdata/sf0.001"
    dim, fact = gold.dim_products, gold.fact_daily_sales
    # a dimension that doubles its rows, and a stock join that breaks the fact's product keys

    def broken(sales, stock=None, **kw):
        out = fact(sales, stock, **kw)
        return out if stock is None else out.withColumn("product_id", -F.col("product_id"))

    monkeypatch.setattr(gold, "dim_products", lambda p: dim(p).unionAll(dim(p)))
    monkeypatch.setattr(gold, "fact_daily_sales", broken)
    bad = {r.table_name for r in queries.QUERIES["gold_key_report"](spark, smoke).where("violations > 0").collect()}
    assert {"dim_products", "fact_daily_sales"} <= bad
