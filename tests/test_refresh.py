"""Partial refresh, stored key summaries, mergeable distinct counts, hot-key joins."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retailflow.operators import distinct as D
from retailflow.operators import joins as J
from retailflow.plans import gold, quality, refresh
from retailflow.sources import catalog as cat
from retailflow.sources import upkeep

SALES = "sale_date date, order_id long, store_id string, product_id long, qty int, gross decimal(18,2), net decimal(18,2), discount decimal(18,2), silver_ts timestamp"


def sales_rows(n=120, ts="2025-02-01"):
    out = []
    for i in range(n):
        net = Decimal(100 + i * 7 % 90)
        out.append((dt.date(2025, 1, 1 + i % 6), i // 3, f"s{i % 2}", i % 5, 1 + i % 3, net + 1, net, Decimal(1), dt.datetime.fromisoformat(ts)))
    return out


def stock_rows():
    return [(dt.date(2025, 1, d), f"s{s}", p, 100 + d + p) for d in range(1, 8) for s in range(2) for p in range(4)]


def build(parts):
    return gold.fact_daily_sales(parts["sales"], parts["stock"], as_of="2025-03-01")


def load(spark, name, sales, stock):
    sales = spark.createDataFrame(sales, SALES)
    stock = spark.createDataFrame(stock, "stock_date date, store_id string, product_id long, stock_qty int")
    done = refresh.refresh_partitions(spark, name, "sale_date", {
        "sales": (sales, F.col("sale_date")), "stock": (stock, F.col("stock_date"))}, build)
    want = sorted(map(str, build({"sales": sales, "stock": stock}).collect()))
    assert sorted(map(str, spark.table(name).select(*gold.FACT_SALES_GRAIN, *gold.FACT_SALES_MEASURES, "gold_ts").collect())) == want
    return done


def test_a_refresh_gives_what_a_rebuild_gives(spark, db):
    name, sales, stock = f"{db}.fact", sales_rows(), stock_rows()
    assert len(load(spark, name, sales, stock)["rebuilt"]) == 7
    assert load(spark, name, sales, stock) == {"rebuilt": [], "dropped": []}
    # a late line, with an order of its own
    late = [*sales, (dt.date(2025, 1, 2), 999, "s1", 4, 2, Decimal(9), Decimal(8), Decimal(1), dt.datetime(2025, 2, 2))]
    assert load(spark, name, late, stock) == {"rebuilt": ["2025-01-02"], "dropped": []}
    # a changed line that keeps its load timestamp
    edited = [(*late[0][:4], 99, *late[0][5:]), *late[1:]]
    assert load(spark, name, edited, stock) == {"rebuilt": ["2025-01-01"], "dropped": []}
    # a deleted line, a day without lines now, a new day, and other stock
    fewer = [r for r in edited[1:] if r[0] != dt.date(2025, 1, 4)] + [(dt.date(2025, 1, 9), *edited[5][1:])]
    changed = [(d, s, p, q + (d == dt.date(2025, 1, 6))) for d, s, p, q in stock]
    assert load(spark, name, fewer, changed) == {"rebuilt": ["2025-01-01", "2025-01-06", "2025-01-09"], "dropped": ["2025-01-04"]}
    # the same rows loaded anew have another timestamp
    again = [(*r[:8], dt.datetime(2025, 5, 1)) if r[0] == dt.date(2025, 1, 3) else r for r in fewer]
    assert load(spark, name, again, changed) == {"rebuilt": ["2025-01-03"], "dropped": []}


def test_a_refresh_that_broke_off_is_made_up_for(spark, db, monkeypatch):
    name, sales, stock = f"{db}.fact", sales_rows(), stock_rows()
    load(spark, name, sales, stock)
    other = [(*r[:4], 7, *r[5:]) if r[0].day == 5 else r for r in sales]
    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="lost"):
        m.setattr(cat, "create_or_replace", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        load(spark, name, other, stock)
    assert load(spark, name, other, stock) == {"rebuilt": ["2025-01-05"], "dropped": []}


def star(spark):
    days = [dt.date(2025, 1, 1) + dt.timedelta(days=i) for i in range(6)]
    return {
        "dim_stores": spark.createDataFrame([("s0",), ("s1",), ("s1",), (None,)], "store_id string"),
        "dim_products": spark.createDataFrame([(i,) for i in range(4)], "product_id long"),
        "dim_calendar": spark.createDataFrame([(d,) for d in days], "day date"),
        "fact_daily_sales": spark.createDataFrame([(r[0], r[2], r[3]) for r in sales_rows()], "sale_date date, store_id string, product_id long"),
        "fact_daily_stock": spark.createDataFrame([r[:3] for r in stock_rows()], "stock_date date, store_id string, product_id long"),
    }


def report(frames):
    return sorted(map(tuple, frames.collect()))


def test_key_summaries_give_the_full_report(spark, db):
    frames = star(spark)
    parts = {"fact_daily_sales": "sale_date", "fact_daily_stock": "stock_date"}
    for t, df in frames.items():
        cat.save(df, f"{db}.{t}", partition_by=[parts[t]] if t in parts else None)

    def check(changed=None):
        got = refresh.key_report({t: refresh.refresh_keys(spark, f"{db}.{t}", refresh.key_rules(t), parts.get(t), changed) for t in frames})
        assert report(got) == report(quality.gold_key_report({t: spark.table(f"{db}.{t}") for t in frames}))
        return {r.rule: r.violations for r in got.collect()}

    first = check()
    assert first["pk_dim_stores"] == 2 and first["fk_fact_sales_dim_products"] == 24 and first["fk_fact_stock_dim_calendar"] == 8
    more = spark.createDataFrame([(dt.date(2025, 1, 3), "s9", 1), (dt.date(2025, 1, 3), None, 2)], "sale_date date, store_id string, product_id long")
    cat.save(more, f"{db}.fact_daily_sales", partition_by=["sale_date"], replace_partitions=True)
    assert check(["2025-01-03"])["fk_fact_sales_dim_stores"] == 1
    # a partition that goes
    upkeep._drop_partitions(spark, cat.current(spark, f"{db}.fact_daily_sales"), {"sale_date": dt.date(2025, 1, 3)})
    assert check(["2025-01-03"])["fk_fact_sales_dim_stores"] == 0
    # the others are not read: their files may as well be unreadable
    files = [r.path for r in upkeep.data_files(spark, f"{db}.fact_daily_sales").collect()]
    for f in files:
        if "2025-01-02" not in f:
            path = f.replace("file:", "")
            os.remove(os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc"))
            with open(path, "wb") as out:
                out.write(b"not parquet")
    refresh.refresh_keys(spark, f"{db}.fact_daily_sales", refresh.key_rules("fact_daily_sales"), "sale_date", ["2025-01-02"])
    with pytest.raises(Exception):  # noqa: B017 - whatever the reader says
        refresh.refresh_keys(spark, f"{db}.fact_daily_sales", refresh.key_rules("fact_daily_sales"), "sale_date", ["2025-01-01"])


@pytest.mark.parametrize("kind", ["store", "day", "region and month"])
@pytest.mark.parametrize("numbered", [False, True])
def test_tickets_from_stored_sets(spark, kind, numbered):
    grain = {"store": ["store_id"], "day": [("day", F.to_date("sale_date"))], "region and month": ["region", ("month", F.month("sale_date"))]}[kind]
    rows = [*sales_rows(200), (dt.date(2025, 1, 1), 90_000, None, 1, 1, Decimal(5), Decimal(5), Decimal(0), None),
            (dt.date(2025, 2, 1), None, "s1", 1, 1, Decimal(5), Decimal(5), Decimal(0), None)]
    sales = spark.createDataFrame(rows, SALES)
    stores = spark.createDataFrame([("s0", "north", None), ("s1", "south", None)], "store_id string, region string, silver_ts timestamp")
    if numbered:
        sales = sales.withColumn("order_id", F.concat(F.lit("order "), F.col("order_id").cast("string")))
    numbers = D.numbers(sales, "order_id") if numbered else None
    totals, sets = gold.ticket_sets(sales, ["sale_date", "store_id"], numbers)
    if "region" in grain:
        totals, sets = (J.enrich(x, stores.select("store_id", "region"), "store_id") for x in (totals, sets))
    got = gold.ticket_from_sets(totals, sets, grain)
    want = gold.ticket_report(sales, grain, stores=stores)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_numbers_go_on_after_the_largest(spark):
    known = D.numbers(spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "v string"), "v")
    assert sorted(map(tuple, known.collect())) == [("a", 1), ("b", 2)]
    more = D.extended(known, spark.createDataFrame([("a",), ("z",), ("c",)], "v string"), "v")
    assert sorted(map(tuple, more.collect())) == [("c", 3), ("z", 4)]
    none = D.numbers(spark.createDataFrame([], "v string"), "v")
    assert sorted(map(tuple, D.extended(none, spark.createDataFrame([("q",)], "v string"), "v").collect())) == [("q", 1)]


def test_sets_over_many_blocks(spark):
    rows = spark.range(100_000).select((F.col("id") * 7).alias("n"), (F.col("id") % 3).alias("cell"), F.lit(1).alias("all"))
    sets = D.distinct_sets(rows.unionAll(rows), ["cell", "all"], "n")
    assert {r.cell: r.c for r in D.set_counts(sets, ["cell"], "c").collect()} == {0: 33_334, 1: 33_333, 2: 33_333}
    assert D.set_counts(sets, ["all"], "c").first().c == 100_000


def test_hot_keys_are_found_and_spread(spark):
    fact = spark.range(6_000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, F.lit(None))
                                     .otherwise(F.col("id") % 900).cast("int").alias("k"))
    hot = J.hot_keys(fact, "k", 0.05).collect()
    assert [(r.k, r._rf_n >= 2_000) for r in hot] == [(7, True)]
    dim = spark.range(0, 800).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    got = J.enrich_spread(fact, dim, "k", parts=8)
    want = J.enrich(fact, dim, "k")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    inner = J.enrich_spread(fact, dim, ["k"], how="inner", parts=8)
    assert inner.count() == fact.join(dim, "k").count()


def test_hot_keys_share_no_task(spark):
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for c, v in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
            spark.conf.set(c, v)
        fact = spark.range(8_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 500).otherwise(7).alias("k"))
        dim = spark.range(500).select(F.col("id").alias("k"), F.lit("x").alias("v"))
        def largest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        assert largest(J.enrich(fact, dim, "k")) > 2_700 > 1_600 > largest(J.enrich_spread(fact, dim, "k", parts=8))
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_hot_pairs_of_keys(spark):
    fact = spark.createDataFrame([("a", 1)] * 50 + [("b", i) for i in range(20)] + [("a", None)] * 5, "x string, y int")
    dim = spark.createDataFrame([("a", 1, 10), ("b", 3, 20)], "x string, y int, v int")
    got, want = J.enrich_spread(fact, dim, ["x", "y"], parts=4), J.enrich(fact, dim, ["x", "y"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert J.enrich_spread(fact.where("false"), dim, ["x", "y"]).collect() == []
