"""Steps whose memory, shuffle or work must not grow faster than the data."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from retailflow.functions import columns as C
from retailflow.operators import distinct as D
from retailflow.operators import joins as J
from retailflow.plans import quality, refresh
from retailflow.plans import queries as Q
from retailflow.sources import catalog as cat
from retailflow.sources import synth as S

SMOKE = "/root/testdata/sf0.001"


def test_sets_of_sparse_cells_stay_small(spark):
    """One number a cell and block: as many rows as values, each a long (not a bitmap of 4 KiB a value)."""
    rows = spark.range(2_000).select((F.col("id") * 40_000).alias("n"), (F.col("id") % 7).alias("cell"))
    sets = D.distinct_sets(rows.unionAll(rows), ["cell"], "n")
    assert sets.schema[D.BITS].dataType == LongType()
    assert sets.count() == 2_000
    assert "SortAggregate" not in D.set_counts(sets, ["cell"], "c")._jdf.queryExecution().toString()
    assert D.set_counts(sets, [("all", F.lit(1))], "c").first().c == 2_000


def test_sets_hold_every_bit_of_a_word(spark):
    rows = spark.createDataFrame([(0,), (63,), (63,), (64,), (127,), (None,), (2**40 + 63,)], "n bigint")
    sets = D.distinct_sets(rows.withColumn("cell", F.lit(1)), ["cell"], "n")
    assert sorted((r[D.BLOCK], r[D.BITS]) for r in sets.collect()) == [(0, 1 - 2**63), (1, 1 - 2**63), (2**34, -2**63)]
    assert D.set_counts(sets, ["cell"], "c").first().c == 5


def test_items_beyond_the_hot_places_meet_blocks(spark, monkeypatch):
    """A draw that matches the whole catalogue is shuffled once a block of products, not once a product."""
    monkeypatch.setattr(J, "RANK_BLOCK", 50)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = spark.range(1, 1_001).select(F.col("id").alias("rank"), (1 / F.col("id")).alias("weight"))
        items = spark.createDataFrame([(1, 0.0), (2, 0.0015), (3, 0.9), (4, 5.0), (5, None), (6, 0.05)], "id int, u double")
        got = J.threshold_join(items, "u", ranked, "weight", 1.0, hot_ranks=10, fanout=8)
        rows = sorted((r.id, r["rank"]) for r in got.collect())
        tops = {1: 1_000, 2: 666, 3: 1, 6: 19}
        assert rows == [(i, k) for i, n in tops.items() for k in range(1, n + 1)]

        # the item's rows are dealt by block, and places are only made for the broadcast ones
        assert got._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(_rf_place") == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)


def test_draws_below_a_bound_equal_the_numbers(spark):
    rows = spark.range(3_000)
    for p in (0.0, 1e-9, 0.1, 0.12, 0.35, 0.5, 1 - 2**-33, 1.0, 1.5, -1.0):
        assert rows.where(C.uniform("id", salt="s") < p).exceptAll(rows.where(C.uniform_below("id", salt="s", p=p))).count() == 0
        assert rows.where(C.uniform_below("id", salt="s", p=p)).count() == rows.where(C.uniform("id", salt="s") < p).count()


def test_labels_of_an_item_give_the_same_lines(spark):
    """Order id and draws made from the item's joined keys equal those made from the single keys."""
    items = spark.range(400).select(F.expr("date'2024-12-30' + CAST(id % 5 AS INT)").alias("day"), F.when(F.col("id") % 7 > 0, "3").alias("store_id"),
                                    F.when(F.col("id") % 9 > 0, F.col("id")).otherwise(F.lit(12_345_678)).alias("local_order"), (F.col("id") % 6).alias("item_no"),
                                    (F.col("id") % 50).alias("product_id"), F.expr("CAST(id AS DECIMAL(18,2)) / 7").cast(C.MONEY).alias("list_price"))
    keys = ("day", "store_id", "local_order", "item_no", "product_id")
    amount = F.col("list_price") * (1 + (C.uniform(*keys, salt="qty2") < 0.35).cast("int") + (C.uniform(*keys, salt="qty3") < 0.1).cast("int"))
    rate = F.when(C.uniform(*keys, salt="disc") < 0.12, (0.05 + C.uniform(*keys, salt="rate") * 0.15).cast(C.RATE)).otherwise(F.lit(0).cast(C.RATE))
    number = F.col("local_order").cast("string")
    order = F.concat(F.date_format("day", "yyyyMMdd"), F.lit("-"), F.col("store_id"), F.lit("-"),
                     F.when(F.length(number) > 6, number).otherwise(F.lpad(number, 6, "0")))
    want = items.select(order, F.round(amount * (1 - rate), 2).cast(C.MONEY), F.round(amount * rate, 2).cast(C.MONEY))
    labelled = S.item_labels(items)
    assert "local_order" not in labelled.columns
    got = S.finish_sales(S.price_lines(labelled)).select("order_id", "net", "discount")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))
    assert got.where("discount > 0").count() > 10


def test_partitioned_loads_without_a_spread_key_are_not_sampled(spark):
    rows = spark.range(100).withColumn("part", F.lit("all"))
    plan = cat._layout(rows, ["part"], None, None)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "REBALANCE" in plan
    kept = cat._layout(rows, ["part"], ["id"], None)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in kept


def test_key_summaries_count_values_before_text(spark):
    rows = spark.createDataFrame([(1, "a", 1.5, "x"), (1, "a", 1.5, "x"), (None, "a", None, "x"), (2, None, 2.0, None), (1, "a", 1.5, "y")],
                                 "k long, t string, f double, m string")
    rules = {"one": ["k"], "text": ["t"], "real": ["f"], "two": ["k", "t"]}
    got = refresh.key_summary(rows, rules, "m")
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()
    tagged = [rows.select(F.lit(r).alias("rule"), quality._key_text(c).alias("key"), "m") for r, c in rules.items()]
    every = tagged[0].unionAll(tagged[1]).unionAll(tagged[2]).unionAll(tagged[3])
    want = every.groupBy("rule", "key", "m").agg(F.count(F.lit(1)).alias("n")).select("rule", "key", "n", "m")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.schema.simpleString() == want.schema.simpleString()


def test_digest_is_the_sum_of_the_hashes(spark):
    rows = spark.range(5_000).select("id", (F.col("id") % 3).alias("p"), F.lit("2025-01-01").cast("timestamp").alias("silver_ts"))
    got = {r.part: r.digest for r in refresh.partition_summary(rows, F.col("p"), "s").collect()}
    want = {str(r.p): r.d for r in rows.groupBy("p").agg(F.sum(F.xxhash64("id", "p").cast("decimal(20,0)")).alias("d")).collect()}
    assert got == want
    plan = refresh.partition_summary(rows, F.col("p"), "s")._jdf.queryExecution().executedPlan().toString()
    assert "decimal(20,0)))" not in plan.split("HashAggregate")[-1]


def test_only_months_with_other_lines_are_rebuilt(spark, monkeypatch):
    seen, real = [], refresh.refresh_partitions
    monkeypatch.setattr(refresh, "refresh_partitions", lambda *a, **k: seen.append(real(*a, **k)) or seen[-1])
    Q.QUERIES["refreshed_fact_by_store"](spark, SMOKE).count()
    first, second = seen
    assert all(m.endswith("-02") for m in second["rebuilt"][:-1])
    assert len(second["dropped"]) == 1 and len(first["rebuilt"]) > 4 * len(second["rebuilt"])
