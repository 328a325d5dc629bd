"""Synthetic generators: fixed domains, keyed draws, partition invariance."""

import datetime as dt

from pyspark.sql import functions as F

from retailflow.sources import synth as S


def test_zipf_products(spark):
    p = S.zipf_products(spark)
    rows = {r.rank: r for r in p.collect()}
    assert len(rows) == S.N_PRODUCTS
    assert rows[1].product_id == "P0001" and rows[120].sku == "SKU-0120"
    assert rows[6].category == S.CATEGORIES[0] and rows[1].category == S.CATEGORIES[1]
    assert rows[4].brand == S.BRANDS[0]
    assert abs(sum(r.weight for r in rows.values()) - 1.0) < 1e-12
    assert all(rows[k].weight > rows[k + 1].weight for k in range(1, 120))
    for r in rows.values():
        lo = S.PRICE_BASE + r.rank % S.PRICE_MOD
        assert lo <= float(r.list_price) <= lo + S.PRICE_SPREAD


def test_stores(spark):
    st = {r.store_id: r for r in S.synthetic_stores(spark, 8).collect()}
    assert st["1"].city == "Vitoria" and st["6"].city == "Linhares" and st["7"].city == "Vitoria"
    assert {r.state for r in st.values()} == {"ES"}


def test_sales_chain_properties_and_invariance(spark):
    products, stores = S.zipf_products(spark), S.synthetic_stores(spark)
    start, end = dt.date(2025, 1, 1), dt.date(2025, 1, 14)
    a = S.synthetic_sales(products, stores, start, end, as_of=dt.datetime(2025, 1, 15), num_partitions=3)
    b = S.synthetic_sales(products, stores, start, end, as_of=dt.datetime(2025, 1, 15), num_partitions=11)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    row = a.agg(F.min("qty").alias("q0"), F.max("qty").alias("q1"), F.count(F.lit(1)).alias("n"),
                F.countDistinct("order_id").alias("o")).first()
    assert (row.q0, row.q1) == (1, 3) and row.n > row.o > 0
    grid = S.transaction_grid(stores, start, end).collect()
    assert len(grid) == 14 * 6 and all(g.tx >= 1 for g in grid)
    assert a.where(F.col("order_id").rlike(r"^2025010[1-9]-[1-6]-[0-9]{6}$") |
                   F.col("order_id").rlike(r"^202501[1][0-4]-[1-6]-[0-9]{6}$")).count() == row.n
    # a discount happens without a second unit too (independent draws)
    lines = a.where("discount > 0")
    assert lines.count() > 0 and lines.where("qty = 1").count() > 0


def test_pick_products_is_a_rank_prefix(spark):
    products = S.zipf_products(spark)
    items = spark.createDataFrame([(1, 0.0), (2, 0.5), (3, 0.9999), (4, 0.01)], "id int, u double")
    got = S.pick_products(items, products).groupBy("id").agg(F.collect_set("rank").alias("r")).collect()
    ranks = {g.id: sorted(g.r) for g in got}
    assert ranks[1] == list(range(1, 121))
    assert 3 not in ranks                     # u above 3 * w1 matches nothing
    for rs in ranks.values():
        assert rs == list(range(1, len(rs) + 1))
