"""Column expressions on hand-made rows (NULLs, zeros, ties, half cents)."""

from decimal import Decimal

from pyspark.sql import functions as F

from retailflow.functions import calendar as CAL
from retailflow.functions import columns as C


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_bucketize_strict_bounds_and_null_to_last(spark):
    df = spark.createDataFrame([(9.99,), (10.0,), (19.99,), (20.0,), (None,)], "p double")
    out = df.select(C.bucketize("p", C.PRICE_CUTS, C.BAND_LABELS).alias("b"))
    assert [r.b for r in out.collect()] == ["Baixo", "Médio", "Médio", "Alto", "Alto"]


def test_tier_by_rank_inclusive(spark):
    df = spark.createDataFrame([(1,), (10,), (11,), (40,), (41,), (None,)], "r int")
    out = df.select(C.tier_by_rank("r").alias("t"))
    assert [r.t for r in out.collect()] == ["Top", "Top", "Média", "Média", "Long tail", "Long tail"]


def test_flag_keeps_null(spark):
    df = spark.createDataFrame([(5,), (11,), (None,)], "r int")
    assert [r.f for r in df.select(C.flag(F.col("r") <= 10).alias("f")).collect()] == [True, False, None]


def test_member_label_null_and_unknown_city(spark):
    df = spark.createDataFrame([("Serra",), ("Linhares",), ("Atlantis",), (None,)], "c string")
    out = df.select(C.member_label("c", C.REGION_CITIES, C.REGION_IN_LABEL, C.REGION_OUT_LABEL).alias("l"))
    assert [r.l for r in out.collect()] == ["Grande Vitória", "Interior", "Interior", "Interior"]


def test_safe_cast_of_non_numeric_store_id(spark):
    df = spark.createDataFrame([("7",), ("x7",)], "s string")
    assert [r.i for r in df.select(C.cast_col("s", "int", safe=True).alias("i")).collect()] == [7, None]


def test_safe_ratio_zero_null_and_types(spark):
    df = spark.createDataFrame(
        [(Decimal("1.00"), Decimal("4.00")), (Decimal("1.00"), Decimal("0.00")), (Decimal("1.00"), None),
         (Decimal("1.00"), Decimal("-2.00"))], "n decimal(18,2), d decimal(19,2)")
    out = df.select(C.safe_ratio("n", "d", 4).alias("r"), C.safe_ratio("n", "d", 2, default=None).alias("v"))
    assert dict(out.dtypes)["r"] == "double"
    assert dict(out.dtypes)["v"].startswith("decimal")
    got = rows(out, "r", "v")
    assert got[0] == (0.25, Decimal("0.25"))
    assert got[1] == (0.0, None) and got[2] == (0.0, None) and got[3] == (0.0, None)


def test_half_cent_rounds_up_and_gross_can_exceed_price(spark):
    # 0.15 * 0.30 = 0.045 and 0.15 * 0.70 = 0.105: both round up to the next cent
    df = spark.createDataFrame([(0.15, 0.30)], "price double, rate double")
    price, rate = C.to_money("price"), F.col("rate").cast(C.RATE)
    out = df.select(F.round(price * (F.lit(1) - rate), 2).cast(C.MONEY).alias("net"),
                    F.round(price * rate, 2).cast(C.MONEY).alias("discount"))
    out = out.withColumn("gross", C.add_gross("net", "discount"))
    r = out.first()
    assert (r.net, r.discount, r.gross) == (Decimal("0.11"), Decimal("0.05"), Decimal("0.16"))
    assert dict(out.dtypes)["gross"] == "decimal(19,2)"


def test_cost_and_margin_are_doubles_rounded_half_up(spark):
    df = spark.createDataFrame([(Decimal("10.00"),), (Decimal("0.00"),), (None,)], "list_price decimal(18,2)")
    out = df.select(*[c.alias(k) for k, c in C.cost_and_margin("list_price").items()])
    assert all(t == "double" for _, t in out.dtypes)
    got = rows(out, "est_cost", "margin", "margin_pct")
    assert got[0] == (6.5, 3.5, 0.35)
    assert got[1] == (0.0, 0.0, 0.0)
    assert got[2] == (None, None, 0.0)


def test_padded_id_never_truncates(spark):
    df = spark.createDataFrame([(7,), (12345,)], "n int")
    assert [r.s for r in df.select(C.padded_id("P", "n", 4).alias("s")).collect()] == ["P0007", "P12345"]


def test_uniform_is_keyed_and_partition_independent(spark):
    base = spark.range(2000).withColumn("u", C.uniform("id", salt="x"))
    a = {r.id: r.u for r in base.collect()}
    b = {r.id: r.u for r in spark.range(2000).repartition(13).withColumn("u", C.uniform("id", salt="x")).collect()}
    assert a == b
    assert all(0.0 <= v < 1.0 for v in a.values())
    other = {r.id: r.u for r in spark.range(2000).withColumn("u", C.uniform("id", salt="y")).collect()}
    assert sum(a[k] == other[k] for k in a) == 0


def test_calendar_columns_and_locale(spark):
    df = spark.createDataFrame([("2025-01-05",), ("2025-03-12",)], "d string").select(F.to_date("d").alias("d"))
    out = df.select(*[c.alias(k) for k, c in CAL.calendar_columns("d").items()]).collect()
    assert out[0].weekday_num == 1 and out[0].weekday_name == "Sunday" and out[0].is_weekend
    assert out[1].month_name == "March" and out[1].quarter == 1 and out[1].year_month == "2025-03"
    pt = df.select(CAL.month_name("d", "pt").alias("m"), CAL.weekday_name("d", "pt").alias("w")).collect()
    assert pt[0].m == "janeiro" and pt[0].w == "domingo"


def test_season_factor_sunday_is_one(spark):
    df = spark.createDataFrame([("2025-01-05",)], "d string").select(F.to_date("d").alias("d"))
    assert df.select(CAL.season_factor("d").alias("f")).first().f == 1.0
