"""Property tests: column expressions against plain-Python references."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retailflow.functions import columns as C
from retailflow.operators import aggregates as A

cents = st.integers(min_value=0, max_value=10**9)


def _half_up(x: Decimal, places: int) -> Decimal:
    return x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(cents, cents, st.integers(min_value=0, max_value=50)), min_size=1, max_size=40))
def test_ratios_are_exact_half_up(spark, rows):
    data = [(Decimal(n).scaleb(-2), Decimal(d).scaleb(-2), q) for n, d, q in rows]
    df = spark.createDataFrame(data, "discount decimal(18,2), net decimal(18,2), qty int")
    df = df.withColumn("gross", C.add_gross("net", "discount"))
    out = df.select("discount", "gross", "qty",
                    C.safe_ratio("discount", "gross", 4).alias("pct"),
                    C.safe_ratio("gross", "qty", 2, default=None).alias("unit")).collect()
    for r in out:
        exp_pct = float(_half_up(r.discount / r.gross, 4)) if r.gross > 0 else 0.0
        exp_unit = _half_up(r.gross / r.qty, 2) if r.qty > 0 else None
        assert r.pct == exp_pct
        assert r.unit == exp_unit


whole_range = st.one_of(st.integers(-(10**18) + 1, 10**18 - 1), st.integers(35 * 10**14, 9 * 10**15),
                        st.sampled_from([4049943105248009, 10**18 - 1, 9 * 10**17]))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), whole_range), min_size=1, max_size=40), st.booleans())
def test_sums_are_exact_over_the_whole_money_range(spark, rows, ansi):
    spark.conf.set("spark.sql.ansi.enabled", str(ansi).lower())
    try:
        lines = spark.createDataFrame([(g, i, 1, Decimal(c).scaleb(-2)) for i, (g, c) in enumerate(rows)],
                                      "g int, order_id int, qty int, net decimal(18,2)")
        lines = lines.selectExpr("g", "order_id", "qty", "CAST(net AS DECIMAL(19,2)) AS gross", "net",
                                 "CAST(0 AS DECIMAL(18,2)) AS discount")
        got = {r.g: (r.net_total, r.gross_total) for r in A.sales_measures(lines, ["g"], stock=None).collect()}
        ticket = {r.g: r.net_total for r in A.average_ticket(lines, ["g"]).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    exp = {}
    for g, c in rows:
        exp[g] = exp.get(g, Decimal(0)) + Decimal(c).scaleb(-2)
    assert {g: n for g, (n, _) in got.items()} == {g: x for g, (_, x) in got.items()} == ticket == exp


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(90, 130)), min_size=1, max_size=30))
def test_bucketize_matches_reference(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "q int")
    got = [r.b for r in df.select(C.bucketize("q", C.STOCK_CUTS, C.BAND_LABELS).alias("b")).collect()]

    def ref(v):
        if v is not None and v < C.STOCK_CUTS[0]:
            return C.BAND_LABELS[0]
        if v is not None and v < C.STOCK_CUTS[1]:
            return C.BAND_LABELS[1]
        return C.BAND_LABELS[2]
    assert got == [ref(v) for v in values]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=200), st.integers(1, 9))
def test_row_number_is_a_permutation_per_group(spark, groups, parts):
    from retailflow.operators.windows import row_number_by
    df = spark.createDataFrame([(i, g) for i, g in enumerate(groups)], "id int, g int")
    out = row_number_by(df, [F.col("id").desc()], within=["g"], out="rn", num_partitions=parts).collect()
    by_group = {}
    for r in out:
        by_group.setdefault(r.g, []).append((r.rn, r.id))
    for g, pairs in by_group.items():
        pairs.sort()
        assert [rn for rn, _ in pairs] == list(range(1, len(pairs) + 1))
        assert [i for _, i in pairs] == sorted((i for i, gg in enumerate(groups) if gg == g), reverse=True)
