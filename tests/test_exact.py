from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revline.functions.exact import round_half_up_scaled, weighted_score_scaled


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**6)), min_size=1, max_size=200))
def test_round_half_up_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "num long, den long")
    for k in (0, 1, 2, 4):
        got = [r[0] for r in df.select(round_half_up_scaled(F.col("num"), F.col("den"), k)).collect()]
        want = [int((Decimal(n) / Decimal(d) * Decimal(10) ** k).quantize(Decimal(1), ROUND_HALF_UP))
                for n, d in pairs]
        assert got == want


def test_round_half_up_ties_and_zero_den(spark):
    df = spark.createDataFrame([(1, 8), (5, 2), (1, 0), (None, 3)], "num long, den long")
    got = [r[0] for r in df.select(round_half_up_scaled(F.col("num"), F.col("den"), 2)).collect()]
    assert got == [13, 250, None, None]        # 0.125 -> 0.13 (half up), 2.5 -> 2.50


def test_weighted_score(spark):
    # ratio 0.5000, community 87.50 -> 0.6*0.5 + 0.4*0.875 = 0.65
    df = spark.createDataFrame([(5000, 8750), (3333, 9999), (1, 0)], "r long, c long")
    got = [r[0] for r in df.select(weighted_score_scaled(F.col("r"), F.col("c"))).collect()]
    want = [int((Decimal(6 * r + 4 * c) / 10).quantize(Decimal(1), ROUND_HALF_UP))
            for r, c in [(5000, 8750), (3333, 9999), (1, 0)]]
    assert got == want == [6500, 5999, 1]
