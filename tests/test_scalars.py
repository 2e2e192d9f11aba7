import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from revline.functions import scalars as S


def one(spark, col, schema="x string", rows=((None,),)):
    return [r[0] for r in spark.createDataFrame(list(rows), schema).select(col.alias("y")).collect()]


def test_trim_spaces_only(spark):
    assert one(spark, S.trim_spaces("x"), rows=[("  a\t ",), ("\t",), (None,)]) == ["a\t", "\t", None]


def test_clip_null_becomes_upper_bound(spark):
    rows = [(None,), (Decimal("150.50"),), (Decimal("-3.00"),), (Decimal("42.42"),)]
    got = one(spark, S.clip("x", 0, 100, "decimal(5,2)"), "x decimal(5,2)", rows)
    assert got == [Decimal("100.00"), Decimal("100.00"), Decimal("0.00"), Decimal("42.42")]


def test_first_element_never_raises(spark):
    rows = [(["a", "b"],), ([],), (None,)]
    assert one(spark, S.first_element("x"), "x array<string>", rows) == ["a", None, None]


def test_epoch_to_date_utc_and_null(spark):
    rows = [(0,), (86399,), (86400,), (-1,), (None,)]
    got = one(spark, S.epoch_seconds_to_date("x"), "x bigint", rows)
    assert got == [dt.date(1970, 1, 1), dt.date(1970, 1, 1), dt.date(1970, 1, 2), dt.date(1969, 12, 31), None]


def test_date_attributes(spark):
    rows = [(dt.date(2021, 1, 1),), (dt.date(2024, 1, 7),), (dt.date(2024, 5, 4),)]
    df = spark.createDataFrame(rows, "d date")
    out = df.select(S.date_key("d").alias("k"), S.iso_week("d").alias("w"), S.day_of_week_sunday0("d").alias("dow"),
                    S.padded_month_name("d").alias("m"), S.padded_day_name("d").alias("n"),
                    S.is_weekend("d").alias("we")).collect()
    assert [r.k for r in out] == [20210101, 20240107, 20240504]
    assert out[0].w == 53                       # ISO week of 2021-01-01
    assert [r.dow for r in out] == [5, 0, 6]    # Friday, Sunday, Saturday
    assert out[0].m == "January  " and len(out[2].m) == 9
    assert out[1].n == "Sunday   "
    assert [r.we for r in out] == [False, True, True]


def test_map_with_default_passes_unknown(spark):
    m = {"LABEL_0": "negative", "LABEL_2": "positive"}
    got = one(spark, S.map_with_default("x", m), rows=[("LABEL_0",), ("LABEL_2",), ("weird",), (None,)])
    assert got == ["negative", "positive", "weird", None]


def test_text_prefix(spark):
    got = one(spark, S.text_prefix("x", 512), rows=[("a" * 1000,), ("",), (None,), ("é" * 600,)])
    assert [len(g) for g in got] == [512, 0, 0, 512]


def test_percent_text_and_display_round(spark):
    rows = [(0.4567,), (1.0,), (0.0,)]
    got = one(spark, S.percent_text("x"), "x double", rows)
    assert got == ["45.7%", "100.0%", "0.0%"]
    assert one(spark, S.display_round(F.col("x"), 3), "x double", [(0.12345,)]) == [0.123]
