import datetime as dt

from revline.plans import marts


def _stg(spark, dates):
    return spark.createDataFrame([(i, d) for i, d in enumerate(dates)], "review_id long, review_date date")


def test_single_date_spine_and_attributes(spark):
    dim = marts.dim_date(_stg(spark, [dt.date(2024, 1, 10)]))
    rows = dim.orderBy("full_date").collect()
    assert len(rows) == 15
    assert rows[0].full_date == dt.date(2024, 1, 3) and rows[-1].full_date == dt.date(2024, 1, 17)
    r = rows[4]                                   # 2024-01-07, a Sunday
    assert (r.date_id, r.day_of_week, r.day_name, r.is_weekend, r.quarter) == (20240107, 0, "Sunday   ", True, 1)


def test_null_bounds_give_empty_calendar(spark):
    assert marts.dim_date(_stg(spark, [None, None])).count() == 0


def test_any_span_of_dates(spark):
    """A creation time in milliseconds read as seconds lies some 50,000 years away."""
    from pyspark.sql import functions as F

    from revline.functions.scalars import epoch_seconds_to_date
    stg = spark.createDataFrame([(1, 1_700_000_000), (2, 1_700_000_000_000)], "review_id long, t long").select(
        "review_id", epoch_seconds_to_date("t").alias("review_date"),
        *(F.lit(5).alias(c) for c in ("item_id", "user_id", "score")),
        *(F.lit("s").alias(c) for c in ("summary", "review_text")))
    dim = marts.dim_date(stg)
    days = stg.agg(F.datediff(F.max("review_date"), F.min("review_date"))).first()[0]
    assert days > 18_000_000 and dim.count() == days + 15
    joined = marts.fact_reviews(stg, dim).select("review_id", "date_id")
    computed = marts.fact_reviews(stg).select("review_id", "date_id")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, computed.collect()))
    assert joined.filter("date_id IS NULL").count() == 0


def test_fact_keeps_reviews_without_date(spark):
    stg = spark.createDataFrame([(1, 5, 7, 50, "s", "t", dt.date(2024, 1, 1)), (2, 5, 7, 60, "s", "t", None)],
                                "review_id long, item_id long, user_id long, score int, summary string, "
                                "review_text string, review_date date")
    for dates in (None, marts.dim_date(stg)):
        got = {r.review_id: r.date_id for r in marts.fact_reviews(stg, dates).collect()}
        assert got == {1: 20240101, 2: None}
    other = marts.dim_date(_stg(spark, [dt.date(1990, 1, 1)]))
    assert [r.date_id for r in marts.fact_reviews(stg, other).collect()] == [None, None]


def test_dim_user_age_and_dim_item(spark):
    u = spark.createDataFrame([(1, "a", dt.date(2001, 12, 1))], "user_id long, username string, join_date date")
    assert marts.dim_user(u, "2002-01-01").first().account_age_days == 31
    items = spark.createDataFrame(
        [(1, "n", None, ["x", "y"], "s", 1, None, 2000, "S", "d"), (2, "m", "M", [], "s", 1, None, 2000, "S", "d")],
        "item_id long, title_native string, title_english string, tags array<string>, studio string, "
        "episodes int, avg_score decimal(5,2), release_year int, status string, description string")
    got = {r.item_id: (r.title_display, r.tag_primary) for r in marts.dim_item(items).collect()}
    assert got == {1: ("n", "x"), 2: ("M", None)}
