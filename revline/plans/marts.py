"""Star schema: item, user and date dimensions around the review fact."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revline.functions.scalars import (
    date_key,
    day_of_week_sunday0,
    first_element,
    is_weekend,
    iso_week,
    padded_day_name,
    padded_month_name,
)

def dim_item(stg_items: DataFrame) -> DataFrame:
    """Display title falls back to the native one; primary tag = first tag."""
    c = F.col
    return stg_items.select(
        c("item_id"),
        c("title_native").alias("title"),
        F.coalesce(c("title_english"), c("title_native")).alias("title_display"),
        c("tags"),
        first_element("tags").alias("tag_primary"),
        c("studio"), c("episodes"), c("avg_score"), c("release_year"),
        c("status"), c("description"),
    )


def dim_user(stg_users: DataFrame, as_of: str | _dt.date | None = None) -> DataFrame:
    """``account_age_days = as_of - join_date``; ``as_of`` defaults to today."""
    ref = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return stg_users.select(
        "user_id", "username", "join_date",
        F.datediff(ref, F.col("join_date")).cast("int").alias("account_age_days"),
    )


def _date_attributes(spine: DataFrame) -> DataFrame:
    d = F.col("full_date")
    return spine.select(
        date_key(d).alias("date_id"),
        d,
        F.dayofmonth(d).cast("int").alias("day"),
        F.month(d).cast("int").alias("month"),
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        iso_week(d).alias("week_of_year"),
        padded_month_name(d).alias("month_name"),
        day_of_week_sunday0(d).alias("day_of_week"),
        padded_day_name(d).alias("day_name"),
        is_weekend(d).alias("is_weekend"),
    )


def dim_date(stg_reviews: DataFrame, buffer_days: int = 7) -> DataFrame:
    """Gap-free calendar ``[min - buffer, max + buffer]`` of the review dates.

    One aggregate brings the two bounds (as day numbers) to the driver; the
    spine is a distributed range, so any span is fine. No dated review gives
    an empty calendar.
    """
    day = F.unix_date("review_date")
    bounds = stg_reviews.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first()
    first, end = (0, 0) if bounds["lo"] is None else (
        bounds["lo"] - buffer_days, bounds["hi"] + buffer_days + 1)
    spine = stg_reviews.sparkSession.range(first, end).select(
        F.date_from_unix_date(F.col("id").cast("int")).alias("full_date"))
    return _date_attributes(spine)


def fact_reviews(stg_reviews: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """One row per review; a review without a date has no date id.

    The calendar has every date of the reviews, and a date's id follows from
    the date, so without ``dates`` nothing is joined. With a calendar of other
    bounds, reviews outside it keep a NULL id (left join; the planner picks the
    strategy by size).
    """
    cols = ["review_id", "item_id", "user_id", "date_id", "score", "summary", "review_text"]
    if dates is None:
        return stg_reviews.withColumn("date_id", date_key(F.col("review_date"))).select(*cols)
    d = dates.select("date_id", F.col("full_date").alias("review_date")).dropDuplicates(["review_date"])
    return stg_reviews.join(d, "review_date", "left").select(*cols)
