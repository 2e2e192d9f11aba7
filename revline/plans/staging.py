"""Staging: type, trim, clip, filter and dedup the raw tables.

Dedup runs *before* the validity filter on purpose: when the newest row of a
key is invalid the key disappears, rather than an older row resurfacing.
Catalyst cannot push the filter below the aggregate, so the order holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revline.functions.scalars import clip, epoch_seconds_to_date, trim_spaces
from revline.operators.dedup import keep_latest


def stage_items(raw_items: DataFrame, null_score: str = "max") -> DataFrame:
    """Items: required id and title; score clipped to [0, 100] as NUMERIC(5,2).

    ``null_score="max"`` reproduces GREATEST/LEAST skipping NULLs (a missing
    score becomes 100); ``"keep"`` leaves it NULL.
    """
    c = F.col
    score = c("avg_score").cast("decimal(5,2)")
    clipped = clip(score, 0, 100, "decimal(5,2)")
    if null_score == "keep":
        clipped = F.when(score.isNull(), F.lit(None).cast("decimal(5,2)")).otherwise(clipped)
    return (raw_items
            .filter(c("item_id").isNotNull() & c("title_native").isNotNull())
            .select(
                c("item_id").cast("bigint").alias("item_id"),
                trim_spaces("title_native").alias("title_native"),
                trim_spaces("title_english").alias("title_english"),
                c("tags"),
                trim_spaces("studio").alias("studio"),
                c("episodes").cast("int").alias("episodes"),
                clipped.alias("avg_score"),
                c("year").cast("int").alias("release_year"),
                F.upper(trim_spaces("status")).alias("status"),
                trim_spaces("description").alias("description"),
            ))


# Ties between rows of one load are broken by the fixed-width columns first, so
# that a reader of these alone finds the same winner without moving any text.
_NARROW = ("item_id", "user_id", "score", "created_at", "user_created_at")
_WIDE = ("username", "summary", "review_text")


def _latest_usable_reviews(raw_reviews: DataFrame, wide: tuple[str, ...],
                           in_place: bool = False) -> DataFrame:
    """Latest load per id, then without unusable rows; of the text columns only ``wide``."""
    c = F.col
    # NULL ids form one group whose survivor the filter below always drops,
    # so dropping them first is equivalent and keeps them out of the shuffle
    rows = raw_reviews.filter(c("review_id").isNotNull()).select(
        "review_id", "loaded_at", *_NARROW,
        (trim_spaces("review_text") != F.lit("")).alias("_has_text"), *wide)
    # a missing text is no text
    latest = keep_latest(rows, ["review_id"], ["loaded_at"], in_place, dealt=True)
    return latest.filter(c("_has_text") & c("score").between(1, 100))


def stage_reviews(raw_reviews: DataFrame, in_place: bool = False) -> DataFrame:
    """Reviews: latest load per id, then drop unusable rows, epoch -> date.

    ``in_place``: of a written table, move only the rows of ids that are not unique."""
    c = F.col
    return _latest_usable_reviews(raw_reviews, _WIDE, in_place).select(
        c("review_id").cast("bigint").alias("review_id"),
        c("item_id").cast("bigint").alias("item_id"),
        c("user_id").cast("bigint").alias("user_id"),
        trim_spaces("username").alias("username"),
        c("score").cast("int").alias("score"),
        trim_spaces("summary").alias("summary"),
        trim_spaces("review_text").alias("review_text"),
        epoch_seconds_to_date("created_at").alias("review_date"),
        epoch_seconds_to_date("user_created_at").alias("user_created_date"),
    )


def review_dates(raw_reviews: DataFrame) -> DataFrame:
    """(review_id, review_date) of the staged reviews, without shuffling a text."""
    return _latest_usable_reviews(raw_reviews, ()).select(
        F.col("review_id").cast("bigint").alias("review_id"),
        epoch_seconds_to_date("created_at").alias("review_date"))


def stage_users(raw_users: DataFrame) -> DataFrame:
    """Users: latest load per id, non-blank name, lower-cased; epoch -> date."""
    c = F.col
    latest = keep_latest(raw_users.filter(c("user_id").isNotNull()), ["user_id"], ["loaded_at"])
    return (latest
            .filter(c("user_id").isNotNull() & c("username").isNotNull()
                    & (trim_spaces("username") != F.lit("")))
            .select(
                c("user_id").cast("bigint").alias("user_id"),
                F.lower(trim_spaces("username")).alias("username"),
                epoch_seconds_to_date("join_date").alias("join_date"),
            ))
