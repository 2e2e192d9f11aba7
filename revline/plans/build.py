"""Compose the whole model graph lazily from three raw tables.

``ReviewMarts`` is the batch job as a set of DataFrames: staging views,
dimensions, the fact, the score table, per-item stats and recommendations.
Sentiment is built *between* the fact and the recommendations, so a first
run needs no previous score table.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revline.operators import recommend as rec
from revline.operators.sentiment import ScorerFactory, append_scores
from revline.plans import marts, reports, staging
from revline.session import write_scratch
from revline.sources import testdata


RawInput = DataFrame | Callable[[], DataFrame]


class ReviewMarts:
    """The model graph; raw inputs are frames or zero-argument builders (a
    builder runs only when a model that needs it is asked for)."""

    def __init__(self, raw_items: RawInput, raw_reviews: RawInput, raw_users: RawInput,
                 scorer: ScorerFactory | None = None, as_of: str | _dt.date | None = None,
                 k: int = 10, min_reviews: int = 2, buffer_days: int = 7,
                 sentiment: DataFrame | None = None, materialize: bool = False):
        self._raw = {"items": raw_items, "reviews": raw_reviews, "users": raw_users}
        self.scorer = scorer
        self.as_of = as_of
        self.k = k
        self.min_reviews = min_reviews
        self.buffer_days = buffer_days
        self._sentiment = sentiment
        self.materialize = materialize

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a model that several consumers read (materialize mode).

        Like a mart table: computed once into the shared scratch folder, then
        read by every consumer with column pruning; also cuts the lineage, so
        a lost executor never re-runs the upstream.
        """
        return write_scratch(df, name) if self.materialize else df

    def _raw_frame(self, name: str) -> DataFrame:
        x = self._raw[name]
        if callable(x):
            x = self._raw[name] = x()
        return x

    @property
    def raw_items(self) -> DataFrame:
        return self._raw_frame("items")

    @property
    def raw_reviews(self) -> DataFrame:
        return self._raw_frame("reviews")

    @property
    def raw_users(self) -> DataFrame:
        return self._raw_frame("users")

    @property
    def spark(self) -> SparkSession:
        return self.raw_reviews.sparkSession

    # staging
    @cached_property
    def stg_items(self) -> DataFrame:
        return staging.stage_items(self.raw_items)

    @cached_property
    def stg_reviews(self) -> DataFrame:
        return self._keep(staging.stage_reviews(self.raw_reviews), "stg-reviews")

    @cached_property
    def stg_users(self) -> DataFrame:
        return self._keep(staging.stage_users(self.raw_users), "stg-users")

    # marts
    @cached_property
    def dim_item(self) -> DataFrame:
        return marts.dim_item(self.stg_items)

    @cached_property
    def dim_user(self) -> DataFrame:
        return marts.dim_user(self.stg_users, self.as_of)

    @cached_property
    def dim_date(self) -> DataFrame:
        dated = self.stg_reviews if self.materialize else staging.review_dates(self.raw_reviews)
        return marts.dim_date(dated, self.buffer_days)

    @cached_property
    def fact_reviews(self) -> DataFrame:
        return marts.fact_reviews(self.stg_reviews)

    @cached_property
    def sentiment(self) -> DataFrame:
        """The score table; computed in place it is a projection of the scored
        fact (same texts, same scorer), so the texts are scored once."""
        if self._sentiment is not None:
            return self._sentiment
        return self.scored_fact.select("review_id", "sentiment_label", "sentiment_score")

    @cached_property
    def scored_fact(self) -> DataFrame:
        """Fact rows with their scores, computed in place (no self-join)."""
        f = self.fact_reviews.select(
            "review_id", "item_id", "score",
            F.coalesce(F.col("review_text"), F.col("summary"), F.lit("")).alias("text"))
        return self._keep(append_scores(f, "text", self.scorer), "scored-fact")

    @cached_property
    def scored(self) -> DataFrame:
        """(review_id, item_id, score, sentiment_label, sentiment_score) rows."""
        if self._sentiment is not None:
            return reports.fact_join_scores(self.fact_reviews, self._sentiment)
        return self.scored_fact

    def models(self) -> dict[str, DataFrame]:
        """Every table of the graph by name (inputs of the data-quality suite)."""
        return {
            "raw_items": self.raw_items, "raw_reviews": self.raw_reviews, "raw_users": self.raw_users,
            "stg_items": self.stg_items, "stg_reviews": self.stg_reviews, "stg_users": self.stg_users,
            "dim_item": self.dim_item, "dim_user": self.dim_user, "dim_date": self.dim_date,
            "fact_reviews": self.fact_reviews, "sentiment": self.sentiment,
            "recommendations": self.recommendations,
        }

    def stats_with_min(self, min_reviews: int | None) -> DataFrame:
        if self._sentiment is not None:
            return rec.item_sentiment_stats(self.fact_reviews, self._sentiment, min_reviews)
        return rec.stats_from_scored(self.scored_fact, min_reviews)

    @cached_property
    def stats(self) -> DataFrame:
        return self.stats_with_min(self.min_reviews)

    @cached_property
    def items_with_stats(self) -> DataFrame:
        return rec.items_with_stats(self.dim_item, self.stats)

    @cached_property
    def recommendations(self) -> DataFrame:
        return self._keep(rec.recommend(self.dim_item, self.stats, self.k), "recommendations")

    @cached_property
    def shortlisted_pairs(self) -> DataFrame:
        return rec.shortlisted_pairs(self.dim_item, self.stats, self.k)


def from_testdata(spark: SparkSession, sf_dir: str, **kw) -> ReviewMarts:
    """The model graph over the driver tables (items=part, reviews=lineitem)."""
    def table(name: str) -> DataFrame:
        return testdata.table(spark, sf_dir, name)

    kw.setdefault("as_of", "2002-01-01")
    return ReviewMarts(lambda: testdata.raw_items(table("part")),
                       lambda: testdata.raw_reviews(table("lineitem")),
                       lambda: testdata.raw_users(table("lineitem")), **kw)
