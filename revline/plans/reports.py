"""Reporting queries over the marts (item list, per-item and per-tag reports).

Inputs named ``scored`` are review rows that carry ``item_id``, ``score``,
``sentiment_label`` and ``sentiment_score``: either the fact joined to the
score table (``fact_join_scores``) or the fact scored in place.

Per-tag figures are additive, so rows are first reduced to one row per item
(partial aggregation before the shuffle), then joined to the item dimension
and summed per tag: the full fact never crosses the network for a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revline.functions.exact import double_to_scaled, round_half_up_scaled, scaled_to_double
from revline.functions.scalars import display_round, percent_text

LABELS = ("positive", "neutral", "negative")


def fact_join_scores(fact: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Fact INNER JOIN score table on review id (unscored reviews drop out)."""
    s = sentiment.select("review_id", "sentiment_label", "sentiment_score")
    return fact.select("review_id", "item_id", "score").join(s, "review_id")


def _label_counts(prefix: str = ""):
    lab = F.col("sentiment_label")
    return [F.count_if(lab == x).alias(f"{prefix}{x}") for x in LABELS]


def _collated(column: str, collation: str | None):
    return F.collate(F.col(column), collation) if collation else F.col(column)


def item_list(dim_item: DataFrame, collation: str | None = None) -> DataFrame:
    """Items for a picker, sorted by display title (R1).

    ``collation``: a name of Spark's, as ``UNICODE`` or ``UNICODE_CI_AI`` (any case, any
    accent) or a language, as ``sv``; by default titles are sorted by their bytes. Titles
    that are equal under it are sorted by id.
    """
    return dim_item.select(
        "item_id", "title", "title_display", "tag_primary",
        F.col("avg_score").cast("double").alias("avg_score"), "release_year",
    ).orderBy(_collated("title_display", collation), "item_id")


def item_titles(dim_item: DataFrame) -> DataFrame:
    """What a look-up by title answers, to be laid out by title."""
    return dim_item.select("item_id", "title", "title_display", "tag_primary")


def item_by_title(dim_item: DataFrame, title_display: str, collation: str | None = None) -> DataFrame:
    """First item (lowest id) whose display title equals ``title_display`` (P10), under
    ``collation`` if one is named (such a look-up reads every title).

    Any table with the columns of ``item_titles`` will do; one that is laid out by title
    is read in part.
    The single-row cut is the feature (a picker resolves a title to one id);
    ``limit(1)`` after ``orderBy`` is a top-1, not a scan of everything.
    """
    return (dim_item.filter(_collated("title_display", collation) == F.lit(title_display))
            .select("item_id", "title", "title_display", "tag_primary")
            .orderBy("item_id").limit(1))


def recs_for_item(recs: DataFrame, item_id: int) -> DataFrame:
    """One item's recommendations with short names, by rank (R2).

    A point lookup is the feature here; the recommendations underneath are
    computed for every item.
    """
    return recs.filter(F.col("source_item_id") == F.lit(int(item_id))).select(
        "rank",
        F.col("recommended_title_display").alias("title"),
        F.col("recommended_tag").alias("tag"),
        F.col("recommended_studio").alias("studio"),
        F.col("recommended_year").alias("year"),
        F.col("recommended_community_score").alias("community_score"),
        F.col("recommended_review_count").alias("reviews"),
        F.col("recommended_positive_ratio").alias("positive_ratio"),
        F.col("recommended_avg_sentiment").alias("avg_sentiment"),
        "recommendation_score",
    ).orderBy("rank")


def display_recs(recs_one_item: DataFrame) -> DataFrame:
    """Display frame of R2: percent text, 3-place score, column headers (R7).

    The headings are fixed values; the mean sentiment is not shown.
    """
    c = F.col
    return recs_one_item.select(
        c("rank").alias("Rank"), c("title").alias("Title"), c("tag").alias("Tag"),
        c("studio").alias("Studio"), c("year").alias("Year"),
        c("community_score").alias("Score"), c("reviews").alias("Reviews"),
        percent_text("positive_ratio").alias("Positive %"),
        display_round("recommendation_score", 3).alias("Rec. Score"),
    )


def sentiment_by_tag(scored: DataFrame, dim_item: DataFrame) -> DataFrame:
    """Label distribution per primary tag, biggest first (R3, also the chart frame R8)."""
    per_item = scored.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("n"), *_label_counts("n_"))
    tags = dim_item.select("item_id", "tag_primary").filter(F.col("tag_primary").isNotNull())
    j = per_item.join(tags, "item_id")
    return j.groupBy(F.col("tag_primary").alias("tag")).agg(
        F.sum("n").alias("review_count"),
        *[F.sum(f"n_{x}").alias(x) for x in LABELS],
    ).orderBy(F.col("review_count").desc(), F.col("tag"))


def _report_aggs():
    return [
        F.count(F.lit(1)).alias("total_reviews"),
        *_label_counts(),
        F.sum(F.col("score").cast("bigint")).alias("_ss"),
        F.count("score").alias("_sn"),
        F.sum(double_to_scaled(F.col("sentiment_score"), 4)).alias("_es"),
        F.count("sentiment_score").alias("_en"),
    ]


def _report_cols():
    # round(avg(score), 1) and round(avg(sentiment), 3), exactly
    avg_score = scaled_to_double(round_half_up_scaled(F.col("_ss"), F.col("_sn"), 1), 1)
    avg_sent = scaled_to_double(
        round_half_up_scaled(F.col("_es"), F.col("_en") * F.lit(10), 0), 3)
    return ["total_reviews", *LABELS, avg_score.alias("avg_score"), avg_sent.alias("avg_sentiment")]


def item_stats_all(scored: DataFrame) -> DataFrame:
    """Review and label counts and rounded means for every item (R5)."""
    return scored.groupBy("item_id").agg(*_report_aggs()).select("item_id", *_report_cols())


def stats_for_items(scored: DataFrame, first: int, last: int) -> DataFrame:
    """R5 for the items ``first`` to ``last``; of a table laid out by item, only their
    row groups are read."""
    return item_stats_all(scored.filter(F.col("item_id").between(int(first), int(last))))


def stats_for_item(scored: DataFrame, item_id: int) -> DataFrame:
    """The same figures for one item as a global aggregate: always one row,
    counts 0 and means NULL when the item has no scored review (R4)."""
    one = scored.filter(F.col("item_id") == F.lit(int(item_id)))
    return one.agg(*_report_aggs()).select(*_report_cols())
