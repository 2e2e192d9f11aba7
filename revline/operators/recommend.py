"""Content-based top-k recommendations from shared tags and review sentiment.

Per item: review count, label counts, positive ratio (4 places), mean
sentiment (4 places) and mean review score (2 places), for items with at
least ``min_reviews`` scored reviews. A target's score is
``round(0.6 * positive_ratio + 0.4 * community_score / 100, 4)``; for each
source item the k best targets sharing at least one tag are kept, ranked by
(score DESC NULLS FIRST, review count DESC, target id ASC).

Scale design — no all-pairs step. The score and both sort keys depend on
the *target* only, so a target in a source's top k is among the best k+1 of
one of their shared tags (k+1: the source itself may take a slot). Hence:

1. explode distinct tags of every scored item;
2. keep the best k+1 items per tag (``row_number <= k+1``: a partial
   WindowGroupLimit runs before the shuffle, so a tag holding a third of all
   items sends at most k+1 rows per map partition);
3. join every (source, tag) with that shortlist on (tag, salt), where a hot tag
   has salts in proportion to its share, in as many tasks as the pairs need (not
   as few as its small input would get); drop self-matches; deal the pairs by
   source to as many tasks again, dedup (source, target), rank, cut at k;
4. only then join the k rows of each source to titles and other attributes: the
   source's where the rows are, the target's from the shortlisted items alone, for
   a few targets are recommended to most sources.

Steps 2 and 3 carry ids, the score and the review count only (fixed-width
numbers), so the plan is the same at every size and the dedup is a hash
aggregate. Work is linear in (items x tags x k) instead of quadratic per tag.
All rounding is exact integer arithmetic (see ``functions.exact``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revline.functions.exact import (
    double_to_scaled,
    round_half_up_scaled,
    scaled_to_double,
    weighted_score_scaled,
)
from revline.session import write_scratch

# a tag is hot when it has more than this share of all (item, tag) rows; it is
# split so that each salt has about this share
HOT_TAG_FRACTION = 0.001

# a task of the tag join makes, and one of the ranking reads, about so many pairs
# (tens of bytes each in its hash table)
PAIRS_PER_TASK = 1_000_000

# shortlisted items are broadcast up to so many bytes (as texts, and 16 a row and column)
TARGET_BYTES = 32 << 20


def _signed_round(num, den, digits):
    """Half away from zero for either sign of ``num``."""
    mag = round_half_up_scaled(F.abs(num), den, digits)
    return F.when(num < 0, -mag).otherwise(mag)


def item_sentiment_stats(fact: DataFrame, sentiment: DataFrame, min_reviews: int | None = 2,
                         item_col: str = "item_id") -> DataFrame:
    """Per-item review/sentiment statistics over fact INNER JOIN scores.

    Aggregates are sums and counts only, so they combine map-side before the
    shuffle on the item key; a hot item costs no more than a cold one.
    """
    f = fact.select("review_id", item_col, "score")
    s = sentiment.select("review_id", "sentiment_label", "sentiment_score")
    return stats_from_scored(f.join(s, "review_id"), min_reviews, item_col)


def stats_from_scored(scored: DataFrame, min_reviews: int | None = 2,
                      item_col: str = "item_id") -> DataFrame:
    """Same statistics from rows that already carry their label and score.

    Used when the scores are computed inside the same plan: scoring is a
    per-row projection of the fact, so joining the fact back to its own
    scores would only add a shuffle of the largest table.
    """
    lab = F.col("sentiment_label")
    agg = scored.groupBy(item_col).agg(
        F.count(F.lit(1)).alias("review_count"),
        F.count_if(lab == "positive").alias("positive_count"),
        F.count_if(lab == "negative").alias("negative_count"),
        F.count_if(lab == "neutral").alias("neutral_count"),
        F.sum(double_to_scaled(F.col("sentiment_score"), 4)).alias("_sent_sum_e4"),
        F.count("sentiment_score").alias("_sent_n"),
        F.sum(F.col("score").cast("bigint")).alias("_score_sum"),
        F.count("score").alias("_score_n"),
    )
    if min_reviews is not None:
        agg = agg.filter(F.col("review_count") >= min_reviews)
    ratio_e4 = round_half_up_scaled(F.col("positive_count"), F.col("review_count"), 4)
    sent_e4 = _signed_round(F.col("_sent_sum_e4"), F.col("_sent_n"), 0)
    score_e2 = _signed_round(F.col("_score_sum"), F.col("_score_n"), 2)
    return agg.select(
        F.col(item_col), "review_count", "positive_count", "negative_count", "neutral_count",
        ratio_e4.alias("positive_ratio_e4"),
        scaled_to_double(ratio_e4, 4).alias("positive_ratio"),
        scaled_to_double(sent_e4, 4).alias("avg_sentiment_score"),
        scaled_to_double(score_e2, 2).alias("avg_review_score"),
    )


def items_with_stats(dim_items: DataFrame, stats: DataFrame) -> DataFrame:
    """Item attributes + stats (inner: unscored and thin items drop out) and
    the exact target score ``score_e4``."""
    a = dim_items.select(
        "item_id", "title", "title_display", "tags", "tag_primary",
        F.col("avg_score").alias("community_score"), "release_year", "studio")
    j = a.join(stats, "item_id")
    community_e2 = (F.col("community_score") * 100).cast("bigint")
    return j.withColumn("score_e4", weighted_score_scaled(F.col("positive_ratio_e4"), community_e2))


def _target_order(prefix: str = ""):
    return [F.col(f"{prefix}score_e4").desc_nulls_first(),
            F.col(f"{prefix}review_count").desc(),
            F.col(f"{prefix}item_id").asc()]


def tag_members(iws: DataFrame) -> DataFrame:
    """(item, tag) for every distinct tag of a scored item; empty/NULL -> none."""
    return iws.select("*", F.explode(F.array_distinct("tags")).alias("tag"))


def tag_shortlist(iws: DataFrame, k: int) -> DataFrame:
    """Best ``k + 1`` items per tag: (tag, t_item_id, t_score_e4, t_review_count)."""
    w = Window.partitionBy("tag").orderBy(*_target_order())
    members = tag_members(iws.select("item_id", "tags", "score_e4", "review_count"))
    return (members.withColumn("_pos", F.row_number().over(w))
            .filter(F.col("_pos") <= k + 1)
            .select("tag", *[F.col(c).alias(f"t_{c}") for c in ("item_id", "score_e4", "review_count")]))


def _tag_counts(iws: DataFrame) -> DataFrame:
    return (tag_members(iws.select("item_id", "tags")).groupBy("tag")
            .agg(F.count(F.lit(1)).alias("n")))


def membership_count(iws: DataFrame) -> int:
    """(item, tag) memberships: one aggregate over the (materialised) scored items."""
    return _tag_counts(iws).agg(F.sum("n")).first()[0] or 0


def hot_tags(iws: DataFrame, fraction: float = HOT_TAG_FRACTION, *,
             total: int | None = None) -> dict[str, int]:
    """Tags holding more than ``fraction`` of all (item, tag) memberships, and
    into how many salts each is split.

    At most ``1 / fraction`` tags can qualify, so the list sent to the driver
    is bounded; an aggregate over the (materialised) scored items, and another
    where their ``total`` is not given.
    """
    total = membership_count(iws) if total is None else total
    limit = max(1, int(total * fraction))
    return {r["tag"]: -(-r["n"] // limit)
            for r in _tag_counts(iws).filter(F.col("n") > limit).collect()}


def pair_tasks(memberships: int, k: int) -> int:
    """Tasks of the tag join: each membership meets ``k + 1`` targets at most."""
    return max(1, -(-memberships * (k + 1) // PAIRS_PER_TASK))


def _joined_pairs(iws: DataFrame, k: int, total: int) -> DataFrame:
    """(source, target) pairs that can reach a source's top k, once per tag that
    they share, with the target's score and review count.

    Sources of a hot tag get a salt from their id; the tag's shortlist (at
    most k+1 rows) is copied once per salt, so every source still meets every
    shortlisted target exactly once. Other tags have one salt (no copies).

    The join's inputs are small next to the pairs that it makes: both are dealt to
    a number of tasks that follows the pairs, which adaptive execution leaves alone.
    Neither is broadcast: the sources' files are far smaller than their rows.
    """
    tasks = pair_tasks(total, k)
    hot = hot_tags(iws, total=total)
    salts = F.lit(1)
    if hot:
        of_tag = F.create_map(*[F.lit(x) for item in hot.items() for x in item])
        salts = F.coalesce(of_tag[F.col("tag")], F.lit(1))
    src = tag_members(iws.select("item_id", "tags")).select(
        F.col("item_id").alias("source_item_id"), "tag",
        F.pmod(F.xxhash64("item_id"), salts).cast("int").alias("_salt"))
    short = tag_shortlist(iws, k).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), (salts - 1).cast("int"))))
    on = ["tag", "_salt"]
    return (src.repartition(tasks, *on).join(short.repartition(tasks, *on).hint("merge"), on)
            .filter(F.col("t_item_id") != F.col("source_item_id"))
            .select("source_item_id", "t_item_id", "t_score_e4", "t_review_count"))


def _distinct_pairs(pairs: DataFrame) -> DataFrame:
    """Every copy of a pair has the same numbers."""
    return pairs.groupBy("source_item_id", "t_item_id").agg(
        F.max("t_score_e4").alias("t_score_e4"), F.max("t_review_count").alias("t_review_count"))


def candidate_pairs(iws: DataFrame, k: int) -> DataFrame:
    """The pairs of the tag join, deduplicated."""
    # the pair key spreads a source with a huge tag list over many tasks and
    # combines duplicates map-side
    return _distinct_pairs(_joined_pairs(iws, k, membership_count(iws)))


_TARGET = ("item_id", "title", "title_display", "tag_primary", "studio", "release_year",
           "community_score", "review_count", "positive_ratio", "avg_sentiment_score",
           "avg_review_score", "score_e4")


def _targets(iws: DataFrame, k: int) -> DataFrame:
    """Attributes of the items that are shortlisted for any tag, k+1 a tag at most.

    Ranked rows crowd on the best of them, and by their ids would crowd in a task;
    the attributes are sent to the rows instead, as long as they are small.
    """
    short = tag_shortlist(iws, k).select(F.col("t_item_id").alias("item_id")).distinct()
    found = write_scratch(iws.select(*_TARGET).join(short, "item_id", "left_semi"), "targets")
    width = F.lit(16 * len(_TARGET))
    for c in ("title", "title_display", "tag_primary", "studio"):
        width = width + F.coalesce(F.octet_length(c), F.lit(0))
    size = found.agg(F.sum(width)).first()[0] or 0
    out = found.select(*[F.col(c).alias(f"t_{c}") for c in _TARGET])
    # many targets: adaptive execution splits those partitions that are far above others
    return F.broadcast(out) if size <= TARGET_BYTES else out.hint("merge")


def rank_candidates(pairs: DataFrame, iws: DataFrame, k: int, tasks: int) -> DataFrame:
    """Rank the distinct targets within each source, keep the top k, then look up
    the attributes of source and target (16 output columns).

    The pairs, repeated or not, are dealt by source to ``tasks`` tasks: dedup, rank
    and the source's attributes need no other shuffle."""
    w = Window.partitionBy("source_item_id").orderBy(*_target_order("t_"))
    dealt = _distinct_pairs(pairs.repartition(tasks, "source_item_id"))
    ranked = (dealt.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
              .select("source_item_id", "t_item_id", "rank"))
    source = iws.select(F.col("item_id").alias("source_item_id"),
                        F.col("title").alias("source_title"), F.col("tag_primary").alias("source_tag"))
    source = source.repartition(tasks, "source_item_id").hint("merge")
    return ranked.join(source, "source_item_id").join(_targets(iws, k), "t_item_id").select(
        "source_item_id", "source_title", "source_tag",
        F.col("t_item_id").alias("recommended_item_id"),
        F.col("t_title").alias("recommended_title"),
        F.col("t_title_display").alias("recommended_title_display"),
        F.col("t_tag_primary").alias("recommended_tag"),
        F.col("t_studio").alias("recommended_studio"),
        F.col("t_release_year").alias("recommended_year"),
        F.col("t_community_score").cast("double").alias("recommended_community_score"),
        F.col("t_review_count").alias("recommended_review_count"),
        F.col("t_positive_ratio").alias("recommended_positive_ratio"),
        F.col("t_avg_sentiment_score").alias("recommended_avg_sentiment"),
        F.col("t_avg_review_score").alias("recommended_avg_review_score"),
        scaled_to_double(F.col("t_score_e4"), 4).alias("recommendation_score"),
        F.col("rank").cast("bigint").alias("rank"),
    )


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Used for the item table with stats, which feeds the hot-tag counts, both
    sides of the tag join and the attribute look-ups: without it each would
    recompute the whole review aggregation. The files are columnar, so every
    reader takes only its columns, and outlive a lost executor.
    """
    return write_scratch(df, "items-with-stats")


def recommend(dim_items: DataFrame, stats: DataFrame, k: int = 10) -> DataFrame:
    """Top-k recommendations for every scored item (see module docstring)."""
    iws = materialize(items_with_stats(dim_items, stats))
    total = membership_count(iws)
    return rank_candidates(_joined_pairs(iws, k, total), iws, k, pair_tasks(total, k))


def shortlisted_pairs(dim_items: DataFrame, stats: DataFrame, k: int = 10) -> DataFrame:
    """The (source, target) candidates of step 3 with the target's score: not
    all pairs with a common tag, only those that can reach a top k."""
    iws = materialize(items_with_stats(dim_items, stats))
    return candidate_pairs(iws, k).select(
        "source_item_id", F.col("t_item_id").alias("recommended_item_id"),
        F.col("t_review_count").alias("recommended_review_count"),
        scaled_to_double(F.col("t_score_e4"), 4).alias("recommendation_score"))
