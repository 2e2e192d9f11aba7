"""SQL over the marts: register them as views, run SQL text with bound args.

The dashboard of the source system ran SQL strings against its marts; here
the same text runs through ``spark.sql`` with named parameters, so values
are bound (``:item_id``), never pasted into the text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from revline.plans.build import ReviewMarts


def register_views(marts: ReviewMarts, prefix: str = "",
                   names: Sequence[str] = ("scored_reviews",)) -> list[str]:
    """Expose the named models as temp views. Only these are built: asking for
    ``recommendations`` runs jobs, asking for the others runs none."""
    for name in names:
        df = marts.scored if name == "scored_reviews" else getattr(marts, name)
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in names]


def run_sql(spark: SparkSession, sql: str, integers: Sequence[str] = (), **args) -> DataFrame:
    """``spark.sql`` with named parameters, bound with the types they have.

    Arguments named in ``integers`` are converted first (a form field that is
    known to hold an id); nothing is guessed from how a value looks.
    """
    return spark.sql(sql, args={k: int(v) if k in integers else v for k, v in args.items()})


# The per-item stats report as SQL text (R4), exact rounding as in the
# DataFrame version.
STATS_FOR_ITEM_SQL = """
SELECT count(*) AS total_reviews,
       count_if(sentiment_label = 'positive') AS positive,
       count_if(sentiment_label = 'neutral') AS neutral,
       count_if(sentiment_label = 'negative') AS negative,
       CAST((2 * sum(CAST(score AS BIGINT)) * 10 + count(score)) div nullif(2 * count(score), 0) AS DOUBLE) / 10
           AS avg_score,
       CAST((2 * sum(CAST(round(sentiment_score * 10000) AS BIGINT)) + 10 * count(sentiment_score))
            div nullif(20 * count(sentiment_score), 0) AS DOUBLE) / 1000 AS avg_sentiment
FROM {view}
WHERE item_id = :item_id
"""
