"""Top-N overall and newest-k per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, n: int, order_by: Sequence[Column]) -> DataFrame:
    """First ``n`` rows in a total order (TakeOrderedAndProject: per-partition
    top-n, then one merge of n rows per partition)."""
    return df.orderBy(*order_by).limit(n)


def top_items(items: DataFrame, n: int, status_col: str = "status", status: str = "FINISHED",
              score_col: str = "avg_score", id_col: str = "item_id") -> DataFrame:
    """Finished items, best score first (id breaks ties), first ``n``."""
    return top_n(items.filter(F.col(status_col) == status), n,
                 [F.col(score_col).desc_nulls_last(), F.col(id_col).asc()])


def newest_k(df: DataFrame, group_cols: Sequence[str], order_by: Sequence[Column], k: int,
             rank_col: str | None = None) -> DataFrame:
    """``k`` first rows per group in ``order_by`` order.

    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so a hot group sends at most k rows per map partition.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order_by)
    rn = "__rn" if rank_col is None else rank_col
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= k)
    return out.drop(rn) if rank_col is None else out.withColumn(rn, F.col(rn).cast("bigint"))
