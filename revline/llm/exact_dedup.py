"""Exact deduplication by skew-safe combining.

Equal texts are collapsed in three steps, each grouping on the *full text*
next to its digest, so that a digest collision can never merge two texts:

1. locally, in the map task (partial aggregation),
2. per (digest, salt): a digest with many copies is spread over salts, their
   number derived from its counted rows,
3. per digest: the few salt winners are combined.

The member rows then look up their class by digest. Should two different texts
ever share a digest, those (and only those) rows look it up by full text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revline.llm.names import fresh
from revline.session import write_scratch

#: a digest is hot when it holds more than one row in this many (and more than
#: fill one salt); so there are fewer hot digests than this, and broadcasting
#: them takes a few MB whatever the size of the input
HOT_SHARE = 100_000
#: rows of a hot digest per salt
ROWS_PER_SALT = 1000


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def _with_salt(df: DataFrame, hot: DataFrame) -> DataFrame:
    """``hot`` has fewer than HOT_SHARE rows by construction, so it is broadcast."""
    return (df.join(F.broadcast(hot), "_d", "left")
              .withColumn("_salt", F.coalesce(
                  F.pmod(F.xxhash64("_id"), F.col("_salts")), F.lit(0))))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """One row per input row: its id, digest and the class of its exact text.

    Columns: ``id_col``, ``keep_id`` (largest id among the equal texts),
    ``group_size`` (rows with this text), ``kept`` (this id is keep_id),
    ``text_sha256`` (the digest, SHA-256 unless another is given).

    Defined cases: a null text equals the empty text. A null id sorts below
    every other id, and a class of null ids only keeps null. Rows repeated with
    the same id and text count towards group_size and all say kept. Other
    columns are ignored, so clashing names do no harm. No rows give no rows.
    """
    base = docs.select(F.col(id_col).alias("_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    base = base.withColumn("_d", digest(F.col("_text")))

    ids = write_scratch(base.select("_id", "_d"), "exact-ids")
    per_digest = ids.groupBy("_d").agg(F.count(F.lit(1)).alias("_rows"))
    limit = max(ids.count() // HOT_SHARE, ROWS_PER_SALT)
    hot = write_scratch(
        per_digest.where(F.col("_rows") > limit)
                  .select("_d", F.ceil(F.col("_rows") / ROWS_PER_SALT).alias("_salts")),
        "exact-hot")

    # steps 1 and 2: the partial aggregate is the local one
    salted = (_with_salt(base, hot)
              .groupBy("_d", "_salt", "_text")
              .agg(F.max("_id").alias("_id"), F.count(F.lit(1)).alias("_rows"),
                   F.max(F.col("_salts").isNotNull()).alias("_hot")))
    # step 3: one salt means the salt winner is the winner
    cold = salted.where(~F.col("_hot"))
    warm = (salted.where("_hot").groupBy("_d", "_text")
            .agg(F.max("_id").alias("_id"), F.sum("_rows").alias("_rows")))
    winners = cold.select("_d", "_text", "_id", "_rows").unionByName(warm)
    classes = write_scratch(
        winners.groupBy("_d").agg(F.count(F.lit(1)).alias("_texts"),
                                  F.max("_id").alias("_keep"),
                                  F.max("_rows").alias("_size")),
        "exact-classes")
    found = (_members(ids.join(F.broadcast(hot), "_d", "left_anti"),
                      classes.where("_texts = 1"))
             .unionByName(_members(ids.join(F.broadcast(hot), "_d", "left_semi"),
                                   F.broadcast(classes.where("_texts = 1")
                                               .join(F.broadcast(hot), "_d", "left_semi")))))
    shared = classes.where("_texts > 1").select("_d")
    if not shared.isEmpty():
        whole = (winners.join(shared, "_d", "left_semi")
                 .select("_d", "_text", F.col("_id").alias("_keep"),
                         F.col("_rows").alias("_size")))
        found = found.unionByName(
            base.join(shared, "_d", "left_semi").join(whole, ["_d", "_text"])
                .select("_id", "_d", "_keep", "_size"))
    return found.select(
        F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.col("_d").alias("text_sha256"))


def _members(ids: DataFrame, classes: DataFrame) -> DataFrame:
    return ids.join(classes, "_d").select("_id", "_d", "_keep", "_size")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns: one for each exact text.

    Of rows that repeat the kept id with the same text one stays.
    """
    id_name, digest = fresh(docs, "keep"), fresh(docs, "digest")
    kept = write_scratch(exact_groups(docs, id_col, text_col).where("kept")
                         .groupBy(F.col("keep_id").alias(id_name),
                                  F.col("text_sha256").alias(digest))
                         .agg(F.count(F.lit(1)).alias("_rows")), "exact-kept")
    keep = kept.select(id_name, F.col(digest).alias("_other"))
    marked = docs.withColumn(digest, sha256_hex(F.coalesce(F.col(text_col), F.lit(""))))
    left = marked.join(keep, (marked[digest] == keep["_other"])
                       & marked[id_col].eqNullSafe(keep[id_name]), "left_semi")
    if not kept.where("_rows > 1").isEmpty():
        left = left.dropDuplicates([id_col, digest])
    return left.drop(digest)
