"""Role adapters: the driver's parquet tables standing in for landed data.

* items   <- ``part``      (tags = words of ``p_name``)
* reviews <- ``lineitem``  (review id from order key and line number; the
  pair is *not* unique, which exercises the latest-row dedup)
* users   <- derived from reviews, as the landing step does
* texts   <- ``documents``

Every adapter is a pure projection of one table (no joins), so it adds no
shuffle; the payload structs are built and taken apart again inside one
projection, which Catalyst folds away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revline.functions.scalars import date_to_epoch_seconds

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def item_payloads(part: DataFrame) -> DataFrame:
    """Nested catalogue records (see ``schemas.ITEM_PAYLOAD``) from ``part``."""
    p = F.col
    studios = F.when(p("p_size") > 45, F.array().cast("array<struct<name:string>>")).otherwise(
        F.array(F.struct(p("p_brand").alias("name")),
                F.struct(F.concat(p("p_brand"), F.lit("-co")).alias("name"))))
    return part.select(
        p("p_partkey").alias("id"),
        F.struct(p("p_name").alias("native"),
                 F.when(p("p_type") != "ECONOMY", F.upper(p("p_name"))).alias("english")).alias("title"),
        F.split(p("p_name"), " ").alias("tags"),
        F.struct(studios.alias("nodes")).alias("studios"),
        p("p_size").alias("episodes"),
        (F.floor(p("p_retailprice")).cast("int") - F.lit(880)).alias("averageScore"),
        F.when(p("p_size") >= 5, F.struct((F.lit(1950) + p("p_size")).alias("year"))).alias("startDate"),
        F.concat(F.lit(" "), F.lower(p("p_type")), F.lit(" ")).alias("status"),
        F.concat_ws(" ", p("p_type"), p("p_brand")).alias("description"),
    )


def review_payloads(lineitem: DataFrame) -> DataFrame:
    """Nested review records (see ``schemas.REVIEW_PAYLOAD``) from ``lineitem``."""
    return lineitem.select(*(e.alias(c) for c, e in review_fields().items()))


def review_fields() -> dict[str, Column]:
    """Fields of a review record as expressions over ``lineitem``.

    The body repeats a tone word ``l_linenumber`` times (from the return
    flag) and adds a second one (from the line status), so a lexicon scorer
    sees positive, negative, mixed and neutral texts; ``l_tax = 0`` gives a
    blank body and ``l_tax >= 0.08`` a review without a user.
    """
    c = F.col
    word1 = (F.when(c("l_returnflag") == "A", F.lit("good"))
             .when(c("l_returnflag") == "R", F.lit("bad")).otherwise(F.lit("okay")))
    word2 = F.when(c("l_linestatus") == "F", F.lit("great")).otherwise(F.lit("poor"))
    body = F.when(c("l_tax") == 0, F.lit("  ")).otherwise(F.concat(
        F.lit(" "), F.repeat(F.concat(word1, F.lit(" ")), c("l_linenumber")), word2,
        F.lit(" order "), c("l_orderkey").cast("string"), F.lit(" ")))
    name = F.concat(F.lit(" Reviewer#"), c("l_suppkey").cast("string"), F.lit(" "))
    user = F.when(c("l_tax") < 0.08, F.struct(
        c("l_suppkey").alias("id"),
        F.when(c("l_returnflag") == "R", F.upper(name)).otherwise(name).alias("name"),
        ((F.lit(8766) + c("l_suppkey")) * F.lit(86400)).alias("createdAt"),
    ))
    return {
        "id": c("l_orderkey") * 8 + c("l_linenumber"),
        "itemId": c("l_partkey"),
        "user": user,
        "score": c("l_quantity").cast("int") * 2 + c("l_linenumber") - 4,
        "summary": F.concat(c("l_returnflag"), F.lit("/"), c("l_linestatus")),
        "body": body,
        "createdAt": date_to_epoch_seconds(c("l_shipdate")) + c("l_linenumber") * 3600,
        # ingest time of the row; used by the latest-row dedup in staging
        "_loaded_at": c("l_shipdate").cast("timestamp"),
    }


def raw_items(part: DataFrame) -> DataFrame:
    from revline.sources.landing import flatten_items, load_items
    return load_items(flatten_items(item_payloads(part)), keep_first_by=None)


def raw_reviews(lineitem: DataFrame) -> DataFrame:
    """Flat reviews as landed, duplicates kept; ``loaded_at`` = ship date."""
    from revline.sources.landing import flatten_reviews
    payload = review_payloads(lineitem)
    flat = flatten_reviews(payload, extra=["_loaded_at"])
    return flat.withColumnRenamed("_loaded_at", "loaded_at")


def raw_users(lineitem: DataFrame) -> DataFrame:
    """Users derived from reviews (first seen in ingest order), as landed."""
    from revline.sources.landing import flatten_reviews, users_from_reviews
    flat = flatten_reviews(review_payloads(lineitem))
    users = users_from_reviews(flat, order_by=["created_at", "review_id"], by_lead=True)
    return users.withColumn("loaded_at", F.lit(None).cast("timestamp"))
