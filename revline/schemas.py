"""Fixed schemas. JSON is always read with one of these, never inferred.

Ids are BIGINT throughout (the source system used INTEGER; at the target
scale ids outgrow 32 bits, so we widen instead of failing on overflow).
"""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the landed and raw records.

# --- nested payloads as landed from the catalogue API -----------------------

ITEM_PAYLOAD = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StructType([
        T.StructField("native", T.StringType()),
        T.StructField("english", T.StringType()),
    ])),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("studios", T.StructType([
        T.StructField("nodes", T.ArrayType(T.StructType([
            T.StructField("name", T.StringType()),
        ]))),
    ])),
    T.StructField("episodes", T.IntegerType()),
    T.StructField("averageScore", T.IntegerType()),
    T.StructField("startDate", T.StructType([T.StructField("year", T.IntegerType())])),
    T.StructField("status", T.StringType()),
    T.StructField("description", T.StringType()),
])

REVIEW_PAYLOAD = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("itemId", T.LongType()),
    T.StructField("user", T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("createdAt", T.LongType()),
    ])),
    T.StructField("score", T.IntegerType()),
    T.StructField("summary", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("createdAt", T.LongType()),
])

# --- flat records (one per landed entity) ------------------------------------

FLAT_ITEM = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("title_native", T.StringType()),
    T.StructField("title_english", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("studio", T.StringType()),
    T.StructField("episodes", T.IntegerType()),
    T.StructField("avg_score", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("description", T.StringType()),
])

FLAT_REVIEW = T.StructType([
    T.StructField("review_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("user_created_at", T.LongType()),
    T.StructField("score", T.IntegerType()),
    T.StructField("summary", T.StringType()),
    T.StructField("review_text", T.StringType()),
    T.StructField("created_at", T.LongType()),
])

# What a snapshot may hold: nested payloads or flat records, one layout a record.
def _either(nested: T.StructType, flat: T.StructType) -> T.StructType:
    return T.StructType(nested.fields + [f for f in flat.fields if f.name not in nested.fieldNames()])


LANDED_ITEM = _either(ITEM_PAYLOAD, FLAT_ITEM)
LANDED_REVIEW = _either(REVIEW_PAYLOAD, FLAT_REVIEW)

FLAT_USER = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("join_date", T.LongType()),
])

# --- raw tables (flat record + load stamp) -----------------------------------

RAW_ITEMS = T.StructType([
    T.StructField("item_id", T.LongType(), False),
    T.StructField("title_native", T.StringType()),
    T.StructField("title_english", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("studio", T.StringType()),
    T.StructField("episodes", T.IntegerType()),
    T.StructField("avg_score", T.DecimalType(5, 2)),
    T.StructField("year", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("loaded_at", T.TimestampType()),
])

RAW_REVIEWS = T.StructType(
    [T.StructField("review_id", T.LongType(), False)]
    + [f for f in FLAT_REVIEW.fields if f.name != "review_id"]
    + [T.StructField("loaded_at", T.TimestampType())]
)

RAW_USERS = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("username", T.StringType()),
    T.StructField("join_date", T.LongType()),
    T.StructField("loaded_at", T.TimestampType()),
])
