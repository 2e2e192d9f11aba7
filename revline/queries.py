"""Query catalogue over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry runs a library operator on whole tables (role mapping in
``revline.sources.testdata``). Arrays are rendered as ``'|'``-joined text
and decimals as doubles at this boundary only, so results compare
value-for-value with the DuckDB oracles in ``revline.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revline.operators import quality
from revline.operators import sentiment as sent
from revline.operators.dedup import keep_first, keep_latest, task_count
from revline.operators.topk import newest_k, top_items
from revline.plans import reports
from revline.plans.build import ReviewMarts, from_testdata
from revline.plans.pipeline import PipelineConfig, run_pipeline
from revline.schemas import ITEM_PAYLOAD, LANDED_ITEM, LANDED_REVIEW, REVIEW_PAYLOAD
from revline.session import dropping_shuffles, scratch_path, write_scratch
from revline.sources import files, landing, testdata
from revline.sources.json_array import read_json_array
from revline.sources.result_cache import ResultCache
from revline.sources.warehouse import Warehouse, bucket_count

def _marts(spark: SparkSession, sf: str, **kw) -> ReviewMarts:
    return from_testdata(spark, sf, **kw)


def _flat(df: DataFrame) -> DataFrame:
    """Arrays -> '|'-joined text, decimals -> double (comparison boundary)."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if t.startswith("array"):
            out.append(F.array_join(F.col(f.name), "|").alias(f.name))
        elif t.startswith("decimal"):
            out.append(F.col(f.name).cast("double").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# --- staging and marts --------------------------------------------------------

def q_stage_items(spark, sf):
    return _flat(_marts(spark, sf).stg_items)


def q_stage_reviews(spark, sf):
    return _marts(spark, sf).stg_reviews


def q_stage_users(spark, sf):
    return _marts(spark, sf).stg_users


def q_dim_item(spark, sf):
    return _flat(_marts(spark, sf).dim_item)


def q_dim_user(spark, sf):
    return _marts(spark, sf).dim_user


def q_dim_date(spark, sf):
    return _marts(spark, sf).dim_date


def q_fact_reviews(spark, sf):
    return _marts(spark, sf).fact_reviews


# --- sentiment and recommendations ----------------------------------------------

def q_sentiment_reviews(spark, sf):
    """Score table of the review fact (JVM lexicon path)."""
    return _marts(spark, sf).sentiment


def q_item_sentiment_stats(spark, sf):
    return _marts(spark, sf).stats.drop("positive_ratio_e4")


def q_item_sentiment_stats_min30(spark, sf):
    return _marts(spark, sf).stats_with_min(30).drop("positive_ratio_e4")


def q_candidate_pairs(spark, sf):
    """Candidates of the pruned plan (not all pairs with a common tag)."""
    return _marts(spark, sf).shortlisted_pairs


def q_recommendations(spark, sf):
    return _marts(spark, sf).recommendations


def q_recommendations_min30(spark, sf):
    return _marts(spark, sf, min_reviews=30).recommendations


CATALOGUE = {
    "q_stage_items": q_stage_items,
    "q_stage_reviews": q_stage_reviews,
    "q_stage_users": q_stage_users,
    "q_dim_item": q_dim_item,
    "q_dim_user": q_dim_user,
    "q_dim_date": q_dim_date,
    "q_fact_reviews": q_fact_reviews,
    "q_sentiment_reviews": q_sentiment_reviews,
    "q_item_sentiment_stats": q_item_sentiment_stats,
    "q_item_sentiment_stats_min30": q_item_sentiment_stats_min30,
    "q_candidate_pairs": q_candidate_pairs,
    "q_recommendations": q_recommendations,
    "q_recommendations_min30": q_recommendations_min30,
}


# --- reports ------------------------------------------------------------------------


LOOKUP_ITEM = 7          # point lookups (R2, R4) on one item: the lookup is the feature
MISSING_ITEM = -1        # an id without rows: R4 still answers one row


def q_item_list(spark, sf):
    return reports.item_list(_marts(spark, sf).dim_item)


def _written_recommendations(spark, sf):
    """The mart as the batch job stores it: ordered by source item, so that a
    look-up reads the row groups of one item only."""
    recs = _marts(spark, sf).recommendations
    return write_scratch(recs.orderBy("source_item_id", "rank"), "recommendations")


def q_recs_for_item(spark, sf):
    return reports.recs_for_item(_written_recommendations(spark, sf), LOOKUP_ITEM)


def q_display_recs(spark, sf):
    return reports.display_recs(reports.recs_for_item(_written_recommendations(spark, sf), LOOKUP_ITEM))


def q_export_recommendations(spark, sf):
    """The full recommendation export (R6): written as CSV, read back."""
    recs = _marts(spark, sf).recommendations
    path = scratch_path(spark, "export") + "/recommendations"
    files.export_csv(recs, path)
    return files.read_csv(spark, path, recs.schema)


def q_sentiment_by_tag(spark, sf):
    m = _marts(spark, sf)
    return reports.sentiment_by_tag(m.scored, m.dim_item)


def q_item_stats_all(spark, sf):
    return reports.item_stats_all(_marts(spark, sf).scored)


def q_stats_for_item(spark, sf):
    return reports.stats_for_item(_marts(spark, sf).scored, LOOKUP_ITEM)


def q_stats_for_missing_item(spark, sf):
    return reports.stats_for_item(_marts(spark, sf).scored, MISSING_ITEM)


# --- data quality -------------------------------------------------------------------


def q_dq_not_null(spark, sf):
    m = _marts(spark, sf)
    return quality.not_null_failures(m.fact_reviews, ["review_id", "item_id", "user_id", "date_id", "score"])


def q_dq_unique(spark, sf):
    return quality.unique_failures(_marts(spark, sf).raw_reviews, "review_id")


def q_dq_relationships(spark, sf):
    m = _marts(spark, sf)
    return quality.relationship_failures(m.fact_reviews, "user_id", m.dim_user, "user_id")


def q_dq_range(spark, sf):
    return quality.range_failures(_marts(spark, sf).stg_reviews, "score", 1, 100).select("review_id", "score")


def q_dq_range_raw(spark, sf):
    return quality.range_failures(_marts(spark, sf).raw_reviews, "score", 1, 100).select("review_id", "score")


def q_dq_report(spark, sf):
    """All 42 declared checks over the model graph, run on written models as a
    test suite runs on built tables."""
    m = _marts(spark, sf, materialize=True)
    return quality.dq_report(quality.default_checks(), m.models())


CATALOGUE.update({
    "q_item_list": q_item_list,
    "q_recs_for_item": q_recs_for_item,
    "q_display_recs": q_display_recs,
    "q_export_recommendations": q_export_recommendations,
    "q_sentiment_by_tag": q_sentiment_by_tag,
    "q_item_stats_all": q_item_stats_all,
    "q_stats_for_item": q_stats_for_item,
    "q_stats_for_missing_item": q_stats_for_missing_item,
    "q_dq_not_null": q_dq_not_null,
    "q_dq_unique": q_dq_unique,
    "q_dq_relationships": q_dq_relationships,
    "q_dq_range": q_dq_range,
    "q_dq_range_raw": q_dq_range_raw,
    "q_dq_report": q_dq_report,
})


# --- sources, landing, dedup, top-k ------------------------------------------------


def _json_roundtrip(df: DataFrame, schema) -> DataFrame:
    """Serialise records to JSON text and parse them back with a fixed schema."""
    js = df.select(F.to_json(F.struct(*df.columns)).alias("j"))
    return js.select(F.from_json("j", schema).alias("r")).select("r.*")


def q_flatten_items(spark, sf):
    payload = testdata.item_payloads(testdata.table(spark, sf, "part"))
    return _flat(landing.flatten_items(_json_roundtrip(payload, ITEM_PAYLOAD)))


def q_flatten_reviews(spark, sf):
    payload = testdata.review_payloads(testdata.table(spark, sf, "lineitem")).drop("_loaded_at")
    return landing.flatten_reviews(_json_roundtrip(payload, REVIEW_PAYLOAD))


def q_users_from_reviews(spark, sf):
    return testdata.raw_users(testdata.table(spark, sf, "lineitem")).drop("loaded_at")


def q_landing_roundtrip(spark, sf):
    """Land daily snapshots, read the newest complete one by name, flatten, load.

    The older snapshot and a second write of the newest day carry marker
    descriptions, and a crashed writer has left a still newer folder; only the
    first write of the newest complete day may come back. Records are loaded
    first-row-per-id in landing order.
    """
    root = scratch_path(spark, "landing")
    payload = testdata.item_payloads(testdata.table(spark, sf, "part"))
    landing.write_snapshot(payload.withColumn("description", F.lit("stale")), root, "items", "2024-01-01")
    landing.write_snapshot(payload, root, "items", "2024-01-02")
    landing.write_snapshot(payload.withColumn("description", F.lit("again")), root, "items", "2024-01-02")
    files.make_folder(spark, landing.snapshot_path(root, "items", "2024-01-03") + "/_temporary")
    raw = landing.with_ingest_order(landing.read_latest(spark, root, "items", LANDED_ITEM))
    flat = landing.landed_items(raw, extra=["__ingest"])
    loaded = landing.load_items(flat, keep_first_by=("__ingest",))
    return _flat(loaded.drop("loaded_at"))


def q_load_flat_items(spark, sf):
    """Flat item records (as the extractor lands them), some without tags."""
    root = scratch_path(spark, "landing-flat")
    flat = landing.flatten_items(testdata.item_payloads(testdata.table(spark, sf, "part")))
    landing.write_snapshot(flat.withColumn("tags", F.when(F.col("episodes") <= 40, F.col("tags"))),
                           root, "items", "2024-01-01")
    raw = landing.with_ingest_order(landing.read_latest(spark, root, "items", LANDED_ITEM))
    return _flat(landing.load_items(landing.landed_items(raw, ["__ingest"])).drop("loaded_at"))


def q_load_flat_reviews(spark, sf):
    """Flat review records, newest load first, landed compressed; the first row of each id is loaded."""
    root = scratch_path(spark, "landing-flat")
    payload = testdata.review_payloads(testdata.table(spark, sf, "lineitem"))
    flat = landing.flatten_reviews(_newest_first(payload))
    landing.write_snapshot(flat, root, "reviews", "2024-01-01", compression="snappy")
    raw = landing.with_ingest_order(landing.read_latest(spark, root, "reviews", LANDED_REVIEW))
    return landing.load_reviews(landing.landed_reviews(raw, ["__ingest"]), ["__ingest"]).drop("loaded_at")


def q_load_users(spark, sf):
    """User records as offered (ids NULL, 0 and repeated): NULL ids dropped, first row wins."""
    reviews = testdata.raw_reviews(testdata.table(spark, sf, "lineitem"))
    offered = reviews.select("user_id", "username", F.col("user_created_at").alias("join_date"),
                             "created_at", "review_id")
    return landing.load_users(offered, ["created_at", "review_id"]).drop("loaded_at")


ITEM_LIST_SCHEMA = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("title", T.StringType()),
    T.StructField("title_display", T.StringType()), T.StructField("tag_primary", T.StringType()),
    T.StructField("avg_score", T.DoubleType()), T.StructField("release_year", T.IntegerType()),
])


def q_csv_roundtrip(spark, sf):
    """Export the item list as CSV (parallel part files) and read it back."""
    path = scratch_path(spark, "export") + "/item_list"
    files.export_csv(reports.item_list(_marts(spark, sf).dim_item), path)
    return files.read_csv(spark, path, ITEM_LIST_SCHEMA)


def q_latest_snapshot(spark, sf):
    """Events of the newest day (events as daily snapshots): one scalar, then a
    literal filter the scan can use."""
    ev = testdata.table(spark, sf, "events")
    day = ev.agg(F.max(F.to_date("ts")).alias("d")).first()["d"]
    return ev.filter(F.to_date("ts") == F.lit(day))


def q_keep_first(spark, sf):
    li = testdata.table(spark, sf, "lineitem")
    return keep_first(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def q_keep_first_in_place(spark, sf):
    """The same, with only the rows of repeated keys moved."""
    li = testdata.table(spark, sf, "lineitem")
    return keep_first(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"], in_place=True)


def q_keep_latest(spark, sf):
    ev = testdata.table(spark, sf, "events")
    return keep_latest(ev, ["user_id"], ["ts"])


def q_top_items(spark, sf):
    return _flat(top_items(_marts(spark, sf).stg_items, 50, status="STANDARD"))


def q_newest_k(spark, sf):
    """Newest five landed reviews of every item, by creation second."""
    r = testdata.raw_reviews(testdata.table(spark, sf, "lineitem")).drop("loaded_at")
    ties = [F.col(c).desc_nulls_last() for c in ("review_id", "user_id", "score", "summary", "review_text")]
    return newest_k(r, ["item_id"], [F.col("created_at").desc(), *ties], 5, rank_col="pos")


def q_newest_k_events(spark, sf):
    ev = testdata.table(spark, sf, "events")
    return newest_k(ev, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], 5, rank_col="pos")


def q_label_map(spark, sf):
    li = testdata.table(spark, sf, "lineitem")
    raw = (F.when(F.col("l_returnflag") == "A", F.lit("LABEL_2"))
           .when(F.col("l_returnflag") == "R", F.lit("LABEL_0"))
           .when(F.col("l_linestatus") == "O", F.lit("mixed"))
           .otherwise(F.lit("neutral")))
    return li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("review_id"),
                     raw.alias("raw_label")).withColumn("sentiment_label", sent.normalise_label(F.col("raw_label")))


def q_truncate_text(spark, sf):
    from revline.functions.scalars import text_prefix
    d = testdata.table(spark, sf, "documents")
    return d.select("doc_id", text_prefix("text", sent.MODEL_INPUT_CHARS).alias("text_512"))


def _documents_as_texts(spark, sf):
    d = testdata.table(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("review_id"), F.coalesce("text", F.lit("")).alias("text"))


def q_sentiment_documents(spark, sf):
    """Python scorer slot (mapInPandas over Arrow batches) on whole documents."""
    return sent.score_texts(_documents_as_texts(spark, sf), sent.lexicon_factory)


def q_sentiment_documents_jvm(spark, sf):
    """Same scores from the JVM form of the lexicon scorer."""
    return sent.score_texts(_documents_as_texts(spark, sf), None)


def q_review_texts_limit(spark, sf):
    """Texts to score with the optional limit (lowest ids first): the limit is the feature."""
    return sent.review_texts(_marts(spark, sf).fact_reviews, limit=100)


def q_tag_explode(spark, sf):
    from revline.operators.recommend import tag_members
    return tag_members(_marts(spark, sf).items_with_stats).select("item_id", "tag")


def q_items_with_stats(spark, sf):
    return _flat(_marts(spark, sf).items_with_stats.drop("positive_ratio_e4"))


CATALOGUE.update({
    "q_flatten_items": q_flatten_items,
    "q_flatten_reviews": q_flatten_reviews,
    "q_users_from_reviews": q_users_from_reviews,
    "q_landing_roundtrip": q_landing_roundtrip,
    "q_load_flat_items": q_load_flat_items,
    "q_load_flat_reviews": q_load_flat_reviews,
    "q_load_users": q_load_users,
    "q_csv_roundtrip": q_csv_roundtrip,
    "q_latest_snapshot": q_latest_snapshot,
    "q_keep_first": q_keep_first,
    "q_keep_first_in_place": q_keep_first_in_place,
    "q_keep_latest": q_keep_latest,
    "q_top_items": q_top_items,
    "q_newest_k": q_newest_k,
    "q_newest_k_events": q_newest_k_events,
    "q_label_map": q_label_map,
    "q_truncate_text": q_truncate_text,
    "q_sentiment_documents": q_sentiment_documents,
    "q_sentiment_documents_jvm": q_sentiment_documents_jvm,
    "q_review_texts_limit": q_review_texts_limit,
    "q_tag_explode": q_tag_explode,
    "q_items_with_stats": q_items_with_stats,
})


# --- the batch job end to end ---------------------------------------------------------


# tie-break columns of the staging dedup, as payload paths, in its order
_REVIEW_TIES = ["itemId", "user.id", "score", "createdAt", "user.createdAt", "_has_text",
                "user.name", "summary", "body"]


def _newest_first(reviews: DataFrame, fields: dict[str, Column] | None = None) -> DataFrame:
    """Payloads in the order of staging's latest-row rule, without the load time: sorted in
    ranges, as many as the rows need. With ``fields`` (payload column -> expression) ``reviews``
    are the rows that payloads are made of: these are shuffled, being far smaller."""
    fields = fields or {c: F.col(c) for c in reviews.columns}

    def order(of: dict[str, Column]) -> list[Column]:
        of = of | {"_has_text": F.trim(of["body"]) != "", "user.id": of["user"].getField("id"),
                   "user.name": of["user"].getField("name"), "user.createdAt": of["user"].getField("createdAt")}
        return [of["_loaded_at"].desc_nulls_first(), *[of[c].desc_nulls_last() for c in _REVIEW_TIES]]

    ranges = task_count(reviews.sparkSession, reviews.count())
    return (reviews.repartitionByRange(ranges, *order(fields))
            .select(*(e.alias(c) for c, e in fields.items()))
            .sortWithinPartitions(*order({c: F.col(c) for c in fields})).drop("_loaded_at"))


def land_testdata(spark, sf, root: str, day: str = "2024-01-02") -> None:
    """Land the driver tables as daily JSON snapshots (items and reviews), compressed.

    Reviews are landed newest load first (the staging order), so the
    loader's first-row-per-id rule keeps the same row as staging's
    latest-row rule would on the unloaded rows.
    """
    items = testdata.item_payloads(testdata.table(spark, sf, "part"))
    reviews = _newest_first(testdata.table(spark, sf, "lineitem"), testdata.review_fields())
    with dropping_shuffles(spark):
        landing.write_snapshot(items, root, "items", day, compression="gzip")
        landing.write_snapshot(reviews, root, "reviews", day, compression="gzip")


# the stand-in data has reviews without a user, and users whose only reviews
# are unusable
KNOWN_FAILURES = ("not_null_stg_reviews_user_id", "not_null_fact_reviews_user_id",
                  "unique_stg_users_username", "relationships_stg_reviews_user_id__stg_users_user_id",
                  "relationships_fact_reviews_user_id__dim_user_user_id")


def q_pipeline_recommendations(spark, sf):
    """Whole batch job from landed JSON to the written recommendation table."""
    base = scratch_path(spark, "pipeline")
    land_testdata(spark, sf, f"{base}/landing")
    cfg = PipelineConfig(landing_root=f"{base}/landing", warehouse_root=f"{base}/warehouse",
                         export_root=f"{base}/exports", as_of="2002-01-01",
                         report_only=KNOWN_FAILURES, export_compression="gzip")
    res = run_pipeline(spark, cfg)
    return files.read_table(spark, res.tables["recommendations"])


CATALOGUE["q_pipeline_recommendations"] = q_pipeline_recommendations


def q_sentiment_conversations(spark, sf):
    """The scorer slot on every chat turn, Python path."""
    c = testdata.table(spark, sf, "conversations")
    texts = c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("review_id"), "role",
                     F.coalesce("text", F.lit("")).alias("text"))
    return sent.append_scores(texts, "text", sent.lexicon_factory)


CATALOGUE["q_sentiment_conversations"] = q_sentiment_conversations


# --- lookups and SQL text -------------------------------------------------------------

LOOKUP_TITLE = "SMALL WIDGET"


def q_item_by_title(spark, sf):
    return reports.item_by_title(_marts(spark, sf).dim_item, LOOKUP_TITLE)


def q_sql_stats_for_item(spark, sf):
    """R4 as SQL text over registered views, item id bound as a parameter."""
    from revline.plans import sql as S
    m = _marts(spark, sf)
    S.register_views(m, prefix="rl_")
    return S.run_sql(spark, S.STATS_FOR_ITEM_SQL.format(view="rl_scored_reviews"),
                     integers=["item_id"], item_id=str(LOOKUP_ITEM))


def q_item_by_title_any_case(spark, sf):
    """A title as somebody types it: other case, other accents."""
    return reports.item_by_title(_marts(spark, sf).dim_item, "Smäll wIdget", "UNICODE_CI_AI")


def q_item_list_collated(spark, sf):
    """The item list under a language-aware collation, with the item that comes before each
    one among those of its tag (half of the titles in another case)."""
    from pyspark.sql import Window
    listed = reports.item_list(_marts(spark, sf).dim_item.withColumn(
        "title_display", F.when(F.col("item_id") % 2 == 0, F.initcap("title_display"))
        .otherwise(F.col("title_display"))), "UNICODE_CI_AI")
    in_tag = Window.partitionBy("tag_primary").orderBy(F.collate("title_display", "UNICODE_CI_AI"), "item_id")
    return listed.select("item_id", "tag_primary", "title_display", F.lag("item_id").over(in_tag).alias("before"))


CATALOGUE.update({"q_item_by_title_any_case": q_item_by_title_any_case,
                  "q_item_list_collated": q_item_list_collated})
CATALOGUE.update({"q_item_by_title": q_item_by_title, "q_sql_stats_for_item": q_sql_stats_for_item})


# --- tables that change together, cached reports, array snapshots ---------------------


#: rows of a bucket: one task sorts them
BUCKET_ROWS = 1_000_000


def q_committed_users(spark, sf):
    """Users of a warehouse after a commit of older tables, one of all raw tables and one
    that failed half-way: readers see the second, whole."""
    reviews = testdata.raw_reviews(testdata.table(spark, sf, "lineitem")).drop("loaded_at")
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    users = q_load_users(spark, sf)
    buckets = bucket_count(spark, reviews.count(), BUCKET_ROWS, BUCKET_ROWS)
    with wh.transaction() as tx:
        tx.write("raw_users", users.where("user_id % 2 = 0"))
        tx.write("raw_reviews", reviews.where("review_id % 2 = 0"))
    with wh.transaction() as tx:
        tx.write("raw_users", users)
        tx.write("raw_reviews", reviews, bucket_key="review_id", buckets=max(4, buckets))

    def rejected(rows):
        raise AssertionError(f"{rows.columns} does not hold")

    try:
        with wh.transaction() as tx:
            tx.write("raw_users", users.where("user_id % 3 = 0"))
            tx.write("raw_reviews", reviews.limit(0), guard=rejected)
    except AssertionError:
        wh.repair(older_than=0)
    at = wh.snapshot()
    return wh.read("raw_users", at).join(
        wh.read("raw_reviews", at).select("user_id").distinct(), "user_id", "left_semi")


def q_cached_item_stats(spark, sf):
    """R5 from the result cache: made once from the committed tables, then read from the
    entry; a new load is seen at once."""
    m = _marts(spark, sf)
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    cache = ResultCache(wh, ttl=300)
    scored = write_scratch(m.scored, "scored")

    def load(rows):
        with wh.transaction() as tx:
            tx.write("scored", rows)

    load(scored.where("review_id % 2 = 0"))
    for rows in (None, scored, None):
        if rows is not None:
            load(rows)
        out = cache.get("item_stats", ["scored"], reports.item_stats_all)
    cache.sweep()
    return out


def _as_array(batches):
    """JSON texts as the lines of one JSON array."""
    import pyarrow as pa
    begin = "["
    for batch in batches:
        lines = []
        for text in batch.column("value").to_pylist():
            lines.append(begin + text)
            begin = ","
        yield pa.RecordBatch.from_pydict({"value": lines})
    yield pa.RecordBatch.from_pydict({"value": ["[]" if begin == "[" else "]"]})


def q_array_snapshot(spark, sf):
    """Items landed as one JSON array file, read in ranges by many tasks, in file order."""
    payload = testdata.item_payloads(testdata.table(spark, sf, "part"))
    path = scratch_path(spark, "array") + ".json"
    (payload.select(F.to_json(F.struct("*")).alias("value")).coalesce(1)
     .mapInArrow(_as_array, "value string").write.text(path))      # one file, as the extractor leaves
    raw = read_json_array(spark, path, LANDED_ITEM, order="__ingest", range_bytes=1 << 16)
    loaded = landing.load_items(landing.landed_items(raw, extra=["__ingest"]), keep_first_by=("__ingest",))
    return _flat(loaded.drop("loaded_at"))


LOOKUP_RANGE = (100, 199)      # the items of one report: the look-up is the feature


def _lookup_tables(spark, sf):
    """Scored reviews by item and titles by title, as the batch job writes them."""
    m = _marts(spark, sf)
    wh = Warehouse(spark, scratch_path(spark, "lookups"))
    with wh.transaction() as tx:
        scored = m.scored.select("review_id", "item_id", "score", "sentiment_label", "sentiment_score")
        tx.write("scored_by_item", scored, cluster_by=("item_id", "review_id"), files=16)
        tx.write("item_titles", reports.item_titles(m.dim_item),
                 cluster_by=("title_display", "item_id"), files=8, blooms=("item_id",))
    return wh


def q_lookup_item_stats(spark, sf):
    """R4 for a range of items from the table laid out by item."""
    return reports.stats_for_items(_lookup_tables(spark, sf).read("scored_by_item"), *LOOKUP_RANGE)


def q_lookup_title(spark, sf):
    """P10 from the table laid out by title."""
    return reports.item_by_title(_lookup_tables(spark, sf).read("item_titles"), LOOKUP_TITLE)


CATALOGUE.update({"q_lookup_item_stats": q_lookup_item_stats, "q_lookup_title": q_lookup_title})
CATALOGUE.update({"q_committed_users": q_committed_users, "q_cached_item_stats": q_cached_item_stats,
                  "q_array_snapshot": q_array_snapshot})
