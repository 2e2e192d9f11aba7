import os
import re
from dataclasses import replace

import pytest

from revline.plans.build import from_testdata
from revline.plans import marts, pipeline, staging
from revline.plans.pipeline import STEPS, PipelineConfig, run_pipeline, run_step, warehouse_of
from revline.queries import KNOWN_FAILURES, land_testdata
from revline.operators.sentiment import sentiment_table
from revline.schemas import LANDED_ITEM, LANDED_REVIEW
from revline.sources import files, landing
from revline.sources.warehouse import bucket_count, dealing

from conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_pipeline_end_to_end_and_rerun(spark, tmp_path):
    base = str(tmp_path)
    land_testdata(spark, SF_SMALL, f"{base}/landing")
    cfg = PipelineConfig(landing_root=f"{base}/landing", warehouse_root=f"{base}/wh",
                         export_root=f"{base}/exports", as_of="2002-01-01",
                         export_single_file=True, report_only=KNOWN_FAILURES)
    res = run_pipeline(spark, cfg)
    recs = files.read_table(spark, res.tables["recommendations"])
    expected = from_testdata(spark, SF_SMALL).recommendations
    first = _rows(recs)
    assert first == _rows(expected)

    lineitem_rows = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert res.offered["reviews"] == lineitem_rows           # rows offered before key conflicts
    assert len(res.checks) == 42
    failing = {r.check_name for r in res.checks if r.failing_rows > 0}
    assert "unique_fact_reviews_review_id" not in failing
    assert "not_null_fact_reviews_user_id" in failing         # reviews without a user are kept

    for name in ("item_list", "recommendations", "sentiment_by_tag", "item_sentiment_stats"):
        parts = [p for p in os.listdir(f"{base}/exports/{name}") if p.endswith(".csv")]
        assert len(parts) == 1                                # asked for as one file
    # re-run of every step on the same landing: tables are replaced, results identical
    res2 = run_pipeline(spark, replace(cfg, skip_current=False))
    assert _rows(files.read_table(spark, res2.tables["recommendations"])) == first


def _job(spark, tmp_path, **settings):
    base = str(tmp_path)
    land_testdata(spark, SF_SMALL, f"{base}/landing")
    return PipelineConfig(landing_root=f"{base}/landing", warehouse_root=f"{base}/wh", as_of="2002-01-01",
                          export_root=f"{base}/exports", report_only=KNOWN_FAILURES, **settings)


def test_a_run_goes_on_from_the_step_that_failed(spark, tmp_path, monkeypatch):
    cfg = _job(spark, tmp_path)
    names, first = list(STEPS), None
    for k, name in enumerate(names):
        def broken(spark, cfg, tx, real=STEPS[name].run):
            real(spark, cfg, tx)             # all its tables are written, then it fails
            raise OSError("injected")
        monkeypatch.setitem(pipeline.STEPS, name, replace(STEPS[name], run=broken))
        before = warehouse_of(spark, cfg).snapshot()
        with pytest.raises(OSError):
            run_pipeline(spark, cfg)
        monkeypatch.undo()
        now = warehouse_of(spark, cfg).snapshot()
        assert set(now.steps) == set(names[:k]) and now.version == before.version + (1 if k else 0)
    res = run_pipeline(spark, cfg)
    assert res.ran == ["export"]
    assert len(res.checks) == 42 and res.offered["reviews"] > 0 and res.exported["recommendations"] > 0
    first = _rows(files.read_table(spark, res.tables["recommendations"]))
    assert first == _rows(from_testdata(spark, SF_SMALL).recommendations)
    again = run_pipeline(spark, cfg)
    assert again.ran == [] and again.checks == res.checks and again.exported == res.exported
    # other settings run what they change, and what reads it
    assert run_pipeline(spark, replace(cfg, k=3)).ran == ["recommend", "export"]
    # a new snapshot runs all
    landing.write_snapshot(landing.read_snapshot(
        spark, landing.latest_snapshot_path(spark, cfg.landing_root, "items"), LANDED_ITEM),
        cfg.landing_root, "items", "2030-01-01")
    assert run_pipeline(spark, replace(cfg, k=3)).ran == names
    assert run_pipeline(spark, replace(cfg, skip_current=False, k=3)).ran == names


def test_row_totals_of_exports(spark, tmp_path):
    res = run_pipeline(spark, _job(spark, tmp_path))
    for name, n in res.exported.items():
        assert spark.read.option("header", True).csv(f"{tmp_path}/exports/{name}").count() == n
    assert len(res.exported) == 4


def test_null_key_stops_the_load(spark, tmp_path):
    base = str(tmp_path)
    land_testdata(spark, SF_SMALL, f"{base}/landing")
    cfg = PipelineConfig(landing_root=f"{base}/landing", warehouse_root=f"{base}/wh")
    run_step(spark, cfg, "load")
    wh = warehouse_of(spark, cfg)
    before = _rows(wh.read("raw_items"))
    bad = spark.createDataFrame([(None, "t"), (1, "u")], "item_id long, title_native string")
    landing.write_snapshot(bad, f"{base}/landing", "items", "2024-01-03")
    with pytest.raises(AssertionError, match="not_null_t_item_id=1"):
        run_step(spark, cfg, "load")
    assert _rows(wh.read("raw_items")) == before


def test_failed_checks_keep_the_published_recommendations(spark, tmp_path):
    base = str(tmp_path)
    land_testdata(spark, SF_SMALL, f"{base}/landing")
    cfg = PipelineConfig(landing_root=f"{base}/landing", warehouse_root=f"{base}/wh", as_of="2002-01-01",
                         report_only=KNOWN_FAILURES)
    res = run_pipeline(spark, cfg)
    before = _rows(files.read_table(spark, res.tables["recommendations"]))
    strict = PipelineConfig(**{**cfg.__dict__, "report_only": ()})   # now the known failures count
    with pytest.raises(AssertionError, match="not_null_stg_reviews_user_id"):
        run_pipeline(spark, strict)
    assert _rows(files.read_table(spark, res.tables["recommendations"])) == before


def test_written_reports_keep_their_order(spark, tmp_path):
    from revline.plans import reports
    m = from_testdata(spark, SF_SMALL)
    path = str(tmp_path / "items")
    reports.item_list(m.dim_item).write.json(path)
    rows = landing.with_ingest_order(landing.read_snapshot(spark, path, "item_id long, title_display string"))
    titles = [(r.title_display, r.item_id) for r in sorted(rows.collect(), key=lambda r: r["__ingest"])]
    assert len(titles) > 1 and titles == sorted(titles)


def _exchanges(df, buckets):
    """Shuffles of review rows in the plan that a write to ``buckets`` makes."""
    with dealing(df.sparkSession, buckets):
        plan = df.repartition(buckets, "review_id")._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(review_id", plan)


def test_one_shuffle_from_load_to_score(spark, tmp_path):
    cfg = _job(spark, tmp_path, bucket_bytes=100_000)
    run_pipeline(spark, cfg)
    wh = warehouse_of(spark, cfg)
    at = wh.snapshot()
    buckets = at.tables["raw_reviews"].buckets
    assert buckets > 1
    for name in ("raw_reviews", "stg_reviews", "fact_reviews", "sentiment"):
        assert at.tables[name].buckets == buckets
        parts = [p for p in os.listdir(wh.path(name, at)) if p.endswith(".parquet")]
        assert len(parts) == buckets                         # one file a bucket
    landed = landing.read_latest_in_order(spark, cfg.landing_root, "reviews", LANDED_REVIEW)
    load = landing.load_reviews(landing.landed_reviews(landed, extra=["__ingest"]), ["__ingest"])
    assert len(_exchanges(load, buckets)) == 1               # the grouping's own shuffle deals the rows
    assert not _exchanges(staging.stage_reviews(wh.read("raw_reviews", at), in_place=True), buckets)
    assert not _exchanges(marts.fact_reviews(wh.read("stg_reviews", at), wh.read("dim_date", at)), buckets)
    assert not _exchanges(sentiment_table(wh.read("fact_reviews", at), None), buckets)


def test_dealing_leaves_the_settings_as_they_were(spark):
    shuffle, auto = "spark.sql.shuffle.partitions", "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(shuffle), spark.conf.get(auto)
    with pytest.raises(OSError), dealing(spark, 3):
        assert spark.conf.get(shuffle) == "3"
        raise OSError("injected")
    assert (spark.conf.get(shuffle), spark.conf.get(auto)) == before


def test_bucket_count(spark):
    cores = spark.sparkContext.defaultParallelism
    assert bucket_count(spark, 0, 512 << 20) == 1
    assert bucket_count(spark, 8 << 20, 512 << 20) == min(cores, 2)
    assert bucket_count(spark, 100 << 40, 512 << 20) == 100_000   # as many as a session allows
    assert bucket_count(spark, 1000, 100) == 10


def test_landing_sorts_ranges_that_follow_the_rows(spark, monkeypatch):
    from pyspark.sql import functions as F

    from conftest import SF_SMALL
    from revline import queries as q
    from revline.operators import dedup
    from revline.sources import testdata
    reviews = testdata.review_payloads(testdata.table(spark, SF_SMALL, "lineitem"))
    want = reviews.withColumn("_has_text", F.trim("body") != "").orderBy(
        F.col("_loaded_at").desc_nulls_first(), *[F.col(c).desc_nulls_last() for c in q._REVIEW_TIES]
    ).drop("_loaded_at", "_has_text").collect()
    monkeypatch.setattr(dedup, "ROWS_PER_TASK", -(-len(want) // 7))
    got = q._newest_first(reviews)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ", 7), REPARTITION_BY_NUM" in plan.split("Exchange rangepartitioning")[1]
    assert got.collect() == want


def test_a_bucket_is_what_a_task_can_sort(spark):
    from revline.plans.pipeline import PipelineConfig
    from revline.sources.warehouse import bucket_count
    assert bucket_count(spark, 10 << 30, PipelineConfig("a", "b").bucket_bytes) == 80


def _shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    files = env.blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_queries_drop_their_shuffle_files(spark, tmp_path):
    import time

    from pyspark.sql import functions as F
    from revline.session import dropping_shuffles
    df = spark.range(0, 1000, 1, 4).groupBy((F.col("id") % 10).alias("k")).count()
    with dropping_shuffles(spark):
        before = _shuffle_files(spark)
        df.write.parquet(str(tmp_path / "a"))
        for _ in range(100):                                  # deleted in the background
            if not (left := _shuffle_files(spark) - before):
                break
            time.sleep(0.1)
        assert not left
        assert sorted(r["count"] for r in df.collect()) == [100] * 10
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    with pytest.raises(OSError), dropping_shuffles(spark):
        assert spark.conf.get(key) == "true"
        raise OSError("injected")
    assert spark.conf.get(key, None) == was


def test_the_job_lands_and_exports_compressed(spark, tmp_path, monkeypatch):
    from revline import queries as q
    monkeypatch.setattr(q, "scratch_path", lambda spark, name: str(tmp_path))
    got = q.q_pipeline_recommendations(spark, SF_SMALL)
    assert _rows(got) == _rows(from_testdata(spark, SF_SMALL).recommendations)
    for folder, end in (("landing/items/snapshot_date=2024-01-02", ".json.gz"),
                        ("landing/reviews/snapshot_date=2024-01-02", ".json.gz"),
                        ("exports/recommendations", ".csv.gz"), ("exports/item_list", ".csv.gz")):
        parts = [n for n in os.listdir(tmp_path / folder) if n.startswith("part-")]
        assert parts and all(n.endswith(end) for n in parts)


def test_landing_shuffles_the_rows_that_payloads_are_made_of(spark):
    from revline import queries as q
    from revline.sources import testdata
    lineitem = testdata.table(spark, SF_SMALL, "lineitem")
    got = q._newest_first(lineitem, testdata.review_fields())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    moved = plan.split("RepartitionByExpression")[1]
    assert "concat" not in moved.split("\n", 1)[1]          # no text is made before the shuffle
    assert got.collect() == q._newest_first(testdata.review_payloads(lineitem)).collect()
