"""Plan-shape tests: the scale properties the design relies on."""

import contextlib
import io
from collections import Counter

from revline.operators.dedup import keep_latest
from revline.plans import reports
from revline.plans.build import from_testdata

from conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_recommendations_plan(spark):
    p = plan(from_testdata(spark, SF_SMALL).recommendations)
    # per-tag shortlist and final ranking both cut before their shuffles
    assert p.count("WindowGroupLimit") >= 4 and "Partial" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_pairs_are_deduplicated_on_numbers(spark):
    """Titles and other attributes are joined after the cut, and the pair dedup
    is a hash aggregate with map-side combine."""
    from revline.operators import recommend as rec
    m = from_testdata(spark, SF_SMALL)
    iws = rec.materialize(m.items_with_stats)
    p = plan(rec.candidate_pairs(iws, 10))
    assert "title" not in p and "studio" not in p
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p and "partial_max" in p


def test_tasks_of_the_tag_join_follow_the_pairs(spark, monkeypatch):
    """Its inputs are small, what it makes is not: adaptive execution may not coalesce it."""
    from revline.operators import recommend as rec
    iws = rec.materialize(from_testdata(spark, SF_SMALL).items_with_stats)
    total = iws.selectExpr("explode(array_distinct(tags))").count()
    rows = rec.candidate_pairs(iws, 10).collect()
    monkeypatch.setattr(rec, "PAIRS_PER_TASK", 11 * total // 7 + 1)
    pairs = rec.candidate_pairs(iws, 10)
    dealt = [line for line in plan(pairs).splitlines() if "REPARTITION_BY_NUM" in line]
    assert len(dealt) == 2 and all("hashpartitioning(tag" in d and ", 7)" in d for d in dealt)
    assert sorted(pairs.collect()) == sorted(rows) and rec.pair_tasks(0, 10) == 1


def _scored_items(spark, ids):
    """Scored items as ``recommend`` writes them; every third has a tag of its own."""
    from revline.operators import recommend as rec
    rows = [(i, f"t{i}", f"T{i}", ["all", f"x{(i or 0) % 5}"] + ([f"own{i}"] if i and i % 3 == 0 else []), "all",
             70.0, 2000, "s", (i or 0) % 4, 0.5, 0.1, 60.0, 100 * ((i or 0) % 7)) for i in ids]
    return rec.materialize(spark.createDataFrame(
        rows, "item_id long, title string, title_display string, tags array<string>, tag_primary string, "
        "community_score double, release_year int, studio string, review_count long, positive_ratio double, "
        "avg_sentiment_score double, avg_review_score double, score_e4 long"))


def _ranked(rec, iws, k):
    total = rec.membership_count(iws)
    return rec.rank_candidates(rec._joined_pairs(iws, k, total), iws, k, rec.pair_tasks(total, k))


def test_tasks_of_the_ranking_follow_the_pairs(spark, monkeypatch):
    """Dedup, rank and the source's titles share one deal of the pairs by source, which
    adaptive execution may not coalesce; rows never meet by their few targets."""
    from revline.operators import recommend as rec
    iws = _scored_items(spark, range(200))
    total = rec.membership_count(iws)
    rows = sorted(_ranked(rec, iws, 3).collect())
    monkeypatch.setattr(rec, "PAIRS_PER_TASK", 4 * total // 7 + 1)
    recs = _ranked(rec, iws, 3)
    moved = [line for line in plan(recs).splitlines() if "hashpartitioning(" in line]
    dealt = [m for m in moved if "hashpartitioning(source_item_id" in m]
    assert len(dealt) == 2 and all(", 7), REPARTITION_BY_NUM" in d for d in dealt)
    assert not any("t_item_id" in m for m in moved)
    assert sorted(recs.collect()) == rows and len(rows) == 600


def test_sources_of_the_tag_join_are_not_broadcast(spark):
    """Files of many items are small where titles and tags repeat; their rows are not."""
    from revline.operators import recommend as rec
    iws = _scored_items(spark, range(50))
    p = plan(rec.candidate_pairs(iws, 3))
    assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p
    p = plan(_ranked(rec, iws, 3))
    assert p.count("BroadcastExchange (") == 1      # the shortlisted items


def test_many_targets_are_not_broadcast(spark, monkeypatch):
    """Either way the same rows, of ids that repeat or are NULL too."""
    from revline.operators import recommend as rec
    iws = _scored_items(spark, [*range(60), 7, 8, 9, 58, None])
    few = sorted(_ranked(rec, iws, 3).collect())
    monkeypatch.setattr(rec, "TARGET_BYTES", 0)
    many = _ranked(rec, iws, 3)
    assert "BroadcastExchange" not in plan(many)
    assert sorted(many.collect()) == few
    # the same from the pairs one by one, each joined to all rows of both ids
    pairs = {}
    for r in rec.candidate_pairs(iws, 3).collect():
        pairs.setdefault(r.source_item_id, []).append((-r.t_score_e4, -r.t_review_count, r.t_item_id))
    copies = Counter(r.item_id for r in iws.collect())
    assert copies[7] == 2 and copies[None] == 1
    assert sorted((r.source_item_id, r.recommended_item_id, r["rank"]) for r in few) == sorted(
        (s, t, i) for s, ts in pairs.items() for i, (_, _, t) in enumerate(sorted(ts)[:3], 1)
        for _ in range(copies[s] * copies[t]))


def test_dq_report_reads_pruned_files(spark):
    from revline.queries import q_dq_report
    p = plan(q_dq_report(spark, SF_SMALL))
    assert "ExistingRDD" not in p
    wide = [line for line in p.splitlines() if "ReadSchema" in line and "review_text" in line]
    assert len(wide) <= 1


def test_dedup_combines_map_side(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "id AS ts", "CAST(id AS STRING) AS v")
    p = plan(keep_latest(df, ["k"], ["ts"]))
    assert "partial_max" in p


def test_calendar_bounds_move_no_text(spark):
    from revline.plans import staging
    m = from_testdata(spark, SF_SMALL)
    p = plan(staging.review_dates(m.raw_reviews))
    winners = [line for line in p.splitlines() if "max(struct(" in line]
    assert winners and not any("text" in w.replace("_has_text", "") for w in winners)
    assert sorted(map(tuple, staging.review_dates(m.raw_reviews).collect())) == sorted(
        map(tuple, m.stg_reviews.select("review_id", "review_date").collect()))


def test_stats_skip_calendar_and_combine_map_side(spark):
    m = from_testdata(spark, SF_SMALL)
    p = plan(m.stats)
    assert "partial_count" in p and "partial_sum" in p
    assert "LeftOuter" not in p and "Range" not in p      # no calendar


def test_scans_are_pruned(spark):
    m = from_testdata(spark, SF_SMALL)
    p = plan(reports.item_stats_all(m.scored))
    assert "l_extendedprice" not in p and "l_discount" not in p
