from pyspark.sql import functions as F

from revline.plans import reports
from revline.plans.build import from_testdata

from conftest import SF_SMALL


def test_label_counts_sum_and_tag_report_matches_item_report(spark):
    m = from_testdata(spark, SF_SMALL)
    per_item = reports.item_stats_all(m.scored)
    assert per_item.filter(F.col("positive") + F.col("neutral") + F.col("negative") != F.col("total_reviews")).count() == 0
    by_tag = {r.tag: (r.review_count, r.positive, r.neutral, r.negative)
              for r in reports.sentiment_by_tag(m.scored, m.dim_item).collect()}
    regroup = (per_item.join(m.dim_item.select("item_id", "tag_primary"), "item_id")
               .filter(F.col("tag_primary").isNotNull())
               .groupBy("tag_primary").agg(*[F.sum(c).alias(c) for c in
                                             ("total_reviews", "positive", "neutral", "negative")]))
    again = {r.tag_primary: (r.total_reviews, r.positive, r.neutral, r.negative) for r in regroup.collect()}
    assert by_tag == again


def test_stats_for_missing_item_is_one_row(spark):
    m = from_testdata(spark, SF_SMALL)
    rows = reports.stats_for_item(m.scored, -1).collect()
    assert len(rows) == 1
    assert rows[0].total_reviews == 0 and rows[0].avg_score is None and rows[0].avg_sentiment is None


def test_title_lookup_and_sql_text(spark):
    from revline.plans import sql as S
    m = from_testdata(spark, SF_SMALL)
    rows = reports.item_by_title(m.dim_item, "SMALL WIDGET").collect()
    first = m.dim_item.filter(F.col("title_display") == "SMALL WIDGET").agg(F.min("item_id")).first()[0]
    assert [r.item_id for r in rows] == ([first] if first is not None else [])
    S.register_views(m, prefix="t_")
    via_sql = S.run_sql(spark, S.STATS_FOR_ITEM_SQL.format(view="t_scored_reviews"),
                        integers=["item_id"], item_id="7").collect()
    via_df = reports.stats_for_item(m.scored, 7).collect()
    assert via_sql == via_df


def test_text_arguments_stay_text(spark):
    from revline.plans import sql as S
    got = S.run_sql(spark, "SELECT :a AS a, :a = '1984' AS same, :b AS b", a="1984", b="007").first()
    assert (got.a, got.same, got.b) == ("1984", True, "007")


def test_display_frame_has_nine_columns(spark):
    recs = spark.createDataFrame(
        [(1, "t", "g", "s", 2000, 80.0, 3, 0.5, 0.7, 0.6123)],
        "rank long, title string, tag string, studio string, year int, community_score double, "
        "reviews long, positive_ratio double, avg_sentiment double, recommendation_score double")
    shown = reports.display_recs(recs)
    assert len(shown.columns) == 9 and "avg_sentiment" not in shown.columns


def test_titles_in_the_order_of_a_language(spark):
    titles = ["zebra", "Éclair", "eclair", "apple", "Zoo", "Äpple", "öl", "Apple", None, ""]
    dim = spark.createDataFrame(
        [(i, t, t, "x", 1.0, 2000) for i, t in enumerate(titles)],
        "item_id long, title string, title_display string, tag_primary string, avg_score double, release_year int")

    def order(collation):
        return [r.title_display for r in reports.item_list(dim, collation).collect()]

    assert order(None) == [None, "", "Apple", "Zoo", "apple", "eclair", "zebra", "Äpple", "Éclair", "öl"]
    # equal under the collation: by id
    assert order("UNICODE_CI_AI") == [None, "", "apple", "Äpple", "Apple", "Éclair", "eclair", "öl", "zebra", "Zoo"]
    assert order("sv")[-2:] == ["Äpple", "öl"]          # after z in Swedish
    found = reports.item_by_title(dim, "ECLAIR", "UNICODE_CI_AI").collect()
    assert [r.item_id for r in found] == [1] and reports.item_by_title(dim, "ECLAIR").collect() == []
