import datetime as dt

from revline.operators.dedup import keep_first, keep_latest
from revline.plans.staging import stage_reviews, stage_users
from revline.schemas import RAW_REVIEWS, RAW_USERS

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def test_keep_latest_nulls_first_and_ties(spark):
    rows = [(1, T1, "a"), (1, T2, "b"),            # newest wins
            (2, None, "n"), (2, T2, "x"),          # NULL load time counts as newest
            (3, T1, "p"), (3, T1, "q"),            # tie: larger rest wins
            (None, T1, "k1"), (None, T2, "k2")]    # NULL keys form one group
    df = spark.createDataFrame(rows, "k int, ts timestamp, v string")
    got = {r.k: r.v for r in keep_latest(df, ["k"], ["ts"]).collect()}
    assert got == {1: "b", 2: "n", 3: "q", None: "k2"}
    assert keep_latest(df, ["k"], ["ts"]).columns == ["k", "ts", "v"]


def test_keep_first_nulls_last(spark):
    rows = [(1, 2, "late"), (1, 1, "early"), (2, None, "unknown"), (2, 5, "known")]
    df = spark.createDataFrame(rows, "k int, seq int, v string")
    got = {r.k: r.v for r in keep_first(df, ["k"], ["seq"]).collect()}
    assert got == {1: "early", 2: "known"}


def test_hot_key_keeps_one_row(spark):
    df = spark.range(0, 20000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS ts", "CAST(id AS STRING) AS v")
    out = keep_latest(df, ["k"], ["ts"])
    assert out.count() == df.select("k").distinct().count()
    assert out.filter("k = 0").first().v == "19998"


def _review(rid, loaded, score=50, text="fine", user=1):
    return (rid, 10, user, " u ", 0, score, "s", text, 86400 * 3, loaded)


def test_invalid_newest_row_removes_key(spark):
    rows = [_review(1, T1), _review(1, T2, score=101),        # newest invalid -> key gone
            _review(2, T1, text="  "), _review(2, T2),         # newest valid -> kept
            _review(None, T2)]                                 # NULL id dropped
    out = stage_reviews(spark.createDataFrame(rows, _schema()))
    got = sorted(r.review_id for r in out.collect())
    assert got == [2]
    r = out.first()
    assert r.username == "u" and r.review_date == dt.date(1970, 1, 4)


def _schema():
    from pyspark.sql import types as T
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in RAW_REVIEWS.fields])


def test_stage_users_lowercase_and_blank(spark):
    from pyspark.sql import types as T
    sch = T.StructType([T.StructField(f.name, f.dataType, True) for f in RAW_USERS.fields])
    rows = [(1, "  Alice ", 0, T1), (2, " \t", 0, T1), (3, None, 0, T1), (None, "x", 0, T1),
            (4, "Bob", 0, T1), (4, "   ", 86400, T2)]
    got = {r.user_id: r.username for r in stage_users(spark.createDataFrame(rows, sch)).collect()}
    # tab-only name is not blank for TRIM (spaces only); user 4's newest row is blank
    assert got == {1: "alice", 2: "\t"}


def test_stage_reviews_score_bounds_and_tab_text(spark):
    rows = [_review(1, T1, score=0), _review(2, T1, score=1), _review(3, T1, score=100),
            _review(4, T1, score=101), _review(5, T1, score=None), _review(6, T1, text="\t")]
    got = sorted(r.review_id for r in stage_reviews(spark.createDataFrame(rows, _schema())).collect())
    assert got == [2, 3, 6]          # BETWEEN 1 AND 100 (NULL fails); a tab is not blank for TRIM


def test_stage_items_null_score_becomes_max(spark):
    from decimal import Decimal

    from revline.plans.staging import stage_items
    rows = [(1, "a", None, ["x"], " s ", 1, None, 2000, " finished ", "d", T1),
            (2, "b", None, ["x"], "s", 1, Decimal("120.50"), 2000, "x", "d", T1),
            (3, None, None, ["x"], "s", 1, Decimal("5.00"), 2000, "x", "d", T1),
            (None, "c", None, ["x"], "s", 1, Decimal("5.00"), 2000, "x", "d", T1)]
    sch = ("item_id long, title_native string, title_english string, tags array<string>, studio string, "
           "episodes int, avg_score decimal(5,2), year int, status string, description string, loaded_at timestamp")
    df = spark.createDataFrame(rows, sch)
    got = {r.item_id: (r.avg_score, r.status, r.studio) for r in stage_items(df).collect()}
    assert got == {1: (Decimal("100.00"), "FINISHED", "s"), 2: (Decimal("100.00"), "X", "s")}
    kept = {r.item_id: r.avg_score for r in stage_items(df, null_score="keep").collect()}
    assert kept == {1: None, 2: Decimal("100.00")}


def _rows_with_few_rivals(spark, tmp_path, null_keys=2):
    rows = [(i, f"k{i % 5}", i % 3, f"text {i}") for i in range(200)]
    rows += [(3, "k3", None, "again"), (3, "k3", 9, "later"), (4, "k4", 4 % 3, "tie"), (4, "k4", 4 % 3, "tie")]
    rows += [(None, "n", i, f"null {i}") for i in range(null_keys)] + [(7, None, 1, "x")]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, "a long, b string, ts int, v string").write.parquet(path)
    return spark.read.parquet(path)


def test_in_place_keeps_the_same_rows(spark, tmp_path):
    df = _rows_with_few_rivals(spark, tmp_path)
    for keep in (keep_latest, keep_first):
        want = sorted(map(str, keep(df, ["a", "b"], ["ts"]).collect()))
        for limit in (1 << 20, 0):                     # broadcast, and the way beyond the limit
            got = keep(df, ["a", "b"], ["ts"], in_place=True, contested_bytes=limit)
            assert got.columns == df.columns and sorted(map(str, got.collect())) == want
    none = df.where("a < 0")
    assert keep_latest(none, ["a", "b"], ["ts"], in_place=True).collect() == []
    unique = df.dropDuplicates(["a", "b"]).select("a", "b", "ts", "v")
    assert keep_latest(unique, ["a", "b"], ["ts"], in_place=True).count() == 202


def test_in_place_moves_no_text_of_an_uncontested_key(spark, tmp_path):
    df = _rows_with_few_rivals(spark, tmp_path)
    got = keep_latest(df, ["a", "b"], ["ts"], in_place=True)
    plan = got._jdf.queryExecution().executedPlan().toString()
    alone, rivals = plan.split("LeftSemi")[0], plan.split("Union")[1]
    assert plan.count("Exchange hashpartitioning") == 1 and "LeftAnti" in rivals
    # the one shuffle is above the semi join, in the branch of the repeated keys
    assert "Exchange hashpartitioning" in alone and "BroadcastHashJoin" in plan
    # without repeated keys there is no shuffle at all
    path = str(tmp_path / "unique")
    df.where("a > 10").write.parquet(path)
    plan = keep_latest(spark.read.parquet(path), ["a"], ["ts"], in_place=True)._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString() and "Aggregate" not in plan.toString()


def test_dealt_keeps_the_same_rows(spark, tmp_path):
    """Also of a key that holds more rows than a task takes, of NULL keys and of no rows."""
    df = _rows_with_few_rivals(spark, tmp_path, null_keys=40)
    hot = df.union(df.where("a = 5").crossJoin(spark.range(90)).selectExpr("a", "b", "ts", "concat(v, id)"))
    for rows in (df, hot, df.where("a < -1")):
        want = sorted(map(str, keep_latest(rows, ["a", "b"], ["ts"]).collect()))
        for limit in (30, 1_000_000):
            got = keep_latest(rows, ["a", "b"], ["ts"], dealt=True, rows_per_task=limit)
            assert got.columns == df.columns and sorted(map(str, got.collect())) == want


def test_staging_sorts_reviews_in_tasks_that_follow_the_rows(spark, monkeypatch):
    """No sort of a whole input split, whose files may hold many rows in few bytes."""
    from revline.operators import dedup
    rows = [_review(i % 500, T1, score=1 + i % 99) for i in range(600)]
    raw = spark.createDataFrame(rows, _schema())
    want = sorted(map(str, stage_reviews(raw).collect()))
    monkeypatch.setattr(dedup, "ROWS_PER_TASK", 100)
    got = stage_reviews(raw)
    plan = got._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning(review_id")
    assert len(below) == 2 and below[1].split("]")[0].split(", ", 1)[1].startswith("6), REPARTITION_BY_NUM")
    assert "Sort" not in below[1] and "Aggregate" not in below[1]
    assert sorted(map(str, got.collect())) == want


def test_first_by_lead_keeps_the_same_rows(spark, tmp_path):
    df = _rows_with_few_rivals(spark, tmp_path).union(
        spark.createDataFrame([(8, "all null", None, v) for v in ("b", "a")], "a long, b string, ts int, v string"))
    want = sorted(map(str, keep_first(df, ["a", "b"], ["ts"]).collect()))
    for limit in (1 << 20, 0):                         # broadcast, and dealt beyond the limit
        got = keep_first(df, ["a", "b"], ["ts"], by_lead=True, contested_bytes=limit)
        assert got.columns == df.columns and sorted(map(str, got.collect())) == want
    none = df.where("a < 0")
    assert keep_first(none, ["a", "b"], ["ts"], by_lead=True).collect() == []


def test_users_of_reviews_are_sorted_after_the_cut(spark, tmp_path):
    """A user's reviews are not sorted, but for those of the first second."""
    from revline.sources.landing import users_from_reviews
    rows = [(i % 20, f"u{i % 20} {i}", 5, i // 40, i) for i in range(400)] + [(0, "zero", 5, 0, 0), (None, "n", 5, 0, 0)]
    flat = spark.createDataFrame(rows, "user_id long, username string, user_created_at long, created_at long, id long")
    want = sorted(map(str, users_from_reviews(flat, ["created_at", "id"]).collect()))
    got = users_from_reviews(flat, ["created_at", "id"], by_lead=True)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan.split("partial_min")[1].split("Sort [")[1]    # below the first sort
    assert sorted(map(str, got.collect())) == want and len(want) == 19
