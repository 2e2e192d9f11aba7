import json
import os

import pytest

from pyspark.sql import functions as F

from revline.operators.dedup import keep_first
from revline.schemas import ITEM_PAYLOAD, LANDED_ITEM, LANDED_REVIEW, RAW_ITEMS, REVIEW_PAYLOAD
from revline.sources import landing


def _item(i, studios=True, start=True, tags=True):
    d = {"id": i, "title": {"native": f"t{i}", "english": None if i % 2 else f"T{i}"},
         "episodes": 12, "averageScore": 80, "status": "FINISHED", "description": "d"}
    if tags:
        d["tags"] = ["a", "b"]
    d["studios"] = {"nodes": [{"name": "S1"}, {"name": "S2"}] if studios else []}
    d["startDate"] = {"year": 2001} if start else None
    return d


def _write_array(path, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        json.dump(records, fh)


def test_flatten_items_edge_cases(spark, tmp_path):
    p = str(tmp_path / "items" / "2024-01-01.json")
    _write_array(p, [_item(1), _item(2, studios=False), _item(3, start=False), _item(4, tags=False)])
    flat = {r.item_id: r for r in landing.flatten_items(landing.read_snapshot(spark, p, ITEM_PAYLOAD)).collect()}
    assert flat[1].studio == "S1" and flat[1].year == 2001 and flat[1].title_english is None
    assert flat[2].studio is None                 # empty studio list -> NULL
    assert flat[3].year is None                   # NULL start date -> NULL year
    assert flat[4].tags is None
    loaded = {r.item_id: r for r in landing.load_items(
        landing.flatten_items(landing.read_snapshot(spark, p, ITEM_PAYLOAD)), keep_first_by=None).collect()}
    assert loaded[4].tags == []                   # NULL tags -> [] on load


def test_flatten_review_without_user(spark, tmp_path):
    p = str(tmp_path / "reviews" / "2024-01-01.json")
    _write_array(p, [{"id": 1, "itemId": 5, "user": None, "score": 70, "body": "b", "createdAt": 10},
                     {"id": 2, "itemId": 5, "user": {"id": 9, "name": "n", "createdAt": 3}, "score": 1}])
    rows = {r.review_id: r for r in landing.flatten_reviews(landing.read_snapshot(spark, p, REVIEW_PAYLOAD)).collect()}
    assert rows[1].user_id is None and rows[1].username is None
    assert rows[2].user_id == 9 and rows[2].review_text is None


def test_newest_snapshot_by_name_and_missing(spark, tmp_path):
    root = str(tmp_path / "land")
    for day in ("2024-01-01", "2024-03-01", "2024-02-01"):
        _write_array(f"{root}/items/{day}.json", [_item(1)])
    assert landing.latest_snapshot_path(spark, root, "items").endswith("2024-03-01.json")
    with pytest.raises(FileNotFoundError):
        landing.latest_snapshot_path(spark, root, "users")


def test_write_snapshot_is_idempotent(spark, tmp_path):
    root = str(tmp_path / "land")
    df1 = spark.createDataFrame([(1, "first")], "id long, v string")
    df2 = spark.createDataFrame([(1, "second")], "id long, v string")
    landing.write_snapshot(df1, root, "x", "2024-01-01")
    assert landing.snapshot_complete(spark, landing.snapshot_path(root, "x", "2024-01-01"))
    landing.write_snapshot(df2, root, "x", "2024-01-01")          # kept as is
    got = landing.read_snapshot(spark, landing.latest_snapshot_path(spark, root, "x"), "id long, v string")
    assert [r.v for r in got.collect()] == ["first"]


def test_users_from_reviews_first_seen_skip_falsy(spark):
    rows = [(1, 5, 7, "first", 100, 50, "s", "t", 1), (2, 5, 7, "second", 100, 50, "s", "t", 2),
            (3, 5, 8, "eight", 100, 50, "s", "t", 3), (4, 5, 0, "zero", 1, 1, "s", "t", 4),
            (5, 5, None, "none", 1, 1, "s", "t", 5)]
    schema = ("review_id long, item_id long, user_id long, username string, user_created_at long, "
              "score int, summary string, review_text string, created_at long")
    users = landing.users_from_reviews(spark.createDataFrame(rows, schema), ["created_at"])
    got = {r.user_id: r.username for r in users.collect()}
    assert got == {7: "first", 8: "eight"}      # 3 rows, repeated id -> 2 kept; 0 and NULL skipped


def test_load_users_drops_null_and_keeps_first(spark):
    rows = [(None, "x", 1, 0), (1, "a", 1, 1), (1, "b", 1, 2)]
    df = spark.createDataFrame(rows, "user_id long, username string, join_date long, __ingest long")
    got = [(r.user_id, r.username) for r in landing.load_users(df, ["__ingest"]).collect()]
    assert got == [(1, "a")]


def test_crashed_snapshot_is_neither_read_nor_kept(spark, tmp_path):
    root = str(tmp_path / "land")
    df = spark.createDataFrame([(1, "first")], "id long, v string")
    landing.write_snapshot(df, root, "x", "2024-01-01")
    os.makedirs(f"{landing.snapshot_path(root, 'x', '2024-01-02')}/_temporary")
    assert landing.latest_snapshot_path(spark, root, "x").endswith("2024-01-01")
    path = landing.write_snapshot(df.withColumn("v", F.lit("second")), root, "x", "2024-01-02")
    assert landing.latest_snapshot_path(spark, root, "x") == path
    assert [r.v for r in landing.read_snapshot(spark, path, "id long, v string").collect()] == ["second"]


def test_flat_and_nested_records_load_alike(spark, tmp_path):
    p = str(tmp_path / "items" / "2024-01-01.json")
    flat = {"item_id": 2, "title_native": "t2", "title_english": "T2", "tags": None, "studio": "S1",
            "episodes": 12, "avg_score": 80, "year": 2001, "status": "FINISHED", "description": "d"}
    _write_array(p, [_item(1), flat])
    rows = {r.item_id: r for r in landing.load_items(landing.landed_items(
        landing.read_snapshot(spark, p, LANDED_ITEM)), keep_first_by=None).collect()}
    assert (rows[1].title_native, rows[1].studio, rows[1].year, rows[1].tags) == ("t1", "S1", 2001, ["a", "b"])
    assert (rows[2].title_native, rows[2].studio, rows[2].year, rows[2].tags) == ("t2", "S1", 2001, [])
    assert landing.load_items(landing.landed_items(
        landing.read_snapshot(spark, p, LANDED_ITEM))).schema.names == RAW_ITEMS.names
    q = str(tmp_path / "reviews" / "2024-01-01.json")
    _write_array(q, [{"id": 1, "itemId": 5, "user": {"id": 9, "name": "n", "createdAt": 3}, "score": 1, "body": "b"},
                     {"review_id": 2, "item_id": 6, "user_id": 8, "username": "m", "score": 2, "review_text": "c"}])
    both = landing.landed_reviews(landing.read_snapshots(spark, [q, q], LANDED_REVIEW))
    got = {(r.review_id, r.item_id, r.user_id, r.username, r.review_text) for r in both.collect()}
    assert got == {(1, 5, 9, "n", "b"), (2, 6, 8, "m", "c")} and both.count() == 4


def test_ingest_order_beyond_five_digit_part_numbers(spark, tmp_path):
    folder = tmp_path / "snap"
    os.makedirs(folder)
    for number, v in ((99999, "early"), (100000, "late")):
        (folder / f"part-{number}-x.json").write_text(json.dumps({"id": 1, "v": v}) + "\n")
    df = landing.with_ingest_order(spark.read.schema("id long, v string").json(str(folder)))
    assert [r.v for r in keep_first(df, ["id"], ["__ingest"]).collect()] == ["early"]


def test_compressed_snapshots_are_small_and_keep_the_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "FILE_RECORDS", 7)
    rows = spark.range(0, 100, 1, 2).selectExpr(
        "id % 10 AS review_id", "id AS item_id", "repeat('the same words again ', 20) AS review_text")
    sizes = {}
    for kind in (None, "snappy"):
        root = str(tmp_path / str(kind))
        path = landing.write_snapshot(rows, root, "reviews", "2024-01-01", compression=kind)
        assert landing.latest_snapshot_path(spark, root, "reviews") == path
        sizes[kind] = landing.snapshot_stamp(spark, path)[1]
        read = landing.with_ingest_order(landing.read_latest(spark, root, "reviews", LANDED_REVIEW))
        loaded = landing.load_reviews(landing.landed_reviews(read, ["__ingest"]), ["__ingest"])
        assert sorted((r.review_id, r.item_id) for r in loaded.collect()) == [(i, i) for i in range(10)]
    assert sizes["snappy"] * 4 < sizes[None]
    names = [n for n in os.listdir(path) if n.endswith(".json.snappy")]
    assert len(names) == 16                       # 50 records a task, 7 a file


def test_flat_reviews_are_landed_compressed(spark, monkeypatch):
    from conftest import SF_SMALL
    from revline import queries
    landed, write = [], landing.write_snapshot
    monkeypatch.setattr(landing, "write_snapshot", lambda *a, **kw: landed.append(write(*a, **kw)))
    queries.q_load_flat_reviews(spark, SF_SMALL)
    folder = landed[0].replace("file:", "")
    assert all(n.endswith(".snappy") for n in os.listdir(folder) if n.startswith("part-"))


def test_dense_snapshots_are_dealt_to_tasks_as_plain_ones(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "FILE_RECORDS", 500)
    rows = spark.range(0, 20_000, 1, 1).selectExpr(
        "id AS review_id", "repeat('the same words again ', 20) AS review_text")
    sizes, paths = {}, {}
    for kind in (None, "gzip"):
        paths[kind] = landing.write_snapshot(rows, str(tmp_path / str(kind)), "reviews", "2024-01-01", compression=kind)
        sizes[kind] = landing.snapshot_stamp(spark, paths[kind])[1]
    assert sizes["gzip"] * 10 < sizes[None]
    for path in paths.values():
        assert landing.landed_bytes(spark, path) == sizes[None]
    settings = {"spark.sql.files.maxPartitionBytes": "2m", "spark.sql.files.openCostInBytes": "0",
                "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in settings}

    def most(path):
        """Records of the largest split."""
        read = landing.read_snapshot(spark, path, LANDED_REVIEW).groupBy(F.spark_partition_id()).count()
        return max(r["count"] for r in read.collect())

    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        plain, dense = most(paths[None]), most(paths["gzip"])
        with landing.split_as_plain(spark, sizes["gzip"], sizes[None]):
            dealt = most(paths["gzip"])
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "2m"
        assert dealt <= plain + 500 < dense
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    empty = landing.write_snapshot(rows.limit(0), str(tmp_path / "empty"), "reviews", "2024-01-01", compression="gzip")
    assert landing.landed_bytes(spark, empty) == landing.snapshot_stamp(spark, empty)[1]
