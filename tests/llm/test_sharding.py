import hashlib
import random
from collections import defaultdict

import pytest

from revline.llm import sharding


def _hash(key):
    return int(hashlib.md5(str(key).encode()).hexdigest()[:15], 16)


def _brute(rows, limit):
    """Split recursively; keys here differ in their hash."""
    out = {}

    def split(group, depth):
        if sum(n for _, n in group) <= limit or len(group) == 1:
            for k, n in group:
                out[k] = (n, format(_hash(k), "060b")[:depth], sum(n for _, n in group), len(group))
            return
        for bit in "01":
            if part := [(k, n) for k, n in group if format(_hash(k), "060b")[depth] == bit]:
                split(part, depth + 1)

    split(rows, 0)
    return out


@pytest.mark.parametrize("limit", [50, 1000, 10**9])
def test_shards_match_recursive_splitting(spark, limit):
    rng = random.Random(4)
    rows = [(i, rng.randrange(0, 90)) for i in range(400)] + [(400, 5000)]
    df = spark.createDataFrame([(i, "é" * (n // 2) + "x" * (n % 2), 3) for i, n in rows],
                               "doc_id long, text string, bytes int")
    got = sharding.extendible_shards(df, limit).collect()
    found = {r.doc_id: (r.bytes, r.shard, r.shard_bytes, r.shard_rows) for r in got}
    assert len(got) == len(rows)
    want = _brute(rows, limit)
    alone = {k for k, v in want.items() if v[2] > limit}  # one row beyond the limit: any prefix of its own
    assert {k: v for k, v in found.items() if k not in alone} == {
        k: v for k, v in want.items() if k not in alone}
    for k in alone:
        assert found[k][2:] == want[k][2:] and found[k][1].startswith(want[k][1])


def test_one_hot_key_is_split(spark):
    df = spark.createDataFrame([(7, "x" * 10)] * 300 + [(i, "y" * 10) for i in range(600)] + [(None, None)],
                               "doc_id long, text string")
    rows = sharding.extendible_shards(df, 200).collect()
    size = defaultdict(int)
    for r in rows:
        size[r.shard] += r.bytes
    assert len(rows) == 901 and max(size.values()) <= 200
    assert all(size[r.shard] == r.shard_bytes and r.depth == len(r.shard) for r in rows)
    names = sorted(size)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:], strict=False))


def test_a_hot_key_is_split_by_the_writer(spark, tmp_path):
    rows = [(7, "x" * 100, i, "a") for i in range(300)] + [(i, "y" * 100, i, "b") for i in range(600)]
    rows += [(7, "x" * 100, 0, "a")] * 30 + [(None, None, 0, "c"), (None, "n" * 50, 1, "c")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int, row0 string").repartition(7)
    out = sharding.write_shards(df, str(tmp_path / "hot"), 2000)
    assert sorted(map(str, out.drop("_shard").collect())) == sorted(map(str, df.collect()))
    size = out.groupBy("_shard").agg({"text": "count"}).collect()
    assert len(size) > 30
    assert all(r[0] <= 2000 for r in out.selectExpr("_shard", "coalesce(octet_length(text), 0) AS n")
               .groupBy("_shard").sum("n").select("sum(n)").collect())
    hot = out.where("doc_id = 7").select("_shard").distinct().count()
    assert hot >= 17
    # the query's form, over a scanned table
    df.drop("shard").write.parquet(str(tmp_path / "table"))
    report = sharding.written_shards(spark.read.parquet(str(tmp_path / "table")), str(tmp_path / "out"), 2000)
    got = report.collect()
    assert len(got) == len(rows) and max(r.shard_bytes for r in got) <= 2000
    size = defaultdict(lambda: [0, 0])
    for r in got:
        size[r.shard][0] += r.bytes
        size[r.shard][1] += 1
    assert all([r.shard_bytes, r.shard_rows] == size[r.shard] and r.depth == len(r.shard) for r in got)


def test_empty_table_and_written_shards(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.extendible_shards(empty, 10).collect() == []
    assert sharding.write_shards(empty, str(tmp_path / "none"), 10).collect() == []
    df = spark.createDataFrame([(i, "t" * 10, "keep") for i in range(100)],
                               "doc_id long, text string, source string")
    out = sharding.write_shards(df, str(tmp_path / "shards"), 100)
    assert out.count() == 100 and set(out.columns) == {*df.columns, "shard"}
    assert out.groupBy("shard").count().where("count > 10").count() == 0
