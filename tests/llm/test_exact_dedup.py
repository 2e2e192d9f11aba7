from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from revline.llm import exact_dedup

TEXTS = ["same", None, "", "same", "Same", "same ", "x" * 200_000, "x" * 200_000, "z", "z"]


def _frame(spark, texts):
    rows = [(i, t, "a", "b") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, keep_id string, _d string")


def _brute(texts):
    same = defaultdict(list)
    for i, t in enumerate(texts):
        same[t or ""].append(i)
    return {i: (max(g), len(g), i == max(g)) for g in same.values() for i in g}


@pytest.mark.parametrize("digest", [
    exact_dedup.sha256_hex,
    lambda c: F.substring(F.sha2(c, 256), 1, 1),  # many collisions
    lambda c: F.lit("one"),
])
@pytest.mark.parametrize("salt_rows", [1000, 2])
def test_groups_match_brute_force(spark, monkeypatch, digest, salt_rows):
    monkeypatch.setattr(exact_dedup, "ROWS_PER_SALT", salt_rows)
    got = exact_dedup.exact_groups(_frame(spark, TEXTS), digest=digest).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in got} == _brute(TEXTS)
    assert len(got) == len(TEXTS)


def test_empty_and_repeated_rows(spark):
    assert exact_dedup.exact_groups(_frame(spark, [])).collect() == []
    twice = _frame(spark, ["a"]).union(_frame(spark, ["a", "b"]))
    got = sorted(map(tuple, exact_dedup.exact_groups(twice).select(
        "doc_id", "keep_id", "group_size", "kept").collect()))
    assert got == [(0, 0, 2, True), (0, 0, 2, True), (1, 1, 1, True)]
    assert exact_dedup.drop_exact_copies(twice).count() == 2


def test_null_ids(spark):
    df = spark.createDataFrame([(None, "a"), (3, "a"), (None, "b")], "doc_id long, text string")
    got = sorted(map(tuple, exact_dedup.exact_groups(df).select(
        "doc_id", "keep_id", "kept", "group_size").collect()), key=str)
    assert got == [(3, 3, True, 2), (None, 3, False, 2), (None, None, True, 1)]


def test_drop_exact_copies_keeps_columns(spark):
    df = _frame(spark, TEXTS)
    left = exact_dedup.drop_exact_copies(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(
        {k for k, _, _ in _brute(TEXTS).values()})
