import hashlib
import random
import zlib

import pytest

from revline.llm import merkle
from revline.llm.merkle import tamper_test

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _rank long, leaf string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def said(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, more=0):
    doc_id, text, lang, source, n_chars = r[:5]
    n = None if n_chars is None else n_chars + more
    return H(*map(said, (doc_id, source, lang, n, text)))


def tree(nodes):
    """The top, and of every node its list of (siblings before, siblings after) upward."""
    paths = [[] for _ in nodes]
    holds = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, over = [], []
        for k in range(0, len(nodes), 2):
            run = nodes[k:k + 2]
            for j in range(len(run)):
                for i in holds[k + j]:
                    paths[i].append((run[:j], run[j + 1:]))
            up.append(H(*run))
            over.append(sum(holds[k:k + 2], []))
        nodes, holds = up, over
    return nodes[0], paths


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    made = []
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang),
                      key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        made.append((mine, *tree([leaf_of(r) for r in mine])))
    root, over = tree([m[1] for m in made])
    out = []
    for (mine, top, paths), up in zip(made, over, strict=True):
        for r, path in zip(mine, paths, strict=True):
            whole = path + up
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = leaf_of(r, int(hit))
            for before, after in whole:
                folded = H(*before, folded, *after)
            proof = H(*(s for before, after in whole for s in before + after))
            out.append((r[0], leaf_of(r), top, root, proof, folded, folded == root))
    return out


def table(n, langs, seed=1):
    rng = random.Random(seed)
    return [(i * 3 % n, rng.choice([None, "", "é text", "x" * rng.randrange(50)]), rng.choice(langs),
             rng.choice([None, "web", "é"]), rng.choice([None, 0, 5, 999_999]), 7, "clash")
            for i in range(n)]


def same(spark, rows, **kw):
    got = [tuple(r) for r in tamper_test(spark.createDataFrame(rows, SCHEMA), **kw).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))
    return got


@pytest.mark.parametrize("n, langs", [(1, ["en"]), (3, ["de", None, "en"]), (700, ["en"]),
                                      (257, ["en", "zh", "é", "~", None])])
def test_same_as_the_plain_tree(spark, n, langs):
    got = same(spark, table(n, langs))
    if n > 100:
        assert {r[6] for r in got} == {True, False}


def test_three_rounds_of_segments_hot_group_and_many_groups(spark):
    langs = ["en"] * 60 + [f"l{k}" for k in range(40)] + [None]
    same(spark, table(300, langs), step=2, cell=16)


def test_null_ids_repeated_ids_and_rows(spark):
    rows = table(40, ["en", None])
    rows = rows + rows[:9] + rows[:3] + [(None, "a", "en", None, 1, 7, "c")] * 2 + [
        (4, "other text of the id", "en", "s", 3, 7, "c"), (None, None, None, None, None, None, None),
        (1, "w " * 200_000, "en", "s", 400_000, 7, "c")]
    same(spark, rows)


def test_empty_table(spark):
    assert tamper_test(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_record_under_another_digest_is_found():
    foot = [hashlib.sha256(bytes([k])).digest() for k in range(3)]
    top = merkle.fold(foot, 2)[-1][0]
    assert merkle._children(top, b"".join(foot), 2)[0] == foot
    with pytest.raises(ValueError):
        merkle._children(top, b"".join(foot[::-1]), 2)
    with pytest.raises(ValueError):
        merkle.fold(foot, 1)
