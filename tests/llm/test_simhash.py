import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from revline.llm import simhash

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu of the a".split()


def _texts(n, seed=3):
    rng = random.Random(seed)
    return [" ".join(rng.choices(WORDS, k=rng.randrange(0, 40))) for _ in range(n)]


def _hashes(spark, words):
    df = spark.createDataFrame([(w,) for w in sorted(words)], "w string")
    return {r.w: r.h % (1 << 64) for r in df.select("w", F.xxhash64("w").alias("h")).collect()}


def _terms(text):
    if re.search(r"[^\W_]", text):
        return [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return [w for w in re.split(r"\s+", text.lower()) if w]


def _brute(text, hashes):
    total, votes = 0, [0] * 64
    for w in _terms(text):
        weight = max(1, len(w) - 2)
        total += weight
        for j in range(64):
            votes[j] += weight * (hashes[w] >> j & 1)
    return sum(1 << j for j in range(64) if 2 * votes[j] > total)


def _expect(ids_texts, hashes):
    rows = sorted(ids_texts, key=lambda x: x[0])
    for i, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        a, b, c = (_brute(t, hashes) for t in (text, edited, following))
        yield doc, (len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{a:016x}",
                    f"{b:016x}", 1 - (a ^ b).bit_count() / 64, 1 - (a ^ c).bit_count() / 64)


@pytest.mark.parametrize("spread", [1, 1000, 1 << 40])
def test_edits_match_brute_force(spark, spread):
    texts = [None, "", "!!! ... ???", "Élan vital 中文 \U0001f600 x", "word " * 3000, *_texts(150)]
    texts += texts[10:15]
    data = [((i - 20) * spread, t) for i, t in enumerate(texts)]
    edited = [t for _, t in data] + ["".join((a or "")[:(len(a or "") + 1) // 2] + (b or "")[:len(a or "") // 2])
                                     for a, b in zip(texts, texts[1:] + texts[:1], strict=True)]
    hashes = _hashes(spark, {w for t in edited for w in _terms(t or "")})
    df = spark.createDataFrame([(i, t, 7) for i, t in data], "doc_id long, text string, fingerprint int")
    rows = simhash.fingerprints_of_edits(df.repartition(7)).collect()
    got = {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint,
                      r.near_edited, r.near_next) for r in rows}
    assert len(rows) == len(data)
    assert got == dict(_expect(data, hashes))
    fps = [int(r.fingerprint, 16) for r in rows]
    for r in rows:
        want = sum((int(r.fingerprint, 16) ^ x).bit_count() <= 3 for x in fps)
        assert r.near_rows == (want if r.doc_id % 50 == 0 else None)


def test_near_fingerprints_match_brute_force(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = [x ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for x in base * 10]
    fps = [x - (1 << 64) if x >> 63 else x for x in fps] + [0, -1, None]
    df = spark.createDataFrame([(x,) for x in fps], "fingerprint long")
    got = {(r.query, r.found): r.distance for r in simhash.near_fingerprints(df, df).collect()}
    known = {x for x in fps if x is not None}
    want = {(a, b): d for a in known for b in known
            if (d := ((a ^ b) % (1 << 64)).bit_count()) <= 3}
    assert got == want


def test_edge_inputs(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.fingerprints_of_edits(empty).collect() == []
    assert simhash.fingerprints(empty).collect() == []
    one = simhash.fingerprints_of_edits(spark.createDataFrame([(5, "ab cd")], "doc_id long, text string")).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"ab ab").hexdigest() and one[0].near_next == 1.0
    odd = spark.createDataFrame([(None, "x"), (1, "a"), (1, "a"), (1, None)], "doc_id long, text string")
    assert simhash.fingerprints_of_edits(odd).count() == 4


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = simhash.fingerprints_of_edits(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan
