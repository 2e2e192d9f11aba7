import random

import numpy as np
import pyarrow as pa

from revline.llm import quality_fm, textvec


def _clean(rng):
    return ". ".join(" ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9)))
                              for _ in range(rng.randrange(4, 12))).capitalize()
                     for _ in range(rng.randrange(1, 9))) + "."


def _junk(rng):
    kind = rng.randrange(3)
    if kind == 0:
        return " ".join(w.upper() + "!!" for w in _clean(rng).split())
    if kind == 1:
        return "\n".join(["| a | b | c |"] * rng.randrange(5, 20))
    return " ".join(w + rng.choice(["%%%", "$$$"]) for w in _clean(rng).split())


def _tables(spark, n=500):
    rng = random.Random(7)
    y = [int(rng.random() < 0.7) for _ in range(n)]
    docs = spark.createDataFrame(
        [(i, _clean(rng) if v else _junk(rng), "en", "s", 0.5) for i, v in enumerate(y)],
        "doc_id long, text string, lang string, source string, score double")
    labels = spark.createDataFrame([(i, v, 0) for i, v in enumerate(y)] + [(-1, 1, 0), (None, 0, 0), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    return docs, labels, y


def _model(n_buckets=64, rank=3, seed=1):
    rng = np.random.default_rng(seed)
    n = n_buckets + len(quality_fm.STATISTICS)
    return quality_fm.QualityModel(0.3, rng.normal(size=n), rng.normal(size=(n, rank)),
                                   np.full(len(quality_fm.STATISTICS), 0.2),
                                   np.full(len(quality_fm.STATISTICS), 1.5), n_buckets)


def test_scores_match_all_pairs():
    model = _model()
    texts = ["the the cat", "", None, "One TWO!!\n| x |\n| x |\n\n", "é ü 中 %%%", " \n\t "]
    data, offs = textvec.utf8(pa.array(texts))
    row, bucket, value, stats = quality_fm.extract(data, offs, 64)
    got = model.scores(data, offs)
    for i in range(len(texts)):
        x = np.zeros(64 + stats.shape[1])
        x[bucket[row == i]] = value[row == i]
        x[64:] = quality_fm.standardise(stats[i:i + 1], model.mean, model.scale)[0]
        z = model.bias + x @ model.linear + sum(
            x[a] * x[b] * (model.factors[a] @ model.factors[b])
            for a in range(x.size) for b in range(a + 1, x.size))
        assert abs(got[i] - 1 / (1 + np.exp(-z))) < 1e-9


def test_statistics_do_not_depend_on_the_batch():
    rng = random.Random(0)
    texts = [_clean(rng) + "\n" + _junk(rng) for _ in range(20)] + ["", "x" * 100_000]
    _, _, _, together = quality_fm.extract(*textvec.utf8(pa.array(texts)), 64)
    for i, t in enumerate(texts):
        alone = quality_fm.extract(*textvec.utf8(pa.array([t])), 64)[3][0]
        assert np.allclose(alone, together[i], atol=1e-12)
    k = quality_fm.STATISTICS.index("different lines")
    two = quality_fm.extract(*textvec.utf8(pa.array(["a\na\nb\n", "a\nb"])), 64)[3]
    assert np.allclose(two[:, k], [2 / 3, 1])


def test_held_out_accuracy_and_filter(spark):
    docs, labels, y = _tables(spark)
    got = quality_fm.held_out_quality(docs, labels).collect()
    assert len(got) == len(y)
    out = [r for r in got if r.held_out]
    assert 100 < len(out) < 250
    assert np.mean([r.predicted == y[r.doc_id] for r in out]) > 0.97
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    left = quality_fm.keep_good(docs, quality_fm.train(docs, labels))
    assert left.schema == docs.schema
    assert np.mean([y[r.doc_id] for r in left.collect()]) > 0.97


def test_cases(spark):
    docs, labels, _ = _tables(spark, 60)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "", "", 0.0), (1, "", "", "", 0.0)], docs.schema)
    rows = quality_fm.held_out_quality(docs.union(odd), labels).collect()
    assert len(rows) == 63 and all(r.score is not None for r in rows)
    empty = [r.score for r in rows if r.doc_id is None]
    assert empty == [next(r.score for r in quality_fm.score(odd, quality_fm.train(
        docs.union(odd).where(~quality_fm.held_out("doc_id", 3, 1)),
        labels.where(~quality_fm.held_out("doc_id", 3, 1))), ["doc_id"]).collect() if r.doc_id is None)]
    none = quality_fm.held_out_quality(docs, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    assert quality_fm.held_out_quality(docs.limit(0), labels).collect() == []
