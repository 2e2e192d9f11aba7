import math
import random
from collections import Counter

import pytest

from revline.llm import backoff


def _brute(texts, order):
    docs = [(t or "").replace("\x0b", " ").replace("\x0c", " ").split() for t in texts]
    grams = lambda w: Counter(tuple(w[i:i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))
    all_of = sum((grams(w) for w in docs), Counter())
    total = sum(map(len, docs))
    for w in docs:
        own = grams(w)
        c = lambda g, own=own: all_of[g] - own[g]
        rest = max(1, total - len(w))
        log_score = full = unseen = 0
        for i in range(len(w)):
            factor = 1.0
            for n in range(min(order, i + 1), 1, -1):
                g = tuple(w[i - n + 1:i + 1])
                if c(g) > 0:
                    log_score += math.log(factor * c(g) / c(g[:-1]))
                    break
                factor *= 0.4
            else:
                log_score += math.log(factor * (c((w[i],)) or 0.4) / rest)
            full += i >= order - 1 and c(tuple(w[i - order + 1:i + 1])) > 0
            unseen += c((w[i],)) == 0
        yield len(w), log_score, full, unseen


@pytest.mark.parametrize("order,block_bytes", [(1, 300), (2, 300), (2, 1 << 24), (3, 1000)])
def test_scores_match_plain_counting(spark, monkeypatch, order, block_bytes):
    monkeypatch.setattr(backoff, "BLOCK_BYTES", block_bytes)
    rng = random.Random(order)
    texts = [" ".join(rng.choices("a b c dd ee fé the of x. y,".split() + [f"r{i}" for i in range(40)],
                                  k=rng.randrange(0, 30))) for _ in range(120)]
    texts += [None, "", " \n\t ", "only", "the\tof\nthe  of", "a b " * 3000, texts[0], texts[1]]
    df = spark.createDataFrame([(i * 3, t, 9) for i, t in enumerate(texts)],
                               "doc_id long, text string, n_words int")
    rows = backoff.backoff_scores(df.repartition(6), order).collect()
    got = {r.doc_id // 3: r for r in rows}
    assert len(rows) == len(texts) == len(got)
    for i, (n, log_score, full, unseen) in enumerate(_brute(texts, order)):
        r = got[i]
        assert (r.n_words, r.full_order, r.unseen) == (n, full, unseen)
        assert math.isclose(r.log_score, log_score, rel_tol=1e-9, abs_tol=1e-9)
        assert r.mean_log_score is None if n == 0 else math.isclose(r.mean_log_score, r.log_score / n)


def test_cases(spark):
    assert backoff.backoff_scores(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    alone = backoff.backoff_scores(spark.createDataFrame([(1, "a a")], "doc_id long, text string")).collect()
    assert math.isclose(alone[0].log_score, 2 * math.log(0.4) + math.log(0.4)) and alone[0].unseen == 2
    odd = spark.createDataFrame([(None, "a b"), (None, "a b"), (4, "a b"), (4, "b")], "doc_id long, text string")
    rows = backoff.backoff_scores(odd).collect()
    assert sorted(r.n_words for r in rows) == [1, 2, 2, 2]
    assert len({r.log_score for r in rows if r.n_words == 2}) == 1
