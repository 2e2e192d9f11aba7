"""Pruned top-k recommendations against a brute-force reference on small frames."""

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from revline.operators import recommend as R

DIM = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("title", T.StringType()),
    T.StructField("title_display", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("tag_primary", T.StringType()), T.StructField("avg_score", T.DecimalType(5, 2)),
    T.StructField("release_year", T.IntegerType()), T.StructField("studio", T.StringType()),
])


def brute_force(items, reviews, k, min_reviews):
    """All tag-sharing pairs, distinct, ranked: the definition, on pandas."""
    rv = pd.DataFrame(reviews, columns=["review_id", "item_id", "score", "label", "sent"])
    g = rv.groupby("item_id")
    st_ = pd.DataFrame({"n": g.size(), "pos": g["label"].apply(lambda s: (s == "positive").sum())})
    st_ = st_[st_["n"] >= min_reviews]
    scored = {}
    for iid, tags, comm in items:
        if iid in st_.index:
            n, pos = int(st_.loc[iid, "n"]), int(st_.loc[iid, "pos"])
            r = (2 * pos * 10000 + n) // (2 * n)
            c = int(round(comm * 100)) if comm is not None else None
            sc = (6 * r + 4 * c + 5) // 10
            scored[iid] = (set(tags or []), sc, n)
    out = []
    for s, (stags, _, _) in scored.items():
        cands = [t for t, (ttags, _, _) in scored.items() if t != s and stags & ttags]
        cands.sort(key=lambda t: (-scored[t][1], -scored[t][2], t))
        out += [(s, t, i + 1) for i, t in enumerate(cands[:k])]
    return sorted(out)


def run_spark(spark, items, reviews, k, min_reviews):
    from decimal import Decimal
    dim = spark.createDataFrame(
        [(i, f"t{i}", f"T{i}", tags, (tags or [None])[0] if tags else None,
          None if c is None else Decimal(str(c)), 2000, "s") for i, tags, c in items], DIM)
    fact = spark.createDataFrame([(r, i, s) for r, i, s, _, _ in reviews], "review_id long, item_id long, score int")
    sent = spark.createDataFrame([(r, lab, se) for r, _, _, lab, se in reviews],
                                 "review_id long, sentiment_label string, sentiment_score double")
    stats = R.item_sentiment_stats(fact, sent, min_reviews)
    recs = R.recommend(dim, stats, k)
    return sorted((r.source_item_id, r.recommended_item_id, r.rank) for r in recs.collect())


TAGS = ["a", "b", "c", "d", "e", "f"]
item_st = st.tuples(st.lists(st.sampled_from(TAGS), max_size=3), st.sampled_from([50.0, 75.5, 100.0]))
review_st = st.tuples(st.integers(0, 29), st.sampled_from(["positive", "neutral", "negative"]))


@settings(max_examples=8, deadline=None)
@given(st.lists(item_st, min_size=2, max_size=30), st.lists(review_st, min_size=1, max_size=150),
       st.integers(1, 4), st.integers(1, 3))
def test_pruned_equals_brute_force(spark, items_raw, reviews_raw, k, min_reviews):
    items = [(i, tags, c) for i, (tags, c) in enumerate(items_raw)]
    n_items = len(items)
    reviews = [(j, it % n_items, 50, lab, 0.5) for j, (it, lab) in enumerate(reviews_raw)]
    assert run_spark(spark, items, reviews, k, min_reviews) == \
        brute_force(items, reviews, k, min_reviews)


def test_repeated_and_empty_tags_and_thin_items(spark):
    items = [(1, ["x", "x"], 80.0), (2, ["x"], 80.0), (3, [], 90.0), (4, None, 90.0), (5, ["x"], 10.0),
             (6, ["x"], 99.0)]
    reviews = [(i * 10 + j, i, 50, "positive", 0.9) for i in (1, 2, 3, 4, 5) for j in range(3)]
    reviews += [(100, 6, 50, "positive", 0.9)]          # item 6 has one review: excluded at min 2
    got = run_spark(spark, items, reviews, 2, 2)
    assert got == brute_force(items, reviews, 2, 2)
    assert got == [(1, 2, 1), (1, 5, 2), (2, 1, 1), (2, 5, 2), (5, 1, 1), (5, 2, 2)]


def test_output_columns(spark):
    items = [(1, ["x"], 80.0), (2, ["x"], 70.0)]
    reviews = [(1, 1, 40, "positive", 0.91), (2, 1, 61, "negative", 0.5),
               (3, 2, 10, "neutral", 0.3333), (4, 2, 11, "positive", 0.6668)]
    from decimal import Decimal
    dim = spark.createDataFrame([(i, f"t{i}", f"T{i}", t, t[0], Decimal(str(c)), 2000, "s") for i, t, c in items], DIM)
    fact = spark.createDataFrame([(r, i, s) for r, i, s, _, _ in reviews], "review_id long, item_id long, score int")
    sent = spark.createDataFrame([(r, lab, se) for r, _, _, lab, se in reviews],
                                 "review_id long, sentiment_label string, sentiment_score double")
    recs = R.recommend(dim, R.item_sentiment_stats(fact, sent, 2), 10)
    assert len(recs.columns) == 16
    r = {x.source_item_id: x for x in recs.collect()}
    assert r[2].recommended_positive_ratio == 0.5 and r[2].recommended_avg_review_score == 50.5
    assert r[2].recommended_avg_sentiment == 0.705          # mean of 0.91 and 0.5
    # (0.3333 + 0.6668) / 2 = 0.50005: a float mean may land on either side;
    # the exact integer mean rounds half up
    assert r[1].recommended_avg_sentiment == 0.5001
    assert r[1].recommended_avg_review_score == 10.5
    assert r[2].recommendation_score == 0.62                # 0.6*0.5 + 0.4*0.8


def test_skewed_inputs_equal_brute_force(spark):
    import random
    rnd = random.Random(7)
    tags = [f"t{i}" for i in range(12)]
    items = []
    for i in range(60):
        if i == 0:
            item_tags = tags + [f"rare{j}" for j in range(40)]       # a huge tag list
        elif i % 3 == 0:
            item_tags = ["hot"]                                      # a third of items share one tag
        else:
            item_tags = rnd.sample(tags, 2)
        items.append((i, item_tags, rnd.choice([60.0, 70.0, 80.0, 90.0])))
    reviews = []
    for j in range(900):
        item = 1 if j % 3 == 0 else rnd.randrange(60)                # item 1: a third of reviews
        reviews.append((j, item, 50, rnd.choice(["positive", "neutral", "negative"]), 0.5))
    for k in (3, 10):
        assert run_spark(spark, items, reviews, k, 2) == brute_force(items, reviews, k, 2)


def test_hot_tags_are_salted_by_their_share(spark, monkeypatch):
    monkeypatch.setattr(R.hot_tags, "__defaults__", (0.1,))
    from decimal import Decimal
    import random
    rnd = random.Random(11)
    items = [(i, ["hot"] if i % 2 else rnd.sample(["a", "b", "c", "d"], 2), rnd.choice([50.0, 90.0]))
             for i in range(40)]
    reviews = [(j, rnd.randrange(40), 50, rnd.choice(["positive", "negative"]), 0.5) for j in range(400)]
    dim = spark.createDataFrame(
        [(i, f"t{i}", f"T{i}", t, t[0], Decimal(str(c)), 2000, "s") for i, t, c in items], DIM)
    fact = spark.createDataFrame([(r, i, s) for r, i, s, _, _ in reviews], "review_id long, item_id long, score int")
    sent = spark.createDataFrame([(r, lab, se) for r, _, _, lab, se in reviews],
                                 "review_id long, sentiment_label string, sentiment_score double")
    stats = R.item_sentiment_stats(fact, sent, 2)
    iws = R.materialize(R.items_with_stats(dim, stats))
    salts = R.hot_tags(iws)
    assert salts["hot"] > 2                       # a third of the rows, a tenth each
    recs = R.recommend(dim, stats, 3)
    got = sorted((r.source_item_id, r.recommended_item_id, r.rank) for r in recs.collect())
    assert got == brute_force(items, reviews, 3, 2)
