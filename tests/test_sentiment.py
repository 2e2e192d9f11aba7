import os

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revline.operators import sentiment as S
from revline.sources import testdata

from conftest import SF_SMALL


def test_python_and_jvm_lexicon_agree_on_documents(spark):
    docs = testdata.table(spark, SF_SMALL, "documents").select(
        F.col("doc_id").alias("review_id"), F.coalesce("text", F.lit("")).alias("text"))
    extra = spark.createDataFrame(
        [(-1, "Good, GOOD! bad... terrible"), (-2, "goodness badly"), (-3, ""), (-4, "GREAT great great poor")],
        "review_id long, text string")
    texts = docs.unionByName(extra)
    py = {r.review_id: (r.sentiment_label, r.sentiment_score) for r in S.score_texts(texts, S.lexicon_factory).collect()}
    jvm = {r.review_id: (r.sentiment_label, r.sentiment_score) for r in S.score_texts(texts, None).collect()}
    assert py == jvm
    assert py[-1] == ("neutral", 0.6)           # 2 vs 2: balanced
    assert py[-2] == ("neutral", 1.0)           # no whole-word hit
    assert py[-3] == ("neutral", 1.0)
    assert py[-4] == ("positive", 0.7)          # 3 vs 1


def test_label_map_and_rounding_in_python_path(spark):
    def factory():
        return lambda texts: [("LABEL_0", 0.123449), ("LABEL_1", 0.99995), ("LABEL_2", 0.5), ("other", 0.1)][:len(texts)]
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "review_id long, text string").coalesce(1)
    got = {r.review_id: (r.sentiment_label, r.sentiment_score)
           for r in S.score_texts(df, factory, batch_size=4).collect()}
    assert got == {1: ("negative", 0.1234), 2: ("neutral", round(0.99995, 4)), 3: ("positive", 0.5),
                   4: ("other", 0.1)}


def test_truncation_and_empty_texts_reach_scorer(spark):
    def factory():
        # reports the length of what it was given, as a score
        return lambda texts: [("LABEL_1", len(t) / 10000) for t in texts]

    df = spark.createDataFrame([(1, "x" * 1000), (2, ""), (3, None)], "review_id long, text string")
    whole = {r.review_id: r.sentiment_score for r in S.score_texts(df, factory).collect()}
    assert whole == {1: 0.1, 2: 0.0, 3: 0.0}                  # whole texts by default
    cut = {r.review_id: r.sentiment_score
           for r in S.score_texts(df, factory, max_chars=S.MODEL_INPUT_CHARS).collect()}
    assert cut == {1: 0.0512, 2: 0.0, 3: 0.0}                 # model input cut on request


def test_lexicon_reads_past_the_model_cut(spark):
    df = spark.createDataFrame([(1, "x " * 600 + "great")], "review_id long, text string")
    assert S.score_texts(df).first().sentiment_label == "positive"
    assert S.score_texts(df, max_chars=S.MODEL_INPUT_CHARS).first().sentiment_label == "neutral"


def test_review_texts_fallback_and_limit(spark):
    fact = spark.createDataFrame([(3, "t3", "s3"), (1, None, "s1"), (2, None, None)],
                                 "review_id long, review_text string, summary string")
    got = {r.review_id: r.text for r in S.review_texts(fact).collect()}
    assert got == {1: "s1", 2: "", 3: "t3"}
    assert [r.review_id for r in S.review_texts(fact, limit=2).collect()] == [1, 2]
    assert S.review_texts(fact, limit=0).count() == 3


def test_empty_fact_gives_empty_table(spark):
    fact = spark.createDataFrame([], "review_id long, review_text string, summary string")
    assert S.sentiment_table(fact).count() == 0
    assert S.sentiment_table(fact, S.lexicon_factory).count() == 0


def test_model_is_loaded_once_a_process(spark, tmp_path):
    log = str(tmp_path / "loads")

    def factory():
        with open(log, "a") as f:
            f.write(f"{os.getpid()}\n")
        return lambda texts: [(f"{os.getpid()}", 0.5) for _ in texts]

    def other():
        return lambda texts: [("LABEL_2", 0.25) for _ in texts]

    df = spark.range(400).selectExpr("id AS review_id", "repeat('x', cast(id % 7 AS int)) AS text").repartition(20)
    served = set()
    for _ in range(2):                               # two queries, 20 tasks each
        served |= {r.sentiment_label for r in S.score_texts(df, factory).collect()}
    loads = open(log).read().split()
    assert set(loads) >= served and len(loads) == len(set(loads)) <= 4
    assert {r.sentiment_label for r in S.score_texts(df, other).collect()} == {"positive"}


def test_processes_hold_a_few_models(monkeypatch):
    monkeypatch.setattr(S, "_SCORERS", {})
    made = []
    for k in [1, 2, 1, 3, 4, 5, 5, 1]:
        S.scorer_of(str(k), lambda k=k: made.append(k))
    assert made == [1, 2, 3, 4, 5, 1] and len(S._SCORERS) == S.MOST_SCORERS


@given(st.lists(st.integers(0, 50), max_size=40), st.integers(1, 6), st.one_of(st.none(), st.integers(1, 120)))
def test_batches_by_length(lengths, size, chars):
    batches = list(S.length_batches(lengths, size, chars))
    assert sorted(i for b in batches for i in b) == list(range(len(lengths)))
    flat = [lengths[i] for b in batches for i in b]
    assert flat == sorted(flat)
    for b in batches:
        assert len(b) <= size
        assert len(b) == 1 or chars is None or len(b) * max(lengths[i] for i in b) <= chars


def test_results_return_to_their_rows_and_wrong_counts_raise(spark):
    def factory():
        return lambda texts: [(t[:1], len(t) / 1000) for t in texts]
    rows = [(i, "abc"[i % 3] * (i * 37 % 91 + 1)) for i in range(200)]
    df = spark.createDataFrame(rows, "review_id long, text string")
    got = {r.review_id: (r.sentiment_label, r.sentiment_score)
           for r in S.append_scores(df, "text", factory, batch_size=8, batch_chars=300).collect()}
    assert got == {i: (t[0], round(len(t) / 1000, 4)) for i, t in rows}

    def short():
        return lambda texts: [("LABEL_1", 0.5)] * (len(texts) - 1)
    import pytest
    with pytest.raises(Exception, match="zip"):
        S.score_texts(df, short).collect()
