import random

import numpy as np
import pytest

from revline.llm import langid

SYLLABLES = {"aa": "th er ing on the of", "bb": "sch ung der keit und ä", "cc": "eau é que le tion ç",
             "dd": "ción ñ el que os ue", "ee": "ж щ на ст и не"}


def _doc(lang, rng):
    return " ".join("".join(rng.choices(SYLLABLES[lang].split(), k=rng.randrange(1, 4)))
                    for _ in range(rng.randrange(3, 60)))


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 8, 30])
def test_codewords_are_apart(n):
    code = langid.codewords(n)
    assert code.shape[0] == n and set(np.unique(code)) <= {-1.0, 1.0}
    gaps = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
    assert min(gaps, default=1) >= (1 if n < 3 else 2 ** (n - 2) if n <= 7 else 10)


def test_decoding_corrects_wrong_bits():
    model = langid.LanguageModel(list("abcde"), langid.codewords(5), None, None, np.ones(15), 0.6)
    for k, word in enumerate(model.code):
        for wrong in ([], [0], [3, 9], [1, 7, 14]):
            out = 4 * word.copy()
            out[wrong] *= -1
            best, score, _ = langid.decode(model, out[None, :])
            assert best[0] == k and score[0] > 0.5


def test_held_out_accuracy_and_cases(spark):
    rng = random.Random(2)
    rows = [(i, _doc(lang, rng), lang, "x") for i, lang in enumerate(rng.choices(list(SYLLABLES), k=600))]
    odd = [(9000, None, "aa", "x"), (9001, "", "aa", "x"), (9002, "123 --- !!!", "bb", "x"),
           (9003, "und " * 50_000, None, "x"), (9004, "é", "cc", "x"), (9005, "th", None, None),
           (9006, "² ½ Ⅷ ① ٣", "aa", "x"), (9007, "中", "aa", "x")]
    got = langid.held_out_languages(_frame(spark, rows + odd + rows[:3])).collect()
    assert len(got) == len(rows) + len(odd) + 3
    truth = {r[0]: r[2] for r in rows}
    out = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in out]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    for k in (9000, 9001, 9002, 9006):
        assert (by_id[k].lang_pred, by_id[k].score, by_id[k].ambiguous) == ("und", 0.0, True)
    assert by_id[9003].lang_pred == "bb"
    assert by_id[9004].lang_pred in SYLLABLES and by_id[9007].lang_pred in SYLLABLES


def test_mixed_text_is_ambiguous(spark):
    rng = random.Random(3)
    rows = [(i, _doc(lang, rng), lang, "x") for i, lang in enumerate(["aa", "bb", "cc"] * 100)]
    model = langid.train(_frame(spark, rows))
    rng = random.Random(8)
    texts = [_doc("aa", rng), _doc("bb", rng), "xyzw vwk"]
    got = {r.doc_id: r for r in langid.predict(
        _frame(spark, [(i, t, None, None) for i, t in enumerate(texts)]), model, ["doc_id"]).collect()}
    assert [got[0].lang_pred, got[1].lang_pred] == ["aa", "bb"]
    assert not got[0].ambiguous and got[2].score < min(got[0].score, got[1].score)


def test_scores_match_plain_sums(spark):
    rng = random.Random(6)
    rows = [(i, _doc(lang, rng), lang, "x") for i, lang in enumerate(["aa", "dd"] * 50)]
    model = langid.train(_frame(spark, rows))
    for r in langid.predict(_frame(spark, rows), model, ["doc_id"]).collect():
        data = np.frombuffer(rows[r.doc_id][1].encode(), np.uint8)
        x = langid.features(data, np.array([0, data.size]), model.weights.shape[0])
        best, score, _ = langid.decode(model, x.astype(np.float64) @ model.weights + model.bias)
        assert model.languages[best[0]] == r.lang_pred and abs(score[0] - r.score) < 1e-4


def test_nothing_to_learn_from_and_filter(spark):
    assert langid.held_out_languages(_frame(spark, [])).collect() == []
    one = langid.held_out_languages(_frame(spark, [(1, "abc", None, None)])).collect()
    assert one[0].lang_pred == "und" and one[0].score == 0
    rng = random.Random(1)
    rows = [(i, _doc("aa", rng), "aa", "x") for i in range(20)] + [(99, "...", "aa", "x")]
    df = _frame(spark, rows)
    left = langid.keep_determined(df, langid.train(df))
    assert left.schema == df.schema and {r.doc_id for r in left.collect()} == set(range(20))


def test_pipeline_stage_drops_what_the_decoder_cannot_place(spark):
    import corpus_pipeline

    rng = random.Random(5)
    langs = list(SYLLABLES) * 80
    rows = [(i, _doc(lang, rng), lang, "x") for i, lang in enumerate(langs)]
    clean = [(1000 + i, _doc(lang, rng), None, "x") for i, lang in enumerate(langs)]
    strange = [(5000, "qzxj wvkq jxqz " * 30, None, "x"), (5001, "漢字仮名交文章 " * 30, None, "x")]
    left = corpus_pipeline.language(spark, _frame(spark, rows + clean + strange), "").collect()
    assert {r.doc_id for r in left} == {r[0] for r in rows + clean}
    unlabelled = _frame(spark, [*clean[:20], (1, "12 -- .", None, "x"), (2, None, "aa", "x")])
    left = corpus_pipeline.language(spark, unlabelled, "").collect()
    assert {r.doc_id for r in left} == {r[0] for r in clean[:20]}


def test_stage_drops_texts_between_two_languages(spark):
    from dataclasses import replace

    rng = random.Random(12)
    rows = [(i, _doc(lang, rng), lang, "x") for i, lang in enumerate(list(SYLLABLES) * 80)]
    model = langid.train(_frame(spark, rows), farthest=True)
    assert 0 < model.least <= model.ambiguous
    words = {lang: " ".join(_doc(lang, rng) for _ in range(4)).split() for lang in SYLLABLES}
    texts = [" ".join(words[a][:m] + words[b][:n]) for a in words for b in words if a < b
             for m in (8, 15, 30) for n in range(1, 1 + len(words[b]))]
    mixed = [(1000 + n, text, None, "x") for n, text in enumerate(texts)]
    score = {r.doc_id: r.score for r in langid.predict(_frame(spark, mixed), model, ["doc_id"]).collect()}
    unsure = {i for i, s in score.items() if s < model.least}
    assert unsure                                 # kept before: any score would do
    near = replace(model, farthest=np.inf)
    left = {r.doc_id for r in langid.keep_determined(_frame(spark, rows + mixed), near).collect()}
    assert left == {r[0] for r in rows + mixed} - unsure
    every = langid.keep_determined(_frame(spark, rows + mixed), near, least=0.0)
    assert every.count() == len(rows + mixed)


def test_a_few_labelled_mixtures_move_no_limit(spark):
    import corpus_pipeline

    rng = random.Random(21)
    rows = [(i, _doc(lang, rng), lang, "x") for i, lang in enumerate(list(SYLLABLES) * 80)]

    def mixed(first, n):
        """Texts of three languages, word by word."""
        return [(first + k, " ".join(w for ws in zip(*(_doc(lang, rng).split() for lang in rng.sample(
            list(SYLLABLES), 3)), strict=False) for w in ws)) for k in range(n)]

    labelled = [(i, text, rng.choice(list(SYLLABLES)), "x") for i, text in mixed(2000, 12)]
    unknown = [(i, text, None, "x") for i, text in mixed(3000, 150)]
    df = _frame(spark, rows + labelled + unknown)
    model = langid.train(df, farthest=True)
    assert model.least == model.ambiguous         # before: what the worst labelled text had
    got = {r.doc_id: r for r in langid.predict(df, model, ["doc_id"], with_loss=True).collect()}
    unsure = {i for i, r in got.items() if r.ambiguous}
    assert unsure & {r[0] for r in unknown}       # kept before
    left = {r.doc_id for r in corpus_pipeline.language(spark, df, "").collect()}
    assert left == {i for i, r in got.items() if not r.ambiguous and r.loss <= model.farthest}
    assert {r[0] for r in rows} <= left


def test_labels_that_do_not_follow_from_the_texts_drop_nothing(spark):
    rng = random.Random(22)
    rows = [(i, _doc("aa", rng), rng.choice(["de", "en"]), "x") for i in range(120)]
    df = _frame(spark, rows)
    model = langid.train(df, farthest=True)
    assert model.least < model.ambiguous
    assert langid.keep_determined(df, model).count() == len(rows)


def test_every_language_is_learned(spark):
    rng = random.Random(9)
    words = {f"l{k:02}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(6)]
             for k in range(80)}
    rows = [(i, " ".join(rng.choices(words[lang], k=25)), lang, "x")
            for i, lang in enumerate([*words, *list(words)[:70]] * 4)]
    df = _frame(spark, rows)
    for most in (25_600, 200):
        model = langid.train(df, max_rows=most)
        assert model.languages == sorted(words)
        got = langid.predict(df, model, ["doc_id"]).collect()
        assert np.mean([r.lang_pred == rows[r.doc_id][2] for r in got]) > 0.95
