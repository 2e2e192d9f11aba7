import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from revline.llm import nbest

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "a", "the  double   spaces ", "line\nbreak\ttab", "é 中文 \U0001f600 ▁ mark",
         "word " * 4000, "x" * 3000, "\u0000\u0007", "Ein Satz, und noch einer."]


def _all_paths(lattice, s):
    """Every segmentation of s with its score, by recursion."""
    if not s:
        yield 0.0, b""
        return
    ends = [j for j in range(1, len(s) + 1) if s[:j] in lattice.edges]
    heads = [(lattice.edges[s[:j]][1], np.array([lattice.edges[s[:j]][0]], "<u4").tobytes(), j) for j in ends]
    if 1 not in ends:
        heads.append((lattice.unknown_score, lattice._spell(s, (0, -1, None)), 1))
    for score, ids, j in heads:
        for rest, tail in _all_paths(lattice, s[j:]):
            yield score + rest, ids + tail


def _check(lattice, text, n):
    got = lattice.encode(text, n)
    want = sorted(_all_paths(lattice, " " + text), key=lambda x: -x[0])
    assert [round(s, 6) for s, _ in got] == [round(s, 6) for s, _ in want[:n]], text
    assert len({ids for _, ids in got}) == len(got)
    scores = {}
    for s, ids in want:
        scores.setdefault(ids, set()).add(round(s, 6))
    assert all(round(s, 6) in scores[ids] for s, ids in got)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_nbest_matches_all_segmentations(n):
    lattice = nbest.PieceLattice.load(MODEL)
    rng = random.Random(n)
    for _ in range(60):
        text = "".join(rng.choices(["th", "e", " ", "er", "an", "é", "\n", "中", "a"], k=rng.randrange(1, 7)))
        _check(lattice, text, n)


@pytest.mark.parametrize("crossing", [False, True])
def test_small_models(crossing):
    rng = random.Random(4)
    pieces = ["", "a", "b", "▁", "ab", "ba", "▁a", "aab", "▁▁", "bb"] + (
        ["b▁a"] if crossing else [])
    lattice = nbest.PieceLattice([(p, -rng.randrange(1, 9) * 0.5) for p in pieces], None)
    for _ in range(80):
        _check(lattice, "".join(rng.choices("ab c", k=rng.randrange(1, 9))), 6)


def test_best_path_beats_the_library_segmentation():
    """Any other segmentation, such as greedy merging, scores no higher."""
    lattice = nbest.PieceLattice.load(MODEL)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in ["the quick brown fox", "Enberber erlichungst", "éeau de ciónraieco", "unbelievable things"]:
        ids = sp.encode(text)
        assert lattice.encode(text, 1)[0][0] >= sum(sp.get_score(i) for i in ids)
        assert lattice.decode(np.array(ids)) == sp.decode(ids) == text


def test_round_trip_and_cases(spark):
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(TEXTS)], "doc_id long, text string, rank int")
    rows = nbest.encode_nbest(df, MODEL, 3).collect()
    assert all(r.round_trip for r in rows)
    assert [r.n_pieces for r in rows if r.doc_id in (0, 1)] == [0, 0]
    for r in rows:
        assert len(r.ids) == r.n_pieces and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    for i in range(2, len(TEXTS)):
        mine = [r for r in rows if r.doc_id == i]
        assert [r.rank for r in sorted(mine, key=lambda r: -r.score)] == list(range(1, len(mine) + 1))
    back = nbest.decode_ids(nbest.encode_nbest(df, MODEL, 3), MODEL, ["doc_id", "rank"]).collect()
    assert {r.text == (TEXTS[r.doc_id] or "") for r in back} == {True}
    assert nbest.encode_nbest(df.limit(0), MODEL).collect() == []
    twice = df.union(df).union(spark.createDataFrame([(None, "a", None)], df.schema))
    assert nbest.encode_nbest(twice, MODEL, 1, with_ids=False).count() == 2 * len(TEXTS) + 1


def test_forgetting_changes_nothing(monkeypatch):
    lattice = nbest.PieceLattice.load(MODEL)
    texts = [f"some words {i} of text {i * i}" for i in range(50)]
    want = [lattice.encode(t, 3) for t in texts]
    monkeypatch.setattr(nbest, "REMEMBERED", 3)
    assert [lattice.encode(t, 3) for t in texts] == want


def test_a_very_long_word_takes_time_in_proportion():
    """Whole-number scores tie often: without a bound on expansions this never ends."""
    lattice = nbest.PieceLattice.load(MODEL)
    rng = random.Random(8)
    word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=200_000))
    han = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(50_000))
    start = time.monotonic()
    for text, least in ((word, 3), (han, 1)):  # a character that is no piece is spelled in one way
        got = lattice.encode(text, 3)
        assert least <= len(got) <= 3 and all(lattice.decode(ids) == text for _, ids in got)
        assert sorted(got, key=lambda x: -x[0]) == got and len({ids for _, ids in got}) == len(got)
    assert time.monotonic() - start < 60
    held = lattice._held
    lattice.encode(word, 1)
    assert lattice._held == held  # nothing of that length is remembered


def test_memory_of_stretches_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(nbest, "REMEMBERED", 20_000)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces = [(sp.id_to_piece(i), sp.get_score(i)) for i in range(300, 2000)]
    lattice = nbest.PieceLattice(pieces, None)
    rng = random.Random(9)
    for _ in range(200):
        lattice.encode(" ".join("".join(rng.choices("abcdef", k=12)) for _ in range(9)), 2)
        assert lattice._held <= 20_000 and len(lattice._known) <= 70


def test_segmentations_decode_to_their_texts(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for packed in (False, True):
        coded = nbest.encode_nbest(df, MODEL, 3, packed=packed)
        got = nbest.decode_ids(coded, MODEL, ["doc_id", "rank", "round_trip", "ids_crc32"]).collect()
        assert {r.doc_id for r in got} == set(range(len(TEXTS)))
        assert all((r.text == (TEXTS[r.doc_id] or "")) == r.round_trip for r in got)
        found.append(sorted(map(tuple, got)))
    assert found[0] == found[1]
