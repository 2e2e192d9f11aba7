import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from revline.llm import fim

TEXTS = [None, "", "a", "one two, three", "  \n\t ", "é日本語 mixed Text😀end", "a<P>b", "x <S>", "<M>",
         "<", "P> and <S", "word " * 30_000, "x" * 50_000, "1234567890" * 50, "same text", "same text"]


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    key = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(key[8 * k:8 * k + 8], 16) for k in range(4)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, output string, form int, _text string")


def test_every_row_is_that_of_the_plain_version(spark):
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choices("abXY ,.\né中😀<PSM>", k=rng.randrange(0, 60))) for _ in range(300)]
    rows = [(None if i == 5 else i, t, "clash", 1, "clash") for i, t in enumerate(texts)]
    rows += rows[:20]
    df = frame(spark, rows)
    arranged = {(r.doc_id, r.output): r for r in fim.fill_in_middle(df).collect()}
    got = fim.round_trip(df).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), *map(str, brute(i, t)[:4]), sha(brute(i, t)[4]), sha(t or ""))
                  for i, t, *_ in rows)
    assert sorted(tuple(map(str, r)) for r in got) == want
    for i, t, *_ in rows:
        assert arranged[i, brute(i, t)[4]].output_sha256 == sha(brute(i, t)[4])
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_restored_from_output_and_form_alone(spark):
    rows = [("<P>a<S>c<M>b", "psm", "x", 7), ("<S>c<P>a<M>b", "spm", "x", 8), ("abc", "plain", "x", 9),
            (None, "psm", "x", 10), ("<P><S><M>", "psm", "x", 11)]
    df = spark.createDataFrame(rows, "output string, form string, restored string, key int")
    got = {r.key: r.restored for r in fim.restore(df).collect()}
    assert got == {7: "abc", 8: "abc", 9: "abc", 10: None, 11: ""}
    with pytest.raises(ValueError):
        fim.inverse(b"<P>a<M>b", "psm")
    with pytest.raises(ValueError):
        fim.inverse(b"x<P>a<S>c<M>b", "psm")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab<PSM>é😀 ", max_size=30), st.integers(0, 40), st.integers(0, 40),
       st.sampled_from(["psm", "spm"]))
def test_inverse_undoes_any_arrangement(text, x, y, form):
    raw = text.encode()
    if any(s in raw for s in (b"<P>", b"<S>", b"<M>")):
        return
    cuts = tuple(sorted((min(x, len(raw)), min(y, len(raw)))))
    pieces = fim.arrange(memoryview(raw), cuts, form)
    output = fim.read(pieces)
    assert fim.digest(pieces) == hashlib.sha256(output).hexdigest()
    assert fim.read(fim.inverse(output, form)) == raw


def test_empty_table(spark):
    assert fim.round_trip(frame(spark, [])).collect() == []
