import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from revline.llm import probminhash as pm
from revline.llm import textvec
from revline.llm.components import components


def _words(text):
    return re.findall(r"[^\W_]+", text.lower())


def _set(text):
    w = _words(text)
    if not w:
        return set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def _brute(rows, similar=0.8):
    """class id, size and links of every row, by comparing all pairs."""
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    sets = [_set(t or "") for _, t in rows]
    alike = [tuple(_words(t or "")) or ("", t or "") for _, t in rows]
    links = defaultdict(set)
    for a in range(len(rows)):
        for b in range(a):
            c = len(sets[a] & sets[b])
            if alike[a] == alike[b] or c and c >= similar * len(sets[a] | sets[b]) - 1e-9:
                parent[max(find(a), find(b))] = min(find(a), find(b))
                if alike[a] != alike[b]:
                    links[a].add(alike[b])
                    links[b].add(alike[a])
    members = defaultdict(list)
    for k in range(len(rows)):
        members[find(k)].append(k)
    return {rows[k][0]: (min(rows[j][0] for j in g), len(g), len(links[k])) for g in members.values() for k in g}


def _corpus(seed, families=12, copies=12, alone=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghié", k=rng.randrange(2, 8))) for _ in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 120))) for _ in range(alone)]
    for _ in range(families):
        origin = rng.choices(vocabulary, k=rng.randrange(30, 200))
        for _ in range(rng.randrange(1, copies)):
            w = list(origin)
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts.append(" ".join(w).capitalize() + rng.choice(["", ".", "!"]))
    return texts


def _frame(spark, texts):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)],
                                 "doc_id long, text string, class_id int, _hi string")


@pytest.mark.parametrize("block", [400, 5])
def test_classes_match_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(pm, "BLOCK", block)
    texts = _corpus(block) + [None, "", " .. ", " .. ", "one two", "One, two!", "one two three",
                              "w " * 5000, "w " * 5001]
    rows = pm.near_duplicates(_frame(spark, texts).repartition(5)).collect()
    want = _brute(list(enumerate(texts)))
    assert {r.doc_id: (r.class_id, r.class_size, r.links) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.class_id) for r in rows) and len(rows) == len(texts)
    assert max(n for _, n, _ in want.values()) > 5


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(3)
    elements = textvec.mix64(np.arange(1, 301, dtype=np.uint64))
    for _ in range(3):
        v = rng.choice([0, 1, 2, 7], 300, p=[0.3, 0.4, 0.2, 0.1]).astype(float)
        w = np.where(rng.random(300) < 0.8, v, rng.choice([0.0, 1, 3], 300))
        with np.errstate(divide="ignore", invalid="ignore"):
            exact = sum(1 / np.maximum(v / v[d], w / w[d]).sum() for d in np.flatnonzero((v > 0) & (w > 0)))
        both = [pm.prob_minhash(elements[x > 0], x[x > 0], np.zeros((x > 0).sum(), np.int64), 1, 4000)[0]
                for x in (v, w)]
        assert abs((both[0] == both[1]).mean() - exact) < 0.04


def test_registers_are_those_of_the_plain_process():
    """Early termination changes nothing against running every process far on."""
    rng = np.random.default_rng(5)
    elements = textvec.mix64(np.arange(7, 19, dtype=np.uint64))
    weight = rng.choice([1.0, 2.5], elements.size)
    got = pm.prob_minhash(elements, weight, np.zeros(elements.size, np.int64), 1, 32)[0]
    best = {}
    for e, w in zip(elements, weight, strict=True):
        x = 0.0
        for step in range(1, 400):
            h = textvec.mix64(np.array([e ^ np.uint64((step * 0xD1342543DE82EF95) % (1 << 64))]))
            x -= float(np.log(((h >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53)[0]) / w
            k = int((int(textvec.mix64(h)[0]) >> 32) * 32 >> 32)
            best[k] = min(best.get(k, (np.inf, 0)), (x, int(e)))
    assert [best[k][1] for k in range(32)] == [int(v) for v in got]


def test_sketch_does_not_depend_on_the_batch():
    texts = _corpus(1)[:40] + ["", "a"]
    def run(parts):
        out = []
        for p in parts:
            batch = pa.RecordBatch.from_arrays([pa.array(range(len(p)), pa.int64())] * 2 + [pa.array(p, pa.string())],
                                               ["_id", "_t", "_text"])
            for b in pm._sketch([batch]):
                out += b.select(["_hi", "_lo", "_bands", "_sig"]).to_pylist()
        return out
    assert run([texts]) == run([[t] for t in texts])


def test_cases(spark):
    assert pm.near_duplicates(_frame(spark, [])).collect() == []
    long = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(None, long), (5, long), (5, long), (None, "b"), (9, long + " end")],
                               "doc_id long, text string")
    got = sorted(map(str, (tuple(r) for r in pm.near_duplicates(df).collect())))
    assert got == sorted(map(str, [(None, 5, 4, 1, False), (5, 5, 4, 1, True), (5, 5, 4, 1, True),
                                   (None, None, 1, 0, True), (9, 5, 4, 1, False)]))
    spread = _frame(spark, [long]).union(_frame(spark, [long + " end", long + " end b"]))
    many = spread.union(spread).union(spread).repartition(9)
    rows = {(r.class_size, r.links) for r in pm.near_duplicates(many).collect()}
    assert rows == {(9, 2)}            # three texts, each three times
    left = pm.keep_one_of_each(_frame(spark, ["x y", "x y", "z"]))
    assert sorted(r.doc_id for r in left.collect()) == [0, 2] and left.columns[-1] == "_hi"


_UNICODE = ["Привет, МИР! Это ДЛИННЫЙ текст", "привет мир это длинный текст", "ΟΔΟΣ ΑΘΗΝΑ", "οδος αθηνα",
            "one\u00a0two\u3000three\u2014four", "“one” two… three–four", "ÉCOLE Œuvre Ÿ ß", "école œuvre ÿ ß",
            "ａｂ，ｃｄ。", "", "x", "١٢٣ ४५", "plain ASCII words_here 42"]


def test_words_by_unicode_classes():
    def hashes(texts):
        got, rows = pm.normal_words(*textvec.utf8(pa.array(texts, pa.string())))
        return [got[rows == i].tolist() for i in range(len(texts))]
    together = hashes(_UNICODE)
    assert together == [hashes([t])[0] for t in _UNICODE]
    assert together == hashes([" ".join(_words(t)) for t in _UNICODE])
    assert [len(h) for h in together] == [len(_words(t)) for t in _UNICODE]
    words = [w for t in _UNICODE for w in _words(t)]
    assert len({h for t in together for h in t}) == len(set(words))
    # characters of scripts without spaces, with full-width punctuation; marks belong to their letter
    assert [len(h) for h in hashes(["我们，吃饭。abc了", "カタカナ「ひらがな」", "สวัส", "की का", "cafe\u0301"])] == [6, 8, 4, 2, 1]
    assert hashes(["की"]) != hashes(["का"])


def test_near_copies_in_other_scripts(spark):
    rng = random.Random(4)
    texts = []
    for _ in range(8):
        han = [chr(rng.randrange(0x4E00, 0x9000)) for _ in range(200)]
        changed = [*han[:100], "新", *han[101:]]
        texts += ["，".join("".join(w[i:i + 9]) for i in range(0, 200, 9)) + "。" for w in (han, changed)]
        cyrillic = ["".join(rng.choices("абвгдежз", k=6)) for _ in range(80)]
        texts += [" ".join(cyrillic), "\u00a0".join([*cyrillic, "ещё"]).upper()]
    rows = pm.near_duplicates(_frame(spark, texts)).collect()
    spaced = [re.sub("([一-鿿])", r"\1 ", t) for t in texts]
    assert {r.doc_id: (r.class_id, r.class_size, r.links) for r in rows} == _brute(list(enumerate(spaced)))
    assert all(r.class_size == 2 for r in rows)


def test_repeated_lines_do_not_hide_a_pair(spark):
    """Pairs just above 0.8 of which one text repeats its own lines."""
    texts = []
    for k in range(40):
        common = " ".join(f"c{k}x{i}" for i in range(104))
        line = " ".join(f"r{k}x{i}" for i in range(12))
        texts += [common, common + f" {line}" * 200]
    rows = pm.near_duplicates(_frame(spark, texts)).collect()
    got = {r.doc_id: (r.class_id, r.class_size, r.links) for r in rows}
    assert got == _brute(list(enumerate(texts)))
    assert all(n == 2 for _, n, _ in got.values())


@pytest.mark.parametrize("block", [400, 3])
def test_strangers_in_a_bucket_do_not_part_a_pair(spark, monkeypatch, block):
    """Every bucket is shared by all nodes; the first ones are strangers to all pairs."""
    monkeypatch.setattr(pm, "BLOCK", block)
    rng = np.random.default_rng(block)
    alone, pairs = rng.integers(1, 1 << 62, (30, 160)), rng.integers(1, 1 << 62, (20, 160))
    other = np.where(rng.random(pairs.shape) < 0.8, pairs, rng.integers(1, 1 << 62, pairs.shape))
    registers = np.r_[alone, pairs, other].astype(np.uint64)
    sig = pm.short_signature(registers).tolist()
    nodes = spark.createDataFrame([(i, [1, 2], s) for i, s in enumerate(sig)],
                                  "_node long, _bands array<long>, _sig array<long>")
    got = {r.node: r.component for r in pm._families(nodes).collect()}
    assert got == {k: 30 + i for i in range(20) for k in (30 + i, 50 + i)}


def test_edges_stay_linear_in_a_group_from_one_template(spark, monkeypatch):
    """Texts alike at about 0.6, no pair at 0.8: every node differs from each centre by
    more than very similar ones do, and still buckets give only a few edges a node."""
    seen = []
    plain = pm.components
    monkeypatch.setattr(pm, "components", lambda e, a, b: seen.append(e.count()) or plain(e, a, b))
    for n in (100, 400):
        rng = random.Random(n)
        words = [f"t{i}" for i in range(200)]
        texts = []
        for k in range(n):
            w = words[:]
            for at in rng.sample(range(200), 6):
                w[at] = f"n{k}x{at}"
            texts.append(" ".join(w))
        seen.clear()
        rows = pm.near_duplicates(_frame(spark, texts)).collect()
        assert {r.doc_id: (r.class_id, r.class_size, r.links) for r in rows} == _brute(list(enumerate(texts)))
        assert sum(seen[:2]) <= 64 * n, seen


def test_one_version_of_an_id_and_one_null_id_are_kept(spark):
    one = " ".join(f"w{i}" for i in range(60))
    rows = [(7, one, 1), (7, one + " end", 2), (8, one + " end b", 3), (None, "x y z", 4), (None, "x, y z", 5),
            (7, "another text of the id", 6), (None, "lone", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, keep int")
    got = pm.keep_one_of_each(df).collect()
    assert len([r for r in got if r.keep in (1, 2, 3)]) == 1 and len([r for r in got if r.keep in (4, 5)]) == 1
    assert {6, 7} <= {r.keep for r in got} and len(got) == 4


def test_components_of_long_paths(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100 + i, 99) for i in range(1, 30)] + [(7, 7), (300, 300)]
    rng.shuffle(edges)
    df = spark.createDataFrame([*edges, edges[0], (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 99 for i in [99, *range(101, 130)]}}
