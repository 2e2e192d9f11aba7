import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from revline.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", "a", "The same words. " * 300, "\n\n  tabs\t and éß中\U0001f600 ",
         "x" * 20_000, "<|endoftext|> in a text", "don't we'll  ", "1234567 89"] + [
    "copy of one text " * 40] * 12


def test_ids_are_those_of_the_tokenizers_library():
    bpe = packing.ByteBpe(PATH)
    rng = random.Random(1)
    alphabet = "abc ABC'\n\t.,!1290éü中\U0001f600   st'll"
    texts = [t for t in TEXTS if t] + [
        "".join(rng.choices(alphabet, k=rng.randrange(1, 200))) for _ in range(300)]
    for text in texts:
        assert bpe.ids(text).tolist() == bpe.plain_ids(text).tolist(), text[:50]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 50), max_size=32))
def test_histogram_packing_places_every_length_once(counts):
    packs = packing.pack_histogram(counts, 32)
    placed = defaultdict(int)
    for lengths, n in packs:
        assert n > 0 and sum(lengths) <= 32
        for length in lengths:
            placed[length] += n
    assert dict(placed) == counts
    total = sum(k * n for k, n in counts.items())
    if counts:  # no two packs could be one, beyond what packing longest first may leave
        assert sum(n for _, n in packs) <= 2 * -(-total // 32)


def _piece_by_piece(counts, size):
    """Rooms left by shortest-pack-first: longest pieces first, each into the emptiest pack
    if it has room, else into a new one."""
    rooms = []
    for length in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
        emptiest = max(range(len(rooms)), key=rooms.__getitem__, default=None)
        if emptiest is None or rooms[emptiest] < length:
            rooms.append(size)
            emptiest = len(rooms) - 1
        rooms[emptiest] -= length
    return sorted(rooms)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 40).flatmap(lambda size: st.tuples(
    st.just(size), st.dictionaries(st.integers(1, size), st.integers(1, 30), max_size=size))))
def test_histogram_packing_is_shortest_pack_first_piece_by_piece(case):
    """Which of equally empty packs a piece goes to is open; the rooms left are not."""
    size, counts = case
    rooms = sorted(size - sum(lengths) for lengths, n in packing.pack_histogram(counts, size) for _ in range(n))
    assert rooms == _piece_by_piece(counts, size)


def _check(rows, texts, seq_len):
    bpe = packing.ByteBpe(PATH)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(range(len(texts)))
    for i, text in enumerate(texts):
        ids = np.append(bpe.plain_ids(text or ""), 0).astype("<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, ids.size)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            assert r.ids == ids[at:at + r.length].tolist()
            at += r.length
        assert at == ids.size
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= seq_len
    assert set(by_seq) == set(range(len(by_seq)))


def test_pack_round_trip(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)],
                               "doc_id long, text string, length int")
    for seq_len in (16, 1024):
        rows = packing.pack_documents(df, PATH, seq_len, with_ids=True).collect()
        _check(rows, TEXTS, seq_len)


def test_little_padding_even_with_many_copies(spark):
    rng = random.Random(5)
    texts = ["word " * 700] * 400 + ["word " * rng.randrange(1, 900) for _ in range(800)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack_documents(df, PATH).collect()
    used = defaultdict(int)
    for r in rows:
        used[r.sequence_id] += r.length
    padding = sum(0 if n & (n - 1) == 0 else 1024 - n for n in used.values())
    assert padding < 0.01 * sum(used.values())


def test_empty_and_repeated_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(df, PATH).collect() == []
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    rows = packing.pack_documents(twice, PATH).collect()
    assert sum(r.length for r in rows) == 3 + 3 + 2
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
