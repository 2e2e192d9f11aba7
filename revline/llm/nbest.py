"""N-best SentencePiece segmentation and decoding.

The lattice of a text has an edge for every piece of the vocabulary at every
place where it occurs, weighted by the piece's score. Forward Viterbi gives the
best score of every prefix (and what the second best path loses, which tells
where the N best of a text can differ at all). A backward search from the end expands the partial
path whose score plus that prefix score is largest; as the prefix scores are
exact, complete paths come out best first.

No piece reaches from a word over the space behind it, and some characters are
in no longer piece; there every path of the lattice passes through one node. So
the lattice is searched piecewise between these nodes, each different word once
for many documents, and the N best of a text are the N best sums of its words'.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revline.llm import textvec

#: bytes of remembered stretches (about) at which a worker starts anew
REMEMBERED = 448 << 20
#: longer stretches are not remembered: they hardly come again
LONGEST_REMEMBERED = 64
_SPACE_MARK = "▁"


def _any_of(chars: set[str]) -> str:
    return f"[{''.join(map(re.escape, sorted(chars)))}]"


class _Known(dict):
    """Words with their best segmentation, found when first asked for."""

    def __init__(self, find):
        super().__init__()
        self._find = find

    def __missing__(self, s: str):
        return self._find(s)


class PieceLattice:
    """Pieces and scores of a model file; one instance per worker process and file."""

    _loaded: dict[str, PieceLattice] = {}

    def __init__(self, pieces: list[tuple[str, float]], byte_ids: dict[int, int] | None,
                 unknown_id: int = 0):
        """``pieces``: (piece, score) by id, None-like empty pieces are skipped."""
        self.edges = {p.replace(_SPACE_MARK, " "): (i, s) for i, (p, s) in enumerate(pieces) if p}
        self.byte_ids, self.unknown_id = byte_ids, unknown_id
        # also every prefix of a piece, so that a scan ends as soon as no piece can follow
        self.scan = {p[:k]: None for p in self.edges for k in range(1, len(p))} | self.edges
        scores = [s for _, s in self.edges.values()]
        self.unknown_score = min(scores, default=0.0) - 10.0
        of = {i: p.encode() for p, (i, _) in self.edges.items()}
        of |= {i: bytes([b]) for b, i in (byte_ids or {}).items()}
        # the text of every id, one after the other; the last is for all others
        texts = [of.get(i, b"\xef\xbf\xbd") for i in range(max(of, default=0) + 2)]
        self._size = np.array([len(t) for t in texts], np.int32)
        self._start = np.r_[0, np.cumsum(self._size)[:-1]].astype(np.int32)
        #: how packed ids are stored: two bytes where the vocabulary allows
        self.packed_type = "<u2" if len(pieces) <= 1 << 16 else "<u4"
        self._bytes = np.frombuffer(b"".join(texts), np.uint8)
        linked = {c for p in self.edges if len(p) > 1 for c in p}
        pairs = {p[k:k + 2] for p in self.edges for k in range(len(p) - 1)}
        crossing = any(re.search("[^ ] ", p) for p in self.edges)
        inside = _any_of(linked - {" "})
        # letters, and marks that no piece puts behind a letter
        letters = {c for c in linked if c.isalpha()}
        behind = {pair[1] for pair in pairs if pair[0] in letters}
        word = f" *{_any_of(letters)}+(?={_any_of(linked - letters - behind - {' '})})|" if (
            letters and linked - letters - behind - {" "}) else ""
        # stretches of the text that only meet in single nodes of the lattice
        self.stretches = re.compile(
            "(?s).+" if crossing else f"(?s){word} *{inside}+| +|." if linked - {" "} else
            "(?s) +|.").findall
        self._known, self._held = _Known(self._remember), 0

    @classmethod
    def load(cls, path: str) -> PieceLattice:
        if path not in cls._loaded:
            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            ids = range(sp.get_piece_size())
            normal = [(sp.id_to_piece(i), sp.get_score(i)) if not (
                sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) else ("", 0.0)
                for i in ids]
            of_byte = {int(sp.id_to_piece(i)[1:-1], 16): i for i in ids if sp.is_byte(i)}
            cls._loaded[path] = cls(normal, of_byte or None, sp.unk_id())
        return cls._loaded[path]

    def _incoming(self, s: str) -> tuple[list[list], list[float]]:
        """Edges by their end, and the Viterbi score of every prefix."""
        n, scan = len(s), self.scan
        incoming: list[list] = [[] for _ in range(n + 1)]
        best = [0.0] + [-np.inf] * n
        for i in range(n):
            base, single = best[i], False
            for j in range(i + 1, n + 1):
                found = scan.get(s[i:j], 0)
                if found:
                    single = single or j == i + 1
                    incoming[j].append((i, found[0], found[1]))
                    if base + found[1] > best[j]:
                        best[j] = base + found[1]
                elif found == 0:
                    break
            if not single:  # every character has an edge
                incoming[i + 1].append((i, -1, self.unknown_score))
                if base + self.unknown_score > best[i + 1]:
                    best[i + 1] = base + self.unknown_score
        return incoming, best

    def _two_best(self, s: str) -> tuple[float, bytes, float]:
        """Forward Viterbi with runners-up: best score, its ids, second best score."""
        n, scan = len(s), self.scan
        nothing = -np.inf
        first, second = [0.0] + [nothing] * n, [nothing] * (n + 1)
        back: list = [None] * (n + 1)
        for i in range(n):
            one, two, single = first[i], second[i], False
            for j in range(i + 1, n + 1):
                found = scan.get(s[i:j], 0)
                if found:
                    if j == i + 1:
                        single = True
                    x = one + found[1]
                    if x > first[j]:
                        y = two + found[1]
                        second[j] = first[j] if first[j] > y else y
                        first[j], back[j] = x, (i, found[0])
                    elif x > second[j]:
                        second[j] = x
                elif found == 0:
                    break
            if not single:
                j, x = i + 1, one + self.unknown_score
                if x > first[j]:
                    y = two + self.unknown_score
                    second[j] = first[j] if first[j] > y else y
                    first[j], back[j] = x, (i, -1)
                elif x > second[j]:
                    second[j] = x
        path, at = None, n
        while at:
            i, piece = back[at]
            path, at = (i, piece, path), i
        return first[n], self._spell(s, path), second[n]

    def _spell(self, s: str, path) -> bytes:
        """Ids of a path ((start, id, rest) from the front) as little-endian 32-bit numbers."""
        out = array("I")
        while path is not None:
            i, piece, path = path
            if piece >= 0:
                out.append(piece)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in s[i].encode())
            else:
                out.append(self.unknown_id)
        return out.tobytes()

    def search(self, s: str, n: int) -> list[tuple[float, bytes]]:
        """The n best (score, ids) of one stretch, best first; fewer if there are fewer.

        A place in the stretch is expanded n times at most: of the ways back from it to
        the end the cheapest come first, and whatever continues a later one has n others
        before it. So ties, however many, cost no more than n times the edges.
        """
        incoming, best = self._incoming(s)
        order, found, expanded = count(), [], bytearray(len(s) + 1) if n < 256 else [0] * (len(s) + 1)
        agenda = [(-best[len(s)], next(order), len(s), 0.0, None)]
        while agenda:
            total, _, at, behind, path = heapq.heappop(agenda)
            if at == 0:
                found.append((-total, self._spell(s, path)))
                if len(found) == n:
                    break
                continue
            if expanded[at] == n:
                continue
            expanded[at] += 1
            for i, piece, score in incoming[at]:
                if best[i] > -np.inf:
                    g = behind + score
                    heapq.heappush(agenda, (-(g + best[i]), next(order), i, g, (i, piece, path)))
        return found

    def _remember(self, s: str) -> tuple[float, bytes, float]:
        """Best score, its ids and what the second best loses (infinite if there is none)."""
        best, ids, second = self._two_best(s)
        entry = (best, ids, best - second)
        if len(s) <= LONGEST_REMEMBERED:
            self._held += 300 + len(s) + len(ids)  # objects and their slot, text, ids
            if self._held > REMEMBERED:
                self._known.clear()
                self._held = 0
            self._known[s] = entry
        return entry

    def encode(self, text: str, n: int) -> list[tuple[float, bytes]]:
        """The n best (score, ids) of a text, best first; the empty text has one, without pieces."""
        if not text:
            return [(0.0, b"")]
        stretches = self.stretches(" " + text)
        scores, ids, losses = zip(*map(self._known.__getitem__, stretches), strict=True)
        # only the n - 1 stretches that lose least can differ from the best path
        near: list[int] = []
        if n > 1:
            array_of = np.array(losses)
            near = np.argsort(array_of, kind="stable")[:n - 1].tolist() if len(losses) < 32 else sorted(
                np.argpartition(array_of, n - 1)[:n - 1].tolist(), key=losses.__getitem__)
        combined: list[tuple[float, dict[int, bytes]]] = [(0.0, {})]
        for at in near:
            if losses[at] == np.inf:
                continue
            best = scores[at]
            others = [x for x in self.search(stretches[at], n) if x[1] != ids[at]][:n - 1]
            combined = heapq.nsmallest(n, (
                *combined, *((loss + best - score, {**change, at: spelled})
                             for loss, change in combined for score, spelled in others)),
                key=lambda x: x[0])
        total, out = sum(scores), []
        for loss, change in combined:
            parts = ids
            if change:
                parts = list(ids)
                for at, spelled in change.items():
                    parts[at] = spelled
            out.append((total - loss, b"".join(parts)))
        return out

    def decode(self, ids: bytes | np.ndarray) -> str:
        """The text of ids: pieces and bytes joined, without the space put before the text.

        Bytes that are no UTF-8, and ids that stand for no text, become U+FFFD.
        """
        ids = np.frombuffer(ids, "<u4") if isinstance(ids, bytes) else np.asarray(ids)
        if not ids.size:
            return ""
        ids = np.minimum(ids, self._size.size - 1)
        size, start = self._size[ids], self._start[ids]
        ends = np.cumsum(size, dtype=np.int64 if ids.size > 1 << 24 else np.int32)
        where = np.repeat(start - (ends - size), size)
        where += np.arange(where.size, dtype=where.dtype)
        raw = self._bytes[where].tobytes()
        return raw.decode("utf-8", "replace").removeprefix(" ")


def _packed(spelled: list[bytes], kind: str) -> pa.Array:
    """Ids of each row in one binary value, without an object for each."""
    values = np.frombuffer(b"".join(spelled), "<u4").astype(kind)
    width = values.dtype.itemsize
    offsets = np.cumsum([0] + [len(x) // 4 * width for x in spelled]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(spelled), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def encode_nbest(docs: DataFrame, model: str, n: int = 3, id_col: str = "doc_id",
                 text_col: str = "text", with_ids: bool = True, packed: bool = False) -> DataFrame:
    """The n best segmentations of every row's whole text.

    One row for each row and rank: id, rank (1 is best), score (sum of the
    pieces' scores), n_pieces, ids_crc32 (of little-endian 32-bit ids),
    round_trip (decoding gives the text back) and, with ``with_ids``, ids: an array or,
    ``packed``, little-endian numbers of 16 bits (32 for a vocabulary beyond 65,536).

    A character that is no piece is spelled in byte pieces, at a score below
    every piece's. Defined cases: a null text counts as empty, an empty text has
    one segmentation, without pieces; a text with fewer than n segmentations has
    fewer rows; equal scores come in a fixed order. A very long text is encoded whole;
    one without any place where the lattice can be cut (a word of a megabyte) takes time
    in proportion to its length and some 500 bytes of memory a character. Rows that repeat are encoded
    each, null ids are kept, other columns are ignored; no rows give no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {id_type}, rank int, score double, n_pieces bigint, ids_crc32 bigint, "
              "round_trip boolean" + (", ids binary" if with_ids and packed else ", ids array<int>" if with_ids else ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = PieceLattice.load(model)
        for batch in textvec.small_batches(batches, "_text"):
            rows, ranks, scores, spelled, same = [], [], [], [], []
            for k, text in enumerate(batch.column("_text").to_pylist()):
                for rank, (score, ids) in enumerate(lattice.encode(text, n), 1):
                    rows.append(k)
                    ranks.append(rank)
                    scores.append(score)
                    spelled.append(ids)
                    same.append(lattice.decode(ids) == text)
            columns = [batch.column("_id").take(pa.array(rows, pa.int64())),
                       pa.array(ranks, pa.int32()), pa.array(scores, pa.float64()),
                       pa.array([len(x) // 4 for x in spelled], pa.int64()),
                       pa.array([zlib.crc32(x) for x in spelled], pa.int64()),
                       pa.array(same, pa.bool_())]
            names = [id_col, "rank", "score", "n_pieces", "ids_crc32", "round_trip"]
            if with_ids:
                columns.append(_packed(spelled, lattice.packed_type) if packed else pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0] + [len(x) // 4 for x in spelled]), pa.int32()),
                    pa.array(np.frombuffer(b"".join(spelled), "<i4"))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col(id_col).alias("_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text")).mapInArrow(run, schema)


def decode_ids(rows: DataFrame, model: str, keep: list[str], ids_col: str = "ids") -> DataFrame:
    """Columns ``keep`` and text, decoded from ids (an array, or packed); null ids give null."""
    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep),
                        "text string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = PieceLattice.load(model)
        for batch in batches:
            ids = batch.column("__ids")
            if pa.types.is_binary(ids.type):
                texts = [None if x is None else lattice.decode(np.frombuffer(x, lattice.packed_type))
                         for x in ids.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(f"__keep{i}") for i in range(len(keep))), pa.array(texts, pa.string())],
                    [*keep, "text"])
                continue
            at, values = ids.offsets.to_numpy(), ids.values.fill_null(-1).to_numpy()
            texts = [lattice.decode(values[a:b].astype(np.int64)) if there else None for a, b, there in
                     zip(at[:-1], at[1:], ids.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f"__keep{i}") for i in range(len(keep))), pa.array(texts, pa.string())],
                [*keep, "text"])

    return rows.select(*(F.col(c).alias(f"__keep{i}") for i, c in enumerate(keep)),
                       F.col(ids_col).alias("__ids")).mapInArrow(run, schema)
