"""Fill-in-middle transformation with a piece table.

A document is never moved: it is a list of descriptors (start, end) over an
immutable buffer, the UTF-8 bytes of its text. Cutting splits a descriptor at
two unit boundaries, an arrangement puts the three descriptors and those of the
sentinels (over a buffer of their own) in order, and the output is what the
descriptors say, read in that order. Restoring reads an output as a new buffer,
cuts it where its sentinels lie, leaves these out and applies the inverse
permutation. Digests are fed descriptor by descriptor.

Units are runs of ASCII letters and single other code points. Where a document is
cut, and how it is arranged, follow from a hash of its id, so repeated or lost
tasks give the same rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revline.llm import textvec
from revline.llm.names import fresh

PLAIN, PSM, SPM = "plain", "psm", "spm"
#: the sentinel buffer; (start, end) of each sentinel in it
SENTINELS = b"<P><S><M>"
PREFIX, SUFFIX, MIDDLE = (0, 3), (3, 6), (6, 9)
#: sentinels in the order in which a form writes them, and which part of a document
#: (0 prefix, 1 middle, 2 suffix) follows each
ORDER = {PSM: [(PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)],
         SPM: [(SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1)]}

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True

#: a piece: the buffer it lies in, its first byte and the byte after its last
Piece = tuple[memoryview, int, int]


def unit_starts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Byte offsets at which the units of all rows begin (``offs``: row offsets)."""
    if not data.size:
        return np.zeros(0, np.int64)
    letter = _LETTER[data]
    start = (data & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    start[offs[:-1][offs[:-1] < data.size]] = True
    return np.flatnonzero(start)


def arrange(buffer: memoryview, cuts: tuple[int, int], form: str) -> list[Piece]:
    """The pieces of an output: sentinels and the parts of ``buffer`` between ``cuts``."""
    if form == PLAIN:
        return [(buffer, 0, len(buffer))]
    parts = [(0, cuts[0]), cuts, (cuts[1], len(buffer))]
    out, marks = [], memoryview(SENTINELS)
    for mark, part in ORDER[form]:
        out += [(marks, *mark), (buffer, *parts[part])]
    return out


def inverse(output: bytes, form: str) -> list[Piece]:
    """The pieces of the document, in its own order, as they lie in an output.

    The first occurrence of each sentinel is taken, in the order of the form; a
    document that holds one itself is never arranged, so these are the ones written.
    """
    buffer = memoryview(output)
    if form == PLAIN:
        return [(buffer, 0, len(buffer))]
    parts: dict[int, tuple[int, int]] = {}
    at, last = 0, None
    for (a, b), part in ORDER[form]:
        found = output.find(SENTINELS[a:b], at)
        if found < 0 or (last is None and found > 0):
            raise ValueError(f"no {form} output: {SENTINELS[a:b]!r} is not where it belongs")
        if last is not None:
            parts[last] = (at, found)
        at, last = found + b - a, part
    parts[last] = (at, len(output))
    return [(buffer, *parts[k]) for k in range(3)]


def read(pieces: list[Piece]) -> bytes:
    return b"".join([buffer[a:b] for buffer, a, b in pieces])


def digest(pieces: list[Piece]) -> str:
    """Lowercase hex SHA-256 of what the pieces say, without joining them."""
    h = hashlib.sha256()
    for buffer, a, b in pieces:
        h.update(buffer[a:b])
    return h.hexdigest()


def _forward(plain_percent: int, spm_percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textvec.small_batches(batches, "_text", 8 * textvec.MAX_BYTES):
            data, offs = textvec.utf8(batch.column("_text"))
            starts = unit_starts(data, offs)
            points = np.r_[0, np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)]
            first = np.searchsorted(starts, offs)
            whole = memoryview(data.tobytes())
            hashes = [batch.column(f"_h{k}").to_pylist() for k in (1, 2, 3, 4)]
            rows = []
            for i, (h1, h2, h3, h4) in enumerate(zip(*hashes, strict=True)):
                n = int(first[i + 1] - first[i])
                a, b = int(offs[i]), int(offs[i + 1])
                text = whole[a:b]
                raw = bytes(text)
                if (not n or h3 % 100 >= 100 - plain_percent
                        or any(SENTINELS[x:y] in raw for x, y in (PREFIX, SUFFIX, MIDDLE))):
                    form, cuts, chars = PLAIN, (0, 0), (None, None)
                else:
                    form = SPM if h4 % 100 < spm_percent else PSM
                    units = sorted((h1 % (n + 1), h2 % (n + 1)))
                    at = [int(starts[first[i] + k]) if k < n else b for k in units]
                    cuts = (at[0] - a, at[1] - a)
                    chars = (int(points[at[0]] - points[a]), int(points[at[1]] - points[at[0]]))
                pieces = arrange(text, cuts, form)
                rows.append((n, form, *chars, read(pieces), digest(pieces)))
            n, form, prefix, middle, output, sha = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(n, pa.int64()), pa.array(form),
                 pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                 pa.array(output, pa.binary()).cast(pa.string()), pa.array(sha)],
                ["_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"])
    return run


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
                   plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """Every document arranged for infilling.

    Columns: id, n (units), form (plain, psm or spm), prefix_chars, middle_chars
    (code points; null if plain), output, output_sha256. The draws h1 to h4 are the
    first four groups of eight digits of the hex SHA-256 of ``seed:id``; the document
    is cut after h1 % (n + 1) and h2 % (n + 1) units.

    Defined cases: a null or empty text, and one that holds a sentinel, stays plain;
    cuts may fall together or at an end, and parts may be empty; a null id draws as
    the empty id; rows that repeat an id and text give equal rows; very long texts
    are single buffers, cut without copies but for the output. Other columns are
    ignored; no rows give no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(key, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"_h{k + 1}")
             for k in range(4)]
    rows = docs.select(F.col(id_col).alias("_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"), *draws)
    out = rows.mapInArrow(
        _forward(plain_percent, spm_percent),
        f"_id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
        "output string, output_sha256 string")
    return out.withColumnRenamed("_id", id_col)


def restore(arranged: DataFrame) -> DataFrame:
    """The rows of ``arranged`` (columns form and output) with the text that they came from.

    Only form and output are read. Columns: all others, restored, restored_sha256
    (in place of columns of these names). An output that lacks a sentinel of its form
    raises; a null output or form gives a null text.
    """
    kept = [f for f in arranged.schema.fields if f.name.lower() not in ("restored", "restored_sha256")]
    form, output = fresh(arranged, "form_in"), fresh(arranged, "output_in")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textvec.small_batches(batches, output, 8 * textvec.MAX_BYTES):
            texts, shas = [], []
            for how, value in zip(batch.column(form).to_pylist(),
                                  batch.column(output).cast(pa.binary()), strict=True):
                value = value.as_py()
                pieces = None if how is None or value is None else inverse(value, how)
                texts.append(None if pieces is None else read(pieces))
                shas.append(None if pieces is None else digest(pieces))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept),
                 pa.array(texts, pa.binary()).cast(pa.string()), pa.array(shas, pa.string())],
                [*(f.name for f in kept), "restored", "restored_sha256"])

    source = arranged.select(*(f.name for f in kept), F.col("form").alias(form),
                             F.col("output").alias(output))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return source.mapInArrow(run, f"{schema}, restored string, restored_sha256 string")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of every document's output and of the text restored from that output."""
    arranged = fill_in_middle(docs, id_col, text_col)
    return restore(arranged).select(id_col, "n", "form", "prefix_chars", "middle_chars",
                                    "output_sha256", "restored_sha256")
