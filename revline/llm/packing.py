"""Packing token sequences: shortest-pack-first over the length histogram.

1. Every document is tokenised once and cut into pieces (``token_pieces``).
2. Only the histogram of piece lengths (at most ``seq_len`` counts) goes to the
   driver, which packs it: lengths longest first, each into the emptiest packs
   that have room, moving whole groups of equal packs at a time
   (``pack_histogram``). The work there depends on ``seq_len``, not on the data.
3. Pieces get a rank among those of their length and join the packs' slots by
   length and rank range (``pack_documents``).
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revline.llm import textvec
from revline.session import write_scratch

#: Fixed value: how the byte-level BPE splits a text before merging.
SPLIT = (r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|"
         r"\s+(?!\S)|\s")


class ByteBpe:
    """Ids of a byte-level BPE given as a ``tokenizers`` file, as arrays.

    The file's own vocabulary is handed to a faster implementation of the same
    merges; the ids are those of ``Tokenizer.encode(add_special_tokens=False)``.
    One instance per worker process and file.
    """

    _loaded: dict[str, ByteBpe] = {}

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        # printable bytes stand for themselves, the others follow from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(byte_of[c] for c in token): i
                 for token, i in spec["model"]["vocab"].items() if token not in special}
        self._fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks,
                                       special_tokens=special)
        self._path = path

    @classmethod
    def load(cls, path: str) -> ByteBpe:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def ids(self, text: str) -> np.ndarray:
        return self._fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)

    def plain_ids(self, text: str) -> np.ndarray:
        """The same by the ``tokenizers`` library itself (for tests)."""
        found = Tokenizer.from_file(self._path).encode(text, add_special_tokens=False)
        return np.array(found.ids, "<u4")


def cut_points(total: int, first: int, seq_len: int) -> np.ndarray:
    """Piece starts and the end: a first piece, full pieces, then what is left."""
    first = min(first, total)
    return np.concatenate([[0], np.arange(first, total, seq_len), [total]]).astype(np.int64)


def token_pieces(docs: DataFrame, tokenizer: str, seq_len: int = 1024, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text",
                 with_ids: bool = False) -> DataFrame:
    """Pieces of every document's ids (with ``end_id`` at the end).

    The first piece's length (1 to seq_len) follows from a hash of the id, so
    piece lengths are spread evenly even where a third of the documents are
    copies of one text: a histogram with one tall peak cannot be packed well.

    Columns: id, start, length, ids_crc32 (of little-endian 32-bit ids),
    doc_tokens; with ``with_ids`` also ids.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    schema += ", ids array<int>" if with_ids else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.load(tokenizer)
        tail = np.array([end_id], "<u4")
        for batch in textvec.small_batches(batches, "text"):
            row, starts, lengths, crcs, totals, parts = [], [], [], [], [], []
            for i, (text, first) in enumerate(zip(batch.column("text").to_pylist(),
                                                  batch.column("first").to_pylist(), strict=True)):
                ids = np.concatenate([bpe.ids(text), tail]) if text else tail
                at = cut_points(ids.size, first, seq_len)
                for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                    row.append(i)
                    starts.append(lo)
                    lengths.append(hi - lo)
                    crcs.append(zlib.crc32(ids[lo:hi].tobytes()))
                    totals.append(ids.size)
                    if with_ids:
                        parts.append(ids[lo:hi].astype(np.int32))
            columns = [batch.column("id").take(pa.array(row, pa.int64())), *(
                pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals))]
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(parts, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        (F.pmod(F.xxhash64(F.col(id_col)), F.lit(seq_len)) + 1).alias("first"),
    ).mapInArrow(cut, schema)


def pack_histogram(counts: dict[int, int], seq_len: int) -> list[tuple[tuple[int, ...], int]]:
    """Packs as (lengths in order, how many such packs), for lengths 1 to seq_len.

    Lengths go longest first, each piece into the emptiest pack with room, or a
    new one. Groups of equal packs move together, so a length adds a few groups
    at most and the result is as small for any number of pieces.
    """
    by_room: dict[int, dict[tuple[int, ...], int]] = {seq_len: {}}
    rooms: list[int] = []  # negative, a heap

    def put(lengths: tuple[int, ...], room: int, n: int) -> None:
        if room not in by_room or (not by_room[room] and -room not in rooms):
            heapq.heappush(rooms, -room)
        group = by_room.setdefault(room, {})
        group[lengths] = group.get(lengths, 0) + n

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            while rooms and not by_room[-rooms[0]]:
                heapq.heappop(rooms)
            if rooms and -rooms[0] >= length:
                room = -rooms[0]
                lengths, n = by_room[room].popitem()
                used = min(n, left)
                if n > used:
                    by_room[room][lengths] = n - used
                put((*lengths, length), room - length, used)
                left -= used
            else:
                each = seq_len // length
                if left >= each:
                    put((length,) * each, seq_len - each * length, left // each)
                if left % each:
                    put((length,) * (left % each), seq_len - (left % each) * length, 1)
                left = 0
    return [(lengths, n) for group in by_room.values() for lengths, n in group.items() if n]


def _slots(spark: SparkSession, packs: list[tuple[tuple[int, ...], int]]) -> DataFrame:
    """For each place in each kind of pack: the ranks of its length that fill it."""
    rows, next_rank, sequence = [], {}, 0
    for lengths, n in packs:
        offset = 0
        for length in lengths:
            lo = next_rank.get(length, 0)
            next_rank[length] = lo + n
            rows.append((length, lo, lo + n, sequence, offset))
            offset += length
        sequence += n
    return spark.createDataFrame(
        rows, "length bigint, _lo bigint, _hi bigint, _sequence bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str, seq_len: int = 1024, end_id: int = 0,
                   id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = False) -> DataFrame:
    """Every token of every document at its place in a training sequence.

    One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset (``with_ids``: and ids). Pieces of a sequence are gapless from 0 and
    take at most ``seq_len`` together.

    Defined cases: a null or empty text is its end id alone. Rows that repeat an
    id are packed each for itself. Null ids are kept. Other columns are ignored.
    No rows give no rows. Results do not depend on the partitioning.
    """
    spark = docs.sparkSession
    pieces = write_scratch(
        token_pieces(docs, tokenizer, seq_len, end_id, id_col, text_col, with_ids), "pieces")
    counts = {r["length"]: r["n"] for r in
              pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    packs = pack_histogram(counts, seq_len)

    # ranks in two levels of about the same size: no task holds a whole length
    dealt = spark.createDataFrame([(k, max(1, isqrt(n))) for k, n in counts.items()],
                                  "length bigint, _buckets bigint")
    keyed = (pieces.join(F.broadcast(dealt), "length")
             .withColumn("_bucket", F.pmod(F.xxhash64(F.col(id_col), "start", "ids_crc32"),
                                           F.col("_buckets"))))
    sizes = keyed.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("length", "_bucket", (
        F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("_n"))
        .alias("_before"))
    order = Window.partitionBy("length", "_bucket").orderBy(id_col, "start", "ids_crc32")
    ranked = (keyed.withColumn("_in", F.row_number().over(order) - 1)
              .join(before, ["length", "_bucket"])
              .withColumn("_rank", F.col("_before") + F.col("_in")))
    slots = _slots(spark, packs).withColumnRenamed("length", "_length")
    placed = ranked.join(F.broadcast(slots), (F.col("length") == F.col("_length"))
                         & (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi")))
    out = [id_col, "start", "length", "ids_crc32", "doc_tokens",
           (F.col("_sequence") + F.col("_rank") - F.col("_lo")).alias("sequence_id"), "offset"]
    return placed.select(*out, *(["ids"] if with_ids else []))
