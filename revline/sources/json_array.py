"""One JSON array file as a splittable scan.

Spark's reader takes a file that is one JSON array as one task, as only a parser
that has read all before a place knows whether that place lies in a string. Here the
file is read as text fragments that end at ``}``, dealt to tasks by byte ranges. For
its range a task finds what any state becomes, (outside or inside a string) -> (state,
change of depth): two numbers and a bit for each of the two. Composed in file order
(one small row a range reaches the driver, as in a file listing) they give the true
state at the start of every range, and a second pass cuts records where the depth
returns to that of the array. Records that cross ranges are put together from pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revline.session import write_scratch

#: kinds of rows of the second pass, in the order they have in a range
WHOLE, END, MIDDLE, START = 0, 1, 2, 3

_SIGN = np.zeros(256, np.int64)
_SIGN[[ord("{"), ord("[")]] = 1
_SIGN[[ord("}"), ord("]")]] = -1


def _marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the quotes that are not escaped, and of all brackets."""
    plain = np.where(data != ord("\\"), np.arange(data.size), -1)
    last_plain = np.r_[-1, np.maximum.accumulate(plain)] if data.size else np.array([-1])
    quotes = np.flatnonzero(data == ord('"'))
    escaped = (quotes - 1 - last_plain[quotes]) % 2 == 1
    return quotes[~escaped], np.flatnonzero(_SIGN[data])


def _brackets(data: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and signs of the brackets outside strings, and whether the text ends inside one."""
    quotes, at = _marks(data)
    at = at[(np.searchsorted(quotes, at) + inside) % 2 == 0]
    return at, _SIGN[data[at]], (inside + quotes.size) % 2


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bytes]]:
    """((path, start of range), text) of the fragments of each batch, in file order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = batch.column("_start").to_numpy()
        paths = batch.column("_path").dictionary_encode()
        code = paths.indices.to_numpy()
        cuts = np.flatnonzero((np.diff(starts) != 0) | (np.diff(code) != 0)) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows], strict=True):
            texts = batch.column("value").slice(a, b - a).to_pylist()
            yield ((paths.dictionary[int(code[a])].as_py(), int(starts[a])),
                   "".join(t + "}" for t in texts).encode())


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # state of each range so far, from outside and from inside a string
    found: dict[tuple[str, int], list] = {}
    for key, text in _ranges(batches):
        data = np.frombuffer(text, np.uint8)
        states = found.setdefault(key, [[0, 0], [1, 0]])
        for state in states:
            _, signs, inside = _brackets(data, state[0])
            state[0], state[1] = inside, state[1] + int(signs.sum())
    rows = [(p, s, *out, *in_) for (p, s), (out, in_) in found.items()]
    if rows:
        names = ["_path", "_start", "out_state", "out_depth", "in_state", "in_depth"]
        yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)))


def _compose(rows) -> dict[tuple[str, int], tuple[int, int, bool]]:
    """State and depth at the start of every range, and whether it is its file's last."""
    by_path: dict[str, list] = {}
    for r in rows:
        by_path.setdefault(r["_path"], []).append(r)
    begin = {}
    for path, ranges in by_path.items():
        ranges.sort(key=lambda r: r["_start"])
        inside = depth = 0
        for r in ranges:
            begin[path, r["_start"]] = (inside, depth, r is ranges[-1])
            inside, change = ((r["in_state"], r["in_depth"]) if inside
                              else (r["out_state"], r["out_depth"]))
            depth += change
    return begin


class _Cutter:
    """Cuts one range into records and pieces of records."""

    def __init__(self, begin: tuple[int, int, bool]):
        self.inside, self.depth, self.last = begin
        self.closed = False
        # the record that is open: its text so far, and whether it began in this range
        self.open: list[bytes] | None = [] if self.depth > 1 else None
        self.began, self.rows = self.depth <= 1, []

    def take(self, text: bytes) -> None:
        if self.closed:
            return
        at, signs, self.inside = _brackets(np.frombuffer(text, np.uint8), self.inside)
        depth = self.depth + np.cumsum(signs)
        from_ = 0
        turns = np.flatnonzero(((signs > 0) & (depth == 2)) | ((signs < 0) & (depth <= 1)))
        for k in turns:
            place = int(at[k])
            if signs[k] > 0:
                self.open, self.began, from_ = [], True, place
            elif depth[k] == 1:
                self.open.append(text[from_:place + 1])
                self.rows.append((WHOLE if self.began else END, b"".join(self.open)))
                self.open, self.began = None, True
            else:                       # the array ends; what follows is no part of it
                self.closed = True
                return
        if self.open is not None:
            self.open.append(text[from_:])
        self.depth = int(depth[-1]) if depth.size else self.depth

    def finish(self) -> list[tuple[int, bytes]]:
        if self.last and not self.closed:
            raise ValueError("the JSON array does not end")
        if self.open is not None:
            self.rows.append((START if self.began else MIDDLE, b"".join(self.open)))
        return self.rows


def _cut(begin: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cutter, done = None, None, 0

        def rows(taken, before):
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * len(taken), pa.string()), pa.array([key[1]] * len(taken), pa.int64()),
                 pa.array(range(before, before + len(taken)), pa.int64()),
                 pa.array([k for k, _ in taken], pa.int32()),
                 pa.array([t for _, t in taken], pa.binary()).cast(pa.string())],
                ["_path", "_start", "_at", "_kind", "_text"])

        for now, text in _ranges(batches):
            if now != key:
                if cutter and (taken := cutter.finish()):
                    yield rows(taken, done)
                key, cutter, done = now, _Cutter(begin[now]), 0
            cutter.take(text)
            taken, cutter.rows = cutter.rows, []
            if taken:
                yield rows(taken, done)
                done += len(taken)
        if cutter and (taken := cutter.finish()):
            yield rows(taken, done)
    return run


@contextmanager
def _pinned(spark: SparkSession, range_bytes: int | None):
    """The same byte ranges in both passes, also where executors come and go between them."""
    names = {"spark.sql.files.minPartitionNum": spark.sparkContext.defaultParallelism}
    if range_bytes:
        names["spark.sql.files.maxPartitionBytes"] = range_bytes
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, str(v))
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def read_json_array(spark: SparkSession, path: str, schema, order: str | None = None,
                    range_bytes: int | None = None) -> DataFrame:
    """The objects of a JSON array file (or of a folder of such files) as rows of ``schema``.

    Ranges are as large as ``spark.sql.files.maxPartitionBytes`` allows (``range_bytes``
    instead), and each is a task. Both passes run at once, the records are written to the
    scratch folder and parsed from there. ``order`` names an added column that sorts as the records lie in the files.

    Braces, brackets and quotes in strings, escapes, white space and nesting are read as
    JSON has them. An empty array gives no rows; elements that are no objects or arrays
    give none; a record that ``schema`` does not fit has nulls, as in Spark's reader;
    what follows the array is ignored; a file that ends before its array raises.
    """
    fragments = (spark.read.option("lineSep", "}").text(path)
                 .select("value", F.col("_metadata.file_path").alias("_path"),
                         F.col("_metadata.file_block_start").alias("_start")))
    with _pinned(spark, range_bytes):
        seen = fragments.mapInArrow(
            _summaries, "_path string, _start bigint, out_state bigint, out_depth bigint, "
                        "in_state bigint, in_depth bigint").collect()      # one row a range
        pieces = write_scratch(fragments.mapInArrow(
            _cut(_compose(seen)), "_path string, _start bigint, _at bigint, _kind int, _text string"),
            "json-records")
    whole = pieces.where(F.col("_kind") == WHOLE).select("_path", "_start", "_at", "_text")
    # at most two pieces a range; a record's pieces follow its START in file order
    by_file = Window.partitionBy("_path").orderBy("_start", "_at")
    crossing = (pieces.where(F.col("_kind") != WHOLE)
                .withColumn("_record", F.count_if(F.col("_kind") == START).over(by_file))
                .groupBy("_path", "_record")
                .agg(F.sort_array(F.collect_list(F.struct("_start", "_at", "_text"))).alias("_parts"))
                .select("_path", F.col("_parts")[0]["_start"].alias("_start"),
                        F.col("_parts")[0]["_at"].alias("_at"),
                        F.array_join(F.col("_parts")["_text"], "").alias("_text")))
    rows = whole.unionByName(crossing)
    parsed: list[Column] = [F.from_json("_text", schema).alias("_row")]
    if order:
        parsed.append(F.struct(F.lit(-1).cast("long").alias("p"), F.col("_path").alias("f"),
                               F.col("_start").alias("b"), F.col("_at").alias("r")).alias(order))
    return rows.select(*parsed).select("_row.*", *([order] if order else []))
