"""Quality classifier: a factorisation machine over words, structure and metadata.

score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pairwise
part is computed in linear time as half of sum_f ((sum_i v_if x_i)^2 -
sum_i v_if^2 x_i^2). Inputs x are hashed words (square root of their counts,
scaled to length 1) and standardised structure statistics and sizes.

Training sees a bounded sample (a parameter) of the labelled rows; scoring sees
every byte of every text, in Arrow batches of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revline.llm import textvec
from revline.llm.langid import hash_below, held_out

STATISTICS = (
    "log bytes", "log words", "log lines", "mean word length", "mean line length",
    "upper-case letters", "digits", "punctuation", "bytes beyond ASCII", "white space",
    "symbols", "bars", "exclamation marks", "full stops and commas",
    "different words", "commonest word", "different lines", "bytes in repeated lines",
    "upper-case words", "words ending in a symbol", "long words", "one-letter words",
)


def _class(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in chars]] = True
    return table


_UPPER, _DIGIT = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789")
_SYMBOL = _class("#$%&*+<=>@^_`{|}~\\/[]")
_PUNCT = _SYMBOL | _class("!\"'(),-.:;?")


def _share(hits: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Share of true bytes in each row."""
    total = np.concatenate([[0], np.cumsum(hits)])
    return (total[offs[1:]] - total[offs[:-1]]) / np.maximum(np.diff(offs), 1)


def _groups(keys: np.ndarray, rows: np.ndarray, weights: np.ndarray, n: int):
    """Of (row, key) pairs: row, first index, count and weight of each different pair."""
    order = np.lexsort((keys, rows))
    k, r = keys[order], rows[order]
    first = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (r[1:] != r[:-1])]) if k.size else order
    count = np.diff(np.r_[first, k.size])
    weight = np.add.reduceat(weights[order], first) if k.size else weights[:0]
    return r[first], order[first], count, weight


def extract(data: np.ndarray, offs: np.ndarray, n_buckets: int):
    """Sparse word inputs (row, bucket, value; by row) and the statistics of each row."""
    n = offs.size - 1
    size = np.diff(offs)
    starts, ends, rows = textvec.words(data, offs)
    hashes = textvec.span_hashes(textvec.LOWER[data], starts, ends)
    length = (ends - starts).astype(np.float64)
    n_words = np.bincount(rows, minlength=n)
    per_word = np.maximum(n_words, 1)

    row, _, count, _ = _groups(hashes, rows, length, n)
    different = np.bincount(row, minlength=n)
    commonest = np.zeros(n)
    np.maximum.at(commonest, row, count)

    edge = np.zeros(data.size + 1, bool)
    edge[offs] = True
    edge[1:] |= np.r_[data == 10]
    at = np.flatnonzero(edge)
    line_start, line_end = at[:-1], at[1:]
    line_row = np.searchsorted(offs, line_start, side="right") - 1
    line_size = (line_end - line_start).astype(np.float64)
    n_lines = np.bincount(line_row, minlength=n)
    lrow, _, lcount, lweight = _groups(
        textvec.span_hashes(data, line_start, line_end), line_row, line_size, n)
    repeated = np.bincount(lrow, lweight * (lcount - 1) / lcount, minlength=n)

    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    shouted = (upper[ends] - upper[starts]) * 2 > length
    per = lambda hits: np.bincount(rows, hits, minlength=n) / per_word
    stats = np.stack([
        np.log1p(size), np.log1p(n_words), np.log1p(n_lines), per(length),
        np.log1p(size / np.maximum(n_lines, 1)),
        _share(_UPPER[data], offs), _share(_DIGIT[data], offs), _share(_PUNCT[data], offs),
        _share(data > 127, offs), _share(textvec._SPACE[data], offs), _share(_SYMBOL[data], offs),
        _share(data == ord("|"), offs), _share(data == ord("!"), offs),
        _share((data == ord(".")) | (data == ord(",")), offs),
        different / per_word, commonest / per_word,
        np.bincount(lrow, minlength=n) / np.maximum(n_lines, 1), repeated / np.maximum(size, 1),
        per(shouted & (length > 1)), per(_SYMBOL[data[ends - 1]] if ends.size else length),
        per(length > 14), per(length == 1)], axis=1)

    bucket = (hashes >> np.uint64(64 - int(np.log2(n_buckets)))).astype(np.int64)
    row, where, count, _ = _groups(bucket, rows, length, n)
    value = np.sqrt(count)
    norm = np.sqrt(np.bincount(row, value * value, minlength=n))
    return row, bucket[where], value / np.maximum(norm, 1e-12)[row], stats


@dataclass
class QualityModel:
    bias: float
    linear: np.ndarray    # inputs: buckets, then statistics
    factors: np.ndarray   # inputs x rank
    mean: np.ndarray
    scale: np.ndarray
    n_buckets: int

    def scores(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        row, bucket, value, stats = extract(data, offs, self.n_buckets)
        n, k = offs.size - 1, self.factors.shape[1]
        z = standardise(stats, self.mean, self.scale)
        w, v = self.linear[self.n_buckets:], self.factors[self.n_buckets:]
        total = self.bias + z @ w
        summed, squared = z @ v, (z * z) @ (v * v)
        if row.size:
            first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            at = row[first]
            total[at] += np.add.reduceat(self.linear[bucket] * value, first)
            vx = self.factors[bucket] * value[:, None]
            summed[at] += np.add.reduceat(vx, first, axis=0)
            squared[at] += np.add.reduceat(vx * vx, first, axis=0)
        assert summed.shape == (n, k)
        total += 0.5 * (summed * summed - squared).sum(1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def standardise(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Statistics with mean 0 and spread 1 in training, cut at 4 and scaled as the words are."""
    return np.clip((stats - mean) / scale, -4, 4) / np.sqrt(stats.shape[1])


class WordRows:
    """Sparse word inputs of many rows; only the rows of a batch are ever spread out."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], n_buckets: int):
        """``rows``: buckets and their values."""
        self.n_buckets = n_buckets
        self.start = np.cumsum([0] + [b.size for b, _ in rows])
        self.bucket = np.concatenate([b for b, _ in rows] or [np.zeros(0, np.int32)])
        self.value = np.concatenate([v for _, v in rows] or [np.zeros(0, np.float32)])

    def dense(self, at: np.ndarray, stats: np.ndarray) -> np.ndarray:
        """Inputs of the rows ``at``: buckets, then their statistics."""
        out = np.zeros((at.size, self.n_buckets + stats.shape[1]), np.float32)
        for k, r in enumerate(at):
            a, b = self.start[r], self.start[r + 1]
            out[k, self.bucket[a:b]] = self.value[a:b]
        out[:, self.n_buckets:] = stats[at]
        return out


def fit(words: WordRows, stats: np.ndarray, y: np.ndarray, rank: int = 6, epochs: int = 30,
        rate: float = 0.03, decay: float = 1e-4, batch: int = 128, seed: int = 0) -> QualityModel:
    """Logistic loss, Adam on small batches."""
    mean, scale = stats.mean(0), np.maximum(stats.std(0), 1e-3)
    z = standardise(stats, mean, scale).astype(np.float32)
    inputs = words.n_buckets + z.shape[1]
    rng = np.random.default_rng(seed)
    share = float(np.clip(y.mean(), 0.001, 0.999))
    b = np.array([np.log(share / (1 - share))], np.float32)
    w = np.zeros(inputs, np.float32)
    v = rng.normal(0, 0.05, (inputs, rank)).astype(np.float32)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (b, w, v)]
    t = 0
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            xb, t = words.dense(at, z), t + 1
            xv = xb @ v
            x2 = xb * xb
            total = b + xb @ w + 0.5 * (xv * xv - x2 @ (v * v)).sum(1)
            g = ((1 / (1 + np.exp(-np.clip(total, -30, 30))) - y[at]) / len(at)).astype(np.float32)
            grads = (g.sum(keepdims=True), xb.T @ g + decay * w,
                     xb.T @ (xv * g[:, None]) - (x2.T @ g)[:, None] * v + decay * v)
            for p, grad, (m, s) in zip((b, w, v), grads, moments, strict=True):
                m += 0.1 * (grad - m)
                s += 0.001 * (grad * grad - s)
                p -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.999 ** t)) + 1e-8)
    return QualityModel(float(b[0]), w.astype(np.float64), v.astype(np.float64), mean, scale,
                        words.n_buckets)


def _inputs(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textvec.small_batches(batches, "text"):
            row, bucket, value, stats = extract(*textvec.utf8(batch.column("text")), n_buckets)
            at = np.searchsorted(row, np.arange(batch.num_rows + 1))
            cut = list(zip(at[:-1], at[1:], strict=True))
            yield pa.RecordBatch.from_arrays([
                batch.column("y"),
                pa.array([bucket[a:b].astype(np.int32).tobytes() for a, b in cut], pa.binary()),
                pa.array([value[a:b].astype(np.float32).tobytes() for a, b in cut], pa.binary()),
                pa.array([s.tobytes() for s in stats], pa.binary())],
                ["y", "buckets", "values", "stats"])
    return run


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 6000, n_buckets: int = 1 << 12,
          id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> QualityModel | None:
    """Learn from labelled documents; None if there are none.

    The sample is bounded: the ``max_rows`` labelled ids with the smallest hash.
    Their inputs (at most n_buckets numbers a row), not their texts, reach the
    driver. Of several labels for one id the majority counts, 0 on a tie.
    """
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id"))
             .agg(F.avg(label_col).alias("_y")))
    # of many labels, only hashes that leave a few times the wanted rows: those are
    # broadcast, so the documents' ids need no shuffle
    share = min(1.0, 4 * max_rows / max(1, known.count()))
    few = known.where(hash_below("_id", F.lit(share))).select(
        "_id", (F.col("_y") > 0.5).cast("int").alias("y"))
    some = (docs.select(F.col(id_col).alias("_id")).join(F.broadcast(few), "_id").distinct()
            .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    sample = (docs.select(F.col(id_col).alias("_id"),
                          F.coalesce(F.col(text_col), F.lit("")).alias("text"))
              .join(F.broadcast(some), "_id").select("y", "text")
              .mapInArrow(_inputs(n_buckets), "y int, buckets binary, values binary, stats binary")
              .collect())
    if not sample:
        return None
    sample.sort(key=lambda r: (r["y"], bytes(r["stats"]), bytes(r["buckets"])))
    words = WordRows([(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["values"], np.float32))
                      for r in sample], n_buckets)
    stats = np.stack([np.frombuffer(r["stats"], np.float64) for r in sample])
    y = np.array([r["y"] for r in sample], np.float32)
    del sample
    return fit(words, stats, y)


def score(docs: DataFrame, model: QualityModel | None, keep: list[str],
          text_col: str = "text") -> DataFrame:
    """Columns ``keep`` and score, predicted of every row, from its text alone.

    score is 0 to 1, higher where label 1 is likelier; predicted is 1 where it is
    at least 0.5. Defined cases: a null text is scored as the empty text; without
    any labels every score is 0.5; repeated rows are scored each; no rows give
    no rows.
    """
    out = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textvec.small_batches(batches, "__text"):
            found = (np.full(batch.num_rows, 0.5) if model is None else
                     model.scores(*textvec.utf8(batch.column("__text"))))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f"__keep{i}") for i in range(len(keep))),
                 pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                [*keep, "score", "predicted"])

    return docs.select(*(F.col(c).alias(f"__keep{i}") for i, c in enumerate(keep)),
                       F.col(text_col).alias("__text")).mapInArrow(
        run, ", ".join([*out, "score double", "predicted int"]))


def held_out_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Train on two thirds of the ids, score every row."""
    is_out = held_out(id_col, 3, 1)
    model = train(docs.where(~is_out), labels.where(~is_out), id_col=id_col)
    return score(docs.select(id_col, "text", is_out.alias("held_out")), model,
                 [id_col, "held_out"])


def keep_good(docs: DataFrame, model: QualityModel | None, text_col: str = "text") -> DataFrame:
    """The rows, all columns, that the model does not reject (predicted 1)."""
    names = docs.columns
    return (score(docs.toDF(*(f"c{i}" for i in range(len(names)))), model,
                  [f"c{i}" for i in range(len(names))], f"c{names.index(text_col)}")
            .where("predicted = 1")
            .select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names))))
