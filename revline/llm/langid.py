"""Language identification by error-correcting output codes.

Each language has a codeword of -1 and +1. One binary classifier for each bit,
logistic regression on hashed byte n-grams, predicts that bit of the codeword.
Decoding adds the classifiers' losses under each codeword, weighted by how well
a bit was learned, takes the codeword with the least loss and flags a text as
ambiguous where the runner-up is nearly as good.

Training sees a bounded sample (a parameter) of the labelled rows; prediction
sees every byte of every text, in Arrow batches of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revline.llm import textvec
from revline.session import write_scratch

#: a letter of any script, to Spark's regular expressions (learning and predicting ask the same)
LETTER = r"\p{L}"
UNDETERMINED = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray      # languages x bits, -1 and +1
    weights: np.ndarray   # buckets x bits
    bias: np.ndarray      # bits
    trust: np.ndarray     # bits, adds up to the number of bits
    ambiguous: float      # a winner's share below this is ambiguous
    farthest: float = np.inf  # a text farther from every codeword is in no known language
    least: float = 0.0    # a text whose winner has a smaller share is in none of them for sure


def codewords(n: int, seed: int = 0) -> np.ndarray:
    """n codewords that differ in many bits.

    Up to 7 languages: the exhaustive code, every way to split the languages in
    two. Beyond: of many seeded random codes (fewer beyond 64 languages), the one
    whose closest two words are farthest apart.
    """
    if n < 2:
        return np.ones((n, 1))
    if n <= 7:
        bits = 2 ** (n - 1) - 1
        splits = np.arange(2 ** (n - 1), 2 ** n - 1)
        return np.array([[1.0 if s >> (n - 1 - k) & 1 else -1.0 for s in splits]
                         for k in range(n)]).reshape(n, bits)
    rng, best, best_gap = np.random.default_rng(seed), None, -1
    bits = int(np.ceil(10 * np.log2(n)))
    for _ in range(max(3, 200 * 64 ** 2 // max(n, 64) ** 2)):
        code = rng.choice([-1.0, 1.0], (n, bits))
        gap = bits
        for at in range(0, n, 256):
            part = (bits - code[at:at + 256] @ code.T) / 2
            part[np.arange(len(part)), at + np.arange(len(part))] = bits
            gap = min(gap, part.min())
        if gap > best_gap and (np.abs(code.sum(0)) < n).all():
            best, best_gap = code, gap
    return best


def buckets_of(data: np.ndarray, offs: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every byte trigram that lies in one row (ASCII lower-cased)."""
    if data.size < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = textvec.LOWER[data].astype(np.uint32)
    gram = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
    rows = np.repeat(np.arange(offs.size - 1), np.diff(offs))
    keep = rows[:-2] == rows[2:]
    bucket = (gram * np.uint32(2654435761)) >> np.uint32(32 - int(np.log2(n_buckets)))
    return bucket[keep].astype(np.int64), rows[:-2][keep]


def features(data: np.ndarray, offs: np.ndarray, n_buckets: int) -> np.ndarray:
    """Rows x buckets: the share of each bucket among a text's trigrams, times 100."""
    bucket, row = buckets_of(data, offs, n_buckets)
    n = offs.size - 1
    counts = np.bincount(row * n_buckets + bucket, minlength=n * n_buckets).reshape(n, n_buckets)
    return (counts * (100.0 / np.maximum(counts.sum(1), 1)[:, None])).astype(np.float32)


def _feature_rows(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textvec.small_batches(batches, "text"):
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                x = features(*textvec.utf8(part.column("text")), n_buckets)
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), pa.array([r.tobytes() for r in x], pa.binary())],
                    ["lang", "x"])
    return run


def fit(x: np.ndarray, labels: np.ndarray, languages: list[str], ambiguous: float = 0.6,
        steps: int = 150, rate: float = 0.05, decay: float = 1e-4) -> LanguageModel:
    """One logistic regression for each code bit, all in one matrix (Adam, full batch)."""
    code = codewords(len(languages))
    target = code[labels]
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    share = np.bincount(labels, minlength=len(languages))
    per_row = (1.0 / np.maximum(share, 1))[labels][:, None] / len(languages)
    for t in range(1, steps + 1):
        margin = target * (x @ w + b)
        g = (-target * per_row / (1 + np.exp(np.clip(margin, -30, 30)))).astype(np.float32)
        for k, (value, grad) in enumerate(((w, x.T @ g + decay * w), (b, g.sum(0)))):
            m, v = state[2 * k], state[2 * k + 1]
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            value -= (rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    right = ((target * (x @ w + b) > 0) * per_row).sum(0)
    trust = np.maximum(right - 0.5, 0.01)
    return LanguageModel(languages, code, w, b, trust * (trust.size / trust.sum()), ambiguous)


def losses(model: LanguageModel, outputs: np.ndarray) -> np.ndarray:
    """Rows x languages: the sum of log(1 + exp(-bit * output)) under each codeword, weighted."""
    step = max(1, (4 << 20) // model.code.size)  # rows at a time, for many languages
    parts = [(np.logaddexp(0, -(outputs[at:at + step, None, :] * model.code[None, :, :]))
              * model.trust).sum(2) for at in range(0, max(1, len(outputs)), step)]
    return np.concatenate(parts)


def decode(model: LanguageModel, outputs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Winner, its score and the runner-up of each row of classifier outputs.

    Scores are the shares exp(-loss). Ties go to the first language.
    """
    return _winners(losses(model, outputs))


def _winners(loss: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    share = np.exp(loss.min(1, keepdims=True) - loss)
    share /= share.sum(1, keepdims=True)
    order = np.argsort(-share, axis=1, kind="stable")
    second = order[:, 1] if share.shape[1] > 1 else order[:, 0]
    return order[:, 0], share[np.arange(len(share)), order[:, 0]], second


def known_bounds(x: np.ndarray, labels: np.ndarray, model: LanguageModel) -> tuple[float, float]:
    """The least loss that a text in a known language does not reach, and the score
    that it does not fall below.

    Each half of the rows is decoded by a model of the other half, and all by
    ``model``. Examples of a language are the rows that are placed in their own and
    not ambiguously: a wrong label or a text between two languages moves no limit.
    To the largest loss of an example a quarter of the way from the median is added;
    it is log(2) at least, what one undecided bit loses: the one bit of two languages
    can tell no text from theirs. The score is that below which a text is ambiguous.

    Only where the labels do not follow from the texts (the halves place no more rows
    than halfway from chance to all, each language of several rows counting alike)
    ambiguity says nothing: then every row is an example, and the smallest score of
    one is the limit.
    """
    seen, scores, placed = [], [], []

    def note(part: LanguageModel, rows: np.ndarray, own: np.ndarray) -> None:
        loss = losses(part, rows.astype(np.float64) @ part.weights + part.bias)
        best, share, _ = _winners(loss)
        seen.append(loss.min(1))
        scores.append(share)
        placed.append(best == own)

    note(model, x, labels)
    out = np.arange(len(x)) % 2 == 0
    for half in (out, ~out):
        if half.any() and not half.all():
            note(fit(x[~half], labels[~half], model.languages), x[half], labels[half])
    loss, score, right = (np.concatenate(part) for part in (seen, scores, placed))
    least, n = model.ambiguous, len(model.languages)
    if len(loss) > len(x):  # the rows by the halves' models come after those by the whole one's
        own, rows = np.r_[labels[out], labels[~out]], np.bincount(labels, minlength=n)
        found = (np.bincount(own, right[len(x):], n) / np.maximum(rows, 1))[rows > 1]
        if n > 1 and (found.mean() if found.size else 0.0) <= (1 + 1 / n) / 2:
            right, least = np.ones(len(loss), bool), max(0.0, min(least, score.min()) - 1e-6)
    seen_right = loss[right & (score >= least)]
    most, middle = (seen_right.max(), np.median(seen_right)) if seen_right.size else (0.0, 0.0)
    return float(max(most + 0.25 * (most - middle), np.log(2)) + 1e-6), float(least)


def hash_below(id_col: str, share) -> Column:
    """True for about this share of the ids, those with the smallest hash."""
    return F.xxhash64(id_col).cast("double") <= (share - 0.5) * 2.0 ** 64


def train(docs: DataFrame, max_per_language: int = 400, max_rows: int = 400 * 64,
          n_buckets: int = 1 << 12, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", farthest: bool = False) -> LanguageModel | None:
    """Learn from rows with a language and a letter in their text; None if there are none.

    Every language is learned (of more than ``max_rows`` values of lang only as many, the
    most frequent: the driver's sample is bounded). The sample is ``max_per_language`` rows of each, the
    ones whose id hash is smallest, or fewer where that would be more than
    ``max_rows`` rows together, but one of each language at least.
    Only their hashed counts (n_buckets numbers a row) reach the driver. With
    ``farthest`` the model also knows how far from it and how unsure a known language can be.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("lang"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = rows.where("lang IS NOT NULL")
    counts = write_scratch(known.groupBy("lang").count(), "langs")
    n_languages = counts.count()
    if not n_languages:
        return None
    if n_languages > max_rows:  # no sample of max_rows has a row of each
        counts = counts.orderBy(F.desc("count"), "lang").limit(max_rows)
        n_languages = max_rows
    most = max(1, min(max_per_language, max_rows // n_languages))
    # of a frequent language, only hashes that leave a few times the wanted rows
    share = F.least(F.lit(1.0), F.lit(4.0 * most + (32 if most < max_per_language else 0)) / F.col("count"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("_id"), "_id")
    some = (known.join(F.broadcast(counts), "lang").where(hash_below("_id", share))
            .where(F.col("text").rlike(LETTER)).select("_id", "lang")
            .withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= most)
            .select("_id", F.col("lang").alias("_lang")).distinct())
    # at most max_rows ids, or one of each language
    sample = (known.join(F.broadcast(some), "_id", "left_semi")
              .where(F.col("text").rlike(LETTER)).select("lang", "text")
              .mapInArrow(_feature_rows(n_buckets), "lang string, x binary").collect())
    sample.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    if not sample:
        return None
    languages = sorted({r["lang"] for r in sample})
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in sample])
    place = {lang: k for k, lang in enumerate(languages)}
    labels = np.array([place[r["lang"]] for r in sample])
    model = fit(x, labels, languages)
    if farthest:
        far, least = known_bounds(x, labels, model)
        model = replace(model, farthest=far, least=least)
    return model


def predict(docs: DataFrame, model: LanguageModel | None, keep: list[str],
            text_col: str = "text", with_loss: bool = False) -> DataFrame:
    """Columns ``keep`` and lang_pred, score, ambiguous, second_lang of every row.

    The text's language only follows from its text. Defined cases: a null text
    or one without a letter is ``und`` with score 0, and so is every text if
    nothing could be learned; ambiguous is true where the winner's share is
    below the model's threshold, for ``und`` always; second_lang is null for
    ``und`` and where only one language is known. ``with_loss`` adds the loss of the
    winner's codeword: null without a letter, 0 if nothing could be learned. Repeated rows are predicted
    each; no rows give no rows.
    """
    out = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    out += ["lang_pred string", "score double", "ambiguous boolean", "second_lang string"]
    if with_loss:
        out.append("loss double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one row of weights for each byte: small batches keep that in a few MB
        for batch in textvec.small_batches(batches, "__text", textvec.MAX_BYTES // 2):
            texts = batch.column("__text")
            letters = batch.column("__letters").to_numpy(zero_copy_only=False).astype(bool)
            lang = np.full(batch.num_rows, UNDETERMINED, object)
            second = np.full(batch.num_rows, None, object)
            score, least = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            if model is not None and letters.any():
                data, offs = textvec.utf8(texts)
                bucket, row = buckets_of(data, offs, model.weights.shape[0])
                seen = np.bincount(row, minlength=batch.num_rows)
                total = np.zeros((batch.num_rows, model.bias.size))
                first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if row.size else row
                if row.size:
                    total[row[first]] = np.add.reduceat(
                        model.weights[bucket], first, axis=0, dtype=np.float64)
                outputs = total * (100.0 / np.maximum(seen, 1))[:, None] + model.bias
                loss = losses(model, outputs)
                least = loss.min(1)
                best, share, runner = _winners(loss)
                names = np.array(model.languages, object)
                lang[letters], score[letters] = names[best][letters], share[letters]
                if len(names) > 1:
                    second[letters] = names[runner][letters]
            unsure = ~letters | (score < (model.ambiguous if model else 1))
            found = [*(batch.column(f"__keep{i}") for i in range(len(keep))),
                     pa.array(lang, pa.string()), pa.array(score), pa.array(unsure),
                     pa.array(second, pa.string())]
            names = [*keep, "lang_pred", "score", "ambiguous", "second_lang"]
            if with_loss:
                found, names = [*found, pa.array(least, mask=~letters)], [*names, "loss"]
            yield pa.RecordBatch.from_arrays(found, names)

    return docs.select(*(F.col(c).alias(f"__keep{i}") for i, c in enumerate(keep)),
                       F.col(text_col).alias("__text"),
                       F.coalesce(F.col(text_col).rlike(LETTER), F.lit(False)).alias("__letters")
                       ).mapInArrow(run, ", ".join(out))


def held_out(id_col: str, modulus: int, rest: int):
    """Rows whose crc32 of the id as text leaves ``rest`` modulo ``modulus``; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus == rest, F.lit(True))


def held_out_languages(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Train on three quarters of the ids, predict every row."""
    is_out = held_out(id_col, 4, 2)
    model = train(docs.where(~is_out), id_col=id_col)
    marked = docs.select(id_col, "text", is_out.alias("held_out"))
    return predict(marked, model, [id_col, "held_out"])


def keep_determined(docs: DataFrame, model: LanguageModel | None, least: float | None = None,
                    text_col: str = "text") -> DataFrame:
    """The rows, all columns, whose text has a letter, is no farther from the known
    languages than the model allows and has a score of ``least`` or more (None: what
    the model has learned that known languages reach).

    If nothing could be learned, every row with a letter stays.
    """
    farthest = model.farthest if model is not None else np.inf
    if least is None or model is None:
        least = model.least if model is not None else 0.0
    names = docs.columns
    return (predict(docs.toDF(*(f"c{i}" for i in range(len(names)))), model,
                    [f"c{i}" for i in range(len(names))], f"c{names.index(text_col)}", with_loss=True)
            .where((F.col("loss") <= float(farthest)) & (F.col("score") >= least))
            .select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names))))
