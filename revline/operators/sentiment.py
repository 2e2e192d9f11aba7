"""Batch text sentiment: a pluggable scorer over review texts.

Scorer protocol: a *factory* ``() -> scorer``; a scorer maps a list of texts
to a list of ``(raw_label, confidence)`` pairs. The factory runs once per
Python worker *process*, whatever tasks and queries it serves (a registry keyed by
the factory); texts arrive in Arrow batches through ``mapInPandas`` and are fed to
the scorer in batches of like length. Ids never leave the batch they came in, so results line
up with their rows without any join.

The bundled lexicon scorer is deterministic and is *not* a trained model;
it also has a JVM-only form (``lexicon_columns``) for the fast path. A
transformer model plugs into the same factory slot.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revline.functions.exact import idiv
from revline.functions.scalars import map_with_default, text_prefix

Scorer = Callable[[list[str]], list[tuple[str, float]]]
ScorerFactory = Callable[[], Scorer]

# Fixed values that must stay as they are for results to match.
# Input cut for model scorers with a hard input size (a transformer took the
# first 512 characters); the lexicon scorer reads whole texts by default.
MODEL_INPUT_CHARS = 512
DEFAULT_BATCH = 32
# characters of a batch after padding to its longest text (ours; 32 texts of 8,192)
DEFAULT_BATCH_CHARS = 1 << 18
LABEL_MAP = {
    "negative": "negative",
    "neutral": "neutral",
    "positive": "positive",
    "LABEL_0": "negative",
    "LABEL_1": "neutral",
    "LABEL_2": "positive",
}

# Lexicon of the bundled scorer (our own choice; lower-case ASCII words).
POSITIVE_WORDS = ("good", "great", "best", "love", "excellent", "happy", "nice", "wonderful",
                  "bon", "gut", "bueno")
NEGATIVE_WORDS = ("bad", "worst", "poor", "hate", "terrible", "awful", "boring", "sad",
                  "mauvais", "schlecht", "malo")
TOKEN_SPLIT = "[^a-z]+"


def _confidence_e4(pos: int, neg: int) -> int:
    """Confidence x 10^4: grows with the margin for a polar text, with the
    number of tone words shrinking it for a balanced (neutral) one."""
    total = pos + neg
    if pos != neg:
        return 5000 + (5000 * abs(pos - neg)) // (total + 1)
    return 10000 - (5000 * total) // (total + 1)


class LexiconScorer:
    """Counts lexicon words in lower-cased text split on non-letters."""

    def __init__(self):
        self._pos = frozenset(POSITIVE_WORDS)
        self._neg = frozenset(NEGATIVE_WORDS)
        self._split = re.compile(TOKEN_SPLIT)

    def __call__(self, texts: list[str]) -> list[tuple[str, float]]:
        out = []
        for t in texts:
            toks = self._split.split(t.lower())
            pos = sum(1 for w in toks if w in self._pos)
            neg = sum(1 for w in toks if w in self._neg)
            label = "LABEL_2" if pos > neg else "LABEL_0" if neg > pos else "LABEL_1"
            out.append((label, _confidence_e4(pos, neg) / 10000.0))
        return out


def lexicon_factory() -> Scorer:
    return LexiconScorer()


def _word_count(text: Column, words: Sequence[str]) -> Column:
    """Occurrences of any of ``words`` as a whole token of ``[a-z]`` letters.

    A token is a maximal run of letters, so a word counts when no letter
    touches it on either side: the lookarounds express exactly the
    split-on-non-letters rule without building an array per row.
    """
    pattern = "(?<![a-z])(?:" + "|".join(words) + ")(?![a-z])"
    return F.regexp_count(text, F.lit(pattern)).cast("bigint")


def lexicon_columns(text: Column) -> tuple[Column, Column]:
    """The lexicon scorer as built-in expressions: (raw_label, confidence).

    Same tokens, counts and integer formula as ``LexiconScorer``; it stays
    inside the JVM, so no rows cross into Python.
    """
    low = F.lower(text)
    pos = _word_count(low, POSITIVE_WORDS)
    neg = _word_count(low, NEGATIVE_WORDS)
    total = pos + neg
    polar = F.lit(5000) + idiv(F.lit(5000) * F.abs(pos - neg), total + 1)
    balanced = F.lit(10000) - idiv(F.lit(5000) * total, total + 1)
    conf = F.when(pos != neg, polar).otherwise(balanced) / F.lit(10000.0)
    label = (F.when(pos > neg, F.lit("LABEL_2"))
             .when(neg > pos, F.lit("LABEL_0")).otherwise(F.lit("LABEL_1")))
    return label, conf


def normalise_label(label: Column) -> Column:
    """Model label names -> positive / neutral / negative; unknown pass through."""
    return map_with_default(label, LABEL_MAP)


def review_texts(fact: DataFrame, limit: int | None = None, id_col: str = "review_id") -> DataFrame:
    """(id, text) to score: ``COALESCE(review_text, summary, '')``.

    ``limit`` of 0 or None means everything; otherwise the lowest ids first.
    """
    out = fact.select(F.col(id_col).alias("review_id"),
                      F.coalesce(F.col("review_text"), F.col("summary"), F.lit("")).alias("text"))
    if limit:
        out = out.orderBy("review_id").limit(int(limit))
    return out


#: scorers of this process, by what their factory is (see ``_factory_key``)
_SCORERS: dict[str, Scorer] = {}
#: models that a process holds at a time
MOST_SCORERS = 4


def _factory_key(factory: ScorerFactory) -> str:
    """The same for a factory in every task of every query: a hash of its pickled form
    (its name where workers can import it, else its code and what it closes over)."""
    return hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()


def scorer_of(key: str, factory: ScorerFactory) -> Scorer:
    """The scorer of a factory in this worker process, made when first asked for.

    Spark reuses a worker for many tasks, so a model is loaded once a process.
    """
    if key not in _SCORERS:
        while len(_SCORERS) >= MOST_SCORERS:
            del _SCORERS[next(iter(_SCORERS))]
        _SCORERS[key] = factory()
    return _SCORERS[key]


def length_batches(lengths: Sequence[int], batch_size: int, batch_chars: int | None) -> Iterator[list[int]]:
    """Places of texts by rising length, in batches of ``batch_size`` at most that, padded
    to their longest, have ``batch_chars`` characters at most (one text at least)."""
    batch: list[int] = []
    for i in sorted(range(len(lengths)), key=lengths.__getitem__):
        if batch and (len(batch) >= batch_size
                      or batch_chars and (len(batch) + 1) * lengths[i] > batch_chars):
            yield batch
            batch = []
        batch.append(i)
    if batch:
        yield batch


def _score_batches(factory: ScorerFactory, batch_size: int, batch_chars: int | None,
                   max_chars: int | None, text_col: str, keep: list[str]):
    label_map, key = dict(LABEL_MAP), _factory_key(factory)

    def run(batches: Iterator) -> Iterator:
        scorer = scorer_of(key, factory)
        for pdf in batches:
            texts = [(t[:max_chars] if max_chars else t) if t else "" for t in pdf[text_col].tolist()]
            labels: list[str] = [""] * len(texts)
            scores: list[float] = [0.0] * len(texts)
            for at in length_batches([len(t) for t in texts], batch_size, batch_chars):
                found = scorer([texts[i] for i in at])
                for i, (lab, sc) in zip(at, found, strict=True):
                    labels[i] = label_map.get(lab, lab)
                    scores[i] = round(float(sc), 4)
            out = pdf[keep].copy()
            out["sentiment_label"] = labels
            out["sentiment_score"] = scores
            yield out

    return run


def append_scores(df: DataFrame, text_col: str = "text", factory: ScorerFactory | None = None,
                  batch_size: int = DEFAULT_BATCH, max_chars: int | None = None,
                  drop_text: bool = True, batch_chars: int | None = DEFAULT_BATCH_CHARS) -> DataFrame:
    """Add ``sentiment_label`` and ``sentiment_score`` to every row of ``df``.

    ``factory=None`` uses the JVM form of the lexicon scorer; any other
    factory runs in Python workers over Arrow batches, once a worker process; texts of
    like length are scored together (``batch_size`` texts, ``batch_chars`` characters
    after padding) and results go back to their rows. Either way the rows
    stay in their partitions (no shuffle) and other columns pass through.
    Whole texts are scored; ``max_chars`` (e.g. ``MODEL_INPUT_CHARS``) cuts
    them only for a scorer that cannot take more. NULL text scores as ''.
    """
    keep = [c for c in df.columns if not (drop_text and c == text_col)]
    if factory is None:
        text = text_prefix(text_col, max_chars) if max_chars else F.coalesce(F.col(text_col), F.lit(""))
        label, conf = lexicon_columns(text)
        return df.select(*keep, normalise_label(label).alias("sentiment_label"),
                         F.round(conf, 4).alias("sentiment_score"))
    fields = [f for f in df.schema.fields if f.name in keep]
    schema = T.StructType(fields + [T.StructField("sentiment_label", T.StringType()),
                                    T.StructField("sentiment_score", T.DoubleType())])
    return df.mapInPandas(_score_batches(factory, batch_size, batch_chars, max_chars, text_col, keep), schema)


def score_texts(texts: DataFrame, factory: ScorerFactory | None = None,
                batch_size: int = DEFAULT_BATCH, max_chars: int | None = None) -> DataFrame:
    """(review_id, text) -> (review_id, sentiment_label, sentiment_score)."""
    return append_scores(texts.select(F.col("review_id").cast("bigint"), "text"), "text",
                         factory, batch_size, max_chars)


def sentiment_table(fact: DataFrame, factory: ScorerFactory | None = None, limit: int | None = None,
                    batch_size: int = DEFAULT_BATCH, with_timestamp: bool = False,
                    max_chars: int | None = None) -> DataFrame:
    """The review score table, rebuilt in full each run.

    An empty fact gives an empty table (the old scores are not kept).
    """
    out = score_texts(review_texts(fact, limit), factory, batch_size, max_chars)
    if with_timestamp:
        out = out.withColumn("scored_at", F.current_timestamp())
    return out
