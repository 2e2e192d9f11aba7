"""Language-model scores by stupid backoff, over counts of the whole corpus.

S(w | context) is count(context w) / count(context) where the longer n-gram was
seen, else 0.4 times the score with a context shorter by one word, down to
count(w) / N. A document is scored by the counts of all *other* documents.

The relational plan is explode, group by n-gram, join back, sum by document. At
one row for each n-gram occurrence it would shuffle tens of bytes for every word
several times, so rows are packed: documents form blocks (ranges of ids), and a
row holds the sorted n-grams of one block that fall into one hash bucket.

1. Blocks send their n-grams with counts to the buckets (the shuffle that grows
   with the corpus).
2. Each bucket adds up its part of the count table and answers every block with
   those of its n-grams that other blocks have as well.
3. Blocks join the answers to their own n-grams and sum the scores.

No table is broadcast, no n-gram is dropped, whatever its count.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revline.llm import textvec
from revline.session import write_scratch

BACKOFF = 0.4
#: UTF-8 bytes of text that a block of documents should have
BLOCK_BYTES = 8 << 20


def _pack(values: np.ndarray) -> bytes:
    """Numbers by byte planes: the high bytes of sorted numbers compress well."""
    return values.view(np.uint8).reshape(values.size, -1).T.tobytes()


def _unpack(raw: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(raw, np.uint8).reshape(width, -1).T.copy().view(kind).reshape(-1)


def ngrams(data: np.ndarray, offs: np.ndarray, order: int):
    """For n from 1 to order: hash and row of every n-gram, in the order of the text.

    Hashes of different n differ. Words are what white space separates.
    """
    starts, ends, rows = textvec.words(data, offs)
    words = textvec.span_hashes(data, starts, ends)
    return [textvec.window_hashes(words, rows, n) for n in range(1, order + 1)]


def _summed(grams: np.ndarray, counts: np.ndarray | None = None):
    """Different n-grams in order, and their total counts."""
    if counts is None:
        return np.unique(grams, return_counts=True)
    order = np.argsort(grams, kind="stable")
    grams, counts = grams[order], counts[order]
    first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]]) if grams.size else order
    return grams[first], np.add.reduceat(counts, first) if grams.size else counts


def _bucket_of(grams: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the hash, so sorted n-grams have ascending buckets."""
    return (((grams >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _requests(order: int, buckets: int, hold_bytes: int = BLOCK_BYTES):
    """(_bucket, _block, _grams, _counts, _words): n-grams of (parts of) blocks by bucket."""
    def flush(held: dict[int, list[pa.Array]]) -> Iterator[pa.RecordBatch]:
        for block, parts in held.items():
            found, words = [], 0
            for part in parts:
                each = ngrams(*textvec.utf8(part), order)
                words += each[0][0].size
                found += [g for g, _ in each]
            grams, counts = _summed(np.concatenate(found))
            if not grams.size:
                continue
            bucket = _bucket_of(grams, buckets)
            at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            cut = list(zip(at.tolist(), [*at[1:].tolist(), grams.size], strict=True))
            yield pa.RecordBatch.from_arrays([
                pa.array(bucket[at]), pa.array(np.full(at.size, block)),
                pa.array([_pack(grams[a:b]) for a, b in cut], pa.binary()),
                pa.array([_pack(counts[a:b].astype(np.uint32)) for a, b in cut], pa.binary()),
                pa.array([words] + [0] * (at.size - 1), pa.int64())],
                ["_bucket", "_block", "_grams", "_counts", "_words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = defaultdict(list), 0
        for batch in textvec.small_batches(batches, "_text"):
            blocks = batch.column("_block").to_numpy(zero_copy_only=False)
            turn = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
            for a, b in zip(turn, np.r_[turn[1:], blocks.size], strict=True):
                held[int(blocks[a])].append(batch.column("_text").slice(a, b - a))
            size += batch.column("_text").nbytes
            if size >= hold_bytes:
                done = dict(held) if len(held) > 4 else {
                    k: v for k, v in held.items() if k != int(blocks[-1])} or dict(held)
                yield from flush(done)
                for k in done:
                    del held[k]
                size = sum(p.nbytes for v in held.values() for p in v)
        yield from flush(held)
    return run


def _answers(table: pa.Table) -> pa.Table:
    """To each block: which of its n-grams in this bucket other blocks have as well
    (a bit for each, in their order), and their corpus counts. And one row (block
    null) with the words this bucket was told of."""
    by_block = defaultdict(list)
    for block, grams, counts in zip(table.column("_block").to_pylist(),
                                    table.column("_grams").to_pylist(),
                                    table.column("_counts").to_pylist(), strict=True):
        by_block[block].append((_unpack(grams, np.uint64), _unpack(counts, np.uint32)))
    own = {block: parts[0] if len(parts) == 1 else
           _summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
           for block, parts in by_block.items()}
    every, total = _summed(np.concatenate([g for g, _ in own.values()]),
                           np.concatenate([c for _, c in own.values()]).astype(np.int64))
    out: dict[str, list] = {"_block": [], "_bits": [], "_totals": []}
    for block, (grams, counts) in own.items():
        all_of = total[np.searchsorted(every, grams)]
        more = all_of > counts
        if more.any():
            out["_block"].append(block)
            out["_bits"].append(np.packbits(more).tobytes())
            out["_totals"].append(_pack(all_of[more]))
    words = sum(table.column("_words").to_pylist())
    n = len(out["_block"])
    return pa.table({"_block": pa.array([*out["_block"], None], pa.int64()),
                     "_from": pa.array([table.column("_bucket")[0].as_py()] * (n + 1), pa.int64()),
                     "_bits": pa.array([*out["_bits"], None], pa.binary()),
                     "_totals": pa.array([*out["_totals"], None], pa.binary()),
                     "_words": pa.array([0] * n + [words], pa.int64())})


def _score_rows(data: np.ndarray, offs: np.ndarray, order: int, grams: np.ndarray,
                totals: np.ndarray, words: int) -> tuple[np.ndarray, ...]:
    """Per row: words, log score, words scored at full order, unseen words."""
    n = offs.size - 1
    found = ngrams(data, offs, order)
    rows = found[0][1]
    n_words = np.bincount(rows, minlength=n)
    start = np.concatenate([[0], np.cumsum(n_words)])
    place = np.arange(rows.size) - start[rows]
    others = []  # by n: for the n-gram that ends at each word, its count in other documents
    for size, (gram, row) in enumerate(found, 1):
        different, inverse = np.unique(gram, return_inverse=True)
        at = np.searchsorted(grams, different)
        at[at == grams.size] = 0
        total = np.where(grams[at] == different, totals[at], 0) if grams.size else np.zeros(
            different.size, np.int64)
        pair = row * max(1, different.size) + inverse
        _, which, within = np.unique(pair, return_inverse=True, return_counts=True)
        count = np.zeros(rows.size, np.int64)
        count[place >= size - 1] = total[inverse] - within[which]
        others.append(count)
    rest = np.maximum(words - n_words, 1)[rows].astype(np.float64)
    score = np.where(others[0] > 0, others[0], BACKOFF) / rest
    for size in range(2, order + 1):
        context = np.r_[0, others[size - 2][:-1]]
        seen = (place >= size - 1) & (others[size - 1] > 0)
        longer = others[size - 1] / np.maximum(context, 1)
        score = np.where(seen, longer, np.where(place >= size - 1, BACKOFF, 1.0) * score)
    log_score = np.bincount(rows, np.log(score), minlength=n).astype(np.float64)
    full = np.bincount(rows, others[-1] > 0, minlength=n).astype(np.int64)
    unseen = np.bincount(rows, others[0] <= 0, minlength=n).astype(np.int64)
    return n_words, log_score, full, unseen


def _scorer(order: int, buckets: int, words: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        texts = [textvec.utf8(b.column("_text")) for b in textvec.small_batches(
            docs.to_batches(), "_text")]
        # the block's own counts, where no other block has the n-gram
        own, counts = _summed(np.concatenate(
            [g for t in texts for g, _ in ngrams(*t, order)] or [np.zeros(0, np.uint64)]))
        counts = counts.astype(np.int64)
        bucket = _bucket_of(own, buckets)
        for source, bits, totals in zip(answers.column("_from").to_pylist(),
                                        answers.column("_bits").to_pylist(),
                                        answers.column("_totals").to_pylist(), strict=True):
            lo, hi = np.searchsorted(bucket, [source, source + 1])
            more = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo).astype(bool)
            counts[lo:hi][more] = _unpack(totals, np.int64)
        scored = [_score_rows(*t, order, own, counts, words) for t in texts]
        columns = [np.concatenate(x) for x in zip(*scored, strict=True)] if scored else [
            np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        return pa.table([docs.column("_id"), *map(pa.array, columns)],
                        ["_id", "n_words", "log_score", "full_order", "unseen"])
    return run


def _block(id_col: str, text: str, bits: int) -> Column:
    """Ids that share all but their last bits are a block; null ids are spread by their text."""
    return F.coalesce(F.shiftright(F.col(id_col).cast("long"), bits),
                      F.lit(-(1 << 62)) + F.pmod(F.xxhash64(text), F.lit(1 << 10)))


def backoff_scores(docs: DataFrame, order: int = 2, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Stupid-backoff score of every row's whole text under all other rows' counts.

    Columns: id, n_words, log_score (sum of natural logs), mean_log_score,
    full_order (words whose longest n-gram was seen elsewhere), unseen (words
    that no other row has; such a word counts as 0.4 of an occurrence).

    Words are what white space separates, as written. The first words of a text
    have shorter contexts, without a backoff factor. Defined cases: a null text
    counts as empty; without words the sums are 0 and the mean is null; rows that
    repeat count as other rows; ids are integers, rows that repeat one share a
    block; null ids are kept. If a row has all the words of the table, N is 1.
    Other columns are ignored; no rows give no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    size = rows.agg(F.sum(F.octet_length("_text").cast("long")).alias("b"),
                    F.count(F.lit(1)).alias("n")).first()
    total, n = size["b"] or 0, max(1, size["n"])
    blocks = max(1, ceil(total / BLOCK_BYTES))
    bits = max(0, round(log2(max(1.0, n / blocks))))
    blocked = rows.withColumn("_block", _block("_id", "_text", bits))

    requests = blocked.select("_block", "_text").mapInArrow(
        _requests(order, blocks),
        "_bucket bigint, _block bigint, _grams binary, _counts binary, _words bigint")
    answered = requests.groupBy("_bucket").applyInArrow(
        _answers, "_block bigint, _from bigint, _bits binary, _totals binary, _words bigint")
    answers = write_scratch(answered, "ngram-answers")
    words = answers.where("_block IS NULL").agg(F.sum("_words")).first()[0] or 0
    told = answers.where("_block IS NOT NULL").select("_block", "_from", "_bits", "_totals")
    scored = (blocked.groupBy("_block").cogroup(told.groupBy("_block"))
              .applyInArrow(_scorer(order, blocks, words),
                            f"_id {id_type}, n_words bigint, log_score double, "
                            "full_order bigint, unseen bigint"))
    return scored.select(
        F.col("_id").alias(id_col), "n_words", "log_score",
        F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).alias("mean_log_score"),
        "full_order", "unseen")
