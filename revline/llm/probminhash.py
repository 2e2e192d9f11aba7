"""Near-duplicate documents by ProbMinHash.

1. Every text becomes a set of five-word shingles, all of one weight, as links
   compare sets. Each shingle is a Poisson process of rate its weight whose
   arrivals fall into registers; a register keeps its earliest arrival's
   shingle, and a shingle stops as soon as its next arrival is later than the
   latest register's (ProbMinHash; equal registers estimate the probability
   Jaccard similarity, with equal weights that of the sets).
2. Texts with the same words are one node. Nodes that share a band of registers
   meet in a bucket and are compared by their registers with its first node: the
   similar ones are joined to it. Joined nodes form a family of candidates. Where a
   bucket holds several families, all but the very similar nodes are grouped anew
   around a node of the smallest, until its nodes are of one family or none is left.
3. In a family all similarities (Jaccard of the shingle sets) are verified
   exactly, by counting common shingles through an inverted index. A large
   family is dealt to a grid of blocks, so no task holds more than two blocks
   and only a spanning forest and link counts leave a block, never the pairs.
4. Linked nodes form classes; the members of a node follow it.

Shapes of the pair space are decided by the data (family sizes), nothing is
capped, and no step brings links, nodes or classes to the driver.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revline.llm import textvec
from revline.llm.components import components, shuffled_anew
from revline.llm.names import fresh
from revline.session import write_scratch

SHINGLE = 5
BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
SIMILAR = 0.8
#: a bucket's nodes are not joined where the registers agree less than at this similarity
FAMILY_LEAST = 0.3
#: short registers that differ at most on an edge
FAR = round(REGISTERS * (1 - FAMILY_LEAST) * 15 / 16)
#: a pair at ``SIMILAR`` differs in more short registers than this with probability
#: below 1e-7. Differences obey the triangle inequality, so where one of the pair is
#: beyond FAR from a node, the other is beyond FAR - APART and stays in the bucket too.
APART = 60
#: nodes of one block of the verification grid
BLOCK = 400

#: scripts written without spaces (Thai, Lao, Burmese, Khmer and neighbours, kana and
#: bopomofo, Han): every letter, mark or digit of them is a word
_UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF),
             (0x1A20, 0x1AAF), (0x3005, 0x3007), (0x3021, 0x31BF), (0x31F0, 0x31FF),
             (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA9E0, 0xA9FF), (0xAA60, 0xAA7F),
             (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF)]
_BETWEEN, _PART, _ALONE = 0, 1, 2


@cache
def _kinds() -> np.ndarray:
    """Of every code point: between words, part of a word (letter, mark, digit), or a word alone."""
    kind = np.array([unicodedata.category(chr(c))[0] in "LMN" for c in range(0x110000)], np.uint8)
    for first, last in _UNSPACED:
        kind[first:last + 1] *= _ALONE
    return kind


def normal_words(data: np.ndarray, offs: np.ndarray):
    """Hash and row of every word, lower-cased."""
    if data.size and data.max() > 127:
        low = [data[a:b].tobytes().decode("utf-8", "replace").lower()
               for a, b in zip(offs[:-1], offs[1:], strict=True)]
        points = np.frombuffer("".join(low).encode("utf-32-le"), np.uint32)
        offs = np.r_[0, np.cumsum([len(t) for t in low], dtype=np.int64)]
    else:
        points = textvec.LOWER[data]
    if not points.size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    kind = _kinds()[points]
    cut = np.ones(points.size + 1, bool)
    cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _ALONE)
    cut[offs] = True
    starts = np.flatnonzero((kind > _BETWEEN) & cut[:-1])
    ends = np.flatnonzero((kind > _BETWEEN) & cut[1:]) + 1
    return (textvec.span_hashes(points, starts, ends),
            np.searchsorted(offs, starts, side="right") - 1)


def shingles(hashes: np.ndarray, rows: np.ndarray, n: int, size: int = SHINGLE):
    """Different shingles with their row and count, ordered by row and shingle.

    A text with fewer words has one shingle, of all its words.
    """
    shingle, row = textvec.window_hashes(hashes, rows, size)
    n_words = np.bincount(rows, minlength=n)
    few = np.flatnonzero((n_words > 0) & (n_words < size))
    if few.size:
        whole, _ = text_keys(hashes, rows, n)
        shingle, row = np.r_[shingle, whole[few]], np.r_[row, few]
    order = np.lexsort((shingle, row))
    shingle, row = shingle[order], row[order]
    if not shingle.size:
        return shingle, row, np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, (shingle[1:] != shingle[:-1]) | (row[1:] != row[:-1])])
    return shingle[first], row[first], np.diff(np.r_[first, shingle.size])


def text_keys(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each row's sequence of words; 0 for a row without words."""
    at = np.searchsorted(rows, np.arange(n + 1))
    place = (np.arange(rows.size) - at[rows]).astype(np.uint64)
    keys = []
    for salt in (0x51ED270B, 0xC2B2AE3D27D4EB4F):
        mixed = textvec.mix64(hashes + textvec.mix64(place * np.uint64(salt) + np.uint64(salt)))
        total = np.r_[np.uint64(0), np.cumsum(mixed, dtype=np.uint64)]
        keys.append(total[at[1:]] - total[at[:-1]])
    return keys[0], keys[1]


def prob_minhash(shingle: np.ndarray, weight: np.ndarray, row: np.ndarray, n: int,
                 m: int = REGISTERS) -> np.ndarray:
    """Registers (n x m, the winning shingles; 0 for rows without any).

    All shingles advance together, one arrival at a time; those whose arrival is
    later than every register of their row have ended.
    """
    times, winner = np.full(n * m, np.inf), np.zeros(n * m, np.uint64)
    x = np.zeros(shingle.size)
    step = 0
    while shingle.size:
        step += 1
        h = textvec.mix64(shingle ^ np.uint64((step * 0xD1342543DE82EF95) % (1 << 64)))
        x = x - np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / weight
        k = ((textvec.mix64(h) >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        slot = row * m + k.astype(np.int64)
        early = x < times[slot]
        np.minimum.at(times, slot[early], x[early])
        won = early & (x == times[slot])
        winner[slot[won]] = shingle[won]
        latest = times.reshape(n, m).max(1)
        on = x < latest[row]
        shingle, weight, row, x = shingle[on], weight[on], row[on], x[on]
    return winner.reshape(n, m)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One key for each band, different from band to band."""
    parts = registers.reshape(len(registers), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(ROWS):
        key = textvec.mix64(key * np.uint64(0x9E3779B97F4A7C15) ^ parts[:, :, r])
    return key.view(np.int64)


def short_signature(registers: np.ndarray) -> np.ndarray:
    """Four bits of each register, 16 to a number."""
    nibbles = textvec.mix64(registers) & np.uint64(15)
    nibbles = nibbles.reshape(len(registers), -1, 16)
    return (nibbles << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(
        2, dtype=np.uint64).view(np.int64)


def different_registers(a: Column, b: Column) -> Column:
    """How many of the four-bit registers differ."""
    total = F.lit(0)
    for i in range(REGISTERS // 16):
        x = a[i].bitwiseXOR(b[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        total = total + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return total


def _lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()),
                                    pa.array(values.reshape(-1)))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # short texts take many arrivals until all registers have one: larger batches
    for batch in textvec.small_batches(batches, "_text", 4 * textvec.MAX_BYTES):
        n = batch.num_rows
        data, offs = textvec.utf8(batch.column("_text"))
        hashes, rows = normal_words(data, offs)
        hi, lo = text_keys(hashes, rows, n)
        # texts without words: the same only if every byte is
        bare = np.flatnonzero(np.bincount(rows, minlength=n) == 0)
        hi[bare] = textvec.span_hashes(data, offs[:-1][bare], offs[1:][bare])
        lo[bare] = 1
        shingle, row, _ = shingles(hashes, rows, n)
        # weighted by counts, a pair would be sought by another similarity than links have
        registers = prob_minhash(shingle, np.ones(shingle.size), row, n)
        bands = _lists(band_keys(registers)).to_pylist() if bare.size else None
        lists = _lists(band_keys(registers))
        if bare.size:
            for i in bare:
                bands[i] = []
            lists = pa.array(bands, pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("_t"), pa.array(hi.view(np.int64)),
             pa.array(lo.view(np.int64)), lists, _lists(short_signature(registers))],
            ["_id", "_t", "_hi", "_lo", "_bands", "_sig"])


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()  # rows that repeat an id and its text: one from each task
    for batch in textvec.small_batches(batches, "_text"):
        n = batch.num_rows
        hashes, rows = normal_words(*textvec.utf8(batch.column("_text")))
        shingle, row, _ = shingles(hashes, rows, n)
        at = np.searchsorted(row, np.arange(n + 1))
        new = []
        for i, node in enumerate(batch.column("_node").to_pylist()):
            if node not in seen:
                seen.add(node)
                new.append(i)
        if not new:
            continue
        out = batch.select(["_node", "_family", "_size"]).take(pa.array(new, pa.int64()))
        sets = pa.array([shingle[at[i]:at[i + 1]].view(np.int64) for i in new], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*out.columns, sets], [*out.schema.names, "_set"])


def _verify(similar: float):
    """Links among the nodes of a cell that are of one family (and, off the diagonal, of two blocks)."""
    def run(table: pa.Table) -> pa.Table:
        _, once = np.unique(table.column("_node").to_numpy(), return_index=True)
        table = table.take(pa.array(np.sort(once))).combine_chunks()
        node = table.column("_node").to_numpy()
        family = table.column("_family").to_numpy().astype(np.uint64)
        block = table.column("_block").to_numpy()
        sets = table.column("_set").combine_chunks()
        size = np.diff(sets.offsets.to_numpy())
        owner = np.repeat(np.arange(node.size), size)
        keys = sets.flatten().to_numpy().view(np.uint64) ^ textvec.mix64(family)[owner]
        order = np.argsort(keys, kind="stable")
        keys, owner = keys[order], owner[order]
        start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if keys.size else order
        group = np.repeat(np.arange(start.size), np.diff(np.r_[start, keys.size]))
        end = np.r_[start[1:], keys.size]
        by_owner = np.argsort(owner, kind="stable")
        at = np.searchsorted(owner[by_owner], np.arange(node.size + 1))
        shared = group[by_owner]
        two_blocks = bool(table.num_rows) and (
            table.column("_i")[0].as_py() != table.column("_j")[0].as_py())

        root = np.arange(node.size)

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        links = np.zeros(node.size, np.int64)
        for a in range(node.size):
            g = shared[at[a]:at[a + 1]]
            g = g[end[g] - start[g] > 1]
            if not g.size:
                continue
            n = end[g] - start[g]
            where = np.repeat(start[g] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            common = np.bincount(owner[where], minlength=node.size)
            common[:a + 1] = 0
            b = np.flatnonzero(common)
            if two_blocks:
                b = b[block[b] != block[a]]
            b = b[family[b] == family[a]]
            c = common[b]
            b = b[c >= similar * (size[a] + size[b] - c) - 1e-9]
            links[a] += b.size
            links[b] += 1
            for k in b:
                x, y = find(a), find(int(k))
                root[max(x, y)] = min(x, y)
        found = np.flatnonzero(links)
        roots = np.array([find(int(k)) for k in found], np.int64)
        return pa.table({"_node": node[found], "_to": node[roots], "_links": links[found]})
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    similar: float = SIMILAR) -> DataFrame:
    """The class of near duplicates of every row.

    Words are runs of letters and digits, lower-cased; two texts are linked where
    the sets of their five-word shingles have a Jaccard similarity of ``similar``
    or more, and classes are what links connect. Columns: id, class_id (smallest
    id of the class), class_size (rows), links (texts with other words it is
    linked to), kept (its id is class_id).

    A word is a run of Unicode letters, their marks and digits; in scripts that are
    written without spaces each of them is a word.

    Defined cases: a null text counts as empty; a text of one to four words has
    one shingle, of all its words; texts without words are alike only where they
    are equal; rows with the same words are always one class; a null id is never
    kept unless its class has no other, and a class of null ids has class_id null.
    Other columns are ignored; no rows give no rows.
    """
    rows, known = _classified(docs, id_col, text_col, similar)
    return (rows.select("_id", "_hi", "_lo").join(known, ["_hi", "_lo"])
            .select(F.col("_id").alias(id_col), "class_id", "class_size", "links",
                    F.col("_id").eqNullSafe(F.col("class_id")).alias("kept")))


def _classified(docs: DataFrame, id_col: str, text_col: str, similar: float) -> tuple[DataFrame, DataFrame]:
    """Rows (_id, _t: hash of the text, _hi, _lo: keys of its words), and by these keys
    class_id, class_size, links and _kept: the (_id, _t) that stands for the class."""
    id_type = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    base = base.withColumn("_t", F.xxhash64("_text"))
    sketches = write_scratch(base.mapInArrow(
        _sketch, f"_id {id_type}, _t bigint, _hi bigint, _lo bigint, _bands array<bigint>, "
                 "_sig array<bigint>"), "sketches")
    nodes = write_scratch(
        sketches.groupBy("_hi", "_lo").agg(
            F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_rows"),
            F.min(F.struct("_id", "_t")).alias("_rep"),
            F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_t")).alias("_first"), F.first("_bands").alias("_bands"),
            F.first("_sig").alias("_sig"))
        .withColumn("_node", F.monotonically_increasing_id()), "nodes")

    families = _families(nodes)
    found = _links(base, nodes, families, similar)
    linked = found.groupBy("_node").agg(F.sum("_links").alias("_links"))
    comps = components(found, "_node", "_to")
    classes = (nodes.select("_hi", "_lo", "_node", "_least", "_rows", "_first")
               .join(comps.withColumnRenamed("node", "_node"), "_node", "left")
               .join(linked, "_node", "left")
               .withColumn("_class", F.coalesce("component", "_node")))
    sizes = shuffled_anew(classes.groupBy("_class").agg(
        F.min("_least").alias("class_id"), F.sum("_rows").alias("class_size"),
        F.min("_first").alias("_kept")), "_class")
    known = classes.join(sizes, "_class").select(
        "_hi", "_lo", "class_id", "class_size", F.coalesce("_links", F.lit(0)).alias("links"),
        "_kept", "_class")
    return sketches.select("_id", "_t", "_hi", "_lo"), known


def _families(nodes: DataFrame) -> DataFrame:
    """(node, component) of the nodes that buckets connect.

    After the first round a bucket is grouped anew only while it holds nodes of two
    families or more, and only nodes of another family than its centre's are compared
    with that: a bucket whose nodes are all joined is done, however large it is.
    """
    sig = nodes.select("_node", "_sig")
    entries = nodes.select("_node", F.explode("_bands").alias("_bucket"))
    first = (entries.groupBy("_bucket").agg(F.min("_node").alias("_centre"), F.count(F.lit(1)).alias("_n"))
             .where("_n > 1").select("_bucket", "_centre"))
    met = entries.join(first, "_bucket").where("_node <> _centre")
    pairs = _compared(met, sig)
    stars = write_scratch(components(pairs.where(F.col("_differ") <= FAR), "_node", "_centre"), "stars")
    family = stars.select(F.col("node").alias("_node"), F.col("component").alias("_family"))
    entries = write_scratch(
        _left_over(met, pairs).join(family, "_node", "left")
        .select("_node", "_bucket", F.coalesce("_family", "_node").alias("_family")), "entries")
    edges, before = [stars.select(F.col("node").alias("_a"), F.col("component").alias("_b"))], None
    while True:
        centres = _centres(entries)
        entries = write_scratch(entries.join(shuffled_anew(centres, "_bucket"), "_bucket")
                                .where("_node <> _centre"), "entries")
        left = entries.count()
        if not left:
            break
        if before is not None and 2 * left > before:
            # many families in a bucket: rounds would be as many
            edges.append(_compare_in_cells(entries, sig, left))
            break
        before = left
        met = entries.where("_family <> _to_family")
        pairs = _compared(met, sig)
        joined = write_scratch(
            met.join(pairs.where(F.col("_differ") <= FAR).select("_node", "_centre"), ["_node", "_centre"],
                     "left_semi").select(F.col("_family").alias("_a"), F.col("_to_family").alias("_b"))
            .distinct(), "joined")
        edges.append(joined)
        merged = components(joined, "_a", "_b").select(
            F.col("node").alias("_family"), F.col("component").alias("_merged"))
        rest = (_left_over(met, pairs).select("_node", "_bucket", "_family")
                .unionByName(entries.where("_family = _to_family").select("_node", "_bucket", "_family")))
        entries = write_scratch(
            rest.join(merged, "_family", "left")
                .select("_node", "_bucket", F.coalesce("_merged", "_family").alias("_family")), "entries")
    return components(reduce(DataFrame.unionByName, edges), "_a", "_b")


def _compared(met: DataFrame, sig: DataFrame) -> DataFrame:
    """(node, centre) that met in any bucket, once, and in how many registers they differ."""
    return write_scratch(
        met.select("_node", "_centre").distinct().join(sig, "_node")
           .join(sig.select(F.col("_node").alias("_centre"), F.col("_sig").alias("_sig2")), "_centre")
           .select("_node", "_centre",
                   different_registers(F.col("_sig"), F.col("_sig2")).alias("_differ")), "pairs")


def _left_over(met: DataFrame, pairs: DataFrame) -> DataFrame:
    """Entries that are not so like their centre that all alike them are joined to it too."""
    again = pairs.where(F.col("_differ") > FAR - APART).select("_node", "_centre")
    return met.join(again, ["_node", "_centre"], "left_semi")


def _centres(entries: DataFrame) -> DataFrame:
    """Of each bucket with two families or more: the first node of the one with the fewest."""
    return (entries.groupBy("_bucket", "_family").agg(F.count(F.lit(1)).alias("_n"), F.min("_node").alias("_node"))
            .groupBy("_bucket").agg(F.count(F.lit(1)).alias("_families"),
                                    F.min(F.struct("_n", "_node", "_family")).alias("_least"))
            .where("_families > 1")
            .select("_bucket", F.col("_least._node").alias("_centre"),
                    F.col("_least._family").alias("_to_family")))


def _compare_in_cells(entries: DataFrame, sig: DataFrame, n: int) -> DataFrame:
    """Edges between families of what rounds of stars would find, in cells of two blocks at most."""
    # centres have been taken out by now, but not compared: they come back
    centres = entries.select(F.col("_centre").alias("_node"), "_bucket",
                             F.col("_to_family").alias("_family")).distinct()
    entries = entries.select("_node", "_bucket", "_family").unionByName(centres)
    sizes = shuffled_anew(entries.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
                          .where("_n > 1"), "_bucket")
    blocks = F.ceil(F.col("_n") / BLOCK).cast("int")
    cells = (entries.join(sizes, "_bucket").join(sig, "_node")
             .withColumn("_block", F.pmod(F.xxhash64("_node"), blocks).cast("int"))
             .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("_node", "_bucket", "_family", "_sig",
                     F.when(F.col("_n") <= BLOCK, F.pmod(F.xxhash64("_bucket"), F.lit(max(1, n // BLOCK))))
                     .otherwise(F.col("_bucket")).alias("_key"), (F.col("_n") > BLOCK).alias("_grid"),
                     F.least("_block", "_other").alias("_i"),
                     F.greatest("_block", "_other").alias("_j")))
    return write_scratch(
        cells.groupBy("_grid", "_key", "_i", "_j")
             .applyInArrow(_join_in_cell, "_a bigint, _b bigint").distinct(), "cell-edges")


def _join_in_cell(table: pa.Table) -> pa.Table:
    """A spanning forest, between families, of the nodes of a cell that a bucket's stars would join."""
    table = table.combine_chunks()
    node, bucket = table.column("_node").to_numpy(), table.column("_bucket").to_numpy()
    names, family = np.unique(table.column("_family").to_numpy(), return_inverse=True)
    sig = table.column("_sig").combine_chunks().flatten().to_numpy().view(np.uint64)
    sig = sig.reshape(node.size, -1)
    edges = []
    order = np.lexsort((node, bucket))
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for left in np.split(order, cuts):
        while left.size > 1:
            of, count = np.unique(family[left], return_counts=True)
            if of.size < 2:
                break
            own = of[np.argmin(count)]
            inside = family[left] == own
            centre, others = left[inside][0], left[~inside]
            x = sig[others] ^ sig[centre]
            x |= x >> np.uint64(1)
            x |= x >> np.uint64(2)
            differ = np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(1, dtype=np.int64)
            joined = np.unique(family[others[differ <= FAR]])
            edges += [(int(names[f]), int(names[own])) for f in joined]
            family[np.isin(family, joined)] = own
            left = np.r_[left[inside][1:], others[differ > FAR - APART]]
    found = np.array(edges, np.int64).reshape(-1, 2)
    return pa.table({"_a": found[:, 0], "_b": found[:, 1]})


def _links(base: DataFrame, nodes: DataFrame, families: DataFrame, similar: float) -> DataFrame:
    """(node, to, links): a spanning forest of the links of each cell, and link counts."""
    families = write_scratch(families.select(F.col("node").alias("_node"),
                                             F.col("component").alias("_family")), "families")
    sizes = shuffled_anew(
        families.groupBy("_family").agg(F.count(F.lit(1)).alias("_size")), "_family")
    wanted = (families.join(sizes, "_family")
              .join(nodes.select("_node", F.col("_rep._id").alias("_id2"),
                                 F.col("_rep._t").alias("_t2")), "_node"))
    rows = (base.join(wanted, (F.col("_t") == F.col("_t2")) & F.col("_id").eqNullSafe(F.col("_id2")))
            .select("_node", "_family", "_size", "_text")
            .mapInArrow(_shingle_rows, "_node bigint, _family bigint, _size bigint, _set array<bigint>"))
    # families of one block share cells; a larger one has a grid of its own
    small = max(1, families.count() // BLOCK)
    blocks = F.ceil(F.col("_size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("_node"), blocks).cast("int")
    others = F.sequence(F.lit(0), blocks - 1)
    cells = (rows.withColumn("_block", block).withColumn("_other", F.explode(others))
             .select("_node", "_family", "_set", "_block",
                     F.when(F.col("_size") <= BLOCK, F.pmod(F.xxhash64("_family"), F.lit(small)))
                     .otherwise(F.col("_family")).alias("_key"),
                     (F.col("_size") > BLOCK).alias("_grid"),
                     F.least("_block", "_other").alias("_i"),
                     F.greatest("_block", "_other").alias("_j")))
    return write_scratch(
        cells.groupBy("_grid", "_key", "_i", "_j")
             .applyInArrow(_verify(similar), "_node bigint, _to bigint, _links bigint"), "links")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     similar: float = SIMILAR) -> DataFrame:
    """The rows, all columns, that are kept: one (id, text) of every class, the one with
    its smallest id (a null id only where it has no other), of these the smallest text hash.

    Rows that repeat the kept id and text all stay: they are exact copies.
    """
    _, known = _classified(docs, id_col, text_col, similar)
    name, text = fresh(docs, "keep"), fresh(docs, "keep_text")
    keep = known.select("_class", "_kept").distinct().select(
        F.col("_kept._id").alias(name), F.col("_kept._t").alias(text))
    return docs.join(keep, docs[id_col].eqNullSafe(keep[name])
                     & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == keep[text]), "left_semi")
