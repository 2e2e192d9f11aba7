"""Merkle manifest of a dataset: content-addressed DAG and membership proofs.

Every row is a leaf digest; the leaves of a group (a language) form a binary tree
and the groups' subroots form another, whose top is the manifest's root.

1. Leaves are sorted over all partitions; a leaf's rank in its group is its place
   less that of the group's first, so no group is ever one task.
2. Upward: runs of ``2 ** STEP`` consecutive digests (segments) are folded level
   by level, and each writes one record to the store: digest -> its children (the
   digests at the segment's foot) and its height. The store is content-addressed:
   equal segments are one record. The tops are the next round's digests.
3. Downward: a request names a digest and the path to it. It is joined to the
   store by that digest and asks for all children, each by the digits of its rank;
   at every digit the child that was not selected joins the path. Leaves that
   share their upper digits travel as one request, so there are as many requests
   as segments, not a root-to-leaf walk for each leaf. What a record says is folded
   again and must give the digest that was asked for.
4. At the last segment the leaves meet their request; the path, collected from the
   root down, is reversed into the proof, and the leaf is folded up through it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revline.llm.names import fresh
from revline.session import write_scratch

#: levels of a segment: 2 ** STEP digests at its foot
STEP = 8
#: leaves that a task takes at a time
CELL = 16_384
#: the tree of the groups' subroots
FOREST = -1


def digest_of(parts: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the values: ``-`` for null, else byte count, ``:`` and value."""
    said = [F.when(p.isNull(), "-").otherwise(
        F.concat(F.octet_length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")))
        for p in parts]
    return F.sha2(F.concat(*said), 256)


def _node(children: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


def fold(foot: list[bytes], height: int) -> list[list[bytes]]:
    """All levels of a segment, from its foot to its single top digest."""
    levels = [foot]
    for _ in range(height):
        foot = [_node(foot[k:k + 2]) for k in range(0, len(foot), 2)]
        levels.append(foot)
    if len(foot) != 1:
        raise ValueError(f"{len(foot)} digests at height {height}")
    return levels


def unselected(levels: list[list[bytes]], rank: int) -> list[tuple[int, bytes | None]]:
    """From the top down to the digest ``rank`` of the foot: the digit taken at each
    level and the child beside it (None where a run has one child)."""
    out = []
    for h in range(len(levels) - 2, -1, -1):
        at = rank >> h
        beside = at ^ 1
        out.append((at & 1, levels[h][beside] if beside < len(levels[h]) else None))
    return out


# A path is kept as bytes: for each level one byte (0 or 1: the digit, plus 2 where
# a sibling follows) and the sibling's 32.

def _pack(path: list[tuple[int, bytes | None]]) -> bytes:
    return b"".join(bytes([d]) if s is None else bytes([d + 2]) + s for d, s in path)


def _unpack(path: bytes) -> list[tuple[int, bytes | None]]:
    out, at = [], 0
    while at < len(path):
        d = path[at]
        out.append((d & 1, path[at + 1:at + 33] if d & 2 else None))
        at += 33 if d & 2 else 1
    return out


def prove(leaf: bytes, path: list[tuple[int, bytes | None]]) -> tuple[str, bytes]:
    """Of a path in order from leaf to root: hex SHA-256 of the siblings, and the
    digest that the leaf folds up to."""
    h = hashlib.sha256()
    for digit, sibling in path:
        if sibling is None:
            leaf = _node([leaf])
        else:
            h.update(sibling.hex().encode())
            leaf = _node([sibling, leaf] if digit else [leaf, sibling])
    return h.hexdigest(), leaf


def _ranked(df: DataFrame, keys: list[Column], rank: str) -> DataFrame:
    """``df`` with the place of each row in the order of ``keys``, from 0.

    A range-partitioned sort is written down; places are those in a partition plus
    the rows of all before it (one row a partition is counted and broadcast).
    """
    at, part = fresh(df, "at"), fresh(df, "part")
    rows = write_scratch(df.orderBy(*keys).withColumn(at, F.monotonically_increasing_id()), "sorted")
    rows = rows.withColumn(part, F.shiftright(at, 33))
    counts = rows.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(part, (F.sum("_n").over(Window.orderBy(part)) - F.col("_n")).alias("_before"))
    return (rows.join(F.broadcast(before), part)
            .withColumn(rank, F.col("_before") + F.col(at).bitwiseAND(F.lit((1 << 33) - 1)))
            .drop(at, part, "_before"))


def _fold_segments(step: int):
    def run(table: pa.Table) -> pa.Table:
        tree, rank, size = (table.column(c).to_numpy() for c in ("_tree", "_rank", "_size"))
        digests = table.column("_digest").to_pylist()
        order = np.lexsort((rank, tree))
        first = np.flatnonzero(np.r_[True, (np.diff(tree[order]) != 0) | (np.diff(rank[order] >> step) != 0)])
        rows = []
        for a, b in zip(first, np.r_[first[1:], order.size], strict=True):
            k = order[a]
            height = min(step, int(size[k] - 1).bit_length())
            foot = [digests[x] for x in order[a:b]]
            rows.append((tree[k], rank[k] >> step, -(-int(size[k]) >> step), fold(foot, height)[-1][0],
                         height, b"".join(foot)))
        names = ["_tree", "_rank", "_size", "_digest", "_height", "_foot"]
        types = [pa.int64()] * 3 + [pa.binary(), pa.int32(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
    return run


def _build(nodes: DataFrame, step: int, cell: int) -> tuple[DataFrame, list[DataFrame]]:
    """Tops (tree, digest) of all trees, and the records of each round.

    ``nodes``: _tree, _rank, _size (digests of the tree), _digest.
    """
    done, store = [], []
    while True:
        # a key that keeps segments whole and puts about ``cell`` rows together
        cells = F.lit(max(1, nodes.count() // cell))
        key = F.pmod(F.xxhash64("_tree", F.shiftright("_rank", step)), cells)
        made = write_scratch(
            nodes.withColumn("_cell", key).groupBy("_cell")
                 .applyInArrow(_fold_segments(step), "_tree bigint, _rank bigint, _size bigint, "
                                               "_digest binary, _height int, _foot binary"), "segments")
        store.append(made)
        done.append(made.where("_size <= 1").select("_tree", "_digest"))
        nodes = made.where("_size > 1").select("_tree", "_rank", "_size", "_digest")
        if nodes.isEmpty():
            break
    tops = done[0]
    for d in done[1:]:
        tops = tops.unionByName(d)
    return tops, store


def records(store: list[DataFrame]) -> DataFrame:
    """The content-addressed store: one (digest, height, foot) for each different segment."""
    rows = store[0]
    for s in store[1:]:
        rows = rows.unionByName(s)
    return rows.select("_digest", "_height", "_foot").dropDuplicates(["_digest", "_height"])


def _children(record_digest: bytes, foot: bytes, height: int) -> list[list[bytes]]:
    levels = fold([foot[k:k + 32] for k in range(0, len(foot), 32)], height)
    if levels[-1][0] != record_digest:
        raise ValueError("the store holds a record under another digest")
    return levels


def _rows(batches: Iterator[pa.RecordBatch], at_a_time: int = 64) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, at_a_time):
            yield from batch.slice(at, at_a_time).to_pylist()


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Requests (tree, rank, digest, path) and their records give the children's requests."""
    for row in _rows(batches):
        levels = _children(row["_digest"], row["_foot"], row["_height"])
        base = row["_rank"] << row["_height"]
        out = [(row["_tree"], base + k, d, row["_path"] + _pack(unselected(levels, k)))
               for k, d in enumerate(levels[0])]
        tree, rank, found, path = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(tree, pa.int64()), pa.array(rank, pa.int64()),
             pa.array(found, pa.binary()), pa.array(path, pa.binary())],
            ["_tree", "_rank", "_digest", "_path"])


_REQUEST = "_tree bigint, _rank bigint, _digest binary, _path binary"


def _asked(requests: DataFrame, heights: DataFrame, store: DataFrame, level: int) -> DataFrame:
    """Requests for records of a round with the records, by digest and height."""
    return (requests.join(heights.where(F.col("_level") == level).drop("_level"), "_tree")
            .join(store, ["_digest", "_height"]))


def _heights(trees: DataFrame, step: int) -> DataFrame:
    """(tree, level, height): what segments a tree has in each round.

    ``trees``: _tree, _size. All but the last round's have the full height; the last
    has what is left. A tree of one digest has one segment, of height 0.
    """
    bits = F.length(F.conv(F.col("_size") - 1, 10, 2))
    total = F.when(F.col("_size") <= 1, 0).otherwise(bits)
    rounds = F.greatest(F.lit(1), F.ceil(total / step)).cast("int")
    return (trees.withColumn("_total", total).withColumn("_rounds", rounds)
            .select("_tree", "_total", F.explode(F.sequence(F.lit(0), F.col("_rounds") - 1)).alias("_level"),
                    "_rounds")
            .select("_tree", "_level", F.when(F.col("_level") < F.col("_rounds") - 1, step)
                    .otherwise(F.col("_total") - F.lit(step) * (F.col("_rounds") - 1))
                    .cast("int").alias("_height")))


def _walk(requests: DataFrame, heights: DataFrame, store: DataFrame, rounds: int) -> DataFrame:
    """From requests for the tops of trees to requests for the last segments, the
    ones whose feet are the leaves."""
    for level in range(rounds - 1, 0, -1):
        here = heights.where(F.col("_level") == level).select("_tree")
        waiting = requests.join(here, "_tree", "left_anti")
        asked = _asked(requests, heights, store, level).select(
            *[c.split()[0] for c in _REQUEST.split(", ")], "_height", "_foot")
        requests = write_scratch(waiting.unionByName(asked.mapInArrow(_descend, _REQUEST)), "requests")
    return requests


def _leaf_proofs(step: int):
    """Proofs and folded roots of the leaves of a cell, from the requests that reach them."""
    def run(leaves: pa.Table, asked: pa.Table) -> pa.Table:
        known = {}
        for row in asked.to_pylist():
            levels = _children(row["_digest"], row["_foot"], row["_height"])
            known[row["_tree"], row["_rank"]] = levels, _unpack(row["_path"]), row["_top"].hex()
        columns = [leaves.column(c).to_pylist() for c in ("_tree", "_rank", "_digest", "_changed")]
        rows = []
        for tree, rank, leaf, changed in zip(*columns, strict=True):
            levels, above, top = known[tree, rank >> step]
            k = rank & ((1 << step) - 1)
            if levels[0][k] != leaf:
                raise ValueError("the digits of a rank lead to another leaf")
            path = (above + unselected(levels, k))[::-1]
            proof, root = prove(leaf if changed is None else changed, path)
            rows.append((leaf.hex(), top, proof, root.hex()))
        names = ["leaf", "subroot", "proof_sha256", "folded_root"]
        found = [pa.array(c, pa.string()) for c in (zip(*rows, strict=True) if rows else ([],) * 4)]
        return pa.table([leaves.column("_id"), *found], ["_id", *names])
    return run


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang",
             columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             tampered: Column | None = None, counter: str = "n_chars",
             step: int = STEP, cell: int = CELL) -> DataFrame:
    """Leaf, subroot, root and proof of every row, and what its leaf folds up to.

    A leaf is ``digest_of`` the ``columns``. Where the condition ``tampered`` holds,
    the leaf that is folded is that of the row with 1 added to ``counter``; proofs
    are always those of the untampered tree. Columns: id, leaf, subroot, root,
    proof_sha256, folded_root, verified (folded_root is root). ``step``: levels of a
    segment; ``cell``: leaves that a task takes at a time.

    Defined cases: a null column is ``-``, an empty text ``0:``; null ids come first
    in their group, and rows that repeat an id are ordered by leaf (equal rows are
    equal leaves, each with a place of its own); rows without a group are the first
    group; a tampered row whose counter is null does not change; texts are hashed
    whole whatever their length. Other columns are ignored; no rows give no rows.
    """
    parts = [F.col(c) for c in columns]
    hit = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    more = [F.col(c) + 1 if c == counter else F.col(c) for c in columns]
    leaves = docs.select(
        F.col(id_col).alias("_id"), F.col(group_col).alias("_group"),
        F.unhex(digest_of(parts)).alias("_digest"),
        F.when(hit, F.unhex(digest_of(more))).alias("_changed"))
    leaves = write_scratch(leaves, "digests")  # a sort samples its input first: no text twice
    # rows alike in all keys are equal leaves: any order of them is the same result
    placed = _ranked(leaves, [F.col("_group").asc_nulls_first(), F.col("_id").asc_nulls_first(),
                              F.col("_digest"), F.monotonically_increasing_id()], "_place")
    groups = placed.groupBy("_group").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_size"))
    trees = write_scratch(_ranked(groups, [F.col("_group").asc_nulls_first()], "_tree"), "trees")
    known = trees.withColumnRenamed("_group", "_group2")
    placed = write_scratch(
        placed.join(known, F.col("_group").eqNullSafe(F.col("_group2")))
              .select("_id", "_tree", (F.col("_place") - F.col("_first")).alias("_rank"), "_size",
                      "_digest", "_changed"), "leaves")

    subroots, store = _build(placed.select("_tree", "_rank", "_size", "_digest"), step, cell)
    n_trees = trees.count()
    top, forest = _build(subroots.select(F.lit(FOREST).cast("long").alias("_tree"), F.col("_tree").alias("_rank"),
                                         F.lit(n_trees).cast("long").alias("_size"), "_digest"), step, cell)
    saved = write_scratch(records(store + forest), "store")

    # down the forest to the subroots, then down each tree
    over = _heights(trees.select(F.lit(FOREST).cast("long").alias("_tree"),
                                 F.lit(n_trees).cast("long").alias("_size")).limit(1), step)
    start = top.select("_tree", F.lit(0).cast("long").alias("_rank"), "_digest", F.lit(b"").alias("_path"))
    last = _walk(start, over, saved, len(forest))
    cols = [c.split()[0] for c in _REQUEST.split(", ")]
    to_subroots = _asked(last, over, saved, 0).select(*cols, "_height", "_foot").mapInArrow(_descend, _REQUEST)
    within = _heights(trees.select("_tree", "_size"), step)
    asked = to_subroots.select(F.col("_rank").alias("_tree"), F.lit(0).cast("long").alias("_rank"),
                               "_digest", "_path")
    asked = write_scratch(asked, "requests")
    tops = asked.select("_tree", F.col("_digest").alias("_top"))
    last = _asked(_walk(asked, within, saved, len(store)), within, saved, 0).join(tops, "_tree")

    cells = F.lit(max(1, placed.count() // cell))
    left = placed.select("_id", "_tree", "_rank", "_digest", "_changed",
                         F.pmod(F.xxhash64("_tree", F.shiftright("_rank", step)), cells).alias("_cell"))
    right = last.select(*cols, "_height", "_foot", "_top",
                        F.pmod(F.xxhash64("_tree", "_rank"), cells).alias("_cell"))
    id_type = docs.schema[id_col].dataType.simpleString()
    proofs = left.groupBy("_cell").cogroup(right.groupBy("_cell")).applyInArrow(
        _leaf_proofs(step), f"_id {id_type}, leaf string, subroot string, proof_sha256 string, folded_root string")
    root = top.select(F.lower(F.hex("_digest"))).first()  # one digest, or none for no rows
    return (proofs.withColumn("root", F.lit(root[0] if root else None).cast("string"))
            .select(F.col("_id").alias(id_col), "leaf", "subroot", "root", "proof_sha256", "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified")))


def tamper_test(docs: DataFrame, step: int = STEP, cell: int = CELL) -> DataFrame:
    """The manifest of ``documents``; every seventh row by the checksum of its id is tampered with."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return manifest(docs, tampered=hit, step=step, cell=cell)
