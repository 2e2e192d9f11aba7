"""Sharding by extendible hashing.

A row's shard is a prefix of its key's hash bits. A directory over the first
bits knows the bytes of every prefix; a bucket is split on another bit only
where it holds more than the limit, so shards have different depths. Rows enter
as (key hash, bytes) only, and the directory is a table, never a driver object:
its entries are a fixed multiple of the number of shards.

Keys that no bit separates (one key holding more than the limit) are split on
the hash of a row number once the key's bits are used up.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revline.llm.names import fresh
from revline.session import write_scratch

#: hash bits of the key, then as many of the row number
HASH_BITS = 60
#: directory bits beyond those that an even spread would need
SPARE_BITS = 6


def hash_bits(value: Column) -> Column:
    """The first 60 bits of the MD5 of the value as text."""
    return F.conv(F.substring(F.md5(value.cast("string")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _bits(node: Column, depth: Column) -> Column:
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin(node), depth, F.lit("0")))


def _directory(cells: DataFrame, depth: int, limit: int, root: bool) -> tuple[DataFrame, DataFrame]:
    """Leaves of the split tree as (prefix, cell -> shard, ...), and cells still too large.

    ``cells``: (_prefix, _cell, _bytes, _rows) at ``depth`` bits. Every cell adds
    its bytes to all its ancestors; a leaf is a bucket that fits under one that
    does not.
    """
    up = cells.select("_prefix", "_bytes", "_rows", F.explode(F.array(*(
        F.struct(F.lit(d).alias("_d"), F.shiftright("_cell", depth - d).alias("_node"))
        for d in range(0 if root else 1, depth + 1)))).alias("_a"))
    nodes = write_scratch(
        up.groupBy("_prefix", "_a._d", "_a._node")
          .agg(F.sum("_bytes").alias("_bytes"), F.sum("_rows").alias("_rows")), "shard-nodes")
    fits = nodes.where(F.col("_bytes") <= limit)
    split = nodes.where(F.col("_bytes") > limit)
    above = split.select("_prefix", (F.col("_d") + 1).alias("_d"), F.col("_node").alias("_up"))
    below = fits.withColumn("_up", F.shiftright("_node", 1))
    leaves = below.join(above, ["_prefix", "_d", "_up"], "left_semi")
    top = fits.where(F.col("_d") == (0 if root else 1))
    # below an earlier prefix the first bit always splits a bucket that is too large
    leaves = leaves.unionByName(top.withColumn("_up", F.lit(0).cast("long")).select(leaves.columns))
    span = F.lit(depth) - F.col("_d")
    first = F.expr("shiftleft(_node, cast(_span as int))")
    last = F.expr("shiftleft(_node + 1, cast(_span as int)) - 1")
    entries = (leaves.withColumn("_span", span).select(
        "_prefix", F.explode(F.sequence(first, last)).alias("_cell"),
        F.concat("_prefix", _bits(F.col("_node"), F.col("_d"))).alias("shard"),
        F.col("_bytes").alias("shard_bytes"), F.col("_rows").alias("shard_rows")))
    large = split.where(F.col("_d") == depth).select("_prefix", F.col("_node").alias("_cell"))
    return entries, large


def extendible_shards(rows: DataFrame, limit_bytes: int, key_col: str = "doc_id",
                      text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The shard of every row, by extendible hashing of its key.

    Columns: key, bytes (of the text in UTF-8), shard (its hash prefix as a
    string of 0 and 1), depth (bits of that prefix), shard_bytes, shard_rows, and
    the columns ``keep`` of the row.
    Every shard's texts take at most ``limit_bytes`` together, unless one row
    alone takes more: that row has a shard of its own.

    Defined cases: a null text has 0 bytes; a null key is hashed as the text
    ``null``; rows that repeat a key share a shard unless that would be too
    large. Other columns are ignored; no rows give no rows; a table that fits
    the limit is one shard with the empty prefix.
    """
    _, _, found = _assigned(rows, limit_bytes, key_col, text_col, keep)
    kept = [f"_keep{i}" for i in range(len(keep))]
    return reduce(DataFrame.unionByName, found).select(
        F.col("_key").alias(key_col), F.col("_size").alias("bytes"), "shard",
        F.length("shard").alias("depth"), "shard_bytes", "shard_rows",
        *(F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)))


def _key_bits(key_col: str) -> Column:
    return hash_bits(F.coalesce(F.col(key_col).cast("string"), F.lit("null")))


def _assigned(rows: DataFrame, limit_bytes: int, key_col: str, text_col: str,
              keep: tuple[str, ...]) -> tuple[DataFrame, int, list[DataFrame]]:
    """The first directory (_cell, shard, ...), its bits, and the rows with their shards:
    those that the first directory settles, then frames of the others."""
    kept = [f"_keep{i}" for i in range(len(keep))]
    hashed = write_scratch(rows.select(
        *(F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)), F.col(key_col).alias("_key"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("_size"),
        _key_bits(key_col).alias("_h1"),
        # written once, so the row number cannot change between the passes
        hash_bits(F.monotonically_increasing_id()).alias("_h2")), "shard-rows")
    total = hashed.agg(F.sum("_size")).first()[0] or 0
    depth = max(1, ceil(log2(max(1, total / limit_bytes)))) + SPARE_BITS
    pending, used, found, directory, bits = hashed.withColumn("_prefix", F.lit("")), 0, [], None, 0
    while True:
        word, at = ("_h1", used) if used < HASH_BITS else ("_h2", used - HASH_BITS)
        step = min(depth, HASH_BITS - at)
        here = pending.withColumn("_cell", F.shiftright(word, HASH_BITS - at - step)
                                  .bitwiseAND(F.lit((1 << step) - 1)))
        cells = here.groupBy("_prefix", "_cell").agg(
            F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
        entries, large = _directory(cells, step, limit_bytes, root=not used)
        if directory is None:
            directory, bits = write_scratch(entries, "directory"), step
            entries = directory
        found.append(here.join(entries, ["_prefix", "_cell"]).select(
            *kept, "_key", "_size", "shard", "shard_bytes", "shard_rows"))
        used += step
        rest = here.join(large, ["_prefix", "_cell"], "left_semi").withColumn(
            "_prefix", F.concat("_prefix", _bits(F.col("_cell"), F.lit(step)))).drop("_cell")
        if large.isEmpty():
            break
        rest = write_scratch(rest, "shard-rest")
        if used >= 2 * HASH_BITS:  # single rows beyond the limit
            same = rest.groupBy("_prefix").agg(F.sum("_size").alias("shard_bytes"),
                                               F.count(F.lit(1)).alias("shard_rows"))
            found.append(rest.join(same, "_prefix").select(
                *kept, "_key", "_size", F.col("_prefix").alias("shard"), "shard_bytes", "shard_rows"))
            break
        # a bucket of one row cannot be split further
        alone = rest.groupBy("_prefix").agg(F.count(F.lit(1)).alias("_n")).where("_n = 1")
        found.append(rest.join(alone, "_prefix", "left_semi").select(
            *kept, "_key", "_size", F.col("_prefix").alias("shard"),
            F.col("_size").alias("shard_bytes"), F.lit(1).cast("long").alias("shard_rows")))
        pending, depth = rest.join(alone, "_prefix", "left_anti"), SPARE_BITS
    return directory, bits, found


def write_shards(rows: DataFrame, path: str, limit_bytes: int, key_col: str = "doc_id",
                 text_col: str = "text", row_id: tuple[str, ...] | None = None) -> DataFrame:
    """Write ``rows`` as Parquet in one folder for each shard, and read them back.

    Column ``shard`` (with underscores before it if there is one already) is
    added as the folder name, ``shard=s<bits>``. Every row, not every key, has a
    shard of its own, so a key that holds more than the limit is written by several
    tasks. ``row_id``: SQL expressions that tell rows apart and are the same whenever they
    are read, as file and row index of a Parquet scan; without them the rows are
    written to the scratch folder first. Cases are those of ``extendible_shards``;
    all columns are written, an empty table gives no folder.
    """
    shard = fresh(rows, "shard")
    ids = [fresh(rows, f"row{i}") for i in range(len(row_id or (0, 0)))]
    if row_id is None:
        rows = write_scratch(rows, "shard-input")
        row_id = SCANNED_ROW
    known = rows.select("*", *(F.expr(e).alias(i) for e, i in zip(row_id, ids, strict=True)))
    directory, bits, found = _assigned(
        known.select(*ids, F.col(key_col).alias("_k"), F.col(text_col).alias("_x")), limit_bytes, "_k", "_x",
        tuple(ids))
    # most rows find their shard in the first directory by their key alone; the texts of
    # the others (of keys and cells beyond the limit) are joined by row
    cell = fresh(rows, "cell")
    names = directory.select(F.col("_cell").alias(cell), F.concat(F.lit("s"), "shard").alias(shard))
    placed = known.withColumn(cell, F.shiftright(_key_bits(key_col), HASH_BITS - bits)).join(
        names, cell).drop(cell, *ids)
    if len(found) > 1:
        where = reduce(DataFrame.unionByName, found[1:]).select(
            *(F.col(f"_keep{i}").alias(c) for i, c in enumerate(ids)),
            F.concat(F.lit("s"), "shard").alias(shard))
        placed = placed.unionByName(known.join(where, ids).drop(*ids))
    placed.repartition(shard).write.partitionBy(shard).parquet(path)
    return rows.sparkSession.read.schema(placed.schema).parquet(path)


#: what tells the rows of a Parquet scan apart (files by a hash of their path)
SCANNED_ROW = ("xxhash64(_metadata.file_path)", "_metadata.row_index")


def written_shards(docs: DataFrame, path: str, limit_bytes: int) -> DataFrame:
    """Write a scanned table ``docs`` in shards and report on every row as it was read back:
    doc_id, bytes, shard, depth, shard_bytes, shard_rows (see ``extendible_shards``)."""
    written = write_shards(docs, path, limit_bytes, row_id=SCANNED_ROW)
    rows = written.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
                          F.substr("shard", F.lit(2)).alias("shard"))
    totals = rows.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes"),
                                       F.count(F.lit(1)).alias("shard_rows"))
    return rows.join(totals, "shard").select("doc_id", "bytes", "shard", F.length("shard").alias("depth"),
                                             "shard_bytes", "shard_rows")
