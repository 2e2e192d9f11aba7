"""SimHash document fingerprints, with DataFrame operations only.

Every word votes with its hash, weighted by its length (long words are rare
words): bit j of the fingerprint is set where the words whose hash has bit j
outweigh the others. Votes are plain sums, so they are combined in the map task
and a document of any length takes 33 numbers.

Two votes share one 64-bit sum (bits j and j + 32). The weights of a text add
up to less than its number of characters, hence below 2^31: no sum overflows.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revline.session import write_scratch

BITS = 64
_PAIR = (1 << 32) | 1
_LOW = (1 << 32) - 1
#: ids per cell of the successor search: 2 to this power
CELL_BITS = 6


def terms(text: Column) -> Column:
    """Lower-case words; for a text without letters and digits what white space separates."""
    low = F.lower(text)
    return F.when(text.rlike(r"[\p{L}\p{N}]"), F.split(low, r"[^\p{L}\p{N}]+")).otherwise(
        F.split(low, r"\s+"))


def _weight(term: Column) -> Column:
    """Characters less two, at least 1; the empty word that a split may leave counts nothing."""
    n = F.length(term)
    return F.when(n == 0, 0).otherwise(F.greatest(n - 2, F.lit(1))).cast("long")


def vote(df: DataFrame, keys: list[str], term: str = "_term") -> DataFrame:
    """Rows of (keys, term) to (keys, fingerprint as bigint)."""
    h = F.xxhash64(term)
    weighed = df.select(*keys, h.alias("_h"), _weight(F.col(term)).alias("_w"))
    sums = [F.sum(F.shiftright("_h", j).bitwiseAND(F.lit(_PAIR)) * F.col("_w")).alias(f"_v{j}")
            for j in range(32)]
    votes = weighed.groupBy(*keys).agg(F.sum("_w").alias("_all"), *sums)

    def bit(j: int) -> Column:
        both = F.col(f"_v{j % 32}")
        votes_for = both.bitwiseAND(F.lit(_LOW)) if j < 32 else F.shiftrightunsigned(both, 32)
        return F.shiftleft(F.when(votes_for * 2 > F.col("_all"), F.lit(1)).otherwise(
            F.lit(0)).cast("long"), j)

    return votes.select(*keys, reduce(Column.bitwiseOR, map(bit, range(BITS))).alias("fingerprint"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fingerprint (bigint) of every row's whole text.

    Defined cases: a null text counts as empty and an empty text has fingerprint
    0; equal texts have equal fingerprints; rows that repeat an id with one text
    give one row. Other columns are ignored; no rows give no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    exploded = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_t"),
                           F.explode(terms(text)).alias("_term"))
    distinct = vote(exploded.select("_id", "_t", "_term"), ["_id", "_t"])
    return distinct.select(F.col("_id").alias(id_col), "fingerprint")


def as_hex(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), BITS // 4, "0")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


# ---------------------------------------------------------------- searching

def block_masks(radius: int, blocks: int | None = None) -> list[int]:
    """Masks of the permuted block tables for a Hamming radius.

    The bits are cut into ``blocks``; ``radius`` differing bits leave at least
    ``blocks - radius`` blocks equal, so two fingerprints within the radius agree
    under one of the masks.
    """
    blocks = blocks or 2 * radius
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    block = [sum(1 << j for j in range(a, b)) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(some) for some in combinations(block, blocks - radius)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _keyed(df: DataFrame, masks: list[int], fp: str) -> DataFrame:
    entry = F.explode(F.array(*(
        F.struct(F.lit(k).alias("table"), F.col(fp).bitwiseAND(F.lit(_signed(m))).alias("key"))
        for k, m in enumerate(masks))))
    return df.withColumn("_e", entry).select("*", "_e.table", "_e.key").drop("_e")


def near_fingerprints(queries: DataFrame, table: DataFrame, radius: int = 3) -> DataFrame:
    """All pairs (query, found, distance) of distinct fingerprints within the radius.

    Both inputs have a column ``fingerprint`` (bigint); nulls match nothing. Each
    distinct fingerprint is looked up once, so copies add no pairs; equal
    fingerprints are a pair at distance 0.
    """
    masks = block_masks(radius)
    q = queries.select(F.col("fingerprint").alias("query")).where("query IS NOT NULL").distinct()
    t = table.select(F.col("fingerprint").alias("found")).where("found IS NOT NULL").distinct()
    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("found")))
    # the entries are many times the fingerprints Spark has measured: always shuffle
    return (_keyed(q, masks, "query").hint("merge")
            .join(_keyed(t, masks, "found"), ["table", "key"])
            .where(distance <= radius).select("query", "found", distance.alias("distance"))
            .distinct())


def count_near(queries: DataFrame, table: DataFrame, radius: int = 3) -> DataFrame:
    """fingerprint and near_rows: how many rows of ``table`` lie within the radius."""
    rows = table.groupBy(F.col("fingerprint").alias("found")).agg(F.count(F.lit(1)).alias("_n"))
    return (near_fingerprints(queries, table, radius).join(rows, "found")
            .groupBy(F.col("query").alias("fingerprint")).agg(F.sum("_n").alias("near_rows")))


# ---------------------------------------------------- documents and successors

def _next_cells(cells: DataFrame) -> DataFrame:
    """cell and the next larger one that occurs (the smallest after the largest)."""
    spark = cells.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = write_scratch(
        cells.distinct().repartitionByRange(n, "_cell")
             .select("_cell", F.spark_partition_id().alias("_part")), "cells")
    # one row per partition of the range: the first cell of the parts after it
    heads = ranged.groupBy("_part").agg(F.min("_cell").alias("_head"))
    parts = heads.select(
        "_part", F.coalesce(F.lead("_head").over(Window.orderBy("_part")),
                            F.min("_head").over(Window.partitionBy())).alias("_after"))
    inside = ranged.withColumn("_lead", F.lead("_cell").over(
        Window.partitionBy("_part").orderBy("_cell")))
    return inside.join(F.broadcast(parts), "_part").select(
        "_cell", F.coalesce("_lead", "_after").alias("_next_cell"))


def fingerprints_of_edits(docs: DataFrame, radius: int = 3, id_col: str = "doc_id",
                          text_col: str = "text", search_every: int = 50) -> DataFrame:
    """Fingerprints of every document and of its edited text.

    The edited text: the last half (rounded down, code points) is replaced by the
    first as many code points, or all, of the next document by id; the last
    document is followed by the first. Columns: id, n_chars, edited_sha256,
    fingerprint and edited_fingerprint (16 hex digits), near_edited and near_next
    (share of equal bits with the edited text's and the next document's
    fingerprint), near_rows (for ids divisible by ``search_every``: the rows of
    the table whose fingerprint lies within ``radius`` bits, itself included; for
    other ids null).

    Defined cases: a null text counts as empty; a single document is its own
    successor; rows that repeat an id follow each other in the order of their
    texts; null ids (integers otherwise) come first. Other columns are ignored;
    no rows give no rows.
    """
    base = docs.select(F.col(id_col).cast("long").alias("_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    # a cell holds a fixed range of ids: no more rows than ids, however many documents
    base = base.withColumn("_cell", F.coalesce(F.shiftright("_id", CELL_BITS), F.lit(-(1 << 60))))
    order = Window.partitionBy("_cell").orderBy("_id", "_text")
    rows = base.select("*", F.row_number().over(order).alias("_rn"),
                       F.lead("_text").over(order).alias("_lead"))
    succ = _next_cells(base.select("_cell"))
    firsts = (rows.where("_rn = 1").select(F.col("_cell").alias("_next_cell"),
                                           F.col("_text").alias("_first"))
              .join(succ, "_next_cell").select("_cell", "_next_cell", "_first"))
    n, half = F.length("_text"), F.floor(F.length("_text") / 2).cast("int")
    following = F.coalesce("_lead", "_first")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), n - half),
                      F.substring(following, F.lit(1), half))
    both = rows.join(firsts, "_cell").select(
        "_cell", "_rn", "_id", "_text", n.cast("long").alias("_n"), edited.alias("_edited"),
        F.when(F.col("_lead").isNull(), F.col("_next_cell")).otherwise(F.col("_cell"))
        .alias("_to_cell"),
        F.when(F.col("_lead").isNull(), 1).otherwise(F.col("_rn") + 1).alias("_to_rn"))
    keys = ["_cell", "_rn", "_id", "_n", "_to_cell", "_to_rn", "_sha"]
    exploded = (both.withColumn("_sha", F.sha2("_edited", 256))
                .select(*keys, F.explode(F.array(
                    F.struct(F.lit(0).alias("which"), F.col("_text").alias("t")),
                    F.struct(F.lit(1).alias("which"), F.col("_edited").alias("t")))).alias("_v"))
                .select(*keys, F.col("_v.which").alias("_which"),
                        F.explode(terms(F.col("_v.t"))).alias("_term")))
    voted = vote(exploded, [*keys, "_which"])
    pick = [F.max(F.when(F.col("_which") == k, F.col("fingerprint"))).alias(c)
            for k, c in enumerate(("fingerprint", "_edited_fp"))]
    own = write_scratch(voted.groupBy(*keys).agg(*pick), "simhash")

    after = own.select(F.col("_cell").alias("_to_cell"), F.col("_rn").alias("_to_rn"),
                       F.col("fingerprint").alias("_next_fp"))
    asked = own.where(F.col("_id") % search_every == 0)
    near = (asked.select("_cell", "_rn", "fingerprint")
            .join(count_near(asked, own, radius), "fingerprint")
            .select("_cell", "_rn", "near_rows"))
    fp = F.col("fingerprint")
    return (own.join(after, ["_to_cell", "_to_rn"]).join(near, ["_cell", "_rn"], "left")
            .select(F.col("_id").cast(docs.schema[id_col].dataType).alias(id_col),
                    F.col("_n").alias("n_chars"), F.col("_sha").alias("edited_sha256"),
                    as_hex(fp).alias("fingerprint"),
                    as_hex(F.col("_edited_fp")).alias("edited_fingerprint"),
                    likeness(fp, F.col("_edited_fp")).alias("near_edited"),
                    likeness(fp, F.col("_next_fp")).alias("near_next"), "near_rows"))
