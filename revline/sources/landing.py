"""Landing zone: nested JSON snapshots per entity and day, and their flattening.

Layout: ``<root>/<entity>/snapshot_date=YYYY-MM-DD/part-*.json`` (JSON lines,
written by Spark; ``part-*.json.gz`` or ``.snappy`` where compressed). Folders holding ``YYYY-MM-DD.json`` files with one JSON
array each (the layout of the original extractor) are read too.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revline.functions.scalars import first_element
from revline.operators.dedup import keep_first
from revline.schemas import FLAT_ITEM, FLAT_REVIEW, RAW_ITEMS, RAW_REVIEWS, RAW_USERS
from revline.sources.json_array import read_json_array

PARTITION = "snapshot_date"


# --- file system helpers (metadata only, through Hadoop's FileSystem) -------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _list_names(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(p)]


def today_utc() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d")


def snapshot_path(root: str, entity: str, day: str) -> str:
    return f"{root.rstrip('/')}/{entity}/{PARTITION}={day}"


def snapshot_complete(spark: SparkSession, path: str) -> bool:
    """True for a dated file, or a folder whose writer has finished (``_SUCCESS``)."""
    fs, p = _fs(spark, path)
    return bool(fs.isFile(p) or fs.exists(_fs(spark, f"{path}/_SUCCESS")[1]))


def snapshot_stamp(spark: SparkSession, path: str) -> tuple[int, int]:
    """(time of the last change in milliseconds, bytes) of a snapshot."""
    fs, p = _fs(spark, path)
    return int(fs.getFileStatus(p).getModificationTime()), int(fs.getContentSummary(p).getLength())


def landed_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a snapshot's records as plain text. Of a plain one they are known from the
    listing; a compressed one is read once, without parsing."""
    packed = snapshot_stamp(spark, path)[1]
    if not any(n.startswith("part-") and not n.endswith(".json") for n, _ in _list_names(spark, path)):
        return packed
    size = spark.read.text(path).agg(F.sum(F.octet_length("value") + F.lit(1)).alias("n")).first().n
    return max(packed, int(size or 0))


@contextmanager
def split_as_plain(spark: SparkSession, packed: int, plain: int) -> Iterator[None]:
    """Scans run inside give a task no more records of files that hold ``plain`` bytes in
    ``packed`` than it would get of plain ones: small dense files are packed into splits by
    their bytes, and a task sorts what its split holds."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key, None)
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    try:
        if 0 < packed < plain:
            spark.conf.set(key, str(max(1, most * packed // plain)))
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


#: records of a compressed file: such a file is not split, so one task reads it
FILE_RECORDS = 1_000_000


def write_snapshot(df: DataFrame, root: str, entity: str, day: str | None = None,
                   compression: str | None = None) -> str:
    """Land records as JSON for one day; a complete snapshot is kept as is.

    Re-runs on the same day are no-ops, like the extractor's skip-if-exists. A
    folder that a crashed writer left without ``_SUCCESS`` is written anew. With
    ``compression`` a task's records go to files of ``FILE_RECORDS`` at most, named in their
    order; the readers tell by the file's ending. With ``snappy`` a split still holds about
    the records that a task can sort; files of a denser codec (``gzip``) are read inside
    ``split_as_plain``.
    """
    path = snapshot_path(root, entity, day or today_utc())
    if not snapshot_complete(df.sparkSession, path):
        writer = df.write.mode("overwrite")
        if compression:
            writer = writer.option("compression", compression).option("maxRecordsPerFile", FILE_RECORDS)
        writer.json(path)
    return path


def latest_snapshot_path(spark: SparkSession, root: str, entity: str) -> str:
    """Newest complete snapshot of an entity, by name; raises when there is none."""
    folder = f"{root.rstrip('/')}/{entity}"
    names = _list_names(spark, folder)
    parts = sorted(n for n, is_dir in names if is_dir and n.startswith(f"{PARTITION}="))
    files = sorted(n for n, is_dir in names if not is_dir and n.endswith(".json"))
    # partition folders and dated files share the YYYY-MM-DD suffix ordering
    cands = [(n.split("=", 1)[1], f"{folder}/{n}") for n in parts]
    cands += [(n[:-5], f"{folder}/{n}") for n in files]
    for _, path in sorted(cands, reverse=True):
        if snapshot_complete(spark, path):
            return path
    raise FileNotFoundError(f"No landed snapshots found in {folder}")


def read_snapshot(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read one snapshot with a fixed schema (JSON lines or one JSON array); both are split."""
    if path.endswith(".json"):
        return read_json_array(spark, path, schema)
    return spark.read.schema(schema).json(path)


def read_snapshots(spark: SparkSession, paths: Sequence[str], schema) -> DataFrame:
    """Several pages or days as one frame (rows of all, in no order)."""
    frames = [read_snapshot(spark, p, schema) for p in paths]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def read_latest_in_order(spark: SparkSession, root: str, entity: str, schema,
                         name: str = "__ingest") -> DataFrame:
    """The newest snapshot with its records' places as ``with_ingest_order`` has them."""
    path = latest_snapshot_path(spark, root, entity)
    if path.endswith(".json"):
        return read_json_array(spark, path, schema, order=name)
    return with_ingest_order(read_snapshot(spark, path, schema), name)


def read_latest(spark: SparkSession, root: str, entity: str, schema) -> DataFrame:
    return read_snapshot(spark, latest_snapshot_path(spark, root, entity), schema)


# --- flattening ---------------------------------------------------------------

def flatten_items(payload: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Nested item record -> flat record; first studio or NULL, null-safe year."""
    c = F.col
    return payload.select(
        c("id").alias("item_id"),
        c("title.native").alias("title_native"),
        c("title.english").alias("title_english"),
        c("tags").alias("tags"),
        first_element(c("studios.nodes")).getField("name").alias("studio"),
        c("episodes"),
        c("averageScore").alias("avg_score"),
        c("startDate.year").alias("year"),
        c("status"),
        c("description"),
        *[c(x) for x in extra],
    )


def flatten_reviews(payload: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Nested review record -> flat record; a missing user gives NULL user fields."""
    c = F.col
    return payload.select(
        c("id").alias("review_id"),
        c("itemId").alias("item_id"),
        c("user.id").alias("user_id"),
        c("user.name").alias("username"),
        c("user.createdAt").alias("user_created_at"),
        c("score"),
        c("summary"),
        c("body").alias("review_text"),
        c("createdAt").alias("created_at"),
        *[c(x) for x in extra],
    )


def users_from_reviews(flat_reviews: DataFrame, order_by: Sequence[str], by_lead: bool = False) -> DataFrame:
    """Distinct users embedded in reviews: first seen wins; NULL and 0 ids skipped.

    ``by_lead``: see ``keep_first``; it reads the reviews twice."""
    u = flat_reviews.filter(F.col("user_id").isNotNull() & (F.col("user_id") != 0)).select(
        "user_id", "username", F.col("user_created_at").alias("join_date"), *order_by)
    first = keep_first(u, ["user_id"], list(order_by), by_lead=by_lead)
    return first.select("user_id", "username", "join_date")


def landed_items(landed: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Flat items from records of either layout (see ``schemas.LANDED_ITEM``)."""
    return _either(landed, flatten_items(landed, [*landed.columns]), "item_id",
                   FLAT_ITEM.fieldNames(), extra)


def landed_reviews(landed: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Flat reviews from records of either layout (see ``schemas.LANDED_REVIEW``)."""
    return _either(landed, flatten_reviews(landed, [*landed.columns]), "review_id",
                   FLAT_REVIEW.fieldNames(), extra)


def _either(landed: DataFrame, flattened: DataFrame, key: str, names: Sequence[str],
            extra: Sequence[str]) -> DataFrame:
    """``flattened`` has the nested layout's columns first, then all landed ones;
    a record with a flat key takes the landed columns of the same names."""
    n = len(names)
    both = flattened.toDF(*(f"_nested_{c}" for c in names), *landed.columns)
    flat = F.col(key).isNotNull()
    assert len(both.columns) == n + len(landed.columns)
    return both.select(*(F.when(flat, F.col(c)).otherwise(F.col(f"_nested_{c}")).alias(c)
                         for c in names), *extra)


# --- raw loading ----------------------------------------------------------------

def load_items(flat: DataFrame, keep_first_by: Sequence[str] | None = ("__ingest",)) -> DataFrame:
    """Raw items: fixed columns, NULL tags -> [], score as NUMERIC(5,2).

    With ``keep_first_by`` the first row per id (in that order) wins, as an
    insert that skips key conflicts would; None keeps every row.
    """
    order = [c for c in (keep_first_by or ()) if c in flat.columns]
    declared = [f for f in RAW_ITEMS.fields if f.name not in ("tags", "loaded_at")]
    tags = F.coalesce(F.col("tags"), F.array().cast("array<string>")).alias("tags")
    out = flat.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in declared), tags, *order)
    if order:
        out = keep_first(out, ["item_id"], order)
    return _as_declared(out.withColumn("loaded_at", F.current_timestamp()), RAW_ITEMS)


def _as_declared(df: DataFrame, schema) -> DataFrame:
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def load_reviews(flat: DataFrame, keep_first_by: Sequence[str]) -> DataFrame:
    """Raw reviews in their declared columns: first row per id (in
    ``keep_first_by`` order) wins."""
    out = keep_first(flat, ["review_id"], list(keep_first_by))
    return _as_declared(out.withColumn("loaded_at", F.current_timestamp()), RAW_REVIEWS)


def load_users(flat_users: DataFrame, keep_first_by: Sequence[str]) -> DataFrame:
    """Raw users: rows without an id are dropped, then first row per id wins."""
    u = flat_users.filter(F.col("user_id").isNotNull())
    out = keep_first(u, ["user_id"], list(keep_first_by))
    return _as_declared(out.withColumn("loaded_at", F.current_timestamp()), RAW_USERS)


def with_ingest_order(df: DataFrame, name: str = "__ingest") -> DataFrame:
    """Tag rows with their position in the landed files.

    (part number, file path, byte offset of the split, row id inside the
    split): the order of records as landed, and stable when a task is retried,
    because a split is always read in the same order. The number is compared as
    a number: ``part-100000`` comes after ``part-99999``. Call it directly on a
    file scan.
    """
    path = F.col("_metadata.file_path")
    part = F.regexp_extract(path, r"part-(\d+)[^/]*$", 1)
    return df.withColumn(name, F.struct(
        F.when(part == "", F.lit(-1)).otherwise(part.try_cast("bigint")).alias("p"),
        path.alias("f"), F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("r")))
