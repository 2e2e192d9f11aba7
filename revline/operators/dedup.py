"""Keep one row per key: first (ingest order) or latest (load time).

Both are written as a grouped ``min`` / ``max`` over one struct whose leading
fields are the ordering keys and whose tail is the rest of the row, instead
of ``row_number() = 1`` over a window. The aggregate runs partially before
the shuffle (map-side combine), so a key holding a third of all rows costs
one struct per map partition, not a sort of the whole group in one task.

Ordering, matching the source system:

* ``keep_latest``: order keys DESC with NULLs FIRST (a row with an unknown
  load time counts as newest); remaining columns break ties, DESC, NULLs last.
* ``keep_first``: order keys ASC with NULLs LAST; remaining columns break
  ties, ASC, NULLs first.

``in_place=True`` (for frames that read the same rows each time, as written tables do)
finds the keys that hold several rows first, from the key columns alone, by a hash
aggregate. Rows of all other keys stay where they are: nothing of them is shuffled or
sorted, whatever texts they carry. It runs a job at once, and pays where few rows repeat
a key; where many do, the plain form reads the rows once less.

``dealt=True`` (for large frames of wide rows) bounds what one task sorts. The plain form
sorts a whole input split before it can combine, and after the shuffle as many rows as the
session's shuffle partitions leave to a task. Here the rows are counted first, by cells of
the key's hash; then they are dealt by key to a task for each ``rows_per_task`` and sorted
only there. Cells that are far above others hold a hot key: their rows take the plain form.
Keys must be equal only if their bytes are (no collation).

``by_lead=True`` (for frames that read the same rows each time, where most rows repeat a
key, as users in their reviews) finds each key's best value of the first order column by a
hash aggregate, and sorts only the rows that have it. Best values are broadcast up to a
checked size; beyond it the rows are dealt. It runs a job at once.

NULL grouping keys form one group, like ``DISTINCT ON``. Columns of map type
are not orderable and are not supported.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revline.session import write_scratch

_W = "__dedup_winner"


def _pick(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], latest: bool) -> DataFrame:
    keys = list(keys)
    order_by = list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    fields = []
    for i, c in enumerate(order_by):
        # flag first: for max it puts NULL rows on top, for min at the bottom
        flag = F.when(F.col(c).isNull(), F.lit(1)).otherwise(F.lit(0)).alias(f"__n{i}")
        fields += [flag, F.col(c).alias(f"__o{i}")]
    fields += [F.col(c) for c in rest]
    agg = F.max if latest else F.min
    picked = df.groupBy(*keys).agg(agg(F.struct(*fields)).alias(_W))
    winner = F.col(_W)

    def column(c: str):
        if c in keys:
            return F.col(c)
        field = f"__o{order_by.index(c)}" if c in order_by else c
        return winner.getField(field).alias(c)

    # the input's column order and names, values of the winning row
    return picked.select(*[column(c) for c in df.columns])


#: contested keys, and leads, are broadcast up to so many bytes (as texts, and 16 a key and column)
CONTESTED_BYTES = 32 << 20


def _pick_in_place(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], latest: bool,
                   contested_bytes: int) -> DataFrame:
    keys = list(keys)
    several = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_W)).filter(F.col(_W) > 1)
               .select(*[F.col(c).alias(f"{_W}{i}") for i, c in enumerate(keys)]))
    contested = write_scratch(several, "contested-keys")
    width = sum((16 + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in contested.columns),
                F.lit(0))
    size = contested.agg(F.sum(width).alias("n")).first().n
    if size is None:
        return df                                  # every key has one row
    if size > contested_bytes:
        return _pick(df, keys, order_by, latest)   # too many to send to every task
    same = [F.col(c).eqNullSafe(F.col(f"{_W}{i}")) for i, c in enumerate(keys)]
    alone = df.join(F.broadcast(contested), same, "left_anti")
    rivals = df.join(F.broadcast(contested), same, "left_semi")
    return alone.union(_pick(rivals, keys, order_by, latest))


#: rows that one task sorts in the dealt form (some hundreds of bytes each), and the least
#: worth a task of their own where cores would idle
ROWS_PER_TASK = 1_200_000
LEAST_ROWS = 50_000
#: cells that rows are counted by
KEY_CELLS = 4096


def deal(df: DataFrame, keys: Sequence[str], rows_per_task: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows dealt by key to a task for each ``rows_per_task``, and apart from them (or None)
    the rows of cells that are far above others. Rows of a key are all in one of the two."""
    cell = F.pmod(F.xxhash64(*keys), F.lit(KEY_CELLS)).cast("int")
    sizes = {r[_W]: r.n for r in df.groupBy(cell.alias(_W)).agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = sum(sizes.values())
    hot = [c for c, n in sizes.items() if n > max(rows_per_task, 4 * rows // KEY_CELLS)]
    rows -= sum(sizes[c] for c in hot)
    tasks = task_count(df.sparkSession, rows, rows_per_task)
    if not hot:
        return df.repartition(tasks, *keys), None
    return df.filter(~cell.isin(hot)).repartition(tasks, *keys), df.filter(cell.isin(hot))


def task_count(spark: SparkSession, rows: int, rows_per_task: int | None = None) -> int:
    """Tasks for so many rows: as many as they need, or more, so that all cores work."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, -(-rows // (rows_per_task or ROWS_PER_TASK)), min(cores, rows // LEAST_ROWS))


def _pick_dealt(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], latest: bool,
                rows_per_task: int) -> DataFrame:
    others, hot = deal(df, keys, rows_per_task)
    picked = _pick(others, keys, order_by, latest)
    return picked.union(_pick(hot, keys, order_by, latest)) if hot is not None else picked


def _first_by_lead(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], lead_bytes: int) -> DataFrame:
    names = [*keys, order_by[0]]
    # NULLs are last: the least value is NULL only where all are
    found = (df.groupBy(*keys).agg(F.min(order_by[0]).alias(_W))
             .select(*[F.col(c).alias(f"{_W}{i}") for i, c in enumerate([*keys, _W])]))
    leads = write_scratch(found, "leads")
    width = sum((16 + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in leads.columns),
                F.lit(0))
    if (leads.agg(F.sum(width).alias("n")).first().n or 0) > lead_bytes:
        return _pick_dealt(df, keys, order_by, False, ROWS_PER_TASK)   # too many to send to every task
    same = [F.col(c).eqNullSafe(F.col(f"{_W}{i}")) for i, c in enumerate(names)]
    return _pick(df.join(F.broadcast(leads), same, "left_semi"), keys, order_by, latest=False)


def keep_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], in_place: bool = False,
                contested_bytes: int = CONTESTED_BYTES, dealt: bool = False,
                rows_per_task: int | None = None) -> DataFrame:
    """``DISTINCT ON (keys) ... ORDER BY keys, order_by DESC`` (NULLs first)."""
    if in_place:
        return _pick_in_place(df, keys, order_by, True, contested_bytes)
    if dealt:
        return _pick_dealt(df, keys, order_by, True, rows_per_task or ROWS_PER_TASK)
    return _pick(df, keys, order_by, latest=True)


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], in_place: bool = False,
               contested_bytes: int = CONTESTED_BYTES, by_lead: bool = False) -> DataFrame:
    """First row per key in ingest order (``ON CONFLICT DO NOTHING`` on load)."""
    if in_place:
        return _pick_in_place(df, keys, order_by, False, contested_bytes)
    if by_lead:
        return _first_by_lead(df, keys, order_by, contested_bytes)
    return _pick(df, keys, order_by, latest=False)
