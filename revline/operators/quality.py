"""Data-quality checks: not-null, unique, relationships, range, and a report.

A check *fails* when its failing-row set is non-empty. Every check is an
aggregate (or anti-join) executed on the cluster; only per-check counts
reach the driver when ``assert_clean`` is used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# --- failing-row sets -----------------------------------------------------------

def not_null_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: (column_name, failing_rows), in a single pass."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)])
    stack = ", ".join(f"'{c}', `_{i}`" for i, c in enumerate(columns))
    return agg.selectExpr(f"stack({len(columns)}, {stack}) AS (column_name, failing_rows)")


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` that occur more than once (NULLs ignored)."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def relationship_failures(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (left anti-join)."""
    keys = parent.select(F.col(field).alias("__k")).filter(F.col("__k").isNotNull())
    c = child.filter(F.col(column).isNotNull())
    return c.join(keys, c[column] == keys["__k"], "left_anti")


def range_failures(df: DataFrame, column: str, lo, hi) -> DataFrame:
    """Rows with ``column < lo OR column > hi`` (NULL passes)."""
    return df.filter((F.col(column) < lo) | (F.col(column) > hi))


# --- declarative checks and the report -------------------------------------------

@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str                      # not_null | unique | relationships | range
    parent: str | None = None      # relationships: parent model
    field: str | None = None       # relationships: parent column
    lo: int | None = None          # range bounds
    hi: int | None = None

    @property
    def name(self) -> str:
        extra = f"__{self.parent}_{self.field}" if self.test == "relationships" else ""
        return f"{self.test}_{self.model}_{self.column}{extra}"


def failing_rows(check: Check, models: dict[str, DataFrame]) -> DataFrame:
    df = models[check.model]
    if check.test == "not_null":
        return df.filter(F.col(check.column).isNull())
    if check.test == "unique":
        return unique_failures(df, check.column)
    if check.test == "relationships":
        return relationship_failures(df, check.column, models[check.parent], check.field)
    if check.test == "range":
        return range_failures(df, check.column, check.lo, check.hi)
    raise ValueError(f"unknown test {check.test}")


def failing_count(check: Check, models: dict[str, DataFrame]) -> DataFrame:
    """One-row frame ``failing_rows`` of one check on its own.

    Relationships count orphans per key first (combined map-side), anti-join
    the distinct keys to the parent and sum: a child key holding a third of
    all rows costs one row per map partition instead of a skewed join.
    """
    if check.test == "relationships":
        child = models[check.model]
        per_key = (child.filter(F.col(check.column).isNotNull())
                   .groupBy(F.col(check.column).alias("__k")).agg(F.count(F.lit(1)).alias("__n")))
        parent = models[check.parent].select(F.col(check.field).alias("__k")).filter(F.col("__k").isNotNull())
        orphans = per_key.join(parent, "__k", "left_anti")
        return orphans.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("failing_rows"))
    return failing_rows(check, models).agg(F.count(F.lit(1)).alias("failing_rows"))


def _comparable(child: DataFrame, column: str, parent: DataFrame, field: str) -> bool:
    """True where equal values have equal texts, so that keys can meet in one column."""
    a, b = (df.select(c).schema[0].dataType.simpleString() for df, c in ((child, column), (parent, field)))
    return a == b or {a, b} <= _WHOLE


_WHOLE = {"tinyint", "smallint", "int", "bigint"}
_BITS = 62          # row checks that share one number


class _Suite:
    """What each model contributes to one grouped multiset of (domain, key, role).

    A domain holds the columns whose values are compared with each other: a unique
    column alone, or the field that a relationship refers to (role 0) with the columns
    that refer to it. Row checks (not-null, range) are a domain a model (and
    62 checks) whose key is the number with a bit set for each check that the row fails.
    Whole numbers are keys as they are, other values as texts.
    """

    def __init__(self, checks: Sequence[Check], models: dict[str, DataFrame]):
        self.entries: dict[str, list] = {}                   # model -> (domain, key, role)
        self.counts = []                                     # a column for each check
        self.roles = 1
        self._members: list[list[tuple[str, str]]] = []      # of each domain, by role
        self._domain_of: dict[tuple[str, str], int] = {}     # by the column of role 0
        row_checks: dict[str, list[Check]] = {}
        for ch in checks:
            if ch.test in ("not_null", "range"):
                mine = row_checks.setdefault(ch.model, [])
                domain = self._domain(("row checks", f"{ch.model}/{len(mine) // _BITS}"))
                bit = F.lit(1 << len(mine) % _BITS).cast("bigint")
                mine.append(ch)
                failed = (F.col("d") == domain) & (F.col("k").bitwiseAND(bit) != 0)
                self.counts.append(F.sum(F.when(failed, F.col("n0"))))
            elif ch.test == "unique":
                domain = self._domain((ch.model, ch.column))
                self.counts.append(F.count_if((F.col("d") == domain) & (F.col("n0") > 1)))
            else:
                domain = self._domain((ch.parent, ch.field))
                role = self._role(domain, (ch.model, ch.column))
                orphan = (F.col("d") == domain) & (F.col("n0") == 0)
                self.counts.append(F.sum(F.when(orphan, F.col(f"n{role}"))))
        for domain, members in enumerate(self._members):
            for role, (model, column) in enumerate(members):
                if model != "row checks":
                    key = F.col(column)
                    whole = models[model].select(key).schema[0].dataType.simpleString() in _WHOLE
                    self._add(model, domain, role, **{"k" if whole else "t": key})
        for model, chs in row_checks.items():
            for at in range(0, len(chs), _BITS):
                bits = F.lit(0).cast("bigint")
                for i, ch in enumerate(chs[at:at + _BITS]):
                    failed = F.when(self._fails(ch), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
                    bits = bits.bitwiseOR(failed)
                domain = self._domain_of["row checks", f"{model}/{at // _BITS}"]
                self._add(model, domain, 0, k=F.nullif(bits, F.lit(0).cast("bigint")))

    @staticmethod
    def _fails(ch: Check):
        c = F.col(ch.column)
        return c.isNull() if ch.test == "not_null" else (c < ch.lo) | (c > ch.hi)

    def _domain(self, source: tuple[str, str]) -> int:
        if source not in self._domain_of:
            self._domain_of[source] = len(self._members)
            self._members.append([source])
        return self._domain_of[source]

    def _role(self, domain: int, source: tuple[str, str]) -> int:
        self._members[domain].append(source)
        self.roles = max(self.roles, len(self._members[domain]))
        return len(self._members[domain]) - 1

    def _add(self, model: str, domain: int, role: int, k=None, t=None) -> None:
        k = F.lit(None) if k is None else k
        t = F.lit(None) if t is None else t
        self.entries.setdefault(model, []).append(
            (F.lit(domain), k.cast("bigint"), t.cast("string"), F.lit(role)))

    def multiset(self, models: dict[str, DataFrame]) -> DataFrame:
        """(d, k, t, n0, n1, ...): how often each role of a domain holds a key."""
        parts = [models[m].select(F.stack(F.lit(len(es)), *[x for e in es for x in e]).alias("d", "k", "t", "r"))
                 .filter(F.col("k").isNotNull() | F.col("t").isNotNull()) for m, es in self.entries.items()]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.union(part)
        return rows.groupBy("d", "k", "t").agg(*[
            F.count_if(F.col("r") == i).alias(f"n{i}") for i in range(self.roles)])


def dq_report(checks: Sequence[Check], models: dict[str, DataFrame]) -> DataFrame:
    """One row per check: (check_name, model, column_name, test, failing_rows).

    Every model is read once and one shuffle serves the whole suite: all rows become
    entries of one multiset (``_Suite``), counted map-side first, so that a key holding
    a third of all rows costs one entry a map task. Relationships between columns of
    different kinds (a number and a text) are anti-joins of their own.
    """
    apart = [ch for ch in checks if ch.test == "relationships"
             and not _comparable(models[ch.model], ch.column, models[ch.parent], ch.field)]
    together = [ch for ch in checks if ch not in apart]
    parts: list[DataFrame] = []
    if together:
        suite = _Suite(together, models)
        one = suite.multiset(models).agg(*[
            F.coalesce(n, F.lit(0)).cast("bigint").alias(f"c{i}") for i, n in enumerate(suite.counts)])
        parts.append(one.select(F.explode(F.array(*[
            _report_row(ch, F.col(f"c{i}")) for i, ch in enumerate(together)])).alias("r")).select("r.*"))
    for ch in apart:
        parts.append(failing_count(ch, models).select(_report_row(ch, F.col("failing_rows")).alias("r"))
                     .select("r.*"))
    # every part has the same five columns in the same order
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def _report_row(ch: Check, failing):
    return F.struct(F.lit(ch.name).alias("check_name"), F.lit(ch.model).alias("model"),
                    F.lit(ch.column).alias("column_name"), F.lit(ch.test).alias("test"),
                    failing.cast("bigint").alias("failing_rows"))


def assert_clean(checks: Sequence[Check], models: dict[str, DataFrame]) -> None:
    """Raise when any check fails (use before replacing a table)."""
    bad = [r for r in dq_report(checks, models).filter(F.col("failing_rows") > 0).collect()]
    if bad:
        desc = ", ".join(f"{r['check_name']}={r['failing_rows']}" for r in bad)
        raise AssertionError(f"data-quality checks failed: {desc}")


# The declared suite of the model graph: 18 on staging and raw sources, 23 on
# the marts, plus the singular score-range test.
def default_checks() -> list[Check]:
    nn, un = "not_null", "unique"
    return [
        Check("raw_items", "item_id", nn), Check("raw_reviews", "review_id", nn),
        Check("raw_users", "user_id", nn),
        Check("stg_items", "item_id", un), Check("stg_items", "item_id", nn),
        Check("stg_items", "title_native", nn),
        Check("stg_reviews", "review_id", un), Check("stg_reviews", "review_id", nn),
        Check("stg_reviews", "item_id", nn),
        Check("stg_reviews", "item_id", "relationships", "stg_items", "item_id"),
        Check("stg_reviews", "user_id", nn),
        Check("stg_reviews", "user_id", "relationships", "stg_users", "user_id"),
        Check("stg_reviews", "score", nn), Check("stg_reviews", "review_text", nn),
        Check("stg_users", "user_id", un), Check("stg_users", "user_id", nn),
        Check("stg_users", "username", nn), Check("stg_users", "username", un),
        Check("sentiment", "review_id", nn),
        Check("dim_item", "item_id", un), Check("dim_item", "item_id", nn),
        Check("dim_item", "title", nn),
        Check("dim_user", "user_id", un), Check("dim_user", "user_id", nn),
        Check("dim_user", "username", nn),
        Check("dim_date", "date_id", un), Check("dim_date", "date_id", nn),
        Check("dim_date", "full_date", un), Check("dim_date", "full_date", nn),
        Check("fact_reviews", "review_id", un), Check("fact_reviews", "review_id", nn),
        Check("fact_reviews", "item_id", nn),
        Check("fact_reviews", "item_id", "relationships", "dim_item", "item_id"),
        Check("fact_reviews", "user_id", nn),
        Check("fact_reviews", "user_id", "relationships", "dim_user", "user_id"),
        Check("fact_reviews", "date_id", "relationships", "dim_date", "date_id"),
        Check("fact_reviews", "score", nn),
        Check("recommendations", "source_item_id", nn),
        Check("recommendations", "recommended_item_id", nn),
        Check("recommendations", "rank", nn),
        Check("recommendations", "recommendation_score", nn),
        Check("stg_reviews", "score", "range", lo=1, hi=100),
    ]
