"""The daily batch job: landed snapshots -> raw -> staging -> marts -> scores
-> look-up tables -> checks -> recommendations -> exports, in that order.

Every step is one transaction on the warehouse: it writes new versions of its
tables, reads them back, and all become visible by one commit, which also notes in
the ledger what the step read, wrote and reported. A run skips the steps whose
inputs and outputs are as noted, so after a failure it goes on from the step that
failed. Scoring runs *before* the recommendations, so a first run on an empty
warehouse completes and recommendations always use the current scores. An empty
fact yields an empty score table (old scores are not kept).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from revline.operators import quality
from revline.operators import recommend as rec
from revline.operators.sentiment import ScorerFactory, sentiment_table
from revline.plans import marts, reports, staging
from revline.schemas import FLAT_USER, LANDED_ITEM, LANDED_REVIEW
from revline.session import dropping_shuffles
from revline.sources import files, landing
from revline.sources.warehouse import Transaction, Warehouse, bucket_count


@dataclass
class PipelineConfig:
    landing_root: str
    warehouse_root: str
    export_root: str | None = None
    scorer: ScorerFactory | None = None
    as_of: str | _dt.date | None = None
    k: int = 10
    min_reviews: int = 2
    # failed checks stop the job before anything that they guard is published;
    # checks named here only report
    fail_on_checks: bool = True
    report_only: tuple[str, ...] = ()
    export_single_file: bool = False
    export_compression: str | None = None
    # raw reviews, staged reviews, fact and scores are bucketed alike by review id, so the
    # load's shuffle is the only one: a bucket for each of so many bytes of landed reviews,
    # counted as plain text (a task sorts one, at about three times its bytes)
    bucket_bytes: int = 128 << 20
    # look-up tables: a file for each of so many bytes (of the fact's or the items' files)
    lookup_bytes: int = 64 << 20
    table_prefix: str = "rl_"
    # skip steps whose inputs and outputs are as the ledger says
    skip_current: bool = True


@dataclass
class PipelineResult:
    tables: dict[str, str] = field(default_factory=dict)    # model -> folder of its version
    offered: dict[str, int] = field(default_factory=dict)   # rows offered to each load
    checks: list[Row] = field(default_factory=list)
    exported: dict[str, int] = field(default_factory=dict)  # rows of each export
    ran: list[str] = field(default_factory=list)            # steps that were not skipped


def _read_landed(spark: SparkSession, root: str, entity: str, schema) -> DataFrame:
    return landing.read_latest_in_order(spark, root, entity, schema)


#: folder of each table below the warehouse
FOLDERS = {
    "raw_items": "raw/raw_items", "raw_reviews": "raw/raw_reviews", "raw_users": "raw/raw_users",
    "stg_items": "staging/stg_items", "stg_reviews": "staging/stg_reviews", "stg_users": "staging/stg_users",
    "dim_item": "marts/dim_item", "dim_user": "marts/dim_user", "dim_date": "marts/dim_date",
    "fact_reviews": "marts/fact_reviews", "sentiment": "marts/review_sentiment",
    "recommendations": "marts/recommendations",
    "scored_by_item": "marts/scored_by_item", "item_titles": "marts/item_titles",
}
#: tables that others are copied from are checked, these copies are not
LOOKUPS = ("scored_by_item", "item_titles")


def warehouse_of(spark: SparkSession, cfg: PipelineConfig) -> Warehouse:
    return Warehouse(spark, cfg.warehouse_root, cfg.table_prefix)


def _counted(df: DataFrame, totals: dict[str, Observation], name: str) -> DataFrame:
    """Rows are counted while they are written, without another pass."""
    totals[name] = Observation(name)
    return df.observe(totals[name], F.count(F.lit(1)).alias("n"))


def _totals(seen: dict[str, Observation]) -> dict[str, int]:
    return {n: int(o.get.get("n", 0)) for n, o in seen.items()}


def declared_constraints(key: str, required: tuple[str, ...] = ()):
    """Guard of a table: primary key unique and not NULL, required
    columns not NULL (the declared constraints of the original tables)."""
    checks = [quality.Check("t", key, "not_null"), quality.Check("t", key, "unique")]
    checks += [quality.Check("t", c, "not_null") for c in required]
    return lambda written: quality.assert_clean(checks, {"t": written})


def load_step(spark: SparkSession, cfg: PipelineConfig, tx: Transaction) -> dict:
    """Newest snapshot per entity -> raw tables; first row per key wins. The shuffle that
    groups the reviews by id also deals them to the buckets that every later step keeps."""
    landed = landing.latest_snapshot_path(spark, cfg.landing_root, "reviews")
    plain = landing.landed_bytes(spark, landed)
    with landing.split_as_plain(spark, landing.snapshot_stamp(spark, landed)[1], plain):
        return _load(spark, cfg, tx, bucket_count(spark, plain, cfg.bucket_bytes))


def _load(spark: SparkSession, cfg: PipelineConfig, tx: Transaction, buckets: int) -> dict:
    items = _read_landed(spark, cfg.landing_root, "items", LANDED_ITEM)
    flat_items = landing.landed_items(items, extra=["__ingest"])
    reviews = _read_landed(spark, cfg.landing_root, "reviews", LANDED_REVIEW)
    flat_reviews = landing.landed_reviews(reviews, extra=["__ingest"])
    try:
        users = _read_landed(spark, cfg.landing_root, "users", FLAT_USER)
    except FileNotFoundError:
        # users are embedded in reviews; derive them when not landed separately
        users = landing.users_from_reviews(flat_reviews, ["__ingest"]).withColumn(
            "__ingest", F.col("user_id"))
    # rows offered to each load (before key conflicts)
    offered: dict[str, Observation] = {}
    raw = {
        "raw_items": (landing.load_items(_counted(flat_items, offered, "items"), ("__ingest",)), "item_id"),
        "raw_reviews": (landing.load_reviews(_counted(flat_reviews, offered, "reviews"), ["__ingest"]),
                        "review_id"),
        "raw_users": (landing.load_users(_counted(users, offered, "users"), ["__ingest"]), "user_id"),
    }
    for name, (df, key) in raw.items():
        dealt = {"bucket_key": key, "buckets": buckets} if name == "raw_reviews" else {}
        tx.write(name, df, FOLDERS[name], guard=declared_constraints(key), **dealt)
    return {"offered": _totals(offered), "buckets": buckets}


def transform_step(spark: SparkSession, cfg: PipelineConfig, tx: Transaction) -> dict:
    """Staging (kept as tables here for the checks) and the star schema. Reviews stay in
    the buckets that the load dealt them to."""
    dealt = {"bucket_key": "review_id", "buckets": tx.buckets_of("raw_reviews")}
    tx.write("stg_items", staging.stage_items(tx.read("raw_items")), FOLDERS["stg_items"])
    reviews = tx.write("stg_reviews", staging.stage_reviews(tx.read("raw_reviews"), in_place=True),
                       FOLDERS["stg_reviews"], **dealt)
    tx.write("stg_users", staging.stage_users(tx.read("raw_users")), FOLDERS["stg_users"])
    dates = tx.write("dim_date", marts.dim_date(reviews), FOLDERS["dim_date"])
    tx.write("dim_item", marts.dim_item(tx.read("stg_items")), FOLDERS["dim_item"])
    tx.write("dim_user", marts.dim_user(tx.read("stg_users"), cfg.as_of), FOLDERS["dim_user"])
    tx.write("fact_reviews", marts.fact_reviews(reviews, dates), FOLDERS["fact_reviews"], **dealt)
    return {}


def score_step(spark: SparkSession, cfg: PipelineConfig, tx: Transaction) -> dict:
    scores = sentiment_table(tx.read("fact_reviews"), cfg.scorer, with_timestamp=True)
    tx.write("sentiment", scores, FOLDERS["sentiment"], bucket_key="review_id",
             buckets=tx.buckets_of("fact_reviews"),
             guard=declared_constraints("review_id", ("sentiment_label", "sentiment_score")))
    return {}


def lookup_step(spark: SparkSession, cfg: PipelineConfig, tx: Transaction) -> dict:
    """Narrow copies laid out for look-ups: scored reviews by item, titles by title. The
    join of fact and scores is made here once, for every report that reads it."""
    def files_for(name: str) -> int:
        return max(1, -(-tx.bytes_of(name) // cfg.lookup_bytes))

    scored = reports.fact_join_scores(tx.read("fact_reviews"), tx.read("sentiment"))
    tx.write("scored_by_item", scored, FOLDERS["scored_by_item"],
             cluster_by=("item_id", "review_id"), files=files_for("fact_reviews"))
    tx.write("item_titles", reports.item_titles(tx.read("dim_item")), FOLDERS["item_titles"],
             cluster_by=("title_display", "item_id"), files=files_for("dim_item"), blooms=("item_id",))
    return {}


def _run_checks(cfg: PipelineConfig, models: dict[str, DataFrame], needed: set[str]) -> list[dict]:
    """Run the declared checks that read ``models`` and one of ``needed``; raise if any counts."""
    checks = [c for c in quality.default_checks() if c.model in models
              and (c.parent is None or c.parent in models) and {c.model, c.parent} & needed]
    found = quality.dq_report(checks, models).collect()            # one row per check
    bad = [r for r in found if r.failing_rows > 0 and r.check_name not in cfg.report_only]
    if cfg.fail_on_checks and bad:
        raise AssertionError("data-quality checks failed: "
                             + ", ".join(f"{r.check_name}={r.failing_rows}" for r in bad))
    return [r.asDict() for r in found]


def check_step(spark: SparkSession, cfg: PipelineConfig, tx: Transaction) -> dict:
    """Everything below the recommendations is checked before they are made."""
    models = {n: tx.read(n) for n in FOLDERS if n not in ("recommendations", *LOOKUPS)}
    return {"checks": _run_checks(cfg, models, set(models))}


def recommend_step(spark: SparkSession, cfg: PipelineConfig, tx: Transaction) -> dict:
    """Write the recommendations and check the written rows; they replace the
    previous ones only if the checks pass."""
    stats = rec.stats_from_scored(tx.read("scored_by_item"), cfg.min_reviews)
    recs = rec.recommend(tx.read("dim_item"), stats, cfg.k).orderBy("source_item_id", "rank")
    checks: list[dict] = []
    tx.write("recommendations", recs, FOLDERS["recommendations"], guard=lambda written: checks.extend(
        _run_checks(cfg, {"recommendations": written}, {"recommendations"})))
    return {"checks": checks}


def export_step(spark: SparkSession, cfg: PipelineConfig, tx: Transaction) -> dict:
    if not cfg.export_root:
        return {}
    dim = tx.read("dim_item")
    scored = tx.read("scored_by_item")
    out = {
        "item_list": reports.item_list(dim),
        "recommendations": tx.read("recommendations").orderBy("source_item_id", "rank"),
        "sentiment_by_tag": reports.sentiment_by_tag(scored, dim),
        "item_sentiment_stats": reports.item_stats_all(scored),
    }
    seen: dict[str, Observation] = {}
    for name, df in out.items():
        files.export_csv(_counted(df, seen, name), f"{cfg.export_root}/{name}", cfg.export_single_file,
                         cfg.export_compression)
    return {"exported": _totals(seen)}


def _landed(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """The newest snapshots and when they were finished."""
    found = {}
    for entity in ("items", "reviews", "users"):
        try:
            path = landing.latest_snapshot_path(spark, cfg.landing_root, entity)
        except FileNotFoundError:
            continue
        found[entity] = [path, *landing.snapshot_stamp(spark, path)]
    return found


def _named(scorer: ScorerFactory | None) -> str:
    """A scorer's name; one whose model changes can tell by an attribute ``version``."""
    if scorer is None:
        return "built-in lexicon"
    name = f"{getattr(scorer, '__module__', '')}.{getattr(scorer, '__qualname__', repr(scorer))}"
    return f"{name} {getattr(scorer, 'version', '')}"


@dataclass(frozen=True)
class Step:
    run: Callable[[SparkSession, PipelineConfig, Transaction], dict]
    reads: tuple[str, ...]                                  # tables
    settings: Callable[[SparkSession, PipelineConfig], dict]


def _rules(spark: SparkSession, cfg: PipelineConfig) -> dict:
    return {"fail": cfg.fail_on_checks, "report_only": sorted(cfg.report_only)}


_RAW = ("raw_items", "raw_reviews", "raw_users")
STEPS = {
    "load": Step(load_step, (), lambda s, c: {**_landed(s, c), "bucket_bytes": c.bucket_bytes}),
    "transform": Step(transform_step, _RAW, lambda s, c: {"as_of": str(c.as_of or _dt.date.today())}),
    "score": Step(score_step, ("fact_reviews",), lambda s, c: {"scorer": _named(c.scorer)}),
    "look-up": Step(lookup_step, ("dim_item", "fact_reviews", "sentiment"),
                    lambda s, c: {"lookup_bytes": c.lookup_bytes}),
    "check": Step(check_step, tuple(n for n in FOLDERS if n not in ("recommendations", *LOOKUPS)), _rules),
    "recommend": Step(recommend_step, ("dim_item", "scored_by_item"),
                      lambda s, c: {"k": c.k, "min_reviews": c.min_reviews, **_rules(s, c)}),
    "export": Step(export_step, ("dim_item", "scored_by_item", "recommendations"),
                   lambda s, c: {"root": c.export_root, "single_file": c.export_single_file,
                                 "compression": c.export_compression, "there": _exports_there(s, c)}),
}


def _exports_there(spark: SparkSession, cfg: PipelineConfig) -> bool:
    """Part of what the exports are made from: where they are missing they are made anew."""
    return bool(cfg.export_root) and landing.snapshot_complete(spark, f"{cfg.export_root}/item_sentiment_stats")


def run_step(spark: SparkSession, cfg: PipelineConfig, name: str, wh: Warehouse | None = None) -> dict:
    """Run one step, unless it is current, and return what it reported. A skipped step
    returns what it reported when it ran, with ``skipped``."""
    wh, step = wh or warehouse_of(spark, cfg), STEPS[name]
    at = wh.snapshot()

    def inputs() -> dict:
        return {"settings": step.settings(spark, cfg),
                "tables": {t: at.tables[t].path for t in step.reads if t in at.tables}}

    if cfg.skip_current and wh.is_current(name, inputs(), at):
        return {**at.steps[name]["result"], "skipped": True}
    with wh.transaction() as tx, dropping_shuffles(spark):
        result = step.run(spark, cfg, tx)
        tx.record(name, inputs(), result)
    return result


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> PipelineResult:
    """load -> transform -> score -> look-up -> checks -> recommend (checked) -> export, from
    the first step that is not current."""
    wh, res = warehouse_of(spark, cfg), PipelineResult()
    wh.repair()
    for name in STEPS:
        result = run_step(spark, cfg, name, wh)
        res.offered.update(result.get("offered", {}))
        res.exported.update(result.get("exported", {}))
        res.checks += [Row(**c) for c in result.get("checks", [])]
        if not result.get("skipped"):
            res.ran.append(name)
    at = wh.snapshot()
    res.tables = {n: wh.path(n, at) for n in FOLDERS if n in at.tables}
    return res
