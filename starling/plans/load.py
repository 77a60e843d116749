"""The full load (PIP-14): dimensions -> facts -> verification -> views.

Storage layout under one warehouse root (a shared file system / object store
path on a cluster):

    {root}/dim_*            Parquet, append-only (insert-only dimensions)
    {root}/fact_*           Parquet, partitioned by month of date_key
    {checkpoint dir}/starling-staging/{run}/{table}
                            each run's new rows, written once then read back
    {lake}/{table}_{ts}     optional timestamped snapshots
    {mirror}/fact_*         optional mirror tables under a schema contract (sinks.mirror)

Every step is re-runnable: dimensions and facts append only keys not yet
stored (left anti join on the key), and every generated value is a hash of
the business key, so a second run with the same inputs appends nothing.
The batch that is counted, snapshotted and appended is one materialised
staging write, never a lazy plan re-evaluated per sink (an initial load
without a snapshot appends its single build directly and counts the files).
Dimensions are built concurrently, then the three facts, as independent
Spark jobs from driver threads.
"""

from __future__ import annotations

import dataclasses
import logging
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.operators.keys import only_new_rows
from starling.params import RunParams
from starling.plans import checks, dims
from starling.plans.facts import split_payments
from starling.plans.star import Star
from starling.schemas import STAR, conform
from starling.sinks.mirror import Contract, Mirror
from starling.sinks.writers import append, write_snapshot
from starling.session import checkpoint_dir
from starling.sources.files import path_exists, read_parquet, remove_path, require_rows

FACT_KEYS = {"fact_sales": "policy_id", "fact_claims": "claim_id", "fact_payments": "payment_id"}
FACT_ORDER = ["fact_sales", "fact_claims", "fact_payments"]
DIM_ORDER = ["dim_date", "dim_policy_type", "dim_county", "dim_claim_status", "dim_customer", "dim_agent"]
PARTITION_COL = "date_month"
# the sales mirror takes new columns, the others do not
CONTRACTS = {name: Contract(STAR[name], additive=name == "fact_sales") for name in FACT_ORDER}

LOG = logging.getLogger(__name__)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def existing(self, name: str) -> DataFrame | None:
        if not path_exists(self.spark, self.path(name)):
            return None
        return self.read(name).select(*STAR[name].names)

    def schema(self, name: str) -> T.StructType:
        """A stored table's declared columns; facts have their partition column (``date_month``) last."""
        partition = [T.StructField(PARTITION_COL, T.DateType())] if name in FACT_KEYS else []
        return T.StructType([*STAR[name].fields, *partition])

    def read(self, name: str) -> DataFrame:
        """Stored table in its declared schema (no footers are read); facts keep their partition
        column, so date filters can also prune partitions."""
        return read_parquet(self.spark, self.path(name), self.schema(name))

    def existing_keys(self, name: str) -> DataFrame | None:
        """Every stored key of a fact (only that column is read): a stored row may have no
        date or an older one, so no month range can stand in for the whole table."""
        if not path_exists(self.spark, self.path(name)):
            return None
        return self.read(name).select(FACT_KEYS[name])

    def stage(self, name: str, df: DataFrame, run_id: str) -> DataFrame:
        """Write the batch once and read it back: one fixed batch for count, snapshot and append.

        Staged under the cluster's checkpoint folder (``spark.checkpoint.dir``,
        read from the session), else under the warehouse root.
        """
        path = f"{self.staging(run_id)}/{name}"
        df.write.mode("errorifexists").parquet(path)
        return read_parquet(self.spark, path, df.schema)

    def staging(self, run_id: str) -> str:
        base = checkpoint_dir(self.spark) or f"{self.root}/_staging"
        return f"{base.rstrip('/')}/starling-staging/{run_id}"

    def append_dim(self, name: str, batch: DataFrame) -> None:
        batch.write.mode("append").parquet(self.path(name))

    def append_fact(self, name: str, batch: DataFrame) -> None:
        """Append partitioned by month of date_key.

        The REBALANCE hint hashes rows on the month, so each task writes one
        partition directory, and lets AQE size the output at runtime: small
        months are coalesced and an oversized (hot) month is split over several
        tasks/files.  Unlike a range repartition it needs no sampling pass, so
        the batch is computed once.
        """
        append(batch.withColumn(PARTITION_COL, F.trunc("date_key", "MM")), self.path(name), partition_by=PARTITION_COL)


def _concurrently(report: dict, names: list[str], step, workers: int) -> None:
    """Run independent steps as concurrent Spark jobs from driver threads (each timed)."""
    if workers <= 1:
        for n in names:
            _timed(report, n, lambda n=n: step(n))
        return
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = [pool.submit(_timed, report, n, lambda n=n: step(n)) for n in names]
        for f in futures:
            f.result()


def _timed(report: dict, name: str, fn):
    t0 = time.time()
    out = fn()
    report.setdefault("seconds", {})[name] = round(time.time() - t0, 3)
    return out


def build_dimensions(spark: SparkSession, domain: dict[str, DataFrame], wh: Warehouse, params: RunParams,
                     run_id: str, report: dict) -> dict[str, DataFrame]:
    rm = domain.get("region_map")
    builders = {
        "dim_date": lambda ex: dims.dim_date(spark, domain.get("policies"), params, ex),
        "dim_policy_type": lambda ex: dims.dim_policy_type(domain["policies"], ex),
        "dim_county": lambda ex: dims.dim_county(domain["customers"], ex),
        "dim_claim_status": lambda ex: dims.dim_claim_status(spark, ex),
        "dim_customer": lambda ex: dims.dim_customer(domain["customers"], params, rm, ex),
        "dim_agent": lambda ex: dims.dim_agent(domain["agents"], rm, ex),
    }
    def step(name):
        existing = wh.existing(name)
        new = conform(builders[name](existing), STAR[name])
        batch = wh.stage(name, new, run_id)
        n = batch.count()
        if n:
            wh.append_dim(name, batch)
        report.setdefault("appended", {})[name] = n

    _concurrently(report, DIM_ORDER, step, params.parallel_steps)
    return {name: wh.read(name) for name in DIM_ORDER}


def build_facts(spark: SparkSession, domain: dict[str, DataFrame], wh: Warehouse, params: RunParams,
                run_id: str, report: dict, dim_tables: dict[str, DataFrame],
                lake_root: str | None = None, snapshot_ts=None, mirror_root: str | None = None) -> None:
    # stored dimensions have file statistics: the planner's size check decides broadcasts
    star = Star(spark, domain, dataclasses.replace(params, broadcast_max_rows=None), dim_tables)
    star.observations["fact_payments"] = Observation(f"payments-{run_id}")
    for name in FACT_ORDER:  # define the (lazy) plans on this thread
        star.table(name)
    mirror = None if mirror_root is None else Mirror(spark, mirror_root, CONTRACTS)

    def step(name):
        batch = None
        if lake_root is None and not path_exists(spark, wh.path(name)):
            # initial load, no snapshot: nothing to reconcile against, so the one
            # build is appended directly and counted from the written files
            wh.append_fact(name, star.table(name))
            n = built = wh.read(name).count()
        else:
            # the fact is built exactly once: its candidate rows are staged first
            candidates = wh.stage(f"{name}_candidates", star.table(name), run_id)
            built = candidates.count()
            batch = candidates
            if path_exists(spark, wh.path(name)):
                batch = wh.stage(name, only_new_rows(candidates, wh.existing_keys(name), FACT_KEYS[name]), run_id)
            n = batch.count()
            if lake_root is not None:
                write_snapshot(batch, lake_root, name, snapshot_ts)
            if n:
                wh.append_fact(name, batch)
        report.setdefault("appended", {})[name] = n
        report.setdefault("kept", {})[name] = built
        report.setdefault("already_stored", {})[name] = built - n
        if name in star.observations:
            report.setdefault("dropped", {})[name] = dropped_rows(star, name, built)
        if mirror is not None:
            stored = wh.existing(name)
            report.setdefault("mirrored", {})[name] = mirror.follow(name, stored, batch, FACT_KEYS[name], run_id)

    _concurrently(report, FACT_ORDER, step, params.parallel_steps)


def dropped_rows(star: Star, name: str, built: int) -> int:
    """Rows that the build of ``name`` left out, as observed while its rows were written."""
    seen = star.observations[name].get
    if seen["read"] - seen["dropped"] == built:
        dropped = seen["dropped"]
    else:   # tasks ran twice after a loss, and were counted twice: count what was left out
        dropped = split_payments(star.payment_rows, star.dim_date)[1].count()
    if dropped:
        LOG.warning("%s: %d of %d rows dropped, their dates are not in dim_date", name, dropped, built + dropped)
    return dropped


def data_quality(star: Star) -> dict[str, list[dict]]:
    """All DQ results; each is at most a handful of rows (one per rule)."""
    out = {}
    for name, q in [("dq_sales", checks.dq_sales), ("dq_claims", checks.dq_claims),
                    ("dq_payments", checks.dq_payments), ("lookup_misses", checks.lookup_misses)]:
        out[name] = [r.asDict() for r in q(star).collect()]
    return out


def verification(star: Star) -> dict[str, dict]:
    return {name: q(star).first().asDict()
            for name, q in [("verify_sales", checks.verify_sales), ("reconcile_claims", checks.reconcile_claims),
                            ("verify_payments", checks.verify_payments)]}


def run(spark: SparkSession, domain: dict[str, DataFrame], root: str, params: RunParams | None = None,
        lake_root: str | None = None, with_checks: bool = True, mirror_root: str | None = None) -> dict:
    """Full, re-runnable load of the star schema under ``root``; returns a run report.

    Per fact it tells the rows kept by the build, already stored, and appended; for payments also those
    dropped for their dates; and, with ``mirror_root``, the rows that the mirror step appended there.
    """
    params = params or RunParams()
    run_id = uuid.uuid4().hex[:12]  # names this run's staging folder only; no data depends on it
    wh = Warehouse(spark, root)
    report: dict = {"run_id": run_id}
    require_rows(domain["policies"], "policies")  # one-row probe, not a count
    if with_checks:
        pre = Star(spark, domain, params)
        report["dq"] = _timed(report, "dq", lambda: data_quality(pre))
    dim_tables = build_dimensions(spark, domain, wh, params, run_id, report)
    build_facts(spark, domain, wh, params, run_id, report, dim_tables, lake_root, params.load_ts, mirror_root)
    if with_checks:
        star = stored_star(spark, root, params, domain)
        report["verify"] = _timed(report, "verify", lambda: verification(star))
    remove_path(spark, wh.staging(run_id))      # all of it is in the tables now
    return report


def stored_star(spark: SparkSession, root: str, params: RunParams | None = None,
                domain: dict[str, DataFrame] | None = None) -> Star:
    """The star schema as stored under ``root`` (for analytics over written tables)."""
    wh = Warehouse(spark, root)
    tables = {name: wh.read(name) for name in DIM_ORDER + FACT_ORDER}
    return Star.from_tables(spark, tables, params or RunParams(), domain, stored=True)
