"""The whole of a day's run: ingestion with repeats, freshness, the decision to go on, the build, the verdict."""

from __future__ import annotations

import datetime as dt
import traceback
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.runs import append_error_log, error_count, run_summary_wide, run_verdict
from tidemark.plans.build import MarketTables, Target, build_market
from tidemark.plans.contracts import bronze_freshness
from tidemark.plans.ingest import Warehouse, ingest_run
from tidemark.quality import ContractViolation
from tidemark.schemas import ERROR_LOG, RAW_CRYPTO, RAW_FX, RAW_WEATHER, RUN_LOG
from tidemark.session import path_exists
from tidemark.sources.bronze import read_bronze

BRONZE = {"raw_weather": RAW_WEATHER, "raw_crypto": RAW_CRYPTO, "raw_fx": RAW_FX}
#: Attempts of one source and moment differ in these.
TIES = ("started_at", "task_id", "status")
BUILD_TASK = "build_market"


@dataclass(frozen=True)
class DailyRun:
    """What a run came to.

    ``verdict`` and the counts are those of the logs; ``proceeded`` says whether a build was
    begun, ``violation`` why it was not accepted, ``stale`` names the bronze tables whose
    newest row is too old. ``tables`` is None without an accepted build.
    """

    run_id: str
    proceeded: bool
    verdict: str
    success: int
    failed: int
    rows_loaded: int
    error_count: int
    freshness: dict[str, str]
    violation: str | None = None
    tables: MarketTables | None = None

    @property
    def stale(self) -> list[str]:
        return sorted(name for name, status in self.freshness.items() if status == "error")


def _log(spark: SparkSession, path: str, schema, run_id: str) -> DataFrame:
    """The rows of one run of a log that may not have been begun."""
    log = spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)
    return log.where(F.col("dag_run_id") == run_id)


def verdict_of(spark: SparkSession, warehouse: Warehouse, run_id: str) -> dict:
    """Counts, verdict and proceed flag of a run, from the stored logs: the last attempt of each source counts."""
    attempts = _log(spark, warehouse.run_log, RUN_LOG, run_id)
    errors = _log(spark, warehouse.error_log, ERROR_LOG, run_id)
    return run_verdict(run_summary_wide(attempts, TIES), error_count(errors)).first().asDict()  # one row


def daily_run(
    spark: SparkSession,
    registry: DataFrame,
    landing: DataFrame | Callable[[], DataFrame],
    warehouse: Warehouse,
    run_id: str,
    as_of: dt.datetime,
    owner: str = "daily_pipeline",
    retries: int = 3,
    mode: str = "raise",
    target: Target | None = None,
    full: bool = False,
    clustered: bool = False,
    clock: Callable[[], dt.datetime] | None = None,
    **build,
) -> DailyRun:
    """Ingest the sources of ``owner``, and build silver and gold if at least one came through.

    Sources that fail are tried up to ``retries`` times more; pass a function as
    ``landing`` to have the landing listed anew each time. Each attempt is logged. A build
    that breaks a contract or fails otherwise is logged as an error of the run, so that
    the verdict tells of it: a broken contract is returned, any other failure is raised
    again. A run without active sources does not go on. Repeating a run, or one that was
    lost at any point, neither stores a poll twice nor leaves a loaded day out: the ledger
    keeps what no accepted build has read. ``build`` takes further arguments of
    ``build_market``.
    """
    timing = {} if clock is None else {"clock": clock}
    now = clock or (lambda: dt.datetime.now(dt.timezone.utc))
    waiting = registry
    for _ in range(retries + 1):
        landed = landing() if callable(landing) else landing
        results = ingest_run(spark, waiting, owner, landed, warehouse, run_id, mode, clustered=clustered, **timing)
        lost = [r["source_name"] for r in results if r["status"] != "success"]
        if not lost:
            break
        waiting = registry.where(F.col("source_name").isin(lost))

    def bronze() -> dict[str, DataFrame]:
        return {name: read_bronze(spark, warehouse.table(f"bronze.{name}"), schema) for name, schema in BRONZE.items()}

    present = {name: df for name, df in bronze().items() if path_exists(spark, warehouse.table(f"bronze.{name}"))}
    fresh = dict.fromkeys(BRONZE, "error")  # a table without rows is too old
    if present:
        fresh.update({r["source_table"]: r["status"] for r in bronze_freshness(present, as_of).collect()})  # a row a table

    violation, tables = None, None
    proceeded = verdict_of(spark, warehouse, run_id)["proceed"]
    if proceeded:
        try:
            tables = build_market(spark, bronze, warehouse.root, as_of.date(), full=full, ledger=warehouse.changed_days, target=target, **build)
        except Exception as error:
            append_error_log(spark, warehouse.error_log, [(run_id, BUILD_TASK, None, str(error), traceback.format_exc(), now())])
            if not isinstance(error, ContractViolation):
                raise
            violation = str(error)
    said = verdict_of(spark, warehouse, run_id)
    counts = {name: said[name] for name in ("verdict", "success", "failed", "rows_loaded", "error_count")}
    return DailyRun(run_id, proceeded, freshness=fresh, violation=violation, tables=tables, **counts)
