"""Running sources: one read, raw layer + typed table, one audit row (P4, P8–P10, F2, K9).

Per source::

    read (lazy) ──write──▶ raw/<source>/load_id=<stamp>   (the only read of the source)
                              │ read back, explicit schema
                              ▼
          REST: normalize ──stage──▶ staging/<source>/load_id=<stamp>  (parse once, observe schema)
                              │ typed projection
                              ▼
                     catalog table (create / append / replace)
                              ▼
                        audit row ──▶ audit table

The raw layer is both the reference's raw output and the durable copy the
table is built from: the source is fetched once, and a lost executor re-reads
files, never the source.
"""

from __future__ import annotations

import datetime as _dt
import logging
import threading
import traceback
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.text import raw_load_stamp
from tributary.operators.normalize import normalize
from tributary.plans.schedules import due
from tributary.plans.specs import PipelineSpec, SourceSpec, table_name_for
from tributary.session import delete_path, shared_root
from tributary.sinks.lattice import load_widening
from tributary.sinks.raw import add_raw_responses, latest_load, read_raw, write_raw, write_raw_responses
from tributary.sinks.table import SKIPPED, delta_available, table_known, table_owner, write_table
from tributary.sources import RestSource, source_for
from tributary.sources.requests import missing_requests, settled
from tributary.sources.rest import response_struct

log = logging.getLogger(__name__)

AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("job_name", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("finished_at", T.TimestampType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("rows_written", T.LongType()),
    T.StructField("error", T.StringType()),
    T.StructField("failed_requests", T.LongType()),
])
#: PARTIAL: data was loaded, but some requests failed (only a PERMISSIVE source goes on then).
SUCCESS, PARTIAL, FAILURE = "SUCCESS", "PARTIAL", "FAILURE"
AUDIT_OWNER = "(run audit)"
#: ``on_mismatch`` of a runner whose tables keep all loads and widen (``sinks.lattice``).
WIDEN = "widen"


@dataclass
class RunResult:
    run_id: str
    job_name: str
    source: str
    status: str
    started_at: _dt.datetime
    finished_at: _dt.datetime
    rows_read: int
    rows_written: int
    error: str | None
    table: str | None = None
    table_action: str | None = None
    load_id: str | None = None
    failed_requests: int = 0
    audited: bool = True  # False: the audit row could not be written (see the log)

    def audit_row(self) -> tuple:
        return (self.run_id, self.job_name, self.source, self.status, self.started_at,
                self.finished_at, self.rows_read, self.rows_written, self.error, self.failed_requests)


def _short_message(e: Exception) -> str:
    """One line for the audit table: the Python error raised in a worker, else the first line."""
    lines = [ln.strip() for ln in str(e).splitlines() if ln.strip()]
    if not lines:
        return ""
    if "Python worker" in lines[0]:
        worker = [ln for ln in lines if ln.split(":", 1)[0].endswith(("Error", "Exception"))]
        return worker[-1] if worker else lines[-1]
    return lines[0]


class Runner:
    """Runs sources against one output root and one catalog database."""

    def __init__(self, spark: SparkSession, output_root: str | None = None, *,
                 table_format: str = "parquet", table_prefix: str = "",
                 audit_table: str = "ingest_runs", on_mismatch: str = "replace",
                 schema: str = "first_record", mode: str = "FAILFAST",
                 parallel_sources: int = 1, keep_staging: bool = False) -> None:
        self.spark = spark
        self.root = (output_root or f"{shared_root(spark)}/output").rstrip("/")
        self.table_format = table_format
        self.table_prefix = table_prefix
        self.audit_table = audit_table
        self.on_mismatch = on_mismatch
        self.schema = schema
        self.mode = mode
        self.parallel_sources = max(1, int(parallel_sources))
        self.keep_staging = keep_staging
        if table_format == "delta" and not delta_available(spark):
            raise RuntimeError("table_format='delta' needs the Delta Lake package on the classpath")
        self._audit_lock = threading.Lock()
        self._tables: dict[str, str] = {}

    # -- one source -------------------------------------------------------
    def _load(self, spec: SourceSpec, connector, load_id: str) -> tuple[int, DataFrame, int, int]:
        """Fetch once into the raw layer; return (rows read, DataFrame for the table,
        its row count, failed requests)."""
        obs = Observation(f"read_{uuid.uuid4().hex[:8]}")
        if isinstance(connector, RestSource):
            # every response is logged, failed ones with their status and error
            responses = connector.read(self.spark, load_id).observe(
                obs, F.count(F.lit(1)).alias("n"), F.count_if(F.col("error").isNotNull()).alias("failed"))
            write_raw_responses(responses, self.root, spec.name, load_id)
            raw = read_raw(self.spark, self.root, spec.name, response_struct(), load_id)
            mode = str(spec.connection.get("mode", self.mode)).upper()
            staging = self._staging_path(spec, load_id)
            stats: dict = {}
            shaped = normalize(raw, schema=spec.connection.get("schema", self.schema), mode=mode,
                               staging=staging, stats=stats)
            seen = obs.get or {}
            return int(seen.get("n", 0)), shaped, stats.get("records", 0), int(seen.get("failed", 0))
        else:
            df = connector.read(self.spark)
            write_raw(df.observe(obs, F.count(F.lit(1)).alias("n")), self.root, spec.name, load_id)
            shaped = read_raw(self.spark, self.root, spec.name, df.schema, load_id)
        rows = int((obs.get or {}).get("n", 0))
        return rows, shaped, rows, 0

    def _write(self, shaped: DataFrame, table: str, owner: str, load_id: str, rows: int):
        if self.on_mismatch == WIDEN:
            return load_widening(shaped, table, load_id, path=self._table_path(table), owner=owner)
        return write_table(shaped, table, fmt=self.table_format, known_rows=rows, path=self._table_path(table),
                           on_mismatch=self.on_mismatch, owner=owner)

    def _claim(self, table: str, source: str) -> None:
        """Refuses a source whose name gives the table of another: it would replace its rows.

        The audit table is reserved. Owners are kept with the tables, so this holds for
        other runners and later sessions too.
        """
        if table.lower() == self.audit_table.lower():
            raise ValueError(f"source {source!r} would write the audit table {table!r}; rename one")
        with self._audit_lock:
            owner = self._tables.setdefault(table, source)
        if owner == source:
            owner = table_owner(self.spark, table, self._table_path(table)) or source
        if owner != source:
            raise ValueError(f"sources {owner!r} and {source!r} would share table {table!r}; rename one")

    def _table_path(self, table: str) -> str:
        return f"{self.root}/tables/{table}"

    def _staging_path(self, spec: SourceSpec, load_id: str) -> str:
        return f"{self.root}/staging/{spec.name}/load_id={load_id}"

    def run_source(self, spec: SourceSpec) -> RunResult:
        self.spark.sparkContext.setJobDescription(f"tributary {spec.job_name}")
        started = _dt.datetime.now(_dt.timezone.utc)
        run_id, load_id = uuid.uuid4().hex, raw_load_stamp()
        table = table_name_for(spec.name, self.table_prefix)
        rows_read = rows_written = failed = 0
        action, status, error = None, SUCCESS, None
        try:
            self._claim(table, spec.name)
            connector = source_for(spec)
            rows_read, shaped, rows_shaped, failed = self._load(spec, connector, load_id)
            if rows_read == 0 or rows_shaped == 0:
                action = SKIPPED
            else:
                load = self._write(shaped, table, spec.name, load_id, rows_shaped)
                action, rows_written = load.action, load.rows
            if failed:
                status = PARTIAL if rows_written else FAILURE
                error = f"{failed} of {rows_read} requests failed"
        except Exception as e:  # noqa: BLE001 - a failing source must not stop the others
            status = FAILURE
            error = f"{type(e).__name__}: {_short_message(e)}"
            log.error("source %s failed: %s\n%s", spec.name, error, traceback.format_exc())
        self._drop_staging(spec, load_id)
        finished = _dt.datetime.now(_dt.timezone.utc)
        result = RunResult(run_id, spec.job_name, spec.name, status, started, finished,
                           rows_read, rows_written, error, table, action, load_id, failed)
        self._try_record(result)
        self.spark.sparkContext.setJobDescription(None)
        return result

    def _drop_staging(self, spec: SourceSpec, load_id: str) -> None:
        """Drops a load's staged records: the raw layer stays the durable copy."""
        if self.keep_staging:
            return
        try:
            delete_path(self.spark, self._staging_path(spec, load_id))
        except Exception as e:  # noqa: BLE001 - left files cost space, not the run
            log.error("staging of %s stays: %s", spec.name, e)

    def _try_record(self, result: RunResult) -> None:
        """Writes the audit row; a failure there is logged and does not stop later sources."""
        try:
            self.record(result)
        except Exception as e:  # noqa: BLE001
            result.audited = False
            log.error("run %s of %s is not in %s: %s\n%s", result.run_id, result.source, self.audit_table, e,
                      traceback.format_exc())

    def run_due(self, pipeline: PipelineSpec, start: _dt.datetime, stop: _dt.datetime) -> list[RunResult]:
        """Runs the scheduled sources of a pipeline that are due at some minute from ``start`` up to
        before ``stop``, once each, in the pipeline's order."""
        scheduled = [s for s in pipeline.sources if s.schedule]
        if not scheduled:
            return []
        rows = self.spark.createDataFrame([(k, s.schedule) for k, s in enumerate(scheduled)], "k int, schedule string")
        found = {r["k"] for r in due(rows, start, stop).where("n_due > 0").select("k").collect()}
        return self._run_all([s for k, s in enumerate(scheduled) if k in found])

    def run_pipeline(self, pipeline: PipelineSpec, *, include_scheduled: bool = False) -> list[RunResult]:
        """Run every unscheduled source (scheduled ones belong to an outside
        scheduler; ``include_scheduled`` runs them too), isolating failures.

        With ``parallel_sources > 1`` that many sources run at once (Spark
        schedules their jobs side by side); results keep the pipeline's order.
        """
        return self._run_all(list(pipeline.sources) if include_scheduled else pipeline.unscheduled())

    def _run_all(self, specs: list[SourceSpec]) -> list[RunResult]:
        if self.parallel_sources == 1 or len(specs) < 2:
            return [self.run_source(s) for s in specs]
        with ThreadPoolExecutor(max_workers=self.parallel_sources) as pool:
            return list(pool.map(self.run_source, specs))

    # -- repair -----------------------------------------------------------
    def repair_source(self, spec: SourceSpec, load_id: str | None = None) -> RunResult:
        """Sends a load's failed and unsent requests again and completes load and table.

        ``load_id`` defaults to the source's latest load. The plan's requests without a good
        response in the raw layer are sent, each once; the responses are written to the
        staging folder, added to the load's raw folder, and the good ones are appended to
        the table with the table's own columns (a value that does not fit raises, and the
        raw layer keeps it). Without a table yet, the whole load is shaped. A load without
        missing requests sends nothing. Like a run, a repair that dies between the append
        and its audit row may append twice when it is started again; one that dies before
        has changed no table.
        """
        self.spark.sparkContext.setJobDescription(f"tributary {spec.job_name} repair")
        started, run_id = _dt.datetime.now(_dt.timezone.utc), uuid.uuid4().hex
        table = table_name_for(spec.name, self.table_prefix)
        sent = rows_written = still = 0
        action, status, error = SKIPPED, SUCCESS, None
        try:
            self._claim(table, spec.name)
            connector = source_for(spec)
            if not isinstance(connector, RestSource):
                raise ValueError(f"source {spec.name!r} has no requests to repair")
            load_id = load_id or latest_load(self.spark, self.root, spec.name)
            if load_id is None:
                raise ValueError(f"source {spec.name!r} has no load to repair")
            staging = f"{self._staging_path(spec, load_id)}/repair-{run_id}"
            raw = read_raw(self.spark, self.root, spec.name, response_struct(), load_id)
            # written first: what is sent must not depend on the folder that it is added to
            missing_requests(connector.plan(self.spark, load_id), raw).write.parquet(f"{staging}/plan")
            plan = self.spark.read.parquet(f"{staging}/plan")
            sent = plan.count()
            if sent:
                connector.fetch(self.spark, plan, load_id).write.parquet(f"{staging}/responses")
                fetched = self.spark.read.parquet(f"{staging}/responses")
                still = fetched.where(F.col("error").isNotNull()).count()
                add_raw_responses(fetched, self.root, spec.name, load_id)
                mode = str(spec.connection.get("mode", self.mode)).upper()
                how = spec.connection.get("schema", self.schema)
                stats: dict = {}
                if self.on_mismatch != WIDEN and table_known(self.spark, table, self._table_path(table)):
                    good = fetched.where(F.col("error").isNull())
                    columns = self.spark.table(table).schema
                    shaped = normalize(good, schema=how, mode=mode, staging=f"{staging}/records", stats=stats, columns=columns)
                else:
                    whole = settled(read_raw(self.spark, self.root, spec.name, response_struct(), load_id))
                    shaped = normalize(whole, schema=how, mode=mode, staging=f"{staging}/records", stats=stats)
                if self.on_mismatch == WIDEN:  # the load's rows are written anew, as a whole
                    load = self._write(shaped, table, spec.name, load_id, stats.get("records", 0))
                else:
                    load = write_table(shaped, table, fmt=self.table_format, known_rows=stats.get("records", 0),
                                       path=self._table_path(table), on_mismatch="fail", owner=spec.name)
                action, rows_written = load.action, load.rows
            if still:
                status, error = (PARTIAL if rows_written else FAILURE), f"{still} of {sent} requests failed again"
        except Exception as e:  # noqa: BLE001 - as in run_source
            status, error = FAILURE, f"{type(e).__name__}: {_short_message(e)}"
            log.error("repair of %s failed: %s\n%s", spec.name, error, traceback.format_exc())
        if load_id is not None:
            self._drop_staging(spec, load_id)
        result = RunResult(run_id, spec.job_name, spec.name, status, started, _dt.datetime.now(_dt.timezone.utc),
                           sent, rows_written, error, table, action, load_id, still)
        self._try_record(result)
        self.spark.sparkContext.setJobDescription(None)
        return result

    # -- audit ---------------------------------------------------------
    def record(self, result: RunResult) -> None:
        """Append one audit row (serialised: the first write creates the table)."""
        row = self.spark.createDataFrame([result.audit_row()], AUDIT_SCHEMA)
        with self._audit_lock:
            write_table(row, self.audit_table, fmt=self.table_format,
                        path=self._table_path(self.audit_table), on_mismatch="fail",
                        skip_if_empty=False, owner=AUDIT_OWNER)

    def run_history(self, limit: int = 100) -> DataFrame:
        return run_history(self.spark.table(self.audit_table), limit)

    def run_status(self, limit: int = 100, job_name: str | None = None) -> DataFrame:
        """``run_id, job_name, status`` of the latest runs (of one job, if given);
        empty when nothing ran yet."""
        if not self.spark.catalog.tableExists(self.audit_table):
            return self.spark.createDataFrame([], "run_id string, job_name string, status string")
        audit = self.spark.table(self.audit_table)
        if job_name is not None:
            audit = audit.filter(F.col("job_name") == job_name)
        return run_history(audit, limit).select("run_id", "job_name", "status")


def run_history(audit: DataFrame, limit: int = 100) -> DataFrame:
    """Latest ``limit`` runs, newest first (ties broken by run id) — a top-k,
    planned as ``TakeOrderedAndProject`` (per-partition top-k, then merge)."""
    return audit.orderBy(F.desc("started_at"), F.desc("run_id")).limit(limit)


def job_summary(audit: DataFrame) -> DataFrame:
    """Per job: runs, successes, failures, rows read and written, last start."""
    return audit.groupBy("job_name").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum(F.when(F.col("status") == SUCCESS, 1).otherwise(0)).cast("bigint").alias("successes"),
        F.sum(F.when(F.col("status") == FAILURE, 1).otherwise(0)).cast("bigint").alias("failures"),
        F.sum("rows_read").alias("rows_read"),
        F.sum("rows_written").alias("rows_written"),
        F.max("started_at").alias("last_started_at"),
    )


__all__ = ["AUDIT_SCHEMA", "FAILURE", "PARTIAL", "SUCCESS", "RunResult", "Runner", "job_summary",
           "run_history", "table_name_for"]
