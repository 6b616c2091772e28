"""Where the raw tables live: one database, its folder, and the per-run staging area next to it."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendmill import files
from spendmill.operators.incremental import DateWindow
from spendmill.operators.schemas import require_same
from spendmill.operators.slices import account_days, expire_commits, finish_commits, partition_dates, table_folder
from spendmill.plans.spec import ReportSpec


@dataclass(frozen=True)
class Run:
    """One run of the loads: one date and one clock reading for all of its tables, in UTC.

    A retry passes the `run_id` of the interrupted run and `resumes=True`.
    """

    run_date: date
    ingested_at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    run_id: str = field(default_factory=lambda: uuid4().hex)
    resumes: bool = False


OUTCOMES_DDL = (
    "requested_account string, row_count bigint, null_dates bigint, broken_rows bigint, unanswered boolean, "
    "failed boolean, violation string, recorded_at timestamp, run_id string, report string"
)
LEDGER_DDL = "run_id string, report string, event string, window_start date, window_end date, recorded_at timestamp"
REQUESTS_DDL = "requested_account string, slice_start date, slice_end date, loaded boolean, run_id string"


def _nanoseconds(moment: datetime) -> int:
    return int(moment.replace(tzinfo=moment.tzinfo or timezone.utc).timestamp() * 1e9)


class Store:
    """Raw tables of one database. `root` has to be a folder that all executors share."""

    def __init__(self, spark: SparkSession, database: str, root: str):
        self.spark = spark
        self.database = database
        self.root = root.rstrip("/")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root}/tables'")

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, spec: ReportSpec) -> DataFrame:
        """The table with its columns in declared order."""
        return self.spark.table(self.name(spec.table)).select(*spec.columns)

    def create_fact(self, spec: ReportSpec) -> None:
        """Date-partitioned table from the declared schema; one that is there has to have that schema.

        A replace that was cut off in an earlier run is finished, so that the newest date is right.
        """
        if self.exists(spec.table):
            self.require_schema(spec)
            finish_commits(self.spark, self.name(spec.table))
            return
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(spec.table)} ({spec.output_ddl}) USING parquet PARTITIONED BY (date)"
        )

    def require_schema(self, spec: ReportSpec) -> None:
        """The stored table holds exactly the declared columns with their types (`SchemaMismatch` otherwise).

        A report that gained a column has to have its table changed first: nothing is dropped and nothing is added unseen.
        """
        if self.exists(spec.table):
            name = self.name(spec.table)
            require_same(f"{name}: stored table", spec.output_schema, self.spark.table(name).schema)

    def last_date(self, table: str) -> date | None:
        """Newest loaded date; a table that does not exist yet counts as empty, any other error is raised."""
        if not self.exists(table):
            return None
        return max(partition_dates(self.spark, self.name(table)), default=None)

    def account_days(self, table: str) -> DataFrame:
        """Rows per account and date of a fact, as its commits noted them; high-water marks come from this."""
        return account_days(self.spark, self.name(table))

    def point_to(self, spec: ReportSpec, location: str) -> None:
        """Let a full-refresh table show another version folder: readers see the old or the new version, never half."""
        table = self.name(spec.table)
        if self.exists(spec.table):
            self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
            self.spark.catalog.refreshTable(table)
        else:
            self.spark.sql(f"CREATE TABLE {table} ({spec.output_ddl}) USING parquet LOCATION '{location}'")

    def new_version_path(self, table: str) -> str:
        """A folder no reader uses yet, also when a run is repeated; names sort by time."""
        return f"{self.root}/versions/{table}/{time.time_ns():020d}-{uuid4().hex}"

    def expire(self, spec: ReportSpec, before: datetime, keep: int = 2) -> int:
        """Delete what no reader needs that began after `before`. Returns how many folders were deleted.

        Of a full-refresh table, versions written before that time go, but never the current one nor the newest `keep`. Of a
        fact, the files of dates go that a later commit replaced before that time.
        """
        if not self.exists(spec.table):
            return 0
        if spec.is_fact:
            return expire_commits(self.spark, self.name(spec.table), before)
        base = f"{self.root}/versions/{spec.table}"
        current = table_folder(self.spark, self.name(spec.table)).rsplit("/", 1)[1]
        cutoff = f"{_nanoseconds(before):020d}"
        versions = files.children(self.spark, base)
        old = [name for name in versions[: max(0, len(versions) - keep)] if name != current and name < cutoff]
        for name in old:
            files.delete(self.spark, f"{base}/{name}")
        return len(old)

    def expire_runs(self, before: datetime) -> int:
        """Delete the staged rows of runs that committed all their facts before the given time. Returns how many.

        Ledger, request log and account outcomes stay. A run that was cut off stays too: its retry reads what it staged.
        """
        ledger = self.ledger()
        if ledger is None:
            return 0
        reports = ledger.groupBy("run_id", "report").agg(
            F.max("recorded_at").alias("at"), F.count_if(F.col("event") == "committed").alias("committed")
        )
        runs = (
            reports.groupBy("run_id")
            .agg(F.min("committed").alias("committed"), F.max("at").alias("at"))
            .where((F.col("committed") > 0) & (F.col("at") < F.lit(before)))
        )
        deleted = 0
        for row in runs.select("run_id").toLocalIterator():
            folder = f"{self.root}/runs/{row['run_id']}"
            if files.exists(self.spark, folder):
                files.delete(self.spark, folder)
                deleted += 1
        return deleted

    # Stored intermediate results: they cut lineage, survive lost executors, and have a known size.

    def run_path(self, run: Run, table: str, part: str) -> str:
        return f"{self.root}/runs/{run.run_id}/{table}/{part}"

    def stage(
        self, rows: DataFrame, run: Run, table: str, part: str, partition_by: tuple[str, ...] = ()
    ) -> DataFrame:
        path = self.run_path(run, table, part)
        rows.write.mode("overwrite").parquet(path, partitionBy=list(partition_by) or None)
        return self.spark.read.schema(rows.schema).parquet(path)

    def staged(self, run: Run, table: str, part: str) -> DataFrame | None:
        """What the run stored under this name, if that write came to its end."""
        path = self.run_path(run, table, part)
        return self._read_if_written(path) if self._complete(path) else None

    def _complete(self, path: str) -> bool:
        return files.exists(self.spark, f"{path}/_SUCCESS")

    def _read_if_written(self, path: str, ddl: str | None = None) -> DataFrame | None:
        """A folder that is not there, or in which a write died before its first file, counts as not written."""
        try:
            reader = self.spark.read.schema(ddl) if ddl else self.spark.read
            return reader.parquet(path)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    # Run ledger: a retry of a run uses the window the run recorded, not one computed from a half-loaded table.

    def record(self, run: Run, table: str, event: str, window: DateWindow) -> None:
        """One small file per event, so that writers of different reports never meet."""
        entry = {
            "run_id": run.run_id,
            "report": table,
            "event": event,
            "window_start": window.start.isoformat(),
            "window_end": window.end.isoformat(),
            "recorded_at": run.ingested_at.astimezone(timezone.utc).isoformat(),
        }
        name = f"{time.time_ns():020d}-{uuid4().hex[:8]}.json"
        files.write_text(self.spark, f"{self.root}/ledger/{name}", json.dumps(entry))

    def ledger(self) -> DataFrame | None:
        written = [n for n in files.children(self.spark, f"{self.root}/ledger") if n.endswith(".json")]
        return self.spark.read.schema(LEDGER_DDL).json(f"{self.root}/ledger") if written else None

    def recorded_window(self, run: Run, table: str) -> DateWindow | None:
        ledger = self.ledger()
        if ledger is None:
            return None
        row = (
            ledger.where((F.col("run_id") == run.run_id) & (F.col("report") == table))
            .agg(F.min("window_start").alias("s"), F.max("window_end").alias("e"))
            .first()
        )
        return DateWindow(row["s"], row["e"]) if row["s"] else None

    # Run report: what became of every account, one folder per run and report, written again when a run is repeated.

    def outcomes_path(self, run_id: str | None = None) -> str:
        return f"{self.root}/outcomes" + (f"/run_id={run_id}" if run_id else "")

    def record_outcomes(self, run: Run, table: str, outcomes: DataFrame) -> None:
        rows = outcomes.withColumn("recorded_at", F.lit(run.ingested_at))
        rows.write.mode("overwrite").parquet(f"{self.outcomes_path(run.run_id)}/report={table}")

    def outcomes(self) -> DataFrame | None:
        """Account outcomes of all runs: `run_id` and `report` are partitions, so one run reads its own files only."""
        return self._read_if_written(self.outcomes_path(), OUTCOMES_DDL)

    # Request log of all runs, by which holes are found that are older than the lookback.

    def log_requests(self, run: Run, table: str, requests: DataFrame) -> None:
        rows = requests.select("requested_account", "slice_start", "slice_end", "loaded")
        rows.write.mode("overwrite").parquet(f"{self.root}/requests/{table}/run_id={run.run_id}")

    def logged_requests(self, table: str) -> DataFrame | None:
        return self._read_if_written(f"{self.root}/requests/{table}", REQUESTS_DDL)
