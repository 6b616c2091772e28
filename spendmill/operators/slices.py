"""Slice replace on a date-partitioned table: delete (account, dates), insert the batch, date by date in one step each.

New rows are written to a folder of their own; a commit record names the dates; then every date's partition is pointed to its
new folder. A reader sees the old or the new rows of a date, and a commit that was cut off is finished by the next one.
"""

from __future__ import annotations

import json
import time
from datetime import date, datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from spendmill import files
from spendmill.operators.incremental import DateWindow
from spendmill.operators.schemas import require_same, storable
from spendmill.session import scoped_conf

ROWS_PER_TASK = 1_000_000
# Row number within a stored file: it tells equal rows apart, the same way in every attempt of a task.
SPREAD = "_spread"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Folder of the commits below the table's own folder; the underscore hides it from file listings.
COMMITS = "_commits"
# Folder of a commit's rows per account and date.
MARKS = "marks"


def partition_dates(spark: SparkSession, table: str) -> set[date]:
    """Partition dates of a table, from the catalog alone: no file is listed or opened."""
    values = [row["partition"].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return {date.fromisoformat(value) for value in values if value != NULL_PARTITION}


def with_spread(stored: DataFrame) -> DataFrame:
    return stored.withColumn(SPREAD, F.col("_metadata.row_index"))


def _slices(scope: DataFrame) -> tuple[DataFrame, Column]:
    slices = scope.select(F.col("account_id").alias("_account"), "slice_start", "slice_end")
    covered = (F.col("account_id") == F.col("_account")) & F.col("date").between(
        F.col("slice_start"), F.col("slice_end")
    )
    return slices, covered


def _against_scope(target: DataFrame, scope: DataFrame, how: str) -> DataFrame:
    slices, covered = _slices(scope)
    return target.join(slices, covered, how)


def rows_outside_scope(target: DataFrame, scope: DataFrame) -> DataFrame:
    """Target rows that no scope slice (`account_id`, `slice_start`, `slice_end`) covers."""
    return _against_scope(target, scope, "left_anti")


def rows_in_scope(target: DataFrame, scope: DataFrame) -> DataFrame:
    """Target rows that a scope slice covers."""
    return _against_scope(target, scope, "left_semi")


def rows_by_date(rows: DataFrame, scope: DataFrame) -> dict[date | None, tuple[int, int]]:
    """Rows per date inside and outside the scope: one job, reduced to accounts and days before the scope is joined.

    What reaches the driver is one row per calendar day.
    """
    days = rows.groupBy("account_id", "date").agg(F.count(F.lit(1)).alias("n"))
    slices, covered = _slices(scope)
    # An account may have several slices, which may overlap.
    judged = (
        days.join(slices, covered, "left")
        .groupBy("account_id", "date")
        .agg(F.max("n").alias("n"), F.count("_account").alias("slices"))
    )
    inside = F.col("slices") > 0
    per_date = judged.groupBy("date").agg(
        F.sum(F.when(inside, F.col("n")).otherwise(0)).alias("inside"),
        F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outside"),
    )
    return {r["date"]: (r["inside"], r["outside"]) for r in per_date.collect()}


# Commits.


def table_folder(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return described.first()["data_type"].rstrip("/")


def _commit_folders(spark: SparkSession, base: str) -> list[str]:
    """Folders of the table's recorded commits, oldest first: their names begin with a time."""
    base = f"{base}/{COMMITS}"
    folders = [f"{base}/{name}" for name in files.children(spark, base)]
    return [folder for folder in folders if files.exists(spark, f"{folder}/record.json")]


def _apply_commit(spark: SparkSession, table: str, folder: str, record: dict[str, list[str]]) -> None:
    """Point every date of a commit to the commit's files. Doing it again changes nothing."""
    current = {day.isoformat() for day in partition_dates(spark, table)}
    emptied = [day for day in record["emptied"] if day in current]
    for day in emptied:
        # Dropping a partition may delete its folder: a reader of the old rows keeps its files this way.
        nothing = f"{folder}/emptied/date={day}"
        files.make_folder(spark, nothing)
        spark.sql(f"ALTER TABLE {table} PARTITION (date = DATE'{day}') SET LOCATION '{nothing}'")
    if emptied:
        drops = ", ".join(f"PARTITION (date = DATE'{day}')" for day in emptied)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {drops}")
    # Sizes are not kept per partition; without this every statement would list the whole table for them.
    with scoped_conf(spark, spark__sql__statistics__size__autoUpdate__enabled="false"):
        new = [day for day in record["dates"] if day not in current]
        if new:
            added = " ".join(f"PARTITION (date = DATE'{day}') LOCATION '{folder}/rows/date={day}'" for day in new)
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
        for day in record["dates"]:
            if day in current:
                spark.sql(
                    f"ALTER TABLE {table} PARTITION (date = DATE'{day}') SET LOCATION '{folder}/rows/date={day}'"
                )
    spark.catalog.refreshTable(table)
    files.write_text(spark, f"{folder}/applied", "")


def finish_commits(spark: SparkSession, table: str, base: str | None = None) -> int:
    """Apply commits that were recorded and then cut off, oldest first. Returns how many there were.

    `base` saves looking up the table's folder.
    """
    folders = _commit_folders(spark, base or table_folder(spark, table))
    cut_off = [f for f in folders if not files.exists(spark, f"{f}/applied")]
    for folder in cut_off:
        _apply_commit(spark, table, folder, json.loads(files.read_text(spark, f"{folder}/record.json")))
    return len(cut_off)


def expire_commits(spark: SparkSession, table: str, before: datetime) -> int:
    """Delete dates of commits that a later commit replaced before the given time. Returns how many were deleted.

    A reader that began after that time, or reads the current rows, finds all its files.
    """
    finish_commits(spark, table)
    cutoff = f"{int(before.replace(tzinfo=before.tzinfo or timezone.utc).timestamp() * 1e9):020d}"
    replaced: set[str] = set()
    deleted = 0
    for folder in reversed(_commit_folders(spark, table_folder(spark, table))):
        record = json.loads(files.read_text(spark, f"{folder}/record.json"))
        for day in record["dates"]:
            path = f"{folder}/rows/date={day}"
            if day in replaced and files.exists(spark, path):
                files.delete(spark, path)
                deleted += 1
        if folder.rsplit("/", 1)[1] < cutoff:
            replaced.update(record["dates"], record["emptied"])
    return deleted


# Marks: rows per account and date, written with every commit.


def _marks_schema(stored: StructType) -> StructType:
    return StructType([stored["account_id"], stored["date"], StructField("n", LongType())])


def _count_days(spark: SparkSession, folder: str, stored: StructType) -> None:
    """Note beside a commit's files how many rows each account has on each date. One column is read, sums leave the tasks."""
    written = spark.read.schema(StructType([stored["account_id"], stored["date"]])).parquet(f"{folder}/rows")
    days = written.groupBy("account_id", "date").agg(F.count(F.lit(1)).alias("n"))
    days.write.mode("overwrite").parquet(f"{folder}/{MARKS}")


def _live_dates(spark: SparkSession, folders: list[str]) -> dict[str, list[date]]:
    """Which dates still show the files of which commit: the last commit that touched a date decides. One entry per date."""
    if not folders:
        return {}
    records = spark.read.schema("dates array<string>, emptied array<string>").json([f"{f}/record.json" for f in folders])
    commit = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("commit")
    kept = records.select(commit, F.lit(True).alias("kept"), F.explode("dates").alias("day"))
    touched = kept.unionByName(records.select(commit, F.lit(False).alias("kept"), F.explode("emptied").alias("day")))
    last = touched.groupBy("day").agg(F.max(F.struct("commit", "kept")).alias("last"))
    live: dict[str, list[date]] = {}
    for row in last.where("last.kept").select("day", "last.commit").collect():
        live.setdefault(row["commit"], []).append(date.fromisoformat(row["day"]))
    return live


def account_days(spark: SparkSession, table: str) -> DataFrame:
    """Rows per account and date of a table (`account_id`, `date`, `n`), from the counts that its commits wrote down.

    No file of the table is opened: of every commit that some date still shows, the counts of those dates are read. Where there
    are none, they are made again: a commit without counts is counted once and keeps them, a date that no commit wrote is
    counted from the table. A commit is there with its counts or not at all, so they are never behind the table. An empty
    table gives no rows; rows without an account count as one account that is null.
    """
    base = table_folder(spark, table)
    finish_commits(spark, table, base)
    stored = spark.table(table).schema
    present = partition_dates(spark, table)
    live = _live_dates(spark, _commit_folders(spark, base))
    live = {commit: shown for commit, days in live.items() if (shown := sorted(present.intersection(days)))}
    uncounted = present.difference(*live.values())
    outside = spark.table(table).where(F.col("date").isin(sorted(uncounted)) if uncounted else F.lit(False))
    counted = outside.groupBy("account_id", "date").agg(F.count(F.lit(1)).alias("n"))
    if not live:
        return counted
    folders = {commit: f"{base}/{COMMITS}/{commit}" for commit in live}
    for folder in folders.values():
        if not files.exists(spark, f"{folder}/{MARKS}/_SUCCESS"):
            _count_days(spark, folder, stored)
    marks = spark.read.schema(_marks_schema(stored)).parquet(*[f"{folder}/{MARKS}" for folder in folders.values()])
    # One row per calendar day; its size is known to Catalyst.
    shown = spark.createDataFrame([(c, d) for c, days in live.items() for d in days], "_commit string, date date")
    marks = marks.withColumn("_commit", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -3))
    current = marks.join(shown, ["_commit", "date"], "left_semi").select("account_id", "date", "n")
    return current.unionByName(counted) if uncounted else current


def replace_slices(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    scope: DataFrame,
    window: DateWindow,
    cluster_by: tuple[str, ...] = (),
    batch_rows: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> list[date]:
    """Make the table hold, in the window, the batch plus all rows outside the scope. Returns the dates dropped.

    `batch` and `scope` have to come from stored (staged) frames, not from `table`: both are read more than once, and
    a stored scope has a known size, by which Catalyst decides whether to broadcast it. A batch that is more than a
    stored frame has to bring its `SPREAD` column along (`with_spread`). `batch_rows` saves counting it.

    The batch has to have the columns of the table, no more and no fewer, with types that fit (`SchemaMismatch`). A row
    without a date, outside the window or outside the scope is an error. All of that is raised before anything is written.

    Only dates that the batch or the scope touches get new files. They are written beside the old ones and named in a commit
    record, with their rows per account (`account_days`); then dates that end up empty are dropped and each other date is pointed to its new files, one catalog change a
    date. Readers see the old or the new rows of a date. If the driver dies on the way, `finish_commits`, which every replace
    calls first, goes on from the record. Old files stay until `expire_commits`. One writer per table is assumed. Lists
    that reach the driver are calendar days of the window, never rows.
    """
    base = table_folder(spark, table)
    finish_commits(spark, table, base)
    stored = spark.table(table).schema
    require_same(f"{table}: batch", stored, batch.drop(SPREAD).schema, storable)
    columns = stored.names
    arriving = rows_by_date(batch.select("account_id", "date"), scope)
    strays = sorted(str(day) for day in arriving if day is None or not window.start <= day <= window.end)
    if strays:
        raise ValueError(f"{table}: batch has rows outside {window.start}..{window.end}: {', '.join(strays)}")
    if any(outside for _, outside in arriving.values()):
        raise ValueError(f"{table}: batch has rows outside its scope")

    def target(dates: set[date]) -> DataFrame:
        return spark.table(table).where(window.contains("date") & F.col("date").isin(sorted(dates)))

    existing = {day for day in partition_dates(spark, table) if window.start <= day <= window.end}
    silent = existing - set(arriving)
    held = rows_by_date(target(silent).select("account_id", "date"), scope) if silent else {}
    # A silent date loses rows only if the scope covers some; it goes if nothing else is left.
    emptied = sorted(day for day in silent if held.get(day, (0, 0))[1] == 0)
    remaining = {day for day in existing if day in arriving or (day in held and all(held[day]))}

    rows = (batch if SPREAD in batch.columns else with_spread(batch)).select(*columns, SPREAD)
    total = sum(inside for inside, _ in arriving.values()) if batch_rows is None else batch_rows
    if remaining:
        # A count by partition comes from Parquet footers.
        total += target(remaining).count()
        kept = rows_outside_scope(with_spread(target(remaining)), scope)
        rows = kept.select(*columns, SPREAD).unionByName(rows)
    dates = sorted(set(arriving) | remaining)
    if not dates and not emptied:
        return emptied

    folder = f"{base}/{COMMITS}/{time.time_ns():020d}-{uuid4().hex[:8]}"
    if dates:
        # Range partitioning keeps dates and clustering keys together, so few files per date and narrow min/max
        # statistics. The row number makes keys distinct: no account, and no group of equal rows, is too big to split.
        tasks = max(-(-total // rows_per_task), min(len(dates), int(spark.conf.get("spark.sql.shuffle.partitions"))))
        laid_out = (
            rows.repartitionByRange(tasks, "date", *cluster_by, SPREAD)
            .sortWithinPartitions("date", *cluster_by)
            .select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stored])
        )
        laid_out.write.partitionBy("date").parquet(f"{folder}/rows")
        _count_days(spark, folder, stored)
    record = {"dates": [day.isoformat() for day in dates], "emptied": [day.isoformat() for day in emptied]}
    files.write_text(spark, f"{folder}/record.json", json.dumps(record))
    _apply_commit(spark, table, folder, record)
    return emptied
