"""The two ways a raw table is kept: incremental slice replace for facts, full refresh for dimensions."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendmill.fixed_values import EXCLUDED_ACCOUNTS, FIRST_RUN_FLOOR, LOOKBACK_DAYS, META_ACCOUNT_PREFIX
from spendmill.functions import without_prefix
from spendmill.operators.dedupe import keep_first
from spendmill.operators.incremental import (
    DateWindow,
    account_marks,
    lookback_window,
    merged_windows,
    missing_windows,
    window_of_marks,
    year_slices,
)
from spendmill.operators.isolation import (
    account_outcomes,
    account_report,
    drop_landing_columns,
    failed_accounts,
    failure_messages,
    is_failure,
    without_failed,
)
from spendmill.operators.slices import SPREAD, replace_slices, with_spread
from spendmill.plans.spec import INGESTED_AT, UNREADABLE_RECORD, VIOLATION, ReportSpec
from spendmill.plans.store import Run, Store
from spendmill.sources.accounts import attach_accounts, exclude_accounts, request_key, unique_accounts

# Folder column of a staged backfill, and the folder of rows without a readable date.
YEAR, UNDATED = "_year", 0


class LoadFailed(RuntimeError):
    """Raised after the commit when some accounts could not be loaded.

    `results` holds what the loads did, those that succeeded included; `outcomes_path` is the stored table of all account
    outcomes, which the message names as well.
    """

    def __init__(self, message: str, results: tuple[LoadResult, ...] = (), outcomes_path: str | None = None):
        super().__init__(f"{message}; all outcomes: {outcomes_path}" if outcomes_path else message)
        self.results = results
        self.outcomes_path = outcomes_path


@dataclass(frozen=True)
class LoadResult:
    """What a load did. `accounts` is the stored per-account report, `rows` the stored rows it was made from."""

    table: str
    accounts: DataFrame
    rows: DataFrame
    row_count: int
    failed: bool
    written: bool
    unique_keys: int | None = None
    window: DateWindow | None = None
    dropped_dates: tuple[date, ...] = ()
    outcomes_path: str | None = None

    def failures(self) -> DataFrame:
        """One row per failed account, with one of its violations."""
        return failure_messages(self.rows, self.accounts)

    def failure_message(self) -> str | None:
        """How many accounts failed, and the first of them as an example."""
        if not self.failed:
            return None
        first = F.min(F.struct("requested_account", "violation")).alias("first")
        row = self.failures().agg(F.count("*").alias("failed"), first).first()
        example = f"{row['first']['requested_account']}: {row['first']['violation']}"
        return f"{self.table}: {row['failed']} accounts failed ({example})"

    def raise_for_failures(self) -> None:
        """The message names the first failed account and the table of all; `results` give the `failures` as well."""
        message = self.failure_message()
        if message:
            raise LoadFailed(message, (self,), self.outcomes_path)


def flatten_report(
    spec: ReportSpec,
    landed: DataFrame,
    accounts: DataFrame,
    excluded: DataFrame | Iterable[str] = EXCLUDED_ACCOUNTS,
) -> DataFrame:
    """Typed rows of all listed accounts, with landing columns and contract violation."""
    listed = exclude_accounts(accounts, excluded, spec.platform)
    return spec.project(attach_accounts(landed, listed, spec.platform))


def clean_rows(spec: ReportSpec, flat: DataFrame) -> DataFrame:
    """Rows a load would accept if no account failed: contract met and, in a fact, a date."""
    rows = flat.where(F.col(VIOLATION).isNull())
    return rows.where("date IS NOT NULL") if spec.is_fact else rows


def dimension_rows(spec: ReportSpec, flat: DataFrame) -> DataFrame:
    """First row per key in listing and response order."""
    kept = keep_first(clean_rows(spec, flat), spec.dedupe_keys, ["account_ord", "row_ord"])
    return drop_landing_columns(kept)


def load_fact(
    store: Store,
    spec: ReportSpec,
    landed: DataFrame,
    accounts: DataFrame,
    run: Run,
    *,
    requests: DataFrame | None = None,
    window: DateWindow | None = None,
    account_windows: DataFrame | None = None,
    excluded: DataFrame | Iterable[str] = EXCLUDED_ACCOUNTS,
    lookback_days: int = LOOKBACK_DAYS,
    floor: date = FIRST_RUN_FLOOR,
    raise_on_failure: bool = True,
) -> LoadResult:
    """Replace the slices of every account that delivered good rows; leave all other rows as they are.

    `window` overrides the lookback rule (a backfill); `account_windows` (see `plan_account_windows`) gives each account
    its own. With `requests` (the request log) the replaced slices are the answered ones, so a date chunk whose request
    failed keeps its earlier rows; in reports that are not chunked a failed request fails its account. Rows without a
    date go to quarantine.
    """
    store.create_fact(spec)
    requests, account_windows = _answers(requests, spec), _by_request_key(account_windows, spec)
    if account_windows is not None and window is None:
        window = _reach(account_windows)
    window = (
        (store.recorded_window(run, spec.table) if run.resumes else None)
        or window
        or lookback_window(store.last_date(spec.table), run.run_date, lookback_days, floor)
    )
    store.record(run, spec.table, "started", window)
    flat = _dated_rows(spec, landed, accounts, run, excluded, window)
    staged = store.stage(flat, run, spec.table, "rows")
    result = _commit_fact(store, spec, staged, run, window, requests, account_windows)
    if raise_on_failure:
        result.raise_for_failures()
    return result


def _dated_rows(
    spec: ReportSpec,
    landed: DataFrame,
    accounts: DataFrame,
    run: Run,
    excluded: DataFrame | Iterable[str],
    window: DateWindow,
) -> DataFrame:
    """Typed rows of the window and rows without a date. The listing is made unique here, once per load: the rows are staged."""
    in_window = F.col("date").isNull() | window.contains("date")
    flat = flatten_report(spec, landed, unique_accounts(accounts), excluded).where(in_window)
    return flat.withColumn(INGESTED_AT, F.lit(run.ingested_at))


def _commit_fact(
    store: Store,
    spec: ReportSpec,
    staged: DataFrame,
    run: Run,
    window: DateWindow,
    requests: DataFrame | None,
    account_windows: DataFrame | None,
) -> LoadResult:
    """Check staged rows account by account, store the outcomes, and replace the slices that may be replaced."""
    failed_requests = requests.where(~F.col("ok")) if requests is not None and not spec.chunked else None
    report = store.stage(account_report(staged, failed_requests), run, spec.table, "accounts")
    totals = report.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("null_dates"), F.lit(0)).alias("null_dates"),
        F.count_if(is_failure()).alias("failed"),
    ).first()
    store.record_outcomes(run, spec.table, account_outcomes(staged, report, bool(totals["failed"])))

    if totals["failed"]:
        _refuse_unnamed(spec, staged, store.outcomes_path(run.run_id))
    rows = with_spread(staged)
    good = without_failed(rows, report) if totals["failed"] else rows
    if totals["null_dates"]:
        quarantined = good.where("date IS NULL").drop(SPREAD)
        quarantined.write.mode("overwrite").parquet(store.run_path(run, spec.table, "quarantine"))
        good = good.where("date IS NOT NULL")

    delivered = without_failed(report, report) if totals["failed"] else report
    delivered = delivered.where("account_id IS NOT NULL AND row_count > null_dates")
    slices = requests.where("ok") if requests is not None and spec.chunked else account_windows
    if slices is not None:
        # Nothing outside the window is loaded, so nothing outside it may be replaced either.
        answered = slices.select(
            F.col("requested_account").alias("_asked"),
            F.greatest("slice_start", F.lit(window.start)).alias("slice_start"),
            F.least("slice_end", F.lit(window.end)).alias("slice_end"),
        )
        answered = answered.where("slice_start <= slice_end")
        asked = F.col("requested_account") == F.col("_asked")
        inside = F.col("date").between(F.col("slice_start"), F.col("slice_end"))
        good = store.stage(good.join(answered, asked & inside, "left_semi"), run, spec.table, "answered")
        active = good.select("requested_account", "account_id").distinct()
        replaced = active.join(answered, asked).select("account_id", "slice_start", "slice_end").distinct()
        scope = store.stage(replaced, run, spec.table, "scope")
        reach = _reach(scope)
    else:
        # Still the size of the stored report: Catalyst broadcasts it only while that is small.
        ends = {"slice_start": F.lit(window.start), "slice_end": F.lit(window.end)}
        scope = delivered.select("account_id").withColumns(ends)
        some = not delivered.isEmpty() if totals["failed"] else totals["rows"] > totals["null_dates"]
        reach = window if some else None

    dropped: list[date] = []
    if reach:
        typed = good.select(*spec.columns, SPREAD)
        rows_to_write = None if slices is not None or totals["failed"] else totals["rows"] - totals["null_dates"]
        dropped = replace_slices(
            store.spark, store.name(spec.table), typed, scope, reach, spec.cluster_by, batch_rows=rows_to_write
        )
    if requests is not None and "slice_start" in requests.columns:
        _log_requests(store, spec, run, requests, report)
    store.record(run, spec.table, "committed", window)
    return LoadResult(
        spec.table,
        report,
        staged,
        totals["rows"],
        bool(totals["failed"]),
        written=reach is not None,
        window=window,
        dropped_dates=tuple(dropped),
        outcomes_path=store.outcomes_path(run.run_id),
    )


def _log_requests(store: Store, spec: ReportSpec, run: Run, requests: DataFrame, report: DataFrame) -> None:
    """Note which requested slices are in the table now: answered ones of accounts that did not fail."""
    failed = failed_accounts(report).select(F.col("requested_account").alias("_failed"))
    judged = requests.join(failed, F.col("requested_account") == F.col("_failed"), "left")
    loaded = F.col("ok") & F.col("_failed").isNull()
    store.log_requests(run, spec.table, judged.withColumn("loaded", loaded))


def unanswered_windows(store: Store, spec: ReportSpec) -> DataFrame:
    """Days that some run asked for and that no run has loaded, per account, merged into maximal windows.

    The lookback repairs a failed chunk only while it is recent; this finds the holes of any age. The request log holds one
    row per account, slice and run, and is summed to account and day before it is sorted.
    """
    log = store.logged_requests(spec.table)
    if log is None:
        ddl = "requested_account string, slice_start date, slice_end date"
        return store.spark.createDataFrame([], ddl)
    return missing_windows(log, log.where("loaded"))


def plan_refill(
    store: Store,
    spec: ReportSpec,
    accounts: DataFrame,
    run: Run,
    lookback_days: int = LOOKBACK_DAYS,
    floor: date = FIRST_RUN_FLOOR,
) -> DataFrame:
    """Windows to ask for next: the table's lookback window for every listed account, and every hole of listed accounts.

    Pass it as `account_windows` to `load_fact`, or cut it with `date_chunks` and request the chunks. A retry uses the windows
    of its run.
    """
    earlier = store.staged(run, spec.table, "refill") if run.resumes else None
    if earlier is not None:
        return earlier
    store.create_fact(spec)
    recent = lookback_window(store.last_date(spec.table), run.run_date, lookback_days, floor)
    listed = unique_accounts(accounts).select(F.col("key").alias("requested_account"))
    due = listed.withColumns({"slice_start": F.lit(recent.start), "slice_end": F.lit(recent.end)})
    holes = unanswered_windows(store, spec).join(listed, "requested_account", "left_semi")
    return store.stage(merged_windows(due.unionByName(holes)), run, spec.table, "refill")


def plan_account_windows(
    store: Store,
    spec: ReportSpec,
    accounts: DataFrame,
    run: Run,
    lookback_days: int = LOOKBACK_DAYS,
    floor: date = FIRST_RUN_FLOOR,
) -> DataFrame:
    """Lookback window per listed account, from that account's own newest date. No file of the fact is opened.

    An account that failed for longer than the lookback, or that is new, is loaded from where it stopped; with the
    default window of the whole table such an account would keep a gap.
    """
    earlier = store.staged(run, spec.table, "account_windows") if run.resumes else None
    if earlier is not None:
        return earlier
    store.create_fact(spec)
    marks = account_marks(store.account_days(spec.table)).withColumnRenamed("account_id", "_account")
    listed = accounts.select(F.col("key").alias("requested_account"))
    account = F.col("requested_account")
    if spec.platform == "meta":
        account = without_prefix(account, META_ACCOUNT_PREFIX)
    windows = window_of_marks(
        listed.join(marks, account == F.col("_account"), "left"), run.run_date, lookback_days, floor
    )
    planned = windows.select("requested_account", "slice_start", "slice_end")
    return store.stage(planned, run, spec.table, "account_windows")


def _by_request_key(frame: DataFrame | None, spec: ReportSpec) -> DataFrame | None:
    if frame is None:
        return None
    return frame.withColumn("requested_account", request_key("requested_account", spec.platform))


def _answers(requests: DataFrame | None, spec: ReportSpec) -> DataFrame | None:
    """One row per account and slice: answered if any attempt was; an attempt without a verdict was not."""
    if requests is None:
        return None
    keys = [name for name in ("requested_account", "slice_start", "slice_end") if name in requests.columns]
    return _by_request_key(requests, spec).groupBy(*keys).agg(F.max(F.coalesce("ok", F.lit(False))).alias("ok"))


def _reach(slices: DataFrame) -> DateWindow | None:
    ends = slices.agg(F.min("slice_start").alias("start"), F.max("slice_end").alias("end")).first()
    return DateWindow(ends["start"], ends["end"]) if ends["start"] else None


def refresh_dimension(
    store: Store,
    spec: ReportSpec,
    landed: DataFrame,
    accounts: DataFrame,
    run: Run,
    *,
    requests: DataFrame | None = None,
    excluded: DataFrame | Iterable[str] = EXCLUDED_ACCOUNTS,
    raise_on_failure: bool = True,
) -> LoadResult:
    """Replace the whole table by the first row per key over all accounts, in listing and response order.

    When an account failed, its earlier rows are carried over if the table says which account a row belongs to;
    without that the table is left as it is. A delivery without any row also leaves it as it is.
    """
    store.require_schema(spec)
    flat = flatten_report(spec, landed, unique_accounts(accounts), excluded)
    staged = store.stage(flat.withColumn(INGESTED_AT, F.lit(run.ingested_at)), run, spec.table, "rows")
    answers = _answers(requests, spec)
    failed_requests = answers.where(~F.col("ok")) if answers is not None else None
    report = store.stage(account_report(staged, failed_requests), run, spec.table, "accounts")
    totals = report.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"),
        F.count_if(is_failure()).alias("failed"),
    ).first()
    store.record_outcomes(run, spec.table, account_outcomes(staged, report, bool(totals["failed"])))

    if totals["failed"]:
        _refuse_unnamed(spec, staged, store.outcomes_path(run.run_id))
    rows, order = staged, ["account_ord", "row_ord"]
    writable = totals["rows"] > 0
    if totals["failed"]:
        rows = without_failed(staged, report)
        writable = not rows.isEmpty()
        if "account_id" in spec.columns:
            if store.exists(spec.table):
                rows = rows.withColumn("_carried", F.lit(0)).unionByName(
                    _previous_rows(store, spec, report), allowMissingColumns=True
                )
                order = ["_carried", *order]
        else:
            writable = False
    unique_keys = None
    if writable:
        kept = drop_landing_columns(keep_first(rows, spec.dedupe_keys, order)).select(*spec.columns)
        location = store.new_version_path(spec.table)
        kept.write.mode("overwrite").parquet(location)
        store.point_to(spec, location)
        unique_keys = store.read(spec).count()  # from Parquet footers
    result = LoadResult(
        spec.table,
        report,
        staged,
        totals["rows"],
        bool(totals["failed"]),
        written=writable,
        unique_keys=unique_keys,
        outcomes_path=store.outcomes_path(run.run_id),
    )
    if raise_on_failure:
        result.raise_for_failures()
    return result


def _refuse_unnamed(spec: ReportSpec, staged: DataFrame, outcomes_path: str) -> None:
    """Stop before the commit if a record that could not be read names no account: it may be a row of any of them."""
    unnamed = staged.where(F.col("requested_account").isNull() & (F.col(VIOLATION) == UNREADABLE_RECORD))
    if not unnamed.isEmpty():
        raise LoadFailed(f"{spec.table}: {UNREADABLE_RECORD} and names no account; nothing was replaced", (), outcomes_path)


def _previous_rows(store: Store, spec: ReportSpec, report: DataFrame) -> DataFrame:
    """Current rows of the accounts that failed this time."""
    failed = (
        failed_accounts(report)
        .select(without_prefix("requested_account", META_ACCOUNT_PREFIX).alias("account_id"))
        .distinct()
    )
    return store.read(spec).join(failed, "account_id", "left_semi").withColumn("_carried", F.lit(1))


def backfill(
    store: Store,
    spec: ReportSpec,
    landed: DataFrame,
    accounts: DataFrame,
    run: Run,
    years: tuple[int, int],
    raise_on_failure: bool = True,
    *,
    requests: DataFrame | None = None,
    excluded: DataFrame | Iterable[str] = EXCLUDED_ACCOUNTS,
) -> list[LoadResult]:
    """Load whole calendar years, ending at the run date, one commit per year. Running it again gives the same table.

    The delivery is read and typed once: its rows are staged by year, and every commit reads the folder of its year. In every
    year only the accounts that delivered rows of that year are replaced, so a year without a delivery stays. A failed account
    does not stop the later years; a row without a readable date may be of any year and counts in each. Each year is a run of
    its own in the ledger (`<run_id>-<year>`).
    """
    first, last = years
    whole = DateWindow(date(first, 1, 1), min(date(last, 12, 31), run.run_date))
    if whole.end < whole.start:
        return []
    store.create_fact(spec)
    requests = _answers(requests, spec)
    windows = store.spark.range(1).select(
        F.lit(whole.start).alias("slice_start"), F.lit(whole.end).alias("slice_end")
    )
    slices = year_slices(windows).orderBy("slice_start").collect()  # one row per year
    runs = [(replace(run, run_id=f"{run.run_id}-{s['slice_start'].year}"), s) for s in slices]
    for own, s in runs:
        store.record(own, spec.table, "started", DateWindow(s["slice_start"], s["slice_end"]))
    flat = _dated_rows(spec, landed, accounts, run, excluded, whole)
    by_year = flat.withColumn(YEAR, F.coalesce(F.year("date"), F.lit(UNDATED)))
    staged = store.stage(by_year, run, spec.table, "years", partition_by=(YEAR,))
    results = []
    for own, s in runs:
        window = DateWindow(s["slice_start"], s["slice_end"])
        rows = staged.where(F.col(YEAR).isin(window.start.year, UNDATED)).drop(YEAR)
        asked = requests
        if requests is not None and "slice_start" in requests.columns:
            # A request belongs to every year it reaches into; what it says of other years is no answer of this one.
            asked = requests.where((F.col("slice_start") <= window.end) & (F.col("slice_end") >= window.start))
        results.append(_commit_fact(store, spec, rows, own, window, asked, None))
    if raise_on_failure:
        messages = [f"{r.window.start.year}: {message}" for r in results if (message := r.failure_message())]
        if messages:
            raise LoadFailed("; ".join(messages), tuple(results), store.outcomes_path())
    return results
