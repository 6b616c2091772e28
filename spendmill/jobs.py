"""Run reports from a landing folder: `spark-submit spendmill/jobs.py --help`.

Folder layout: `<landing>/accounts/<platform>`, `<landing>/<report>`, and, where requests were logged,
`<landing>/requests/<report>`. Each holds JSON lines; with `--drop` each is partitioned by `drop`.
"""

from __future__ import annotations

import argparse
from collections.abc import Iterable
from datetime import date, datetime, timedelta, timezone

from spendmill.fixed_values import EXCLUDED_ACCOUNTS, LOOKBACK_DAYS
from spendmill.plans.catalog import LANDED_AS, OPTIONAL, REPORTS
from spendmill.plans.loads import (
    LoadFailed,
    LoadResult,
    backfill,
    load_fact,
    plan_account_windows,
    plan_refill,
    refresh_dimension,
)
from spendmill.plans.store import Run, Store
from spendmill.session import build_session
from spendmill.sources import (
    GOOGLE_ACCOUNT_DDL,
    META_ACCOUNT_DDL,
    google_accounts,
    meta_accounts,
    read_landed,
    read_wire,
    read_listing,
    read_requests,
)


def run_report(
    store: Store,
    name: str,
    landing: str,
    run: Run,
    *,
    drop: str | None = None,
    logged_requests: bool = False,
    excluded: Iterable[str] = EXCLUDED_ACCOUNTS,
    years: tuple[int, int] | None = None,
    account_windows: bool = False,
    refill: bool = False,
    lookback_days: int = LOOKBACK_DAYS,
    wire: str | None = None,
) -> dict[str, LoadResult]:
    """Load or refresh one table from its landing folder. Raises `LoadFailed` after the commit.

    `wire` says that rows lie there as the platform's JSON interface sent them, with names in "snake" or "camel" case.

    Facts load their lookback window; with `years` (first and last) whole calendar years, which give one result each
    (`<name> <year>`), with `account_windows` each account from its own newest date, and with `refill` the lookback window and
    all windows that earlier runs asked for in vain.
    """
    spark, spec = store.spark, {**REPORTS, **OPTIONAL}[name]
    ddl, typed = (
        (GOOGLE_ACCOUNT_DDL, google_accounts) if spec.platform == "google" else (META_ACCOUNT_DDL, meta_accounts)
    )
    accounts = typed(read_listing(spark, ddl, f"{landing}/accounts/{spec.platform}", drop=drop))
    if wire not in (None, "snake", "camel"):
        raise ValueError(f"wire names are in snake or camel case, not {wire!r}")
    path = f"{landing}/{LANDED_AS.get(name, name)}"
    landed = read_wire(spark, spec, path, drop, wire == "camel") if wire else read_landed(spark, spec, path, drop=drop)
    requests = read_requests(spark, f"{landing}/requests/{LANDED_AS.get(name, name)}", drop=drop) if logged_requests else None
    delivery, options = (store, spec, landed, accounts, run), {"requests": requests, "excluded": excluded}
    if not spec.is_fact:
        return {name: refresh_dimension(*delivery, **options)}
    if years:
        return {f"{name} {result.window.start.year}": result for result in backfill(*delivery, years, **options)}
    windows = None
    if account_windows:
        windows = plan_account_windows(store, spec, accounts, run, lookback_days)
    elif refill:
        windows = plan_refill(store, spec, accounts, run, lookback_days)
    return {name: load_fact(*delivery, account_windows=windows, lookback_days=lookback_days, **options)}


def run_reports(store: Store, names: Iterable[str], landing: str, run: Run, **options) -> dict[str, LoadResult]:
    """Load several tables; a failing one does not stop the others, and all failures are raised at the end.

    That holds for any error of a report, such as a landing folder that is not there. The error carries the results of all
    reports that came to their commit, and names the table of all account outcomes (`Store.outcomes`).
    """
    results: dict[str, LoadResult] = {}
    failures: list[str] = []
    failed: list[LoadResult] = []
    for name in names:
        try:
            results.update(run_report(store, name, landing, run, **options))
        except LoadFailed as failure:
            failures.append(str(failure))
            failed.extend(failure.results)
        except Exception as error:  # noqa: BLE001 - raised at the end, with the report's name
            failures.append(f"{name}: {type(error).__name__}: {str(error).splitlines()[0]}")
    if failures:
        raise LoadFailed("; ".join(failures), (*results.values(), *failed), store.outcomes_path())
    return results


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("reports", nargs="+", help="report names, or a platform (google, meta) for all of its reports")
    parser.add_argument("--landing", required=True)
    parser.add_argument("--root", required=True, help="folder of the tables, shared by all executors")
    parser.add_argument("--database", default="ads_raw")
    parser.add_argument("--run-date", type=date.fromisoformat, default=datetime.now(timezone.utc).date())
    parser.add_argument("--drop", help="delivery to read")
    parser.add_argument("--wire", choices=("snake", "camel"), help="rows as the platform sent them, names in that case")
    parser.add_argument("--logged-requests", action="store_true", help="read the request logs")
    parser.add_argument("--exclude", action="append", help="account to leave out (default: the known test account)")
    parser.add_argument("--resume", metavar="RUN_ID", help="repeat an interrupted run")
    parser.add_argument("--lookback-days", type=int, default=LOOKBACK_DAYS)
    reach = parser.add_mutually_exclusive_group()
    reach.add_argument("--years", nargs=2, type=int, metavar=("FIRST", "LAST"), help="load whole calendar years of facts")
    reach.add_argument("--account-windows", action="store_true", help="load each account from its own newest date")
    reach.add_argument("--refill", action="store_true", help="load what earlier runs asked for in vain as well")
    parser.add_argument("--expire-days", type=int, help="afterwards delete files that were replaced that many days ago")
    options = parser.parse_args()

    names = [
        name
        for wanted in options.reports
        for name, spec in REPORTS.items()
        if wanted in (name, spec.platform)
    ] + [name for name in OPTIONAL if name in options.reports]
    unknown = [w for w in options.reports if w not in {**REPORTS, **OPTIONAL} and w not in ("google", "meta")]
    if unknown:
        parser.error(f"unknown reports: {', '.join(unknown)}")
    store = Store(build_session(metastore=True), options.database, options.root)
    run = Run(options.run_date, run_id=options.resume, resumes=True) if options.resume else Run(options.run_date)
    print(f"run {run.run_id}: {', '.join(names)}")
    results = run_reports(
        store,
        names,
        options.landing,
        run,
        drop=options.drop,
        logged_requests=options.logged_requests,
        excluded=options.exclude or EXCLUDED_ACCOUNTS,
        years=tuple(options.years) if options.years else None,
        account_windows=options.account_windows,
        refill=options.refill,
        lookback_days=options.lookback_days,
        wire=options.wire,
    )
    for name, result in results.items():
        print(f"{name}: {result.row_count} rows landed, written: {result.written}")
    if options.expire_days is not None:
        before = run.ingested_at - timedelta(days=options.expire_days)
        for name in names:
            print(f"{name}: {store.expire({**REPORTS, **OPTIONAL}[name], before)} old folders deleted")
        print(f"{store.expire_runs(before)} staged runs deleted")


if __name__ == "__main__":
    main()
