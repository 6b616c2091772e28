"""Commits of slices, versions, schemas, outcomes and holes."""

import random
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from spendmill import files
from spendmill.operators import slices
from spendmill.operators.incremental import DateWindow, merged_windows, missing_windows
from spendmill.operators.schemas import SchemaMismatch
from spendmill.operators.slices import expire_commits, finish_commits
from spendmill.plans import loads
from spendmill.plans.loads import LoadFailed, backfill, plan_refill, unanswered_windows
from spendmill.plans.store import Run
from tests.helpers import geo_row, google_listing, insight, land, meta_listing
from tests.test_loads import ADS, GEO, INSIGHTS, REQUESTS, RUN, ad, costs, load, refresh, spend
from tests.test_slices import FIRST, create, replace, table_rows

DAYS = [FIRST + timedelta(days=i) for i in range(4)]
WINDOW = DateWindow(DAYS[0], DAYS[3])
SLICES = "requested_account string, slice_start date, slice_end date"


def test_a_reader_sees_old_or_new_rows_of_every_date(store, monkeypatch):
    name = create(store, [(d, "a", 1) for d in DAYS])
    seen = []
    plain = store.spark.sql

    def watched(statement, *args, **options):
        if statement.startswith("ALTER TABLE"):
            seen.append(table_rows(store, name))
        return plain(statement, *args, **options)

    monkeypatch.setattr(store.spark, "sql", watched)
    replace(store, name, [(d, "a", 2) for d in DAYS[:3]], [("a", DAYS[0], DAYS[3])], WINDOW)
    monkeypatch.undo()
    assert len(seen) >= 5
    for rows in seen:
        values = {d: n for d, _, n in rows}
        assert all(values[d] in (1, 2) for d in DAYS[:3])
    assert table_rows(store, name) == [(d, "a", 2) for d in DAYS[:3]]


def test_a_reader_that_began_before_the_commit_ends(store):
    """Its files are still there, those of dates that are dropped too."""
    name = create(store, [(d, "a", 1) for d in DAYS for _ in range(3)])
    store.spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        reader = store.spark.table(name).select("date", "n").toLocalIterator()
        first = next(reader)
        replace(store, name, [(DAYS[0], "a", 2)], [("a", DAYS[0], DAYS[3])], WINDOW)
        rest = list(reader)
    finally:
        store.spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["n"] for r in [first, *rest]] == [1] * 12


@pytest.mark.parametrize("statements", range(5))
def test_a_commit_that_was_cut_off_is_finished(store, monkeypatch, statements):
    """The driver dies after so many catalog changes; the next replace, of another date, goes on from the record."""
    name = create(store, [(d, "a", 1) for d in DAYS[:3]])
    plain, left = store.spark.sql, [statements]

    def dying(statement, *args, **options):
        if statement.startswith("ALTER TABLE"):
            if not left[0]:
                raise OSError("lost")
            left[0] -= 1
        return plain(statement, *args, **options)

    monkeypatch.setattr(store.spark, "sql", dying)
    with pytest.raises(OSError):
        replace(store, name, [(d, "a", 2) for d in (DAYS[0], DAYS[1], DAYS[3])], [("a", DAYS[0], DAYS[3])], WINDOW)
    monkeypatch.undo()
    assert {d for d, _, _ in table_rows(store, name)} >= set(DAYS[:2])
    assert finish_commits(store.spark, name) == 1 and finish_commits(store.spark, name) == 0
    assert table_rows(store, name) == [(d, "a", 2) for d in (DAYS[0], DAYS[1], DAYS[3])]


def test_files_without_a_record_are_no_commit(store, monkeypatch):
    name = create(store, [(DAYS[0], "a", 1)])

    def lost(*args):
        raise OSError("lost")

    monkeypatch.setattr(slices.files, "write_text", lost)
    with pytest.raises(OSError):
        replace(store, name, [(DAYS[0], "a", 2)], [("a", DAYS[0], DAYS[3])], WINDOW)
    monkeypatch.undo()
    assert finish_commits(store.spark, name) == 0
    assert table_rows(store, name) == [(DAYS[0], "a", 1)]


def test_replaced_dates_expire(store):
    name = create(store, [])
    for n in range(3):
        replace(store, name, [(d, "a", n) for d in DAYS[: 4 - n]], [("a", DAYS[0], DAYS[3])], WINDOW, f"p{n}")
    rows = table_rows(store, name)
    assert expire_commits(store.spark, name, datetime.now(timezone.utc) - timedelta(days=1)) == 0
    assert expire_commits(store.spark, name, datetime.now(timezone.utc) + timedelta(days=1)) == 7
    assert table_rows(store, name) == rows == [(d, "a", 2) for d in DAYS[:2]]


# Rows per account and date.


def counts(store, name):
    return sorted(
        ((r["date"], r["account_id"], r["n"]) for r in slices.account_days(store.spark, name).collect()), key=repr
    )


def counted(store, name):
    return sorted(
        (tuple(r) for r in store.spark.table(name).groupBy("date", "account_id").count().collect()), key=repr
    )


def test_account_days_follow_every_commit(store):
    """Against counts of the table; dates that no commit wrote are counted there."""
    name = create(store, [])
    assert counts(store, name) == []
    rng = random.Random(5)
    store.spark.sql(f"INSERT INTO {name} PARTITION (date = DATE'{FIRST - timedelta(days=9)}') VALUES ('a', 1), (NULL, 2)")
    for n in range(4):
        accounts = "ab"[: 1 + n % 2]
        batch = [(rng.choice(DAYS), a, n) for a in accounts for _ in range(rng.randrange(1, 4))]
        replace(store, name, batch, [(a, DAYS[0], DAYS[3]) for a in accounts], WINDOW, f"c{n}")
        assert counts(store, name) == counted(store, name)
    replace(store, name, [], [(a, DAYS[0], DAYS[3]) for a in "ab"], WINDOW, "none")
    assert counts(store, name) == counted(store, name) and len(counts(store, name)) == 2


def test_account_days_open_no_file_of_the_table(store):
    name = create(store, [])
    for n in range(2):
        replace(store, name, [(d, "a", n) for d in DAYS[n:]], [("a", DAYS[n], DAYS[3])], WINDOW, f"m{n}")
    days = slices.account_days(store.spark, name)
    assert counts(store, name) == counted(store, name)
    assert days.inputFiles() and all("/marks/" in file for file in days.inputFiles())


def test_account_days_are_made_again(store):
    """A commit without counts, as earlier releases wrote it."""
    name = create(store, [])
    replace(store, name, [(d, "a", 1) for d in DAYS], [("a", DAYS[0], DAYS[3])], WINDOW)
    base = f"{slices.table_folder(store.spark, name)}/{slices.COMMITS}"
    (commit,) = files.children(store.spark, base)
    files.delete(store.spark, f"{base}/{commit}/{slices.MARKS}")
    assert counts(store, name) == counted(store, name)
    assert files.exists(store.spark, f"{base}/{commit}/{slices.MARKS}/_SUCCESS")


# Schemas.


@pytest.mark.parametrize(
    "change, problem",
    [
        (lambda b: b.withColumn("more", F.lit(1)), "[EXTRA_COLUMN] more"),
        (lambda b: b.drop("n"), "[MISSING_COLUMN] n"),
        (lambda b: b.withColumn("n", F.col("n").cast("string")), "[INCOMPATIBLE_COLUMN_TYPE] n (bigint wanted, string found)"),
    ],
)
def test_a_batch_of_another_schema_is_refused(store, change, problem):
    name = create(store, [(DAYS[0], "a", 1)])
    before = store.spark.table(name).inputFiles()
    batch = store.spark.createDataFrame([(DAYS[0], "a", 2)], "date date, account_id string, n bigint")
    scope = store.spark.createDataFrame([("a", *DAYS[:2])], "account_id string, slice_start date, slice_end date")
    with pytest.raises(SchemaMismatch) as error:
        slices.replace_slices(store.spark, name, change(batch), scope, WINDOW)
    assert [str(d) for d in error.value.differences] == [problem]
    assert store.spark.table(name).inputFiles() == before


def test_a_stored_table_of_another_schema_stops_the_load(store, tmp_path):
    """A report that gained a column must not lose it without a word."""
    columns = GEO.output_ddl.replace("clicks bigint, ", "").replace("impressions bigint", "impressions int")
    store.spark.sql(f"CREATE TABLE {store.name(GEO.table)} ({columns}) USING parquet PARTITIONED BY (date)")
    with pytest.raises(SchemaMismatch, match="INCOMPATIBLE_COLUMN_TYPE. impressions .*MISSING_COLUMN. clicks"):
        load(store, GEO, [geo_row(1, "2024-01-20")], tmp_path, [1])
    assert store.spark.table(store.name(GEO.table)).count() == 0
    assert store.ledger() is None


def test_a_dimension_of_another_schema_stops_the_refresh(store, tmp_path):
    store.spark.sql(f"CREATE TABLE {store.name(ADS.table)} ({ADS.output_ddl}, more int) USING parquet")
    with pytest.raises(SchemaMismatch, match="EXTRA_COLUMN. more"):
        refresh(store, ADS, [ad(1, "a")], tmp_path, [1])


# Outcomes.


def test_outcomes_of_all_accounts_are_stored(store, tmp_path):
    run = Run(RUN)
    accounts = list(range(1, 41))
    rows = [geo_row(a, "2024-01-20", clicks=None if a > 1 else 2) for a in accounts]
    with pytest.raises(LoadFailed, match="39 accounts failed") as error:
        load(store, GEO, rows, tmp_path, accounts, run=run)
    assert error.value.outcomes_path in str(error.value)
    stored = store.spark.read.parquet(error.value.outcomes_path).where("failed")
    assert {r["requested_account"] for r in stored.collect()} == {str(a) for a in accounts[1:]}
    assert {r["violation"] for r in stored.collect()} == {"metrics.clicks is missing"}
    mine = store.outcomes().where(F.col("run_id") == run.run_id)
    assert mine.where("NOT failed").select("requested_account", "row_count", "violation").collect() == [("1", 1, None)]


def test_a_repeated_run_writes_its_outcomes_once(store, tmp_path):
    run = Run(RUN)
    for resumes in (False, True):
        load(store, GEO, [geo_row(1, "2024-01-20")], tmp_path, [1], run=Run(RUN, run_id=run.run_id, resumes=resumes))
    assert store.outcomes().count() == 1


# Holes.


def slices_of(frame):
    return sorted((r["requested_account"], str(r["slice_start"]), str(r["slice_end"])) for r in frame.collect())


def windows(spark, *rows):
    return spark.createDataFrame([(a, date.fromisoformat(s), date.fromisoformat(e)) for a, s, e in rows], SLICES)


def test_interval_subtraction(spark):
    asked = windows(
        spark,
        ("a", "2024-01-01", "2024-01-31"),
        ("a", "2024-01-20", "2024-02-10"),
        ("a", "2024-02-11", "2024-02-12"),
        ("b", "2024-01-01", "2024-01-05"),
        ("c", "2024-01-05", "2024-01-01"),
    )
    given = windows(spark, ("a", "2024-01-05", "2024-01-06"), ("a", "2024-01-06", "2024-01-09"), ("b", "2023-01-01", "2025-01-01"))
    assert slices_of(missing_windows(asked, given)) == [("a", "2024-01-01", "2024-01-04"), ("a", "2024-01-10", "2024-02-12")]
    assert slices_of(merged_windows(asked)) == [("a", "2024-01-01", "2024-02-12"), ("b", "2024-01-01", "2024-01-05")]
    assert slices_of(missing_windows(asked.limit(0), given)) == []


def test_a_chunk_that_failed_long_ago_is_loaded_again(store, tmp_path):
    """No lookback reaches it: the hole comes from the request log."""
    asked = [("act_1", date(2023, 12, 1), date(2023, 12, 15), False), ("act_1", date(2023, 12, 16), date(2024, 1, 31), True)]
    requests = store.spark.createDataFrame(asked, REQUESTS)
    rows = [insight(1, "2023-12-20"), insight(1, "2024-01-30")]
    load(store, INSIGHTS, rows, tmp_path, [1], run=Run(date(2024, 1, 31)), requests=requests)
    assert slices_of(unanswered_windows(store, INSIGHTS)) == [("act_1", "2023-12-01", "2023-12-15")]

    run = Run(date(2024, 2, 1))
    due = plan_refill(store, INSIGHTS, meta_listing(store.spark, 1), run)
    assert slices_of(due) == [("act_1", "2023-12-01", "2023-12-15"), ("act_1", "2024-01-16", "2024-02-01")]
    rows = [insight(1, "2023-12-10"), insight(1, "2023-12-20", spend="9"), insight(1, "2024-01-30")]
    answered = due.withColumn("ok", F.lit(True))
    load(store, INSIGHTS, rows, tmp_path, [1], run=run, account_windows=due, requests=answered)
    # The day between the windows was not asked for and stays.
    assert spend(store) == [("2023-12-10", "1", 1.5), ("2023-12-20", "1", 1.5), ("2024-01-30", "1", 1.5)]
    assert slices_of(unanswered_windows(store, INSIGHTS)) == []


def test_answers_of_an_account_that_failed_are_holes(store, tmp_path):
    requests = store.spark.createDataFrame([("act_1", date(2024, 1, 1), date(2024, 1, 31), True)], REQUESTS)
    rows = [insight(1, "2024-01-20", clicks="many")]
    load(store, INSIGHTS, rows, tmp_path, [1], requests=requests, raise_on_failure=False)
    assert slices_of(unanswered_windows(store, INSIGHTS)) == [("act_1", "2024-01-01", "2024-01-31")]


# Years and versions.


def test_backfill_types_the_delivery_once(store, tmp_path, monkeypatch):
    calls = []
    plain = loads.flatten_report
    monkeypatch.setattr(loads, "flatten_report", lambda *a, **k: calls.append(1) or plain(*a, **k))
    rows = [geo_row(1, f"{y}-05-01") for y in (2021, 2022, 2023, 2024)] + [geo_row(1, "soon", 2)]
    landed = land(store.spark, GEO, rows, tmp_path / "l")
    results = backfill(store, GEO, landed, google_listing(store.spark, 1), Run(date(2024, 6, 1)), (2022, 2024))
    assert len(calls) == 1 and [r.written for r in results] == [True] * 3
    assert [c[0] for c in costs(store)] == ["2022-05-01", "2023-05-01", "2024-05-01"]


def test_a_broken_undated_row_fails_its_account_in_every_year(store, tmp_path):
    rows = [insight(a, f"{y}-05-01") for a in (1, 2) for y in (2023, 2024)] + [insight(2, "soon")]
    landed = land(store.spark, INSIGHTS, rows, tmp_path / "l")
    with pytest.raises(LoadFailed, match="2023: .*act_2.*2024: .*act_2"):
        backfill(store, INSIGHTS, landed, meta_listing(store.spark, 1, 2), Run(date(2024, 6, 1)), (2023, 2024))
    assert spend(store) == [("2023-05-01", "1", 1.5), ("2024-05-01", "1", 1.5)]


def test_three_refreshes_leave_two_versions(store, tmp_path):
    readers = []
    for n in range(3):
        refresh(store, ADS, [ad(1, "a", name=f"v{n}")], tmp_path, [1])
        readers.append(store.read(ADS).select("ad_name"))
        readers[-1]._jdf.queryExecution().executedPlan()
    past = datetime.now(timezone.utc) - timedelta(days=1)
    assert store.expire(ADS, past) == 0
    assert store.expire(ADS, datetime.now(timezone.utc) + timedelta(days=1)) == 1
    assert len(files.children(store.spark, f"{store.root}/versions/{ADS.table}")) == 2
    assert [r.collect()[0]["ad_name"] for r in readers[1:]] == ["v1", "v2"]


def test_staged_runs_expire_after_their_commit(store, tmp_path):
    run = Run(RUN)
    load(store, GEO, [geo_row(1, "2024-01-20")], tmp_path, [1], run=run)
    open_run = Run(RUN)
    store.record(open_run, GEO.table, "started", WINDOW)
    store.stage(store.spark.range(1), open_run, GEO.table, "rows")
    assert store.expire_runs(datetime.now(timezone.utc) - timedelta(days=1)) == 0
    assert store.expire_runs(datetime.now(timezone.utc) + timedelta(days=1)) == 1
    assert files.children(store.spark, f"{store.root}/runs") == [open_run.run_id]
    assert costs(store) == [("2024-01-20", "1", 3000000)]
