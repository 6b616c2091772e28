"""From a landing folder to tables; landing formats and deliveries."""

import json
import subprocess
import sys
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from spendmill.jobs import run_reports
from spendmill.operators.incremental import DateWindow
from spendmill.operators.slices import replace_slices
from spendmill.plans.catalog import DIMENSIONS, FACTS
from spendmill.plans.loads import LoadFailed
from spendmill.plans.store import Run
from spendmill.sources import read_batches, read_landed
from tests.conftest import ROOT
from tests.helpers import geo_row, insight, land

GEO, INSIGHTS = FACTS["google_ads_geo"], FACTS["meta_ads_performance"]
RUN = Run(date(2024, 1, 31))


def write(folder, rows):
    folder.mkdir(parents=True)
    (folder / "part.json").write_text("".join(json.dumps(row) + "\n" for row in rows))


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    listing = [{"id": 1, "descriptive_name": "A", "manager": False, "account_ord": 1}, {"id": 2, "manager": True}]
    write(root / "accounts" / "google" / "drop=d1", listing)
    write(root / "accounts" / "meta" / "drop=d1", [{"id": "act_1", "account_ord": 1}])
    write(root / GEO.table / "drop=d0", [geo_row(1, "2024-01-01")])
    write(root / GEO.table / "drop=d1", [geo_row(1, "2024-01-20"), geo_row(2, "2024-01-20")])
    write(root / INSIGHTS.table / "drop=d1", [insight(1, "2024-01-20"), insight(1, "2024-01-21", clicks="x")])
    ad = {"id": "a", "creative": {"id": "c"}, "requested_account": "act_1", "account_ord": 1, "row_ord": 1}
    write(root / "meta_ads_ad_dim" / "drop=d1", [ad, {**ad, "row_ord": 2}])
    return str(root)


def test_one_failing_report_does_not_stop_the_others(store, landing):
    with pytest.raises(LoadFailed, match="meta_ads_performance: 1 accounts failed .act_1: clicks is no integer"):
        run_reports(store, [GEO.table, INSIGHTS.table, "meta_ads_ad_dim"], landing, RUN, drop="d1")
    assert [(r["account_id"], str(r["date"])) for r in store.read(GEO).collect()] == [("1", "2024-01-20")]
    assert store.read(INSIGHTS).count() == 0
    ads = [tuple(r)[:6] for r in store.read(DIMENSIONS["meta_ads_ad_dim"]).collect()]
    assert ads == [("a", None, "1", "Unnamed Account", None, "c")]


def test_results(store, landing):
    results = run_reports(store, [GEO.table, "meta_ads_ad_dim"], landing, RUN, drop="d1")
    assert (results[GEO.table].row_count, results[GEO.table].written) == (1, True)
    assert (results["meta_ads_ad_dim"].row_count, results["meta_ads_ad_dim"].unique_keys) == (2, 1)


def test_years_give_one_result_each(store, landing):
    results = run_reports(store, [GEO.table, "meta_ads_ad_dim"], landing, RUN, drop="d1", years=(2023, 2024))
    written = {name: result.written for name, result in results.items()}
    assert written == {f"{GEO.table} 2023": False, f"{GEO.table} 2024": True, "meta_ads_ad_dim": True}
    assert [str(r["date"]) for r in store.read(GEO).collect()] == ["2024-01-20"]


def test_windows_per_account(store, landing):
    write(Path(landing) / "accounts" / "google" / "drop=d0", [{"id": 1, "manager": False, "account_ord": 1}])
    run_reports(store, [GEO.table], landing, Run(date(2024, 1, 10)), drop="d0")
    run_reports(store, [GEO.table], landing, RUN, drop="d1", account_windows=True, lookback_days=0)
    assert sorted(str(r["date"]) for r in store.read(GEO).collect()) == ["2024-01-20"]  # its own last day was asked again
    assert store.recorded_window(RUN, GEO.table) == DateWindow(date(2024, 1, 1), date(2024, 1, 31))


def test_a_write_that_died_counts_as_not_written(store, landing):
    run = Run(date(2024, 1, 31), resumes=True)
    for part in (store.run_path(run, GEO.table, "account_windows"), f"{store.root}/ledger"):
        (Path(part) / "_temporary" / "0").mkdir(parents=True)
    assert store.staged(run, GEO.table, "account_windows") is None and store.ledger() is None
    run_reports(store, [GEO.table], landing, run, drop="d1", account_windows=True)
    assert store.read(GEO).count() == 1


def test_command_line_names():
    command = [sys.executable, "-m", "spendmill.jobs", "nothing", "--landing", "x", "--root", "y"]
    done = subprocess.run(command, cwd=ROOT, capture_output=True, text=True, timeout=60)
    assert done.returncode == 2 and "unknown reports: nothing" in done.stderr


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_landing_formats(spark, tmp_path, fmt):
    rows = land(spark, GEO, [geo_row(1, "2024-01-20"), geo_row(1, "2024-01-21", average_cpc=None)], tmp_path / "j")
    rows.write.format(fmt).save(str(tmp_path / "l"))
    again = read_landed(spark, GEO, str(tmp_path / "l"), fmt)
    assert again.schema == rows.schema and sorted(again.collect()) == sorted(rows.collect())


def test_unknown_landing_format(spark, tmp_path):
    with pytest.raises(ValueError, match="csv"):
        read_landed(spark, GEO, str(tmp_path), "csv")


def test_batches_keep_response_order(spark, tmp_path):
    def result(n):
        return {k: v for k, v in geo_row(1, "2024-01-20", n).items() if k not in ("requested_account", "account_ord", "row_ord")}

    batches = [
        {"results": [result(1), result(2)], "requested_account": "1", "account_ord": 1, "batch_ord": 0},
        {"results": [result(3)], "requested_account": "1", "account_ord": 1, "batch_ord": 1},
        {"results": [], "requested_account": "1", "account_ord": 1, "batch_ord": 2},
    ]
    write(tmp_path / "b", batches)
    rows = read_batches(spark, GEO, str(tmp_path / "b")).orderBy("row_ord")
    assert [r["geographic_view"]["country_criterion_id"] for r in rows.collect()] == [2001, 2002, 2003]
    assert set(rows.columns) == set(GEO.landed_schema.names)


def test_the_table_schema_is_enforced(store):
    """A value that does not fit its column stops the write and leaves the table as it was."""
    name, day = store.name("strict"), date(2024, 1, 1)
    store.spark.sql(f"CREATE TABLE {name} (date date, account_id string, n int) USING parquet PARTITIONED BY (date)")
    scope = store.stage(
        store.spark.createDataFrame([("a", day, day)], "account_id string, slice_start date, slice_end date"), RUN, "s", "scope"
    )

    def load(value, kind):
        rows = store.spark.createDataFrame([(value, "a", day)], f"n {kind}, account_id string, date date")
        batch = store.stage(rows, RUN, "s", f"batch_{kind}_{value}")
        replace_slices(store.spark, name, batch, scope, DateWindow(day, day))

    load(5, "bigint")  # columns are matched by name, and the value fits
    with pytest.raises(Exception, match="OVERFLOW|overflow"):
        load(2**40, "bigint")
    with pytest.raises(Exception, match="INCOMPATIBLE_COLUMN_TYPE"):
        load(True, "boolean")
    assert [(r["account_id"], r["n"]) for r in store.spark.table(name).collect()] == [("a", 5)]


def test_one_ingest_time_per_run(store, landing):
    run = Run(date(2024, 1, 31))
    run_reports(store, [GEO.table], landing, run, drop="d1")
    stamps = store.read(GEO).select(F.unix_micros("_ingested_at").alias("t")).distinct().collect()
    assert [r["t"] for r in stamps] == [round(run.ingested_at.timestamp() * 1e6)]
