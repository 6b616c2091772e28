"""Fact loads and dimension refreshes on landed fixtures."""

from datetime import date

import pytest

from spendmill.plans.catalog import DIMENSIONS, FACTS
from spendmill.plans.loads import LoadFailed, backfill, load_fact, plan_account_windows, refresh_dimension
from spendmill.plans.store import Run
from tests.helpers import content, day, geo_row, google_listing, insight, land, meta_listing

GEO, INSIGHTS = FACTS["google_ads_geo"], FACTS["meta_ads_performance"]
RUN = date(2024, 1, 31)
REQUESTS = "requested_account string, slice_start date, slice_end date, ok boolean"


def load(store, spec, rows, tmp_path, accounts, run=None, **options):
    listing = google_listing if spec.platform == "google" else meta_listing
    run = run or Run(RUN)
    landed = land(store.spark, spec, rows, tmp_path / f"landing-{run.run_id}")
    return load_fact(store, spec, landed, listing(store.spark, *accounts), run, **options)


def costs(store):
    return sorted((str(r["date"]), r["account_id"], r["cost_micros"]) for r in store.read(GEO).collect())


def spend(store):
    return sorted((str(r["date"]), r["account_id"], r["spend"]) for r in store.read(INSIGHTS).collect())


def test_first_load_starts_at_the_floor(store, tmp_path):
    rows = [geo_row(1, "2021-12-31", 1), geo_row(1, "2022-01-01", 2), geo_row(1, "2024-02-01", 3)]
    result = load(store, GEO, rows, tmp_path, [1])
    assert (result.window.start, result.window.end) == (date(2022, 1, 1), RUN)
    assert [c[0] for c in costs(store)] == ["2022-01-01"]


def test_restated_load_is_idempotent(store, tmp_path):
    load(store, GEO, [geo_row(a, d) for a in (1, 2) for d in ("2024-01-01", "2024-01-20", "2024-01-30")], tmp_path, [1, 2])
    restated = [geo_row(1, "2024-01-20", cost_micros=5), geo_row(1, "2024-01-31", cost_micros=6)]
    expected = sorted(
        [("2024-01-01", "1", 3000000), ("2024-01-20", "1", 5), ("2024-01-31", "1", 6)]
        + [(d, "2", 3000000) for d in ("2024-01-01", "2024-01-20", "2024-01-30")]
    )
    for _ in range(2):
        # The account that sends nothing keeps its rows; the other one loses the day it no longer delivers.
        load(store, GEO, restated, tmp_path, [1, 2])
        assert costs(store) == expected


def test_failing_account_is_left_out_and_raised(store, tmp_path):
    load(store, GEO, [geo_row(a, "2024-01-20") for a in (1, 2)], tmp_path, [1, 2])
    bad = [geo_row(1, "2024-01-20", cost_micros=5), geo_row(2, "2024-01-20", cost_micros=5), geo_row(2, "2024-01-21", clicks=None)]
    with pytest.raises(LoadFailed, match="2: metrics.clicks is missing"):
        load(store, GEO, bad, tmp_path, [1, 2])
    assert costs(store) == [("2024-01-20", "1", 5), ("2024-01-20", "2", 3000000)]


def test_orphan_rows_fail_the_run_but_not_the_others(store, tmp_path):
    rows = [geo_row(1, "2024-01-20"), {**geo_row(1, "2024-01-21", 2), "requested_account": None}]
    with pytest.raises(LoadFailed, match="None: row names no account"):
        load(store, GEO, rows, tmp_path, [1])
    assert costs(store) == [("2024-01-20", "1", 3000000)]


def test_all_accounts_fail(store, tmp_path):
    load(store, GEO, [geo_row(1, "2024-01-20")], tmp_path, [1])
    result = load(store, GEO, [geo_row(1, "2024-01-20", clicks=None)], tmp_path, [1], raise_on_failure=False)
    assert not result.written and len(costs(store)) == 1


def test_failed_request_of_an_unchunked_report(store, tmp_path):
    requests = store.spark.createDataFrame([("1", RUN, RUN, True), ("2", RUN, RUN, False)], REQUESTS)
    with pytest.raises(LoadFailed, match="2: request failed"):
        load(store, GEO, [geo_row(a, "2024-01-20") for a in (1, 2)], tmp_path, [1, 2], requests=requests)
    assert costs(store) == [("2024-01-20", "1", 3000000)]


def test_undated_rows_are_quarantined_once(store, tmp_path):
    rows = [geo_row(1, "2024-01-20"), geo_row(1, "soon", 2)]
    for _ in range(2):
        run = Run(RUN)
        load(store, GEO, rows, tmp_path, [1], run=run)
        assert costs(store) == [("2024-01-20", "1", 3000000)]
        quarantine = store.spark.read.parquet(store.run_path(run, GEO.table, "quarantine"))
        assert [r["geo_criterion_id"] for r in quarantine.collect()] == ["2002"]


def test_equal_rows_are_kept(store, tmp_path):
    load(store, GEO, [geo_row(1, "2024-01-20")] * 3, tmp_path, [1])
    assert len(costs(store)) == 3


def test_failed_chunk_keeps_its_rows(store, tmp_path):
    load(store, INSIGHTS, [insight(1, d) for d in ("2024-01-18", "2024-01-25", "2024-01-30")], tmp_path, [1])
    requests = store.spark.createDataFrame(
        [("act_1", day("2024-01-16"), day("2024-01-20"), True), ("act_1", day("2024-01-21"), day("2024-01-27"), False),
         ("act_1", day("2024-01-28"), day("2024-01-31"), True)],
        REQUESTS,
    )
    # The failed chunk delivered one row before it broke; the last chunk answered without rows.
    rows = [insight(1, "2024-01-18", spend="9"), insight(1, "2024-01-22", spend="9")]
    load(store, INSIGHTS, rows, tmp_path, [1], requests=requests)
    assert spend(store) == [("2024-01-18", "1", 9.0), ("2024-01-25", "1", 1.5)]


def test_account_ids_with_and_without_prefix_are_the_same(store, tmp_path):
    rows = [insight(1, "2024-01-18", requested_account="1"), insight(1, "2024-01-25", requested_account="act_1")]
    requests = store.spark.createDataFrame([("1", day("2024-01-16"), day("2024-01-20"), True)], REQUESTS)
    load(store, INSIGHTS, rows, tmp_path, [1], requests=requests)
    assert spend(store) == [("2024-01-18", "1", 1.5)]


def test_broken_insight_fails_its_account(store, tmp_path):
    rows = [insight(1, "2024-01-18"), insight(2, "2024-01-18"), insight(2, "2024-01-19", impressions="1.0")]
    with pytest.raises(LoadFailed, match="act_2: impressions is no integer"):
        load(store, INSIGHTS, rows, tmp_path, [1, 2])
    assert spend(store) == [("2024-01-18", "1", 1.5)]


def test_retry_uses_the_recorded_window(store, tmp_path):
    run = Run(RUN)
    load(store, GEO, [geo_row(1, "2024-01-10"), geo_row(1, "2024-01-30")], tmp_path, [1], run=run)
    again = Run(RUN, run_id=run.run_id, resumes=True)
    result = load(store, GEO, [geo_row(1, "2024-01-10", cost_micros=5)], tmp_path, [1], run=again)
    assert result.window.start == date(2022, 1, 1)
    assert costs(store) == [("2024-01-10", "1", 5)]


def test_account_windows_close_a_gap(store, tmp_path):
    load(store, GEO, [geo_row(1, "2023-11-01"), geo_row(2, "2024-01-30")], tmp_path, [1, 2])
    rows = [geo_row(1, "2023-10-01"), geo_row(1, "2023-11-20"), geo_row(2, "2023-11-20"), geo_row(2, "2024-01-31")]
    run = Run(RUN)
    windows = plan_account_windows(store, GEO, google_listing(store.spark, 1, 2), run)
    load(store, GEO, rows, tmp_path, [1, 2], run=run, account_windows=windows)
    # Account 1 resumes from its own mark; account 2 only takes its recent days.
    assert [c[:2] for c in costs(store)] == [("2023-11-20", "1"), ("2024-01-31", "2")]


def test_backfill_twice(store, tmp_path):
    rows = [geo_row(1, d) for d in ("2022-12-31", "2023-01-01", "2023-12-31", "2024-01-31", "2024-02-01")]
    listing = google_listing(store.spark, 1)
    for n in range(2):
        landed = land(store.spark, GEO, rows, tmp_path / f"years-{n}")
        backfill(store, GEO, landed, listing, Run(RUN), (2023, 2024))
        assert [c[0] for c in costs(store)] == ["2023-01-01", "2023-12-31", "2024-01-31"]


def test_tables_are_partitioned_by_date(store, tmp_path):
    load(store, GEO, [geo_row(1, "2024-01-20")], tmp_path, [1])
    plan = store.read(GEO).where("date = DATE'2024-01-20'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert store.last_date(GEO.table) == date(2024, 1, 20)
    assert store.last_date("google_ads_gender") is None


# Dimensions.

ADS, AUDIENCES = DIMENSIONS["meta_ads_ad_dim"], DIMENSIONS["google_ads_audience_dim"]


def ad(account, ad_id, n=1, name="x"):
    return {
        "id": ad_id,
        "name": name,
        "creative": {"id": "c"},
        "requested_account": f"act_{account}",
        "account_ord": account,
        "row_ord": n,
    }


def audience(account, criterion, n=1, kind="USER_LIST"):
    return {
        "ad_group": {"id": n},
        "ad_group_criterion": {"criterion_id": criterion, "display_name": "n", "type": kind},
        "requested_account": str(account),
        "account_ord": account,
        "row_ord": n,
    }


def refresh(store, spec, rows, tmp_path, accounts, **options):
    listing = google_listing if spec.platform == "google" else meta_listing
    run = Run(RUN)
    landed = land(store.spark, spec, rows, tmp_path / f"landing-{run.run_id}")
    return refresh_dimension(store, spec, landed, listing(store.spark, *accounts), run, **options)


def names(store):
    return sorted((r["ad_id"], r["account_id"], r["ad_name"]) for r in store.read(ADS).collect())


def test_refresh_keeps_the_first_row_and_forgets_old_ones(store, tmp_path):
    refresh(store, ADS, [ad(1, "gone"), ad(1, "a", 2)], tmp_path, [1, 2])
    rows = [ad(2, "a", 1, "later account"), ad(1, "a", 9, "second"), ad(1, "a", 3, "first"), ad(2, "b")]
    refresh(store, ADS, rows, tmp_path, [1, 2])
    assert names(store) == [("a", "1", "first"), ("b", "2", "x")]


def test_empty_delivery_keeps_the_table(store, tmp_path):
    refresh(store, ADS, [ad(1, "a")], tmp_path, [1])
    result = refresh(store, ADS, [], tmp_path, [1])
    assert not result.written and names(store) == [("a", "1", "x")]


def test_rows_of_a_failed_account_are_carried(store, tmp_path):
    refresh(store, ADS, [ad(1, "a"), ad(1, "moved"), ad(2, "b")], tmp_path, [1, 2])
    rows = [ad(1, "a", 1, "new"), ad(1, None), ad(2, "c"), ad(2, "moved", 2, "new")]
    with pytest.raises(LoadFailed, match="act_1"):
        refresh(store, ADS, rows, tmp_path, [1, 2])
    assert names(store) == [("a", "1", "x"), ("c", "2", "x"), ("moved", "2", "new")]


def test_no_refresh_without_account_column_when_one_failed(store, tmp_path):
    refresh(store, AUDIENCES, [audience(1, 5), audience(2, 6)], tmp_path, [1, 2])
    before = content(store, AUDIENCES)
    with pytest.raises(LoadFailed):
        refresh(store, AUDIENCES, [audience(1, 7), audience(2, None)], tmp_path, [1, 2])
    assert content(store, AUDIENCES) == before


def test_a_crash_between_drop_and_overwrite_is_repaired_by_a_retry(store, tmp_path, monkeypatch):
    from spendmill.operators import slices

    load(store, GEO, [geo_row(a, d) for a in (1, 2) for d in ("2024-01-20", "2024-01-30")], tmp_path, [1, 2])
    # Now the newest date disappears for good; the run dies after it was dropped.
    rows = [geo_row(a, "2024-01-20", cost_micros=5) for a in (1, 2)]

    def crash(*args, **settings):
        raise OSError("lost")

    run = Run(RUN)
    with monkeypatch.context() as patched:
        patched.setattr(slices, "scoped_conf", crash)
        with pytest.raises(OSError, match="lost"):
            load(store, GEO, rows, tmp_path, [1, 2], run=run)
    assert [c[0] for c in costs(store)] == ["2024-01-20", "2024-01-20"]
    result = load(store, GEO, rows, tmp_path, [1, 2], run=Run(RUN, run_id=run.run_id, resumes=True))
    assert result.window.start == date(2024, 1, 16)
    assert costs(store) == [("2024-01-20", "1", 5), ("2024-01-20", "2", 5)]
    events = [r["event"] for r in store.ledger().where(f"run_id = '{run.run_id}'").orderBy("event").collect()]
    assert events == ["committed", "started", "started"]


def test_backfill_leaves_a_silent_year(store, tmp_path):
    accounts = google_listing(store.spark, 1, 2)
    both = [geo_row(a, f"{y}-03-0{a}") for a in (1, 2) for y in (2023, 2024)]
    backfill(store, GEO, land(store.spark, GEO, both, tmp_path / "a"), accounts, Run(date(2024, 6, 1)), (2023, 2024))
    later = land(store.spark, GEO, [geo_row(1, "2024-03-05")], tmp_path / "b")
    results = backfill(store, GEO, later, accounts, Run(date(2024, 6, 1)), (2023, 2024))
    assert [r.written for r in results] == [False, True]
    days = sorted((str(r.date), r.account_id) for r in store.read(GEO).select("date", "account_id").collect())
    assert days == [("2023-03-01", "1"), ("2023-03-02", "2"), ("2024-03-02", "2"), ("2024-03-05", "1")]


def test_repeated_listing_does_not_double_rows(store, tmp_path):
    landed = land(store.spark, GEO, [geo_row(1, "2024-01-18")], tmp_path / "a")
    load_fact(store, GEO, landed, google_listing(store.spark, 1, 1), Run(RUN))
    assert store.read(GEO).count() == 1


def test_keyword_without_score_loads_as_zero(store, tmp_path):
    spec = FACTS["google_ads_keywords"]
    row = geo_row(1, "2024-01-18") | {"ad_group_criterion": {"criterion_id": 5, "type": "KEYWORD"}}
    load_fact(store, spec, land(store.spark, spec, [row], tmp_path / "a"), google_listing(store.spark, 1), Run(RUN))
    assert [r.quality_score for r in store.read(spec).collect()] == [0]


def test_bare_id_excludes_a_prefixed_account(store, tmp_path):
    landed = land(store.spark, INSIGHTS, [insight(8, "2024-01-18"), insight(9, "2024-01-18")], tmp_path / "a")
    load_fact(store, INSIGHTS, landed, meta_listing(store.spark, 8, 9), Run(RUN), excluded=("8",))
    assert [r.account_id for r in store.read(INSIGHTS).collect()] == ["9"]


def test_last_attempt_of_a_request_counts(store, tmp_path):
    landed = land(store.spark, GEO, [geo_row(1, "2024-01-18"), geo_row(2, "2024-01-18")], tmp_path / "a")
    tried = [("1", date(2024, 1, 1), RUN, False), ("1", date(2024, 1, 1), RUN, True), ("2", date(2024, 1, 1), RUN, None)]
    requests = store.spark.createDataFrame(tried, "requested_account string, slice_start date, slice_end date, ok boolean")
    with pytest.raises(LoadFailed, match="1 accounts failed .2: request failed") as error:
        load_fact(store, GEO, landed, google_listing(store.spark, 1, 2), Run(RUN), requests=requests)
    assert [r.requested_account for r in error.value.results[0].failures().collect()] == ["2"]
    assert [r.account_id for r in store.read(GEO).collect()] == ["1"]
