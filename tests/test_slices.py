"""Slice replace against a plain-Python model, on random small tables."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from spendmill.operators.incremental import DateWindow
from spendmill.operators.slices import partition_dates, replace_slices
from spendmill.plans.store import Run

DDL = "date date, account_id string, n bigint"
FIRST = date(2024, 1, 1)


def create(store, rows):
    name = store.name("facts")
    store.spark.sql(f"CREATE TABLE {name} ({DDL}) USING parquet PARTITIONED BY (date)")
    if rows:
        frame = store.spark.createDataFrame(rows, DDL).select("account_id", "n", "date")
        frame.write.insertInto(name)
    return name


def replace(store, name, batch, scope, window, part="x", **options):
    run = Run(FIRST)
    spark = store.spark
    return replace_slices(
        spark,
        name,
        store.stage(spark.createDataFrame(batch, DDL), run, part, "batch"),
        store.stage(spark.createDataFrame(scope, "account_id string, slice_start date, slice_end date"), run, part, "scope"),
        window,
        ("account_id",),
        **options,
    )


def table_rows(store, name):
    return sorted(tuple(r) for r in store.spark.table(name).select("date", "account_id", "n").collect())


def model(table, batch, scope, window):
    def covered(row):
        return any(row[1] == a and s <= row[0] <= e for a, s, e in scope)

    kept = [r for r in table if not (window.start <= r[0] <= window.end and covered(r))]
    return sorted(kept + batch)


@pytest.mark.parametrize("seed", range(6))
def test_against_model(store, seed):
    rng = random.Random(seed)
    days = [FIRST + timedelta(days=i) for i in range(8)]
    accounts = ["a", "b", "c", "d"]
    # Account "a" holds most rows, and its rows repeat.
    table = [(rng.choice(days), rng.choice("aaaabcd"), rng.randrange(3)) for _ in range(rng.choice([0, 30, 60]))]
    window = DateWindow(days[2], days[6])
    chosen = rng.sample(accounts, rng.randrange(1, 4))
    scope = []
    for account in chosen:
        start = rng.randrange(2, 7)
        scope.append((account, days[start], days[rng.randrange(start, 7)]))
    batch = []
    for _ in range(rng.choice([0, 10, 30])):
        account, start, end = rng.choice(scope)
        batch.append((start + timedelta(days=rng.randrange((end - start).days + 1)), account, 10 + rng.randrange(3)))
    # A date that nobody delivers any more.
    batch = [r for r in batch if r[0] != days[4]]

    name = create(store, table)
    expected = model(table, batch, scope, window)
    for attempt in range(2):
        replace(store, name, batch, scope, window, f"t{attempt}", rows_per_task=7)
        assert table_rows(store, name) == expected
    assert partition_dates(store.spark, name) == {r[0] for r in expected}


def test_emptied_dates_are_reported_and_gone(store):
    days = [FIRST + timedelta(days=i) for i in range(3)]
    name = create(store, [(d, "a", 1) for d in days] + [(days[1], "b", 1)])
    window = DateWindow(days[0], days[2])
    dropped = replace(store, name, [(days[0], "a", 2)], [("a", *days[::2])], window)
    assert dropped == [days[2]]
    assert table_rows(store, name) == [(days[0], "a", 2), (days[1], "b", 1)]


def test_a_scope_too_large_to_broadcast_gives_the_same(store):
    days = [FIRST + timedelta(days=i) for i in range(4)]
    table = [(d, a, 1) for d in days for a in ("a", "a", "a", "b", "c")]
    name = create(store, table)
    batch, scope = [(days[3], "a", 5)], [("a", days[1], days[3]), ("c", days[2], days[2])]
    window = DateWindow(days[1], days[3])
    store.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        replace(store, name, batch, scope, window)
    finally:
        store.spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert table_rows(store, name) == model(table, batch, scope, window)


def test_files_follow_dates_and_clustering(store):
    """Equal rows of one hot account are spread over tasks, and files stay grouped by date."""
    days = [FIRST, FIRST + timedelta(days=1)]
    hot = [(days[0], "a", 1)] * 300
    batch = hot + [(days[1], a, 1) for a in "bcdefgh" for _ in range(10)]
    scope = [(a, days[0], days[1]) for a in "abcdefgh"]
    name = create(store, [])
    replace(store, name, batch, scope, DateWindow(*days), rows_per_task=50)
    files = (
        store.spark.table(name)
        .groupBy(F.col("_metadata.file_path").alias("f"), "date")
        .agg(F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    first_day = [r["rows"] for r in files if r["date"] == days[0]]
    assert sum(first_day) == 300 and len(first_day) >= 4 and max(first_day) <= 150


def test_overwrite_mode_is_put_back(store):
    name = create(store, [])
    before = store.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    replace(store, name, [(FIRST, "a", 1)], [("a", FIRST, FIRST)], DateWindow(FIRST, FIRST))
    assert store.spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_other_dates_keep_their_files(store):
    name = create(store, [(FIRST + timedelta(days=i), "a", i) for i in range(4)])
    window = DateWindow(FIRST, FIRST + timedelta(days=9))
    files = lambda: {f for f in store.spark.table(name).inputFiles()}
    before = files()
    replace(store, name, [(FIRST + timedelta(days=2), "b", 7)], [("b", window.start, window.end)], window)
    assert len(before & files()) == 3
    assert len(table_rows(store, name)) == 5


@pytest.mark.parametrize("day, account", [(20, "b"), (2, "c"), (None, "b")])
def test_stray_rows_are_refused_before_anything_is_dropped(store, day, account):
    name = create(store, [(FIRST, "b", 1), (FIRST + timedelta(days=20), "a", 1)])
    window = DateWindow(FIRST, FIRST + timedelta(days=9))
    stray = (FIRST + timedelta(days=day) if day is not None else None, account, 9)
    with pytest.raises(ValueError, match="outside"):
        replace(store, name, [stray], [("b", window.start, window.end)], window)
    assert len(table_rows(store, name)) == 2
