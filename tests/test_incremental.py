from datetime import date, timedelta

import pytest

from spendmill.operators import incremental
from spendmill.operators.incremental import DateWindow


def test_lookback_window():
    run = date(2024, 3, 10)
    assert incremental.lookback_window(date(2024, 3, 9), run) == DateWindow(date(2024, 2, 24), run)
    assert incremental.lookback_window(None, run) == DateWindow(date(2022, 1, 1), run)


def expected_chunks(start, end, days=30):
    chunks = []
    while start <= end:
        stop = min(start + timedelta(days=days), end)
        chunks.append((start, stop))
        start = stop + timedelta(days=1)
    return chunks


@pytest.mark.parametrize("length", [-1, 0, 29, 30, 31, 32, 61, 62, 63, 400])
def test_chunks(spark, length):
    start = date(2024, 1, 15)
    end = start + timedelta(days=length)
    windows = spark.createDataFrame([("a", start, end)], "k string, slice_start date, slice_end date")
    got = [tuple(r)[1:] for r in incremental.date_chunks(windows).orderBy("slice_start").collect()]
    assert got == expected_chunks(start, end)


def test_year_slices(spark):
    windows = spark.createDataFrame(
        [("a", date(2022, 5, 1), date(2024, 2, 3)), ("b", date(2024, 1, 1), date(2023, 1, 1))],
        "k string, slice_start date, slice_end date",
    )
    got = sorted(tuple(r) for r in incremental.year_slices(windows).collect())
    assert got == [
        ("a", date(2022, 5, 1), date(2022, 12, 31)),
        ("a", date(2023, 1, 1), date(2023, 12, 31)),
        ("a", date(2024, 1, 1), date(2024, 2, 3)),
    ]


def test_marks(spark):
    rows = spark.createDataFrame(
        [("a", date(2024, 1, 1)), ("a", date(2024, 1, 3)), ("b", None)], "account_id string, date date"
    )
    assert incremental.high_water_mark(rows).first()[0] == date(2024, 1, 3)
    assert incremental.high_water_mark(rows.where("false")).first()[0] is None
    windows = incremental.window_of_marks(incremental.account_marks(rows), date(2024, 1, 5))
    got = {r["account_id"]: (r["slice_start"], r["slice_end"]) for r in windows.collect()}
    assert got == {
        "a": (date(2023, 12, 20), date(2024, 1, 5)),
        "b": (date(2022, 1, 1), date(2024, 1, 5)),
    }
