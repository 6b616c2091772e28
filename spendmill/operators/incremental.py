"""Which dates to load: high-water mark, lookback window, chunks, calendar years."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendmill.fixed_values import CHUNK_DAYS, FIRST_RUN_FLOOR, LOOKBACK_DAYS


@dataclass(frozen=True)
class DateWindow:
    """Inclusive at both ends."""

    start: date
    end: date

    def contains(self, day: Column | str) -> Column:
        return (F.col(day) if isinstance(day, str) else day).between(F.lit(self.start), F.lit(self.end))


def high_water_mark(rows: DataFrame, day: str = "date") -> DataFrame:
    """One row with the newest date, null for an empty table."""
    return rows.agg(F.max(day).alias("last_date"))


def account_marks(rows: DataFrame, day: str = "date") -> DataFrame:
    """Newest date per account."""
    return rows.groupBy("account_id").agg(F.max(day).alias("last_date"))


def lookback_window(
    last_date: date | None,
    run_date: date,
    lookback_days: int = LOOKBACK_DAYS,
    floor: date = FIRST_RUN_FLOOR,
) -> DateWindow:
    """From some days before the newest loaded date, or from the floor on the first run, to the run date."""
    start = last_date - timedelta(days=lookback_days) if last_date else floor
    return DateWindow(start, run_date)


def window_of_marks(
    marks: DataFrame, run_date: date, lookback_days: int = LOOKBACK_DAYS, floor: date = FIRST_RUN_FLOOR
) -> DataFrame:
    """The same rule as columns, for any number of marks (such as one per account)."""
    start = F.coalesce(F.date_sub("last_date", lookback_days), F.lit(floor))
    return marks.withColumns({"slice_start": start, "slice_end": F.lit(run_date)})


def date_chunks(windows: DataFrame, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """Each `slice_start`..`slice_end` row cut into consecutive chunks that neither overlap nor leave a gap.

    `chunk_days` is added to an inclusive start, so a chunk has `chunk_days + 1` days. A window that ends before it
    starts yields no chunk.
    """
    step = F.make_interval(days=F.lit(chunk_days + 1))
    starts = F.when(
        F.col("slice_start") <= F.col("slice_end"), F.sequence(F.col("slice_start"), F.col("slice_end"), step)
    )
    return (
        windows.withColumn("_start", F.explode(starts))
        .withColumn("slice_end", F.least(F.date_add("_start", chunk_days), F.col("slice_end")))
        .withColumn("slice_start", F.col("_start"))
        .drop("_start")
    )


def year_slices(windows: DataFrame) -> DataFrame:
    """Each window cut at calendar years; the last slice ends where the window ends."""
    years = F.sequence(F.year("slice_start"), F.year("slice_end"))
    return (
        windows.withColumn("_year", F.explode(F.when(F.col("slice_start") <= F.col("slice_end"), years)))
        .withColumns(
            {
                "slice_start": F.greatest("slice_start", F.make_date("_year", F.lit(1), F.lit(1))),
                "slice_end": F.least("slice_end", F.make_date("_year", F.lit(12), F.lit(31))),
            }
        )
        .drop("_year")
    )


def merged_windows(slices: DataFrame, keys: tuple[str, ...] = ("requested_account",)) -> DataFrame:
    """Windows of the days that any slice holds: slices that overlap or touch become one. See `missing_windows`."""
    return missing_windows(slices, slices.where(F.lit(False)), keys)


def missing_windows(
    requested: DataFrame, answered: DataFrame, keys: tuple[str, ...] = ("requested_account",)
) -> DataFrame:
    """Interval subtraction: the days that some requested slice holds and no answered one, merged into maximal windows.

    Both sides have the keys, `slice_start` and `slice_end` (inclusive); a slice that ends before it starts holds no day, one
    without a start or an end is left out. A sweep over interval ends: every slice adds one where it starts and takes one away
    behind its end, for its side. Changes are summed per key and day before anything is sorted, so the window sees at most
    one row per key and day, however many slices and repeated requests there are.
    """
    keys = list(keys)

    def changes(slices: DataFrame, side: str) -> DataFrame:
        other = "answered" if side == "requested" else "requested"
        ends = F.explode(
            F.array(
                F.struct(F.col("slice_start").alias("day"), F.lit(1).alias("change")),
                F.struct(F.date_add("slice_end", 1).alias("day"), F.lit(-1).alias("change")),
            )
        )
        rows = slices.where("slice_start <= slice_end").select(*keys, ends.alias("_end"))
        return rows.select(
            *keys, "_end.day", F.col("_end.change").alias(side), F.lit(0).alias(other)
        )

    swept = (
        changes(requested, "requested")
        .unionByName(changes(answered, "answered"))
        .groupBy(*keys, "day")
        .agg(F.sum("requested").alias("requested"), F.sum("answered").alias("answered"))
    )
    by_day = Window.partitionBy(*keys).orderBy("day")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    open_days = (F.sum("requested").over(so_far) > 0) & (F.sum("answered").over(so_far) == 0)
    # One segment from each day of change to the next; segments that are missing and touch form an island.
    segments = swept.withColumns({"missing": open_days, "next_day": F.lead("day").over(by_day)})
    starts = F.col("missing") & ~F.coalesce(F.lag("missing").over(by_day), F.lit(False))
    islands = segments.withColumn("island", F.sum(starts.cast("int")).over(so_far)).where("missing")
    return (
        islands.groupBy(*keys, "island")
        .agg(F.min("day").alias("slice_start"), F.date_sub(F.max("next_day"), 1).alias("slice_end"))
        .drop("island")
    )
