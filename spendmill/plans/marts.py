"""Marts over the raw tables.

Money and fractional counts are summed as integer micros: such sums are exact, so a figure does not change with the
number of executors. Ratios are taken of sums, never averaged over rows. Amounts in different currencies are never
added. Every window and every pairing works on rows that are already aggregated, so a campaign that holds a large
share of all rows is reduced before it is shuffled.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendmill.fixed_values import MICROS_PER_UNIT
from spendmill.functions import to_micros
from spendmill.operators.lookups import with_creative

CAMPAIGN = ["account_id", "campaign_id", "currency"]


def _units(micros: Column | str) -> Column:
    return (F.col(micros) if isinstance(micros, str) else micros) / F.lit(float(MICROS_PER_UNIT))


def return_on_spend(facts: DataFrame, period: str = "month") -> DataFrame:
    """ROAS and ROI per campaign and period; both are null where nothing was spent."""
    totals = (
        facts.groupBy(*CAMPAIGN, F.trunc("date", period).alias("period_start"))
        .agg(F.sum("cost_micros").alias("cost_micros"), F.sum(to_micros("conversions_value")).alias("value_micros"))
    )
    return totals.select(
        *CAMPAIGN,
        "period_start",
        _units("cost_micros").alias("cost"),
        _units("value_micros").alias("value"),
        F.try_divide("value_micros", "cost_micros").alias("roas"),
        F.try_divide(F.col("value_micros") - F.col("cost_micros"), "cost_micros").alias("roi"),
    )


def budget_pacing(budgets: DataFrame, through: date | None = None) -> DataFrame:
    """Month-to-date cost against the daily budgets of all days that have passed, one row per day.

    A platform delivers no row for a day without any activity, but its budget was there to be spent. Every month in which a
    campaign has a row is filled up: from the first of the month (in its first month from its first row) to its last row, or to
    `through` in that day's month. Such a day costs nothing and has the last budget known before it.
    """
    daily = budgets.groupBy(*CAMPAIGN, "date").agg(
        F.sum("cost_micros").alias("cost_micros"), F.max("daily_budget_micros").alias("budget_micros")
    )
    by_day = Window.partitionBy(*CAMPAIGN).orderBy("date")
    known = F.last("budget_micros", ignorenulls=True).over(
        by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = daily.withColumns({"budget_micros": known, "next_date": F.lead("date").over(by_day)})

    # The days a row stands for: its own, those behind it in its month, and those of the next row's month before that row.
    month, next_month = F.trunc("date", "month"), F.trunc("next_date", "month")
    last_day = F.lit(through).cast("date")
    until_now = (month == F.trunc(last_day, "month")) & (last_day > F.col("date"))
    own_day, day_before = F.array("date"), F.date_sub("next_date", 1)
    days = (
        F.when(F.col("next_date").isNull() & until_now, F.sequence("date", last_day))
        .when(F.col("next_date").isNull(), own_day)
        .when(month == next_month, F.sequence("date", day_before))
        .when(next_month < F.col("next_date"), F.concat(own_day, F.sequence(next_month, day_before)))
        .otherwise(own_day)
    )
    filled = rows.select(
        *CAMPAIGN, "budget_micros", F.col("date").alias("row_date"), "cost_micros", F.explode(days).alias("date")
    )
    so_far = (
        Window.partitionBy(*CAMPAIGN, F.trunc("date", "month"))
        .orderBy("date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    cost = F.when(F.col("date") == F.col("row_date"), F.col("cost_micros")).otherwise(0)
    running = filled.withColumns({"cost_mtd": F.sum(cost).over(so_far), "budget_mtd": F.sum("budget_micros").over(so_far)})
    return running.select(
        *CAMPAIGN,
        "date",
        _units("cost_mtd").alias("cost_to_date"),
        _units("budget_mtd").alias("budget_to_date"),
        F.try_divide("cost_mtd", "budget_mtd").alias("pacing"),
    )


def daily_cost(facts: DataFrame) -> DataFrame:
    return facts.groupBy(*CAMPAIGN, "date").agg(
        F.sum("cost_micros").alias("cost_micros"), F.sum("clicks").alias("clicks")
    )


def year_over_year(facts: DataFrame) -> DataFrame:
    """Each campaign day with the same date one year earlier (28 February for 29 February).

    A self-join would read the facts twice. Instead every aggregated day is emitted once as itself and once for each
    day it is the earlier date of (none, one, or two around a leap day), and both meet in one more aggregation.
    """
    next_year = F.add_months("date", 12)
    later = F.filter(
        F.array(next_year, F.date_add(next_year, 1)), lambda day: F.add_months(day, -12) == F.col("date")
    )
    role = F.explode(
        F.concat(
            F.array(F.struct(F.col("date").alias("day"), F.lit(True).alias("own"))),
            F.transform(later, lambda day: F.struct(day.alias("day"), F.lit(False).alias("own"))),
        )
    )
    rows = daily_cost(facts).select(*CAMPAIGN, "cost_micros", "clicks", role.alias("_role"))
    own = F.col("_role.own")
    paired = rows.groupBy(*CAMPAIGN, F.col("_role.day").alias("date")).agg(
        F.max(F.when(own, F.col("cost_micros"))).alias("cost_micros"),
        F.max(F.when(~own, F.col("cost_micros"))).alias("previous_cost_micros"),
        F.max(F.when(own, F.col("clicks"))).alias("clicks"),
        F.max(F.when(~own, F.col("clicks"))).alias("previous_clicks"),
        F.count_if(own).alias("_days"),
    )
    change = F.try_divide(F.col("cost_micros") - F.col("previous_cost_micros"), "previous_cost_micros")
    return paired.where("_days > 0").drop("_days").withColumn("cost_change", change)


def year_to_date(facts: DataFrame) -> DataFrame:
    """Running cost and clicks from 1 January."""
    year = (
        Window.partitionBy(*CAMPAIGN, F.year("date"))
        .orderBy("date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily_cost(facts).select(
        *CAMPAIGN,
        "date",
        F.sum("cost_micros").over(year).alias("cost_micros_ytd"),
        F.sum("clicks").over(year).alias("clicks_ytd"),
    )


def enriched_ads(facts: DataFrame, ad_dim: DataFrame, creative_dim: DataFrame) -> DataFrame:
    """Spend, clicks and conversions per ad, with the ad's and the creative's attributes."""
    per_ad = facts.groupBy("account_id", "ad_id", "currency").agg(
        F.sum(to_micros("spend")).alias("spend_micros"),
        F.sum("clicks").alias("clicks"),
        F.sum(to_micros("conversions")).alias("conversions_micros"),
    )
    return with_creative(
        per_ad,
        ad_dim,
        creative_dim,
        {"headline": "headline", "destination_url": "destination_url"},
        ad_columns={"ad_name": "ad_name", "status": "ad_status"},
    )


def cross_platform_spend(google_facts: DataFrame, meta_facts: DataFrame) -> DataFrame:
    """Daily spend of both platforms per account, campaign and currency."""
    keys = ["date", *CAMPAIGN]
    google = google_facts.select(F.lit("google").alias("platform"), *keys, F.col("cost_micros").alias("micros"), "clicks")
    meta = meta_facts.select(F.lit("meta").alias("platform"), *keys, to_micros("spend").alias("micros"), "clicks")
    totals = (
        google.unionByName(meta)
        .groupBy("platform", *keys)
        .agg(F.sum("micros").alias("spend_micros"), F.sum("clicks").alias("clicks"))
    )
    return totals.select("platform", *keys, _units("spend_micros").alias("spend"), "clicks")


def weighted_ratios(facts: DataFrame, by: list[str]) -> DataFrame:
    """CTR and CPC of a group, as ratios of sums."""
    totals = facts.groupBy(*by, "currency").agg(
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum("cost_micros").alias("cost_micros"),
    )
    return totals.select(
        *by,
        "currency",
        "impressions",
        "clicks",
        F.try_divide("clicks", "impressions").alias("ctr"),
        F.try_divide(_units("cost_micros"), F.col("clicks")).alias("cpc"),
    )
