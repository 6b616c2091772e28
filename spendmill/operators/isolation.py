"""Per-account contract checks: one bad account is left out, the others load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendmill.plans.spec import LANDING_COLUMNS, VIOLATION

REQUEST_FAILED = "request failed"


def account_report(staged: DataFrame, failed_requests: DataFrame | None = None) -> DataFrame:
    """One row per requested and delivered account: rows, rows without a date, broken rows, and whether it failed to answer.

    Only counts are taken, so Spark aggregates with a hash map in every task and sorts nothing.
    """
    day = F.col("date").isNull() if "date" in staged.columns else F.lit(False)
    account = F.col("account_id") if "account_id" in staged.columns else F.lit(None).cast("string").alias("account_id")
    counts = staged.groupBy("requested_account", account).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(day).alias("null_dates"),
        F.count(VIOLATION).alias("broken_rows"),
        F.lit(False).alias("unanswered"),
    )
    if failed_requests is None:
        return counts
    unanswered = failed_requests.select("requested_account").distinct().withColumn("unanswered", F.lit(True))
    return counts.unionByName(unanswered, allowMissingColumns=True)


def is_failure() -> Column:
    return (F.coalesce("broken_rows", F.lit(0)) > 0) | F.col("unanswered")


def failed_accounts(report: DataFrame) -> DataFrame:
    """Requested accounts with a broken row, whatever account ID that row itself carries, or without an answer."""
    return report.where(is_failure()).select("requested_account").distinct()


def failure_messages(staged: DataFrame, report: DataFrame) -> DataFrame:
    """One message per failed account. Reads broken rows only: elsewhere the staged column is null throughout."""
    broken = staged.where(F.col(VIOLATION).isNotNull()).select("requested_account", F.col(VIOLATION).alias("violation"))
    unanswered = report.where("unanswered").select("requested_account", F.lit(REQUEST_FAILED).alias("violation"))
    return broken.unionByName(unanswered).groupBy("requested_account").agg(F.min("violation").alias("violation"))


def account_outcomes(staged: DataFrame, report: DataFrame, failures: bool = True) -> DataFrame:
    """What became of every account: its counts, whether it failed, and one of its violations.

    Nothing is collected: any number of failures can be stored and queried. `failures` is false where the report is known to
    have none; the staged rows are then not read again.
    """
    per_account = report.groupBy("requested_account").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_dates").alias("null_dates"),
        F.sum("broken_rows").alias("broken_rows"),
        F.max("unanswered").alias("unanswered"),
        F.max(is_failure()).alias("failed"),
    )
    if not failures:
        return per_account.withColumn("violation", F.lit(None).cast("string"))
    messages = failure_messages(staged, report).withColumnRenamed("requested_account", "_account")
    # Rows that name no account have an outcome as well.
    same = F.col("requested_account").eqNullSafe(F.col("_account"))
    return per_account.join(messages, same, "left").drop("_account")


def without_failed(rows: DataFrame, report: DataFrame) -> DataFrame:
    """Rows of accounts that did not fail. Rows that name no account are broken themselves and never pass."""
    return rows.where("requested_account IS NOT NULL").join(failed_accounts(report), "requested_account", "left_anti")


def drop_landing_columns(rows: DataFrame) -> DataFrame:
    return rows.drop(*[name for name, _ in LANDING_COLUMNS], VIOLATION)
