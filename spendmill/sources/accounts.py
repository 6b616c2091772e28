"""Account listings and the link from landed rows to them.

A listing becomes `key` (the ID a request is made for), `name`, `currency` and `account_ord` (listing order).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendmill.fixed_values import DEFAULT_CURRENCY, META_ACCOUNT_PREFIX, UNNAMED_ACCOUNT
from spendmill.functions import default_if_blank, with_prefix

GOOGLE_ACCOUNT_DDL = "id bigint, descriptive_name string, status string, manager boolean, account_ord int"
META_ACCOUNT_DDL = "id string, name string, currency string, account_ord int"


def google_accounts(listing: DataFrame) -> DataFrame:
    """Accounts that are no managers; a missing or empty name gets the default."""
    return listing.where(~F.col("manager")).select(
        F.col("id").cast("string").alias("key"),
        default_if_blank("descriptive_name", UNNAMED_ACCOUNT).alias("name"),
        F.lit(None).cast("string").alias("currency"),
        "account_ord",
    )


def meta_accounts(listing: DataFrame) -> DataFrame:
    """All accounts; only a missing name or currency gets the default, an empty one stays."""
    return listing.select(
        with_prefix("id", META_ACCOUNT_PREFIX).alias("key"),
        F.coalesce("name", F.lit(UNNAMED_ACCOUNT)).alias("name"),
        F.coalesce("currency", F.lit(DEFAULT_CURRENCY)).alias("currency"),
        "account_ord",
    )


def unique_accounts(accounts: DataFrame) -> DataFrame:
    """Each account once, by its first entry in listing order, so that no row is doubled.

    A client below two managers is listed twice. One aggregation without a sort; loads store its result.
    """
    first = F.min(F.struct("account_ord", "name", "currency")).alias("first")
    return accounts.groupBy("key").agg(first).select("key", "first.name", "first.currency", "first.account_ord")


def exclude_accounts(
    accounts: DataFrame, excluded: DataFrame | Iterable[str], platform: str = "google"
) -> DataFrame:
    """Accounts without the excluded keys, given as a short list or as a DataFrame with a `key` column.

    Keys may be written with or without the platform's prefix.
    """
    if isinstance(excluded, DataFrame):
        return accounts.join(excluded.select(request_key("key", platform).alias("key")), "key", "left_anti")
    prefix = META_ACCOUNT_PREFIX if platform == "meta" else ""
    keys = [key if key.startswith(prefix) else prefix + key for key in excluded]
    return accounts.where(~F.col("key").isin(*keys)) if keys else accounts


def request_key(account: Column | str, platform: str) -> Column:
    """Account ID in the form the listing uses."""
    if platform == "meta":
        return with_prefix(account, META_ACCOUNT_PREFIX)
    return F.col(account) if isinstance(account, str) else account


def attach_accounts(landed: DataFrame, accounts: DataFrame, platform: str) -> DataFrame:
    """Landed rows of listed accounts, with the listing entry as the struct column `account`.

    Rows that name no account at all are kept with a null `account`, so that the load can report them. No broadcast
    hint: Catalyst broadcasts the listing while its size is under the session's threshold and otherwise shuffles,
    where AQE splits an account that is too large for one task.
    """
    keyed = landed.withColumn("requested_account", request_key("requested_account", platform))
    listed = accounts.select(
        F.col("key").alias("_key"), F.struct("key", "name", "currency").alias("account")
    )
    return (
        keyed.join(listed, F.col("requested_account") == F.col("_key"), "left")
        .where(F.col("_key").isNotNull() | F.col("requested_account").isNull())
        .drop("_key")
    )
