"""Joins between facts and their dimensions. Keys were prepared for these joins; no report executes one itself.

None of them hints a broadcast. A dimension is a stored table, so Catalyst knows its size: under the session's
threshold it is broadcast, above it both sides are shuffled, and AQE splits the tasks of a key (or of the null keys)
that is too frequent. AQE can do so only while both join inputs are exchanges of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendmill.operators.dedupe import keep_first


def _named(dim: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    return dim.select(*keys, *[F.col(source).alias(name) for source, name in columns.items()])


def with_ad(facts: DataFrame, ad_dim: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Ad fact with attributes of its ad (`columns`: dimension column to output name)."""
    return facts.join(_named(ad_dim, ["ad_id"], columns), "ad_id", "left")


def with_creative(
    facts: DataFrame,
    ad_dim: DataFrame,
    creative_dim: DataFrame,
    columns: dict[str, str],
    ad_columns: dict[str, str] | None = None,
) -> DataFrame:
    """Ad fact with attributes of its creative, through the creative ID that the ad dimension holds.

    `ad_columns` are taken from the ad dimension in the same join.
    """
    bridged = with_ad(facts, ad_dim, {**(ad_columns or {}), "creative_id": "creative_id"})
    return bridged.join(_named(creative_dim, ["creative_id"], columns), "creative_id", "left")


KEYWORD_KEYS = ["account_id", "ad_group_id", "keyword_id", "date"]


def with_keyword(search_terms: DataFrame, keywords: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Search-term fact with attributes of the keyword on the same day.

    Keyword rows are daily and may repeat, so one row per key is kept (the smallest in the chosen attributes) before
    the join; the number of search-term rows does not change.
    """
    named = keep_first(_named(keywords, KEYWORD_KEYS, columns), KEYWORD_KEYS, list(columns.values()))
    # One more join key than the dedupe has: the join gets its own exchange on both sides instead of reusing the one of
    # the dedupe, and with it skew handling for keywords (or missing keyword IDs) that hold a large share of the terms.
    digest = F.xxhash64(*KEYWORD_KEYS)
    left, right = search_terms.withColumn("_digest", digest), named.withColumn("_digest", digest)
    return left.join(right, [*KEYWORD_KEYS, "_digest"], "left").drop("_digest")


def with_audience(facts: DataFrame, audience_dim: DataFrame) -> DataFrame:
    columns = {"audience_name": "audience_name", "audience_type": "audience_type"}
    return facts.join(_named(audience_dim, ["audience_criterion_id"], columns), "audience_criterion_id", "left")


def with_asset(facts: DataFrame, asset_dim: DataFrame) -> DataFrame:
    """Asset fact with content, role and status. An asset that serves in several roles gives one row per role."""
    columns = {"asset_content": "asset_content", "field_type": "field_type", "asset_status": "asset_status"}
    keys = ["asset_group_id", "asset_id"]
    return facts.join(_named(asset_dim, keys, columns), keys, "left")
