"""Landed reports derived from the driver tables, whole tables at a time.

Each landed path is one scalar expression in SQL that Spark and DuckDB read the same way. Spark packs the expressions
into the nested rows a platform would deliver; the oracle computes the expected report straight from them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendmill.plans.spec import ReportSpec
from spendmill.session import shared_dir
from spendmill.sources import google_accounts, meta_accounts, read_landed

EXCLUDED = ("8",)

# Landed search-platform facts, from `events`.
GOOGLE = {
    "segments.date": "CASE WHEN event_id % 97 = 0 THEN 'bad' ELSE CAST(CAST(ts AS DATE) AS STRING) END",
    "segments.device": "CASE event_id % 3 WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'DESKTOP' ELSE NULL END",
    "segments.ad_network_type": "CASE WHEN event_id % 2 = 0 THEN 'SEARCH' ELSE 'CONTENT' END",
    "segments.day_of_week": "CASE WHEN event_id % 7 < 5 THEN 'MONDAY' ELSE 'SUNDAY' END",
    "segments.hour": "CAST(EXTRACT(HOUR FROM ts) AS BIGINT)",
    "segments.keyword.ad_group_criterion": "CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'plain' "
    "ELSE CONCAT('customers/', user_id % 12, '/adGroupCriteria/', user_id, '~', event_id % 9) END",
    "segments.conversion_action": "CONCAT('customers/', user_id % 12, '/conversionActions/', event_id % 6)",
    "segments.conversion_action_name": "CONCAT('Action ', event_id % 6)",
    "segments.conversion_action_category": "UPPER(event_type)",
    "customer.id": "user_id % 12",
    "customer.descriptive_name": "CONCAT('Account ', user_id % 12)",
    "customer.currency_code": "CASE WHEN user_id % 12 < 6 THEN 'USD' ELSE 'EUR' END",
    "campaign.id": "user_id % 60",
    "campaign.name": "CONCAT('Campaign ', user_id % 60)",
    "campaign.status": "CASE WHEN user_id % 60 < 50 THEN 'ENABLED' ELSE 'PAUSED' END",
    "campaign.advertising_channel_type": "CASE event_id % 4 WHEN 0 THEN 'PERFORMANCE_MAX' WHEN 1 THEN 'SMART' "
    "WHEN 2 THEN 'SEARCH' ELSE 'LOCAL' END",
    "campaign.bidding_strategy_type": "CASE WHEN user_id % 60 < 10 THEN NULL ELSE 'TARGET_CPA' END",
    "ad_group.id": "user_id",
    "ad_group.name": "CONCAT('Group ', user_id)",
    "ad_group_ad.ad.id": "CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id * 10 + event_id % 10 END",
    "ad_group_ad.ad.name": "CONCAT('Ad ', event_id % 10)",
    "ad_group_ad.ad.type": "CASE WHEN event_id % 2 = 0 THEN 'RESPONSIVE_SEARCH_AD' ELSE 'IMAGE_AD' END",
    "ad_group_criterion.type": "CASE WHEN event_id % 3 = 0 THEN 'USER_LIST' ELSE 'KEYWORD' END",
    "ad_group_criterion.criterion_id": "event_id % 9",
    "ad_group_criterion.keyword.text": "CONCAT('keyword ', event_id % 9)",
    "ad_group_criterion.keyword.match_type": "CASE WHEN event_id % 2 = 0 THEN 'EXACT' ELSE NULL END",
    "ad_group_criterion.quality_info.quality_score": "event_id % 10",
    "ad_group_criterion.age_range.type": "CASE event_id % 3 WHEN 0 THEN 'AGE_RANGE_18_24' WHEN 1 THEN "
    "'AGE_RANGE_25_34' ELSE NULL END",
    "ad_group_criterion.gender.type": "CASE event_id % 3 WHEN 0 THEN 'MALE' WHEN 1 THEN 'FEMALE' ELSE NULL END",
    "ad_group_audience_view.resource_name": "CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'plain' "
    "ELSE CONCAT('customers/', user_id % 12, '/adGroupAudienceViews/', user_id, '~', event_id % 30) END",
    "search_term_view.search_term": "CONCAT('term ', event_id % 100)",
    "geographic_view.country_criterion_id": "2000 + event_id % 40",
    "geographic_view.location_type": "CASE WHEN event_id % 2 = 0 THEN 'LOCATION_OF_PRESENCE' ELSE 'AREA_OF_INTEREST' END",
    "user_location_view.country_criterion_id": "2000 + event_id % 30",
    "user_location_view.targeting_location": "event_id % 2 = 0",
    "landing_page_view.unexpanded_final_url": "CONCAT('https://example.com/', event_id % 25)",
    "group_placement_view.placement": "CONCAT('placement/', event_id % 20)",
    "group_placement_view.display_name": "CONCAT('Placement ', event_id % 20)",
    "campaign_budget.amount_micros": "(user_id % 60 + 1) * 5000000",
    "campaign_budget.total_amount_micros": "CAST(0 AS BIGINT)",
    "campaign_budget.type": "CASE WHEN user_id % 60 < 30 THEN 'STANDARD' ELSE 'FIXED_CPA' END",
    "asset_group.id": "user_id % 20",
    "asset_group.name": "CONCAT('Asset group ', user_id % 20)",
    "asset.id": "event_id % 50",
    "asset.type": "CASE WHEN event_id % 50 < 30 THEN 'TEXT' ELSE 'IMAGE' END",
    "asset.text_asset.text": "CASE WHEN event_id % 50 < 30 THEN CONCAT('Text ', event_id % 50) ELSE NULL END",
    "metrics.impressions": "1 + event_id % 50",
    "metrics.clicks": "event_id % 5",
    "metrics.ctr": "CAST(event_id % 5 AS DOUBLE) / CAST(1 + event_id % 50 AS DOUBLE)",
    "metrics.average_cpc.micros": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE (event_id % 5) * 10000 + 7 END",
    "metrics.cost_micros": "CAST(ROUND(value * 1000000) AS BIGINT)",
    "metrics.conversions": "CAST(event_id % 4 AS DOUBLE) / 2",
    "metrics.conversions_value": "value * 3",
    "metrics.all_conversions": "CAST(event_id % 4 AS DOUBLE)",
    "metrics.all_conversions_value": "value * 4",
    "metrics.view_through_conversions": "CAST(event_id % 3 AS DOUBLE)",
    "metrics.engagements": "event_id % 6",
    "metrics.search_budget_lost_impression_share": "CAST(event_id % 8 AS DOUBLE) / 8",
    "metrics.content_budget_lost_impression_share": "CASE WHEN event_id % 2 = 0 THEN NULL ELSE 0.25E0 END",
}

# Landed social-platform facts, from `events`. Metrics are text, and some are missing.
META = {
    "date_start": "CAST(CAST(ts AS DATE) AS STRING)",
    "account_id": "CAST(user_id % 12 AS STRING)",
    "account_name": "CONCAT('Account ', user_id % 12)",
    "campaign_id": "CAST(user_id % 60 AS STRING)",
    "campaign_name": "CONCAT('Campaign ', user_id % 60)",
    "adset_id": "CAST(user_id AS STRING)",
    "adset_name": "CONCAT('Set ', user_id)",
    "ad_id": "CAST(user_id * 10 + event_id % 10 AS STRING)",
    "ad_name": "CONCAT('Ad ', event_id % 10)",
    "age": "CASE event_id % 3 WHEN 0 THEN '18-24' WHEN 1 THEN '' ELSE NULL END",
    "gender": "CASE event_id % 2 WHEN 0 THEN 'male' ELSE NULL END",
    "impressions": "CAST(1 + event_id % 50 AS STRING)",
    "clicks": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 5 AS STRING) END",
    "spend": "CAST(value AS STRING)",
    "ctr": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE '0.5' END",
    "cpc": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE ' 1.25 ' END",
    "cpm": "'12'",
    "reach": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 50 AS STRING) END",
    "frequency": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE '1.5e0' END",
}
# Nested lists are Spark's own: missing, empty, or a few entries of several action types.
META_LISTS = {
    "actions": "CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN slice(array(named_struct('action_type', 'x', 'value', "
    "'1')), 1, 0) ELSE array(named_struct('action_type', 'purchase', 'value', CAST(event_id % 4 AS STRING)), "
    "named_struct('action_type', event_type, 'value', CAST(value AS STRING))) END",
    "action_values": "CASE event_id % 4 WHEN 0 THEN NULL ELSE array(named_struct('action_type', event_type, 'value', "
    "CAST(value AS STRING)), named_struct('action_type', 'purchase', 'value', '2.5')) END",
}

# A second delivery restates recent days: doubled amounts, errors retracted, account 5 silent, account 3 broken.
RESTATED_ROWS = "event_type <> 'error' AND user_id % 12 <> 5"
RESTATED_GOOGLE = {
    "metrics.cost_micros": f"({GOOGLE['metrics.cost_micros']}) * 2",
    "metrics.conversions_value": f"({GOOGLE['metrics.conversions_value']}) * 2",
    "campaign.id": f"CASE WHEN user_id % 12 = 3 THEN NULL ELSE {GOOGLE['campaign.id']} END",
}
RESTATED_META = {
    "spend": "CAST(value * 2 AS STRING)",
    "clicks": f"CASE WHEN user_id % 12 = 3 AND event_id % 2 = 0 THEN '12.0' ELSE {META['clicks']} END",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pack(
    rows: DataFrame,
    paths: list[str],
    expressions: dict[str, str],
    landing: tuple[str, str, str],
    sparse: bool = False,
) -> DataFrame:
    """Nested rows from flat expressions, one per dotted path, plus the three landing columns.

    `sparse` leaves out an object whose members are all missing, as JSON would.
    """
    tree: dict = {}
    for path in paths:
        *parents, leaf = path.split(".")
        node = tree
        for parent in parents:
            node = node.setdefault(parent, {})
        node[leaf] = F.expr(expressions[path])

    def build(node):
        if not isinstance(node, dict):
            return node
        members = {name: build(child) for name, child in node.items()}
        whole = F.struct(*[member.alias(name) for name, member in members.items()])
        if not sparse:
            return whole
        return F.when(reduce(Column.__or__, [member.isNotNull() for member in members.values()]), whole)

    account, account_ord, row_ord = landing
    return rows.select(
        *[build(child).alias(name) for name, child in tree.items()],
        F.expr(account).cast("string").alias("requested_account"),
        F.expr(account_ord).cast("int").alias("account_ord"),
        F.expr(row_ord).cast("bigint").alias("row_ord"),
    )


_delivered: dict[tuple, str] = {}


def deliver(spark: SparkSession, spec: ReportSpec, derive: Callable[[], DataFrame], *key: object) -> DataFrame:
    """Write landed rows as a platform delivery would arrive and scan them as a load does.

    Queries of one session share a delivery; its content follows from the key alone.
    """
    fmt = "json" if spec.platform == "meta" else "parquet"
    full_key = (spark.conf.get("spark.app.id", ""), spec.table, *key)
    if full_key not in _delivered:
        path = f"{shared_dir(spark)}/spendmill/landing/{uuid4().hex}"
        derive().write.format(fmt).save(path)
        _delivered[full_key] = path
    return read_landed(spark, spec, _delivered[full_key], fmt)


def landed_fact(spark: SparkSession, sf_dir: str, spec: ReportSpec, restated: bool = False) -> DataFrame:
    """Landed rows of any fact report, first delivery or restated."""
    return deliver(spark, spec, lambda: derived_fact(spark, sf_dir, spec, restated), sf_dir, restated)


def derived_fact(spark: SparkSession, sf_dir: str, spec: ReportSpec, restated: bool = False) -> DataFrame:
    events = table(spark, sf_dir, "events")
    google = spec.platform == "google"
    paths = dict(GOOGLE) if google else {**META, **META_LISTS}
    if restated:
        events = events.where(RESTATED_ROWS)
        paths.update(RESTATED_GOOGLE if google else RESTATED_META)
    account = "user_id % 12" if google else "CONCAT('act_', user_id % 12)"
    landed = pack(events, [path for path, _ in spec.landed_paths], paths, (account, "user_id % 12", "event_id"))
    return landed.select([F.col(f.name).cast(f.dataType) for f in spec.landed_schema.fields])


def fact_accounts(spark: SparkSession, sf_dir: str, platform: str) -> DataFrame:
    """Account listing of the fact reports: account 11 is a manager, account 4 has no name, account 5 no currency."""
    key = (spark.conf.get("spark.app.id", ""), "accounts", sf_dir)
    if key not in _delivered:
        path = f"{shared_dir(spark)}/spendmill/landing/{uuid4().hex}"
        table(spark, sf_dir, "events").selectExpr("user_id % 12 AS n").distinct().write.parquet(path)
        _delivered[key] = path
    ids = spark.read.parquet(_delivered[key])
    if platform == "google":
        return google_accounts(
            ids.selectExpr(
                "n AS id",
                "CASE WHEN n = 4 THEN '' ELSE CONCAT('Account ', n) END AS descriptive_name",
                "'ENABLED' AS status",
                "n = 11 AS manager",
                "CAST(n AS INT) AS account_ord",
            )
        )
    return meta_accounts(
        ids.where("n <> 11").selectExpr(
            "CONCAT('act_', n) AS id",
            "CASE WHEN n = 4 THEN NULL ELSE CONCAT('Account ', n) END AS name",
            "CASE WHEN n = 5 THEN NULL ELSE 'EUR' END AS currency",
            "CAST(n AS INT) AS account_ord",
        )
    )


def excluded_keys(platform: str) -> tuple[str, ...]:
    return EXCLUDED if platform == "google" else tuple(f"act_{key}" for key in EXCLUDED)


def dimension_accounts(spark: SparkSession, sf_dir: str, platform: str) -> DataFrame:
    """Account listing of the dimensions, from `region`: account 4 is a manager, account 2 has no name."""
    regions = table(spark, sf_dir, "region")
    name = "CASE WHEN r_regionkey = 2 THEN NULL ELSE r_name END"
    if platform == "google":
        return google_accounts(
            regions.selectExpr(
                "CAST(r_regionkey AS BIGINT) AS id",
                f"{name} AS descriptive_name",
                "'ENABLED' AS status",
                "r_regionkey = 4 AS manager",
                "r_regionkey AS account_ord",
            )
        )
    return meta_accounts(
        regions.where("r_regionkey <> 4").selectExpr(
            "CONCAT('act_', r_regionkey) AS id", f"{name} AS name", "'EUR' AS currency", "r_regionkey AS account_ord"
        )
    )


def _texts(*items: str) -> str:
    return "array(" + ", ".join(f"named_struct('text', {item})" for item in items) + ")"


# Landed dimensions. Source table, account and order come with each.
AD = {
    "ad.id": "p_partkey",
    "ad.type": "CASE p_partkey % 4 WHEN 0 THEN 'RESPONSIVE_SEARCH_AD' WHEN 1 THEN 'RESPONSIVE_DISPLAY_AD' "
    "WHEN 2 THEN 'EXPANDED_TEXT_AD' ELSE 'IMAGE_AD' END",
    "ad.final_urls": "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE array(CONCAT('https://example.com/', p_partkey), p_type) END",
    "ad.responsive_search_ad.headlines": _texts("p_name", "CONCAT(p_brand, '/', copy)"),
    "ad.responsive_search_ad.descriptions": _texts("p_type"),
    "ad.responsive_display_ad.headlines": _texts("p_brand"),
    "ad.responsive_display_ad.descriptions": _texts("p_name", "p_type"),
    "ad.responsive_display_ad.long_headline.text": "CONCAT('Long ', p_name)",
    "ad.expanded_text_ad.headline_part1": "p_name",
    "ad.expanded_text_ad.headline_part2": "CASE WHEN p_size % 2 = 0 THEN '' ELSE p_brand END",
    "ad.expanded_text_ad.headline_part3": "CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(p_size AS STRING) END",
    "ad.expanded_text_ad.description": "CASE WHEN p_size % 5 = 0 THEN '' ELSE p_type END",
    "ad.expanded_text_ad.description2": "p_brand",
}
AUDIENCE = {
    "ad_group.id": "c_custkey",
    "ad_group_criterion.criterion_id": "c_custkey - c_custkey % 3",
    "ad_group_criterion.display_name": "c_name",
    "ad_group_criterion.type": "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'AFFINITY' WHEN 'BUILDING' THEN 'IN_MARKET' "
    "WHEN 'FURNITURE' THEN 'USER_LIST' WHEN 'HOUSEHOLD' THEN 'AGE_RANGE' ELSE 'CUSTOM_INTENT' END",
}
ASSET = {
    "asset_group.id": "o_orderkey % 20",
    "asset_group.name": "CONCAT('Asset group ', o_orderkey % 20)",
    "asset.id": "o_custkey % 50",
    "asset.name": "CONCAT('File ', o_custkey % 50)",
    "asset.type": "CASE WHEN o_orderkey % 3 = 0 THEN 'IMAGE' ELSE 'TEXT' END",
    "asset.text_asset.text": "CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE CONCAT('Text ', o_orderkey) END",
    "asset_group_asset.field_type": "o_orderpriority",
    "asset_group_asset.status": "o_orderstatus",
    "campaign.advertising_channel_type": "CASE o_orderkey % 4 WHEN 0 THEN 'PERFORMANCE_MAX' WHEN 1 THEN 'SMART' "
    "WHEN 2 THEN 'SEARCH' ELSE 'LOCAL' END",
}
META_AD = {
    "id": "CAST(o_orderkey - o_orderkey % 2 AS STRING)",
    "name": "CONCAT('Ad ', o_orderkey)",
    "status": "o_orderstatus",
    "creative.id": "CASE WHEN o_orderkey % 7 < 2 THEN NULL ELSE CAST(o_custkey AS STRING) END",
    "created_time": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "updated_time": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE '2024-01-01' END",
}
_LINK = "CASE WHEN doc_id % 2 = 0 THEN {} ELSE NULL END"
_VIDEO = "CASE WHEN doc_id % 3 = 0 THEN {} ELSE NULL END"
# Scalar parts of a creative, for both engines.
CREATIVE = {
    "id": "CAST(doc_id AS STRING)",
    "name": "CONCAT('Creative ', doc_id)",
    "status": "CASE WHEN doc_id % 4 = 0 THEN 'ACTIVE' ELSE NULL END",
    "image_url": "CASE doc_id % 5 WHEN 0 THEN CONCAT('image/', doc_id) WHEN 1 THEN '' ELSE NULL END",
    "thumbnail_url": "CASE doc_id % 7 WHEN 0 THEN CONCAT('thumb/', doc_id) WHEN 1 THEN '' ELSE NULL END",
    "url_tags": "CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN CONCAT('tag=', doc_id) ELSE NULL END",
    "call_to_action_type": "CASE doc_id % 6 WHEN 0 THEN 'SHOP_NOW' WHEN 1 THEN '' ELSE NULL END",
    "object_story_spec.link_data.name": _LINK.format("CASE WHEN doc_id % 8 = 0 THEN '' ELSE CONCAT('link ', lang) END"),
    "object_story_spec.link_data.message": _LINK.format("text"),
    "object_story_spec.link_data.link": _LINK.format("CASE WHEN doc_id % 10 = 0 THEN NULL ELSE CONCAT('link/', source) END"),
    "object_story_spec.link_data.picture": _LINK.format("CONCAT('picture/', doc_id)"),
    "object_story_spec.link_data.call_to_action.type": _LINK.format(
        "CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 'LEARN_MORE' END"
    ),
    "object_story_spec.video_data.title": _VIDEO.format("CASE WHEN doc_id % 9 = 0 THEN '' ELSE CONCAT('video ', lang) END"),
    "object_story_spec.video_data.message": _VIDEO.format("CASE WHEN doc_id % 9 = 3 THEN NULL ELSE CONCAT('seen: ', text) END"),
    "object_story_spec.video_data.image_url": _VIDEO.format("CONCAT('still/', doc_id)"),
    "object_story_spec.video_data.call_to_action.type": _VIDEO.format("'WATCH_MORE'"),
}
# Whole objects that are missing, and the feed lists, are Spark's own.
CREATIVE_LISTS = {
    "asset_feed_spec.titles": "CASE doc_id % 5 WHEN 0 THEN array(named_struct('text', CONCAT('feed ', lang)), "
    "named_struct('text', 'second')) WHEN 1 THEN array(named_struct('text', CAST(NULL AS STRING))) ELSE NULL END",
    "asset_feed_spec.bodies": "CASE doc_id % 5 WHEN 0 THEN array(named_struct('text', CONCAT('feed body ', doc_id))) "
    "WHEN 2 THEN slice(array(named_struct('text', 'x')), 1, 0) ELSE NULL END",
    "asset_feed_spec.link_urls": "CASE doc_id % 5 WHEN 0 THEN array(named_struct('website_url', CONCAT('feed/', doc_id))) "
    "ELSE NULL END",
    "asset_feed_spec.images": "CASE doc_id % 5 WHEN 2 THEN array(named_struct('url', CONCAT('feed image/', doc_id))) "
    "ELSE NULL END",
}

# Source rows, expressions, and (account, account_ord, row_ord) per dimension.
DIMENSION_SOURCES = {
    "google_ads_ad_dim": ("part", AD, ("copy", "copy", "p_partkey")),
    "google_ads_audience_dim": ("customer", AUDIENCE, ("c_nationkey % 5", "c_nationkey % 5", "c_custkey")),
    "google_ads_pmax_asset_dim": ("orders", ASSET, ("o_custkey % 5", "o_custkey % 5", "o_orderkey")),
    "meta_ads_ad_dim": ("orders", META_AD, ("CONCAT('act_', o_custkey % 5)", "o_custkey % 5", "o_orderkey")),
    "meta_ads_creative_dim": (
        "documents",
        {**CREATIVE, **CREATIVE_LISTS},
        ("CONCAT('act_', doc_id % 5)", "doc_id % 5", "doc_id"),
    ),
}


def landed_dimension(spark: SparkSession, sf_dir: str, spec: ReportSpec, rows: str | None = None) -> DataFrame:
    """Landed rows of any dimension, or those that satisfy `rows`."""
    return deliver(spark, spec, lambda: derived_dimension(spark, sf_dir, spec, rows), sf_dir, rows)


def derived_dimension(spark: SparkSession, sf_dir: str, spec: ReportSpec, rows: str | None = None) -> DataFrame:
    source, expressions, landing = DIMENSION_SOURCES[spec.table]
    data = table(spark, sf_dir, source)
    if spec.table == "google_ads_ad_dim":
        # Two accounts list the same ads; the first of them lacks every third one.
        data = data.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(0)))).where("copy = 1 OR p_partkey % 3 <> 0")
    if rows:
        data = data.where(rows)
    sparse = spec.table == "meta_ads_creative_dim"
    landed = pack(data, [path for path, _ in spec.landed_paths], expressions, landing, sparse)
    return landed.select([F.col(f.name).cast(f.dataType) for f in spec.landed_schema.fields])
