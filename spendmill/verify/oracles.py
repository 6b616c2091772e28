"""Expected results in SQL that DuckDB runs on the driver tables.

Only the derivation of the landed rows is shared with the Spark side; what a report does with them is written here a
second time, without the package's operators.
"""

from __future__ import annotations

from spendmill.verify.landing import (
    ASSET,
    AUDIENCE,
    CREATIVE,
    GOOGLE,
    META,
    META_AD,
)

# Google facts.

ACCEPTED_GOOGLE = "user_id % 12 NOT IN (8, 11)"
GOOGLE_DATE = f"TRY_CAST({GOOGLE['segments.date']} AS DATE)"


def _text(path: str) -> str:
    return f"CAST({GOOGLE[path]} AS VARCHAR)"


def _long(path: str) -> str:
    return f"CAST({GOOGLE[path]} AS BIGINT)"


def _double(path: str) -> str:
    return f"CAST({GOOGLE[path]} AS DOUBLE)"


_ACCOUNT = {"account_id": _text("customer.id"), "account_name": _text("customer.descriptive_name")}
_CAMPAIGN = {
    "campaign_id": _text("campaign.id"),
    "campaign_name": _text("campaign.name"),
    "campaign_status": _text("campaign.status"),
}
_AD_GROUP = {"ad_group_id": _text("ad_group.id"), "ad_group_name": _text("ad_group.name")}
_METRICS = {
    "impressions": _long("metrics.impressions"),
    "clicks": _long("metrics.clicks"),
    "ctr": _double("metrics.ctr"),
    "average_cpc": f"{_double('metrics.average_cpc.micros')} / 1e6",
    "cost_micros": _long("metrics.cost_micros"),
    "conversions": _double("metrics.conversions"),
    "conversions_value": _double("metrics.conversions_value"),
    "all_conversions": _double("metrics.all_conversions"),
}
_VIEW_THROUGH = {"view_through_conversions": _double("metrics.view_through_conversions")}
_ENGAGEMENTS = {"engagements": _long("metrics.engagements")}
_CLOSING = {
    "bidding_strategy_type": _text("campaign.bidding_strategy_type"),
    "currency": _text("customer.currency_code"),
}


def _tail(path: str, separator: str) -> str:
    return f"SPLIT({GOOGLE[path]}, '{separator}')[-1]"


def _google(own: dict, *metrics: dict, level: dict = _AD_GROUP, where: str = "TRUE") -> tuple[dict, str]:
    columns: dict[str, str] = {}
    for part in (_ACCOUNT, _CAMPAIGN, level, own, *metrics, _CLOSING):
        columns.update(part)
    return columns, where


_WIDE = (_METRICS, _VIEW_THROUGH, _ENGAGEMENTS)
GOOGLE_FACTS: dict[str, tuple[dict, str]] = {
    "google_ads_performance": _google(
        {
            "ad_id": _text("ad_group_ad.ad.id"),
            "ad_name": _text("ad_group_ad.ad.name"),
            "ad_type": _text("ad_group_ad.ad.type"),
            "ad_network_type": _text("segments.ad_network_type"),
            "device": _text("segments.device"),
        },
        *_WIDE,
    ),
    "google_ads_age_range": _google({"age_range": _text("ad_group_criterion.age_range.type")}, *_WIDE),
    "google_ads_gender": _google({"gender": _text("ad_group_criterion.gender.type")}, *_WIDE),
    "google_ads_audience": _google(
        {"audience_criterion_id": _tail("ad_group_audience_view.resource_name", "~")}, *_WIDE
    ),
    "google_ads_keywords": _google(
        {
            "keyword_id": _text("ad_group_criterion.criterion_id"),
            "keyword_text": _text("ad_group_criterion.keyword.text"),
            "keyword_match_type": _text("ad_group_criterion.keyword.match_type"),
            "quality_score": _long("ad_group_criterion.quality_info.quality_score"),
        },
        _METRICS,
        where="event_id % 3 <> 0",
    ),
    "google_ads_search_terms": _google(
        {
            "search_term": _text("search_term_view.search_term"),
            "keyword_id": f"CASE WHEN {GOOGLE['segments.keyword.ad_group_criterion']} = '' THEN NULL "
            f"ELSE {_tail('segments.keyword.ad_group_criterion', '~')} END",
        },
        _METRICS,
    ),
    "google_ads_geo": _google(
        {
            "geo_criterion_id": _text("geographic_view.country_criterion_id"),
            "location_type": _text("geographic_view.location_type"),
        },
        _METRICS,
        _VIEW_THROUGH,
    ),
    "google_ads_user_location": _google(
        {
            "user_geo_criterion_id": _text("user_location_view.country_criterion_id"),
            "is_targeting_location": GOOGLE["user_location_view.targeting_location"],
        },
        _METRICS,
        _VIEW_THROUGH,
    ),
    "google_ads_schedule": _google(
        {"day_of_week": _text("segments.day_of_week"), "hour": _long("segments.hour")}, _METRICS
    ),
    "google_ads_landing_page": _google(
        {"landing_page_url": _text("landing_page_view.unexpanded_final_url")}, _METRICS
    ),
    "google_ads_conversion_action": _google(
        {
            "conversion_action_id": _tail("segments.conversion_action", "/"),
            "conversion_action_name": _text("segments.conversion_action_name"),
            "conversion_category": _text("segments.conversion_action_category"),
        },
        {
            "conversions": _double("metrics.conversions"),
            "conversions_value": _double("metrics.conversions_value"),
            "all_conversions": _double("metrics.all_conversions"),
            "all_conversions_value": _double("metrics.all_conversions_value"),
        },
        level={},
        where="event_id % 4 > 0",
    ),
    "google_ads_group_placement_view": _google(
        {
            "placement_resource_name": _text("group_placement_view.placement"),
            "placement_display_name": _text("group_placement_view.display_name"),
        },
        *_WIDE,
    ),
    "google_ads_budget_pacing": _google(
        {
            "daily_budget_micros": _long("campaign_budget.amount_micros"),
            "total_budget_micros": _long("campaign_budget.total_amount_micros"),
            "budget_type": _text("campaign_budget.type"),
        },
        {
            "cost_micros": _long("metrics.cost_micros"),
            "search_budget_lost_is": _double("metrics.search_budget_lost_impression_share"),
            "content_budget_lost_is": _double("metrics.content_budget_lost_impression_share"),
        },
        level={},
    ),
    "google_ads_pmax_asset": _google(
        {
            "asset_id": _text("asset.id"),
            "asset_type": _text("asset.type"),
            "asset_text": _text("asset.text_asset.text"),
        },
        _METRICS,
        level={"asset_group_id": _text("asset_group.id"), "asset_group_name": _text("asset_group.name")},
        where="event_id % 4 <> 2",
    ),
}

# Meta facts.

ACCEPTED_META = ACCEPTED_GOOGLE
META_DATE = f"CAST({META['date_start']} AS DATE)"


def _meta_whole(name: str) -> str:
    return f"COALESCE(CAST({META[name]} AS BIGINT), 0)"


def _meta_number(name: str) -> str:
    return f"COALESCE(CAST(TRIM({META[name]}) AS DOUBLE), 0.0)"


_WHO = {
    name: META[name]
    for name in (
        "account_id",
        "account_name",
        "campaign_id",
        "campaign_name",
        "adset_id",
        "adset_name",
        "ad_id",
        "ad_name",
    )
}
_REACHED = {"impressions": _meta_whole("impressions"), "clicks": _meta_whole("clicks"), "spend": "value"}
_RESULT = {
    "conversions": "CASE WHEN event_id % 4 < 2 THEN 0.0E0 ELSE 0.0E0 + CAST(event_id % 4 AS DOUBLE) + value END",
    "conversion_value": "CASE WHEN event_id % 4 = 0 THEN 0.0E0 ELSE 0.0E0 + value + 2.5E0 END",
    "currency": "CASE WHEN user_id % 12 = 5 THEN 'USD' ELSE 'EUR' END",
}
META_FACTS: dict[str, tuple[dict, str]] = {
    "meta_ads_performance": (
        {
            **_WHO,
            **_REACHED,
            "ctr": _meta_number("ctr"),
            "average_cpc": _meta_number("cpc"),
            "cpm": "12.0E0",
            "reach": _meta_whole("reach"),
            "frequency": _meta_number("frequency"),
            **_RESULT,
        },
        "TRUE",
    ),
    "meta_ads_age_gender": (
        {
            **_WHO,
            "age": f"COALESCE({META['age']}, 'Unknown')",
            "gender": f"COALESCE({META['gender']}, 'Unknown')",
            **_REACHED,
            "ctr": _meta_number("ctr"),
            "average_cpc": "0.0E0",
            "cpm": "0.0E0",
            "reach": "CAST(0 AS BIGINT)",
            "frequency": "0.0E0",
            **_RESULT,
        },
        "TRUE",
    ),
}

FACTS = {**GOOGLE_FACTS, **META_FACTS}


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in columns.items())


def scan_fact(table: str, extra: str = "") -> str:
    """Rows a fact report delivers: accepted accounts, its own filter, a readable date."""
    columns, where = FACTS[table]
    google = table in GOOGLE_FACTS
    day, accepted = (GOOGLE_DATE, ACCEPTED_GOOGLE) if google else (META_DATE, ACCEPTED_META)
    return (
        f"SELECT {day} AS date, {_select(columns)}{extra} FROM events "
        f"WHERE {accepted} AND ({where}) AND {day} IS NOT NULL"
    )


def load_fact(table: str) -> str:
    """First delivery, then the restated one: 15 days are replaced, except for a silent and a broken account."""
    columns, _ = FACTS[table]
    doubled = {"cost_micros", "conversions_value"} if table in GOOGLE_FACTS else {"spend"}
    inner = scan_fact(table, ", event_type AS _event, user_id % 12 AS _account")
    replaced = "date >= last_date - 14 AND _account NOT IN (3, 5)"
    names = ", ".join(
        f"CASE WHEN {replaced} THEN {name} * 2 ELSE {name} END AS {name}" if name in doubled else name
        for name in columns
    )
    return (
        f"WITH base AS ({inner}), mark AS (SELECT MAX(date) AS last_date FROM base) "
        f"SELECT date, {names} FROM base CROSS JOIN mark WHERE NOT ({replaced} AND _event = 'error')"
    )


# Dimensions.

AD_DIM = """
SELECT CAST(p_partkey AS VARCHAR) AS ad_id,
  CASE p_partkey % 4 WHEN 0 THEN 'RESPONSIVE_SEARCH_AD' WHEN 1 THEN 'RESPONSIVE_DISPLAY_AD'
    WHEN 2 THEN 'EXPANDED_TEXT_AD' ELSE 'IMAGE_AD' END AS ad_type,
  CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'https://example.com/' || p_partkey || '|' || p_type END AS final_urls,
  CASE p_partkey % 4
    WHEN 0 THEN p_name || '|' || p_brand || '/' || CASE WHEN p_partkey % 3 = 0 THEN '1' ELSE '0' END
    WHEN 1 THEN p_brand || '|Long ' || p_name
    WHEN 2 THEN CONCAT_WS('|', p_name, CASE WHEN p_size % 2 = 1 THEN p_brand END,
      CASE WHEN p_size % 3 <> 0 THEN CAST(p_size AS VARCHAR) END)
    ELSE '' END AS headlines,
  CASE p_partkey % 4
    WHEN 0 THEN p_type
    WHEN 1 THEN p_name || '|' || p_type
    WHEN 2 THEN CONCAT_WS('|', CASE WHEN p_size % 5 <> 0 THEN p_type END, p_brand)
    ELSE '' END AS descriptions
FROM part
"""

AUDIENCE_DIM = f"""
SELECT ad_group_id, audience_criterion_id, audience_name, audience_type FROM (
  SELECT CAST({AUDIENCE['ad_group.id']} AS VARCHAR) AS ad_group_id,
    CAST({AUDIENCE['ad_group_criterion.criterion_id']} AS VARCHAR) AS audience_criterion_id,
    c_name AS audience_name, {AUDIENCE['ad_group_criterion.type']} AS audience_type,
    ROW_NUMBER() OVER (PARTITION BY c_custkey - c_custkey % 3 ORDER BY c_nationkey % 5, c_custkey) AS rn
  FROM customer WHERE c_mktsegment <> 'HOUSEHOLD' AND c_nationkey % 5 <> 4)
WHERE rn = 1
"""

ASSET_DIM = f"""
SELECT asset_group_id, asset_group_name, asset_id, asset_type, asset_content, field_type, asset_status FROM (
  SELECT CAST(o_orderkey % 20 AS VARCHAR) AS asset_group_id, {ASSET['asset_group.name']} AS asset_group_name,
    CAST(o_custkey % 50 AS VARCHAR) AS asset_id, {ASSET['asset.type']} AS asset_type,
    CASE WHEN o_orderkey % 3 = 2 THEN {ASSET['asset.text_asset.text']} ELSE {ASSET['asset.name']} END AS asset_content,
    o_orderpriority AS field_type, o_orderstatus AS asset_status,
    ROW_NUMBER() OVER (PARTITION BY o_orderkey % 20, o_custkey % 50, o_orderpriority
      ORDER BY o_custkey % 5, o_orderkey) AS rn
  FROM orders WHERE o_orderkey % 4 <> 2 AND o_custkey % 5 <> 4)
WHERE rn = 1
"""

_META_ACCOUNT = """CAST({key} AS VARCHAR) AS account_id,
    CASE WHEN {key} = 2 THEN 'Unnamed Account' ELSE r_name END AS account_name"""

META_AD_DIM = f"""
SELECT ad_id, ad_name, account_id, account_name, status, creative_id, created_time, updated_time FROM (
  SELECT {META_AD['id']} AS ad_id, {META_AD['name']} AS ad_name,
    {_META_ACCOUNT.format(key="o_custkey % 5")}, o_orderstatus AS status,
    {META_AD['creative.id']} AS creative_id, {META_AD['created_time']} AS created_time,
    {META_AD['updated_time']} AS updated_time,
    ROW_NUMBER() OVER (PARTITION BY o_orderkey - o_orderkey % 2 ORDER BY o_custkey % 5, o_orderkey) AS rn
  FROM orders JOIN region ON r_regionkey = o_custkey % 5 WHERE o_custkey % 5 <> 4)
WHERE rn = 1
"""

_C = {path.rsplit("object_story_spec.", 1)[-1].replace(".", "_"): sql for path, sql in CREATIVE.items()}
CREATIVE_DIM = f"""
WITH flat AS (SELECT doc_id, lang, r_name, {", ".join(f"{sql} AS {name}_" for name, sql in _C.items())}
  FROM documents JOIN region ON r_regionkey = doc_id % 5 WHERE doc_id % 5 <> 4),
steps AS (SELECT *,
  COALESCE(NULLIF(image_url_, ''), thumbnail_url_) AS image0,
  NULLIF(link_data_call_to_action_type_, '') AS link_button
  FROM flat),
link AS (SELECT *,
  CASE WHEN COALESCE(call_to_action_type_, '') = '' AND doc_id % 2 = 0 THEN link_data_call_to_action_type_
    ELSE call_to_action_type_ END AS button1,
  CASE WHEN COALESCE(image0, '') = '' AND doc_id % 2 = 0 THEN link_data_picture_ ELSE image0 END AS image1
  FROM steps),
video AS (SELECT *,
  CASE WHEN COALESCE(button1, '') = '' AND doc_id % 3 = 0 THEN video_data_call_to_action_type_ ELSE button1 END AS button2,
  CASE WHEN COALESCE(image1, '') = '' AND doc_id % 3 = 0 THEN video_data_image_url_ ELSE image1 END AS image2
  FROM link)
SELECT id_ AS creative_id, name_ AS creative_name, {_META_ACCOUNT.format(key="doc_id % 5")}, status_ AS status,
  CASE doc_id % 5 WHEN 0 THEN CONCAT('feed ', lang) WHEN 1 THEN NULL
    ELSE COALESCE(NULLIF(video_data_title_, ''), NULLIF(link_data_name_, '')) END AS headline,
  CASE WHEN doc_id % 5 = 0 THEN CONCAT('feed body ', doc_id)
    ELSE COALESCE(NULLIF(video_data_message_, ''), NULLIF(link_data_message_, '')) END AS body,
  CASE WHEN doc_id % 5 = 0 THEN CONCAT('feed/', doc_id) ELSE COALESCE(NULLIF(link_data_link_, ''), url_tags_) END
    AS destination_url,
  button2 AS call_to_action_type,
  CASE WHEN COALESCE(image2, '') = '' AND doc_id % 5 = 2 THEN CONCAT('feed image/', doc_id) ELSE image2 END AS image_url
FROM video
"""

DIMENSIONS = {
    "google_ads_ad_dim": AD_DIM,
    "google_ads_audience_dim": AUDIENCE_DIM,
    "google_ads_pmax_asset_dim": ASSET_DIM,
    "meta_ads_ad_dim": META_AD_DIM,
    "meta_ads_creative_dim": CREATIVE_DIM,
}
