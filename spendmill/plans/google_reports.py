"""Search-platform reports: 14 daily facts and 3 dimensions.

The facts are one operator with different parameters, so they share the account, campaign, ad group and metric
columns and each adds its own.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from spendmill import functions as fn
from spendmill.fixed_values import ASSET_CHANNEL_TYPES, AUDIENCE_TYPES, KEYWORD_CRITERION
from spendmill.plans.spec import (
    Field,
    ReportSpec,
    identifier,
    lenient_day,
    measure,
    money,
    optional_identifier,
    plain,
    resource_tail,
    whole,
    whole_or_zero,
)

DAY = (lenient_day("date", "segments.date"),)
ACCOUNT = (identifier("account_id", "customer.id"), plain("account_name", "customer.descriptive_name"))
CAMPAIGN = (
    identifier("campaign_id", "campaign.id"),
    plain("campaign_name", "campaign.name"),
    plain("campaign_status", "campaign.status"),
)
AD_GROUP = (identifier("ad_group_id", "ad_group.id"), plain("ad_group_name", "ad_group.name"))
TRAFFIC = (
    whole("impressions", "metrics.impressions"),
    whole("clicks", "metrics.clicks"),
    measure("ctr", "metrics.ctr"),
    money("average_cpc", "metrics.average_cpc.micros"),
    whole("cost_micros", "metrics.cost_micros"),
)
CONVERSIONS = (
    measure("conversions", "metrics.conversions"),
    measure("conversions_value", "metrics.conversions_value"),
    measure("all_conversions", "metrics.all_conversions"),
)
VIEW_THROUGH = (measure("view_through_conversions", "metrics.view_through_conversions"),)
ENGAGEMENTS = (whole("engagements", "metrics.engagements"),)
BIDDING = (plain("bidding_strategy_type", "campaign.bidding_strategy_type"),)
CURRENCY = (plain("currency", "customer.currency_code"),)

METRICS = TRAFFIC + CONVERSIONS
CHANNEL_TYPE = (("campaign.advertising_channel_type", "string"),)


def _serves_assets():
    return F.col("campaign.advertising_channel_type").isin(*ASSET_CHANNEL_TYPES)


def _fact(
    table: str,
    own: tuple[Field, ...],
    cluster_by: str,
    *,
    before_account: tuple[Field, ...] = (),
    level: tuple[Field, ...] = AD_GROUP,
    metrics: tuple[Field, ...] = METRICS,
    closing: tuple[Field, ...] = BIDDING + CURRENCY,
    **filters,
) -> ReportSpec:
    fields = DAY + before_account + ACCOUNT + CAMPAIGN + level + own + metrics + closing
    return ReportSpec(table, "google", fields, cluster_by=tuple(cluster_by.split()), **filters)


FACTS = (
    _fact(
        "google_ads_performance",
        (
            optional_identifier("ad_id", "ad_group_ad.ad.id"),
            plain("ad_name", "ad_group_ad.ad.name"),
            plain("ad_type", "ad_group_ad.ad.type"),
            plain("ad_network_type", "segments.ad_network_type"),
            plain("device", "segments.device"),
        ),
        "account_id campaign_id ad_group_id ad_id",
        metrics=METRICS + VIEW_THROUGH + ENGAGEMENTS,
    ),
    _fact(
        "google_ads_age_range",
        (plain("age_range", "ad_group_criterion.age_range.type"),),
        "account_id campaign_id ad_group_id age_range",
        metrics=METRICS + VIEW_THROUGH + ENGAGEMENTS,
    ),
    _fact(
        "google_ads_gender",
        (plain("gender", "ad_group_criterion.gender.type"),),
        "account_id campaign_id ad_group_id gender",
        metrics=METRICS + VIEW_THROUGH + ENGAGEMENTS,
    ),
    _fact(
        "google_ads_audience",
        (resource_tail("audience_criterion_id", "ad_group_audience_view.resource_name", "~"),),
        "account_id campaign_id audience_criterion_id",
        metrics=METRICS + VIEW_THROUGH + ENGAGEMENTS,
    ),
    _fact(
        "google_ads_keywords",
        (
            identifier("keyword_id", "ad_group_criterion.criterion_id"),
            plain("keyword_text", "ad_group_criterion.keyword.text"),
            plain("keyword_match_type", "ad_group_criterion.keyword.match_type"),
            whole_or_zero("quality_score", "ad_group_criterion.quality_info.quality_score"),
        ),
        "account_id campaign_id ad_group_id keyword_id",
        row_filter=lambda: F.col("ad_group_criterion.type") == KEYWORD_CRITERION,
        filter_reads=(("ad_group_criterion.type", "string"),),
    ),
    _fact(
        "google_ads_search_terms",
        (
            plain("search_term", "search_term_view.search_term"),
            resource_tail("keyword_id", "segments.keyword.ad_group_criterion", "~", blank_as_null=True),
        ),
        "account_id campaign_id ad_group_id keyword_id",
    ),
    _fact(
        "google_ads_geo",
        (
            identifier("geo_criterion_id", "geographic_view.country_criterion_id"),
            plain("location_type", "geographic_view.location_type"),
        ),
        "account_id campaign_id ad_group_id geo_criterion_id",
        metrics=METRICS + VIEW_THROUGH,
    ),
    _fact(
        "google_ads_user_location",
        (
            identifier("user_geo_criterion_id", "user_location_view.country_criterion_id"),
            plain("is_targeting_location", "user_location_view.targeting_location", "boolean"),
        ),
        "account_id campaign_id ad_group_id user_geo_criterion_id",
        metrics=METRICS + VIEW_THROUGH,
    ),
    _fact(
        "google_ads_schedule",
        (),
        "account_id campaign_id day_of_week hour",
        before_account=(plain("day_of_week", "segments.day_of_week"), plain("hour", "segments.hour", "bigint")),
    ),
    _fact(
        "google_ads_landing_page",
        (plain("landing_page_url", "landing_page_view.unexpanded_final_url"),),
        "account_id campaign_id ad_group_id",
    ),
    _fact(
        "google_ads_conversion_action",
        (
            resource_tail("conversion_action_id", "segments.conversion_action", "/"),
            plain("conversion_action_name", "segments.conversion_action_name"),
            plain("conversion_category", "segments.conversion_action_category"),
        ),
        "account_id campaign_id conversion_action_name",
        level=(),
        metrics=CONVERSIONS + (measure("all_conversions_value", "metrics.all_conversions_value"),),
        row_filter=lambda: F.col("metrics.conversions") > 0,
    ),
    _fact(
        "google_ads_group_placement_view",
        (
            plain("placement_resource_name", "group_placement_view.placement"),
            plain("placement_display_name", "group_placement_view.display_name"),
        ),
        "account_id campaign_id ad_group_id placement_display_name",
        metrics=METRICS + VIEW_THROUGH + ENGAGEMENTS,
    ),
    _fact(
        "google_ads_budget_pacing",
        (
            whole("daily_budget_micros", "campaign_budget.amount_micros"),
            whole("total_budget_micros", "campaign_budget.total_amount_micros"),
            plain("budget_type", "campaign_budget.type"),
        ),
        "account_id campaign_id",
        level=(),
        metrics=(
            whole("cost_micros", "metrics.cost_micros"),
            measure("search_budget_lost_is", "metrics.search_budget_lost_impression_share"),
            measure("content_budget_lost_is", "metrics.content_budget_lost_impression_share"),
        ),
    ),
    _fact(
        "google_ads_pmax_asset",
        (
            identifier("asset_id", "asset.id"),
            plain("asset_type", "asset.type"),
            plain("asset_text", "asset.text_asset.text"),
        ),
        "account_id campaign_id asset_group_id asset_id",
        level=(identifier("asset_group_id", "asset_group.id"), plain("asset_group_name", "asset_group.name")),
        row_filter=_serves_assets,
        filter_reads=CHANNEL_TYPE,
    ),
)

_TEXTS = "array<struct<text: string>>"
_AD_ASSETS = (
    ("ad.type", "string"),
    ("ad.responsive_search_ad.headlines", _TEXTS),
    ("ad.responsive_search_ad.descriptions", _TEXTS),
    ("ad.responsive_display_ad.headlines", _TEXTS),
    ("ad.responsive_display_ad.descriptions", _TEXTS),
    ("ad.responsive_display_ad.long_headline.text", "string"),
    ("ad.expanded_text_ad.headline_part1", "string"),
    ("ad.expanded_text_ad.headline_part2", "string"),
    ("ad.expanded_text_ad.headline_part3", "string"),
    ("ad.expanded_text_ad.description", "string"),
    ("ad.expanded_text_ad.description2", "string"),
)

DIMENSIONS = (
    ReportSpec(
        "google_ads_ad_dim",
        "google",
        (
            identifier("ad_id", "ad.id"),
            plain("ad_type", "ad.type"),
            Field(
                "final_urls",
                "array<string>",
                lambda: F.coalesce(F.col("ad.final_urls"), F.array().cast("array<string>")),
                (("ad.final_urls", "array<string>"),),
            ),
            Field("headlines", "array<string>", lambda: fn.asset_headlines(F.col("ad")), _AD_ASSETS),
            Field("descriptions", "array<string>", lambda: fn.asset_descriptions(F.col("ad")), _AD_ASSETS),
        ),
        dedupe_keys=("ad_id",),
    ),
    ReportSpec(
        "google_ads_audience_dim",
        "google",
        (
            identifier("ad_group_id", "ad_group.id"),
            identifier("audience_criterion_id", "ad_group_criterion.criterion_id"),
            plain("audience_name", "ad_group_criterion.display_name"),
            plain("audience_type", "ad_group_criterion.type"),
        ),
        row_filter=lambda: F.col("ad_group_criterion.type").isin(*AUDIENCE_TYPES),
        dedupe_keys=("audience_criterion_id",),
    ),
    ReportSpec(
        "google_ads_pmax_asset_dim",
        "google",
        (
            identifier("asset_group_id", "asset_group.id"),
            plain("asset_group_name", "asset_group.name"),
            identifier("asset_id", "asset.id"),
            plain("asset_type", "asset.type"),
            Field(
                "asset_content",
                "string",
                lambda: fn.default_if_blank("asset.text_asset.text", F.col("asset.name")),
                (("asset.text_asset.text", "string"), ("asset.name", "string")),
            ),
            plain("field_type", "asset_group_asset.field_type"),
            plain("asset_status", "asset_group_asset.status"),
        ),
        row_filter=_serves_assets,
        filter_reads=CHANNEL_TYPE,
        dedupe_keys=("asset_group_id", "asset_id", "field_type"),
    ),
)
