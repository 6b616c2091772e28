"""Social-platform reports: 2 daily facts and 2 dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from spendmill import functions as fn
from spendmill.fixed_values import META_ACCOUNT_PREFIX, UNKNOWN_BREAKDOWN
from spendmill.plans.spec import (
    Field,
    ReportSpec,
    constant,
    listed_total,
    number_text,
    plain,
    required_text,
    strict_day,
    whole_text,
)

WHO = tuple(
    required_text(name, name)
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
)
_REACHED = (whole_text("impressions", "impressions"), whole_text("clicks", "clicks"), number_text("spend", "spend"))
_OUTCOME = (listed_total("conversions", "actions"), listed_total("conversion_value", "action_values"))
# The insight has no currency of its own; the account listing has.
CURRENCY = (Field("currency", "string", lambda: F.col("account.currency"), (("account.currency", "string"),)),)


def _breakdown(name: str) -> Field:
    return Field(name, "string", lambda: F.coalesce(F.col(name), F.lit(UNKNOWN_BREAKDOWN)), ((name, "string"),))


FACTS = (
    ReportSpec(
        "meta_ads_performance",
        "meta",
        (
            strict_day("date", "date_start"),
            *WHO,
            *_REACHED,
            number_text("ctr", "ctr"),
            number_text("average_cpc", "cpc"),
            number_text("cpm", "cpm"),
            whole_text("reach", "reach"),
            number_text("frequency", "frequency"),
            *_OUTCOME,
            *CURRENCY,
        ),
        cluster_by=("account_id", "campaign_id", "ad_id"),
        chunked=True,
    ),
    ReportSpec(
        "meta_ads_age_gender",
        "meta",
        (
            strict_day("date", "date_start"),
            *WHO,
            _breakdown("age"),
            _breakdown("gender"),
            *_REACHED,
            number_text("ctr", "ctr"),
            # This report never requests these four, so they are always zero.
            constant("average_cpc", "double", 0.0),
            constant("cpm", "double", 0.0),
            constant("reach", "bigint", 0),
            constant("frequency", "double", 0.0),
            *_OUTCOME,
            *CURRENCY,
        ),
        cluster_by=("account_id", "campaign_id", "age", "gender"),
        chunked=True,
    ),
)

_ACCOUNT = (
    Field(
        "account_id",
        "string",
        lambda: fn.without_prefix("account.key", META_ACCOUNT_PREFIX),
        (("account.key", "string"),),
    ),
    Field("account_name", "string", lambda: F.col("account.name"), (("account.name", "string"),)),
)

_CREATIVE_PATHS = (
    ("image_url", "string"),
    ("thumbnail_url", "string"),
    ("url_tags", "string"),
    ("call_to_action_type", "string"),
    ("object_story_spec.link_data.name", "string"),
    ("object_story_spec.link_data.message", "string"),
    ("object_story_spec.link_data.link", "string"),
    ("object_story_spec.link_data.picture", "string"),
    ("object_story_spec.link_data.call_to_action.type", "string"),
    ("object_story_spec.video_data.title", "string"),
    ("object_story_spec.video_data.message", "string"),
    ("object_story_spec.video_data.image_url", "string"),
    ("object_story_spec.video_data.call_to_action.type", "string"),
    ("asset_feed_spec.titles", "array<struct<text: string>>"),
    ("asset_feed_spec.bodies", "array<struct<text: string>>"),
    ("asset_feed_spec.link_urls", "array<struct<website_url: string>>"),
    ("asset_feed_spec.images", "array<struct<url: string>>"),
)


def _detail(name: str) -> Field:
    def value():
        return fn.creative_detail(
            name,
            image_url=F.col("image_url"),
            thumbnail_url=F.col("thumbnail_url"),
            url_tags=F.col("url_tags"),
            button=F.col("call_to_action_type"),
            story=F.col("object_story_spec"),
            feed=F.col("asset_feed_spec"),
        )

    return Field(name, "string", value, _CREATIVE_PATHS)


DIMENSIONS = (
    ReportSpec(
        "meta_ads_ad_dim",
        "meta",
        (
            required_text("ad_id", "id"),
            plain("ad_name", "name"),
            *_ACCOUNT,
            plain("status", "status"),
            plain("creative_id", "creative.id"),
            plain("created_time", "created_time"),
            plain("updated_time", "updated_time"),
        ),
        dedupe_keys=("ad_id",),
    ),
    ReportSpec(
        "meta_ads_creative_dim",
        "meta",
        (
            required_text("creative_id", "id"),
            plain("creative_name", "name"),
            *_ACCOUNT,
            plain("status", "status"),
            _detail("headline"),
            _detail("body"),
            _detail("destination_url"),
            _detail("call_to_action_type"),
            _detail("image_url"),
        ),
        dedupe_keys=("creative_id",),
    ),
)
