"""Declared schemas, and the flattening of small landed fixtures."""

import re
from datetime import date

import pytest

from spendmill.plans.catalog import DIMENSIONS, FACTS, REPORTS
from spendmill.plans.loads import clean_rows, dimension_rows, flatten_report
from spendmill.plans.spec import VIOLATION
from tests.conftest import ROOT
from tests.helpers import geo_row, google_listing, insight, land, meta_listing

GEO, INSIGHTS, AGES = (FACTS[n] for n in ("google_ads_geo", "meta_ads_performance", "meta_ads_age_gender"))


def documented():
    text = (ROOT / "FIXTURES.md").read_text()
    found = re.findall(r"^### `(\w+)`.*?```\n(.*?)```", text, flags=re.M | re.S)
    return {name: [tuple(c.split()) for c in ddl.replace("\n", " ").split(",")] for name, ddl in found}


def test_all_reports_are_specified():
    assert set(documented()) == set(REPORTS)
    assert (len(FACTS), len(DIMENSIONS)) == (16, 5)


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_output_schema(spark, name):
    spec = REPORTS[name]
    declared = [tuple(column.split(" ", 1)) for column in spec.output_ddl.split(", ")]
    assert declared == documented()[name]
    landed = spark.createDataFrame([], spec.landed_schema)
    listing = google_listing(spark, 1) if spec.platform == "google" else meta_listing(spark, 1)
    kinds = dict(flatten_report(spec, landed, listing).dtypes)
    assert [(f.name, kinds[f.name]) for f in spec.fields] == declared[:-1]


def test_scan_reads_only_used_fields(spark, tmp_path):
    landed = land(spark, GEO, [geo_row(1, "2024-01-05")], tmp_path / "l")
    assert "advertising_channel_type" not in landed.schema.simpleString()
    assert "engagements" not in landed.schema.simpleString()


def flat(spark, spec, rows, tmp_path, *accounts, excluded=()):
    listing = google_listing(spark, *accounts) if spec.platform == "google" else meta_listing(spark, *accounts)
    landed = land(spark, spec, rows, tmp_path / "landed")
    return flatten_report(spec, landed, listing, excluded)


def test_google_fact_rules(spark, tmp_path):
    rows = [
        geo_row(1, "2024-01-05", 1),
        geo_row(1, "2024-01-05", 1),  # equal rows are both kept
        geo_row(1, "bad", 2),  # row without a date: kept by the projection
        geo_row(1, "2024-01-05", 3, average_cpc=None),
        geo_row(1, "2024-01-05", 4, average_cpc=1.5),  # another shape than expected reads as null
        geo_row(1, "2024-01-05", 5, ctr=None),
        geo_row(1, "2024-01-05", 6, clicks=None),  # breaks the contract
        geo_row(9, "2024-01-05", 7),  # not listed
    ]
    got = {r["geo_criterion_id"]: r for r in flat(spark, GEO, rows, tmp_path, 1).orderBy("row_ord").collect()}
    assert set(got) == {"2001", "2002", "2003", "2004", "2005", "2006"}
    assert got["2001"]["date"] == date(2024, 1, 5) and got["2002"]["date"] is None
    assert got["2001"]["average_cpc"] == 1.5
    assert got["2003"]["average_cpc"] is None and got["2004"]["average_cpc"] is None
    assert got["2004"]["clicks"] == 2
    assert got["2005"]["ctr"] is None and got["2005"][VIOLATION] is None
    assert got["2006"][VIOLATION] == "metrics.clicks is missing"
    clean = clean_rows(GEO, flat(spark, GEO, rows, tmp_path, 1))
    assert sorted(r["geo_criterion_id"] for r in clean.collect()) == ["2001", "2001", "2003", "2004", "2005"]


def test_rows_without_an_account_are_reported(spark, tmp_path):
    orphan = {**geo_row(1, "2024-01-05"), "requested_account": None}
    got = flat(spark, GEO, [orphan], tmp_path, 1).collect()
    assert [r[VIOLATION] for r in got] == ["row names no account"]


def test_excluded_accounts(spark, tmp_path):
    rows = [geo_row(a, "2024-01-05") for a in (1, 2, 3)]
    got = flat(spark, GEO, rows, tmp_path, 1, 2, 3, excluded=["2"]).collect()
    assert sorted(r["account_id"] for r in got) == ["1", "3"]


def test_insight_rules(spark, tmp_path):
    rows = [
        insight(1, "2024-01-05", 1),
        insight(1, "2024-01-05", 2, actions=None, action_values=[], clicks=None, spend=None),
        insight(1, "2024-01-05", 3, impressions="12.0"),
        insight(1, "05/01/2024", 4),
        insight(1, "2024-01-05", 5, ad_name=None),
        insight(1, "2024-01-05", 6, actions=[{"action_type": "x"}]),
    ]
    got = {r["ad_id"]: r for r in flat(spark, INSIGHTS, rows, tmp_path, 1).collect()}
    assert (got["a1"]["conversions"], got["a1"]["conversion_value"], got["a1"]["currency"]) == (2.5, 40.25, "EUR")
    assert (got["a2"]["conversions"], got["a2"]["conversion_value"]) == (0.0, 0.0)
    assert (got["a2"]["clicks"], got["a2"]["spend"]) == (0, 0.0)
    assert {k: r[VIOLATION] for k, r in got.items()} == {
        "a1": None,
        "a2": None,
        "a3": "impressions is no integer",
        "a4": "date_start is no date",
        "a5": "ad_name is missing",
        "a6": "actions holds a value that is no number",
    }


def test_breakdowns(spark, tmp_path):
    rows = [insight(1, "2024-01-05", 1, age="18-24", gender=""), insight(1, "2024-01-05", 2)]
    got = {r["ad_id"]: r for r in flat(spark, AGES, rows, tmp_path, 1).collect()}
    assert (got["a1"]["age"], got["a1"]["gender"]) == ("18-24", "")
    assert (got["a2"]["age"], got["a2"]["gender"]) == ("Unknown", "Unknown")
    assert [got["a1"][c] for c in ("average_cpc", "cpm", "reach", "frequency")] == [0.0, 0.0, 0, 0.0]


def creative(name, **parts):
    return {"id": name, "requested_account": "act_1", "account_ord": 1, "row_ord": 1, **parts}


LINK = {"name": "N", "message": "M", "link": "L", "picture": "P", "call_to_action": {"type": "LINK"}}
VIDEO = {"title": "T", "message": "V", "image_url": "I", "call_to_action": {"type": "VIDEO"}}
CREATIVES = [
    (creative("link", object_story_spec={"link_data": LINK}, url_tags="u"), ("N", "M", "L", "LINK", "P")),
    (creative("video", object_story_spec={"video_data": VIDEO}, url_tags="u"), ("T", "V", "u", "VIDEO", "I")),
    (
        creative("both", object_story_spec={"link_data": LINK, "video_data": VIDEO}, image_url="own"),
        ("T", "V", "L", "LINK", "own"),
    ),
    (
        creative("link-without-button", object_story_spec={"link_data": {"name": "N"}, "video_data": VIDEO}),
        ("T", "V", None, "VIDEO", "I"),
    ),
    (
        creative(
            "null-first-title",
            object_story_spec={"link_data": LINK},
            asset_feed_spec={"titles": [{}, {"text": "2"}], "bodies": [{"text": "B"}], "link_urls": [{"website_url": "W"}]},
        ),
        (None, "B", "W", "LINK", "P"),
    ),
    (
        creative(
            "empty-feed",
            object_story_spec={"link_data": LINK},
            asset_feed_spec={"titles": [], "bodies": [], "link_urls": [], "images": []},
        ),
        ("N", "M", "L", "LINK", "P"),
    ),
    (creative("feed-image", asset_feed_spec={"images": [{"url": "F"}]}), (None, None, None, None, "F")),
    (creative("thumbnail", image_url="", thumbnail_url="t", call_to_action_type="OWN"), (None, None, None, "OWN", "t")),
    (creative("tags", url_tags=""), (None, None, "", None, None)),
    (creative("nothing"), (None, None, None, None, None)),
]


def test_creative_precedence(spark, tmp_path):
    spec = DIMENSIONS["meta_ads_creative_dim"]
    rows = flat(spark, spec, [c for c, _ in CREATIVES], tmp_path, 1)
    columns = ("headline", "body", "destination_url", "call_to_action_type", "image_url")
    got = {r["creative_id"]: tuple(r[c] for c in columns) for r in rows.collect()}
    assert got == {c["id"]: expected for c, expected in CREATIVES}


def test_asset_dimension(spark, tmp_path):
    spec = DIMENSIONS["google_ads_pmax_asset_dim"]

    def asset(account, n, group, asset_id, role, text, name="file", channel="SMART"):
        return {
            "asset_group": {"id": group, "name": "G"},
            "asset": {"id": asset_id, "name": name, "type": "TEXT", "text_asset": {"text": text}},
            "asset_group_asset": {"field_type": role, "status": "ENABLED"},
            "campaign": {"advertising_channel_type": channel},
            "requested_account": str(account),
            "account_ord": account,
            "row_ord": n,
        }

    rows = [
        asset(2, 1, 1, 1, "HEADLINE", "from account 2"),
        asset(1, 2, 1, 1, "HEADLINE", "second row of account 1"),
        asset(1, 1, 1, 1, "HEADLINE", ""),
        asset(1, 3, 1, 1, "DESCRIPTION", "text"),
        asset(1, 4, 1, 2, "HEADLINE", "search", channel="SEARCH"),
    ]
    got = dimension_rows(spec, flat(spark, spec, rows, tmp_path, 1, 2)).collect()
    assert sorted((r["asset_id"], r["field_type"], r["asset_content"]) for r in got) == [
        ("1", "DESCRIPTION", "text"),
        ("1", "HEADLINE", "file"),
    ]


def test_audience_types(spark, tmp_path):
    spec = DIMENSIONS["google_ads_audience_dim"]
    kinds = ["AFFINITY", "IN_MARKET", "USER_LIST", "CUSTOM_AUDIENCE", "CUSTOM_INTENT", "KEYWORD", None]
    rows = [
        {
            "ad_group": {"id": 1},
            "ad_group_criterion": {"criterion_id": i, "display_name": "n", "type": kind},
            "requested_account": "1",
            "account_ord": 1,
            "row_ord": i,
        }
        for i, kind in enumerate(kinds)
    ]
    got = flat(spark, spec, rows, tmp_path, 1).collect()
    assert [r["audience_type"] for r in sorted(got, key=lambda r: r["audience_criterion_id"])] == kinds[:5]
