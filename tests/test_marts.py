from datetime import date

from spendmill.operators import lookups
from spendmill.operators.dedupe import keep_first
from spendmill.plans import marts

FACTS = (
    "account_id string, campaign_id string, currency string, date date, impressions bigint, clicks bigint, "
    "cost_micros bigint, conversions_value double"
)


def facts(spark, *rows):
    return spark.createDataFrame([("a", "c", currency, date.fromisoformat(d), *rest) for currency, d, *rest in rows], FACTS)


def test_return_on_spend(spark):
    rows = facts(
        spark,
        ("EUR", "2024-01-01", 1, 1, 2_000_000, 3.0),
        ("EUR", "2024-01-31", 1, 1, 2_000_000, 3.0),
        ("EUR", "2024-02-01", 1, 1, 0, 5.0),
        ("USD", "2024-01-01", 1, 1, 1_000_000, 0.0),
    )
    got = {(r["currency"], str(r["period_start"])): (r["cost"], r["value"], r["roas"], r["roi"]) for r in marts.return_on_spend(rows).collect()}
    assert got == {
        ("EUR", "2024-01-01"): (4.0, 6.0, 1.5, 0.5),
        ("EUR", "2024-02-01"): (0.0, 5.0, None, None),
        ("USD", "2024-01-01"): (1.0, 0.0, 0.0, -1.0),
    }


def test_year_over_year_on_a_leap_day(spark):
    rows = facts(
        spark,
        ("EUR", "2023-02-28", 1, 1, 100, 0.0),
        ("EUR", "2024-02-28", 1, 1, 150, 0.0),
        ("EUR", "2024-02-29", 1, 1, 200, 0.0),
    )
    got = {str(r["date"]): (r["previous_cost_micros"], r["cost_change"]) for r in marts.year_over_year(rows).collect()}
    assert got == {"2023-02-28": (None, None), "2024-02-28": (100, 0.5), "2024-02-29": (100, 1.0)}


def test_year_to_date(spark):
    rows = facts(spark, *[("EUR", d, 1, 1, 10, 0.0) for d in ("2023-12-31", "2024-01-01", "2024-01-01", "2024-03-01")])
    got = {str(r["date"]): r["cost_micros_ytd"] for r in marts.year_to_date(rows).collect()}
    assert got == {"2023-12-31": 10, "2024-01-01": 20, "2024-03-01": 30}


def test_pacing(spark):
    rows = spark.createDataFrame(
        [("a", "c", "EUR", date(2024, 1, d), 10, cost) for d, cost in ((1, 5), (2, 15), (2, 10))]
        + [("a", "c", "EUR", date(2024, 2, 1), 0, 7)],
        "account_id string, campaign_id string, currency string, date date, daily_budget_micros bigint, cost_micros bigint",
    )
    got = {str(r["date"]): r["pacing"] for r in marts.budget_pacing(rows).collect()}
    assert got == {"2024-01-01": 0.5, "2024-01-02": 1.5, "2024-02-01": None}


def test_pacing_counts_days_without_a_row(spark):
    rows = spark.createDataFrame(
        [("a", "c", "EUR", date(2024, 1, 29), 10, 5), ("a", "c", "EUR", date(2024, 1, 31), None, 5), ("a", "c", "EUR", date(2024, 3, 3), 20, 8)],
        "account_id string, campaign_id string, currency string, date date, daily_budget_micros bigint, cost_micros bigint",
    )
    got = {str(r["date"])[5:]: (r["cost_to_date"] * 1e6, r["budget_to_date"] * 1e6) for r in marts.budget_pacing(rows).collect()}
    january = {"01-29": (5, 10), "01-30": (5, 20), "01-31": (10, 30)}
    # February has no row and no line; March begins on its first with the budget known then.
    assert got == january | {"03-01": (0, 10), "03-02": (0, 20), "03-03": (8, 40)}
    later = {str(r["date"])[5:]: r["budget_to_date"] * 1e6 for r in marts.budget_pacing(rows, date(2024, 3, 5)).collect()}
    assert (later["03-03"], later["03-05"]) == (40, 80) and len(later) == 8


def test_weighted_ratios(spark):
    rows = facts(spark, ("EUR", "2024-01-01", 10, 5, 5_000_000, 0.0), ("EUR", "2024-01-01", 90, 5, 0, 0.0), ("USD", "2024-01-01", 0, 0, 0, 0.0))
    got = {r["currency"]: (r["ctr"], r["cpc"]) for r in marts.weighted_ratios(rows, ["account_id"]).collect()}
    assert got == {"EUR": (0.1, 0.5), "USD": (None, None)}


def test_cross_platform_never_adds_currencies(spark):
    google = facts(spark, ("EUR", "2024-01-01", 1, 1, 1_500_000, 0.0), ("USD", "2024-01-01", 1, 1, 1_000_000, 0.0))
    meta = spark.createDataFrame(
        [("a", "c", "EUR", date(2024, 1, 1), 2, 0.25)] * 2,
        "account_id string, campaign_id string, currency string, date date, clicks bigint, spend double",
    )
    got = sorted((r["platform"], r["currency"], r["spend"], r["clicks"]) for r in marts.cross_platform_spend(google, meta).collect())
    assert got == [("google", "EUR", 1.5, 1), ("google", "USD", 1.0, 1), ("meta", "EUR", 0.5, 4)]


def test_keep_first_treats_null_keys_as_equal(spark):
    rows = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "k string, n int")
    assert sorted((r["k"] or "", r["n"]) for r in keep_first(rows, ["k"], ["n"]).collect()) == [("", 1), ("a", 3)]


def test_asset_lookup_fans_out_by_role(spark):
    clicks = spark.createDataFrame([("g", "1", 5), ("g", "2", 6)], "asset_group_id string, asset_id string, clicks int")
    dim = spark.createDataFrame(
        [("g", "1", "t", "HEADLINE", "ENABLED"), ("g", "1", "t", "DESCRIPTION", "PAUSED")],
        "asset_group_id string, asset_id string, asset_content string, field_type string, asset_status string",
    )
    got = sorted((r["asset_id"], r["field_type"] or "", r["clicks"]) for r in lookups.with_asset(clicks, dim).collect())
    assert got == [("1", "DESCRIPTION", 5), ("1", "HEADLINE", 5), ("2", "", 6)]


def test_keyword_lookup_keeps_the_row_count(spark):
    ddl = "account_id string, ad_group_id string, keyword_id string, date date, "
    key = ("a", "g", "k", date(2024, 1, 1))
    terms = spark.createDataFrame([(*key, "t1"), (*key, "t2"), ("a", "g", None, date(2024, 1, 1), "t3")], ddl + "search_term string")
    keywords = spark.createDataFrame([(*key, "y"), (*key, "x")], ddl + "keyword_text string")
    got = lookups.with_keyword(terms, keywords, {"keyword_text": "keyword_text"})
    assert sorted((r["search_term"], r["keyword_text"]) for r in got.collect()) == [("t1", "x"), ("t2", "x"), ("t3", None)]
