"""Lookups and marts over report rows, with the same figures in SQL.

Marts read flattened reports; their oracles start from the report oracles, so the chain from landed row to figure is
checked end to end. Ratios are compared exactly: both engines divide the same two exact sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendmill.operators import lookups
from spendmill.plans import marts
from spendmill.verify.landing import table
from spendmill.verify.operator_queries import query
from spendmill.verify.oracles import ASSET_DIM, AUDIENCE_DIM, CREATIVE_DIM, META_AD_DIM, load_fact, scan_fact
from spendmill.verify.queries import load_restated, scan

PERFORMANCE = scan_fact("google_ads_performance")
BUDGETS = scan_fact("google_ads_budget_pacing")
META = scan_fact("meta_ads_performance")
VALUE_MICROS = "CAST(ROUND_EVEN(conversions_value * 1e6, 0) AS BIGINT)"
SPEND_MICROS = "CAST(ROUND_EVEN(spend * 1e6, 0) AS BIGINT)"


@query(
    "q26_roas",
    f"""SELECT account_id, campaign_id, currency, period_start, cost / 1e6 AS cost, value / 1e6 AS value,
          value / CAST(NULLIF(cost, 0) AS DOUBLE) AS roas, (value - cost) / CAST(NULLIF(cost, 0) AS DOUBLE) AS roi
        FROM (SELECT account_id, campaign_id, currency, CAST(DATE_TRUNC('month', date) AS DATE) AS period_start,
            CAST(SUM(cost_micros) AS BIGINT) AS cost, CAST(SUM({VALUE_MICROS}) AS BIGINT) AS value
          FROM ({PERFORMANCE}) GROUP BY ALL)""",
)
def roas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.return_on_spend(scan("google_ads_performance", spark, sf_dir))


def pacing_sql(daily: str) -> str:
    """Pacing over a calendar that SQL generates, from daily cost and budget."""
    keys = "account_id, campaign_id, currency"
    return f"""WITH daily AS ({daily}),
        spans AS (SELECT {keys}, CAST(DATE_TRUNC('month', date) AS DATE) AS m, MAX(date) AS e FROM daily GROUP BY ALL),
        firsts AS (SELECT {keys}, MIN(date) AS f FROM daily GROUP BY ALL),
        days AS (SELECT {keys}, CAST(UNNEST(GENERATE_SERIES(GREATEST(m, f), e, INTERVAL 1 DAY)) AS DATE) AS date
          FROM spans JOIN firsts USING ({keys})),
        costs AS (SELECT d.*, COALESCE(c.cost, 0) AS cost FROM days d LEFT JOIN daily c USING ({keys}, date)),
        filled AS (SELECT c.*, k.budget FROM costs c ASOF LEFT JOIN (SELECT * FROM daily WHERE budget IS NOT NULL) k
          ON c.account_id = k.account_id AND c.campaign_id = k.campaign_id AND c.currency = k.currency AND c.date >= k.date),
        running AS (SELECT *, CAST(SUM(cost) OVER w AS BIGINT) AS c, CAST(SUM(budget) OVER w AS BIGINT) AS b FROM filled
          WINDOW w AS (PARTITION BY {keys}, DATE_TRUNC('month', date) ORDER BY date))
        SELECT {keys}, date, c / 1e6 AS cost_to_date, b / 1e6 AS budget_to_date,
          c / CAST(NULLIF(b, 0) AS DOUBLE) AS pacing FROM running"""


@query(
    "q27_pacing",
    pacing_sql(
        f"""SELECT account_id, campaign_id, currency, date, CAST(SUM(cost_micros) AS BIGINT) AS cost,
            MAX(daily_budget_micros) AS budget FROM ({BUDGETS}) GROUP BY ALL"""
    ),
)
def pacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.budget_pacing(scan("google_ads_budget_pacing", spark, sf_dir))


# Every customer as a campaign: most days have no row, and some rows no budget.
SPARSE = {
    "account_id": "CAST(o_custkey % 12 AS STRING)",
    "campaign_id": "CAST(o_custkey AS STRING)",
    "currency": "CASE WHEN o_custkey % 12 < 6 THEN 'USD' ELSE 'EUR' END",
    "date": "CAST(o_orderdate AS DATE)",
    "cost_micros": "CAST(ROUND(o_totalprice * 1000000) AS BIGINT)",
    "daily_budget_micros": "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE (o_orderkey % 40 + 1) * 1000000 END",
}


@query(
    "pacing_sparse_days",
    pacing_sql(
        "SELECT account_id, campaign_id, currency, date, CAST(SUM(cost_micros) AS BIGINT) AS cost, "
        "MAX(daily_budget_micros) AS budget FROM (SELECT "
        + ", ".join(f"{sql} AS {name}" for name, sql in SPARSE.items())
        + " FROM orders) GROUP BY ALL"
    ),
)
def pacing_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaigns with few days of activity: the days between count with the last budget."""
    rows = table(spark, sf_dir, "orders").selectExpr(*[f"{sql} AS {name}" for name, sql in SPARSE.items()])
    return marts.budget_pacing(rows)


# Seven years of orders seen as a daily fact, for the marts that compare years.
YEARS = {
    "account_id": "CAST(o_custkey % 12 AS STRING)",
    "campaign_id": "o_orderpriority",
    "currency": "CASE WHEN o_custkey % 12 < 6 THEN 'USD' ELSE 'EUR' END",
    "date": "CAST(o_orderdate AS DATE)",
    "cost_micros": "CAST(ROUND(o_totalprice * 1000000) AS BIGINT)",
    "clicks": "o_orderkey % 5",
}
YEARS_DAILY = (
    "SELECT account_id, campaign_id, currency, date, CAST(SUM(cost_micros) AS BIGINT) AS cost_micros, "
    "CAST(SUM(clicks) AS BIGINT) AS clicks FROM (SELECT "
    + ", ".join(f"{sql} AS {name}" for name, sql in YEARS.items())
    + " FROM orders) GROUP BY ALL"
)


def years_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*[f"{sql} AS {name}" for name, sql in YEARS.items()])


@query(
    "q28_yoy",
    f"""WITH d AS ({YEARS_DAILY})
        SELECT d.account_id, d.campaign_id, d.currency, d.date, d.cost_micros, p.cost_micros AS previous_cost_micros,
          d.clicks, p.clicks AS previous_clicks,
          (d.cost_micros - p.cost_micros) / CAST(NULLIF(p.cost_micros, 0) AS DOUBLE) AS cost_change
        FROM d LEFT JOIN d AS p ON d.account_id = p.account_id AND d.campaign_id = p.campaign_id
          AND d.currency = p.currency AND p.date = CAST(d.date - INTERVAL 12 MONTH AS DATE)""",
)
def year_over_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.year_over_year(years_fact(spark, sf_dir))


@query(
    "q29_ytd",
    f"""SELECT account_id, campaign_id, currency, date, CAST(SUM(cost_micros) OVER w AS BIGINT) AS cost_micros_ytd,
          CAST(SUM(clicks) OVER w AS BIGINT) AS clicks_ytd FROM ({YEARS_DAILY})
        WINDOW w AS (PARTITION BY account_id, campaign_id, currency, YEAR(date) ORDER BY date)""",
)
def year_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.year_to_date(years_fact(spark, sf_dir))


@query(
    "q30_enriched",
    f"""WITH per_ad AS (SELECT account_id, ad_id, currency, CAST(SUM({SPEND_MICROS}) AS BIGINT) AS spend_micros,
            CAST(SUM(clicks) AS BIGINT) AS clicks,
            CAST(SUM(CAST(ROUND_EVEN(conversions * 1e6, 0) AS BIGINT)) AS BIGINT) AS conversions_micros
          FROM ({META}) GROUP BY ALL)
        SELECT f.account_id, f.ad_id, f.currency, f.spend_micros, f.clicks, f.conversions_micros, a.creative_id,
          a.ad_name, a.status AS ad_status, c.headline, c.destination_url
        FROM per_ad f LEFT JOIN ({META_AD_DIM}) a USING (ad_id) LEFT JOIN ({CREATIVE_DIM}) c USING (creative_id)""",
)
def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.enriched_ads(
        scan("meta_ads_performance", spark, sf_dir),
        scan("meta_ads_ad_dim", spark, sf_dir),
        scan("meta_ads_creative_dim", spark, sf_dir),
    )


@query(
    "q31_cross_channel",
    f"""SELECT platform, date, account_id, campaign_id, currency, CAST(SUM(m) AS BIGINT) / 1e6 AS spend,
          CAST(SUM(clicks) AS BIGINT) AS clicks
        FROM (SELECT 'google' AS platform, date, account_id, campaign_id, currency, cost_micros AS m, clicks FROM ({PERFORMANCE})
          UNION ALL SELECT 'meta', date, account_id, campaign_id, currency, {SPEND_MICROS}, clicks FROM ({META}))
        GROUP BY platform, date, account_id, campaign_id, currency""",
)
def cross_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.cross_platform_spend(
        scan("google_ads_performance", spark, sf_dir), scan("meta_ads_performance", spark, sf_dir)
    )


@query(
    "q32_weighted_ratio",
    f"""SELECT account_id, device, currency, i AS impressions, c AS clicks, c / CAST(NULLIF(i, 0) AS DOUBLE) AS ctr,
          (m / 1e6) / NULLIF(c, 0) AS cpc
        FROM (SELECT account_id, device, currency, CAST(SUM(impressions) AS BIGINT) AS i, CAST(SUM(clicks) AS BIGINT) AS c,
          CAST(SUM(cost_micros) AS BIGINT) AS m FROM ({PERFORMANCE}) GROUP BY ALL)""",
)
def weighted_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.weighted_ratios(scan("google_ads_performance", spark, sf_dir), ["account_id", "device"])


@query(
    "flagship_restated_cost",
    f"""SELECT campaign_id, date, CAST(SUM(cost_micros) AS BIGINT) AS cost_micros, CAST(SUM(clicks) AS BIGINT) AS clicks
        FROM ({load_fact("google_ads_geo")}) GROUP BY ALL""",
)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily cost and clicks per campaign after a restated batch was loaded."""
    facts = load_restated("google_ads_geo", spark, sf_dir)
    return facts.groupBy("campaign_id", "date").agg(
        F.sum("cost_micros").alias("cost_micros"), F.sum("clicks").alias("clicks")
    )


# Lookups.


@query(
    "lookup_ad",
    f"""SELECT f.date, f.account_id, f.campaign_id, f.ad_id, f.spend, a.status AS ad_status
        FROM ({META}) f LEFT JOIN ({META_AD_DIM}) a USING (ad_id)""",
)
def lookup_ad(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = scan("meta_ads_performance", spark, sf_dir).select("date", "account_id", "campaign_id", "ad_id", "spend")
    return lookups.with_ad(facts, scan("meta_ads_ad_dim", spark, sf_dir), {"status": "ad_status"})


@query(
    "lookup_creative",
    f"""SELECT f.date, f.account_id, f.ad_id, f.spend, a.creative_id, c.headline, c.call_to_action_type AS button
        FROM ({META}) f LEFT JOIN ({META_AD_DIM}) a USING (ad_id) LEFT JOIN ({CREATIVE_DIM}) c USING (creative_id)""",
)
def lookup_creative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.with_creative(
        scan("meta_ads_performance", spark, sf_dir).select("date", "account_id", "ad_id", "spend"),
        scan("meta_ads_ad_dim", spark, sf_dir),
        scan("meta_ads_creative_dim", spark, sf_dir),
        {"headline": "headline", "call_to_action_type": "button"},
    )


@query(
    "lookup_keyword",
    f"""WITH k AS (SELECT account_id, ad_group_id, keyword_id, date, keyword_text, quality_score FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY account_id, ad_group_id, keyword_id, date
            ORDER BY keyword_text, quality_score) AS rn FROM ({scan_fact("google_ads_keywords")})) WHERE rn = 1)
        SELECT t.date, t.account_id, t.ad_group_id, t.keyword_id, t.search_term, t.cost_micros, k.keyword_text, k.quality_score
        FROM ({scan_fact("google_ads_search_terms")}) t LEFT JOIN k USING (account_id, ad_group_id, keyword_id, date)""",
)
def lookup_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = scan("google_ads_search_terms", spark, sf_dir)
    return lookups.with_keyword(
        terms.select("date", "account_id", "ad_group_id", "keyword_id", "search_term", "cost_micros"),
        scan("google_ads_keywords", spark, sf_dir),
        {"keyword_text": "keyword_text", "quality_score": "quality_score"},
    )


@query(
    "lookup_audience",
    f"""SELECT f.date, f.account_id, f.ad_group_id, f.audience_criterion_id, f.clicks, a.audience_name, a.audience_type
        FROM ({scan_fact("google_ads_audience")}) f LEFT JOIN ({AUDIENCE_DIM}) a USING (audience_criterion_id)""",
)
def lookup_audience(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = scan("google_ads_audience", spark, sf_dir)
    return lookups.with_audience(
        facts.select("date", "account_id", "ad_group_id", "audience_criterion_id", "clicks"),
        scan("google_ads_audience_dim", spark, sf_dir),
    )


@query(
    "lookup_asset",
    f"""SELECT f.asset_group_id, f.asset_id, CAST(SUM(f.clicks) AS BIGINT) AS clicks, a.asset_content, a.field_type,
          a.asset_status
        FROM (SELECT asset_group_id, asset_id, SUM(clicks) AS clicks FROM ({scan_fact("google_ads_pmax_asset")})
          GROUP BY ALL) f LEFT JOIN ({ASSET_DIM}) a USING (asset_group_id, asset_id)
        GROUP BY ALL""",
)
def lookup_asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks per asset and role: the join gives one row per role, so clicks are summed before it."""
    clicks = (
        scan("google_ads_pmax_asset", spark, sf_dir)
        .groupBy("asset_group_id", "asset_id")
        .agg(F.sum("clicks").alias("clicks"))
    )
    return lookups.with_asset(clicks, scan("google_ads_pmax_asset_dim", spark, sf_dir))
