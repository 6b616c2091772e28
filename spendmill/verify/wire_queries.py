"""Reports landed in the platforms' own form, and the breakdown by action type, with the same results in SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from spendmill.plans.action_breakdown import ACTIONS
from spendmill.plans.catalog import FACTS
from spendmill.plans.loads import clean_rows, flatten_report, load_fact
from spendmill.plans.spec import INGESTED_AT, LANDING_COLUMNS, ReportSpec
from spendmill.plans.store import Run
from spendmill.sources.wire import camel_case, read_wire
from spendmill.verify.landing import derived_fact, excluded_keys, fact_accounts, landed_fact
from spendmill.verify.operator_queries import RUN_DATE, query
from spendmill.verify.oracles import ACCEPTED_META, META_DATE, scan_fact
from spendmill.verify.oracles import _WHO as WHO_SQL
from spendmill.verify.oracles import _select as columns_sql
from spendmill.verify.oracles import load_fact as load_sql
from spendmill.verify.queries import load_restated, new_store

GEO, KEYWORDS, SCHEDULE = (FACTS[n] for n in ("google_ads_geo", "google_ads_keywords", "google_ads_schedule"))


def wire_lines(spec: ReportSpec, rows: DataFrame) -> DataFrame:
    """One JSON text per landed row as the platform would send it: camel case, integers as text, no zeros, no nulls.

    IDs are sent even if they are 0, which only the ones derived here are.
    """
    landing = [name for name, _ in LANDING_COLUMNS]

    def sent(kind: DataType, value: Column, path: str) -> Column:
        if isinstance(kind, StructType):
            members = [sent(f.dataType, value[f.name], f"{path}.{f.name}").alias(camel_case(f.name)) for f in kind.fields]
            some = reduce(Column.__or__, [value[f.name].isNotNull() for f in kind.fields])
            return F.when(some, F.struct(*members))
        text = value.cast("string") if kind.simpleString() == "bigint" else value
        return F.when(value != F.lit(0).cast(kind), text) if path in spec.zero_paths else text

    members = [
        sent(f.dataType, F.col(f.name), f.name).alias(camel_case(f.name)) for f in rows.schema.fields if f.name not in landing
    ]
    # The account stands first, so that a cut line still names it.
    whole = F.struct("requested_account", "account_ord", "row_ord", *members)
    return rows.select(F.to_json(whole).alias("value"), "requested_account")


def _read(spark: SparkSession, spec: ReportSpec, lines: DataFrame) -> DataFrame:
    path = f"{new_store(spark).root}/landing/{spec.table}"
    lines.select("value").write.text(path)
    return read_wire(spark, spec, path, camel=True)


@query("wire_form_keywords", scan_fact("google_ads_keywords"))
def wire_form_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report sent with text integers and without zeros, equal to the spelled-out one."""
    landed = _read(spark, KEYWORDS, wire_lines(KEYWORDS, derived_fact(spark, sf_dir, KEYWORDS)))
    flat = flatten_report(KEYWORDS, landed, fact_accounts(spark, sf_dir, "google"), excluded_keys("google"))
    return clean_rows(KEYWORDS, flat).select([c for c in KEYWORDS.columns if c != INGESTED_AT])


@query("wire_form_schedule", scan_fact("google_ads_schedule"))
def wire_form_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `wire_form_keywords`; the hour of midnight is a zero that the platform leaves out."""
    landed = _read(spark, SCHEDULE, wire_lines(SCHEDULE, derived_fact(spark, sf_dir, SCHEDULE)))
    flat = flatten_report(SCHEDULE, landed, fact_accounts(spark, sf_dir, "google"), excluded_keys("google"))
    return clean_rows(SCHEDULE, flat).select([c for c in SCHEDULE.columns if c != INGESTED_AT])


@query("wire_cut_lines", load_sql("google_ads_geo"))
def wire_cut_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact table after two wire-form deliveries; in the second, lines of account 3 are cut, so it keeps all earlier rows."""
    store, accounts = new_store(spark), fact_accounts(spark, sf_dir, "google")
    for restated in (False, True):
        lines = wire_lines(GEO, derived_fact(spark, sf_dir, GEO, restated))
        if restated:
            cut = F.when(F.col("requested_account") == "3", F.substring("value", 1, 120)).otherwise(F.col("value"))
            lines = lines.withColumn("value", cut)
        load_fact(
            store,
            GEO,
            _read(spark, GEO, lines),
            accounts,
            Run(RUN_DATE),
            excluded=excluded_keys("google"),
            raise_on_failure=False,
        )
    return store.read(GEO).drop(INGESTED_AT)


# Every insight has, by `event_id % 4`, no list, values only, or both; two types, which are one if the event is a purchase.
_BY_TYPE = f"""
SELECT {META_DATE} AS date, account_id, account_name, campaign_id, campaign_name, adset_id, adset_name, ad_id, ad_name,
  entry.t AS action_type, entry.n AS conversions, entry.v AS conversion_value, currency, _event, _account FROM (
  SELECT *, UNNEST(CASE
    WHEN kind = 0 THEN [{{'t': CAST(NULL AS VARCHAR), 'n': 0.0E0, 'v': 0.0E0}}]
    WHEN _event = 'purchase' THEN [{{'t': _event, 'n': CASE WHEN kind = 1 THEN 0.0E0 ELSE kind + value END, 'v': value + 2.5E0}}]
    ELSE [{{'t': 'purchase', 'n': CASE WHEN kind = 1 THEN 0.0E0 ELSE CAST(kind AS DOUBLE) END, 'v': 2.5E0}},
          {{'t': _event, 'n': CASE WHEN kind = 1 THEN 0.0E0 ELSE value END, 'v': value}}] END) AS entry
  FROM (SELECT *, event_id % 4 AS kind, event_type AS _event, user_id % 12 AS _account, {columns_sql(WHO_SQL)},
    CASE WHEN user_id % 12 = 5 THEN 'USD' ELSE 'EUR' END AS currency FROM events WHERE {ACCEPTED_META}))
"""


@query("action_breakdown", f"SELECT * EXCLUDE (_event, _account) FROM ({_BY_TYPE})")
def action_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insights by action type."""
    landed = landed_fact(spark, sf_dir, ACTIONS)
    flat = flatten_report(ACTIONS, landed, fact_accounts(spark, sf_dir, "meta"), excluded_keys("meta"))
    return clean_rows(ACTIONS, flat).select([c for c in ACTIONS.columns if c != INGESTED_AT])


@query(
    "load_meta_ads_actions",
    f"""WITH base AS ({_BY_TYPE}), mark AS (SELECT MAX(date) AS last_date FROM base)
    SELECT base.* EXCLUDE (_event, _account) FROM base CROSS JOIN mark
    WHERE NOT (date >= last_date - 14 AND _account <> 5 AND _event = 'error')""",
)
def load_meta_ads_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long table after a first and a restated delivery, which retracts errors; account 5 is silent."""
    return load_restated("meta_ads_actions", spark, sf_dir, ACTIONS)


@query(
    "action_totals",
    f"""SELECT ad_id, date, CAST(SUM(conversions) AS DECIMAL(18, 3)) AS conversions,
      CAST(SUM(conversion_value) AS DECIMAL(18, 3)) AS conversion_value
    FROM ({scan_fact("meta_ads_performance")}) GROUP BY ad_id, date""",
)
def action_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of the breakdown per ad and day; the SQL adds up the daily report, which knows no action types."""
    rows = action_breakdown(spark, sf_dir)
    totals = [F.sum(name).cast("decimal(18, 3)").alias(name) for name in ("conversions", "conversion_value")]
    return rows.groupBy("ad_id", "date").agg(*totals)
