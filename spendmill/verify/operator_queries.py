"""One query per operator over the driver tables, each with the same result stated in SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendmill import functions as fn
from spendmill.fixed_values import AUDIENCE_TYPES, META_ACCOUNT_PREFIX, UNKNOWN_BREAKDOWN, UNNAMED_ACCOUNT
from spendmill.operators import incremental
from spendmill.operators.dedupe import keep_first, union_all
from spendmill.operators.incremental import DateWindow
from spendmill.operators.isolation import account_report, failed_accounts
from spendmill.operators.slices import replace_slices
from spendmill.plans.catalog import FACTS, REPORTS
from spendmill.plans.loads import backfill, flatten_report, load_fact, refresh_dimension
from spendmill.plans.spec import INGESTED_AT, ReportSpec, identifier, plain
from spendmill.plans.store import Run
from spendmill.sources import attach_accounts, exclude_accounts, google_accounts, meta_accounts
from spendmill.sources.landing import explode_batches, read_batches
from spendmill.verify.landing import (
    derived_fact,
    dimension_accounts,
    excluded_keys,
    fact_accounts,
    landed_fact,
    table,
)
from spendmill.verify.oracles import scan_fact
from spendmill.verify.queries import new_store, scan

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
RUN_DATE = date(2024, 1, 30)


def query(name: str, oracle: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        ORACLES[name] = oracle
        return function

    return register


# Events seen as a small ads fact.
ADS = {
    "date": "CAST(ts AS DATE)",
    "account_id": "CAST(user_id % 12 AS STRING)",
    "campaign_id": "event_type",
    "ad_id": "CAST(event_id AS STRING)",
    "clicks": "CAST(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS BIGINT)",
    "impressions": "CAST(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS BIGINT)",
    "cost_micros": "CAST(ROUND(value * 1000000) AS BIGINT)",
}
ADS_SQL = "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in ADS.items()) + " FROM events"


def ads_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*[f"{sql} AS {name}" for name, sql in ADS.items()])


# Projection and scalar functions.


@query(
    "q01_flatten_cast",
    """SELECT CAST(ts AS DATE) AS date, CAST(user_id % 12 AS VARCHAR) AS account_id, event_type AS campaign_status,
       CAST(event_id % 5 AS BIGINT) AS clicks, CASE WHEN event_id % 5 > 0 THEN (event_id % 900000) / 1e6 END AS average_cpc,
       CAST(ROUND(value * 1000000) AS BIGINT) AS cost_micros FROM events""",
)
def flatten_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "events").selectExpr(
        "named_struct('date', CAST(CAST(ts AS DATE) AS STRING)) AS segments",
        "named_struct('id', user_id % 12, 'status', event_type) AS campaign",
        "named_struct('clicks', event_id % 5, 'average_cpc', named_struct('micros', "
        "CASE WHEN event_id % 5 > 0 THEN event_id % 900000 END), 'cost_micros', "
        "CAST(ROUND(value * 1000000) AS BIGINT)) AS metrics",
    )
    return nested.select(
        fn.lenient_date("segments.date").alias("date"),
        F.col("campaign.id").cast("string").alias("account_id"),
        F.col("campaign.status").alias("campaign_status"),
        F.col("metrics.clicks").alias("clicks"),
        fn.micros_to_units("metrics.average_cpc.micros").alias("average_cpc"),
        F.col("metrics.cost_micros").alias("cost_micros"),
    )


@query("q02_date_range", f"SELECT * FROM ({ADS_SQL}) WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-19'")
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads_fact(spark, sf_dir).where(DateWindow(date(2024, 1, 10), date(2024, 1, 19)).contains("date"))


@query(
    "q03_allow_list",
    """SELECT c_custkey, kind FROM (SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'AFFINITY'
       WHEN 'BUILDING' THEN 'IN_MARKET' WHEN 'FURNITURE' THEN 'USER_LIST' ELSE c_mktsegment END AS kind FROM customer)
       WHERE kind IN ('AFFINITY', 'IN_MARKET', 'USER_LIST', 'CUSTOM_AUDIENCE', 'CUSTOM_INTENT')""",
)
def allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'AFFINITY' WHEN 'BUILDING' THEN 'IN_MARKET' "
        "WHEN 'FURNITURE' THEN 'USER_LIST' ELSE c_mktsegment END AS kind",
    )
    return kinds.where(F.col("kind").isin(*AUDIENCE_TYPES))


@query("q04_exclude_accounts", f"SELECT * FROM ({ADS_SQL}) WHERE account_id NOT IN ('3', '7', '11')")
def excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listed exclusion (3), a stored exclusion (7), and a manager account (11)."""
    facts = ads_fact(spark, sf_dir)
    accounts = fact_accounts(spark, sf_dir, "google")
    stored = accounts.where("name = 'Account 7'").select("key")
    kept = exclude_accounts(exclude_accounts(accounts, ["3"]), stored)
    named = facts.withColumn("requested_account", F.col("account_id"))
    return attach_accounts(named, kept, "google").select(facts.columns)


@query("q05_positive_and_equality", f"SELECT * FROM ({ADS_SQL}) WHERE campaign_id = 'click' AND cost_micros > 0")
def positive_and_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads_fact(spark, sf_dir).where((F.col("campaign_id") == "click") & (F.col("cost_micros") > 0))


RESOURCE = (
    "CASE event_id % 4 WHEN 0 THEN CONCAT('customers/', user_id, '/adGroupCriteria/', event_id, '~', user_id) "
    "WHEN 1 THEN 'plain' WHEN 2 THEN '' ELSE NULL END"
)


@query(
    "q06_resource_tail",
    f"""SELECT event_id, SPLIT(r, '~')[-1] AS tail, CASE WHEN r = '' THEN NULL ELSE SPLIT(r, '~')[-1] END AS tail_or_null,
        SPLIT(r, '/')[-1] AS path_tail FROM (SELECT event_id, {RESOURCE} AS r FROM events)""",
)
def resource_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "events").selectExpr("event_id", f"{RESOURCE} AS r")
    return names.select(
        "event_id",
        fn.last_segment("r", "~").alias("tail"),
        fn.last_segment("r", "~", blank_as_null=True).alias("tail_or_null"),
        fn.last_segment("r", "/").alias("path_tail"),
    )


DAY_TEXT = (
    "CASE WHEN event_id % 7 = 0 THEN 'bad' WHEN event_id % 7 = 1 THEN NULL WHEN event_id % 7 = 2 THEN '2024-02-30' "
    "ELSE CAST(CAST(ts AS DATE) AS STRING) END"
)


@query(
    "q07_lenient_date",
    f"""SELECT event_id, TRY_CAST({DAY_TEXT} AS DATE) AS lenient, CAST(ts AS DATE) AS strict FROM events""",
)
def lenient_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").selectExpr(
        "event_id", f"{DAY_TEXT} AS text", "CAST(CAST(ts AS DATE) AS STRING) AS day"
    )
    return days.select("event_id", fn.lenient_date("text").alias("lenient"), fn.strict_date("day").alias("strict"))


@query(
    "q08_defaults",
    """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name ELSE 'Unnamed Account' END AS name,
       CASE WHEN c_custkey % 2 = 0 THEN CONCAT('act_', c_nationkey) ELSE CONCAT('act_act_', c_nationkey) END AS prefixed,
       CAST(c_nationkey AS VARCHAR) AS stripped,
       CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE c_custkey END AS clicks,
       CASE WHEN c_custkey % 5 = 1 THEN 0.0E0 ELSE c_acctbal END AS spend,
       CASE c_custkey % 4 WHEN 0 THEN CONCAT('text ', c_custkey) ELSE c_name END AS content,
       c_custkey % 7 = 3 AS bad_clicks, c_custkey % 7 = 4 AS bad_spend FROM customer""",
)
def defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "customer").selectExpr(
        "*",
        "CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN '' END AS maybe_name",
        "CASE WHEN c_custkey % 2 = 0 THEN CONCAT('act_', c_nationkey) ELSE CONCAT('act_act_', c_nationkey) END AS key",
        "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey AS STRING) END AS clicks_text",
        "CASE WHEN c_custkey % 5 = 1 THEN NULL ELSE CAST(c_acctbal AS STRING) END AS spend_text",
        "CASE c_custkey % 4 WHEN 0 THEN CONCAT('text ', c_custkey) WHEN 1 THEN '' END AS asset_text",
        "CASE c_custkey % 7 WHEN 3 THEN '12.0' WHEN 4 THEN '12' END AS clicks_check",
        "CASE c_custkey % 7 WHEN 3 THEN '12.0' WHEN 4 THEN '12d' WHEN 5 THEN '1e3' END AS spend_check",
    )
    return raw.select(
        "c_custkey",
        fn.default_if_blank("maybe_name", UNNAMED_ACCOUNT).alias("name"),
        fn.with_prefix("key", META_ACCOUNT_PREFIX).alias("prefixed"),
        fn.without_prefix("key", META_ACCOUNT_PREFIX).alias("stripped"),
        fn.whole_number_or_zero("clicks_text").alias("clicks"),
        fn.number_or_zero("spend_text").alias("spend"),
        fn.default_if_blank("asset_text", F.col("c_name")).alias("content"),
        fn.bad_whole_number("clicks_check").alias("bad_clicks"),
        fn.bad_number("spend_check").alias("bad_spend"),
    )


@query(
    "q09_nested_sum",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
       CASE l_linenumber % 4 WHEN 0 THEN 0.0E0 WHEN 1 THEN 0.0E0
         ELSE 0.0E0 + l_quantity + l_extendedprice + l_discount END AS total FROM lineitem""",
)
def nested_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-row lists: missing, empty, or three entries of different types, all of which count."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "*",
        "CASE l_linenumber % 4 WHEN 0 THEN NULL WHEN 1 THEN slice(array(named_struct('value', '1')), 1, 0) ELSE "
        "array(named_struct('value', CAST(l_quantity AS STRING)), named_struct('value', CAST(l_extendedprice AS "
        "STRING)), named_struct('value', CAST(l_discount AS STRING))) END AS actions",
    )
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    return lines.select(*keys, fn.list_total("actions").alias("total"))


@query(
    "q25_breakdown_default",
    """SELECT event_id, COALESCE(json_extract_string(props, '$.k'), 'Unknown') AS age,
       COALESCE(json_extract_string(props, '$.zz'), 'Unknown') AS gender FROM events""",
)
def breakdown_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.coalesce(F.get_json_object("props", "$.k"), F.lit(UNKNOWN_BREAKDOWN)).alias("age"),
        F.coalesce(F.get_json_object("props", "$.zz"), F.lit(UNKNOWN_BREAKDOWN)).alias("gender"),
    )


@query(
    "q23_type_switched_assets",
    """SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN CONCAT_WS('|', p_name, p_brand)
         WHEN 'STANDARD' THEN CONCAT_WS('|', p_brand, 'long ' || p_name)
         WHEN 'PROMO' THEN CONCAT_WS('|', p_name, CASE WHEN p_size % 2 = 1 THEN p_brand END) ELSE '' END AS headlines
       FROM part""",
)
def type_switched_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ads = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        """named_struct('type', CASE p_type WHEN 'ECONOMY' THEN 'RESPONSIVE_SEARCH_AD' WHEN 'STANDARD' THEN
           'RESPONSIVE_DISPLAY_AD' WHEN 'PROMO' THEN 'EXPANDED_TEXT_AD' ELSE p_type END,
           'responsive_search_ad', named_struct('headlines', array(named_struct('text', p_name), named_struct('text', p_brand))),
           'responsive_display_ad', named_struct('headlines', array(named_struct('text', p_brand)),
             'long_headline', named_struct('text', CONCAT('long ', p_name))),
           'expanded_text_ad', named_struct('headline_part1', p_name, 'headline_part2',
             CASE WHEN p_size % 2 = 1 THEN p_brand ELSE '' END, 'headline_part3', CAST(NULL AS STRING))) AS ad""",
    )
    return ads.select("p_partkey", F.array_join(fn.asset_headlines(F.col("ad")), "|").alias("headlines"))


@query(
    "q24_creative_precedence",
    """SELECT doc_id, CASE doc_id % 4 WHEN 3 THEN NULL WHEN 2 THEN text WHEN 1 THEN source ELSE lang END AS headline,
       CASE WHEN doc_id % 4 IN (0, 3) AND doc_id % 3 = 0 THEN 'link'
         WHEN doc_id % 4 = 1 THEN CAST(NULL AS VARCHAR) ELSE '' END AS destination_url,
       CASE WHEN doc_id % 4 IN (0, 3) THEN 'LINK' WHEN doc_id % 4 = 1 THEN 'VIDEO' ELSE 'OWN' END AS call_to_action_type
       FROM documents""",
)
def creative_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0: link only; 1: video only; 2: feed; 3: link and a feed whose first title is null. Whole texts throughout."""
    linked = "doc_id % 4 IN (0, 3)"
    raw = table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "CASE WHEN doc_id % 4 = 2 THEN 'OWN' ELSE '' END AS button",
        "CASE WHEN doc_id % 4 = 1 THEN NULL ELSE '' END AS url_tags",
        f"""named_struct(
          'link_data', CASE WHEN {linked} THEN named_struct('name', lang, 'message', text, 'link',
            CASE WHEN doc_id % 3 = 0 THEN 'link' ELSE '' END, 'picture', source,
            'call_to_action', named_struct('type', 'LINK')) END,
          'video_data', CASE WHEN doc_id % 4 = 1 THEN named_struct('title', source, 'message', text, 'image_url', lang,
            'call_to_action', named_struct('type', 'VIDEO')) END) AS story""",
        """named_struct('titles', CASE doc_id % 4 WHEN 2 THEN array(named_struct('text', text))
             WHEN 3 THEN array(named_struct('text', CAST(NULL AS STRING))) END,
           'bodies', CAST(NULL AS array<struct<text: string>>),
           'link_urls', CAST(NULL AS array<struct<website_url: string>>),
           'images', CAST(NULL AS array<struct<url: string>>)) AS feed""",
    )
    nothing = F.lit(None).cast("string")
    parts = (nothing, nothing, F.col("url_tags"), F.col("button"), F.col("story"), F.col("feed"))
    wanted = ("headline", "destination_url", "call_to_action_type")
    return raw.select("doc_id", *[fn.creative_detail(name, *parts).alias(name) for name in wanted])


# Sources.


@query(
    "accounts_google",
    """SELECT CAST(c_custkey AS VARCHAR) AS key, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE 'Unnamed Account' END AS name,
       c_nationkey AS account_ord FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def google_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        "CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN '' END AS descriptive_name",
        "'ENABLED' AS status",
        "c_mktsegment = 'BUILDING' AS manager",
        "c_nationkey AS account_ord",
    )
    return google_accounts(listing).drop("currency")


@query(
    "accounts_meta",
    """SELECT CONCAT('act_', c_custkey) AS key, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN ''
         ELSE 'Unnamed Account' END AS name,
       CASE WHEN c_custkey % 4 = 0 THEN 'USD' ELSE 'EUR' END AS currency, c_nationkey AS account_ord FROM customer""",
)
def meta_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = table(spark, sf_dir, "customer").selectExpr(
        "CASE WHEN c_custkey % 2 = 0 THEN CONCAT('act_', c_custkey) ELSE CAST(c_custkey AS STRING) END AS id",
        "CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN '' END AS name",
        "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'EUR' END AS currency",
        "c_nationkey AS account_ord",
    )
    return meta_accounts(listing)


GEO = FACTS["google_ads_geo"]


@query("landed_batches", scan_fact("google_ads_geo"))
def landed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report landed as JSON response batches (of one row each; `batch_order` has more), scanned and flattened."""
    rows = derived_fact(spark, sf_dir, GEO)
    members = F.struct(*[c for c in rows.columns if c not in ("requested_account", "account_ord", "row_ord")])
    batches = rows.select(
        F.array(members).alias("results"),
        "requested_account",
        "account_ord",
        F.col("row_ord").cast("int").alias("batch_ord"),
    )
    path = f"{new_store(spark).root}/landing/{GEO.table}"
    batches.write.json(path)
    landed = read_batches(spark, GEO, path)
    flat = flatten_report(GEO, landed, fact_accounts(spark, sf_dir, "google"), excluded_keys("google"))
    return flat.where("_violation IS NULL AND date IS NOT NULL").select([c for c in GEO.columns if c != INGESTED_AT])


@query(
    "batch_order",
    """SELECT l_orderkey, l_linenumber, l_partkey, p AS position, CAST(l_orderkey AS BIGINT) * 4294967296 + p AS row_ord
       FROM lineitem, (SELECT UNNEST([0, 1]) AS p)""",
)
def batch_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = table(spark, sf_dir, "lineitem").selectExpr(
        "array(named_struct('l_orderkey', l_orderkey, 'l_linenumber', l_linenumber, 'l_partkey', l_partkey, 'position', 0), "
        "named_struct('l_orderkey', l_orderkey, 'l_linenumber', l_linenumber, 'l_partkey', l_partkey, 'position', 1)) "
        "AS results",
        "'1' AS requested_account",
        "0 AS account_ord",
        "CAST(l_orderkey AS INT) AS batch_ord",
    )
    return explode_batches(batches).drop("requested_account", "account_ord")


# Incremental control.


@query(
    "q10_high_water_mark",
    """SELECT 'loaded' AS state, MAX(CAST(ts AS DATE)) AS last_date FROM events
       UNION ALL SELECT 'empty', MAX(CAST(ts AS DATE)) FROM events WHERE user_id < 0""",
)
def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = ads_fact(spark, sf_dir)
    loaded = incremental.high_water_mark(facts).withColumn("state", F.lit("loaded"))
    empty = incremental.high_water_mark(facts.where("account_id < '0'")).withColumn("state", F.lit("empty"))
    return loaded.unionByName(empty)


@query(
    "q11_lookback_window",
    f"""WITH marks AS ({ORACLES['q10_high_water_mark']})
        SELECT state, COALESCE(last_date - 14, DATE '2022-01-01') AS slice_start, DATE '2024-01-30' AS slice_end FROM marks""",
)
def lookback_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.window_of_marks(high_water_mark(spark, sf_dir), RUN_DATE).drop("last_date")


@query(
    "account_windows",
    f"""SELECT account_id, MAX(date - CAST(CAST(account_id AS INTEGER) % 5 AS INTEGER)) - 14 AS slice_start,
          DATE '2024-01-30' AS slice_end FROM ({ADS_SQL}) GROUP BY account_id""",
)
def account_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-water mark per account instead of per table."""
    # Accounts stop on different days.
    stopped = F.date_sub("date", F.col("account_id").cast("int") % 5)
    marks = incremental.account_marks(ads_fact(spark, sf_dir).withColumn("date", stopped))
    return incremental.window_of_marks(marks, RUN_DATE).drop("last_date")


@query(
    "q12_date_chunks",
    """WITH span AS (SELECT o_orderpriority, MIN(CAST(o_orderdate AS DATE)) AS s, MAX(CAST(o_orderdate AS DATE)) AS e
         FROM orders GROUP BY o_orderpriority),
       chunks AS (SELECT o_orderpriority, e, CAST(UNNEST(GENERATE_SERIES(s, e, INTERVAL 31 DAY)) AS DATE) AS slice_start
         FROM span)
       SELECT o_orderpriority, slice_start, LEAST(slice_start + 30, e) AS slice_end FROM chunks""",
)
def date_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderpriority")
        .agg(
            F.min("o_orderdate").cast("date").alias("slice_start"), F.max("o_orderdate").cast("date").alias("slice_end")
        )
    )
    return incremental.date_chunks(spans)


@query(
    "q13_year_slices",
    """WITH span AS (SELECT o_orderpriority, MIN(CAST(o_orderdate AS DATE)) AS s FROM orders GROUP BY o_orderpriority),
       years AS (SELECT o_orderpriority, s, UNNEST(RANGE(YEAR(s), 2000)) AS y FROM span)
       SELECT o_orderpriority, GREATEST(s, MAKE_DATE(y, 1, 1)) AS slice_start,
         LEAST(DATE '1999-08-15', MAKE_DATE(y, 12, 31)) AS slice_end FROM years""",
)
def year_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderpriority")
        .agg(F.min("o_orderdate").cast("date").alias("slice_start"))
        .withColumn("slice_end", F.lit(date(1999, 8, 15)))
    )
    return incremental.year_slices(spans)


# Deduplication and set operations.


@query(
    "q14_keep_first",
    f"""SELECT date, account_id, campaign_id, ad_id, clicks, impressions, cost_micros FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY CAST(ad_id AS BIGINT)) AS rn FROM ({ADS_SQL}))
        WHERE rn = 1""",
)
def keep_first_per_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(ads_fact(spark, sf_dir), ["account_id"], [F.col("ad_id").cast("bigint")])


@query(
    "q15_keep_first_composite",
    """SELECT l_orderkey, l_returnflag, l_linestatus, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_returnflag, l_linestatus
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS rn FROM lineitem) WHERE rn = 1""",
)
def keep_first_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_returnflag", "l_linestatus"]
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    lines = table(spark, sf_dir, "lineitem").select(*keys, *order, "l_extendedprice")
    return keep_first(lines, keys, order).drop("l_shipdate")


@query(
    "q16_union_accounts",
    f"""SELECT *, CASE WHEN account_id = '4' THEN 'Unnamed Account' ELSE 'Account ' || account_id END AS account_name
        FROM ({ADS_SQL}) WHERE account_id <> '11'""",
)
def union_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries with their columns in different order, united and linked to the account listing."""
    facts = ads_fact(spark, sf_dir)
    first = facts.where("CAST(account_id AS INT) < 6")
    second = facts.where("CAST(account_id AS INT) >= 6").select(*reversed(facts.columns))
    united = union_all([first, second]).withColumn("requested_account", F.col("account_id"))
    linked = attach_accounts(united, fact_accounts(spark, sf_dir, "google"), "google")
    return linked.select(*facts.columns, F.col("account.name").alias("account_name"))


# Slice replace and full refresh.

SMALL_FACT = "account_id string, campaign_id string, ad_id string, clicks bigint, impressions bigint, cost_micros bigint"
RESTATED = DateWindow(date(2024, 1, 16), date(2024, 1, 30))
RESTATED_SQL = "date BETWEEN DATE '2024-01-16' AND DATE '2024-01-30'"


def replaced(spark: SparkSession, sf_dir: str, batch_filter: str, scope_filter: str, times: int = 1) -> DataFrame:
    """The base fact as a table, then a restated batch (double cost) put in place of the accounts in scope."""
    store = new_store(spark)
    name = store.name("ads_fact")
    spark.sql(f"CREATE TABLE {name} (date date, {SMALL_FACT}) USING parquet PARTITIONED BY (date)")
    run = Run(RUN_DATE)
    base = store.stage(ads_fact(spark, sf_dir), run, "ads_fact", "base")
    everything = DateWindow(date(2024, 1, 1), date(2024, 1, 31))
    everyone = base.select("account_id", *_ends(everything)).distinct()
    replace_slices(spark, name, base, store.stage(everyone, run, "ads_fact", "everyone"), everything, ("account_id",))

    restated = base.where(RESTATED.contains("date")).where(batch_filter)
    restated = restated.withColumn("cost_micros", F.col("cost_micros") * 2)
    batch = store.stage(restated, run, "ads_fact", "batch")
    scope = base.where(scope_filter).select("account_id", *_ends(RESTATED)).distinct()
    scope = store.stage(scope, run, "ads_fact", "scope")
    for _ in range(times):
        replace_slices(spark, name, batch, scope, RESTATED, ("account_id", "campaign_id"))
    return spark.table(name)


def _ends(window: DateWindow) -> list:
    return [F.lit(window.start).alias("slice_start"), F.lit(window.end).alias("slice_end")]


_RESTATED_COST = (
    "date, account_id, campaign_id, ad_id, clicks, impressions, CASE WHEN {when} THEN cost_micros * 2 ELSE cost_micros END "
    "AS cost_micros"
)
_ALL_RESTATED = f"SELECT {_RESTATED_COST.format(when=RESTATED_SQL)} FROM ({ADS_SQL})"


@query("q17_slice_replace", _ALL_RESTATED)
def slice_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replaced(spark, sf_dir, "true", "true")


@query("q18_slice_replace_vanishing_date", f"SELECT * FROM ({_ALL_RESTATED}) WHERE date <> DATE '2024-01-20'")
def slice_replace_vanishing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replaced(spark, sf_dir, "date <> DATE'2024-01-20'", "true")


@query("q20_slice_replace_twice", _ALL_RESTATED)
def slice_replace_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replaced(spark, sf_dir, "true", "true", times=2)


@query(
    "slice_replace_some_accounts",
    f"""SELECT {_RESTATED_COST.format(when=RESTATED_SQL + " AND account_id IN ('1', '2')")} FROM ({ADS_SQL})
        WHERE NOT ({RESTATED_SQL} AND account_id IN ('1', '2') AND date = DATE '2024-01-20')""",
)
def slice_replace_some(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only two accounts are in scope; the date they lose keeps the other accounts' rows."""
    wanted = "account_id IN ('1', '2')"
    return replaced(spark, sf_dir, f"{wanted} AND date <> DATE'2024-01-20'", wanted)


PARTS = ReportSpec(
    "parts", "google", (identifier("part_id", "part.id"), plain("part_name", "part.name")), dedupe_keys=("part_id",)
)


@query("q19_full_refresh", "SELECT CAST(p_partkey AS VARCHAR) AS part_id, p_name AS part_name FROM part WHERE p_size <= 25")
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refreshed table holds the last delivery only: rows of the first one that are gone do not survive."""
    store = new_store(spark)
    for keep in ("true", "p_size <= 25"):
        landed = table(spark, sf_dir, "part").where(keep).selectExpr(
            "named_struct('id', p_partkey, 'name', p_name) AS part",
            "CAST(p_partkey % 12 AS STRING) AS requested_account",
            "CAST(p_partkey % 12 AS INT) AS account_ord",
            "p_partkey AS row_ord",
        )
        accounts = table(spark, sf_dir, "part").selectExpr(
            "CAST(p_partkey % 12 AS STRING) AS key", "'x' AS name", "'EUR' AS currency", "CAST(p_partkey % 12 AS INT) AS account_ord"
        ).distinct()
        refresh_dimension(store, PARTS, landed, accounts, Run(RUN_DATE))
    return store.read(PARTS).drop(INGESTED_AT)


# Failure isolation.


def loaded_geo(spark: SparkSession, sf_dir: str, restated_too: bool = True):
    store, accounts = new_store(spark), fact_accounts(spark, sf_dir, "google")
    results = []
    for restated in (False, True) if restated_too else (False,):
        results.append(
            load_fact(
                store, GEO, landed_fact(spark, sf_dir, GEO, restated), accounts, Run(RUN_DATE),
                excluded=excluded_keys("google"), raise_on_failure=False,
            )
        )
    return store, results


@query(
    "q21_failure_isolation",
    """SELECT CAST(user_id % 12 AS VARCHAR) AS requested_account, CAST(COUNT(*) AS BIGINT) AS row_count,
         MAX(CASE WHEN user_id % 12 = 3 THEN 'campaign.id is missing' END) AS violation, user_id % 12 = 3 AS failed
       FROM events WHERE user_id % 12 NOT IN (5, 8, 11) AND event_type <> 'error'
         AND (event_id % 97 = 0 OR CAST(ts AS DATE) BETWEEN DATE '2024-01-16' AND DATE '2024-01-30')
       GROUP BY user_id % 12""",
)
def failure_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run report of a load in which one account breaks the contract (table contents: `load_google_ads_geo`)."""
    _, results = loaded_geo(spark, sf_dir)
    result = results[-1]
    broken = failed_accounts(result.accounts).withColumn("failed", F.lit(True))
    counts = result.accounts.groupBy("requested_account").agg(F.sum("row_count").alias("row_count"))
    flagged = counts.join(broken, "requested_account", "left").join(result.failures(), "requested_account", "left")
    return flagged.withColumn("failed", F.coalesce("failed", F.lit(False)))


META = FACTS["meta_ads_performance"]
CHUNK_FAILS = "user_id % 12 = 2 AND CAST(ts AS DATE) BETWEEN DATE '2024-01-22' AND DATE '2024-01-28'"


RESTATES = f"user_id % 12 NOT IN (3, 5) AND CAST(ts AS DATE) >= DATE '2024-01-16' AND NOT ({CHUNK_FAILS})"


@query(
    "failed_chunk_isolation",
    f"""SELECT CAST(ts AS DATE) AS date, CAST(user_id % 12 AS VARCHAR) AS account_id,
         CAST(COUNT(*) AS BIGINT) AS row_count,
         CAST(SUM(CAST(ROUND(CASE WHEN {RESTATES} THEN value * 2 ELSE value END * 1000000) AS BIGINT)) AS BIGINT)
           AS spend_micros
       FROM events WHERE user_id % 12 NOT IN (8, 11) AND NOT (event_type = 'error' AND {RESTATES})
       GROUP BY ALL""",
)
def failed_chunk_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests in 7-day chunks from 15 January, a day before the window; one chunk of account 2 fails and keeps its earlier rows.

    So do account 3, whose second delivery is broken, and account 5, which delivers nothing.
    """
    store, accounts = new_store(spark), fact_accounts(spark, sf_dir, "meta")
    options = {"excluded": excluded_keys("meta"), "raise_on_failure": False}
    load_fact(store, META, landed_fact(spark, sf_dir, META), accounts, Run(RUN_DATE), **options)
    windows = accounts.select(
        F.col("key").alias("requested_account"),
        F.lit(date(2024, 1, 15)).alias("slice_start"),
        F.lit(RUN_DATE).alias("slice_end"),
    )
    requests = incremental.date_chunks(windows, chunk_days=6).withColumn(
        "ok", ~((F.col("requested_account") == "act_2") & (F.col("slice_start") == F.lit(date(2024, 1, 22))))
    )
    load_fact(
        store, META, landed_fact(spark, sf_dir, META, restated=True), accounts, Run(RUN_DATE), requests=requests, **options
    )
    return (
        store.read(META)
        .groupBy("date", "account_id")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum(fn.to_micros("spend")).alias("spend_micros"))
    )


@query(
    "q22_null_date_quarantine",
    """SELECT CAST(user_id % 12 AS VARCHAR) AS account_id, CAST(event_id % 9 AS VARCHAR) AS keyword_id,
         CAST(COUNT(*) AS BIGINT) AS row_count
       FROM events WHERE event_id % 97 = 0 AND event_id % 3 <> 0 AND user_id % 12 NOT IN (8, 11) GROUP BY ALL""",
)
def null_date_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec, store, run = FACTS["google_ads_keywords"], new_store(spark), Run(RUN_DATE)
    accounts = fact_accounts(spark, sf_dir, "google")
    load_fact(store, spec, landed_fact(spark, sf_dir, spec), accounts, run, excluded=excluded_keys("google"))
    quarantined = spark.read.parquet(store.run_path(run, spec.table, "quarantine"))
    return quarantined.groupBy("account_id", "keyword_id").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "account_row_counts",
    """SELECT CAST(user_id % 12 AS VARCHAR) AS requested_account, CAST(user_id % 12 AS VARCHAR) AS account_id,
         CAST(COUNT(*) AS BIGINT) AS row_count, CAST(COUNT(*) FILTER (event_id % 97 = 0) AS BIGINT) AS null_dates
       FROM events WHERE user_id % 12 NOT IN (8, 11) GROUP BY user_id % 12""",
)
def account_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per account of one delivery, without loading it."""
    flat = flatten_report(
        GEO, landed_fact(spark, sf_dir, GEO), fact_accounts(spark, sf_dir, "google"), excluded_keys("google")
    )
    return account_report(flat).drop("broken_rows", "unanswered")


@query(
    "unique_key_count",
    """SELECT 'google_ads_ad_dim' AS report, CAST(COUNT(DISTINCT p_partkey) AS BIGINT) AS unique_keys FROM part""",
)
def unique_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan("google_ads_ad_dim", spark, sf_dir)
    return rows.agg(F.count(F.lit(1)).alias("unique_keys")).withColumn("report", F.lit("google_ads_ad_dim"))


@query(
    "failed_account_count",
    """SELECT CAST(COUNT(DISTINCT user_id % 12) AS BIGINT) AS failed FROM events
       WHERE user_id % 12 = 3 AND event_type <> 'error'""",
)
def failed_account_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten_report(
        GEO,
        landed_fact(spark, sf_dir, GEO, restated=True),
        fact_accounts(spark, sf_dir, "google"),
        excluded_keys("google"),
    )
    return failed_accounts(account_report(flat)).agg(F.count(F.lit(1)).alias("failed"))


@query(
    "carried_dimension_rows",
    """WITH old AS (SELECT CAST(o_orderkey AS VARCHAR) AS ad_id, CAST(o_custkey % 5 AS VARCHAR) AS account_id, 'old' AS ad_name
         FROM orders WHERE o_orderstatus <> 'P' AND o_custkey % 5 <> 4),
       new AS (SELECT CAST(o_orderkey AS VARCHAR) AS ad_id, CAST(o_custkey % 5 AS VARCHAR) AS account_id, 'new' AS ad_name
         FROM orders WHERE o_custkey % 5 NOT IN (1, 4))
       SELECT * FROM new UNION ALL SELECT * FROM old WHERE account_id = '1'""",
)
def carried_dimension_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account 1 fails in the second refresh: its rows of the first one stay, all others are replaced."""
    spec, store = REPORTS["meta_ads_ad_dim"], new_store(spark)
    accounts = dimension_accounts(spark, sf_dir, "meta")
    orders = table(spark, sf_dir, "orders")
    for name, rows in (("old", "o_orderstatus <> 'P'"), ("new", "true")):
        landed = orders.where(rows).selectExpr(
            f"CASE WHEN '{name}' = 'new' AND o_custkey % 5 = 1 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS id",
            f"'{name}' AS name",
            "o_orderstatus AS status",
            "named_struct('id', CAST(o_custkey AS STRING)) AS creative",
            "'2024-01-01' AS created_time",
            "'2024-01-01' AS updated_time",
            "CONCAT('act_', o_custkey % 5) AS requested_account",
            "CAST(o_custkey % 5 AS INT) AS account_ord",
            "o_orderkey AS row_ord",
        )
        refresh_dimension(store, spec, landed, accounts, Run(RUN_DATE), raise_on_failure=False)
    return store.read(spec).select("ad_id", "account_id", "ad_name")


@query("backfill_years", scan_fact("google_ads_budget_pacing") + " AND CAST(ts AS DATE) <= DATE '2024-01-20'")
def backfill_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole years, ending at the run date, loaded twice: the second run changes nothing."""
    spec, store = FACTS["google_ads_budget_pacing"], new_store(spark)
    accounts, landed = fact_accounts(spark, sf_dir, "google"), landed_fact(spark, sf_dir, spec)
    for _ in range(2):
        backfill(store, spec, landed, accounts, Run(date(2024, 1, 20)), (2023, 2025), excluded=excluded_keys("google"))
    return store.read(spec).drop(INGESTED_AT)


@query(
    "ingest_timestamp",
    f"""SELECT CAST(DATE '2024-01-30' AS VARCHAR) AS day, CAST(COUNT(*) AS BIGINT) AS row_count
        FROM ({scan_fact("google_ads_geo")})""",
)
def ingest_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of a run carry its one clock reading."""
    store = new_store(spark)
    run = Run(RUN_DATE, ingested_at=datetime(2024, 1, 30, 6, tzinfo=timezone.utc))
    landed, accounts = landed_fact(spark, sf_dir, GEO), fact_accounts(spark, sf_dir, "google")
    load_fact(store, GEO, landed, accounts, run, excluded=excluded_keys("google"))
    day = F.substring(F.col(INGESTED_AT).cast("string"), 1, 10).alias("day")
    return store.read(GEO).groupBy(day).agg(F.count(F.lit(1)).alias("row_count"))
