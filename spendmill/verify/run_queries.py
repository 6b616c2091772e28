"""Runs as a whole: schemas that do not fit, outcomes, holes, years, versions, with the same results in SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendmill.operators.schemas import SchemaMismatch
from spendmill.operators.slices import replace_slices
from spendmill.plans.catalog import FACTS
from spendmill.plans.loads import backfill, unanswered_windows
from spendmill.plans.spec import INGESTED_AT
from spendmill.plans.store import Run
from spendmill.verify.landing import excluded_keys, fact_accounts, landed_fact, table
from spendmill.verify.operator_queries import (
    ADS_SQL,
    RESTATED,
    RESTATED_SQL,
    RUN_DATE,
    SMALL_FACT,
    _ends,
    ads_fact,
    loaded_geo,
    query,
)
from spendmill.verify.oracles import load_fact, scan_fact
from spendmill.verify.queries import new_store

_REFUSED = "SELECT '{}' AS batch, '{}' AS problem, CAST(COUNT(*) AS BIGINT) AS row_count, CAST(SUM(cost_micros) AS BIGINT) AS cost_micros FROM ({})"
_DOUBLED = f"SELECT CASE WHEN {RESTATED_SQL} THEN cost_micros * 2 ELSE cost_micros END AS cost_micros FROM ({ADS_SQL})"


@query(
    "schema_enforced",
    " UNION ALL ".join(
        [
            _REFUSED.format("extra", "[EXTRA_COLUMN] surplus", ADS_SQL),
            _REFUSED.format("missing", "[MISSING_COLUMN] clicks", ADS_SQL),
            _REFUSED.format(
                "mistyped", "[INCOMPATIBLE_COLUMN_TYPE] clicks (bigint wanted, string found)", ADS_SQL
            ),
            _REFUSED.format(
                "two at once",
                "[INCOMPATIBLE_COLUMN_TYPE] campaign_id (string wanted, array<string> found), [MISSING_COLUMN] ad_id",
                ADS_SQL,
            ),
            _REFUSED.format("reordered", "", _DOUBLED),
        ]
    ),
)
def schema_enforced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that do not fit the table are refused whole and leave it as it is; the last one fits in another order."""
    store, run = new_store(spark), Run(RUN_DATE)
    name = store.name("ads_fact")
    spark.sql(f"CREATE TABLE {name} (date date, {SMALL_FACT}) USING parquet PARTITIONED BY (date)")
    base = store.stage(ads_fact(spark, sf_dir), run, "ads_fact", "base")
    scope = store.stage(base.select("account_id").distinct(), run, "ads_fact", "accounts")
    everything = type(RESTATED)(date(2024, 1, 1), date(2024, 1, 31))
    replace_slices(spark, name, base, scope.select("account_id", *_ends(everything)), everything)

    restated = base.where(RESTATED.contains("date")).withColumn("cost_micros", F.col("cost_micros") * 2)
    batches = {
        "extra": restated.withColumn("surplus", F.lit(1)),
        "missing": restated.drop("clicks"),
        "mistyped": restated.withColumn("clicks", F.col("clicks").cast("string")),
        "two at once": restated.withColumn("campaign_id", F.array("campaign_id")).drop("ad_id"),
        "reordered": restated.select(*reversed(restated.columns)),
    }
    states = []
    for label, rows in batches.items():
        batch = store.stage(rows, run, "ads_fact", label.replace(" ", "_"))
        problem = ""
        try:
            replace_slices(spark, name, batch, scope.select("account_id", *_ends(RESTATED)), RESTATED)
        except SchemaMismatch as mismatch:
            problem = ", ".join(map(str, mismatch.differences))
        state = spark.table(name).agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("cost_micros").alias("cost_micros")
        )
        # Stored now: the next batch changes the table.
        labelled = state.select(F.lit(label).alias("batch"), F.lit(problem).alias("problem"), "*")
        states.append(store.stage(labelled, run, "ads_fact", f"state_{len(states)}"))
    result = states[0]
    for state in states[1:]:
        result = result.unionByName(state)
    return result


@query(
    "run_outcomes",
    """SELECT CAST(user_id % 12 AS VARCHAR) AS requested_account, 'google_ads_geo' AS report,
         CAST(COUNT(*) AS BIGINT) AS row_count, CAST(COUNT(*) FILTER (event_id % 97 = 0) AS BIGINT) AS null_dates,
         CAST(COUNT(*) FILTER (user_id % 12 = 3) AS BIGINT) AS broken_rows, user_id % 12 = 3 AS failed,
         MAX(CASE WHEN user_id % 12 = 3 THEN 'campaign.id is missing' END) AS violation
       FROM events WHERE user_id % 12 NOT IN (5, 8, 11) AND event_type <> 'error'
         AND (event_id % 97 = 0 OR CAST(ts AS DATE) BETWEEN DATE '2024-01-16' AND DATE '2024-01-30')
       GROUP BY user_id % 12""",
)
def run_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored outcome of every account in the second of two runs."""
    store, results = loaded_geo(spark, sf_dir)
    run_id = results[-1].outcomes_path.rsplit("run_id=", 1)[1]
    return (
        store.outcomes()
        .where(F.col("run_id") == run_id)
        .select("requested_account", "report", "row_count", "null_dates", "broken_rows", "failed", "violation")
    )


# Every order as one request for some days of an account; urgent ones were loaded.
ASKED = {
    "requested_account": "CONCAT('act_', o_custkey % 500)",
    "slice_start": "CAST(o_orderdate AS DATE)",
    "slice_end": "CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INT) AS DATE)",
    "loaded": "o_orderpriority = '1-URGENT'",
}


@query(
    "unanswered_windows",
    f"""WITH asked AS (SELECT {', '.join(f'{sql} AS {name}' for name, sql in ASKED.items())} FROM orders),
        days AS (SELECT requested_account, loaded,
          CAST(UNNEST(GENERATE_SERIES(slice_start, slice_end, INTERVAL 1 DAY)) AS DATE) AS day FROM asked),
        missing AS (SELECT DISTINCT requested_account, day FROM days
          EXCEPT SELECT requested_account, day FROM days WHERE loaded),
        numbered AS (SELECT *, day - CAST(ROW_NUMBER() OVER (PARTITION BY requested_account ORDER BY day) AS INTEGER) AS island
          FROM missing)
        SELECT requested_account, MIN(day) AS slice_start, MAX(day) AS slice_end FROM numbered
        GROUP BY requested_account, island""",
)
def missing_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that runs asked for in vain, from a request log written by two runs."""
    store, spec = new_store(spark), FACTS["meta_ads_performance"]
    asked = table(spark, sf_dir, "orders").selectExpr(*[f"{sql} AS {name}" for name, sql in ASKED.items()])
    store.log_requests(Run(RUN_DATE), spec.table, asked.where("loaded"))
    store.log_requests(Run(RUN_DATE), spec.table, asked.where("NOT loaded"))
    return unanswered_windows(store, spec)


@query(
    "backfill_years_meta",
    f"SELECT * FROM ({scan_fact('meta_ads_performance')}) WHERE date <= DATE '2024-01-20'",
)
def backfill_years_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole years of the social platform from one staged delivery, loaded twice."""
    spec, store = FACTS["meta_ads_performance"], new_store(spark)
    accounts, landed = fact_accounts(spark, sf_dir, "meta"), landed_fact(spark, sf_dir, spec)
    for _ in range(2):
        backfill(store, spec, landed, accounts, Run(date(2024, 1, 20)), (2022, 2025), excluded=excluded_keys("meta"))
    return store.read(spec).drop(INGESTED_AT)


@query(
    "account_days",
    f"SELECT account_id, date, CAST(COUNT(*) AS BIGINT) AS n FROM ({load_fact('google_ads_geo')}) GROUP BY account_id, date",
)
def account_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per account and day as two loads noted them; the table is not read."""
    store, _ = loaded_geo(spark, sf_dir)
    return store.account_days("google_ads_geo")
