"""What the physical plans have to look like."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from spendmill.operators import lookups
from spendmill.operators.dedupe import keep_first
from spendmill.operators.incremental import DateWindow
from spendmill.operators.isolation import account_report
from spendmill.operators.slices import rows_outside_scope
from spendmill.plans import marts
from spendmill.plans.catalog import FACTS, REPORTS
from spendmill.plans.loads import clean_rows, flatten_report
from spendmill.session import scoped_conf
from spendmill.sources import (
    GOOGLE_ACCOUNT_DDL,
    META_ACCOUNT_DDL,
    attach_accounts,
    google_accounts,
    meta_accounts,
    read_landed,
)


def stored_listing(spark, platform, tmp_path):
    """Account listing as it is landed: a file, so its size is known."""
    ddl, accounts = (
        (GOOGLE_ACCOUNT_DDL, google_accounts) if platform == "google" else (META_ACCOUNT_DDL, meta_accounts)
    )
    spark.createDataFrame([], ddl).write.json(str(tmp_path / "listing"))
    return accounts(spark.read.schema(ddl).json(str(tmp_path / "listing")))


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def final_plan(rows):
    rows.collect()
    return plan(rows)


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_reports_stay_in_the_jvm(spark, tmp_path, name):
    spec = REPORTS[name]
    spark.createDataFrame([], spec.landed_schema).write.parquet(str(tmp_path / "l"))
    landed = read_landed(spark, spec, str(tmp_path / "l"), "parquet")
    listing = stored_listing(spark, spec.platform, tmp_path)
    text = plan(clean_rows(spec, flatten_report(spec, landed, listing)))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    # The scan of the landed rows is joined to the listing without a shuffle of the rows.
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_row_filters_reach_the_scan(spark, tmp_path, capsys):
    spec = FACTS["google_ads_pmax_asset"]
    spark.createDataFrame([], spec.landed_schema).write.parquet(str(tmp_path / "l"))
    landed = read_landed(spark, spec, str(tmp_path / "l"), "parquet")
    rows = flatten_report(spec, landed, stored_listing(spark, "google", tmp_path))
    rows.select("date", "clicks").explain("formatted")
    text = capsys.readouterr().out
    assert re.search(r"PushedFilters: \[[^\]]*In\(campaign.advertising_channel_type", text)
    assert "metrics:struct<clicks:bigint>" in text and "asset_group" not in text


def test_keep_first_limits_before_the_exchange(spark):
    rows = spark.range(10).selectExpr("id % 3 AS k", "id AS n", "id AS payload")
    text = plan(keep_first(rows, ["k"], ["n"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_slice_window_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    facts = spark.range(5).selectExpr("CAST(id AS STRING) AS account_id", "date_add(DATE'2024-01-01', CAST(id AS INT)) AS date")
    facts.write.partitionBy("date").parquet(path)
    scope = spark.createDataFrame(
        [("1", date(2024, 1, 2), date(2024, 1, 3))], "account_id string, slice_start date, slice_end date"
    )
    target = spark.read.parquet(path).where(DateWindow(date(2024, 1, 2), date(2024, 1, 3)).contains("date"))
    text = plan(rows_outside_scope(target, scope))
    assert re.search(r"PartitionFilters: \[isnotnull\(date#\d+\), \(date#\d+ >= 2024-01-02\)", text)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20000",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20000",
}


def test_hot_keyword_is_split(spark, tmp_path):
    """A third of the search terms has one keyword and a third has none: both are spread over tasks."""
    keys = "'a' AS account_id, 'g' AS ad_group_id, DATE'2024-01-01' AS date"
    hot = "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE CAST(id % 5000 AS STRING) END AS keyword_id"
    terms = spark.range(60000).repartition(8).selectExpr(*keys.split(", "), hot, "CONCAT('term ', uuid()) AS search_term")
    terms.write.parquet(str(tmp_path / "terms"))
    words = spark.range(5000).selectExpr(*keys.split(", "), "CAST(id AS STRING) AS keyword_id", "'w' AS keyword_text")
    words = words.unionByName(words.limit(1).withColumn("keyword_id", F.lit("hot")))
    words.write.parquet(str(tmp_path / "words"))
    with scoped_conf(spark, **SKEW):
        joined = lookups.with_keyword(
            spark.read.parquet(str(tmp_path / "terms")),
            spark.read.parquet(str(tmp_path / "words")),
            {"keyword_text": "keyword_text"},
        )
        text = final_plan(joined)
    assert "SortMergeJoin(skew=true)" in text
    got = {r["k"]: r["n"] for r in joined.groupBy(F.col("keyword_text").alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sum(got.values()) == 60000 and got[None] == 20000


def test_hot_account_is_split_when_the_listing_is_large(spark, tmp_path):
    spec = FACTS["google_ads_budget_pacing"]
    rows = spark.range(40000).repartition(8).selectExpr(
        "named_struct('id', IF(id % 3 = 0, 7, id)) AS customer", "CONCAT('x', uuid()) AS note", "CAST(IF(id % 3 = 0, 7, id) AS STRING) AS requested_account"
    )
    rows.write.parquet(str(tmp_path / "rows"))
    listing = spark.range(40000).selectExpr("CAST(id AS STRING) AS key", "'n' AS name", "'EUR' AS currency")
    listing.write.parquet(str(tmp_path / "listing"))
    with scoped_conf(spark, **SKEW):
        joined = attach_accounts(
            spark.read.parquet(str(tmp_path / "rows")), spark.read.parquet(str(tmp_path / "listing")), spec.platform
        )
        assert "skew=true" in final_plan(joined)


def test_marts_aggregate_before_every_exchange(spark, tmp_path):
    spec = FACTS["google_ads_performance"]
    spark.createDataFrame([], spec.output_schema).write.parquet(str(tmp_path / "t"))
    facts = spark.read.parquet(str(tmp_path / "t"))
    for mart in (marts.return_on_spend(facts), marts.year_to_date(facts), marts.weighted_ratios(facts, ["device"])):
        text = plan(mart)
        first_exchange = text.rindex("Exchange hashpartitioning")
        assert "partial_sum" in text[first_exchange:]
        assert "ad_name" not in text.split("ReadSchema")[1]


def test_account_report_sorts_no_rows(spark, tmp_path):
    spec = FACTS["google_ads_geo"]
    spark.createDataFrame([], spec.landed_schema).write.parquet(str(tmp_path / "l"))
    landed = read_landed(spark, spec, str(tmp_path / "l"), "parquet")
    flat = flatten_report(spec, landed, stored_listing(spark, "google", tmp_path))
    text = plan(account_report(flat))
    assert "HashAggregate" in text and "SortAggregate" not in text and "Sort " not in text


def test_year_over_year_reads_the_facts_once(spark, tmp_path):
    spec = FACTS["google_ads_performance"]
    spark.createDataFrame([], spec.output_schema).write.parquet(str(tmp_path / "t"))
    text = plan(marts.year_over_year(spark.read.parquet(str(tmp_path / "t"))))
    assert text.count("FileScan") == 1 and "Join" not in text and "SortAggregate" not in text
