"""Queries over the driver tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendmill.plans.catalog import DIMENSIONS, FACTS, REPORTS
from spendmill.plans.loads import clean_rows, dimension_rows, flatten_report, load_fact, refresh_dimension
from spendmill.plans.spec import INGESTED_AT, ReportSpec
from spendmill.plans.store import Run, Store
from spendmill.session import shared_dir
from spendmill.verify.landing import (
    DIMENSION_SOURCES,
    dimension_accounts,
    excluded_keys,
    fact_accounts,
    landed_dimension,
    landed_fact,
)

Query = Callable[[SparkSession, str], DataFrame]
RUN_DATE = date(2024, 12, 31)
# What a first, smaller delivery of a dimension held; the second one holds the whole table.
FIRST_DELIVERIES = {
    "part": "p_size <= 25",
    "customer": "c_acctbal > 0",
    "orders": "o_orderstatus <> 'P'",
    "documents": "lang <> 'en'",
}


def new_store(spark: SparkSession) -> Store:
    """Empty store of its own in the shared folder."""
    key = uuid4().hex
    return Store(spark, f"spendmill_{key}", f"{shared_dir(spark)}/spendmill/{key}")


def joined_arrays(rows: DataFrame) -> DataFrame:
    arrays = [name for name, kind in rows.dtypes if kind.startswith("array")]
    return rows.withColumns({name: F.array_join(name, "|") for name in arrays}) if arrays else rows


def scan(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report from landed rows to typed rows."""
    spec = REPORTS[name]
    if spec.is_fact:
        landed, accounts = landed_fact(spark, sf_dir, spec), fact_accounts(spark, sf_dir, spec.platform)
        flat = flatten_report(spec, landed, accounts, excluded_keys(spec.platform))
        return clean_rows(spec, flat).select(*[c for c in spec.columns if c != INGESTED_AT])
    landed, accounts = landed_dimension(spark, sf_dir, spec), dimension_accounts(spark, sf_dir, spec.platform)
    rows = dimension_rows(spec, flatten_report(spec, landed, accounts))
    return joined_arrays(rows.select(*[c for c in spec.columns if c != INGESTED_AT]))


def load_restated(name: str, spark: SparkSession, sf_dir: str, spec: ReportSpec | None = None) -> DataFrame:
    """A fact table after a first delivery and a restated one, with one silent and one broken account."""
    spec, store = spec or FACTS[name], new_store(spark)
    accounts, excluded = fact_accounts(spark, sf_dir, spec.platform), excluded_keys(spec.platform)
    for restated in (False, True):
        load_fact(
            store,
            spec,
            landed_fact(spark, sf_dir, spec, restated),
            accounts,
            Run(RUN_DATE),
            excluded=excluded,
            raise_on_failure=False,
        )
    return store.read(spec).drop(INGESTED_AT)


def load_refreshed(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension table after two refreshes, of which the second has all rows."""
    spec, store = DIMENSIONS[name], new_store(spark)
    accounts = dimension_accounts(spark, sf_dir, spec.platform)
    for rows in (FIRST_DELIVERIES[DIMENSION_SOURCES[name][0]], None):
        refresh_dimension(store, spec, landed_dimension(spark, sf_dir, spec, rows), accounts, Run(RUN_DATE))
    return joined_arrays(store.read(spec).drop(INGESTED_AT))


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    found.update({f"scan_{name}": partial(scan, name) for name in REPORTS})
    found.update({f"load_{name}": partial(load_restated, name) for name in FACTS})
    found.update({f"load_{name}": partial(load_refreshed, name) for name in DIMENSIONS})
    return found
