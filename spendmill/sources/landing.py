"""Landed responses: one row per line, or one response batch per line.

A landing folder may be partitioned by `drop` (one value per delivery), so a load lists and reads its delivery only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from spendmill.plans.spec import LANDING_COLUMNS, ReportSpec

REQUEST_DDL = "requested_account string, slice_start date, slice_end date, ok boolean"


def scan(
    spark: SparkSession, schema: StructType | str, path: str, fmt: str, drop: str | None, **options: str
) -> DataFrame:
    if fmt not in ("json", "parquet", "orc"):
        raise ValueError(f"landing format {fmt!r} is not one of json, parquet, orc")
    reader = spark.read.schema(schema).options(**options)
    if drop is None:
        return reader.format(fmt).load(path)
    return reader.option("basePath", path).format(fmt).load(f"{path}/drop={drop}").drop("drop")


def read_landed(
    spark: SparkSession, spec: ReportSpec, path: str, fmt: str = "json", drop: str | None = None
) -> DataFrame:
    """Rows of one report with exactly the fields the report uses; a field of another shape reads as null."""
    return scan(spark, spec.landed_schema, path, fmt, drop)


def read_batches(
    spark: SparkSession, spec: ReportSpec, path: str, fmt: str = "json", drop: str | None = None
) -> DataFrame:
    """Rows of one report landed as response batches."""
    landing = {name for name, _ in LANDING_COLUMNS}
    row = StructType([f for f in spec.landed_schema.fields if f.name not in landing])
    schema = StructType(
        [
            StructField("results", ArrayType(row)),
            *StructType.fromDDL("requested_account string, account_ord int, batch_ord int").fields,
        ]
    )
    return explode_batches(scan(spark, schema, path, fmt, drop))


def explode_batches(batches: DataFrame) -> DataFrame:
    """One row per element of `results`; `row_ord` follows batch order, then order in the batch."""
    rows = batches.select(
        "requested_account", "account_ord", "batch_ord", F.posexplode("results").alias("_position", "_row")
    )
    row_ord = F.shiftleft(F.col("batch_ord").cast("bigint"), 32) + F.col("_position")
    return rows.select("_row.*", "requested_account", "account_ord", row_ord.alias("row_ord"))


def read_listing(spark: SparkSession, ddl: str, path: str, fmt: str = "json", drop: str | None = None) -> DataFrame:
    """Account listing as it was delivered."""
    return scan(spark, ddl, path, fmt, drop)


def read_requests(spark: SparkSession, path: str, fmt: str = "json", drop: str | None = None) -> DataFrame:
    """Request log: which account and date slice was asked for, and whether the answer is complete."""
    return scan(spark, REQUEST_DDL, path, fmt, drop)
