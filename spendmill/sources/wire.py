"""Reports in the form in which the platforms' JSON interfaces send them.

There, whole numbers travel as text, a number or flag that has its default value (0, false) is left out together with
messages that hold nothing else, and names may be in camel case. A line may also be cut or hold a value of another shape. None of
that may lose a row: what cannot be read becomes a row with the column `UNREADABLE`, which breaks its account's contract, so
the account keeps its earlier rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from spendmill.plans.spec import LANDING_COLUMNS, UNREADABLE, UNREADABLE_RECORD, ReportSpec
from spendmill.sources.landing import scan

_RECORD = "_record"
_NUMBERS = ("bigint", "double", "boolean")


def camel_case(name: str) -> str:
    first, *others = name.split("_")
    return first + "".join(other.capitalize() for other in others)


def wire_schema(spec: ReportSpec, camel: bool = False) -> StructType:
    """The report's landed schema with every number and flag as text, and a column for lines that cannot be read."""
    landing = {name for name, _ in LANDING_COLUMNS}

    def as_sent(kind: DataType, named: bool) -> DataType:
        if isinstance(kind, StructType):
            return StructType(
                [StructField(camel_case(f.name) if named else f.name, as_sent(f.dataType, named)) for f in kind.fields]
            )
        if isinstance(kind, ArrayType):
            return ArrayType(as_sent(kind.elementType, named))
        return StringType()

    fields = []
    for field in spec.landed_schema.fields:
        named = camel and field.name not in landing
        fields.append(StructField(camel_case(field.name) if named else field.name, as_sent(field.dataType, named)))
    return StructType([*fields, StructField(_RECORD, StringType())])


def read_wire(spark: SparkSession, spec: ReportSpec, path: str, drop: str | None = None, camel: bool = False) -> DataFrame:
    """Landed rows of one report from JSON lines as they were sent, plus the column `UNREADABLE`.

    The account of a line that cannot be read is taken from its text where that still names one. Blank lines are no rows.
    """
    sent = scan(spark, wire_schema(spec, camel), path, "json", drop, columnNameOfCorruptRecord=_RECORD)
    return typed_rows(spec, sent, camel)


def typed_rows(spec: ReportSpec, sent: DataFrame, camel: bool = False) -> DataFrame:
    """Rows of `wire_schema` as rows of the report's landed schema, plus `UNREADABLE`."""
    zero = spec.zero_paths
    landing = {name for name, _ in LANDING_COLUMNS}
    problems: list[Column] = []

    def typed(kind: DataType, value: Column, parent: Column | None, path: str, named: bool) -> Column:
        if isinstance(kind, StructType):
            members = [
                typed(
                    f.dataType,
                    value[camel_case(f.name) if named else f.name],
                    value,
                    f"{path}.{f.name}",
                    named,
                ).alias(f.name)
                for f in kind.fields
            ]
            whole = F.struct(*members)
            # A message left out holds zeros if the report counts any of its members as such.
            return whole if any(z.startswith(f"{path}.") for z in zero) else F.when(value.isNotNull(), whole)
        name = kind.simpleString()
        if name not in _NUMBERS:
            # Lists keep their members' names, which the reports read by position in the schema.
            return value.cast(kind)
        number = value.try_cast(kind)
        problems.append(F.when(value.isNotNull() & number.isNull(), F.lit(f"{path} is no {name}")))
        default = F.lit(False) if name == "boolean" else F.lit(0).cast(kind)
        if path in zero:
            return F.when(value.isNull(), default).otherwise(number)
        if parent is not None and path in spec.zero_if_sent:
            return F.when(parent.isNotNull() & value.isNull(), default).otherwise(number)
        return number

    columns = []
    for field in spec.landed_schema.fields:
        named = camel and field.name not in landing
        source = F.col(camel_case(field.name) if named else field.name)
        column = source.try_cast(field.dataType) if field.name in landing else typed(field.dataType, source, None, field.name, named)
        if field.name == "requested_account":
            named_in_text = F.regexp_extract(_RECORD, r'"requested_account"\s*:\s*"?([^",}\s]+)[",}\s]', 1)
            column = F.coalesce(column, F.nullif(named_in_text, F.lit("")))
        columns.append(column.alias(field.name))
    unreadable = F.when(F.col(_RECORD).isNotNull(), F.lit(UNREADABLE_RECORD))
    return sent.select(*columns, F.coalesce(unreadable, *problems).alias(UNREADABLE))
