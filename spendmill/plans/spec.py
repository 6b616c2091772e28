"""What a report is: landed fields in, typed columns out, and how the table is kept."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spendmill import functions as fn

INGESTED_AT = "_ingested_at"
VIOLATION = "_violation"
# Landed rows may carry a reason why they could not be read.
UNREADABLE = "_unreadable"
UNREADABLE_RECORD = "record cannot be read"
# Added to every landed row: the account it was requested for, and its place in listing and response.
LANDING_COLUMNS = (("requested_account", "string"), ("account_ord", "int"), ("row_ord", "bigint"))

Expression = Callable[[], Column]


@dataclass(frozen=True)
class Rule:
    """A row breaks the contract when the expression is true."""

    broken: Expression
    message: str


@dataclass(frozen=True)
class Field:
    """One output column, the landed paths it reads, and what would make a row unusable."""

    name: str
    kind: str
    value: Expression
    reads: tuple[tuple[str, str], ...]
    rules: tuple[Rule, ...] = ()
    # A platform that leaves out zeros means 0 by a missing value: always, or only in a message that was sent.
    unset_is_zero: bool = False
    zero_if_sent: bool = False


@dataclass(frozen=True)
class ReportSpec:
    table: str
    platform: str
    fields: tuple[Field, ...]
    row_filter: Expression | None = None
    filter_reads: tuple[tuple[str, str], ...] = ()
    cluster_by: tuple[str, ...] = ()
    dedupe_keys: tuple[str, ...] = ()
    # Turns a landed row into the rows that the fields are computed on; it reads `unnest_reads`.
    unnest: Callable[[DataFrame], DataFrame] | None = None
    unnest_reads: tuple[tuple[str, str], ...] = ()
    # A failed request loses one date chunk instead of the whole account.
    chunked: bool = False

    @property
    def is_fact(self) -> bool:
        return not self.dedupe_keys

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields] + [INGESTED_AT]

    @property
    def output_ddl(self) -> str:
        return ", ".join(f"{f.name} {f.kind}" for f in self.fields) + f", {INGESTED_AT} timestamp"

    @property
    def output_schema(self) -> StructType:
        return StructType.fromDDL(self.output_ddl)

    @property
    def landed_paths(self) -> list[tuple[str, str]]:
        """Distinct landed paths, so a scan reads no field the report does not use."""
        seen = dict.fromkeys(read for f in self.fields for read in f.reads if not read[0].startswith("account."))
        seen.update(dict.fromkeys((*self.filter_reads, *self.unnest_reads)))
        return list(seen)

    @property
    def zero_paths(self) -> set[str]:
        return {path for f in self.fields if f.unset_is_zero for path, _ in f.reads}

    @property
    def zero_if_sent(self) -> set[str]:
        return {path for f in self.fields if f.zero_if_sent for path, _ in f.reads}

    @property
    def landed_schema(self) -> StructType:
        return StructType.fromDDL(nested_ddl([*self.landed_paths, *LANDING_COLUMNS]))

    def project(self, landed: DataFrame) -> DataFrame:
        """Filtered, typed rows plus the landing columns and the first broken rule per row, if any.

        Rows that could not be read pass the filter: what they hold is not known.
        """
        unreadable = F.col(UNREADABLE) if UNREADABLE in landed.columns else F.lit(None).cast("string")
        rows = landed
        if self.row_filter:
            kept = self.row_filter()
            rows = landed.where(kept | unreadable.isNotNull() if UNREADABLE in landed.columns else kept)
        rules = [F.when(r.broken(), F.lit(r.message)) for f in self.fields for r in f.rules]
        no_account = F.when(F.col("requested_account").isNull(), F.lit("row names no account"))
        rows = self.unnest(rows) if self.unnest else rows
        reasons = [unreadable, no_account] if UNREADABLE in landed.columns else [no_account]
        return rows.select(
            *[f.value().cast(f.kind).alias(f.name) for f in self.fields],
            *[F.col(name) for name, _ in LANDING_COLUMNS],
            F.coalesce(*reasons, *rules).alias(VIOLATION),
        )


def nested_ddl(paths: Iterable[tuple[str, str]]) -> str:
    """DDL of the nested schema that holds exactly the given dotted paths."""
    tree: dict = {}
    for path, kind in paths:
        *parents, leaf = path.split(".")
        node = tree
        for parent in parents:
            node = node.setdefault(parent, {})
        node[leaf] = kind

    def inner(node: dict) -> str:
        return ", ".join(
            f"{name}: struct<{inner(kind)}>" if isinstance(kind, dict) else f"{name}: {kind}"
            for name, kind in node.items()
        )

    return inner(tree)


# Field constructors.


def plain(name: str, path: str, kind: str = "string") -> Field:
    return Field(
        name, kind, lambda: F.col(path), ((path, kind),), unset_is_zero=kind in ("bigint", "double", "boolean")
    )


def identifier(name: str, path: str) -> Field:
    """Numeric ID stored as text; a row without it is unusable."""
    missing = Rule(lambda: F.col(path).isNull(), f"{path} is missing")
    return Field(name, "string", lambda: F.col(path).cast("string"), ((path, "bigint"),), (missing,))


def optional_identifier(name: str, path: str) -> Field:
    return Field(name, "string", lambda: F.col(path).cast("string"), ((path, "bigint"),))


def whole(name: str, path: str) -> Field:
    """Integer metric that must be there."""
    missing = Rule(lambda: F.col(path).isNull(), f"{path} is missing")
    return Field(name, "bigint", lambda: F.col(path), ((path, "bigint"),), (missing,), unset_is_zero=True)


def whole_or_zero(name: str, path: str) -> Field:
    """Integer that the platform leaves out when it is unset."""
    return Field(name, "bigint", lambda: F.coalesce(F.col(path), F.lit(0)), ((path, "bigint"),), unset_is_zero=True)


def measure(name: str, path: str) -> Field:
    return plain(name, path, "double")


def money(name: str, path: str) -> Field:
    return Field(name, "double", lambda: fn.micros_to_units(path), ((path, "bigint"),), zero_if_sent=True)


def resource_tail(name: str, path: str, separator: str, blank_as_null: bool = False) -> Field:
    return Field(name, "string", lambda: fn.last_segment(path, separator, blank_as_null), ((path, "string"),))


def lenient_day(name: str, path: str) -> Field:
    return Field(name, "date", lambda: fn.lenient_date(path), ((path, "string"),))


def required_text(name: str, path: str) -> Field:
    missing = Rule(lambda: F.col(path).isNull(), f"{path} is missing")
    return Field(name, "string", lambda: F.col(path), ((path, "string"),), (missing,))


def strict_day(name: str, path: str) -> Field:
    """Date text that has to be a date: the row breaks the contract instead of the query."""
    bad = Rule(lambda: fn.lenient_date(path).isNull(), f"{path} is no date")
    return Field(name, "date", lambda: fn.lenient_date(path), ((path, "string"),), (bad,))


def whole_text(name: str, path: str) -> Field:
    bad = Rule(lambda: fn.bad_whole_number(path), f"{path} is no integer")
    return Field(name, "bigint", lambda: fn.whole_number_or_zero(path), ((path, "string"),), (bad,))


def number_text(name: str, path: str) -> Field:
    bad = Rule(lambda: fn.bad_number(path), f"{path} is no number")
    return Field(name, "double", lambda: fn.number_or_zero(path), ((path, "string"),), (bad,))


def listed_total(name: str, path: str) -> Field:
    bad = Rule(lambda: fn.bad_list_values(path), f"{path} holds a value that is no number")
    return Field(
        name, "double", lambda: fn.list_total(path), ((path, "array<struct<action_type: string, value: string>>"),), (bad,)
    )


def constant(name: str, kind: str, value: object) -> Field:
    return Field(name, kind, lambda: F.lit(value), ())
