"""The schemas a write meets, compared by name and type before anything is stored.

Three schemas have to agree: what the report declares, what the batch brings, and what the table holds. Columns are matched by
name, without regard to case, as the catalog does; their order does not matter.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql.types import DataType, NumericType, StructType

MISSING, EXTRA, MISTYPED = "MISSING_COLUMN", "EXTRA_COLUMN", "INCOMPATIBLE_COLUMN_TYPE"


@dataclass(frozen=True)
class Difference:
    kind: str
    column: str
    wanted: str | None = None
    found: str | None = None

    def __str__(self) -> str:
        types = f" ({self.wanted} wanted, {self.found} found)" if self.kind == MISTYPED else ""
        return f"[{self.kind}] {self.column}{types}"


class SchemaMismatch(ValueError):
    """Raised before a write. `differences` lists every column that does not fit."""

    def __init__(self, what: str, differences: Iterable[Difference]):
        self.differences = tuple(differences)
        super().__init__(f"{what}: " + ", ".join(map(str, self.differences)))


def same_type(found: DataType, wanted: DataType) -> bool:
    """Equal but for nullability and for field metadata."""
    return found.simpleString().lower() == wanted.simpleString().lower()


def storable(found: DataType, wanted: DataType) -> bool:
    """Equal, or both numeric: such a value is cast with a range check when it is written."""
    return same_type(found, wanted) or (isinstance(found, NumericType) and isinstance(wanted, NumericType))


def compare(wanted: StructType, found: StructType, fits=same_type) -> list[Difference]:
    """Differences in the order of `wanted`, then columns that only `found` has."""
    by_name = {field.name.lower(): field for field in found}
    differences = []
    for field in wanted:
        other = by_name.pop(field.name.lower(), None)
        if other is None:
            differences.append(Difference(MISSING, field.name))
        elif not fits(other.dataType, field.dataType):
            types = (field.dataType.simpleString(), other.dataType.simpleString())
            differences.append(Difference(MISTYPED, field.name, *types))
    return differences + [Difference(EXTRA, field.name) for field in by_name.values()]


def require_same(what: str, wanted: StructType, found: StructType, fits=same_type) -> None:
    differences = compare(wanted, found, fits)
    if differences:
        raise SchemaMismatch(what, differences)
