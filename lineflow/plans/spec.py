"""RowSpec: which columns of a DataFrame are tags, fields and the designated timestamp."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lineflow.functions.arrays import depth, leaf
from lineflow.functions.names import MAX_NAME, check_column_name, check_table_name
from lineflow.functions.times import check_unit

KINDS = ("string", "boolean", "int", "float", "array", "timestamp", "decimal", "decimal_text")
VERSIONS = (1, 2, 3)


class SpecError(ValueError):
    """A declaration that cannot make valid rows."""


@dataclass(frozen=True)
class Field:
    """A typed field; ``column`` is the DataFrame's column (by default ``name``), ``unit`` that of numbers as timestamps."""

    name: str
    kind: str
    column: str | None = None
    unit: str = "us"

    @property
    def source(self) -> str:
        return self.column or self.name


@dataclass(frozen=True)
class RowSpec:
    """Rows of one table: tags first, then fields, then the timestamp (None: the receiver assigns it)."""

    table: str
    symbols: tuple[str, ...] = ()
    fields: tuple[Field, ...] = ()
    at: str | None = None
    unit: str = "us"
    longest: int = MAX_NAME
    table_column: str | None = field(default=None)

    def __post_init__(self) -> None:
        if self.table_column is None:
            check_table_name(self.table, self.longest)
        for name in (*self.symbols, *(f.name for f in self.fields)):
            check_column_name(name, self.longest)
        if not self.symbols and not self.fields:
            raise SpecError("a row needs a tag or a field")
        names = [*self.symbols, *(f.name for f in self.fields)]
        if len({*names}) < len(names):
            raise SpecError("a name is declared twice")
        for f in self.fields:
            if f.kind not in KINDS:
                raise SpecError(f"unknown kind {f.kind!r} of field {f.name}, expected one of {KINDS}")
            check_unit(f.unit)
        check_unit(self.unit)

    def check(self, df: DataFrame, version: int) -> None:
        """Raise unless ``df`` has the columns, in types that ``version`` can carry."""
        if version not in VERSIONS:
            raise SpecError(f"unknown protocol version {version!r}")
        need = [*self.symbols, *(f.source for f in self.fields), *filter(None, (self.at, self.table_column))]
        if missing := [c for c in need if c not in df.columns]:
            raise SpecError(f"columns {missing} are missing")
        if self.unit == "ns" and self.at and not isinstance(df.schema[self.at].dataType, T.LongType):
            raise SpecError("nanoseconds need a column of longs")
        for f in self.fields:
            kind = df.schema[f.source].dataType
            if f.kind == "array":
                if version == 1:
                    raise SpecError("protocol version 1 has no arrays")
                if not depth(kind):
                    raise SpecError(f"{f.name} must be an array, not {kind.simpleString()}")
                if not isinstance(leaf(kind), T.NumericType):
                    raise SpecError(f"{f.name} must be an array of numbers, not {kind.simpleString()}")
            if f.kind in ("decimal", "decimal_text") and version < 3:
                raise SpecError(f"protocol version {version} has no decimals")
            if f.kind == "decimal" and not isinstance(kind, T.DecimalType):
                raise SpecError(f"{f.name} must be a decimal, not {kind.simpleString()}")
            if f.kind == "string" and not isinstance(kind, T.StringType):
                raise SpecError(f"{f.name} must be a string, not {kind.simpleString()}")
            if f.kind == "boolean" and not isinstance(kind, T.BooleanType):
                raise SpecError(f"{f.name} must be a boolean, not {kind.simpleString()}")
            if f.kind == "int" and not isinstance(kind, T.IntegralType):
                raise SpecError(f"{f.name} must be an integer, not {kind.simpleString()}")
            if f.kind == "float" and not isinstance(kind, T.NumericType):
                raise SpecError(f"{f.name} must be a number, not {kind.simpleString()}")
            if f.kind == "timestamp" and f.unit == "ns" and not isinstance(kind, T.LongType):
                raise SpecError(f"{f.name}: nanoseconds need a column of longs")
