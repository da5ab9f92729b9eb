"""Checks of table names, column names, decimal texts, flags and integers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_NAME = 127
# Characters that names may not contain.
TABLE_BAD = r"[?,'\"\\/:)(+*%~\x00-\x0f\x7f\ufeff]"
COLUMN_BAD = r"[?,'\"\\/:)(+*%~.\-\x00-\x0f\x7f\ufeff]"
TABLE_DOTS = r"^\.|\.$|\.\."
DECIMAL_TEXT = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$|^[-+]?Infinity$|^NaN$"


def _units(name: str) -> int:
    """UTF-16 units of a name."""
    return len(name.encode("utf-16-le", "surrogatepass")) // 2


def check_table_name(name: str, longest: int = MAX_NAME) -> str:
    if not isinstance(name, str):
        raise TypeError(f"a table name must be a string, not {type(name).__name__}")
    if _units(name) > longest:
        raise ValueError(f"table name is longer than {longest} characters")
    if not name:
        raise ValueError("table name is empty")
    if re.search(TABLE_DOTS.replace("$", r"\Z"), name):
        raise ValueError("a table name may hold single dots between other characters only")
    if bad := re.search(TABLE_BAD, name):
        raise ValueError(f"table name holds {bad[0]!r}")
    return name


def check_column_name(name: str, longest: int = MAX_NAME) -> str:
    if not isinstance(name, str):
        raise TypeError(f"a column name must be a string, not {type(name).__name__}")
    if _units(name) > longest:
        raise ValueError(f"column name is longer than {longest} characters")
    if not name:
        raise ValueError("column name is empty")
    if bad := re.search(COLUMN_BAD, name):
        raise ValueError(f"column name holds {bad[0]!r}")
    return name


def _length(c: Column) -> Column:
    """UTF-16 units: characters, and one more for each beyond the basic plane."""
    return F.char_length(c) + F.char_length(F.regexp_replace(c, r"[^\x{10000}-\x{10FFFF}]", ""))


def is_table_name(c: Column, longest: int = MAX_NAME) -> Column:
    fits = (_length(c) <= longest) & (_length(c) > 0)
    return fits & ~c.rlike(TABLE_DOTS.replace("$", r"\z")) & ~c.rlike(TABLE_BAD)


def is_column_name(c: Column, longest: int = MAX_NAME) -> Column:
    return (_length(c) <= longest) & (_length(c) > 0) & ~c.rlike(COLUMN_BAD)


def is_decimal_text(c: Column) -> Column:
    return c.rlike(DECIMAL_TEXT.replace("$", r"\z"))


def is_flag(value: object) -> bool:
    return isinstance(value, bool)


def is_integer(value: object, least: int) -> bool:
    return isinstance(value, int) and not isinstance(value, bool) and value >= least


def is_integer_text(c: Column, least: int) -> Column:
    """Whether a text is an integer of at least ``least``."""
    return F.coalesce(c.try_cast("bigint") >= least, F.lit(False)) & c.rlike(r"^[+-]?\d+\z")
