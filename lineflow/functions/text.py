"""Escapes and number texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _behind_backslash(c: Column, marks: str) -> Column:
    """A backslash before each of ``marks``: plain searches of bytes, much cheaper than a pattern.  A backslash comes first in ``marks``."""
    for mark in marks:
        c = F.replace(c, F.lit(mark), F.lit("\\" + mark))
    return c


def escape(c: Column) -> Column:
    """A backslash before blank, comma, equals sign, line ends and backslash, as names and tags need it."""
    return _behind_backslash(c, "\\ ,=\n\r")


def escape_quoted(c: Column) -> Column:
    """A backslash before quotation mark, line ends and backslash, as quoted strings need it."""
    return _behind_backslash(c, '\\"\n\r')


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def _plain(text: Column, scale: int) -> Column:
    """A number text with exponent as digits without trailing zeros."""
    digits = text.try_cast(f"decimal(38,{scale})").cast("string")
    return F.regexp_replace(F.regexp_replace(digits, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def js_number(c: Column) -> Column:
    """A double in the shortest ECMAScript notation: ``17``, ``0.00044``, ``1e+21``.

    Digits are those of the JVM; where it prints one more than needed, so does this.
    """
    c = c.cast("double")
    text, size = c.cast("string"), F.abs(c)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E", -1)
    return (
        F.when((size < 1 << 53) & (c == c.cast("bigint")), c.cast("bigint").cast("string"))  # whole: their digits are exact
        .when((size >= 1e-3) & (size < 1e7), text)
        .when(F.isnan(c) | (size == float("inf")), text)
        .when((size >= 1e7) & (size < 1e21), _plain(text, 12))
        .when((size >= 1e-6) & (size < 1e-3), _plain(text, 24))
        .otherwise(F.concat(mantissa, F.when(power.startswith("-"), "e").otherwise("e+"), power))
    )
