"""Rows to lines.  Version 1 is text and one native projection; versions 2 and 3 carry binary values.

A null tag or field is left out with its separator; arrays and decimals have null values of their
own (versions 2 and 3).  A row without any tag and field is an error: strict mode raises
it, otherwise its line is null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineflow.functions import arrays, binary, names, text, times
from lineflow.plans.spec import Field, RowSpec


def _stamp(df: DataFrame, column: str, unit: str, version: int, designated: bool) -> Column:
    """A timestamp's text.  Columns of timestamp type are micros whatever ``unit`` says."""
    kind = df.schema[column].dataType.simpleString()
    c = F.col(column)
    if kind.startswith("timestamp"):
        c, unit = times.epoch_micros(c, kind), "us"
    if version == 1:
        return times.to_nanos(c, unit).cast("string") if designated else F.concat(times.to_micros(c, unit).cast("string"), F.lit("t"))
    if unit == "ns":
        return F.concat(c.cast("string"), F.lit("n"))
    return F.concat(times.to_micros(c, unit).cast("string"), F.lit("t"))


def _text_value(df: DataFrame, f: Field, version: int) -> Column | None:
    """The value of a field that is text in ``version``, or None."""
    c = F.col(f.source)
    if f.kind == "string":
        return F.concat(F.lit('"'), text.escape_quoted(c), F.lit('"'))
    if f.kind == "boolean":
        return F.when(c, "t").when(~c, "f")
    if f.kind == "int":
        return F.concat(c.cast("string"), F.lit("i"))
    if f.kind == "timestamp":
        return _stamp(df, f.source, f.unit, version, designated=False)
    if f.kind == "decimal_text":
        told = text.js_number(c) if isinstance(df.schema[f.source].dataType, (T.DoubleType, T.FloatType)) else c.cast("string")
        bad = F.raise_error(F.concat(F.lit("not a decimal: "), told)).cast("string")
        return F.when(told.isNull(), None).when(names.is_decimal_text(told), F.concat(told, F.lit("d"))).otherwise(bad)
    if f.kind == "float" and version == 1:
        return text.js_number(c)
    return None


def _binary_value(df: DataFrame, f: Field) -> Column:
    c = F.col(f.source)
    if f.kind == "float":
        return binary.float_value(c.cast("double"))
    if f.kind == "decimal":
        return binary.decimal_value(c)
    levels = arrays.depth(df.schema[f.source].dataType)
    ragged = F.raise_error(F.lit(f"the lengths of sub-arrays of {f.name} differ")).cast("array<int>")
    shape = F.when(c.isNull(), F.lit(None)).when(arrays.regular(c, levels), arrays.dims(c, levels)).otherwise(ragged)
    return binary.array_value(shape, F.coalesce(arrays.flatten_all(c, levels).cast("array<double>"), F.array().cast("array<double>")))


def _bytes(c: Column) -> Column:
    return F.encode(c, "UTF-8")


def encode(df: DataFrame, spec: RowSpec, version: int = 1, strict: bool = True) -> DataFrame:
    """``df`` with a column ``line``: a string with its line end (version 1), or binary (2 and 3)."""
    spec.check(df, version)
    table = text.escape(F.col(spec.table_column) if spec.table_column else F.lit(spec.table))
    tags = [F.concat(F.lit(","), text.escape(F.lit(s)), F.lit("="), text.escape(F.col(s).cast("string"))) for s in spec.symbols]
    plain = {f.name: _text_value(df, f, version) for f in spec.fields}
    head = F.concat(table, *(F.coalesce(t, F.lit("")) for t in tags))
    stamp = F.coalesce(F.concat(F.lit(" "), _stamp(df, spec.at, spec.unit, version, True)), F.lit("")) if spec.at else F.lit("")
    named = [(F.concat(text.escape(F.lit(f.name)), F.lit("=")), plain[f.name], f) for f in spec.fields]
    empty = reduce(lambda a, b: a & b, [F.col(s).isNull() for s in spec.symbols], F.lit(True))
    if version == 1:
        fields = F.concat_ws(",", *(F.concat(n, v) for n, v, _ in named))
        body = F.when(fields == "", "").otherwise(F.concat(F.lit(" "), fields)) if named else F.lit("")
        line = F.concat(head, body, stamp, F.lit("\n"))
        empty = empty & (body == "")
    else:
        parts = []
        for n, v, f in named:
            parts.append(_bytes(F.concat(n, v)) if v is not None else F.concat(_bytes(n), _bytes(F.lit("=")), _binary_value(df, f)))
        found = F.filter(F.array(*parts), lambda x: x.isNotNull()) if parts else F.array().cast("array<binary>")
        blank = F.lit(b"").cast("binary")
        body = F.aggregate(found, blank, lambda a, x: F.concat(a, F.when(F.octet_length(a) == 0, _bytes(F.lit(" "))).otherwise(_bytes(F.lit(","))), x))
        line = F.concat(_bytes(head), body, _bytes(F.concat(stamp, F.lit("\n"))))
        empty = empty & (F.size(found) == 0)
    kind = "string" if version == 1 else "binary"
    none = F.raise_error(F.lit("a row has neither tags nor fields")).cast(kind) if strict else F.lit(None).cast(kind)
    return df.withColumn("line", F.when(empty, none).otherwise(line))
