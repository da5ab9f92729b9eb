"""Lines to rows: version 1 by one pattern in native expressions, versions 2 and 3 by a parser over Arrow batches."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineflow.functions import binary, text
from lineflow.plans.spec import Field, RowSpec

# Names and values of version 1, still escaped; possessive, so long strings need no stack.
_TABLE = r"(?:[^,\\ \n]++|\\.)++"
_NAME = r"(?:[^,=\\ ]++|\\.)++"
_TAG = r"(?:[^, \\]++|\\.)*+"
_VALUE = r'(?:[^ ,"\\]++|\\.|"(?:[^"\\]++|\\.)*+")++'
_TAGS, _FIELDS = rf"(?:,{_NAME}={_TAG})*+", rf"{_NAME}={_VALUE}(?:,{_NAME}={_VALUE})*+"
#: More characters than a text has, for substrings up to its end.
_REST = 1 << 30
#: Array levels that a decoded column may have.
LEAF = {"string": "string", "boolean": "boolean", "int": "bigint", "float": "double", "timestamp": "bigint"}


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """``rows`` with a column in a projection of its own, so what reads it several times computes it once."""
    return rows.select("*", value.alias(name))


def _parts(rows: DataFrame, line: Column, lead: str) -> DataFrame:
    """``rows`` with the parts of a version-1 line: table, tags and fields, all still escaped, and at.

    Each part is cut off the front of what the one before left, so a line is read once.  Texts that are no line have empty parts.
    Names of the new columns start with ``lead``.
    """
    begin = lambda text, pattern: F.regexp_extract(text, f"(?s)^(?:{pattern})", 0)
    behind = lambda text, part: F.substring(text, F.char_length(part) + 1, F.lit(_REST))
    body, table, tail, tags, rest, fields, at, fits = (F.col(lead + k) for k in ("body", "table", "tail", "tags", "rest", "fields", "at", "fits"))
    ends = line.endswith("\n")
    rows = _once(rows, lead + "body", F.when(ends, F.substring(line, F.lit(1), F.char_length(line) - 1)).otherwise(line))
    rows = _once(rows, lead + "table", begin(body, _TABLE))
    rows = _once(rows, lead + "tail", behind(body, table))
    rows = _once(rows, lead + "tags", begin(tail, _TAGS))
    rows = _once(rows, lead + "rest", behind(tail, tags))
    rows = _once(rows, lead + "fields", begin(rest, f" {_FIELDS}"))
    rows = _once(rows, lead + "at", behind(rest, fields))
    rows = _once(rows, lead + "fits", (table != "") & at.rlike(r"^(?: -?\d+)?\z"))
    told = lambda part: F.when(fits, part).otherwise("")
    pairs = lambda part, pair: F.regexp_extract_all(told(part), F.lit(f"(?s){pair}"), F.lit(0))
    rows = _once(rows, lead + "tag_pairs", pairs(tags, f"{_NAME}={_TAG}"))
    rows = _once(rows, lead + "field_pairs", pairs(fields, f"{_NAME}={_VALUE}"))
    rows = _once(rows, lead + "told_table", text.unescape(told(table)))
    return _once(rows, lead + "told_at", F.when(fits, F.substring(at, F.lit(2), F.lit(20)).try_cast("bigint")))


def _one(pairs: Column, name: str) -> Column:
    """The value behind ``name=`` among pairs, still escaped; null where there is none.  Of equal names the first counts."""
    own = re.sub(r"([ ,=\n\r\\])", r"\\\1", name) + "="
    found = F.get(F.filter(pairs, lambda pair: pair.startswith(own)), 0)
    return F.substring(found, F.lit(len(own) + 1), F.lit(_REST))


def _typed(value: Column, kind: str) -> Column:
    if kind == "string":
        quoted = value.startswith('"') & value.endswith('"')
        return text.unescape(F.when(quoted, F.substring(value, F.lit(2), F.char_length(value) - 2)).otherwise(value))
    if kind == "boolean":
        return value == "t"
    if kind == "float":
        return value.try_cast("double")
    return F.regexp_replace(value, "[it]$", "").try_cast("bigint")


def decode_text(lines: DataFrame, spec: RowSpec, line: str = "line") -> DataFrame:
    """The other columns of ``lines``, ``table``, and spec's tags, fields and ``at`` (nanos) of version-1 lines.

    Timestamp fields are micros.  What a line lacks is null.
    """
    others = [F.col("`" + c.replace("`", "``") + "`") for c in lines.columns if c != line]
    lead = "_"
    while any(c.startswith(lead) for c in lines.columns):
        lead += "_"
    rows = _parts(lines, F.col(line), lead)
    for kind, names in (("tag", spec.symbols), ("field", [f.name for f in spec.fields])):
        for k, name in enumerate(names):
            rows = rows.select("*", _one(F.col(f"{lead}{kind}_pairs"), name).alias(f"{lead}{kind}{k}"))
    tags = [text.unescape(F.col(f"{lead}tag{k}")).alias(s) for k, s in enumerate(spec.symbols)]
    fields = [_typed(F.col(f"{lead}field{k}"), f.kind).alias(f.name) for k, f in enumerate(spec.fields)]
    at = [F.col(lead + "told_at").alias(spec.at)] if spec.at else []
    return rows.select(*others, F.col(lead + "told_table").alias("table"), *tags, *fields, *at)


# --- versions 2 and 3 ---


class DecodeError(ValueError):
    """Bytes that are no whole line."""


_PART = {stops: re.compile(rb"(?s)(?:[^\\" + re.escape(stops) + rb"]|\\.)*") for stops in (b", \n", b"=", b'"')}
_ESCAPE = re.compile(rb"(?s)\\(.)")
_STAMP = re.compile(rb"-?[0-9]+[tn](?=\n)")


def _until(data: bytes, i: int, stops: bytes) -> tuple[str, int]:
    """Text from ``i`` up to a stop that isn't escaped, unescaped."""
    end = _PART[stops].match(data, i).end()
    if end >= len(data):
        raise DecodeError(f"the line is cut off at byte {len(data)}")
    part = data[i:end]
    return (_ESCAPE.sub(rb"\1", part) if b"\\" in part else part).decode(), end


_double = struct.Struct("<d").unpack_from


def _value(data: bytes, i: int) -> tuple[object, int]:
    """A field's value, and where it ends."""
    first = data[i]
    if first == 0x3D:  # binary
        code = data[i + 1]
        if code == binary.FLOAT:
            return _double(data, i + 2)[0], i + 10
        if code == binary.DECIMAL:
            end = i + 4 + data[i + 3]
            return binary.decimal_of(data[i + 1 : end]), end
        if code != binary.ARRAY:
            raise DecodeError(f"unknown type code {code} at byte {i + 1}")
        if data[i + 2] == binary.NULL_LEAF:
            return None, i + 3
        n = data[i + 3]
        shape = np.frombuffer(data, "<i4", n, i + 4)
        end = i + 4 + 4 * n + 8 * int(shape.prod())
        return binary.array_of(data[i + 1 : end]), end
    if first == 0x22:
        value, i = _until(data, i + 1, b'"')
        return value, i + 1
    raw, i = _until(data, i, b", \n")
    if raw in ("t", "f"):
        return raw == "t", i
    return (raw[:-1] if raw[-1:] == "d" else int(raw[:-1])), i


def parse(data: bytes) -> Iterator[tuple[str, dict, dict, str | None]]:
    """(table, tags, fields, timestamp text) of each line of a blob of version 2 or 3.

    A timestamp keeps its unit letter.  Binary values may hold any byte, so only a parser finds the line ends.
    Bytes that are no whole line raise a DecodeError.
    """
    i = 0
    try:
        while i < len(data):
            tags, fields, at = {}, {}, None
            table, i = _until(data, i, b", \n")
            while data[i] == 0x2C:
                name, i = _until(data, i + 1, b"=")
                tags[name], i = _until(data, i + 1, b", \n")
            while data[i] != 0x0A:
                i += 1
                stamp = _STAMP.match(data, i)
                if stamp:
                    at, i = stamp[0].decode(), stamp.end()
                    continue
                name, i = _until(data, i, b"=")
                fields[name], i = _value(data, i + 1)
            yield table, tags, fields, at
            i += 1
    except DecodeError:
        raise
    except (IndexError, ValueError, struct.error) as e:
        raise DecodeError(f"no whole line at byte {i}: {e}") from e


def _type(f: Field, kinds: dict[str, T.DataType]) -> T.DataType:
    return kinds.get(f.name) or {"string": T.StringType(), "boolean": T.BooleanType(), "float": T.DoubleType(), "decimal_text": T.StringType()}.get(f.kind, T.LongType())


def _nest(found: tuple[list[int], np.ndarray] | None, levels: int) -> list | None:
    if found is None:
        return None
    shape, leaves = found
    nested = leaves.reshape(shape).tolist() if len(shape) == levels else [] if 0 in shape else None
    if nested is None:
        raise ValueError(f"an array of {len(shape)} dimensions where {levels} are declared")
    return nested


def decode_binary(lines: DataFrame, spec: RowSpec, kinds: dict[str, T.DataType] | None = None, line: str = "line") -> DataFrame:
    """``table``, tags, fields and ``at`` (nanos) of blobs of whole version-2 or -3 lines.

    ``kinds`` gives the types of array and decimal columns.  Other columns of ``lines`` come along with each row.
    """
    kinds = kinds or {}
    others = [lines.schema[c] for c in lines.columns if c != line]
    own = [T.StructField("table", T.StringType()), *(T.StructField(s, T.StringType()) for s in spec.symbols)]
    own += [T.StructField(f.name, _type(f, kinds)) for f in spec.fields]
    own += [T.StructField(spec.at, T.LongType())] if spec.at else []
    schema = T.StructType(others + own)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    levels = {f.name: _levels(kinds.get(f.name)) for f in spec.fields if f.kind == "array"}
    keep, symbols, names = [f.name for f in others], spec.symbols, [f.name for f in spec.fields]
    with_at = bool(spec.at)

    def run(batches):
        for batch in batches:
            rows = []
            before = list(zip(*(batch.column(k).to_pylist() for k in keep), strict=True)) or [()] * batch.num_rows
            for more, blob in zip(before, batch.column(line).to_pylist(), strict=True):
                for table, tags, fields, at in parse(blob or b""):
                    values = [_nest(fields.get(n), levels[n]) if n in levels else fields.get(n) for n in names]
                    stamp = [None if at is None else int(at[:-1]) * (1000 if at[-1] == "t" else 1)] if with_at else []
                    rows.append((*more, table, *(tags.get(s) for s in symbols), *values, *stamp))
            columns = zip(*rows, strict=True) if rows else [[]] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return lines.mapInArrow(run, schema)


def _levels(kind: T.DataType | None) -> int:
    return 1 + _levels(kind.elementType) if isinstance(kind, T.ArrayType) else 0
