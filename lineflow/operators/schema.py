"""Schemas that grow: merged tables, the list of tables, typed column metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineflow.functions.arrays import depth, leaf
from lineflow.plans.spec import RowSpec


def merge(*parts: DataFrame) -> DataFrame:
    """Rows of all parts; columns unseen before come last and are null in earlier rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def tables(spark: SparkSession, names: list[str], where: str | None = None) -> DataFrame:
    """(table_name, rows) of catalog tables; counts are one job over column-free scans."""
    each = [spark.table(n).agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n in names]
    found = reduce(DataFrame.unionByName, each)
    return found.filter(where) if where else found


def annotate(df: DataFrame, spec: RowSpec) -> DataFrame:
    """``df`` with the role of each column in its metadata."""
    units = {f.source: f.unit for f in spec.fields if f.kind == "timestamp"} | ({spec.at: spec.unit} if spec.at else {})
    role = {s: {"role": "symbol"} for s in spec.symbols} | {c: {"role": "timestamp", "unit": u} for c, u in units.items()}
    return df.select(*(F.col(c).alias(c, metadata=role.get(c, {})) for c in df.columns))


# The receiver's type names.
TYPES = {T.StringType: "VARCHAR", T.BooleanType: "BOOLEAN", T.LongType: "LONG", T.IntegerType: "INT", T.ShortType: "SHORT", T.ByteType: "BYTE", T.DoubleType: "DOUBLE", T.FloatType: "FLOAT", T.TimestampType: "TIMESTAMP", T.TimestampNTZType: "TIMESTAMP"}


def columns(df: DataFrame) -> list[dict]:
    """[{name, type[, elemType, dim]}] of a DataFrame, by types and metadata."""
    out = []
    for f in df.schema:
        role, kind = (f.metadata or {}).get("role"), f.dataType
        if role == "symbol":
            out.append({"name": f.name, "type": "SYMBOL"})
        elif role == "timestamp":
            out.append({"name": f.name, "type": "TIMESTAMP_NS" if f.metadata.get("unit") == "ns" else "TIMESTAMP"})
        elif isinstance(kind, T.ArrayType):
            out.append({"name": f.name, "type": "ARRAY", "elemType": TYPES.get(type(leaf(kind)), "DOUBLE"), "dim": depth(kind)})
        elif isinstance(kind, T.DecimalType):
            out.append({"name": f.name, "type": f"DECIMAL({kind.precision},{kind.scale})"})
        else:
            out.append({"name": f.name, "type": TYPES.get(type(kind), kind.simpleString().upper())})
    return out
