"""Small queries over tables: a bare name, ``T order by c``, a projection in time order, a result set with its columns."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from lineflow.operators.schema import columns


def query(spark: SparkSession, text: str) -> DataFrame:
    """A SELECT as it is; a text that starts with a table's name gets ``SELECT * FROM`` in front."""
    short = text.strip().rstrip(";")
    if re.match(r"(?i)(select|with|values|show|describe|from|table)\b", short):
        return spark.sql(short)
    return spark.sql(f"SELECT * FROM {short}")


def project(df: DataFrame, names: list[str], at: str, ties: list[str] | None = None) -> DataFrame:
    """Columns of a table in the order of its timestamp (a DataFrame has no order of its own)."""
    return df.orderBy(at, *(ties or [])).select(*names)


def result_set(df: DataFrame, text: str, most: int = 1000) -> dict:
    """query, columns, dataset (``most`` rows at most) and count, as a server answers."""
    return {"query": text, "columns": columns(df), "dataset": [list(r) for r in df.limit(most).collect()], "count": df.count()}
