"""Structured Streaming: encode and send micro-batches, assign batches across them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lineflow.operators.batch import flushes
from lineflow.operators.encode import encode
from lineflow.plans.spec import RowSpec
from lineflow.sources.sink import encoded


def send(rows: DataFrame, spec: RowSpec, conf: str) -> DataStreamWriter:
    """A stream's rows encoded in the server's version and written to it; call ``start()`` on it."""
    lines, options = encoded(rows, spec, conf)
    return lines.writeStream.format("lineflow").options(**options)


def append_once(rows: DataFrame, spec: RowSpec, path: str, version: int = 1) -> DataStreamWriter:
    """Encoded lines by micro-batch below ``path``: a batch that is run again replaces what it wrote."""

    def write(batch: DataFrame, number: int) -> None:
        encode(batch, spec, version).select("line").write.mode("overwrite").parquet(f"{path}/batch={number}")

    return rows.writeStream.foreachBatch(write)


def batches(rows: DataFrame, micros: str, writer: str, limit: int, interval: int) -> DataFrame:
    """(writer, micros, batch) of a stream by rows and time; three numbers of state per writer.

    Rows of a writer are ordered by time within a micro-batch.
    """
    schema = T.StructType([rows.schema[writer], rows.schema[micros], T.StructField("batch", T.LongType())])
    state_schema = "batch long, pending long, last long"

    def assign(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        times = np.sort(np.concatenate([p[micros].to_numpy(np.int64) for p in parts]))  # 8 bytes a row of one micro-batch
        held = state.get if state.exists else (0, 0, int(times[0]))
        numbers, held = flushes(times, limit, interval, tuple(held))
        state.update(held)
        yield pd.DataFrame({writer: key[0], micros: times, "batch": numbers})

    return rows.select(writer, micros).groupBy(writer).applyInPandasWithState(assign, schema, state_schema, "append", GroupStateTimeout.NoTimeout)
