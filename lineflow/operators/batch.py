"""Which rows are sent together: by rows, by time, by bytes.

Batches are made per key (a writer, as with one sender per worker).  Batches by rows and bytes
need running sums only, which are made in two levels, however many rows a writer has.  The time
rule is sequential: a writer's rows pass one task in order, without being held.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Rows that are sampled for each range of the order.
SAMPLED = 100


def _by_range(df: DataFrame, order: list[str], ranges: int) -> DataFrame:
    """``df`` with ``_part``: the range of ``order`` that a row falls in, by bounds that are fixed here once and for all."""
    keys = df.select(*order)
    share = min(1.0, SAMPLED * ranges / max(keys.count(), 1))
    found = keys.sample(share, seed=1).orderBy(*order).collect()
    bounds = [tuple(found[len(found) * k // ranges]) for k in range(1, ranges)] if found else []
    bounds = df.sparkSession.createDataFrame([(bounds,)], T.StructType([T.StructField("bounds", T.ArrayType(keys.schema))])).scalar()
    rows = df.select("*", bounds.alias("_bounds"))
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(max(ranges - 1, 1).bit_length()))))  # of a binary search
    own = F.struct(*order)
    part = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get("_bounds", at + step - 1) <= own, at + step).otherwise(at))
    return rows.select(*(rows[c] for c in df.columns), part.alias("_part"))


def running(df: DataFrame, order: list[str], writer: list[str], sums: dict[str, Column], ranges_by: list[str] | None = None) -> DataFrame:
    """``df`` with running sums, each row included, over a writer's rows in ``order``.

    A writer may own most rows, so rows are dealt by ranges of ``order``; sums run within a
    writer's share of a range, and the totals of its ranges before are added.  The ranges' bounds come
    from a sample that is taken at once, and a row's range depends on nothing else, however often Spark computes it.
    Rows that ``order`` doesn't tell apart are numbered in any order.  ``ranges_by`` are the first columns of ``order``, where
    these alone tell rows apart well enough and the others are large.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _by_range(df.select("*", *(c.cast("bigint").alias(k) for k, c in sums.items())), ranges_by or order, ranges)
    inside = Window.partitionBy(*writer, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = dealt.select("*", *(F.sum(k).over(inside).alias(f"_in_{k}") for k in sums))
    totals = dealt.groupBy(*writer, "_part").agg(*(F.sum(k).alias(f"_all_{k}") for k in sums))
    along = Window.partitionBy(*writer).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        F.col("_part").alias("_range"),
        *(F.col(w).alias(f"_of_{w}") for w in writer),
        *(F.coalesce(F.sum(f"_all_{k}").over(along), F.lit(0)).alias(f"_to_{k}") for k in sums),
    )
    met = F.col("_part") == F.col("_range")
    for w in writer:
        met = met & F.col(w).eqNullSafe(F.col(f"_of_{w}"))
    return rows.join(before, met).select(*(rows[c] for c in df.columns), *((F.col(f"_in_{k}") + F.col(f"_to_{k}")).alias(k) for k in sums))


def by_rows(df: DataFrame, order: list[str], rows: int, writer: list[str]) -> DataFrame:
    """``df`` with ``batch``: rows 0 to rows - 1 of a writer are batch 0 and so on; rows 0 means one batch."""
    if rows <= 0:
        return df.withColumn("batch", F.lit(0).cast("bigint"))
    numbered = running(df, order, writer, {"_place": F.lit(1)})
    return numbered.withColumn("batch", F.floor((F.col("_place") - 1) / rows).cast("bigint")).drop("_place")


def by_bytes(df: DataFrame, order: list[str], limit: int, writer: list[str], line: str = "line") -> DataFrame:
    """``df`` with ``bytes`` (of a writer's lines up to this one) and ``batch`` (by multiples of ``limit``).

    A line that alone is larger than ``limit`` raises an error.
    """
    size = F.octet_length(line).cast("bigint")
    fits = F.when(size > limit, F.raise_error(F.lit(f"a line is larger than {limit} bytes")).cast("bigint")).otherwise(size)
    df = running(df, order, writer, {"bytes": fits})
    return df.withColumn("batch", F.floor((F.col("bytes") - 1) / limit).cast("bigint"))


def flushes(micros: np.ndarray, rows: int, interval: int, state: tuple[int, int, int]) -> tuple[np.ndarray, tuple[int, int, int]]:
    """Batch numbers of rows in order, and the state after them: (batch, rows pending, time of the last flush).

    A row that makes ``rows`` pending, or comes ``interval`` micros or more after the last flush, ends its batch.
    """
    batch, pending, last = state
    out = np.empty(len(micros), np.int64)
    for i, t in enumerate(micros.tolist()):
        out[i] = batch
        pending += 1
        if rows and pending >= rows or interval and t - last >= interval:
            batch, pending, last = batch + 1, 0, t
    return out, (batch, pending, last)


def by_interval(df: DataFrame, micros: str, order: list[str], rows: int, interval: int, writer: list[str]) -> DataFrame:
    """``df`` with ``batch`` by rows and time, in the order of events; the first row's time is where a writer starts.

    A writer's rows come in sorted Arrow batches, and only the state of three numbers is held between them.
    Null is a writer like any other; the other columns pass as they are.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("batch", T.LongType())])
    names = list(writer)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, (0, 0, 0)
        for part in parts:
            out = np.empty(part.num_rows, np.int64)
            keys = list(zip(*(part.column(n).to_pylist() for n in names), strict=True))
            times = part.column(micros).to_numpy()
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if keys[a] != key:
                    key, state = keys[a], (0, 0, int(times[a]))
                out[a:b], state = flushes(times[a:b], rows, interval, state)
            yield part.append_column("batch", pa.array(out))

    dealt = df.repartition(*(F.col(n) for n in names)).sortWithinPartitions(*names, *order)
    return dealt.mapInArrow(run, schema)


def summary(batched: DataFrame, writer: list[str], *more: Column) -> DataFrame:
    """One row per batch: writer, batch, rows and whatever ``more`` aggregates."""
    return batched.groupBy(*writer, "batch").agg(F.count("*").alias("rows"), *more)
