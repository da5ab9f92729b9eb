"""Helpers the operators share: lineage cuts, skew-safe lookups, key filters."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: At most this many keys can each own more than 1/HOT_KEYS of the rows.
HOT_KEYS = 1000
#: Rows below which no key is worth a broadcast.
HOT_FLOOR = 50
#: Bits in one bucket of Spark's bitmap aggregate.
BUCKET_BITS = 32768
#: Largest key filter: 2**28 bits are 32 MB when broadcast.
MAX_FILTER_BITS = 1 << 28
#: Rows of texts in one Arrow batch: some MB on each side of the pipe.
BATCH_ROWS = 1000

_held: dict[str, Any] = {}


def held(name: str, make: Callable[[], Any]) -> Any:
    """What this Python worker keeps between tasks under ``name``; only the last name's thing is kept.

    Workers outlive a stage, so whatever an earlier stage kept would count against the next one's memory.
    """
    if name not in _held:
        _held.clear()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)
        _held[name] = make()
    return _held[name]


def text_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_ROWS rows for this session, unless it sets a number of its own.

    Spark's 10,000 rows suit numbers; so many texts take tens of MB in each task and its worker.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else, on one machine only, a new one."""
    sc = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if known is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        known = tempfile.mkdtemp(prefix="lineflow-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(known)
    return known


def cut(df: DataFrame) -> DataFrame:
    """Compute once and keep in the shared folder, so a lost executor costs no recomputation.

    Spark removes the files once the result is out of use where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path for a written table in the shared folder."""
    return os.path.join(shared_dir(spark), f"lineflow-scratch-{name}-{uuid.uuid4().hex}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that ``scratch`` named, on whatever file system it is."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def fresh(*frames: DataFrame) -> Callable[[str], str]:
    """A maker of column names that none of the frames has: as many underscores go in front as are needed."""
    taken = [c for df in frames for c in df.columns]
    lead = "_"
    while any(c.startswith(lead) for c in taken):
        lead += "_"
    return lambda name: lead + name


def own(df: DataFrame, *but: str) -> list[Column]:
    """The columns of ``df`` but some, quoted: names may hold dots."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c not in but]


def lookup(rows: DataFrame, table: DataFrame, key: str, total: int, weight: str = "n") -> DataFrame:
    """Left join of ``rows`` with ``table`` (unique ``key``; ``weight`` = rows that carry it).

    Keys that own more than ``total / HOT_KEYS`` rows number at most ``HOT_KEYS``, so this
    part of ``table`` is broadcast; what remains is shuffled and holds no large group.
    """
    limit = max(HOT_FLOOR, total // HOT_KEYS)
    hot = table.filter(F.col(weight) > limit)
    met = rows.join(F.broadcast(hot), key, "inner")
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    cold = rest.join(table.filter(F.col(weight) <= limit), key, "left")
    return met.unionByName(cold)


def key_filter(keys: DataFrame, hashed: Column, count: int) -> tuple[DataFrame, int]:
    """A bitmap of the hashes of ``keys``: rows (bucket, bits), and its number of bits.

    About 16 bits a key up to MAX_FILTER_BITS, beyond which more rows pass, never fewer.  Keys are dealt by
    bucket, so that each bucket's bits are made in one place.
    """
    size = BUCKET_BITS
    while size < min(16 * count, MAX_FILTER_BITS):
        size *= 2
    at = F.pmod(hashed, F.lit(size))
    dealt = keys.select(at.alias("at")).select((F.col("at") / BUCKET_BITS).cast("long").alias("bucket"), (F.col("at") % BUCKET_BITS).alias("place"))
    return dealt.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits")), size


def split_by_filter(rows: DataFrame, hashed: Column, bits: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be among the keys of a ``key_filter``, and rows whose key is not."""
    at, bucket, mask, hit = map(fresh(rows), ("at", "bucket", "bits", "hit"))
    byte = ((F.col(at) % BUCKET_BITS) / 8).cast("int")
    value = F.conv(F.hex(F.substring(F.col(mask), byte + 1, F.lit(1))), 16, 10).cast("int")
    met = F.coalesce(F.getbit(value, (F.col(at) % 8).cast("int")) == 1, F.lit(False))
    marked = (
        rows.withColumn(at, F.pmod(hashed, F.lit(size)))
        .withColumn(bucket, (F.col(at) / BUCKET_BITS).cast("long"))
        .join(F.broadcast(bits.toDF(bucket, mask)), bucket, "left")
        .withColumn(hit, met)
    )
    pick = lambda keep: marked.filter(keep).select(*own(rows))
    return pick(F.col(hit)), pick(~F.col(hit))


def drop_rows(docs: DataFrame, drops: DataFrame, text_key: Column) -> DataFrame:
    """``docs`` without the rows that ``drops`` (doc_id, text_key, spare) names.

    ``spare`` true keeps one of the rows with this doc_id and text key.  Only rows that
    pass a key filter are shuffled, so the texts of all others stay where they are.
    """
    drops = cut(drops.select("doc_id", "text_key", "spare"))
    count = drops.count()
    if count == 0:
        return docs
    bits, size = key_filter(drops, F.xxhash64("doc_id"), count)
    maybe, clear = split_by_filter(docs, F.xxhash64("doc_id"), cut(bits), size)
    key, drop_id, drop_key, spare = map(fresh(docs), ("key", "drop_id", "drop_key", "spare"))
    met = F.col("doc_id").eqNullSafe(F.col(drop_id)) & F.col(key).eqNullSafe(F.col(drop_key))
    told = maybe.withColumn(key, text_key).join(drops.toDF(drop_id, drop_key, spare), met, "left")
    kept = clear.unionByName(told.filter(F.col(spare).isNull()).select(*own(docs)))
    if drops.filter("spare").isEmpty():
        return kept
    one = told.filter(F.col(spare)).dropDuplicates(["doc_id", key]).select(*own(docs))
    return kept.unionByName(one)
