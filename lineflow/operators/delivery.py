"""Plans of delivery as columns: time limits, retry waits, which answers are tried again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Defaults of senders, and HTTP answers that are tried again.
REQUEST_TIMEOUT_MS = 10_000
RETRY_TIMEOUT_MS = 10_000
MIN_THROUGHPUT = 102_400
FIRST_WAIT_MS, MOST_WAIT_MS = 10, 1_000
RETRYABLE = (500, 503, 504, 507, 509, 523, 524, 529, 599)
SUCCESS = 204
ROWS_HTTP, ROWS_TCP = 75_000, 600
FLUSH_INTERVAL_MS = 1_000


def request_timeout_ms(size: Column, throughput: int = MIN_THROUGHPUT, base: int = REQUEST_TIMEOUT_MS) -> Column:
    """Milliseconds that a request of ``size`` bytes may take."""
    return size / F.lit(throughput) * 1000 + base


def is_retryable(status: Column) -> Column:
    return status.isin(*RETRYABLE)


def retry_schedule(df: DataFrame, attempts: int) -> DataFrame:
    """``df`` times its retries: attempt and wait_ms before it, without jitter."""
    waits = F.transform(F.sequence(F.lit(0), F.lit(attempts - 1)), lambda k: F.struct(k.alias("attempt"), F.least(F.lit(FIRST_WAIT_MS) * F.pow(F.lit(2), k), F.lit(MOST_WAIT_MS)).cast("bigint").alias("wait_ms")))
    return df.select("*", F.explode(waits).alias("_w")).select(*df.columns, "_w.*")


def capacity_needed(size: Column, current: int) -> Column:
    """A buffer of ``current`` bytes grown to hold ``size``: the least multiple of its size that does."""
    return (F.lit(current) * F.greatest(F.ceil(size / current), F.lit(1))).cast("bigint")
