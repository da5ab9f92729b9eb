"""``df.write.format("lineflow")``: batches of encoded lines to a server, for batch and streaming.

``save`` does all of it: it settles the protocol version with the server, encodes rows in this version with names
as long as ``max_name_len`` allows, and writes them.  Whoever encodes rows by hand writes a DataFrame with a column
``line`` (see ``operators.encode``).  Each task opens one sender, and sends whole rows: a request is due when
``auto_flush_rows`` rows are pending, when ``auto_flush_interval`` has passed since the last one, or when the next
row would exceed ``max_buf_size`` bytes; a task's last rows are always sent.  Counts of rows, requests and bytes go to
``commit``.  A failed task is run again by Spark, so delivery is at least once unless the server drops repeats.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from lineflow.operators.encode import encode
from lineflow.plans.spec import RowSpec
from lineflow.sources.config import Options, from_config, from_env, negotiate
from lineflow.sources.logs import imported
from lineflow.sources.transport import sender


@dataclass
class Sent(WriterCommitMessage):
    rows: int
    requests: int
    bytes: int


class BufferTooLarge(ValueError):
    pass


def chunks(lines: Iterator[bytes], rows: int, limit: int, interval: int = 0, clock: Callable[[], float] = time.monotonic) -> Iterator[tuple[bytes, int]]:
    """(bytes, rows) of requests: whole lines only; ``rows`` 0 and ``interval`` 0 (milliseconds) set no limit."""
    held: list[bytes] = []
    size, last = 0, clock()
    for line in lines:
        if len(line) > limit:
            raise BufferTooLarge(f"a line of {len(line)} bytes exceeds max_buf_size {limit}")
        if held and size + len(line) > limit:
            yield b"".join(held), len(held)
            held, size, last = [], 0, clock()
        held.append(line)
        size += len(line)
        if rows and len(held) >= rows or interval and (clock() - last) * 1000 >= interval:
            yield b"".join(held), len(held)
            held, size, last = [], 0, clock()
    if held:
        yield b"".join(held), len(held)


class _Writer:
    def __init__(self, options: Options, signer: str | None = None):
        self.options, self.signer = options, signer

    def write(self, rows: Iterator) -> Sent:
        o, out = self.options, sender(self.options, imported(self.signer) if self.signer else None)
        done = size = 0
        lines = (r["line"].encode() if isinstance(r["line"], str) else bytes(r["line"]) for r in rows if r["line"] is not None)
        try:
            for data, n in chunks(lines, o.auto_flush_rows * o.auto_flush, o.max_buf_size, o.auto_flush_interval * o.auto_flush):
                out.send(data)
                done, size = done + n, size + len(data)
        finally:
            out.close()
        return Sent(done, out.requests, size)


class BatchWriter(_Writer, DataSourceWriter):
    def commit(self, messages: list[Sent | None]) -> None:
        told = [m for m in messages if m]
        self.options.log("info", f"sent {sum(m.rows for m in told)} rows in {sum(m.requests for m in told)} requests")

    def abort(self, messages: list[Sent | None]) -> None:
        self.options.log("warn", f"the write failed; {sum(m is not None for m in messages)} tasks had sent their rows")


class StreamWriter(_Writer, DataSourceStreamWriter):
    def commit(self, messages: list[Sent | None], batchId: int) -> None:  # noqa: N803
        self.options.log("info", f"batch {batchId}: sent {sum(m.rows for m in messages if m)} rows")

    def abort(self, messages: list[Sent | None], batchId: int) -> None:  # noqa: N803
        self.options.log("warn", f"batch {batchId} failed")


def _settled(conf: str | None, log: str | None, version: str | None = None) -> Options:
    """Options of a configuration text, or of the environment variable, with the version settled."""
    more = {"log": imported(log)} if log else {}
    if version:
        more["protocol_version"] = version
    return negotiate(from_config(conf, **more) if conf else from_env(**more))


class LineSource(DataSource):
    """Options: ``conf`` (a configuration text, else the environment variable is read), ``protocol_version``, which overrides
    that of ``conf``, and ``signer`` and ``log``, each ``module:function``.
    """

    @classmethod
    def name(cls) -> str:
        return "lineflow"

    def _settled(self) -> tuple[Options, str | None]:
        o = self.options
        return _settled(o.get("conf"), o.get("log"), o.get("protocol_version")), o.get("signer")

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        return BatchWriter(*self._settled())

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:  # noqa: N802
        return StreamWriter(*self._settled())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LineSource)


def encoded(rows: DataFrame, spec: RowSpec, conf: str | None = None, log: str | None = None, writer: list[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """The lines of ``rows`` in the version that the server and this library share, and the options to write them with.

    ``writer`` columns give each of their values to one task, as a sender of its own would.
    """
    options = _settled(conf, log)
    lines = encode(rows, replace(spec, longest=options.max_name_len), int(options.protocol_version))
    if writer:
        lines = lines.repartition(*writer)
    given = {"conf": conf, "log": log, "protocol_version": options.protocol_version}
    return lines.select("line"), {k: v for k, v in given.items() if v}


def save(rows: DataFrame, spec: RowSpec, conf: str | None = None, log: str | None = None, signer: str | None = None, writer: list[str] | None = None) -> None:
    """Encode ``rows`` and send them to the server of ``conf``."""
    lines, options = encoded(rows, spec, conf, log, writer)
    options |= {"signer": signer} if signer else {}
    lines.write.format("lineflow").options(**options).mode("append").save()
