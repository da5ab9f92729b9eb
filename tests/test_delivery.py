"""Configuration, transports, the sink, batches and streams."""

import base64
import json
import socket
import tempfile
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lineflow import ConfigError, Field, RowSpec, decode_binary, encode, from_config, from_env, register, save
from lineflow.operators.batch import by_bytes, by_interval, by_rows, flushes, running
from lineflow.operators.decode import DecodeError, parse
from lineflow.operators.delivery import capacity_needed
from lineflow.operators.schema import annotate, columns, merge
from lineflow.sources import config
from lineflow.sources.logs import log
from lineflow.sources.sink import BufferTooLarge, chunks
from lineflow.sources.transport import DeliveryError, HttpSender
from lineflow.streaming import flow


@pytest.fixture
def server():
    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            body = self.rfile.read(int(self.headers["Content-Length"]))
            status = self.server.answers.pop() if self.server.answers else 204
            with self.server.lock:
                self.server.seen.append((self.path, dict(self.headers), body, status))
            self.send_response(status)
            self.send_header("Content-Length", "0")
            self.end_headers()

        def do_GET(self):  # noqa: N802
            known = {} if self.server.versions is None else {"line.proto.support.versions": self.server.versions}
            body = json.dumps({"config": known}).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    s.answers, s.seen, s.versions, s.lock = [], [], [1, 2, 3], threading.Lock()
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield s
    s.shutdown()
    s.server_close()


def conf(s, more=""):
    return f"http::addr=127.0.0.1:{s.server_port};{more}"


def test_config_goldens(monkeypatch):
    o = from_config("http::addr=host;username=us;;;;;;er;;1;;;password=p;;wd;")
    assert (o.username, o.password, o.port, o.auto_flush_rows) == ("us;;;er;1;", "p;wd", 9000, 75000)
    o = from_config("tcp::addr=host;")
    assert (o.port, o.protocol_version, o.auto_flush_rows) == (9009, "1", 600)
    assert from_config("http::addr=a;auto_flush=off;auto_flush_rows=5;auto_flush_rows=7;").auto_flush_rows == 7
    assert from_config("http::addr=a;", bufferSize=10, copy_buffer=True).init_buf_size == 10
    monkeypatch.setenv(config.ENVIRONMENT, "https::addr=x:1;tls_verify=unsafe_off;")
    assert (from_env().port, from_env().tls_verify) == (1, False)


@pytest.mark.parametrize("text", ["", "http", "ftp::addr=a;", "http::host=a;", "http::addr=;", "http::addr=a:b;", "http::addr", "http::addr=a;Addr=b;", "http::addr=a;auto_flush=yes;", "http::addr=a;request_min_throughput=0;", "http::addr=a;auto_flush_rows=-1;", "http::addr=a;username=x\x07;", "http::addr=a;protocol_version=4;", "http::addr=a;tls_roots=b;", "tcp::addr=a;username=u;", "http::;"])
def test_config_errors(text):
    with pytest.raises(ConfigError):
        from_config(text)


@pytest.mark.parametrize("versions, want", [([1, 2, 3], "3"), ([1], "1"), (None, "1"), ([], "1"), ([2, 9], "2")])
def test_versions(versions, want):
    assert config.choose_version({"config": {config.SETTINGS_KEY: versions}}) == want
    with pytest.raises(ConfigError):
        config.choose_version({"config": {config.SETTINGS_KEY: [4, 5]}})


def test_negotiation(server):
    server.versions = [1, 2]
    assert config.negotiate(from_config(conf(server))).protocol_version == "2"


def test_retries_until_success(server):
    server.answers = [204, 500, 523, 504, 500]
    HttpSender(from_config(conf(server, "username=u;password=p;"))).send(b"t a=1i\n")
    assert [x[3] for x in server.seen] == [500, 504, 523, 500, 204]
    assert server.seen[0][0] == "/write?precision=n" and server.seen[0][1]["Authorization"].startswith("Basic ")


def test_failures(server):
    server.answers = [401]
    with pytest.raises(DeliveryError, match="401"):
        HttpSender(from_config(conf(server))).send(b"x")
    assert len(server.seen) == 1
    server.answers = [500] * 9
    with pytest.raises(DeliveryError, match="500"):
        HttpSender(from_config(conf(server, "retry_timeout=0;"))).send(b"x")
    assert len(server.seen) == 2
    with pytest.raises(DeliveryError):
        HttpSender(from_config("http::addr=127.0.0.1:1;")).send(b"x")


def test_chunks():
    assert list(chunks(iter([b"aa", b"bb", b"c", b"dddd"]), 2, 5)) == [(b"aabb", 2), (b"cdddd", 2)]
    assert list(chunks(iter([b"aa", b"bb", b"c"]), 0, 4)) == [(b"aabb", 2), (b"c", 1)]
    assert list(chunks(iter([]), 1, 4)) == []
    with pytest.raises(BufferTooLarge):
        list(chunks(iter([b"aaaaa"]), 0, 4))


def test_sink(spark, server):
    register(spark)
    rows = spark.range(1000).selectExpr("id", "id % 3 as k")
    lines = encode(rows, RowSpec("t", ("k",), (Field("id", "int"),)), 2).select("line").repartition(3)
    lines.write.format("lineflow").option("conf", conf(server, "auto_flush_rows=100;token=abc;")).mode("append").save()
    bodies = b"".join(x[2] for x in server.seen)
    assert sorted(bodies.splitlines()) == sorted(f"t,k={i % 3} id={i}i".encode() for i in range(1000))
    assert all(x[2].count(b"\n") <= 100 and x[1]["Authorization"] == "Bearer abc" for x in server.seen)


class Clock:
    """Each look at the clock is a tenth of a second later."""

    now = 0.0

    def __call__(self):
        self.now += 0.1
        return self.now


def test_chunks_by_time():
    lines = [b"a"] * 7
    assert [n for _, n in chunks(iter(lines), 0, 100, 250, Clock())] == [3, 3, 1]
    assert [n for _, n in chunks(iter(lines), 2, 100, 250, Clock())] == [2, 2, 2, 1]
    assert [n for _, n in chunks(iter(lines), 0, 100, 0, Clock())] == [7]


@pytest.mark.parametrize("versions, want", [([1], "text"), ([1, 2], "binary"), (None, "text")])
def test_save_encodes_in_the_server_s_version(spark, server, versions, want):
    register(spark)
    server.versions = versions
    spec = RowSpec("t", ("k",), (Field("x", "float"),))
    save(spark.range(20).selectExpr("'a' as k", "id + 0.5D as x"), spec, conf(server))
    body = b"".join(x[2] for x in server.seen)
    if want == "text":
        assert sorted(body.splitlines()) == sorted(f"t,k=a x={i}.5".encode() for i in range(20))
    else:
        assert sorted(f["x"] for _, _, f, _ in parse(body)) == [i + 0.5 for i in range(20)]


def test_save_needs_a_common_version(spark, server):
    register(spark)
    server.versions = [4, 5]
    with pytest.raises(ConfigError):
        save(spark.range(1), RowSpec("t", (), (Field("id", "int"),)), conf(server))


def test_save_checks_names_by_the_configuration(spark, server):
    register(spark)
    spec, rows = RowSpec("t", (), (Field("long_name", "int", "id"),)), spark.range(1)
    with pytest.raises(ValueError, match="longer than 5"):
        save(rows, spec, conf(server, "max_name_len=5;"))
    save(rows, spec, conf(server, "max_name_len=9;"))
    assert server.seen[0][2] == b"t long_name=0i\n"


def test_writers_have_senders_of_their_own(spark, server):
    register(spark)
    rows = spark.range(300).selectExpr("id", "concat('k', id % 3) as k").repartition(5)
    save(rows, RowSpec("t", ("k",), (Field("id", "int"),)), conf(server), writer=["k"])
    assert sum(x[2].count(b"\n") for x in server.seen) == 300 and len(server.seen) <= 3


NOTED = Path(tempfile.gettempdir()) / "lineflow-test-noted"  # other processes log


def note(level, message):
    with NOTED.open("a") as f:
        f.write(f"{level} {message}\n")


def backwards(challenge):
    return challenge[::-1]


def test_a_caller_s_log(spark, server):
    register(spark)
    NOTED.write_text("")
    save(spark.range(3), RowSpec("t", (), (Field("id", "int"),)), conf(server), log="test_delivery:note")
    assert "info sent 3 rows" in NOTED.read_text()
    told = []
    from_config("http::addr=a;", copy_buffer=True, log=lambda *x: told.append(x))
    assert told == [("warn", "option copy_buffer is not supported any more")]
    with pytest.raises(ConfigError):
        from_config("http::addr=a;", log="no function")
    with pytest.raises(ValueError, match="unknown log level"):
        log("loud", "x")


def test_tcp_with_a_challenge(spark):
    register(spark)
    listener, seen = socket.create_server(("127.0.0.1", 0)), []

    def serve():
        while True:
            try:
                c, _ = listener.accept()
            except OSError:
                return
            with c, c.makefile("rb") as f:
                seen.append(f.readline())
                c.sendall(b"challenge\n")
                seen.append(f.readline())
                seen.append(f.read())

    threading.Thread(target=serve, daemon=True).start()
    rows = spark.range(3).coalesce(1)
    spec, where = RowSpec("t", (), (Field("id", "int"),)), f"tcp::addr=127.0.0.1:{listener.getsockname()[1]};"
    save(rows, spec, where + "username=key;token=secret;", signer="test_delivery:backwards")
    for _ in range(50):
        if len(seen) < 3:
            time.sleep(0.1)
    assert seen == [b"key\n", base64.b64encode(b"egnellahc") + b"\n", b"t id=0i\nt id=1i\nt id=2i\n"]
    with pytest.raises(Exception, match="signer"):
        save(rows, spec, where + "username=key;token=secret;")
    listener.close()


def test_cut_off_bytes_are_errors(spark):
    spec = RowSpec("t", ("k",), (Field("x", "float"),))
    whole = bytes(encode(spark.range(1).selectExpr("'a' as k", "0.5D as x"), spec, 2).first()["line"])
    assert list(parse(whole)) == [("t", {"k": "a"}, {"x": 0.5}, None)]
    for n in range(1, len(whole)):
        with pytest.raises(DecodeError):
            list(parse(whole[:n]))
    with pytest.raises(Exception, match="DecodeError"):
        decode_binary(spark.createDataFrame([(bytearray(whole[:9]),)], "line binary"), spec).collect()


def test_running_sums_of_wide_rows_without_reuse(spark):
    before = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(3000).selectExpr("id", "hash(id) % 1000 as t", "if(id % 9 = 0, 'b', 'a') as w", "repeat('x', cast(id % 13 as int)) as line", "id * 2 as more").repartition(7)
        within = Window.partitionBy("w").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
        got = by_bytes(df, ["t", "id"], 50, ["w"])
        assert got.columns == [*df.columns, "bytes", "batch"]
        want = df.withColumn("want", F.sum(F.octet_length("line").cast("bigint")).over(within)).select("id", "want")
        assert got.join(want, "id").filter("bytes = want and length(line) = id % 13 and more = id * 2").count() == 3000
        got = by_rows(df, ["t", "id"], 40, ["w"])
        want = df.withColumn("want", F.floor((F.row_number().over(within) - 1) / 40)).select("id", "want")
        assert got.join(want, "id").filter("batch = want").count() == 3000
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)


def test_streams(spark, server, tmp_path):
    register(spark)
    source = str(tmp_path / "in")
    spark.range(50).selectExpr("id", "'a' as k", "id * 1000 as us").coalesce(1).write.parquet(source)
    rows = spark.readStream.schema("id long, k string, us long").parquet(source)
    spec = RowSpec("t", ("k",), (Field("id", "int"),), at="us")
    q = flow.send(rows, spec, conf(server)).option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert b"".join(x[2] for x in server.seen).count(b"\n") == 50
    out = str(tmp_path / "out")
    q = flow.append_once(rows, spec, out).option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 50
    q = flow.batches(rows, "us", "k", 20, 0).writeStream.format("memory").queryName("flow_batches").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r[1] for r in spark.sql("SELECT batch, count(*) FROM flow_batches GROUP BY 1 ORDER BY 1").collect()] == [20, 20, 10]


def test_capacity(spark):
    for current, size, want in ((8, 8, 8), (8, 20, 24), (24, 25, 48), (48, 60, 96)):
        assert spark.range(1).select(capacity_needed(F.lit(size), current)).first()[0] == want


def test_flush_policy():
    times = np.array([0, 1, 2, 10, 11, 25])
    assert flushes(times, 3, 0, (0, 0, 0))[0].tolist() == [0, 0, 0, 1, 1, 1]
    assert flushes(times, 0, 10, (0, 0, 0))[0].tolist() == [0, 0, 0, 0, 1, 1]
    assert flushes(times, 0, 0, (0, 0, 0))[0].tolist() == [0] * 6


def test_batches_by_time_keep_null_writers_and_large_numbers(spark):
    large = (1 << 62) + 1
    rows = [(w, t * 10, None if t % 3 else large + t) for w in (None, 1, 2) for t in range(20)]
    df = spark.createDataFrame(rows, "w long, us long, nanos long").repartition(3)
    got = by_interval(df, "us", ["us"], 4, 1000, ["w"]).collect()
    assert sorted(map(repr, got)) == sorted(repr(type(got[0])(w=w, us=us, nanos=n, batch=us // 40)) for w, us, n in rows)


def test_running_sums_of_a_large_writer(spark):
    df = spark.range(500).selectExpr("id", "(id * 7919) % 503 as t", "if(id % 10 = 0, 'b', if(id % 10 = 1, null, 'a')) as w").repartition(5)
    got = running(df, ["t"], ["w"], {"place": F.lit(1), "total": F.col("id")}).collect()
    for w in ("a", "b", None):
        place = total = 0
        for r in sorted((r for r in got if r.w == w), key=lambda r: r.t):
            place, total = place + 1, total + r.id
            assert (r.place, r.total) == (place, total)
    assert len(got) == 500


def test_batches_without_limit(spark):
    assert {r.batch for r in by_rows(spark.range(5), ["id"], 0, ["id"]).collect()} == {0}


def test_schemas(spark):
    first = spark.createDataFrame([("us", 17.1)], "location string, temperature double")
    second = spark.createDataFrame([("us", 17.3, "york")], "location string, temperature double, city string")
    both = merge(first, second)
    assert both.columns == ["location", "temperature", "city"]
    assert [r.city for r in both.orderBy("temperature").collect()] == [None, "york"]
    told = annotate(both.selectExpr("*", "1L as ts", "array(1.0D) as v"), RowSpec("w", ("location",), (Field("temperature", "float"),), at="ts", unit="ns"))
    assert columns(told) == [
        {"name": "location", "type": "SYMBOL"}, {"name": "temperature", "type": "DOUBLE"}, {"name": "city", "type": "VARCHAR"},
        {"name": "ts", "type": "TIMESTAMP_NS"}, {"name": "v", "type": "ARRAY", "elemType": "DOUBLE", "dim": 1},
    ]
