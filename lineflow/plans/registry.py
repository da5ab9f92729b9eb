"""Registered queries over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineflow.functions import arrays, binary, names, text, times
from lineflow.operators import batch, delivery, schema
from lineflow.operators.decode import decode_binary, decode_text
from lineflow.operators.encode import encode
from lineflow.plans.query import project, query
from lineflow.plans.spec import Field, RowSpec
from lineflow.sources.config import config_pairs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

EVENTS = RowSpec("events", ("event_type",), (Field("user_id", "int"), Field("value", "float"), Field("props", "string")), at="ts")
LINEITEM = RowSpec("lineitem", ("l_returnflag", "l_linestatus"), (Field("l_linenumber", "int"), Field("l_quantity", "float")), at="l_shipdate")
SYMBOL_ONLY = RowSpec("events", ("event_type",), at="ts")
PRICE = RowSpec("orders", ("o_orderstatus",), (Field("price", "decimal"),), at="o_orderdate")
PRICE_TEXT = RowSpec("orders", ("o_orderstatus",), (Field("price", "decimal_text"),))
VECTOR = RowSpec("embeddings", (), (Field("label", "int"), Field("v", "array")))

# Pieces of SQL that several oracles share.
ESCAPED = r"regexp_replace({0}, '([ ,=\n\r\\])', '\\\1', 'g')"
QUOTED = r"regexp_replace({0}, '([\"\n\r\\])', '\\\1', 'g')"
NUMBER = r"regexp_replace(CAST({0} AS VARCHAR), '\.0$', '')"
EVENT_HEAD = "'events,event_type=' || " + ESCAPED.format("event_type")
EVENT_FIELDS = f"""' user_id=' || user_id || 'i,value=' || {NUMBER.format("value")} || ',props="' || {QUOTED.format("props")} || '"'"""
EVENT_LINE = f"{EVENT_HEAD} || {EVENT_FIELDS} || ' ' || (epoch_us(ts) * 1000) || chr(10)"


def registered(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _micros(df: DataFrame, column: str) -> F.Column:
    return times.epoch_micros(F.col(column), df.schema[column].dataType.simpleString())


# --- encoding ---


@registered(f"SELECT event_id, {EVENT_LINE} AS line FROM events")
def encode_v1_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read(spark, sf_dir, "events"), EVENTS).select("event_id", "line")


@registered(
    f"""SELECT l_orderkey, l_partkey, 'lineitem,l_returnflag=' || {ESCAPED.format("l_returnflag")} || ',l_linestatus='
    || {ESCAPED.format("l_linestatus")} || ' l_linenumber=' || l_linenumber || 'i,l_quantity=' || {NUMBER.format("l_quantity")}
    || ' ' || (epoch_us(l_shipdate) * 1000) || chr(10) AS line FROM lineitem"""
)
def encode_v1_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read(spark, sf_dir, "lineitem"), LINEITEM).select("l_orderkey", "l_partkey", "line")


@registered(f"SELECT event_id, {EVENT_HEAD} || {EVENT_FIELDS} || chr(10) AS line FROM events")
def encode_v1_atnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = RowSpec(EVENTS.table, EVENTS.symbols, EVENTS.fields)
    return encode(read(spark, sf_dir, "events"), spec).select("event_id", "line")


@registered(
    """SELECT doc_id, 'labels toxic=' || CASE WHEN toxic = 1 THEN 't' ELSE 'f' END || ',quality='
    || CASE WHEN quality = 1 THEN 't' ELSE 'f' END || chr(10) AS line FROM labels"""
)
def encode_bool_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("toxic"), (F.col("quality") == 1).alias("quality"))
    return encode(rows, RowSpec("labels", (), (Field("toxic", "boolean"), Field("quality", "boolean")))).select("doc_id", "line")


@registered(
    f"""SELECT event_id, {EVENT_HEAD} || CASE WHEN event_id % 3 = 0 THEN '' ELSE ' value=' || {NUMBER.format("value")} END
    || CASE WHEN event_id % 5 = 0 THEN '' ELSE CASE WHEN event_id % 3 = 0 THEN ' ' ELSE ',' END || 'user_id=' || user_id || 'i' END
    || chr(10) AS line FROM events"""
)
def encode_v1_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select(
        "event_id", "event_type", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"), F.when(F.col("event_id") % 5 != 0, F.col("user_id")).alias("user_id")
    )
    spec = RowSpec("events", ("event_type",), (Field("value", "float"), Field("user_id", "int")))
    return encode(rows, spec).select("event_id", "line")


@registered(f"SELECT event_id, {EVENT_HEAD} || ' ' || epoch_us(ts) || 't' || chr(10) AS line FROM events")
def ts_suffix_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode(read(spark, sf_dir, "events"), SYMBOL_ONLY, 2)
    return rows.select("event_id", F.decode("line", "UTF-8").alias("line"))


@registered(f"SELECT event_id, {EVENT_HEAD} || ' ' || (epoch_us(ts) * 1000 + event_id % 1000) || 'n' || chr(10) AS line FROM events")
def ts_suffix_v2_nanos(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events")
    rows = rows.withColumn("ns", _micros(rows, "ts") * 1000 + F.col("event_id") % 1000)
    rows = encode(rows, RowSpec("events", ("event_type",), at="ns", unit="ns"), 2)
    return rows.select("event_id", F.decode("line", "UTF-8").alias("line"))


@registered(
    f"""SELECT event_id, {EVENT_HEAD} || ' seen=' || epoch_us(ts) || 't,ms=' || (epoch_us(ts) // 1000 * 1000) || 't,ns='
    || epoch_us(ts) || 't,user_id=' || user_id || 'i' || chr(10) AS line FROM events"""
)
def ts_fields_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stamped(spark, sf_dir)
    return encode(rows, STAMPS).select("event_id", "line")


@registered(
    f"""SELECT event_id, {EVENT_HEAD} || ' seen=' || epoch_us(ts) || 't,ms=' || (epoch_us(ts) // 1000 * 1000) || 't,ns='
    || (epoch_us(ts) * 1000 + event_id % 1000) || 'n,user_id=' || user_id || 'i' || chr(10) AS line FROM events"""
)
def ts_fields_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode(_stamped(spark, sf_dir), STAMPS, 2)
    return rows.select("event_id", F.decode("line", "UTF-8").alias("line"))


STAMPS = RowSpec("events", ("event_type",), (Field("seen", "timestamp", "ts"), Field("ms", "timestamp", unit="ms"), Field("ns", "timestamp", unit="ns"), Field("user_id", "int")))


def _stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events")
    us = _micros(rows, "ts")
    return rows.select("event_id", "event_type", "user_id", "ts", times.whole_div(us, 1000).alias("ms"), (us * 1000 + F.col("event_id") % 1000).alias("ns"))


# --- scalar functions ---


@registered(f"SELECT doc_id, {ESCAPED.format('text')} AS escaped FROM documents")
def escape_symbol_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", text.escape(F.col("text")).alias("escaped"))


@registered(f"SELECT page_id, {QUOTED.format('html')} AS escaped FROM pages")
def escape_string_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", text.escape_quoted(F.col("html")).alias("escaped"))


@registered("SELECT doc_id, text FROM documents")
def unescape_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", text.unescape(text.escape(F.col("text"))).alias("text"))


@registered(f"SELECT l_orderkey, l_linenumber, {NUMBER.format('l_extendedprice')} AS number FROM lineitem")
def number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", text.js_number(F.col("l_extendedprice")).alias("number"))


@registered(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE '-' END || CASE o_orderkey % 3 WHEN 0 THEN k || '000000000000' WHEN 1 THEN '0.0000' || k
    ELSE k[1] || CASE WHEN rtrim(k[2:], '0') = '' THEN '' ELSE '.' || rtrim(k[2:], '0') END || 'e+' || (24 + length(k)) END AS number
    FROM (SELECT o_orderkey, CAST(o_custkey * 10 + 1 AS VARCHAR) AS k FROM orders)"""
)
def number_text_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large, small and very large numbers, of either sign."""
    k = F.concat((F.col("o_custkey") * 10 + 1).cast("string"), F.lit(""))
    told = F.when(F.col("o_orderkey") % 3 == 0, F.concat(k, F.lit("e12"))).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("0.0000"), k)).otherwise(F.concat(k, F.lit("e25")))
    value = told.cast("double") * F.when(F.col("o_orderkey") % 2 == 0, 1.0).otherwise(-1.0)
    return read(spark, sf_dir, "orders").select("o_orderkey", text.js_number(value).alias("number"))


@registered("SELECT event_id, epoch_us(ts) AS us FROM events")
def ts_to_micros(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events")
    return rows.select("event_id", times.to_micros(_micros(rows, "ts"), "us").alias("us"))


@registered("SELECT event_id, epoch_us(ts) * 1000 AS ns FROM events")
def ts_to_nanos(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events")
    return rows.select("event_id", times.to_nanos(_micros(rows, "ts"), "us").alias("ns"))


@registered("SELECT event_id, (epoch_us(ts) // 1000) * 1000 AS us, (epoch_us(ts) // 1000) * 1000000 AS ns FROM events")
def ts_ms_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events")
    ms = times.whole_div(_micros(rows, "ts"), 1000)
    return rows.select("event_id", times.to_micros(ms, "ms").alias("us"), times.to_nanos(ms, "ms").alias("ns"))


@registered("SELECT event_id, epoch_us(ts) AS us, -epoch_us(ts) AS negative FROM events")
def ts_ns_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events")
    ns = _micros(rows, "ts") * 1000 + F.col("event_id") % 1000
    return rows.select("event_id", times.to_micros(ns, "ns").alias("us"), times.to_micros(-ns, "ns").alias("negative"))


@registered("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso FROM events")
def ts_iso_micros(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events")
    return rows.select("event_id", times.iso_micros(_micros(rows, "ts")).alias("iso"))


@registered("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') || 'Z' AS iso FROM events")
def ts_iso_nanos(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events")
    return rows.select("event_id", times.iso_nanos(_micros(rows, "ts") * 1000 + F.col("event_id") % 1000).alias("iso"))


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, parts, docs = (read(spark, sf_dir, t) for t in ("pages", "part", "documents"))
    words = docs.select(F.substring_index("text", " ", 2).alias("name"))
    return pages.select(F.col("url").alias("name")).unionByName(parts.select(F.col("p_name").alias("name"))).unionByName(words).distinct()


NAMES = "(SELECT url AS name FROM pages UNION SELECT p_name FROM part UNION SELECT array_to_string(string_split(text, ' ')[1:2], ' ') FROM documents)"


@registered(
    rf"""SELECT name, length(name) BETWEEN 1 AND 127 AND NOT regexp_matches(name, '[?,''"\\/:)(+*%~\x00-\x0f\x7f\x{{feff}}]')
    AND NOT regexp_matches(name, '^\.|\.$|\.\.') AS ok FROM {NAMES}"""
)
def name_check_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).select("name", names.is_table_name(F.col("name")).alias("ok"))


@registered(rf"""SELECT name, length(name) BETWEEN 1 AND 127 AND NOT regexp_matches(name, '[?,''"\\/:)(+*%~.\-\x00-\x0f\x7f\x{{feff}}]') AS ok FROM {NAMES}""")
def name_check_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).select("name", names.is_column_name(F.col("name")).alias("ok"))


@registered(
    r"""SELECT o_orderkey, told, regexp_matches(told, '^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$|^[-+]?Infinity$|^NaN$') AS ok FROM (
    SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '.' || o_custkey WHEN 1 THEN o_orderstatus || o_custkey WHEN 2 THEN '-' || o_custkey || '.e3'
    WHEN 3 THEN o_custkey || '.1.2' ELSE '+' || o_custkey || 'E-2' END AS told FROM orders)"""
)
def decimal_text_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, kind = F.col("o_custkey").cast("string"), F.col("o_orderkey") % 5
    told = (
        F.when(kind == 0, F.concat(F.lit("."), key))
        .when(kind == 1, F.concat("o_orderstatus", key))
        .when(kind == 2, F.concat(F.lit("-"), key, F.lit(".e3")))
        .when(kind == 3, F.concat(key, F.lit(".1.2")))
        .otherwise(F.concat(F.lit("+"), key, F.lit("E-2")))
    )
    rows = read(spark, sf_dir, "orders").select("o_orderkey", told.alias("told"))
    return rows.withColumn("ok", names.is_decimal_text(F.col("told")))


# --- binary values ---


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))


@registered("SELECT o_orderkey, 'orders,o_orderstatus=' || o_orderstatus || ' price=' || CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) || 'd' || chr(10) AS line FROM orders")
def decimal_text_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(_orders(spark, sf_dir), PRICE_TEXT, 3).select("o_orderkey", F.decode("line", "UTF-8").alias("line"))


@registered(
    """SELECT c_custkey, 3 + CASE WHEN k BETWEEN -1 AND 127 THEN 1 WHEN k BETWEEN -256 AND 32767 THEN 2 WHEN k BETWEEN -65536 AND 8388607 THEN 3
    WHEN k BETWEEN -16777216 AND 2147483647 THEN 4 ELSE 5 END AS size
    FROM (SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(18, 2)) * 100 AS BIGINT) AS k FROM customer)"""
)
def decimal_bytes_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = binary.decimal_value(F.col("c_acctbal").cast("decimal(18,2)"))
    return read(spark, sf_dir, "customer").select("c_custkey", F.octet_length(value).alias("size"))


@registered("SELECT o_orderkey, 'orders' AS \"table\", o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS price, epoch_us(o_orderdate) * 1000 AS ns FROM orders")
def decimal_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = encode(_orders(spark, sf_dir), PRICE, 3).select("o_orderkey", "line")
    rows = decode_binary(lines, PRICE, {"price": T.DecimalType(18, 2)})
    return rows.select("o_orderkey", "table", "o_orderstatus", F.col("price").cast("string").alias("price"), F.col("o_orderdate").alias("ns"))


@registered("SELECT event_id, event_type, user_id, value, props, epoch_us(ts) * 1000 AS ns FROM events")
def float_v2_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = encode(read(spark, sf_dir, "events"), EVENTS, 2).select("event_id", "line")
    return decode_binary(lines, EVENTS).select("event_id", "event_type", "user_id", "value", "props", F.col("ts").alias("ns"))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return rows.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))


@registered("SELECT vec_id, label, i AS i, CAST(embedding[i + 1] AS DOUBLE) AS x FROM (SELECT *, unnest(range(len(embedding))) AS i FROM embeddings)")
def array_v2_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = encode(_vectors(spark, sf_dir), VECTOR, 2).select("vec_id", "line")
    rows = decode_binary(lines, VECTOR, {"v": T.ArrayType(T.DoubleType())})
    return rows.select("vec_id", F.col("label").cast("int").alias("label"), F.posexplode("v").alias("i", "x")).withColumn("i", F.col("i").cast("bigint"))


@registered("SELECT vec_id, i // 8 AS r, i % 8 AS c, CAST(embedding[i + 1] AS DOUBLE) AS x FROM (SELECT *, unnest(range(len(embedding))) AS i FROM embeddings)")
def array2d_v2_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _vectors(spark, sf_dir).withColumn("v", arrays.reshape(F.col("v"), 8, 8))
    lines = encode(rows, VECTOR, 2).select("vec_id", "line")
    rows = decode_binary(lines, VECTOR, {"v": T.ArrayType(T.ArrayType(T.DoubleType()))})
    rows = rows.select("vec_id", F.posexplode("v").alias("r", "row")).select("vec_id", "r", F.posexplode("row").alias("c", "x"))
    return rows.select("vec_id", F.col("r").cast("bigint").alias("r"), F.col("c").cast("bigint").alias("c"), "x")


@registered("SELECT vec_id, CAST(len(embedding) AS VARCHAR) AS one, '8,8' AS two, len(embedding) * 8 AS bytes, len(embedding) = 64 AS regular, len(embedding) AS leaves FROM embeddings")
def array_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, square = F.col("v"), F.col("square")
    rows = _vectors(spark, sf_dir).withColumn("square", arrays.reshape(v, 8, 8))
    shape = lambda c, n: F.array_join(arrays.dims(c, n).cast("array<string>"), ",")
    return rows.select(
        "vec_id",
        shape(v, 1).alias("one"),
        shape(square, 2).alias("two"),
        arrays.payload_size(square, 2).alias("bytes"),
        arrays.regular(square, 2).alias("regular"),
        F.size(arrays.flatten_all(square, 2)).cast("bigint").alias("leaves"),
    )


MIXED = RowSpec(
    "mixed", ("o_orderstatus",),
    (Field("name", "string"), Field("big", "boolean"), Field("o_custkey", "int"), Field("o_totalprice", "float"), Field("seen", "timestamp", "o_orderdate"), Field("price", "decimal"), Field("v", "array"), Field("m", "array")),
    at="ns", unit="ns",
)


@registered(
    """SELECT o_orderkey, o_orderstatus, o_orderpriority || '="' || chr(10) AS name, o_totalprice > 150000 AS big, o_custkey, o_totalprice, epoch_us(o_orderdate) AS seen,
    CASE WHEN o_orderkey % 7 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) END AS price,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN '' ELSE o_custkey || '.0,0.5' END AS v, o_custkey || '.0|' || (-1 - o_custkey) || '.0' AS m,
    epoch_us(o_orderdate) * 1000 AS ns FROM orders"""
)
def all_kinds_v3_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row of every kind: null, empty and filled arrays, null decimals, strings with marks."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey").cast("double")
    v = F.when(key % 3 == 1, F.array().cast("array<double>")).when(key % 3 == 2, F.array(cust, F.lit(0.5)))
    rows = _orders(spark, sf_dir).select(
        "o_orderkey", "o_orderstatus", F.concat("o_orderpriority", F.lit('="\n')).alias("name"), (F.col("o_totalprice") > 150000).alias("big"), "o_custkey", "o_totalprice", "o_orderdate",
        F.when(key % 7 != 0, F.col("price")).alias("price"), v.alias("v"), F.array(F.array(cust), F.array(-1 - cust)).alias("m"),
    )
    lines = encode(rows.withColumn("ns", _micros(rows, "o_orderdate") * 1000), MIXED, 3).select("o_orderkey", "line")
    doubles = T.ArrayType(T.DoubleType())
    back = decode_binary(lines, MIXED, {"price": T.DecimalType(18, 2), "v": doubles, "m": T.ArrayType(doubles)})
    listed = F.array_join(F.col("v").cast("array<string>"), ",")
    return back.select("o_orderkey", "o_orderstatus", "name", "big", "o_custkey", "o_totalprice", "seen", F.col("price").cast("string").alias("price"), listed.alias("v"), F.array_join(F.transform("m", lambda x: F.get(x, F.lit(0)).cast("string")), "|").alias("m"), "ns")


@registered(
    """SELECT vec_id, CASE WHEN vec_id % 4 = 0 THEN NULL ELSE vec_id % 4 <> 1 END AS regular, CASE vec_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '2,3' WHEN 2 THEN '2,0' ELSE '2,2' END AS shape,
    CASE vec_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 5 WHEN 2 THEN 0 ELSE 4 END AS leaves FROM embeddings"""
)
def ragged_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ragged, empty, regular and null arrays."""
    k, cut = F.col("vec_id") % 4, lambda n, at=1: F.slice("v", at, n)
    ragged = F.when(k == 1, F.array(cut(3), cut(2))).when(k == 2, F.array(cut(0), cut(0))).when(k == 3, F.array(cut(2), cut(2, 3)))
    rows = _vectors(spark, sf_dir).select("vec_id", "v").withColumn("r", ragged)
    r = F.col("r")
    told = lambda c: F.when(r.isNotNull(), c)
    return rows.select("vec_id", told(arrays.regular(r, 2)).alias("regular"), told(F.array_join(arrays.dims(r, 2).cast("array<string>"), ",")).alias("shape"), told(F.size(arrays.flatten_all(r, 2))).alias("leaves"))


# --- decoding, schemas, queries ---


@registered("SELECT event_id, 'events' AS \"table\", event_type, user_id, value, props, epoch_us(ts) * 1000 AS ns FROM events")
def v1_decode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = encode(read(spark, sf_dir, "events"), EVENTS).select("event_id", "line")
    rows = decode_text(lines, EVENTS)
    return rows.select("event_id", "table", "event_type", "user_id", "value", "props", F.col("ts").alias("ns"))


@registered("SELECT doc_id, lang, text FROM documents")
def v1_decode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = RowSpec("documents", ("lang",), (Field("text", "string"),))
    lines = encode(read(spark, sf_dir, "documents"), spec).select("doc_id", "line")
    return decode_text(lines, spec).select("doc_id", "lang", "text")


@registered("SELECT event_id, event_type, value, NULL AS user_id, NULL AS props FROM events WHERE event_id % 2 = 0 UNION ALL SELECT event_id, event_type, value, user_id, props FROM events WHERE event_id % 2 = 1")
def schema_merge_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events")
    early = rows.filter("event_id % 2 = 0").select("event_id", "event_type", "value")
    late = rows.filter("event_id % 2 = 1").select("event_id", "event_type", "value", "user_id", "props")
    return schema.merge(early, late)


@registered("SELECT 'nation' AS table_name, count(*) AS rows FROM nation UNION ALL SELECT 'region', count(*) FROM region")
def tables_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    for t in ("nation", "region", "supplier"):
        read(spark, sf_dir, t).createOrReplaceTempView(f"lineflow_{t}")
    found = schema.tables(spark, ["lineflow_nation", "lineflow_region", "lineflow_supplier"], "table_name <> 'lineflow_supplier'")
    return found.select(F.replace("table_name", F.lit("lineflow_"), F.lit("")).alias("table_name"), "rows")


@registered("SELECT * FROM supplier")
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    read(spark, sf_dir, "supplier").createOrReplaceTempView("lineflow_scan")
    return query(spark, "lineflow_scan")


@registered("SELECT * FROM events ORDER BY value, event_id")
def order_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    read(spark, sf_dir, "events").createOrReplaceTempView("lineflow_order")
    return query(spark, "lineflow_order order by value, event_id")


@registered("SELECT event_id, value FROM events ORDER BY ts, event_id")
def project_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(read(spark, sf_dir, "events"), ["event_id", "value"], "ts", ["event_id"])


@registered("SELECT event_type, count(*) AS n FROM events GROUP BY ALL")
def worker_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))


# --- batches and delivery ---


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events")
    return encode(rows, EVENTS).select("event_id", "event_type", _micros(rows, "ts").alias("us"), "line")


@registered(
    """SELECT event_type, batch, count(*) AS rows FROM (SELECT event_type, (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) // 600 AS batch FROM events)
    GROUP BY ALL"""
)
def batch_by_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("event_type", "ts", "event_id")
    return batch.summary(batch.by_rows(rows, ["ts", "event_id"], 600, ["event_type"]), ["event_type"])


@registered(
    """WITH RECURSIVE e AS (SELECT event_type, epoch_us(ts) AS us, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS k FROM events),
    s(event_type, k, batch, nxt, pending, last) AS (
        SELECT event_type, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), min(us) FROM e GROUP BY event_type
        UNION ALL
        SELECT e.event_type, e.k, s.nxt, s.nxt + CASE WHEN s.pending + 1 >= 20 OR e.us - s.last >= 21600000000 THEN 1 ELSE 0 END,
               CASE WHEN s.pending + 1 >= 20 OR e.us - s.last >= 21600000000 THEN 0 ELSE s.pending + 1 END,
               CASE WHEN s.pending + 1 >= 20 OR e.us - s.last >= 21600000000 THEN e.us ELSE s.last END
        FROM s JOIN e ON e.event_type = s.event_type AND e.k = s.k + 1)
    SELECT event_type, batch, count(*) AS rows FROM s WHERE k > 0 GROUP BY ALL"""
)
def batch_by_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events")
    rows = rows.select("event_type", _micros(rows, "ts").alias("us"), "event_id")
    found = batch.by_interval(rows, "us", ["us", "event_id"], 20, 6 * 3600 * 1_000_000, ["event_type"])
    return batch.summary(found, ["event_type"])


BYTES = f"""SELECT event_id, event_type, CAST(sum(octet_length(encode(line))) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS bytes
    FROM (SELECT *, {EVENT_LINE} AS line FROM events)"""


@registered(f"SELECT *, (bytes - 1) // 65536 AS batch FROM ({BYTES.replace('SELECT event_id, event_type,', 'SELECT event_id, event_type, line,', 1)})")
def batch_bytes_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.by_bytes(_lines(spark, sf_dir).select("event_id", "event_type", "us", "line"), ["us", "event_id"], 65536, ["event_type"]).drop("us")


@registered("SELECT *, (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) // 600 AS batch FROM events")
def batch_by_rows_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.by_rows(read(spark, sf_dir, "events"), ["ts", "event_id"], 600, ["event_type"])


@registered(f"SELECT event_id, bytes, (bytes - 1) // 65536 AS batch FROM ({BYTES})")
def batch_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.by_bytes(_lines(spark, sf_dir), ["us", "event_id"], 65536, ["event_type"]).select("event_id", "bytes", "batch")


@registered(f"SELECT event_type, (bytes - 1) // 65536 AS batch, count(*) AS rows, round(max(bytes) / 102400 * 1000 + 10000, 3) AS timeout_ms FROM ({BYTES}) GROUP BY ALL")
def request_timeout_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = batch.by_bytes(_lines(spark, sf_dir), ["us", "event_id"], 65536, ["event_type"])
    return batch.summary(rows, ["event_type"], F.round(delivery.request_timeout_ms(F.max("bytes")), 3).alias("timeout_ms"))


@registered("SELECT s_suppkey, k AS attempt, CAST(least(10 * 2 ** k, 1000) AS BIGINT) AS wait_ms FROM (SELECT s_suppkey, unnest(range(10)) AS k FROM supplier)")
def retry_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = delivery.retry_schedule(read(spark, sf_dir, "supplier").select("s_suppkey"), 10)
    return rows.withColumn("attempt", F.col("attempt").cast("bigint"))


@registered("SELECT event_id, 200 + event_id % 400 AS status, 200 + event_id % 400 IN (500, 503, 504, 507, 509, 523, 524, 529, 599) AS again FROM events")
def status_retryable(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 400 + 200).alias("status"))
    return rows.withColumn("again", delivery.is_retryable(F.col("status")))


@registered("SELECT event_type, CAST(64 * greatest(ceil(total / 64), 1) AS BIGINT) AS capacity FROM (SELECT event_type, count(*) * 8 AS total FROM events GROUP BY ALL)")
def buffer_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").groupBy("event_type").agg((F.count("*") * 8).alias("total"))
    return rows.select("event_type", delivery.capacity_needed(F.col("total"), 64).alias("capacity"))


@registered(
    """SELECT s_suppkey, unnest(['addr', 'username', 'auto_flush_rows']) AS key, unnest(['host' || s_suppkey || ':9000', s_name || ';' || s_nationkey, CAST(s_nationkey AS VARCHAR)]) AS value
    FROM supplier"""
)
def config_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    conf = F.concat(F.lit("http::addr=host"), "s_suppkey", F.lit(":9000;username="), "s_name", F.lit(";;"), "s_nationkey", F.lit(";auto_flush_rows="), "s_nationkey", F.lit(";"))
    return read(spark, sf_dir, "supplier").select("s_suppkey", F.explode(config_pairs(conf)).alias("key", "value"))
