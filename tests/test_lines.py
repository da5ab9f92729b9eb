"""Golden lines, rejected declarations, and round trips."""

from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineflow import Field, RowSpec, SpecError, decode_binary, decode_text, encode
from lineflow.functions import binary, names, text
from lineflow.operators.decode import parse


def lines(df, spec, version=1):
    return [r.line if version == 1 else bytes(r.line) for r in encode(df, spec, version).select("line").collect()]


def test_golden_text(spark):
    df = spark.createDataFrame([("us", 17.1, 1658484765000000000)], "location string, temperature double, ts long")
    spec = RowSpec("test", ("location",), (Field("temperature", "float"),), at="ts", unit="ns")
    assert lines(df, RowSpec("test", ("location",), (Field("temperature", "float"),), at="ts", unit="ns")) == ["test,location=us temperature=17.1 1658484765000000000\n"]
    assert lines(df.drop("ts"), RowSpec("t", (), (Field("temperature", "float"),))) == ["t temperature=17.1\n"]
    assert spec.table == "test"


@pytest.mark.parametrize(
    "version, unit, value, want",
    [
        (1, "ms", 1658484769000, b"1658484769000000000"),
        (2, "ms", 1658484769000, b"1658484769000000t"),
        (2, "ns", 1658484769000000, b"1658484769000000n"),
        (1, "ns", 1658484769000000123, b"1658484769000000123"),
    ],
)
def test_designated_timestamp(spark, version, unit, value, want):
    df = spark.createDataFrame([(42, value)], "c1 long, ts long")
    got = lines(df, RowSpec("tableName", (), (Field("c1", "int"),), at="ts", unit=unit), version)[0]
    got = got.encode() if isinstance(got, str) else got
    assert got == b"tableName c1=42i " + want + b"\n"


@pytest.mark.parametrize("version, unit, value, want", [(1, "ms", 1658484765123, "1658484765123000t"), (1, "ns", 1658484765123456789, "1658484765123456t"), (2, "ns", 1658484765123456789, "1658484765123456789n")])
def test_timestamp_field(spark, version, unit, value, want):
    got = lines(spark.createDataFrame([(value,)], "ts long"), RowSpec("t", (), (Field("ts", "timestamp", unit=unit),)), version)[0]
    assert (got if isinstance(got, str) else got.decode()) == f"t ts={want}\n"


def test_binary_goldens(spark):
    df = spark.createDataFrame([(123.456, [12.3, 23.4], [[12.3], [23.4]], [], None)], "f double, a array<double>, b array<array<double>>, c array<double>, d array<double>")
    spec = RowSpec("t", (), (Field("f", "float"), *(Field(x, "array") for x in "abcd")))
    two = bytes.fromhex("9a9999999999284066666666666637 40".replace(" ", ""))
    assert lines(df, spec, 2)[0] == (
        b"t f==" + bytes.fromhex("1077be9f1a2fdd5e40") + b",a==" + bytes.fromhex("0e0a0102000000") + two
        + b",b==" + bytes.fromhex("0e0a020200000001000000") + two + b",c==" + bytes.fromhex("0e0a0100000000") + b",d==" + bytes.fromhex("0e21") + b"\n"
    )


@pytest.mark.parametrize("value, scale, want", [(12345, 2, "1702023039"), (1234500, 6, "17060312d644"), (255, 1, "17010200ff"), (-10, 2, "170202fff6"), (None, 0, "170000")])
def test_decimal_goldens(value, scale, want):
    assert binary.decimal_bytes(value, scale).hex() == want


@pytest.mark.parametrize("value, want", [(0, "00"), (1, "01"), (123456, "01e240"), (255, "00ff"), (-1, "ff"), (-10, "fff6"), (-256, "ff00")])
def test_twos_complement(value, want):
    assert binary.twos_complement(value).hex() == want


def test_decimal_limits():
    for scale in (-1, 77):
        with pytest.raises(ValueError):
            binary.decimal_bytes(1, scale)
    binary.decimal_bytes(2**255 - 1, 0)
    binary.decimal_bytes(-(2**248), 0)
    for value in (2**255, -(2**248) - 1):
        with pytest.raises(ValueError):
            binary.decimal_bytes(value, 0)


def test_empty_arrays_of_three_levels(spark):
    kind = T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))
    df = spark.createDataFrame([([[[], []], [[], []], [[], []]],)], T.StructType([T.StructField("a", kind)]))
    assert lines(df, RowSpec("t", (), (Field("a", "array"),)), 2)[0] == b"t a==" + bytes.fromhex("0e0a03030000000200000000000000") + b"\n"


def test_decimal_texts(spark):
    df = spark.createDataFrame([("1.234500", -42.0, float("nan"))], "a string, b double, c double")
    spec = RowSpec("fx", (), tuple(Field(x, "decimal_text") for x in "abc"))
    assert lines(df, spec, 3) == [b"fx a=1.234500d,b=-42d,c=NaNd\n"]


def test_rejected_values(spark):
    ragged = spark.createDataFrame([([[1.0], [1.0, 2.0]],)], "a array<array<double>>")
    with pytest.raises(Exception, match="sub-arrays"):
        lines(ragged, RowSpec("t", (), (Field("a", "array"),)), 2)
    with pytest.raises(Exception, match="neither tags nor fields"):
        lines(spark.createDataFrame([(None,)], "x long"), RowSpec("t", (), (Field("x", "int"),)))
    with pytest.raises(Exception, match="not a decimal"):
        lines(spark.createDataFrame([("1.2.3",)], "x string"), RowSpec("t", (), (Field("x", "decimal_text"),)), 3)
    assert encode(spark.createDataFrame([(None,)], "x long"), RowSpec("t", (), (Field("x", "int"),)), strict=False).first().line is None


def test_rejected_declarations(spark):
    df = spark.createDataFrame([(1.5, [1.0], ["x"], Decimal("1.0"))], "f double, a array<double>, s array<string>, d decimal(9,2)")
    for version, field in ((1, Field("a", "array")), (2, Field("s", "array")), (2, Field("f", "array")), (1, Field("d", "decimal")), (2, Field("d", "decimal")), (1, Field("f", "int")), (1, Field("zz", "int")), (1, Field("f", "string"))):
        with pytest.raises(SpecError):
            lines(df, RowSpec("t", (), (field,)), version)
    for bad in (lambda: RowSpec("", ("a",)), lambda: RowSpec("t"), lambda: RowSpec("t", ("a", "a")), lambda: RowSpec("t", ("a.b",)), lambda: RowSpec("x" * 128, ("a",)), lambda: RowSpec("t", (), (Field("f", "float", unit="foobar"),))):
        with pytest.raises(ValueError):
            bad()


NAMES = ["a", "a b", "a=b", "a.b", ".a", "a.", "a..b", "", "x" * 127, "x" * 128, "a\n", "\x10", "\x0f", "﻿a", "a-b", "a,b", "é😀", "a\x7f"]


def test_names_agree(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    for check, column in ((names.check_table_name, names.is_table_name), (names.check_column_name, names.is_column_name)):
        got = {r.n: r.ok for r in df.select("n", column(F.col("n")).alias("ok")).collect()}
        for n in NAMES:
            try:
                want = bool(check(n))
            except ValueError:
                want = False
            assert got[n] == want, n


def test_number_text(spark):
    cases = {17.0: "17", 1234567890.0: "1234567890", 0.00044: "0.00044", 1e21: "1e+21", 1.5e-7: "1.5e-7", 0.0: "0", -0.0: "0", 1e-6: "0.000001", -12345678.25: "-12345678.25", 123456789012345680000.0: "123456789012345680000", float("nan"): "NaN", float("inf"): "Infinity", 2.5e25: "2.5e+25"}
    rows = spark.createDataFrame([(k, v) for k, v in cases.items()], "x double, want string")
    for r in rows.select("want", text.js_number(F.col("x")).alias("got")).collect():
        assert r.got == r.want


def test_round_trips(spark):
    rows = [("a b", "x\\y \"q\",\n=", True, 5, 1.5, 1000), ("=,\\", "", None, -1, -0.25, 7), ("é", None, False, None, None, None)]
    df = spark.createDataFrame(rows, "sy string, st string, bo boolean, it long, fl double, ts long")
    spec = RowSpec("my table", ("sy",), (Field("st", "string"), Field("bo", "boolean"), Field("it", "int"), Field("fl", "float")), at="ts")
    names_ = ("sy", "st", "bo", "it", "fl")
    want = sorted((tuple(r[:5]) for r in rows), key=repr)
    back = decode_text(encode(df, spec).select("line"), spec)
    assert sorted((tuple(r[n] for n in names_) for r in back.collect()), key=repr) == want
    for version in (2, 3):
        back = decode_binary(encode(df, spec, version).select("line"), spec)
        assert sorted((tuple(r[n] for n in names_) for r in back.collect()), key=repr) == want
        assert {r.table for r in back.collect()} == {"my table"}


@settings(max_examples=60, deadline=None)
@given(st.floats(allow_nan=False), st.lists(st.floats(allow_nan=False, width=64), max_size=4), st.integers(-(2**248), 2**255 - 1), st.integers(0, 76))
def test_parser_finds_line_ends_in_binary(x, v, unscaled, scale):
    import numpy as np

    line = b"t,a=b f==\x10" + np.array([x], "<f8").tobytes() + b",v==" + binary.array_bytes(np.array(v), [len(v)]) + b",d==" + binary.decimal_bytes(unscaled, scale) + b" 10n\n"
    found = list(parse(line * 2))
    assert len(found) == 2
    table, tags, fields, at = found[1]
    assert (table, tags, at) == ("t", {"a": "b"}, "10n")
    assert fields["f"] == x and fields["v"][1].tolist() == v and fields["d"] == Decimal(unscaled).scaleb(-scale, binary._wide())


def test_time_zone_does_not_matter(spark):
    df = spark.createDataFrame([(1, datetime(2024, 3, 10, 2, 30))], T.StructType([T.StructField("a", T.LongType()), T.StructField("ts", T.TimestampNTZType())]))
    assert lines(df, RowSpec("t", (), (Field("a", "int"),), at="ts")) == ["t a=1i 1710037800000000000\n"]


def test_decode_odd_lines_and_names(spark):
    spec = RowSpec("t", ("s",), (Field("v", "string"), Field("x", "int")))
    told = [
        ('t,s=a\\ b v="q\\"\\\\,=\n",x=3i 17\n', "a b", 'q"\\,=\n', 3),
        ('t v="",x=1i,x=2i\n', None, "", 1),
        ("t,s= x=-5i", "", None, -5),
        ('t,s=a v="open\n', None, None, None),  # no whole line
        ("", None, None, None),
        (None, None, None, None),
    ]
    rows = spark.createDataFrame([(line, k, -k) for k, (line, *_) in enumerate(told)], "line string, _body long, `a.b` long")
    found = decode_text(rows, spec).orderBy("_body").collect()
    assert [tuple(r[c] for c in ("s", "v", "x")) for r in found] == [t[1:] for t in told]
    assert [(r["_body"], r["a.b"]) for r in found] == [(k, -k) for k in range(len(told))]
