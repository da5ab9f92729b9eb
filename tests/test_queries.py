"""Every registered core query against its SQL."""

import duckdb
import pytest

from conftest import DATA
from lineflow.plans.registry import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(rows):
    return sorted(repr(tuple(r)) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    assert plain(got.select(*columns).collect()) == plain(cursor.fetchall())


def test_text_encoding_is_one_native_projection(spark):
    plan = QUERIES["encode_v1_events"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert "o_comment" not in plan


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1000
