"""Every registered query against its SQL counterpart."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry_point
from conftest import SF_DIR
from tidemark.operators import stats

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
conversations""".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def sorted_rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("nan" if isinstance(r[i], float) and math.isnan(r[i]) else repr(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    frame = entry_point.queries()[name](spark, SF_DIR)
    wanted = duck.execute(entry_point.oracle_sql()[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(frame.columns) == sorted(columns)
    assert sorted_rows(frame.columns, [tuple(r) for r in frame.collect()]) == sorted_rows(columns, wanted.fetchall())


def test_every_query_has_sql():
    optional = {n for n in entry_point.queries() if re.match(r"op\d+_|pipeline$", n)}
    assert set(entry_point.queries()) - set(entry_point.oracle_sql()) - optional == set()


def test_sketched_statistics_are_close_to_exact_ones(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = {r["column"]: r for r in stats.column_stats_approx(orders).collect()}
    exact = orders.select("o_orderkey").distinct().count()
    assert rows["o_orderkey"]["row_count"] == orders.count() and rows["o_orderkey"]["null_count"] == 0
    assert abs(rows["o_orderkey"]["unique_count"] - exact) < 0.2 * exact
    assert rows["o_orderstatus"]["unique_count"] == 3 and rows["o_orderstatus"]["max_length"] == 1


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert frame.count() == 6 and frame.columns == ["l_returnflag", "l_linestatus", "n", "quantity", "cents"]
