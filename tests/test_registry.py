"""Every registered query against its SQL at the smallest scale."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_queries import TABLES, _rows

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    # Those of the corpus subpackage have tests of their own, and go with it.
    plain = {q for q in set(QUERIES) - set(ORACLES) if not re.match(r"op\d+_|pipeline$", q)}
    assert plain == {"value_stats_approx", "train_compare"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, sf, name):
    frame = QUERIES[name](spark, sf)
    answer = db.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    assert _rows(frame.columns, [tuple(r) for r in frame.collect()]) == _rows(columns, answer.fetchall())


def test_approximate_quartiles_are_close(spark, sf):
    exact = {r["cancer_type"]: r for r in QUERIES["value_stats"](spark, sf).collect()}
    for r in QUERIES["value_stats_approx"](spark, sf).collect():
        for q in ("q1_log2_tpm", "mediana_log2_tpm", "q3_log2_tpm"):
            assert math.isclose(r[q], exact[r["cancer_type"]][q], abs_tol=0.05)


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() == 5 and frame.columns[0] == "cancer_type"


def test_score_new_covers_all_documents(spark, sf):
    scored = QUERIES["score_new"](spark, sf)
    assert scored.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
