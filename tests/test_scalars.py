import math

import pytest
from pyspark.sql import functions as F

from assaylake import domain
from assaylake import functions as fn


def one(spark, column, **values):
    types = {bool: "boolean", int: "bigint", float: "double", str: "string"}
    schema = ", ".join(f"{k} {types.get(type(v), 'string')}" for k, v in values.items()) or "x int"
    frame = spark.createDataFrame([tuple(values.values()) or (1,)], schema)
    return frame.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize("given, want", [("ENSG01.12", "ENSG01"), ("ENSG01", "ENSG01"), ("a.b.c", "a"), (None, None)])
def test_base_id(spark, given, want):
    assert one(spark, fn.base_id("c"), c=given) == want


def test_log_of_null_measure_is_zero(spark):
    assert one(spark, fn.log2p1(fn.null_to_zero(F.lit(None).cast("double")))) == 0.0
    assert one(spark, fn.log2p1("c"), c=7.0) == pytest.approx(3.0)


@pytest.mark.parametrize(
    "path, want",
    [
        ("/raw/0a1b2c3d-0000-1111-2222-abcdefABCDEF/x.tsv", "0a1b2c3d-0000-1111-2222-abcdefABCDEF"),
        ("/raw/no-id-here/x.tsv", ""),
    ],
)
def test_file_id(spark, path, want):
    assert one(spark, fn.file_id_of("c"), c=path) == want


def test_subject_id_takes_the_first_known(spark):
    assert one(spark, fn.subject_id("a", "b", "c"), a="case", b="XX-12-3456-01A", c="s") == "case"
    assert one(spark, fn.subject_id("a", "b", "c"), a=None, b="XX-12-345678-01A", c="s") == "XX-12-345678"
    assert one(spark, fn.subject_id("a", "b", "c"), a=None, b=None, c="s") == "s"


def test_class_lookup_defaults(spark):
    projects = domain.study_projects("PRJ-")
    assert len(projects) == 18
    code, name = fn.class_lookup("p", projects)
    assert one(spark, code, p="PRJ-OV") == "OV"
    assert one(spark, name, p="PRJ-OV") == domain.CLASS_NAMES["OV"]
    assert one(spark, code, p="OTHER-OV") == domain.UNKNOWN
    assert one(spark, name, p=None) == domain.UNKNOWN
    empty, _ = fn.class_lookup("p", {})
    assert one(spark, empty, p="x") == domain.UNKNOWN


@pytest.mark.parametrize(
    "text, want",
    [("1.5", 1.5), (" 12 ", 12.0), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0), ("-inf", -math.inf), ("1d", None),
     ("0x1p3", None), ("n/a", None), ("", None), ("NaN", None), (None, None)],
)
def test_to_number(spark, text, want):
    assert one(spark, fn.to_number("c"), c=text) == want


def test_decode_outside_the_labels(spark):
    assert one(spark, fn.decode_label("i", ["a", "b"]), i=1) == "b"
    assert one(spark, fn.decode_label("i", ["a", "b"]), i=2) == domain.UNKNOWN
    assert one(spark, fn.element(F.array(F.lit(0.1), F.lit(0.9)), "i"), i=5) is None


@pytest.mark.parametrize("share, want", [(0.7, "train"), (0.71, "validation"), (0.85, "validation"), (0.86, "test"), (1.0, "test")])
def test_split_label(spark, share, want):
    assert one(spark, fn.split_label(F.col("c")), c=share) == want


def test_rounded_is_what_sql_rounds_to(spark):
    import duckdb

    values = [409 / 4000, -409 / 4000, 0.10225, 1.005, 0.12345, 2.5, 0.00005, 1 / 3, 0.0, None]
    values += [k / 20_000 for k in range(1, 20_000, 2)]  # halves at four decimals
    frame = spark.createDataFrame([(v,) for v in values], "x double").select("x", fn.rounded("x", 4).alias("y"))
    sql = duckdb.connect()
    sql.execute("CREATE TABLE t (x DOUBLE)")
    sql.executemany("INSERT INTO t VALUES (?)", [[v] for v in values[:10]])
    sql.execute("INSERT INTO t SELECT k / 2e4 FROM range(1, 20000, 2) r(k)")
    got, expected = frame.collect(), dict(sql.execute("SELECT DISTINCT x, round(x, 4) FROM t").fetchall())
    assert [r["y"] for r in got] == [expected[r["x"]] for r in got]
    assert {r["x"]: r["y"] for r in got}[409 / 4000] == 0.1022


def test_characters_are_counted_in_one_pass(spark, sf):
    from collections import Counter

    from assaylake import bind

    texts = ["", "a", "banana 🍌🍌", "été ŒŒ\n\t", None, "\u0000x" * 3]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r["id"]: r["c"] for r in frame.select("id", fn.character_counts("text").alias("c")).collect()}
    for at, text in enumerate(texts):
        assert got[at] is None if text is None else {x["letter"]: x["n"] for x in got[at]} == Counter(text)
    # A pass over the text for each of its letters made most of the work of the training queries.
    plan = bind.document_values(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "replace(" not in plan and "split(" not in plan
