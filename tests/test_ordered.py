import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from assaylake.operators.ordered import _place_by_sample, exact_quantiles, running_totals


def frame(spark, n, seed, hot=0.6):
    """Half the rows in one group and many equal values."""
    rnd = random.Random(seed)
    data = [("hot" if rnd.random() < hot else f"k{rnd.randrange(3)}", round(rnd.gauss(0, 2), 1)) for _ in range(n)]
    return data, spark.createDataFrame(data, "k string, v double")


def brute(data, descending):
    out = {}
    groups = defaultdict(lambda: defaultdict(int))
    for k, v in data:
        groups[k][v] += 1
    for k, values in groups.items():
        total = 0
        for v in sorted(values, reverse=descending):
            total += values[v]
            out[(k, v)] = (total, sum(values.values()))
    return out


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("buckets, parts", [(1, 3), (4, 2), (64, 7)])
def test_running_totals(spark, descending, buckets, parts):
    data, df = frame(spark, 600, 1)
    counted = df.repartition(parts).groupBy("k", "v").agg(F.count("*").alias("n"))
    got = running_totals(counted, ["k"], ["v"], ["n"], descending, buckets=buckets).collect()
    assert {(r["k"], r["v"]): (r["cum_n"], r["all_n"]) for r in got} == brute(data, descending)


def test_hot_group_is_cut_into_buckets(spark):
    _, df = frame(spark, 3000, 2, hot=0.95)
    spread = F.col("v") + F.xxhash64(F.monotonically_increasing_id()) / 2.0**63
    counted = df.coalesce(1).withColumn("v", spread).groupBy("k", "v").agg(F.count("*").alias("n"))
    sizes = [r[0] for r in _place_by_sample(counted, ["k"], "v", ["n"], 32, True).filter("k = 'hot'").groupBy("_bucket").count().select("count").collect()]
    assert len(sizes) == 32 and max(sizes) < 0.25 * sum(sizes)


def test_given_bucket_and_several_sums(spark):
    df = spark.createDataFrame([("a", i, 1, i % 2) for i in range(20)], "k string, v int, p int, q int")
    got = running_totals(df, ["k"], ["v"], ["p", "q"], bucket=F.floor(F.col("v") / 6)).orderBy("v").collect()
    assert [r["cum_p"] for r in got] == list(range(1, 21))
    assert [r["cum_q"] for r in got] == [(i + 1) // 2 for i in range(20)]
    assert got[0]["all_p"] == 20 and got[0]["all_q"] == 10


@pytest.mark.parametrize("seed", range(3))
def test_exact_quantiles(spark, seed):
    data, df = frame(spark, 401, seed)
    asked = {"lo": 0.25, "mid": 0.5, "hi": 0.75, "top": 1.0}
    with_null = df.union(spark.createDataFrame([("hot", None)], "k string, v double"))
    for r in exact_quantiles(with_null, ["k"], "v", asked, buckets=8).collect():
        values = sorted(v for k, v in data if k == r["k"])
        for name, q in asked.items():
            want = next(v for i, v in enumerate(values, 1) if i >= q * len(values))
            assert r[name] == want


def test_many_groups_need_no_broadcast(spark):
    data = [(f"g{i % 90}", float(i * 7919 % 101)) for i in range(1500)]
    df = spark.createDataFrame(data, "k string, v double")
    counted = df.groupBy("k", "v").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = running_totals(counted, ["k"], ["v"], ["n"], buckets=4, few_groups=False)
        assert {(r["k"], r["v"]): (r["cum_n"], r["all_n"]) for r in ranked.collect()} == brute(data, False)
        assert "Broadcast" not in ranked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_group(spark):
    df = spark.createDataFrame([(None, 1.0, 2), (None, 2.0, 3), ("a", 1.0, 1)], "k string, v double, n bigint")
    got = {(r["k"], r["v"]): (r["cum_n"], r["all_n"]) for r in running_totals(df, ["k"], ["v"], ["n"]).collect()}
    assert got == {(None, 1.0): (2, 5), (None, 2.0): (5, 5), ("a", 1.0): (1, 1)}
