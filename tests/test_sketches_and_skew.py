"""Sketches within their bounds, and joins whose hot keys are spread."""

import random

import pytest
from pyspark.sql import functions as F

from lakemill.operators import sketches
from lakemill.operators.skew import frequent_keys, salted_join


@pytest.mark.parametrize("n", [1, 300, 40_000])
def test_united_sketches_stay_within_their_bounds(spark, n):
    t = spark.range(3 * n).select((F.col("id") % 3).cast("int").alias("load"), F.lit("a").alias("k"), (F.xxhash64(F.col("id") % n) % 1_000_003).alias("v"), F.when(F.col("id") % 2 == 0, F.col("id").cast("double")).alias("w"))
    stored = sketches.sketched(t, ["load", "k"], {"d": F.col("v")}, {"q": F.col("w")})
    one = sketches.united(stored, ["k"], ["d"], ["q"])
    exact = t.agg(F.count_distinct("v")).first()[0]
    found = one.select(sketches.distinct_count("d").alias("d"), *[sketches.quantile("q", s).alias(str(s)) for s in (0.1, 0.5, 0.99)]).first()
    assert abs(found["d"] - exact) <= sketches.distinct_error() * exact
    values = [float(i) for i in range(0, 3 * n, 2)]
    for share in (0.1, 0.5, 0.99):
        below, upto = (sum(x < found[str(share)] for x in values) / len(values), sum(x <= found[str(share)] for x in values) / len(values))
        assert below - sketches.rank_error() <= share <= upto + sketches.rank_error()


def test_sketches_of_nulls_and_of_nothing(spark):
    t = spark.createDataFrame([("a", None, None), ("a", None, None), ("b", 1, 2.0)], "k string, v int, w double")
    made = sketches.sketched(t, ["k"], {"d": F.col("v")}, {"q": F.col("w")})
    one = sketches.united(made.union(made), ["k"], ["d"], ["q"])
    assert sorted(one.select("k", sketches.distinct_count("d"), sketches.quantile("q", 0.5)).collect()) == [("a", 0, None), ("b", 1, 2.0)]
    assert sketches.united(made.limit(0), ["k"], ["d"], ["q"]).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_joins_equal_plain_ones(spark, how):
    rng = random.Random(4)
    left = spark.createDataFrame([(rng.choice([None, 1, 1, 1, 1, 2, rng.randint(3, 40)]), i % 50, {"m": i}) for i in range(600)], "k int, v int, m map<string,int>")
    right = spark.createDataFrame([(rng.choice([None, 1, 1, rng.randint(1, 30)]), f"r{i}") for i in range(60)], "rk int, w string")
    found = salted_join(left, right, "k", "rk", how, task_rows=40)
    wanted = left.join(right, left.k == right.rk, how)
    assert found.columns == wanted.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect()))
    assert salted_join(left.limit(0), right, "k", "rk", how).count() == 0


def test_a_salted_join_refuses_what_it_cannot_spread(spark):
    a, b = spark.range(3).toDF("k"), spark.range(3).toDF("rk")
    with pytest.raises(ValueError, match="can't be"):
        salted_join(a, b, "k", "rk", "full_outer")
    with pytest.raises(ValueError, match="both sides"):
        salted_join(a, a, "k", "k")


def test_the_largest_task_is_near_the_median(spark):
    """A third of the rows have one key and a sixth have none; the join's tasks are even."""
    lines = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 6 == 1, F.lit(None)).otherwise(F.col("id") % 2000).cast("long").alias("k"), "id")
    parts = spark.range(2000).toDF("p")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {c: spark.conf.get(c, None) for c in settings}
    try:
        for c, v in settings.items():
            spark.conf.set(c, v)
        assert [tuple(r) for r in frequent_keys(lines, "k", 500).collect()] == [(7, 41)]
        sizes = {}
        for name, found in (("salted", salted_join(lines, parts, "k", "p", "left", task_rows=500)), ("plain", lines.join(parts, lines.k == parts.p, "left"))):
            sizes[name] = sorted(r[1] for r in found.groupBy(F.spark_partition_id()).count().collect())
    finally:
        for c, v in before.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
    assert sizes["salted"][-1] <= 2 * sizes["salted"][len(sizes["salted"]) // 2] < sizes["plain"][-1]
    assert sum(sizes["salted"]) == sum(sizes["plain"]) == 60_000


def test_the_frequent_keys_are_sent_to_the_tasks(spark):
    """Before a row has its salt, no join may deal the rows by the bare key: a frequent one would be one task's."""
    found = salted_join(spark.range(100).select((F.col("id") % 3).alias("k"), "id"), spark.range(9).toDF("p"), "k", "p", "left", task_rows=10)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 2
