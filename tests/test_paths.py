"""Paths against a plain state machine."""

import datetime
import random

import pytest

from lakemill.operators import paths

SHAPE = "k int, at timestamp, id int, kind string, bucket string"


def made(seed):
    rng = random.Random(seed)
    start = datetime.datetime(1969, 12, 20)
    return [(rng.choice([None, 1, 2, 3, 4]), None if rng.random() < 0.05 else start + datetime.timedelta(hours=rng.randint(0, 600)), i, rng.choice(["a", "b", "c", None, "d"]), "x") for i in range(250)]


def plain(rows, steps):
    out = {}
    for k in {r[0] for r in rows}:
        s = 0
        for _, _, kind in sorted((r[1], r[2], r[3]) for r in rows if r[0] == k and r[1] is not None and r[3] is not None):
            s += s < len(steps) and steps[s] == kind
        out[k] = s
    return out


@pytest.mark.parametrize(("seed", "steps", "seconds"), [(1, ["a", "b", "a", "c", "c", "b", "a", "d", "a", "b", "c", "d"], 86_400), (2, ["a", "a", "z"], 10**9), (3, ["c"], 1)])
def test_steps_equal_a_plain_machine(spark, seed, steps, seconds):
    t = spark.createDataFrame(made(seed), SHAPE)
    found = paths.steps_reached(t, paths.bucket_maps(t, "k", "at", "id", "kind", steps, seconds), "k")
    assert {r.k: r.steps for r in found.collect()} == plain(made(seed), steps)


def test_maps_of_later_buckets_are_added(spark):
    rows, steps = made(4), ["a", "b", "c", "d", "a", "b", "c"]
    noon = datetime.datetime(1970, 1, 2)
    early, late = [r for r in rows if r[1] and r[1] < noon], [r for r in rows if r[1] and r[1] >= noon]
    maps = [paths.bucket_maps(spark.createDataFrame(x, SHAPE), "k", "at", "id", "kind", steps) for x in (early, late)]
    found = paths.steps_reached(spark.createDataFrame(rows, SHAPE), maps[0].unionByName(maps[1]), "k")
    assert {r.k: r.steps for r in found.collect()} == plain(rows, steps)


def test_no_events(spark):
    t = spark.createDataFrame([], SHAPE)
    assert paths.steps_reached(t, paths.bucket_maps(t, "k", "at", "id", "kind", ["a"]), "k").count() == 0
