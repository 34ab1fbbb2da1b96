"""History in two times, interval joins and appended tables against brute force."""

import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from lakemill.operators import bitemporal, dimensions
from lakemill.operators.intervals import overlap_join
from lakemill.operators.ordered import with_neighbour
from lakemill.plans import loads
from lakemill.sources import formats

START = datetime.datetime(2024, 1, 1)
LOG = "k int, at timestamp, v string, id int, load long"


def hour(h):
    return None if h is None else START + datetime.timedelta(hours=h)


def made(seed, n=120):
    rng = random.Random(seed)
    return [(rng.choice([None, 1, 1, 1, 2, 3]), rng.choice([None, *map(hour, range(0, 200, 3))]) if rng.random() < 0.9 else hour(6), rng.choice(["a", "b", "c", None]), rng.choice([None, i, i, i]), rng.randint(0, 5)) for i in range(n)]


def least(x):
    return (x is not None, 0 if x is None else x)


def known(log, load):
    """{(key, at, tie): (value, valid_to)} after a load."""
    values = {}
    for k, at, v, tie, own in sorted(log, key=lambda r: (r[4], least(r[2]))):
        if at is not None and own <= load:
            values[k, at, tie] = v
    out = {}
    for k, at, tie in values:
        later = [a for x, a, t in values if x == k and (a, least(t)) > (at, least(tie))]
        out[k, at, tie] = (values[k, at, tie], min(later, default=None))
    return out


def brute_rectangles(log):
    out, held = [], {}
    for load in [*sorted({r[4] for r in log}), None]:
        now = {} if load is None else known(log, load)
        for p, (since, was) in list(held.items()):
            if load is None or now[p] != was:
                out.append((p[0], was[0], p[1], was[1], since, load))
                del held[p]
        for p, v in now.items():
            held.setdefault(p, (load, v))
    return [r for r in out if r[3] is None or r[3] > r[2]]


def loaded(spark, log, bucket_seconds=86_400):
    table = None
    for load in sorted({r[4] for r in log}):
        changes = spark.createDataFrame([r for r in log if r[4] == load], LOG)
        more = bitemporal.opened(table, changes, "k", "at", "v", "id", load, bucket_seconds)
        more = spark.createDataFrame(more.collect(), more.schema)
        table = more if table is None else table.unionByName(more)
    return table


def texts(rows):
    return sorted(map(repr, map(tuple, rows)))


@pytest.mark.parametrize(("seed", "bucket"), [(1, 86_400), (2, 3600)])
def test_rectangles_equal_brute_force(spark, seed, bucket):
    log = made(seed)
    assert texts(bitemporal.rectangles(loaded(spark, log, bucket), "k").collect()) == texts(brute_rectangles(log))


def test_what_was_known_at_each_load_is_the_history_of_the_loads_so_far(spark):
    log = [r for r in made(4) if r[3] is not None]  # ties tell changes apart, as `history` needs
    table = loaded(spark, log)
    for load in (1, 3, 5):
        whole = dimensions.history(spark.createDataFrame([r for r in log if r[4] <= load], LOG), "k", "at", "v", "id")
        found = bitemporal.known_history(table, "k", load, 7200).withColumnRenamed("value", "v")
        assert texts(found.collect()) == texts(whole.select(found.columns).collect())


def test_the_present_history_does_not_depend_on_the_order_of_loads(spark):
    log = [r for r in made(5, 60) if r[3] is not None]
    parts = [[r[:4] for r in log if r[4] % 3 == i] for i in range(3)]
    seen = set()
    for order in itertools.islice(itertools.permutations(range(3)), 0, 6, 2):
        table = loaded(spark, [(*r, load) for load, i in enumerate(order) for r in parts[i]])
        seen.add(tuple(texts(bitemporal.known_history(table, "k").collect())))
    assert len(seen) == 1


def test_facts_get_the_value_known_at_their_load(spark):
    log, rng = made(6), random.Random(7)
    facts = [(i, rng.choice([None, 1, 2, 3, 9]), rng.choice([None, *map(hour, range(-2, 210, 2))]), rng.choice([None, 0, 1, 3, 5, 9])) for i in range(80)]
    facts += facts[:3]
    wanted = []
    for i, k, at, load in facts:
        hits = [] if None in (k, at, load) else [v for (x, a, _), (v, to) in known(log, load).items() if x == k and a <= at and (to is None or at < to)]
        assert len(hits) <= 1
        wanted.append((i, k, at, load, hits[0] if hits else None))
    table = spark.createDataFrame(facts, "_at int, k int, at timestamp, _k long")
    found = bitemporal.as_known(table, loaded(spark, log), "k", "at", "_k", "state")
    assert found.columns == ["_at", "k", "at", "_k", "state"]
    assert texts(found.collect()) == texts(wanted)


def test_a_lookup_in_two_times_copies_a_fact_to_few_rows_and_has_a_small_plan(spark):
    """A fact used to be copied to every level of interval lengths, in a plan that a driver of 1.5 GB couldn't hold twice."""
    table, facts = loaded(spark, made(6)), spark.createDataFrame([(1, 1, hour(5), 3)], "id int, k int, at timestamp, load long")
    plan = bitemporal.as_known(facts, table, "k", "at", "load", "state")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 12 and "Overlap" not in plan and "_level" not in plan


def test_loads_of_changes_are_added_once_and_in_order(spark, tmp_path):
    log = made(8, 60)
    t = lambda load: spark.createDataFrame([r for r in log if r[4] == load], LOG)
    path, arguments = f"{tmp_path}/history", ("k", "at", "v", "id")
    for load in (0, 1, 3, 4):
        assert loads.load_changes(spark, path, t(load), *arguments, load)
        assert not loads.load_changes(spark, path, t(load), *arguments, load)
        if load == 3:
            assert formats.compact(spark, path) == 2
            assert not loads.load_changes(spark, path, t(1), *arguments, 1)
    with pytest.raises(ValueError, match="comes after"):
        loads.load_changes(spark, path, t(2), *arguments, 2)
    assert loads.load_changes(spark, path, t(5), *arguments, 5)
    wanted = brute_rectangles([r for r in log if r[4] != 2])
    assert texts(bitemporal.rectangles(formats.read_appended(spark, path), "k").collect()) == texts(wanted)


def test_a_load_of_nothing(spark):
    nothing = spark.createDataFrame([], LOG)
    first = bitemporal.opened(None, nothing, "k", "at", "v", "id", 1)
    assert first.count() == 0 and bitemporal.opened(first, nothing, "k", "at", "v", "id", 2).count() == 0
    assert bitemporal.known_history(first, "k").count() == bitemporal.rectangles(first, "k").count() == 0


@pytest.mark.parametrize("bucket", [3600, 10**9])
def test_neighbours_do_not_depend_on_the_bucket(spark, bucket):
    rng = random.Random(9)
    rows = [(rng.choice([None, 1, 2]), hour(rng.randint(-50, 50)), i) for i in range(80)]
    t = spark.createDataFrame(rows, "k int, at timestamp, id int")
    for after in (True, False):
        found = {r.id: r.n.id if r.n else None for r in with_neighbour(t, "k", "at", ["id"], ["id"], "n", after, bucket).collect()}
        for k, at, i in rows:
            others = [(a, j) for x, a, j in rows if x == k and ((a, j) > (at, i) if after else (a, j) < (at, i))]
            assert found[i] == ((min(others) if after else max(others))[1] if others else None)


# interval joins


def spans(seed, n, keys=(1, 2, 3, None), open_share=0.1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        begin = rng.choice([None, *[rng.randint(-5000, 5000)] * 12])
        length = rng.choice([0, -5, 1, 2, 7, 60, 800, 5000])
        out.append((i, rng.choice(keys), hour(begin), None if rng.random() < open_share or begin is None else hour(begin + length)))
    return out


def overlaps(left, right):
    out = []
    for i, k, a, b in left:
        for j, x, c, d in right:
            if k is None or k != x or a is None or c is None or (b is not None and b <= a) or (d is not None and d <= c):
                continue
            if (d is None or a < d) and (b is None or c < b):
                out.append((k, i, j, max(a, c), min((y for y in (b, d) if y is not None), default=None)))
    return out


L, R = "i int, k int, a timestamp, b timestamp", "j int, k int, c timestamp, d timestamp"


@pytest.mark.parametrize(("seed", "rows"), [(1, 100_000), (2, 7), (3, 1)])
def test_overlaps_equal_brute_force(spark, seed, rows):
    left, right = spans(seed, 150), spans(seed + 10, 130)
    found = overlap_join(spark.createDataFrame(left, L), spark.createDataFrame(right, R), "k", ("a", "b"), ("c", "d"), bin_rows=rows)
    assert found.columns == ["i", "k", "a", "b", "j", "c", "d", "overlap_from", "overlap_to"]
    assert texts(found.select("k", "i", "j", "overlap_from", "overlap_to").collect()) == texts(overlaps(left, right))


def test_overlaps_of_nothing_and_of_other_names(spark):
    left, right = spark.createDataFrame(spans(1, 20), L), spark.createDataFrame(spans(2, 20), R)
    assert overlap_join(left.limit(0), right, "k", ("a", "b"), ("c", "d")).count() == 0
    assert overlap_join(left, right.limit(0), "k", ("a", "b"), ("c", "d")).count() == 0
    renamed = right.withColumnRenamed("k", "key")
    assert overlap_join(left, renamed, "k", ("a", "b"), ("c", "d"), right_key="key").count() == len(overlaps(spans(1, 20), spans(2, 20)))
    with pytest.raises(ValueError, match="both sides"):
        overlap_join(left, left, "k", ("a", "b"), ("a", "b"))


def test_overlaps_join_by_equal_keys_only(spark):
    plan = overlap_join(spark.createDataFrame(spans(1, 20), L), spark.createDataFrame(spans(2, 20), R), "k", ("a", "b"), ("c", "d"))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_a_hot_key_is_cut_and_guests_do_not_meet(spark):
    """One key, many short intervals that touch no other and a few long ones: rows that meet stay near the pairs that overlap."""
    short = [(i, 1, hour(2 * i), hour(2 * i + 1)) for i in range(3000)]
    others = [(i, 1, hour(2 * i + 1), hour(2 * i + 2)) for i in range(3000)]
    long = [(5000, 1, hour(0), hour(6000))]
    left, right = spark.createDataFrame(short + long, L), spark.createDataFrame(others + long, R)
    found = overlap_join(left, right, "k", ("a", "b"), ("c", "d"), bin_rows=200)
    per_task = found.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r[1] for r in per_task) == 6001
    assert found.groupBy("i").count().where("count > 1").count() == 1


def test_batches_are_merged_without_loss(spark, tmp_path):
    path = f"{tmp_path}/table"
    assert formats.compact(spark, path) == 0
    for n in (0, 2, 3):
        formats.append(spark.range(n, n + 2), path, n)
    assert formats.compact(spark, path) == 2 and formats.merged_upto(spark, path) == 2
    assert not formats.append(spark.range(9), path, 1) and not formats.append(spark.range(9), path, 2)
    assert formats.append(spark.range(4, 6), path, 4) and formats.append(spark.range(1), path)
    wanted = sorted([0, 1, 2, 3, 3, 4, 4, 5, 0])
    assert sorted(r.id for r in formats.read_appended(spark, path).collect()) == wanted
    assert formats.compact(spark, path, keep=0) == 3
    formats.forget_merged(spark, path)
    assert sorted(r.id for r in formats.read_appended(spark, path).collect()) == wanted
    assert [p.name for p in sorted((tmp_path / "table").iterdir())] == ["m000000000005"]


def test_a_fact_load_that_is_tried_again_adds_nothing(spark, tmp_path):
    path, dim = f"{tmp_path}/fact", spark.createDataFrame([(1,)], "k int")
    facts = spark.createDataFrame([(1,), (7,)], "f int")
    assert loads.load_facts(spark, path, facts, "f", dim, "k", load=0) and not loads.load_facts(spark, path, facts, "f", dim, "k", load=0)
    assert sorted(r.f for r in formats.read_appended(spark, path).collect()) == [-1, 1]
