"""Hierarchies, keys and clustered tables against brute force."""

import datetime
import random
from itertools import combinations

import pytest

from lakemill.operators import hierarchy, keys
from lakemill.sources import clustered


def plain_closure(edges, most=None):
    up = {}
    for c, p in edges:
        if c is not None and p is not None:
            up.setdefault(c, set()).add(p)
    out = {}
    for start in up:
        level, depth = {start}, 0
        while level and (most is None or depth < most):
            depth += 1
            level = {p for x in level for p in up.get(x, ()) if (start, p) not in out}
            out |= {(start, p): depth for p in level}
    return out


def edges(kind):
    rng = random.Random(3)
    if kind == "chain":
        return [(i, i + 1) for i in range(35)]
    if kind == "cycles":
        return [(i, (i + 1) % 9) for i in range(9)] + [(20, 3), (21, 20), (5, 5), (5, 5), (None, 3), (4, None)]
    if kind == "hot root":
        return [(i, 0) for i in range(1, 300)] + [(0, -1), (-1, -2)]
    return [(rng.randrange(60), rng.randrange(60)) for _ in range(90)]


@pytest.mark.parametrize("kind", ["chain", "cycles", "hot root", "random"])
@pytest.mark.parametrize("most", [None, 1, 5])
def test_closure_equals_a_plain_walk(spark, kind, most):
    t = spark.createDataFrame([(c, p, "x") for c, p in edges(kind)], "child int, parent int, depth string")
    found = hierarchy.closure(t, "child", "parent", most, task_rows=20).collect()
    assert len({(r.node, r.ancestor) for r in found}) == len(found)
    assert {(r.node, r.ancestor): r.depth for r in found} == plain_closure(edges(kind), most)


def test_cycles_and_no_edges(spark):
    t = spark.createDataFrame(edges("cycles"), "child int, parent int")
    assert {r.node: r.length for r in hierarchy.cyclic(hierarchy.closure(t, "child", "parent")).collect()} == {**dict.fromkeys(range(9), 9), 5: 1}
    assert hierarchy.closure(t.limit(0), "child", "parent").count() == 0
    with pytest.raises(ValueError):
        hierarchy.closure(t, "child", "parent", 0)


def test_subtree_totals(spark):
    links = edges("random")
    above = plain_closure(links)
    facts = [(random.Random(i).randrange(70), i) for i in range(200)] + [(None, 5), (3, None)]
    wanted = {}
    for node in {k for k, _ in facts if k is not None} | {a for n, a in above if n in {k for k, _ in facts}}:
        below = {node} | {n for n, a in above if a == node}
        rows = [v for k, v in facts if k in below]
        own = [v for k, v in facts if k == node and v is not None]
        wanted[node] = (sum(own) if own else None, sum(v for v in rows if v is not None), len(rows))
    pairs = hierarchy.closure(spark.createDataFrame(links, "c int, p int"), "c", "p")
    found = hierarchy.subtree_totals(spark.createDataFrame(facts, "k int, v long"), "k", "v", pairs).collect()
    assert {r.node: (r.own, r.total, r.n_rows) for r in found} == wanted


def made(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = i // 10, i % 10
        rows.append((a, b if b else None, f"n{a}", 7, rng.choice([None, 1.5, float("nan"), 2.0]), rng.randrange(40), bytearray([a % 3])))
    return rows


NAMES = ["a", "b", "c", "d", "e", "f", "g"]
SHAPE = "a int, b int, c string, d int, e double, f int, g binary"


def plain_parts(rows, s):
    value = lambda x: "nan" if x != x else bytes(x) if isinstance(x, bytearray) else x
    return len({tuple(value(r[NAMES.index(c)]) for c in s) for r in rows})


@pytest.mark.parametrize("sample_rows", [1, 30, 1000])
def test_keys_and_dependencies_equal_brute_force(spark, sample_rows):
    rows = made(5)
    t = spark.createDataFrame([(*r, [1]) for r in rows], SHAPE + ", other array<int>")
    parts = {s: plain_parts(rows, s) for size in range(5) for s in combinations(NAMES, size)}
    unique = [s for s in parts if len(s) <= 3 and parts[s] == len(rows)]
    assert keys.minimal_keys(t, most=3, sample_rows=sample_rows) == [s for s in unique if not any(set(k) < set(s) for k in unique)]
    hold = [(s, c) for s in parts if len(s) <= 2 for c in NAMES if c not in s and parts[tuple(x for x in NAMES if x in s or x == c)] == parts[s]]
    least = [(s, c) for s, c in hold if not any(b == c and set(a) < set(s) for a, b in hold)]
    assert sorted(keys.dependencies(t, most=2, sample_rows=sample_rows)) == sorted(least) and ((), "d") in least and (("a",), "c") in least


def test_keys_of_few_rows(spark):
    t = spark.createDataFrame(made(1, 2), SHAPE)
    assert keys.minimal_keys(t.limit(0)) == [()] == keys.minimal_keys(t.limit(1))
    assert {c for s, c in keys.dependencies(t.limit(0)) if s == ()} == set(NAMES)
    same = spark.createDataFrame([(1, 2), (1, 2)], "a int, b int")
    assert keys.minimal_keys(same) == []
    with pytest.raises(ValueError):
        keys.minimal_keys(spark.createDataFrame([([1],)], "a array<int>"), ["a"])


def lines(n=6000):
    rng = random.Random(2)
    start = datetime.datetime(1969, 1, 1)
    return [(i, None if i % 50 == 0 else start + datetime.timedelta(minutes=rng.randrange(10**6)), 7 if i % 3 == 0 else rng.randrange(1000), float("nan") if i % 97 == 0 else rng.gauss(0, 1)) for i in range(n)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_clustered_reads_equal_a_filter_and_open_fewer_files(spark, tmp_path, kind):
    rows = lines()
    t = spark.createDataFrame(rows, f"id int, at {kind}, k int, x double")
    path = str(tmp_path / kind)
    clustered.write_clustered(t, path, ["at", "k", "x"], file_rows=100)
    files = clustered.file_list(spark, path)
    assert sorted(r.id for r in spark.read.parquet(f"{path}/data").collect()) == list(range(6000))
    assert files.count() > 40 and files.agg({"_rows": "max"}).first()[0] <= 200
    a, b = datetime.datetime(1969, 8, 1), datetime.datetime(1969, 10, 1)
    for ranges, holds in [
        ({"at": (a, b), "k": (100, 300)}, lambda r: r[1] and a <= r[1] <= b and 100 <= r[2] <= 300),
        ({"k": (900, None)}, lambda r: r[2] >= 900),
        ({"at": (None, a)}, lambda r: r[1] and r[1] <= a),
        ({"at": (None, None)}, lambda r: r[1]),
        ({"x": (1.5, 9.0)}, lambda r: 1.5 <= r[3] <= 9),
        ({"k": (2000, 3000)}, lambda r: False),
    ]:
        assert sorted(r.id for r in clustered.read_within(spark, path, ranges).collect()) == [r[0] for r in rows if holds(r)]
        if None not in next(iter(ranges.values())):
            assert clustered.files_within(spark, path, ranges).count() < 0.5 * files.count()
    plan = clustered.read_within(spark, path, {"at": (a, b)})._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(at" in plan
    with pytest.raises(ValueError):
        clustered.files_within(spark, path, {"id": (1, 2)})


def test_clustered_tables_without_rows_or_values(spark, tmp_path):
    t = spark.createDataFrame([(1, None)], "a int, b date")
    for i, rows in enumerate([t, t.limit(0)]):
        clustered.write_clustered(rows, str(tmp_path / str(i)), ["a", "b"])
        assert clustered.read_within(spark, str(tmp_path / str(i)), {"a": (0, 5)}).count() == 1 - i
        assert clustered.read_within(spark, str(tmp_path / str(i)), {"b": (None, None)}).count() == 0
    with pytest.raises(ValueError):
        clustered.along_curve(spark.createDataFrame([("x",)], "a string"), ["a"])


def test_a_round_of_the_closure_writes_new_pairs_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hierarchy, "shared_dir", lambda _: str(tmp_path))
    found = hierarchy.closure(spark.createDataFrame(edges("chain"), "c int, p int"), "c", "p").count()
    written = sum(spark.read.parquet(str(x)).count() for x in next(tmp_path.glob("closure-*")).iterdir())
    assert written == found == 35 * 36 // 2


@pytest.mark.parametrize("share", [1, 64])
def test_classes_are_counted_in_many_tasks_and_looked_at_whole(spark, share, monkeypatch):
    """No task adds up all of a set that is nearly a key where it is read, and equal numbers and nulls are one class."""
    t = spark.createDataFrame([(i // 2, [0.0, -0.0, float("nan"), None][i % 4]) for i in range(400)], "a int, x double").coalesce(1)
    monkeypatch.setattr(keys, "SHARE", share)
    assert keys.classes(t, [("a",), ("x",), ("a", "x"), ()], task_rows=50) == {("a",): 200, ("x",): 3, ("a", "x"): 300, (): 1}
    k, n = keys._counted(t, [(("a",), ("a",))], 8, 400)[("a",), ("a",)]
    assert 0 < k < 200 and n == 2 * k
    assert keys.minimal_keys(t, sample_rows=1) == [] and keys.dependencies(t, sample_rows=1) == []
