import datetime
import random
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakemill import queries as warehouse
from lakemill.operators import dimensions, lookups, rules, summaries
from lakemill.plans import loads
from lakemill.sources import formats

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or v != v:
        return "null"
    if isinstance(v, (int, float, np.integer, np.floating)) and not isinstance(v, (bool, np.bool_)):
        return repr(float(v))
    return str(pd.Timestamp(v)) if hasattr(v, "isoformat") else str(v)


def rows(df):
    df = df[sorted(df.columns)]
    return sorted("|".join(map(plain, r)) for r in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(warehouse.ORACLE))
def test_query_gives_what_sql_gives(spark, duck, name):
    found, wanted = warehouse.QUERIES[name](spark, SF).toPandas(), duck.execute(warehouse.ORACLE[name]).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows(found) == rows(wanted)


def test_streamed_totals_do_not_depend_on_the_order_of_files(spark, duck, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    parts = events.withColumn("d", F.dayofmonth("ts")).where("d in (2, 12, 25)")
    (tmp_path / "events.parquet").mkdir()
    for i, d in enumerate([25, 2, 12]):  # the newest first
        parts.where(F.col("d") == d).drop("d").coalesce(1).write.parquet(f"{tmp_path}/one{i}")
        (file,) = (tmp_path / f"one{i}").glob("*.parquet")
        file.rename(tmp_path / "events.parquet" / f"{i}.parquet")
    found = warehouse.streamed_totals(spark, str(tmp_path), files_per_trigger=1).toPandas()
    wanted = duck.execute(warehouse.ORACLE["streamed_totals"].replace("FROM events", f"FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")).df()
    assert rows(found) == rows(wanted)


def test_every_query_has_sql():
    assert set(warehouse.QUERIES) == set(warehouse.ORACLE)


def test_upsert_adds_and_replaces_whole_rows(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", None)], "k int, v string, w int")
    new = spark.createDataFrame([(2, None, 5), (3, "c", 6)], "k int, v string, w int")
    assert sorted(dimensions.upsert(old, new, "k").collect()) == [(1, "a", 1), (2, None, 5), (3, "c", 6)]


def test_history_merges_repeats_and_keeps_null_as_a_value(spark):
    t = [datetime.datetime(2024, 1, d) for d in range(1, 6)]
    log = spark.createDataFrame([(1, t[0], None, 1), (1, t[1], None, 2), (1, t[2], "a", 3), (1, t[3], "a", 4), (1, t[4], None, 5)], "k int, at timestamp, v string, id int")
    found = dimensions.history(log, "k", "at", "v", "id").orderBy("valid_from").collect()
    assert [(r.v, r.valid_from, r.valid_to) for r in found] == [(None, t[0], t[2]), ("a", t[2], t[4]), (None, t[4], None)]


def test_diff_counts_equal_nulls_as_same(spark):
    old = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "k int, v string")
    new = spark.createDataFrame([(1, None), (2, "z"), (4, "y")], "k int, v string")
    assert sorted(dimensions.snapshot_diff(old, new, "k").collect()) == [(1, "S"), (2, "U"), (3, "D"), (4, "I")]


@pytest.mark.parametrize("bucket", [1, 3600, 10**9])
def test_as_of_does_not_depend_on_the_bucket(spark, bucket):
    at = lambda h: datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=h)
    left = spark.createDataFrame([(1, at(5), "a"), (1, at(0), "b"), (2, at(9), "c"), (None, at(9), "d")], "k int, at timestamp, n string")
    right = spark.createDataFrame([(1, at(1), 10), (1, at(5), 11), (1, at(6), 12), (3, at(1), 13)], "k int, since timestamp, v int")
    found = lookups.as_of(left, right, "k", "at", "since", ["v"], bucket)
    assert {r.n: r.v for r in found.collect()} == {"a": 11, "b": None, "c": None, "d": None}


def test_as_of_keeps_columns_of_any_name(spark):
    names = ["_v", "_l", "_k", "_t", "_b", "_r", "_own", "_carried", "_tie", "_end"]
    left = spark.createDataFrame([(1, datetime.datetime(2024, 1, 2), *range(10)), (None, datetime.datetime(2024, 1, 2), *range(10))], f"k int, at timestamp, {', '.join(f'{n} int' for n in names)}")
    right = spark.createDataFrame([(1, datetime.datetime(2024, 1, 1), 7)], "k int, since timestamp, v int")
    found = lookups.as_of(left, right, "k", "at", "since", ["v"])
    assert found.columns == [*left.columns, "v"]
    assert {r.k: tuple(r)[2:] for r in found.collect()} == {1: (*range(10), 7), None: (*range(10), None)}
    with pytest.raises(ValueError):
        lookups.as_of(left, right.withColumnRenamed("v", "_V"), "k", "at", "since", ["_V"])


def test_as_of_keeps_left_rows_without_key_or_time(spark):
    now = datetime.datetime(2024, 1, 1)
    left = spark.createDataFrame([(None, now, "key"), (1, None, "time"), (None, None, "both"), (1, now, "none missing")], "k int, at timestamp, n string")
    right = spark.createDataFrame([(1, now, 7), (None, now, 8), (1, None, 9)], "k int, since timestamp, v int")
    assert {r.n: r.v for r in lookups.as_of(left, right, "k", "at", "since", ["v"]).collect()} == {"key": None, "time": None, "both": None, "none missing": 7}


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_lookups_at_equal_times_do_not_depend_on_partitions(spark, parts):
    now, later = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 3)
    left = spark.createDataFrame([(1, now, "same"), (1, later, "later")], "k int, at timestamp, n string")
    right = spark.createDataFrame([(1, now, i, 9 - i) for i in range(6)], "k int, since timestamp, v int, w int").repartition(parts, "v")
    assert {r.n: r.v for r in lookups.as_of(left, right, "k", "at", "since", ["v"]).collect()} == {"same": 5, "later": 5}
    assert {r.n: r.v for r in lookups.as_of(left, right, "k", "at", "since", ["v"], tie=["w"]).collect()} == {"same": 0, "later": 0}
    log = right.withColumnRenamed("since", "at")
    past = dimensions.history(log, "k", "at", "v", "w")
    assert [(r.v, r.valid_from, r.valid_to) for r in past.collect()] == [(0, now, None)]
    assert {r.n: r.v for r in lookups.point_in_time(left, past, "k", "at", "v").collect()} == {"same": 0, "later": 0}


def test_late_changes_enter_the_history(spark):
    day = lambda d: datetime.datetime(2024, 1, d)
    schema = "k int, at timestamp, v string, id int"
    early = [(1, day(1), "a", 1), (1, day(5), "b", 2), (1, day(9), "c", 3), (2, day(2), "x", 4), (None, day(2), "n", 5)]
    late = [(1, day(3), "late", 6), (1, day(9), "d", 7), (3, day(1), "new", 8), (None, day(4), "m", 9)]
    log = ("k", "at", "v", "id")
    points = dimensions.change_points(spark.createDataFrame(early, schema), *log)
    found = dimensions.merge_history(dimensions.history(points, *log), points, spark.createDataFrame(late, schema), *log)
    whole = dimensions.history(spark.createDataFrame(early + late, schema), *log)
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_histories_merged_in_any_order_equal_the_whole(spark, seed):
    rng = random.Random(seed)
    log = ("k", "at", "v", "id")
    day = lambda d: datetime.datetime(2024, 1, d)
    made = [(rng.choice([None, 1, 2, 3]), rng.choice([None, *map(day, range(1, 12))]), rng.choice(["a", "b", None]), i) for i in range(90)]
    rng.shuffle(made)
    t = lambda x: spark.createDataFrame(x, "k int, at timestamp, v string, id int")
    points = dimensions.change_points(t(made[:40]), *log)
    past = dimensions.history(points, *log)
    for part in (made[40:60], made[60:]):
        past, points = dimensions.merge_history(past, points, t(part), *log), dimensions.merge_points(points, t(part), *log)
    assert sorted(map(str, past.collect())) == sorted(map(str, dimensions.history(t(made), *log).collect()))


def test_natural_keys_tell_all_keys_apart(spark):
    made = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("", "c"), ("-", "c"), ("c", None), ("1:a", "b"), ("a", "1:b")]
    t = spark.createDataFrame(made, "a string, b string")
    for bits in (128, 256):
        assert t.select(dimensions.natural_key("a", "b", bits=bits)).distinct().count() == len(made)


def test_null_is_one_key(spark):
    t = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    assert sorted(map(str, dimensions.upsert(t, t, "k").collect())) == sorted(map(str, t.collect()))
    assert {(r.k, r.change) for r in dimensions.snapshot_diff(t, t, "k").collect()} == {(None, "S"), (1, "S")}


def test_rules_count_nulls_as_broken(spark):
    t = spark.createDataFrame([(1, None), (1, 5), (2, -1)], "k int, v int")
    found = rules.report(rules.unique("u", t, "k"), rules.holds("h", t, F.col("v") > 0), rules.foreign_key("f", t, "v", t, "k"))
    assert {r.rule: r.n_bad for r in found.collect()} == {"u": 2, "h": 2, "f": 2}


def test_merged_partials_equal_one_load(spark):
    t = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    both = summaries.merged(summaries.partials(t.where("v < 40"), "k", F.col("v")), summaries.partials(t.where("v >= 40"), "k", F.col("v")), "k")
    assert sorted(both.collect()) == sorted(summaries.partials(t, "k", F.col("v")).collect())


@pytest.mark.parametrize("kind", ["parquet", "orc", "csv", "json"])
def test_files_round_trip(spark, tmp_path, kind):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, None)], "k int, v string")
    formats.write_files(t, f"{tmp_path}/t", kind)
    assert sorted(map(str, formats.read_files(spark, f"{tmp_path}/t", kind, t.schema).collect())) == sorted(map(str, t.collect()))


def test_versions_can_be_derived_from_the_present_one(spark, tmp_path):
    path = f"{tmp_path}/table"
    assert formats.read_version(spark, path) is None
    formats.write_version(spark.range(3), path)
    formats.write_version(formats.read_version(spark, path).union(spark.range(2)), path)
    assert formats.read_version(spark, path).count() == 5 and formats.versions(spark, path) == [1, 2]
    formats.forget_versions(spark, path, keep=1)
    assert formats.read_version(spark, path).count() == 5 and formats.versions(spark, path) == [2]


def test_a_numbered_batch_is_appended_once(spark, tmp_path):
    path = f"{tmp_path}/table"
    assert formats.read_appended(spark, path) is None
    assert formats.append(spark.range(3), path, 4) and not formats.append(spark.range(5), path, 4) and formats.append(spark.range(2), path, 0)
    assert formats.append(spark.range(1), path)
    assert formats.read_appended(spark, path).count() == 6 and formats.versions(spark, path) == [0, 4, 5]


def test_intermediate_tables_need_a_shared_folder_on_a_cluster():
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda name, default: default)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="checkpoint.dir"):
        formats.shared_dir(Session)


def test_loads_build_on_the_version_before(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, "k int, v string")
    dim, fact = f"{tmp_path}/dim", f"{tmp_path}/fact"
    assert {tuple(r) for r in loads.load_dimension(spark, dim, make([(1, "a"), (2, "b")]), "k").collect()} == {("I", 2)}
    assert {tuple(r) for r in loads.load_dimension(spark, dim, make([(2, "c"), (3, "d")]), "k").collect()} == {("I", 1), ("U", 1), ("D", 1)}
    assert sorted(map(tuple, formats.read_version(spark, dim).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    for keys in ([1, 9], [3, None]):
        loads.load_facts(spark, fact, spark.createDataFrame([(k, 1) for k in keys], "f int, n int"), "f", formats.read_version(spark, dim), "k")
    assert sorted(r.f for r in formats.read_appended(spark, fact).collect()) == [-1, -1, 1, 3]
