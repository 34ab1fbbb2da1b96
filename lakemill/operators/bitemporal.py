"""History in two times: when a value was valid, and since which load that was known.

The table is append only. Each row is what one load made known of one change: its key, valid_from,
tie and value, the valid_to that it has had since, and the load, known_from. A load appends the
rows of its own changes and of those changes before them whose valid_to they move; nothing else is
written. A row holds until the next one of its change, so no row is ever updated, and what was
known at any load can be read for ever.

Changes are kept one by one, repeats of a value too, which `known_history` merges when it is
read. So a late change is placed as if it had come in time, whatever the order of loads.

Defined cases: null is a key, a value and a tie (the least) like any other; a change without a time
is left out (count those by a rule); of changes of a key at one time the one with the greatest tie
holds, the others get an empty interval; a change that comes again with another value replaces
itself from that load on, and with the same value changes nothing; of several with one tie in one
load the greatest value counts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakemill.operators.lookups import as_of
from lakemill.operators.ordered import with_neighbour
from lakemill.sources.formats import shared_dir


def opened(table: DataFrame | None, changes: DataFrame, key: str, at: str, value: str, tie: str, load: int, bucket_seconds: int = 86_400) -> DataFrame:
    """The rows that a load of changes (key, at, value, tie) adds to table (None: nothing loaded yet)."""
    # Old and new rows meet in one aggregation, which is written: with_neighbour reads it twice.
    spark, place = changes.sparkSession, [key, "valid_from", "tie"]
    new = changes.where(F.col(at).isNotNull()).select(F.col(key), F.col(at).alias("valid_from"), F.col(tie).alias("tie"), F.struct(F.col(value).alias("value")).alias("new"))
    rows = new
    if table is not None:
        keys = new.select(F.col(key).alias("_k")).distinct()
        rows = new.unionByName(table.join(keys, F.col(key).eqNullSafe(F.col("_k")), "left_semi").select(*place, F.struct("value", "valid_to").alias("old"), "known_from"), allowMissingColumns=True)
    else:
        nothing = F.struct(F.col("new.value").alias("value"), F.col("valid_from").alias("valid_to"))
        rows = new.select("*", F.when(F.lit(False), nothing).alias("old"), F.lit(None).cast("long").alias("known_from"))
    path = f"{shared_dir(spark)}/changes-{uuid.uuid4().hex}"
    rows.groupBy(*place).agg(F.max("new").alias("new"), F.max_by("old", "known_from").alias("old")).write.parquet(path)
    both = spark.read.parquet(path)
    placed = with_neighbour(both, key, "valid_from", ["tie"], ["valid_from"], "next", after=True, bucket_seconds=bucket_seconds)
    rows = placed.select("*", F.when(F.col("new").isNotNull(), F.col("new.value")).otherwise(F.col("old.value")).alias("value"), F.col("next.valid_from").alias("valid_to"))
    same = F.col("old").isNotNull() & F.col("old.value").eqNullSafe(F.col("value")) & F.col("old.valid_to").eqNullSafe(F.col("valid_to"))
    return rows.where(~same).select(key, "valid_from", "tie", "value", "valid_to", F.lit(load).cast("long").alias("known_from"))


def rectangles(table: DataFrame, key: str) -> DataFrame:
    """key, value, valid_from, valid_to, known_from, known_to (null: open) of all that was ever known; empty intervals are left out."""
    own = W.partitionBy(key, "valid_from", "tie").orderBy("known_from")
    closed = table.withColumn("known_to", F.lead("known_from").over(own))
    return closed.where(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))).select(key, "value", "valid_from", "valid_to", "known_from", "known_to")


def known_history(table: DataFrame, key: str, load: int | None = None, bucket_seconds: int = 86_400) -> DataFrame:
    """The history (value, valid_from, valid_to, is_current by key) as it was known after a load (None: the last), repeats merged."""
    seen = table if load is None else table.where(F.col("known_from") <= load)
    now = seen.groupBy(key, "valid_from", "tie").agg(F.max_by(F.struct("value", "valid_to"), "known_from").alias("v")).select(key, "valid_from", "v.*")
    held = now.where(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))).drop("valid_to")
    marked = with_neighbour(held, key, "valid_from", [], ["value"], "before", after=False, bucket_seconds=bucket_seconds)
    begun = marked.where(F.col("before").isNull() | ~F.col("before.value").eqNullSafe(F.col("value"))).drop("before")
    ended = with_neighbour(begun, key, "valid_from", [], ["valid_from"], "next", after=True, bucket_seconds=bucket_seconds)
    return ended.select(key, "value", "valid_from", F.col("next.valid_from").alias("valid_to"), F.col("next").isNull().alias("is_current"))


def as_known(facts: DataFrame, table: DataFrame, key: str, at: str, known: str, name: str) -> DataFrame:
    """facts with column name: the value valid at their time at, as it was known after the load in their column known; null where none was.

    A change known by then and begun by the fact's time is the one in force if none is later, so
    this is an as-of lookup among the rows of the first loads. A Fenwick tree over the loads makes
    it one of equal keys: a row is copied to the log2(loads) spans of loads that hold its own, a
    fact asks the log2(loads) spans that its loads consist of. The numbers of the loads come to the driver.
    """
    loads = sorted(r[0] for r in table.select("known_from").distinct().collect())
    place = lambda c: F.size(F.filter(F.array(*map(F.lit, loads)).cast("array<long>"), lambda x: x <= F.col(c)))  # noqa: E731  # 1 for the first load
    bits = range(len(loads).bit_length())
    own = facts.select(F.struct(*facts.columns).alias("_fact"), F.col(key).alias("_fk"), F.col(at).alias("_fa"), F.when(F.col(known).isNotNull(), place(known)).alias("_fn"))
    points = own.select(F.col("_fk").alias("_k"), F.col("_fa").alias("_at"), F.col("_fn").alias("_load")).where("_k is not null and _at is not null and _load > 0").distinct()
    asked = points.withColumn("_bit", F.explode(F.array(*map(F.lit, bits)).cast("array<int>"))).where("getbit(_load, _bit) = 1")
    asked = asked.withColumn("_span", F.struct("_k", F.col("_bit"), F.expr("shiftright(_load, _bit) - 1").alias("_nth")))
    rows = table.where(F.col(key).isNotNull()).select(F.col(key).alias("_rk"), "valid_from", "tie", "known_from", "value", (place("known_from") - 1).alias("_load"))
    rows = rows.withColumn("_bit", F.explode(F.array(*map(F.lit, bits)).cast("array<int>"))).where("getbit(shiftright(_load, _bit), 0) = 0")
    order = F.struct("valid_from", "tie", "known_from").alias("_order")
    rows = rows.select(F.struct(F.col("_rk").alias("_k"), "_bit", F.expr("shiftright(_load, _bit)").alias("_nth")).alias("_rspan"), "valid_from", order, F.struct(F.col("value").alias("_value")).alias("_held"))
    found = as_of(asked.select("_span", "_k", "_at", "_load"), rows.withColumnRenamed("_rspan", "_span"), "_span", "_at", "valid_from", ["_order", "_held"], tie=["_order"])
    answers = found.groupBy("_k", "_at", "_load").agg(F.max_by("_held", "_order").alias("_held"))
    joined = own.join(answers, (F.col("_fk") == F.col("_k")) & (F.col("_fa") == F.col("_at")) & (F.col("_fn") == F.col("_load")), "left")
    return joined.select(*[F.col("_fact")[c].alias(c) for c in facts.columns], F.col("_held._value").alias(name))
