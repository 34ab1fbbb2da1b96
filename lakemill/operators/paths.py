"""Ordered patterns over events, by a state machine whose parts can be put together.

How far a key has come in a list of steps is a state from 0 to the number of steps. The events of a
time bucket map each state that a key may be in at its start to the one at its end, so buckets are
worked on independently, and a key's maps, of a few numbers each, are applied one after the other.
The maps of stored buckets stay right when later buckets are added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.operators.ordered import bucket


def bucket_maps(events: DataFrame, key: str, at: str, tie: str, kind: str, steps: list[str], bucket_seconds: int = 86_400) -> DataFrame:
    """(key, bucket, map): the state after a key's events of a bucket for each state before them.

    Only events of a kind among the steps are gathered, those of one key and bucket in one row;
    those without a time are left out. Of events at one time the order is that of tie.
    """
    used = events.where(F.col(at).isNotNull() & F.col(kind).isin(steps))
    own = used.groupBy(key, bucket(at, bucket_seconds).alias("bucket")).agg(F.transform(F.array_sort(F.collect_list(F.struct(at, tie, kind))), lambda x: x[kind]).alias("kinds"))
    wanted = F.array(*map(F.lit, steps))
    step = lambda states, k: F.transform(states, lambda s: F.when((s < len(steps)) & (F.get(wanted, s) == k), s + 1).otherwise(s))
    start = F.array(*[F.lit(i) for i in range(len(steps) + 1)])
    return own.select(key, "bucket", F.aggregate("kinds", start, step).alias("map"))


def steps_reached(keys: DataFrame, maps: DataFrame, key: str) -> DataFrame:
    """Each key of keys with how many of the steps it has taken in their order, other events between them or not."""
    along = maps.groupBy(F.col(key).alias("_k")).agg(F.array_sort(F.collect_list(F.struct("bucket", "map"))).alias("m"))
    reached = along.select("_k", F.aggregate("m", F.lit(0), lambda s, x: F.get(x["map"], s)).alias("n"))
    return keys.select(key).distinct().join(reached, F.col(key).eqNullSafe(F.col("_k")), "left").select(key, F.coalesce("n", F.lit(0)).alias("steps"))
