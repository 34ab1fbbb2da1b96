"""Neighbours in time within a key, where a key may hold any share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def bucket(at: str, seconds: int) -> Column:
    return F.floor(F.unix_timestamp(F.col(at).cast("timestamp")) / seconds)


def with_neighbour(rows: DataFrame, key: str, at: str, tie: list[str], values: list[str], name: str, after: bool, bucket_seconds: int = 86_400) -> DataFrame:
    """rows with column name: a struct of values of the next row (or the one before) of the key in the order (at, tie); null at the end.

    Rows are ordered within time buckets of a key, and what the neighbouring bucket begins or ends
    with is carried over from one row a bucket, so a key with many rows spreads over tasks. Null is
    a key like any other; at must not be null.
    """
    order = [at, *tie]
    found = F.struct(*values)
    place = F.struct(*order)
    parts = rows.withColumn("_b", bucket(at, bucket_seconds))
    within = W.partitionBy(key, "_b").orderBy(*order)
    own = parts.withColumn("_own", F.lead(found).over(within) if after else F.lag(found).over(within))
    edge = (F.min_by if after else F.max_by)(found, place)
    ends = parts.groupBy(F.col(key).alias("_k"), F.col("_b").alias("_kb")).agg(edge.alias("_edge"))
    along = W.partitionBy("_k").orderBy("_kb")
    carried = ends.select("_k", "_kb", (F.lead("_edge") if after else F.lag("_edge")).over(along).alias("_carried"))
    joined = own.join(carried, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_b") == F.col("_kb")))
    return joined.select(*rows.columns, F.coalesce("_own", "_carried").alias(name))
