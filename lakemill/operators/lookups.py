"""Lookups of facts in dimensions and in other events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, right_at: str, values: list[str], bucket_seconds: int = 86_400, tie: list[str] | None = None) -> DataFrame:
    """left with the values of the latest right row of its key whose right_at is not after at; null where there is none.

    left may have no column named like a value; rename it first. Every left row comes out; one without a key or a time has nulls, and right rows without
    either match nothing. Of right rows at one time the one with the greatest tie columns
    (unless given, the values) counts, whatever the partitioning.

    Rows are ordered within a key's time buckets, and what earlier buckets end with is carried
    in from one row a bucket, so that a key with many rows spreads over its buckets.
    """

    clash = {c.lower() for c in left.columns} & {v.lower() for v in values}
    if clash:
        raise ValueError(f"both sides have columns {sorted(clash)}")

    def bucket(c: str) -> Column:
        return F.floor(F.unix_timestamp(F.col(c).cast("timestamp")) / bucket_seconds)

    known = F.col(key).isNotNull() & F.col(at).isNotNull()
    found_row, tie_row = F.struct(*values), F.struct(*(tie or values))
    shape = right.select(found_row.alias("r"), tie_row.alias("t")).schema
    nothing = [F.lit(None).cast(shape[c].dataType).alias(name) for c, name in (("r", "_r"), ("t", "_tie"))]
    l = left.where(known).select(F.col(key).alias("_k"), F.col(at).alias("_t"), bucket(at).alias("_b"), F.struct(*left.columns).alias("_l"), *nothing)
    r = right.where(F.col(key).isNotNull() & F.col(right_at).isNotNull()).select(F.col(key).alias("_k"), F.col(right_at).alias("_t"), bucket(right_at).alias("_b"), F.lit(None).cast(l.schema["_l"].dataType).alias("_l"), found_row.alias("_r"), tie_row.alias("_tie"))
    within = W.partitionBy("_k", "_b").orderBy("_t", F.col("_l").isNotNull(), "_tie")
    rows = l.unionByName(r).withColumn("_own", F.last("_r", ignorenulls=True).over(within)).where("_l is not null")
    some = ["_k", "_b", "_t", "_r", "_tie"]
    ends = l.select(some).unionByName(r.select(some)).groupBy("_k", "_b").agg(F.max_by("_r", F.when(F.col("_r").isNotNull(), F.struct("_t", "_tie"))).alias("_end"))
    carried = ends.select("_k", "_b", F.last("_end", ignorenulls=True).over(W.partitionBy("_k").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)).alias("_carried"))
    found = rows.join(carried, ["_k", "_b"]).select("_l", F.coalesce("_own", "_carried").alias("_v"))
    rest = left.where(~known).select(F.struct(*left.columns).alias("_l"), F.lit(None).cast(shape["r"].dataType).alias("_v"))
    return found.unionByName(rest).select(*[F.col("_l")[c].alias(c) for c in left.columns], *[F.col("_v")[v].alias(v) for v in values])


def point_in_time(facts: DataFrame, past: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """facts with the value of the history row (from `dimensions.history`) in force at their time.

    Histories have no gaps after a key's first row, so the row in force is the latest begun.
    """
    return as_of(facts, past, key, at, "valid_from", [value])


def with_unknown(facts: DataFrame, dimension: DataFrame, fact_key: str, key: str, unknown: int = -1) -> DataFrame:
    """facts with fact_key replaced by unknown where dimension lacks it."""
    known = dimension.select(F.col(key).alias("_known")).distinct()
    return facts.join(known, F.col(fact_key) == F.col("_known"), "left").withColumn(fact_key, F.coalesce("_known", F.lit(unknown).cast(dict(facts.dtypes)[fact_key]))).drop("_known")
