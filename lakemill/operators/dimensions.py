"""Dimension loading: keys, upserts, history, snapshot differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def date_dimension(span: DataFrame, start: str, end: str) -> DataFrame:
    """One row a day from column start to column end of the one-row frame span."""
    day = span.select(F.explode(F.sequence(F.col(start).cast("date"), F.col(end).cast("date"))).alias("day"))
    return day.select(
        F.date_format("day", "yyyyMMdd").cast("int").alias("date_key"),
        "day",
        F.year("day").alias("year"),
        F.quarter("day").alias("quarter"),
        F.month("day").alias("month"),
        F.dayofmonth("day").alias("day_of_month"),
        (F.weekday("day") + 1).alias("iso_weekday"),
        (F.weekday("day") >= 5).alias("is_weekend"),
    )


def natural_key(*columns: str, bits: int = 256) -> Column:
    """A surrogate key that depends on the natural key alone, so that loads agree without a shared counter.

    Each part carries its length, and a null has a mark of its own, so that different natural
    keys are different texts before they are hashed.
    """
    part = lambda c: F.coalesce(F.concat(F.length(c), F.lit(":"), c), F.lit("-"))
    joined = F.concat_ws("|", *[part(F.col(c).cast("string")) for c in columns])
    return F.md5(joined) if bits == 128 else F.sha2(joined, bits)


def _paired(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The rows (key, o) and (key, n) joined outwards by key, where null equals null."""
    both = old.join(new.withColumnRenamed(key, "_k"), F.col(key).eqNullSafe(F.col("_k")), "full_outer")
    return both.select(F.coalesce(key, "_k").alias(key), "o", "n")


def upsert(dimension: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Type 1: a change replaces the row of its key; new keys are added. changes has one row a key; null is a key like any other."""
    others = [c for c in dimension.columns if c != key]
    old = dimension.select(key, F.struct(*others).alias("o"))
    new = changes.select(key, F.struct(*others).alias("n"))
    return _paired(old, new, key).select(key, F.coalesce("n", "o").alias("v")).select(key, "v.*")


def latest(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    return rows.withColumn("_rn", F.row_number().over(W.partitionBy(key).orderBy(*order))).where("_rn = 1").drop("_rn")


def history(log: DataFrame, key: str, at: str, value: str, tie: str) -> DataFrame:
    """Type 2 history of value by key from a change log: valid_from, valid_to (null: open), is_current.

    Repeats of a value merge. Of changes at one time the last by tie counts, so that no row has length
    zero; changes without a time are left out. A key's changes are ordered in one task (see
    `bitemporal` for keys of any size).
    """
    log = log.where(F.col(at).isNotNull())
    order = W.partitionBy(key).orderBy(at, tie)
    last = log.withColumn("_next", F.lead(at).over(order)).where(F.col("_next").isNull() | (F.col("_next") > F.col(at)))
    changed = last.withColumn("_before", F.lag(F.struct(value)).over(order)).where(F.col("_before").isNull() | ~F.col("_before")[value].eqNullSafe(F.col(value)))
    out = changed.select(key, value, F.col(at).alias("valid_from"), F.lead(at).over(order).alias("valid_to"))
    return out.withColumn("is_current", F.col("valid_to").isNull())


def change_points(log: DataFrame, key: str, at: str, value: str, tie: str) -> DataFrame:
    """The changes that a history is made of, repeats of a value too: at each time the last by tie. Keep these to merge later logs; changes without a time are left out."""
    timed = log.where(F.col(at).isNotNull())
    return timed.groupBy(key, at).agg(F.max(F.struct(tie, value)).alias("v")).select(key, at, F.col(f"v.{value}").alias(value), F.col(f"v.{tie}").alias(tie))


def merge_points(points: DataFrame, log: DataFrame, key: str, at: str, value: str, tie: str) -> DataFrame:
    """points with a further change log, as `change_points` would give them for all changes, in whatever order they come."""
    return change_points(points.unionByName(log.select(points.columns)), key, at, value, tie)


def merge_history(past: DataFrame, points: DataFrame, log: DataFrame, key: str, at: str, value: str, tie: str) -> DataFrame:
    """The history past, whose change points are points, with a further change log: what `history` gives for all changes.

    Late changes may lie anywhere. Rows of keys that the log doesn't touch stay as they are; those
    of others are formed again from their points.
    """
    keys = log.select(F.col(key).alias("_k")).distinct()
    touched = F.col(key).eqNullSafe(F.col("_k"))
    again = merge_points(points.join(keys, touched, "left_semi"), log, key, at, value, tie)
    return past.join(keys, touched, "left_anti").unionByName(history(again, key, at, value, tie).select(past.columns))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """change by key between two snapshots: I(nsert), U(pdate), D(elete) or S(ame); nulls equal nulls, in keys too."""
    others = [c for c in old.columns if c != key]
    o, n = old.select(key, F.struct(*others).alias("o")), new.select(key, F.struct(*others).alias("n"))
    kind = F.when(F.col("o").isNull(), "I").when(F.col("n").isNull(), "D").when(F.col("o").eqNullSafe(F.col("n")), "S").otherwise("U")
    return _paired(o, n, key).select(key, kind.alias("change"))


def placeholders(dimension: DataFrame, facts: DataFrame, key: str, fact_key: str) -> DataFrame:
    """dimension with is_placeholder, and a row of nulls for each key that only facts have; an upsert replaces it later."""
    late = facts.select(F.col(fact_key).alias(key)).where(F.col(key).isNotNull()).distinct().join(dimension, key, "left_anti")
    return dimension.withColumn("is_placeholder", F.lit(False)).unionByName(late.withColumn("is_placeholder", F.lit(True)), allowMissingColumns=True)
