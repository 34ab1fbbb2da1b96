"""Joins in which a few keys hold a large part of the rows.

Adaptive execution splits large partitions of a sort-merge join, but only by whole map outputs, and
not where an aggregation or window on the key follows. Here frequent keys are found by an exact
count, which is added up before the shuffle, and only their rows are treated: those of the left side
are dealt over as many salts as they fill tasks, and the right side's rows of the key are copied to
each salt. Other keys have one salt, so nothing of theirs is copied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frequent_keys(rows: DataFrame, key: str, task_rows: int) -> DataFrame:
    """Keys (_key) with more than task_rows rows and the salts (_salts) that they are dealt over; at most rows / task_rows of them."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    return counts.where(F.col("_n") > task_rows).select("_key", F.ceil(F.col("_n") / task_rows).cast("int").alias("_salts"))


def salted_join(left: DataFrame, right: DataFrame, key: str, right_key: str, how: str = "inner", task_rows: int = 1_000_000) -> DataFrame:
    """left joined with right where key = right_key, all columns of both; how is inner, left, left_semi or left_anti.

    Frequent keys of left are spread: none of its tasks gets much more than task_rows rows of one
    key. Rows of left with a null key match nothing, and are spread too, as left and left_anti keep
    them. Equal left rows of a frequent key share a salt only if they are equal in all columns.
    Column names of the two must differ.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join can't be {how}")
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if clash:
        raise ValueError(f"both sides have columns {sorted(clash)}")
    heavy = F.broadcast(frequent_keys(left, key, task_rows))  # at most rows / task_rows; else both sides would be dealt by the bare key first
    plain = [c for c, kind in left.dtypes if "map<" not in kind and "variant" not in kind]
    spread = F.xxhash64(*plain)
    dealt = left.select(F.struct(*left.columns).alias("_left"), F.col(key).alias("_lk"), spread.alias("_hash"))
    # A null key joins no count; it is given a salt of its own per row hash so that such rows don't meet in one task.
    dealt = dealt.join(heavy, F.col("_lk") == F.col("_key"), "left").select("_left", "_lk", F.when(F.col("_lk").isNull(), F.col("_hash")).otherwise(F.pmod("_hash", F.coalesce("_salts", F.lit(1)).cast("long"))).alias("_salt"))
    copied = right.where(F.col(right_key).isNotNull()).select(F.struct(*right.columns).alias("_right"), F.col(right_key).alias("_rk"))
    copied = copied.join(heavy, F.col("_rk") == F.col("_key"), "left").select("_right", "_rk", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)).cast("long") - 1)).alias("_rsalt"))
    joined = dealt.join(copied, (F.col("_lk") == F.col("_rk")) & (F.col("_salt") == F.col("_rsalt")), how)
    columns = [F.col("_left")[c].alias(c) for c in left.columns]
    return joined.select(*columns, *([F.col("_right")[c].alias(c) for c in right.columns] if how in ("inner", "left") else []))
