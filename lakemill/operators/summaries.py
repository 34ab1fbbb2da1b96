"""Summaries: balances by period, totals at several levels, mergeable aggregates, sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def monthly_balance(keys: DataFrame, moves: DataFrame, key: str, at: str, amount: Column) -> DataFrame:
    """A row for each key and month from the first to the last month of moves: what moved, and the balance at its end."""
    month = F.trunc(F.col(at).cast("date"), "month")
    first, last = moves.agg(F.min(month)).scalar(), moves.agg(F.max(month)).scalar()
    scaffold = keys.select(key, F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("month"))
    moved = moves.groupBy(key, month.alias("month")).agg(F.sum(amount).alias("moved"))
    rows = scaffold.join(moved, [key, "month"], "left").withColumn("moved", F.coalesce("moved", F.lit(0)))
    return rows.withColumn("balance", F.sum("moved").over(W.partitionBy(key).orderBy("month").rowsBetween(W.unboundedPreceding, 0)))


def partials(rows: DataFrame, key: str, value: Column) -> DataFrame:
    """Sum and count by key, which add up over loads; an average doesn't."""
    return rows.groupBy(key).agg(F.sum(value).alias("total"), F.count(value).alias("n"))


def merged(stored: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Partials of two loads as one."""
    return summed(stored.unionByName(delta), key)


def summed(parts: DataFrame, key: str) -> DataFrame:
    """Partials of any number of loads as one."""
    return parts.groupBy(key).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def sessions(events: DataFrame, key: str, at: str, gap: str) -> DataFrame:
    """Sessions of a key's events that follow each other within gap: first, last, n_events."""
    return events.groupBy(key, F.session_window(at, gap)).agg(F.min(at).alias("first_ts"), F.max(at).alias("last_ts"), F.count("*").alias("n_events")).drop("session_window")
