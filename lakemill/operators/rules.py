"""Data-quality rules: each gives one row, (rule, n_bad)."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row(name: str, bad: DataFrame) -> DataFrame:
    return bad.agg(F.count("*").alias("n_bad")).select(F.lit(name).alias("rule"), "n_bad")


def unique(name: str, rows: DataFrame, *key: str) -> DataFrame:
    """Rows whose key another row has."""
    return rows.groupBy(*key).agg(F.count("*").alias("m")).where("m > 1").agg(F.coalesce(F.sum("m"), F.lit(0)).cast("long").alias("n_bad")).select(F.lit(name).alias("rule"), "n_bad")


def foreign_key(name: str, rows: DataFrame, column: str, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose column isn't null and isn't a key of parents."""
    return _row(name, rows.where(F.col(column).isNotNull()).join(parents.select(F.col(key).alias("_p")), F.col(column) == F.col("_p"), "left_anti"))


def holds(name: str, rows: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is false or null."""
    return _row(name, rows.where(~F.coalesce(condition, F.lit(False))))


def report(*rules: DataFrame) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, rules)
