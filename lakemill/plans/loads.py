"""Loads composed of the operators: a dimension kept as versions of Parquet files, a fact table as batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakemill.operators import bitemporal, dimensions, lookups
from lakemill.sources.formats import append, merged_upto, read_appended, read_version, versions, write_version


def load_dimension(spark: SparkSession, path: str, snapshot: DataFrame, key: str) -> DataFrame:
    """Upserts a snapshot into the dimension at path; gives how many keys changed in which way.

    Keys that the snapshot lacks stay in the dimension and count as D.
    """
    present = read_version(spark, path)
    if present is None:
        present = snapshot.limit(0)
    changes = dimensions.snapshot_diff(present, snapshot, key).groupBy("change").count()
    write_version(dimensions.upsert(present, snapshot, key), path)
    return changes


def load_facts(spark: SparkSession, path: str, facts: DataFrame, fact_key: str, dimension: DataFrame, key: str, unknown: int = -1, load: int | None = None) -> bool:
    """Appends facts to the table at path, with the unknown member where the dimension lacks their key; read it by `read_appended`.

    A load with a number is added once, however often it is tried again. Whether it was added.
    """
    return append(lookups.with_unknown(facts, dimension, fact_key, key, unknown), path, load)


def load_changes(spark: SparkSession, path: str, changes: DataFrame, key: str, at: str, value: str, tie: str, load: int) -> bool:
    """Adds a load of changes to the two-time history at path (see `bitemporal`); whether it was added.

    Loads have ascending numbers from 0; one that is tried again changes nothing, and one below a
    later load is an error, as what was known then can't change any more.
    """
    done = max([merged_upto(spark, path), *versions(spark, path)])
    if load < done and load not in versions(spark, path) and load > merged_upto(spark, path):
        raise ValueError(f"load {load} comes after load {done}")
    if load <= done:
        return False
    return append(bitemporal.opened(read_appended(spark, path), changes, key, at, value, tie, load), path, load)
