"""Readers of the input tables."""

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table name below sf_dir, which may be any path that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
