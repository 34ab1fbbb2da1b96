"""Helpers that the operators of this package share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.sources.formats import shared_dir

WHITESPACE = re.compile(rb"[\x20\x09-\x0d]")
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder as Parquet and read again; smaller on disk than a checkpoint."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like name that df doesn't have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def text_bytes(column: str = "text"):
    """Whole text as UTF-8 bytes; null is empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def word_runs(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists that cover about size bytes each."""
    start = 0
    while start < len(text):
        end = start + size
        if end < len(text):
            gap = WHITESPACE.search(text, end)
            end = gap.start() if gap else len(text)
        yield text[start:end].split()
        start = end


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most n-1 links (node, least node of its component) that connect what the links a-b connect."""
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = where[: len(a)], where[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], least)
        np.minimum.at(new, label[y], least)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b): rows (node, root), root the least node.

    Alternating large-star and small-star rounds of joins and aggregations. Edges stay
    distributed; only a row count and a checksum come to the driver to see whether a round
    changed anything. Nodes without an edge to another node aren't returned.
    """

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    kind = dict(edges.dtypes)["a"]
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    was, seen = None, mark(now)
    while seen != was:
        both = now.union(now.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("w"))
        large = both.join(least, "u").where("v > u and v <> w").select(F.col("v").alias("a"), F.col("w").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("w"))
        now = cut(large.join(low, "a").select(F.when(F.col("b") == F.col("w"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("w").alias("b")).distinct())
        was, seen = seen, mark(now)
    roots = now.select("b").distinct()
    return now.select(F.col("a").cast(kind).alias("node"), F.col("b").cast(kind).alias("root")).union(roots.select(F.col("b").cast(kind).alias("node"), F.col("b").cast(kind).alias("root")))
