"""Hierarchies given as child and parent: every ancestor with its distance, and totals of subtrees.

The closure grows by doubling: when all pairs up to a distance of d are known, those up to 2d are a
join of the pairs at exactly d with the known ones, so a hierarchy of depth n takes log2(n) joins
and not n. A child may have several parents, and parents may form cycles.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.operators.skew import salted_join
from lakemill.sources.formats import shared_dir


def closure(edges: DataFrame, child: str, parent: str, max_depth: int | None = None, task_rows: int = 1_000_000) -> DataFrame:
    """(node, ancestor, depth): all pairs up a hierarchy, once each, with the least number of steps between them.

    A node of a cycle is an ancestor of itself, at the length of its shortest cycle; pairs further
    than max_depth apart are left out. Edges without a child or a parent are no edges, repeated
    ones count once, and other columns are ignored. A node isn't paired with itself otherwise, so
    one that is nobody's child has no row.

    Pairs that meet in an ancestor with very many descendants, as a root has, are spread over tasks
    of about task_rows. Each round's new pairs are written to the shared folder, and the next reads
    them; known pairs that it can't meet stay where they are. Up to task_rows nodes are broadcast.
    """
    if max_depth is not None and max_depth < 1:
        raise ValueError("max_depth is at least 1")
    spark = edges.sparkSession
    base = f"{shared_dir(spark)}/closure-{uuid.uuid4().hex}"
    own = edges.select(F.col(child).alias("node"), F.col(parent).alias("ancestor")).dropna().distinct()
    own.withColumn("depth", F.lit(1)).write.parquet(f"{base}/1")
    parts, reach = [f"{base}/1"], 1
    while max_depth is None or reach < max_depth:
        known, edge = spark.read.parquet(*parts), spark.read.parquet(parts[-1]).where(F.col("depth") == reach)
        if edge.isEmpty():
            break
        above = _among(known, "node", edge.select("ancestor"), task_rows).select(F.col("node").alias("_via"), F.col("ancestor").alias("_above"), F.col("depth").alias("_more"))
        if max_depth is not None:
            above = above.where(F.col("_more") <= max_depth - reach)
        met = salted_join(edge, above, "ancestor", "_via", task_rows=task_rows)
        further = met.select("node", F.col("_above").alias("ancestor"), (F.col("depth") + F.col("_more")).alias("depth"))
        # Only known pairs whose ancestor is reached again can meet the further ones. All are dealt by an exact count, without adding up before the shuffle: hardly any are equal, and a task that reads a file of millions would hold them all.
        before = _among(known, "ancestor", above.select("_above"), task_rows)
        ways = edge.groupBy("ancestor").agg(F.count("*").alias("_n")).join(above.groupBy("_via").agg(F.count("*").alias("_m")), F.col("ancestor") == F.col("_via"))
        rows = (ways.agg(F.sum(F.col("_n") * F.col("_m"))).first()[0] or 0) + before.count()
        dealt = before.unionByName(further).repartition(max(1, -(-rows // task_rows)), "node", "ancestor")
        dealt.groupBy("node", "ancestor").agg(F.min("depth").alias("depth")).where(F.col("depth") > reach).write.parquet(f"{base}/{2 * reach}")
        reach *= 2
        parts.append(f"{base}/{reach}")
    return spark.read.parquet(*parts)


def _among(rows: DataFrame, column: str, some: DataFrame, most: int) -> DataFrame:
    """The rows with one of some in column, if these are at most `most` and so can be sent to all tasks; else all rows."""
    some = some.toDF("_one").distinct()
    return rows.join(F.broadcast(some), F.col(column) == F.col("_one"), "left_semi") if some.count() <= most else rows


def cyclic(pairs: DataFrame) -> DataFrame:
    """(node, length): the nodes on cycles of a closure, with the length of the shortest cycle of each."""
    return pairs.where(F.col("node").eqNullSafe(F.col("ancestor"))).select("node", F.col("depth").alias("length"))


def subtree_totals(facts: DataFrame, key: str, measure, pairs: DataFrame) -> DataFrame:
    """(node, own, total, n_rows): the sum of measure over the facts of a node, and over those of it and all its descendants.

    pairs is a closure without a depth limit. A descendant that is reached in several ways counts
    once. Facts are added up by key before they meet the closure; those without a key are left out.
    Nodes are the keys of facts and all their ancestors; own and total are null where no fact of
    theirs has the measure.
    """
    by_key = facts.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.sum(measure).alias("own"), F.count("*").alias("n_rows"))
    up = pairs.where("node <> ancestor").join(by_key, F.col("node") == F.col("_key")).select(F.col("ancestor").alias("node"), F.lit(None).cast(by_key.schema["own"].dataType).alias("own"), F.col("own").alias("part"), "n_rows")
    own = by_key.select(F.col("_key").alias("node"), "own", F.col("own").alias("part"), "n_rows")
    return own.unionByName(up).groupBy("node").agg(F.max("own").alias("own"), F.sum("part").alias("total"), F.sum("n_rows").alias("n_rows"))
