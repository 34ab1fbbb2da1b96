"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

Slot i of the schedule has the point frac(i * golden ratio), in 32-bit integer arithmetic. The
cumulative target shares of the sources cut [0, 1) into intervals, and a point's interval names
the slot's source, so every stretch of the schedule has nearly the target proportions. The
slots of a source are ranked; the k-th takes the k-th of the equal blocks into which the
source's words, in shuffled document order and repeated end to end, are cut.

Ranks and word positions are prefix sums in two levels (sums of small buckets, then within a
bucket), so no source has to fit into one task. Points meet intervals by an equi-join on cells
of [0, 1). Only tables with one row a source go through an unpartitioned window.

The rows of the mix come in slot order: each copy of a document at the slot that its first word
falls into, so that every stretch of the output has nearly the target proportions.

Defined cases: a null or empty text has size 0 and nothing is taken from it; a null source is
a source of its own, last; rows that repeat an id are taken as separate documents; without
words all targets are 0; equal shuffle keys are ordered by id, size and text hash; a very long
text fills many blocks; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakemill.llm.common import WORD, cut, fresh, stored, table

#: 2^32 divided by the square of the golden ratio, rounded to an odd number.
STEP = 1640531527
CELLS = 4096
RUN = 4096


def source_targets(light: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """One row a source: rank s, source, source_size, target, words (target, rounded), interval [lo, hi) of its share."""
    n = len(weights)
    sources = light.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sources.withColumn("s", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("s") - 1) % n + 1))
    cap = F.col("source_size") * max_epochs
    by_ratio = W.orderBy((cap.cast("double") / F.col("weight")), "s")
    everything = W.partitionBy()
    level = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("spent", F.coalesce(F.sum(cap).over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("lam", (F.col("total") - F.col("spent")).cast("double") / F.col("rest"))
        .withColumn("k", F.row_number().over(by_ratio))
    )
    first = F.min(F.when(F.col("lam") <= cap.cast("double") / F.col("weight"), F.struct("k", "lam"))).over(everything)
    aimed = level.withColumn("lam", first["lam"]).withColumn("target", F.when(cap.cast("double") / F.col("weight") < F.col("lam"), cap.cast("double")).otherwise(F.col("lam") * F.col("weight")))
    before = F.coalesce(F.sum("target").over(W.orderBy("s").rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    return aimed.select("s", "source", "source_size", "target", F.floor(F.col("target") + 0.5).alias("words"), F.try_divide(before, F.col("total")).alias("lo"), F.try_divide(before + F.col("target"), F.col("total")).alias("hi"))


def schedule(sources: DataFrame, slots: int) -> DataFrame:
    """Slots (slot, s, r, n): r, from 0, is the slot's rank among the n of source s. A source with words has one at least."""
    spark = sources.sparkSession
    share = sources.where("words > 0").select("s", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1)))).alias("cell"))
    point = ((F.col("id") % (1 << 32)) * STEP % (1 << 32)) / F.lit(float(1 << 32))
    points = spark.range(slots).select(F.col("id").alias("slot"), point.alias("point")).withColumn("cell", F.floor(F.col("point") * CELLS))
    own = points.join(share, "cell").where("point >= lo and point < hi").select("slot", "s", F.expr(f"slot div {RUN}").alias("run"))
    runs = own.groupBy("s", "run").agg(F.count("*").alias("m"))
    before = runs.select("s", "run", (F.sum("m").over(W.partitionBy("s").orderBy("run")) - F.col("m")).alias("before"))
    counts = sources.where("words > 0").select("s").join(runs.groupBy("s").agg(F.sum("m").alias("n")), "s", "left")
    ranked = own.join(before, ["s", "run"]).select("slot", "s", (F.col("before") + F.row_number().over(W.partitionBy("s", "run").orderBy("slot")) - 1).alias("r"))
    late = counts.where("n is null").select((F.col("s") + slots).alias("slot"), "s", F.lit(0).cast("long").alias("r"))
    return ranked.union(late).join(counts.select("s", F.coalesce("n", F.lit(1)).alias("n")), "s")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, block_words: int = 1024) -> dict[str, DataFrame]:
    """The mix of docs: 'sources' (targets), 'schedule' (slot, s, doc_id, first, words: what each slot takes),
    'copies' (doc_id, source, text_key, size, epoch, slot of its first word, words) and 'taken' (a row for each row of docs).

    Words of a document are taken from its start up to `words` in each epoch of its source;
    no document is taken more than max_epochs times.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    light = stored(docs.select("doc_id", F.col("source").cast("string").alias("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), key.alias("key"), F.xxhash64("text").alias("text_key")), "sizes")
    n_docs, total = light.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    sources = cut(source_targets(light, weights, max_epochs))
    slots = cut(schedule(sources, max(math.ceil(total / block_words), 32 * sources.count())))

    digits = max(1, math.ceil(math.log(max(1, n_docs / 5000), 16)))
    light = light.withColumn("bucket", F.substring("key", 1, digits))
    buckets = light.groupBy("source", "bucket").agg(F.sum("size").alias("m")).withColumnRenamed("source", "b_source").withColumnRenamed("bucket", "b_bucket")
    buckets = buckets.join(sources.drop("lo", "hi"), F.col("b_source").eqNullSafe(F.col("source"))).drop("source")
    buckets = buckets.withColumn("base", F.sum("m").over(W.partitionBy("s").orderBy("b_bucket")) - F.col("m"))
    placed = light.join(buckets, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
    within = W.partitionBy("s", "bucket").orderBy("key", F.col("doc_id").asc_nulls_first(), "size", "text_key").rowsBetween(W.unboundedPreceding, 0)
    placed = placed.select("doc_id", "s", "size", "text_key", "source_size", "target", "words", (F.col("base") + F.sum("size").over(within) - F.col("size")).alias("at"))

    counts = slots.groupBy("s").agg(F.first("n").alias("n"))
    at = F.col("at") + F.col("epoch") * F.col("source_size")
    block = lambda x: F.floor(x.cast("double") * F.col("n") / F.col("words"))
    pieces = (
        placed.where("size > 0 and words > 0")
        .join(counts, "s")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
        .withColumn("from", at)
        .withColumn("to", F.least(at + F.col("size"), F.col("words")))
        .where("`from` < `to`")
        .withColumn("r", F.explode(F.sequence(F.greatest(block(F.col("from")) - 1, F.lit(0)), F.least(block(F.col("to")) + 1, F.col("n") - 1))))
    )
    edge = lambda r: F.when(r >= F.col("n"), F.col("words")).otherwise(F.floor(r.cast("double") * F.col("words") / F.col("n")))
    lo, hi = F.greatest("from", edge(F.col("r"))), F.least("to", edge(F.col("r") + 1))
    plan = pieces.where(lo < hi).join(slots.select("slot", "s", "r"), ["s", "r"]).select("slot", "s", "doc_id", "size", "text_key", "at", "epoch", (lo - F.col("from")).alias("first"), (hi - lo).alias("n_words"))
    key = ("s", "at", "doc_id", "size", "text_key")
    copies = plan.groupBy(*key, "epoch").agg(F.sum("n_words").alias("words"), F.min("slot").alias("slot"), F.max("slot").alias("last_slot"))
    takes = copies.groupBy(*key).agg(F.sum("words").alias("n_words"), F.min("slot").alias("first_slot"), F.max("last_slot").alias("last_slot")).select("n_words", "first_slot", "last_slot", *[F.col(c).alias(f"t_{c}") for c in key])
    copies = copies.join(sources.select("s", "source"), "s").select("doc_id", "source", "text_key", "size", "epoch", "slot", "words")
    same = functools.reduce(operator.and_, [F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in key])
    taken = placed.join(takes, same, "left").select("doc_id", "size", "source_size", "target", F.coalesce("n_words", F.lit(0)).cast("long").alias("taken"), "first_slot", "last_slot")
    return {"sources": sources, "schedule": plan.select("slot", "s", "doc_id", "first", F.col("n_words").alias("words")), "copies": copies, "taken": taken}


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of the mix in slot order, with the columns of docs: a document taken k and a part times gives k whole rows and one of its first words.

    The part's words are joined by single spaces. Of rows that repeat an id, a text and a source
    one gives the other columns for all their copies. n_chars, where docs has it, is that of the new text.
    """
    k, h = fresh(docs, "mix"), fresh(docs, "hash")
    copies = mix(docs)["copies"].select(F.struct("doc_id", "source", "text_key", "size", "slot", "words").alias(k))
    whole = docs.withColumn(h, F.xxhash64("text"))
    if not docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        whole = whole.dropDuplicates(["doc_id", h, "source"])
    same = F.col("doc_id").eqNullSafe(F.col(f"{k}.doc_id")) & (F.col(h) == F.col(f"{k}.text_key")) & F.col("source").cast("string").eqNullSafe(F.col(f"{k}.source"))
    cut_text = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col(f"{k}.words").cast("int")), " ")
    rows = whole.join(copies, same).withColumn("text", F.when(F.col(f"{k}.words") == F.col(f"{k}.size"), F.col("text")).otherwise(cut_text))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return rows.orderBy(f"{k}.slot", f"{k}.doc_id", f"{k}.text_key").select(docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))["taken"]


ORACLE = r"""
WITH light AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS key,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS s FROM light GROUP BY source),
weighed AS (SELECT *, (s - 1) % 3 + 1 AS weight, CAST(3 * source_size AS DOUBLE) / ((s - 1) % 3 + 1) AS ratio FROM ranked),
levels AS (
  SELECT *, row_number() OVER (ORDER BY ratio, s) AS k,
    CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY ratio, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / sum(weight) OVER (ORDER BY ratio, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lam FROM weighed),
aimed AS (
  SELECT source, s, source_size, CASE WHEN ratio < (SELECT arg_min(lam, k) FROM levels WHERE lam <= ratio) THEN CAST(3 * source_size AS DOUBLE)
    ELSE (SELECT arg_min(lam, k) FROM levels WHERE lam <= ratio) * weight END AS target FROM levels),
placed AS (
  SELECT doc_id, s, size, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS words,
    CAST(sum(size) OVER (PARTITION BY s ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - size AS pos
  FROM light JOIN aimed ON light.source IS NOT DISTINCT FROM aimed.source),
counts AS (
  SELECT count(*) AS n_sources, greatest(ceil((SELECT coalesce(sum(size), 0) FROM light) / 1024.0), 32 * count(*)) AS slots FROM aimed),
shares AS (
  SELECT s, CAST(floor(target + 0.5) AS BIGINT) AS words, coalesce(sum(target) OVER b, 0) / (SELECT sum(size) FROM light) AS lo,
    (coalesce(sum(target) OVER b, 0) + target) / (SELECT sum(size) FROM light) AS hi FROM aimed
  WINDOW b AS (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
dealt AS (
  SELECT slot, s, words, row_number() OVER (PARTITION BY s ORDER BY slot) - 1 AS r, count(*) OVER (PARTITION BY s) AS n
  FROM (SELECT i AS slot, CAST((i % 4294967296) * 1640531527 % 4294967296 AS DOUBLE) / 4294967296.0 AS point FROM range((SELECT CAST(slots AS BIGINT) FROM counts)) t(i))
  JOIN shares ON point >= lo AND point < hi WHERE words > 0),
blocks AS (
  SELECT slot, s, CAST(floor(CAST(r AS DOUBLE) * words / n) AS BIGINT) AS lo, CASE WHEN r + 1 = n THEN words ELSE CAST(floor(CAST(r + 1 AS DOUBLE) * words / n) AS BIGINT) END AS hi FROM dealt
  UNION ALL SELECT s + (SELECT CAST(slots AS BIGINT) FROM counts), s, 0, words FROM shares WHERE words > 0 AND s NOT IN (SELECT s FROM dealt)),
pieces AS (
  SELECT p.*, e, pos + e * source_size AS a, least(pos + e * source_size + size, words) AS b FROM placed p, (VALUES (0), (1), (2)) t(e)),
taken AS (
  SELECT doc_id, s, pos, size, source_size, target, CAST(sum(greatest(0, b - a)) AS BIGINT) AS taken, min(a) FILTER (b > a) AS head, max(b - 1) FILTER (b > a) AS tail
  FROM pieces GROUP BY ALL)
SELECT t.doc_id, t.size, t.source_size, t.target, t.taken, f.slot AS first_slot, l.slot AS last_slot
FROM taken t LEFT JOIN blocks f ON f.s = t.s AND t.head >= f.lo AND t.head < f.hi LEFT JOIN blocks l ON l.s = t.s AND t.tail >= l.lo AND t.tail < l.hi"""
