"""Exact dedup by content-defined chunk recipes, in DataFrame operations only.

A text is cut where its own content says so: from LEAST characters after the last cut on, behind
the first six characters of which the first equals the third and the fourth the sixth, whatever
the script, and after MOST characters at the latest. In prose that is so about every 300
characters, well above LEAST, so that cuts behind an edit fall into step again soon. Equal texts
give equal chunk lists and, as the chunks concatenate to the text, different texts give different
lists. Chunks become 64-bit identifiers that are verified: the distinct pairs of identifier and SHA-256 of the chunk are formed, with partial
aggregation before the shuffle, and no identifier may have two. If one does, SHA-256 takes its
place. Documents are then grouped by their ordered identifier lists, a few hundredths of the
text; neither texts nor chunks are shuffled.

Defined cases: a null text counts as empty; an empty text is the empty list; a very long text is
a long list; of equal texts with one id each all are one group and the largest id stays; rows that repeat an id and a text form one group and are all marked kept where the id is
the largest; null ids are never larger than another id; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm.common import fresh, stored, table

LEAST, MOST = 128, 4096
CHUNK = rf"(?s).{{{LEAST - 6},{MOST - 6}}}?(.).\1(.).\2|.{{1,{MOST}}}"
IDENTIFIERS = (lambda chunk: F.xxhash64(chunk), lambda chunk: F.sha2(chunk, 256))


def chunks(text):
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def verified_identifier(texts: DataFrame, identifiers=IDENTIFIERS):
    """The first of the identifiers that has one chunk only, by SHA-256, behind each of its values."""
    for identifier in identifiers:
        chunk = F.col("chunk")
        pieces = texts.select(F.explode(chunks(F.col("text"))).alias("chunk")).select(identifier(chunk).alias("id"), F.unhex(F.sha2(chunk, 256)).alias("sha"))
        if pieces.groupBy("id", "sha").agg(F.lit(1)).groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            return identifier
    raise ValueError("no identifier tells all chunks apart")


def exact_groups(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, keep_id (largest doc_id of its equal texts), group_size, kept, text_sha256."""
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    identifier = verified_identifier(texts)
    recipes = stored(texts.select("doc_id", F.transform(chunks(F.col("text")), identifier).alias("recipe"), F.sha2("text", 256).alias("text_sha256")), "recipes")
    groups = recipes.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return recipes.join(groups, "recipe").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """docs without the rows whose text another row with a larger id has.

    Of rows that repeat both id and text one stays. The shuffle that brings texts and
    verdicts together is keyed by id, so a large group of copies spreads over all tasks.
    """
    k = fresh(docs, "kept")
    sha = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    kept = exact_groups(docs).where("kept").select(F.struct("doc_id", "text_sha256").alias(k)).distinct()
    found = docs.join(kept, F.col("doc_id").eqNullSafe(F.col(f"{k}.doc_id")) & (sha == F.col(f"{k}.text_sha256")), "left_semi")
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    return found if repeated.isEmpty() else found.withColumn(k, sha).dropDuplicates(["doc_id", k]).drop(k)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""
