"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on every row that the stage before it kept, and is
written as Parquet and read again before the next. All but the last return the columns of
documents. SQL can't express the classifier, SimHash or retrieval packing, so ORACLE_SQL is None;
tests hold each stage against a brute-force version.

Defined cases, for all stages: a null text is an empty one; a null id is an id like any other, but near
dedup keeps no row with one unless a group has null ids only (then it keeps all rows with one); very long texts are whole; repeated
rows are copies; extra columns stay, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakemill.llm.common import stored, table
from lakemill.llm.exact_dedup import drop_exact_copies
from lakemill.llm.mixing import mixed_documents
from lakemill.llm.packing import pack
from lakemill.llm.quality import keep_quality
from lakemill.llm.simhash import drop_near_copies

ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, fitted on these documents' labels, scores at 0.3 or more; ties of scores are kept or dropped together."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of 4 or fewer differing bits connect, the one with the smallest id."""
    return drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix in slot order; a document may come up to three times, or in part."""
    return mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens; equal BM25 scores go to the first in the shard's order."""
    return pack(docs)


STAGES = [("quality", quality_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage), ("mixing", mixing_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
