"""Streaming ingest of facts."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.operators.summaries import partials, summed
from lakemill.sources.formats import append, merged_upto, read_appended, read_note, versions, write_note

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_files(spark: SparkSession, path: str, schema, at: str, lateness: str, files_per_trigger: int = 64) -> DataFrame:
    """Parquet files as a stream with event time at (a timestamp without zone becomes one in the session's zone)."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return rows.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, lateness)


def _checkpointed(spark: SparkSession, checkpoint: str) -> str | None:
    """The id of the stream whose checkpoint this is, or None."""
    found = read_note(spark, f"{checkpoint}/metadata")
    return json.loads(found)["id"] if found else None


def drain_into(rows: DataFrame, path: str, checkpoint: str, batch_of: Callable[[DataFrame, int], DataFrame] = lambda batch, number: batch, mode: str = "append") -> list[dict]:
    """Drains a stream into the table of appended batches at path; the progress of its triggers.

    Each batch is written under its number, once: one that is run again after a failure changes
    nothing. State is kept in RocksDB, on disk. The table belongs to one checkpoint, noted beside
    it. A stream with another one, or with none where the table has rows already, would number its
    batches anew, and batches of known numbers would be passed over; that is an error.
    """
    spark = rows.sparkSession
    owner, present = read_note(spark, f"{path}/_stream"), _checkpointed(spark, checkpoint)
    filled = bool(versions(spark, path)) or merged_upto(spark, path) >= 0
    if (owner or filled) and (present is None or present != (owner or present)):
        raise ValueError(f"the batches at {path} come from another checkpoint than {checkpoint}")

    def add(batch: DataFrame, number: int) -> None:
        append(batch_of(batch, number), path, number)

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    query = rows.writeStream.foreachBatch(add).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).queryName(f"drain-{uuid.uuid4().hex[:8]}").start()
    if owner is None:
        write_note(spark, f"{path}/_stream", query.id)
    query.awaitTermination()
    return [p if isinstance(p, dict) else json.loads(p.json) for p in query.recentProgress]


def totals_into(stream: DataFrame, key: str, window: tuple[str, str], value, once: list[str], path: str, checkpoint: str) -> None:
    """Drains the stream: drops repeats of the columns once, and adds each batch's sums and counts by key and time window to the table at path.

    A batch writes its own sums only, so the table so far isn't written again. `totals` adds them up.
    """
    rows = stream.dropDuplicatesWithinWatermark(once).withColumn("bucket", F.concat_ws("|", F.date_format(F.window(*window)["start"], "yyyy-MM-dd HH:mm:ss"), F.col(key)))
    drain_into(rows, path, checkpoint, lambda batch, _: partials(batch, "bucket", value))


def totals(spark: SparkSession, path: str) -> DataFrame:
    """The totals that `totals_into` has gathered at path: bucket, total, n."""
    return summed(read_appended(spark, path, "bucket string, total decimal(28,2), n long"), "bucket")
