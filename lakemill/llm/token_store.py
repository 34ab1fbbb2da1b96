"""Token-id output in byte planes.

A store is a folder of Parquet files. Each row is a chunk of whole documents: its ids lie in
blocks of BLOCK ids (the last of a chunk is shorter), a block is transposed into four byte
planes, and each plane is compressed with zstandard by itself. The row's other columns are the
chunk index: part and chunk number, ids before the chunk in its part, the documents with their
id counts. Parts follow each other in ascending doc_id order, as do the chunks of a part, so
the start of a document is the ids of all parts before it, plus those before it in its part.

Documents are dealt into parts by ranges of id and text hash. A lost task writes its part
again; Spark's commit protocol keeps one copy.

Defined cases: a null or empty text is its end id alone; rows that repeat an id are stored
one after the other in order of text hash; null ids come first; an empty table gives an empty
store; other columns are not stored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakemill.llm.common import scratch_path, shuffle_partitions, table
from lakemill.llm.tokens import default_path, encoder

BLOCK = 1 << 16
CHUNK = 1 << 18
FIELDS = [("part", pa.int32()), ("chunk", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("planes", pa.list_(pa.binary()))]
SCHEMA = "part int, chunk int, before long, n_ids long, doc_ids array<long>, doc_tokens array<long>, planes array<binary>"


def to_planes(ids: bytes, level: int = 3) -> list[bytes]:
    """Compressed byte planes of little-endian 32-bit ids, four for each block."""
    press = zstandard.ZstdCompressor(level=level)
    octets = np.frombuffer(ids, np.uint8).reshape(-1, 4)
    return [press.compress(np.ascontiguousarray(octets[i : i + BLOCK, k]).tobytes()) for i in range(0, len(octets), BLOCK) for k in range(4)]


def from_planes(planes: list[bytes]) -> bytes:
    """The ids that to_planes took."""
    expand = zstandard.ZstdDecompressor()
    blocks = []
    for i in range(0, len(planes), 4):
        own = [np.frombuffer(expand.decompress(x), np.uint8) for x in planes[i : i + 4]]
        blocks.append(np.stack(own, axis=1).tobytes())
    return b"".join(blocks)


def write_ids(docs: DataFrame, path: str, end_id: int = 2, tokenizer: str | None = None, special_as_text: bool = False) -> None:
    """Encodes whole texts, appends end_id to each, and writes a store to path. See `tokens` for special_as_text."""
    vocabulary = tokenizer or default_path()
    end = np.array([end_id], "<u4").tobytes()

    def chunks(batches):
        part, chunk, before = 0, 0, 0
        ids, doc_ids, counts, held = [], [], [], 0

        def row():
            flat = b"".join(ids)
            values = [[part], [chunk], [before], [len(flat) // 4], [doc_ids], [counts], [to_planes(flat)]]
            return pa.RecordBatch.from_arrays([pa.array(v, kind) for v, (_, kind) in zip(values, FIELDS, strict=True)], [name for name, _ in FIELDS])

        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
            for i in range(0, batch.num_rows, 500):
                some = batch.slice(i, 500)
                for doc_id, raw in zip(some.column("doc_id").to_pylist(), encoder(vocabulary, special_as_text).encode(some.column("text").to_pylist()), strict=True):
                    ids.append(raw + end)
                    doc_ids.append(doc_id)
                    counts.append(len(raw) // 4 + 1)
                    held += counts[-1]
                    if held >= CHUNK:
                        yield row()
                        chunk, before = chunk + 1, before + held
                        ids, doc_ids, counts, held = [], [], [], 0
        if held:
            yield row()

    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    dealt.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(chunks, SCHEMA).write.option("compression", "uncompressed").parquet(path)


def _documents(batches):
    for batch in batches:
        for row in batch.to_pylist():
            flat, counts = from_planes(row["planes"]), np.array(row["doc_tokens"], np.int64)
            ends = np.cumsum(counts)
            starts = ends - counts
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["part"]] * len(counts), pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["before"]), pa.array(counts), pa.array([flat[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary())],
                ["part", "doc_id", "local", "n_tokens", "ids"],
            )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a store, from its files: doc_id, start (ids before it), n_tokens, ids (little-endian 32-bit).

    The broadcast table has one row a part; parts are as many as the tasks that wrote the store.
    """
    store = spark.read.schema(SCHEMA).parquet(path)
    parts = store.groupBy("part").agg(F.sum("n_ids").alias("m"))
    bases = parts.select("part", (F.sum("m").over(W.orderBy("part")) - F.col("m")).alias("base"))
    found = store.select("part", "before", "doc_ids", "doc_tokens", "planes").mapInArrow(_documents, "part int, doc_id long, local long, n_tokens long, ids binary")
    return found.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), path)
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
