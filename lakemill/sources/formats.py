"""Reading and writing files, and tables kept as versions of Parquet files.

Plain Parquet has no MERGE or UPDATE, so a changed table is written as a new version and the
readers take the newest complete one. A version is complete when Spark's commit has left its
_SUCCESS file, which is the last thing that a write does.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables that every executor sees.

    spark.checkpoint.dir, as the cluster sets it. Where it is unset, a session on one machine
    gets a fresh folder; on a cluster that would be each machine's own, so it is an error there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def read_files(spark: SparkSession, path: str, kind: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Files of kind parquet, orc, csv, json or text; a schema avoids a pass over the data to infer it."""
    reader = spark.read.format(kind).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def write_files(rows: DataFrame, path: str, kind: str = "parquet", partition_by: tuple[str, ...] = (), **options) -> None:
    rows.write.format(kind).options(**options).partitionBy(*partition_by).save(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None."""
    _, file, fs = _fs(spark, path)
    return "\n".join(r.value for r in spark.read.text(path).collect()) if fs.exists(file) else None


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file of ASCII text; it is an error if there is one."""
    _, file, fs = _fs(spark, path)
    out = fs.create(file, False)
    out.writeBytes(text)
    out.close()


def _version(path: str, number: int) -> str:
    return f"{path}/v{number:012d}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions below path, ascending."""
    jvm, folder, fs = _fs(spark, path)
    if not fs.exists(folder):
        return []
    names = [x.getPath() for x in fs.listStatus(folder)]
    return sorted(int(p.getName()[1:]) for p in names if p.getName().startswith("v") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def read_version(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete version, or None."""
    found = versions(spark, path)
    return spark.read.parquet(_version(path, found[-1])) if found else None


def write_version(rows: DataFrame, path: str) -> None:
    """rows as the next version; rows may be derived from the present one."""
    found = versions(rows.sparkSession, path)
    rows.write.parquet(_version(path, (found[-1] if found else 0) + 1))


def forget_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Deletes all complete versions but the newest `keep`, one at least. Not for tables that grow by append."""
    jvm, _, fs = _fs(spark, path)
    for number in versions(spark, path)[: -max(1, keep)]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(_version(path, number)), True)


def _merged(path: str, upto: int) -> str:
    return f"{path}/m{upto:012d}"


def merged_upto(spark: SparkSession, path: str) -> int:
    """The last batch that `compact` has merged, or -1."""
    jvm, folder, fs = _fs(spark, path)
    if not fs.exists(folder):
        return -1
    names = [x.getPath() for x in fs.listStatus(folder)]
    return max((int(p.getName()[1:]) for p in names if p.getName().startswith("m") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))), default=-1)


def batches(spark: SparkSession, path: str) -> list[int]:
    """Complete batches below path that aren't merged, ascending."""
    upto = merged_upto(spark, path)
    return [n for n in versions(spark, path) if n > upto]


def append(rows: DataFrame, path: str, number: int | None = None) -> bool:
    """Adds rows to the table at path as a batch of their own; what is there isn't read or written again.

    A batch with a number is added once: a repeat of one that is complete changes nothing, and
    one that broke off is written again. Numbers up to that of the last merged batch count as
    complete. Whether rows were added.
    """
    found, upto = versions(rows.sparkSession, path), merged_upto(rows.sparkSession, path)
    if number is not None and (number in found or number <= upto):
        return False
    rows.write.mode("overwrite" if number is not None else "errorifexists").parquet(_version(path, max([0, upto, *found]) + 1 if number is None else number))
    return True


def read_appended(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """The rows of all complete batches; without any, None, or no rows of the schema if it is given."""
    upto = merged_upto(spark, path)
    found = [*([_merged(path, upto)] if upto >= 0 else []), *(_version(path, n) for n in batches(spark, path))]
    if not found:
        return None if schema is None else spark.createDataFrame([], schema)
    return spark.read.parquet(*found)


def compact(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Merges all batches but the newest `keep` into one folder, so that readers open few; how many were merged.

    The merged folder counts once its write is complete, and from then on instead of its batches.
    They stay for readers that began before; `forget_merged` deletes them. Only for tables whose
    batches come in ascending numbers, as those of loads and streams do.
    """
    due = batches(spark, path)
    due = due[: len(due) - keep] if keep else due
    if not due:
        return 0
    upto = merged_upto(spark, path)
    old = [*([_merged(path, upto)] if upto >= 0 else []), *(_version(path, n) for n in due)]
    spark.read.parquet(*old).write.mode("overwrite").parquet(_merged(path, due[-1]))
    return len(due)


def forget_merged(spark: SparkSession, path: str) -> None:
    """Deletes batches, and earlier merged folders, that the newest merged folder holds; no reader may still use them."""
    jvm, folder, fs = _fs(spark, path)
    upto = merged_upto(spark, path)
    for x in [x.getPath() for x in fs.listStatus(folder)] if upto >= 0 else []:
        name = x.getName()
        if name[1:].isdigit() and ((name[0] == "v" and int(name[1:]) <= upto) or (name[0] == "m" and int(name[1:]) < upto)):
            fs.delete(x, True)
