"""Tables laid out along a space-filling curve, with the least and greatest values of each file.

Each clustering column is cut at its quantiles into 2^bits ranges; the bits of the range numbers,
taken in turn from each column, order the rows. Files hold runs of that order and so are narrow in
every clustering column, and a reader opens only those whose ranges meet its filter, whichever of the
columns it is on.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types that have an order and quantiles.
ORDERED = (T.IntegralType, T.FractionalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _number(c: str, kind: T.DataType) -> Column:
    """A column of an ordered type as a double, for its quantiles."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    return (F.unix_date(c) if isinstance(kind, T.DateType) else F.col(c)).cast("double")


def _halved(x: Column, cuts: list[float], a: int, b: int) -> Column:
    """How many of cuts[a:b] lie below x, and a, found by halving."""
    if a == b:
        return F.lit(a)
    m = (a + b) // 2
    return F.when(x <= cuts[m], _halved(x, cuts, a, m)).otherwise(_halved(x, cuts, m + 1, b))


def along_curve(rows: DataFrame, columns: list[str], bits: int = 8, accuracy: int = 4096) -> tuple[DataFrame, int]:
    """rows with _place, the place of each along the curve (nulls as the least values), and their number.

    The edges of the ranges are approximate quantiles over all rows, at most 2^bits - 1 a column;
    only they come to the driver.
    """
    if not columns or bits < 1 or bits * len(columns) > 62:
        raise ValueError("the bits of all columns together are 1 to 62")
    kinds = {c: rows.schema[c].dataType for c in columns}
    for c, kind in kinds.items():
        if not isinstance(kind, ORDERED):
            raise ValueError(f"rows can't be clustered by {c}, of type {kind.simpleString()}")
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    edges = rows.agg(F.count("*").alias("n"), *[F.percentile_approx(_number(c, kinds[c]), shares, accuracy).alias(f"e{i}") for i, c in enumerate(columns)]).first()
    cuts = [sorted({x for x in edges[f"e{i}"] or [] if x == x}) for i in range(len(columns))]
    bins = {f"_bin{i}": F.coalesce(F.when(F.col(c).isNotNull(), _halved(_number(c, kinds[c]), cuts[i], 0, len(cuts[i]))), F.lit(0)).cast("long") for i, c in enumerate(columns)}
    place = F.lit(0).cast("long")
    for i in range(len(columns)):
        for b in range(bits):
            place = place.bitwiseOR(F.shiftleft(F.shiftright(F.col(f"_bin{i}"), b).bitwiseAND(F.lit(1)), b * len(columns) + i))
    return rows.withColumns(bins).withColumn("_place", place).drop(*bins), edges.n


def write_clustered(rows: DataFrame, path: str, columns: list[str], file_rows: int = 5_000_000, bits: int = 8) -> None:
    """Writes rows below path in files of about file_rows along the curve of columns, and then the list of files.

    rows are read three times: for quantiles, for the ranges of files and for the files. Rows at one
    place are parted by a hash of all their columns, so a frequent value fills several files; only
    rows that are equal in all columns must share a task, which cuts them into files of twice file_rows.
    The table counts as written when its list of files is complete.
    """
    placed, n = along_curve(rows, columns, bits)
    plain = [c for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    placed = placed.withColumn("_tie", F.xxhash64(*plain))
    order = ["_place", "_tie"]
    dealt = placed.repartitionByRange(max(1, -(-n // file_rows)), *order).sortWithinPartitions(*order).drop(*order)
    dealt.write.option("maxRecordsPerFile", 2 * file_rows).parquet(f"{path}/data")
    spark = rows.sparkSession
    held = spark.read.schema(rows.schema).parquet(f"{path}/data").select(F.col("_metadata.file_name").alias("_file"), *columns)
    stats = [x for c in columns for x in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))]
    held.groupBy("_file").agg(F.count("*").alias("_rows"), *stats).write.parquet(f"{path}/files")


def file_list(spark: SparkSession, path: str) -> DataFrame:
    """A row for each file of a clustered table: _file, _rows, and for each clustering column c lo_c and hi_c."""
    return spark.read.parquet(f"{path}/files")


def _bound(x, kind: T.DataType) -> Column:
    """A bound as a column; a time is the wall clock of the session's zone, in the column's own type, so that Parquet can use it."""
    return F.lit(str(x)).cast(kind) if isinstance(x, datetime) else F.lit(x)


def _within(kind: T.DataType, least, most, lo: str, hi: str) -> Column:
    found = F.col(lo).isNotNull()
    if least is not None:
        found &= F.col(hi) >= _bound(least, kind)
    if most is not None:
        found &= F.col(lo) <= _bound(most, kind)
    return found


def files_within(spark: SparkSession, path: str, ranges: dict) -> DataFrame:
    """The rows of `file_list` whose files may hold rows within ranges: for columns their least and greatest value, None for open ends."""
    found = file_list(spark, path)
    for c, (least, most) in ranges.items():
        if f"hi_{c}" not in found.columns:
            raise ValueError(f"{path} isn't clustered by {c}")
        found = found.where(_within(found.schema[f"lo_{c}"].dataType, least, most, f"lo_{c}", f"hi_{c}"))
    return found


def read_within(spark: SparkSession, path: str, ranges: dict) -> DataFrame:
    """The rows of a clustered table that lie within ranges, bounds included; rows with a null in one of these columns don't.

    Only files that may hold such rows are opened; their names come to the driver. Within them
    Parquet's own statistics skip row groups.
    """
    names = [r["_file"] for r in files_within(spark, path, ranges).select("_file").collect()]
    rows = spark.read.parquet(*(f"{path}/data/{x}" for x in names)) if names else spark.read.parquet(f"{path}/data").limit(0)
    for c, (least, most) in ranges.items():
        rows = rows.where(_within(rows.schema[c].dataType, least, most, c, c))
    return rows
