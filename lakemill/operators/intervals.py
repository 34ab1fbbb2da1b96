"""Joins of intervals that overlap, as equi-joins on time bins.

An interval is put into bins as wide as the next power of two above its length, so it lies in
two of them at most, however long it is; the width is its level. Two intervals meet on the level
of the longer one, for which the shorter is also put into the bins of each higher level that the
other side has. A pair that shares several bins comes out of the one that its overlap begins in.
So no pair is lost or repeated, a row is copied at most twice a level (four times on its own), and
the join has equal keys only: (key, who is on his own level, level, bin). A key's rows spread over its bins; a bin with very many rows
is cut further: the side with more rows in it is dealt over salts, the other is copied to each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Microseconds of the narrowest bins, by power of two: about a second.
FINEST = 20


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def overlap_join(left: DataFrame, right: DataFrame, key: str, left_span: tuple[str, str], right_span: tuple[str, str], right_key: str | None = None, bin_rows: int = 100_000) -> DataFrame:
    """Pairs of rows of equal keys whose half-open intervals [from, to) overlap: all columns of both, overlap_from and overlap_to.

    A null end is open, and overlap_to is null where both are. Rows with a null key or start, or
    with an end that isn't after the start, overlap nothing. The sides' columns must differ in
    name, but for the key where right_key is not given; it then comes once. Bins in which a side
    has more than bin_rows rows are cut.
    """
    right_key = right_key or key
    clash = ({c.lower() for c in left.columns} & {c.lower() for c in right.columns}) - ({key.lower()} if right_key == key else set())
    if clash:
        raise ValueError(f"both sides have columns {sorted(clash)}")

    def spans(rows: DataFrame, own_key: str, span: tuple[str, str]) -> DataFrame:
        valid = F.col(own_key).isNotNull() & F.col(span[0]).isNotNull() & (F.col(span[1]).isNull() | (F.col(span[1]) > F.col(span[0])))
        return rows.where(valid).select(F.col(own_key).alias("_k"), F.struct(*rows.columns).alias("_row"), _micros(span[0]).alias("_from"), _micros(span[1]).alias("_to"))

    l, r = spans(left, key, left_span), spans(right, right_key, right_span)
    # Open ends are as long as any interval can matter: to the last moment of either side. Two numbers come to the driver.
    last = max((x for x in (s.agg(F.max(F.greatest("_from", F.coalesce("_to", "_from")))).first()[0] for s in (l, r)) if x is not None), default=0) + 1

    def leveled(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("_end", F.coalesce("_to", F.lit(last)))
        length = F.greatest(F.col("_end") - F.col("_from"), F.lit(1))
        return rows.withColumn("_level", F.greatest(F.ceil(F.log2(length.cast("double"))).cast("int"), F.lit(FINEST)))

    l, r = leveled(l), leveled(r)
    levels = [sorted(x[0] for x in s.select("_level").distinct().collect()) for s in (l, r)]  # 44 at most for all of time

    def binned(rows: DataFrame, others: list[int], home: list[str], guest: str) -> DataFrame:
        """A row for each bin; role tells who is on his own level: both (a), only the left (b) or only the right (c). Guests never meet guests."""
        own = F.array(*[F.struct(F.col("_level").alias("_at"), F.lit(x).alias("_role")) for x in home])
        higher = F.filter(F.array(*map(F.lit, others)).cast("array<int>"), lambda x: x > F.col("_level"))
        at = rows.withColumn("_place", F.explode(F.concat(own, F.transform(higher, lambda x: F.struct(x.alias("_at"), F.lit(guest).alias("_role")))))).select("*", "_place.*").drop("_place")
        return at.withColumn("_bin", F.explode(F.expr("sequence(shiftright(_from, _at), shiftright(_end - 1, _at))")))

    lb, rb = binned(l, levels[1], ["a", "b"], "c"), binned(r, levels[0], ["a", "c"], "b")
    place = ["_k", "_role", "_at", "_bin"]
    size = lambda rows, name: rows.groupBy(*place).agg(F.count("*").alias(name)).where(F.col(name) > bin_rows)
    many = size(lb, "_nl").join(size(rb, "_nr"), place, "full_outer")
    most = F.greatest(F.coalesce("_nl", F.lit(0)), F.coalesce("_nr", F.lit(0)))
    cut = many.select(*place, F.ceil(most / bin_rows).cast("int").alias("_salts"), (F.coalesce("_nl", F.lit(0)) >= most).alias("_left"))

    def salted(rows: DataFrame, is_left: bool) -> DataFrame:
        plain = [f.name for f in rows.schema["_row"].dataType.fields if "map<" not in f.dataType.simpleString()]
        own = F.pmod(F.xxhash64("_from", "_end", *[F.col("_row")[c] for c in plain]), F.coalesce("_salts", F.lit(1)).cast("long")).cast("int")
        dealt = F.col("_salts").isNull() | (F.col("_left") == is_left)
        return rows.join(cut, place, "left").withColumn("_salt", F.explode(F.when(dealt, F.array(own)).otherwise(F.sequence(F.lit(0), F.col("_salts") - 1)))).drop("_salts", "_left")

    named = lambda rows, side: rows.select(*place, "_salt", *[F.col(c).alias(c + side) for c in ("_row", "_from", "_to", "_end")])
    pairs = named(salted(lb, True), "_l").join(named(salted(rb, False), "_r"), [*place, "_salt"])
    met = pairs.where("_from_l < _end_r and _from_r < _end_l and _bin = shiftright(greatest(_from_l, _from_r), _at)")
    kind = dict(left.dtypes)[left_span[0]]
    columns = [*[F.col("_row_l")[c].alias(c) for c in left.columns], *[F.col("_row_r")[c].alias(c) for c in right.columns if not (right_key == key and c.lower() == key.lower())]]
    return met.select(*columns, F.timestamp_micros(F.greatest("_from_l", "_from_r")).cast(kind).alias("overlap_from"), F.timestamp_micros(F.least("_to_l", "_to_r")).cast(kind).alias("overlap_to"))
