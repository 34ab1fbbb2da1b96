"""Which columns identify a row, and which determine others.

A set of columns parts the rows into classes of equal values. It is a key if there are as many
classes as rows, and determines another column if adding that one parts no class. Sets are tried
from small to large, and none that holds a found one. Most fail on a few thousand rows, and most
others on one class in 64, taken with all its rows; both refute but never accept a set. The classes
of what is left are counted over all rows, several sets at once.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column sets whose classes one job counts; each row is copied for each of them, as its own columns only.
TOGETHER = 8
#: One class in so many, by a hash of its values, is looked at whole before all are.
SHARE = 64


def _plain(rows: DataFrame, columns: list[str] | None) -> list[str]:
    simple = [f.name for f in rows.schema if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
    if columns is None:
        return simple
    wrong = [c for c in columns if c not in simple]
    if wrong:
        raise ValueError(f"not plain columns: {wrong}")
    return list(columns)


def classes(rows: DataFrame, sets: list[tuple[str, ...]], task_rows: int = 250_000) -> dict[tuple[str, ...], int]:
    """For each set of columns, given in one order, its number of classes; nulls are equal. Of no columns: 1, or 0 without rows.

    Rows are dealt to tasks of about task_rows before they are compared: adding them up where they
    are read would hold nearly all in one task for sets that are nearly keys, and save nothing.
    """
    return {s: n for (s, _), (n, _) in _counted(rows, [(s, s) for s in sets], 1, rows.count(), task_rows).items()}


def _counted(rows: DataFrame, sets: list[tuple], share: int, n: int, task_rows: int = 250_000) -> dict[tuple, tuple[int, int]]:
    """For each (columns, by), the classes of columns and the rows, in one in share of the classes of the columns by. n: all rows."""
    found, sets = {}, list(dict.fromkeys(sets))
    due = [x for x in sets if x[0]]
    inexact = {f.name for f in rows.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    value = lambda c: (F.col(c) + F.lit(0.0)).cast("string") if c in inexact else F.col(c)  # noqa: E731  # one text a number, and one zero
    for i in range(0, len(due), TOGETHER):
        some = due[i : i + TOGETHER]
        own = list(dict.fromkeys(c for s, _ in some for c in s))
        kinds = {f.name: f.dataType for f in rows.select(*[value(c).alias(c) for c in own]).schema}
        each = []
        for j, (s, by) in enumerate(some):
            x = F.struct(F.lit(j).alias("_set"), *[(value(c) if c in s else F.lit(None).cast(kinds[c])).alias(f"_{k}") for k, c in enumerate(own)])
            each.append(F.when(F.pmod(F.xxhash64(*map(value, by)), F.lit(share)) == 0, x) if share > 1 and by else x)
        names = ["_set", *[f"_{k}" for k in range(len(own))]]
        parted = rows.select(F.explode(F.array(*each)).alias("_x")).where("_x is not null").select("_x.*").repartition(max(1, -(-n * len(some) // (share * task_rows))), *names).groupBy(*names).agg(F.count("*").alias("_rows"))
        counts = {r["_set"]: (r["k"], r["n"]) for r in parted.groupBy("_set").agg(F.count("*").alias("k"), F.sum("_rows").alias("n")).collect()}
        found |= {x: counts.get(j, (0, 0)) for j, x in enumerate(some)}
    return found | {x: (min(n, 1), n) for x in sets if not x[0]}


def _sample(rows: DataFrame, columns: list[str], sample_rows: int) -> list[dict]:
    plain = lambda x: bytes(x) if isinstance(x, bytearray) else x
    return [{c: plain(r[i]) for i, c in enumerate(columns)} for r in rows.select(columns).limit(sample_rows).collect()]


def minimal_keys(rows: DataFrame, columns: list[str] | None = None, most: int = 2, sample_rows: int = 5_000) -> list[tuple[str, ...]]:
    """The keys of at most `most` columns of which no column can be left out, small ones first, each in the order of columns.

    columns: all plain ones unless given. Nulls are equal to each other. Of a table with one row or
    none the empty set is the key. sample_rows come to the driver to refute sets and don't affect the result.
    """
    columns = _plain(rows, columns)
    n = rows.count()
    if n < 2:
        return [()]
    seen, found = _sample(rows, columns, sample_rows), []
    for size in range(1, min(most, len(columns)) + 1):
        open_ = [s for s in combinations(columns, size) if not any(set(k) <= set(s) for k in found)]
        open_ = [s for s in open_ if len({tuple(r[c] for c in s) for r in seen}) == len(seen)]
        part = _counted(rows, [(s, s) for s in open_], SHARE, n)
        open_ = [s for s in open_ if part[s, s][0] == part[s, s][1]]
        counts = _counted(rows, [(s, s) for s in open_], 1, n)
        found += [s for s in open_ if counts[s, s][0] == n]
    return found


def dependencies(rows: DataFrame, columns: list[str] | None = None, most: int = 2, sample_rows: int = 5_000) -> list[tuple[tuple[str, ...], str]]:
    """(determining columns, column): each column with the sets of at most `most` others that determine it and of which none can be left out.

    A constant column is determined by the empty set, as are all columns of a table without rows.
    Otherwise as `minimal_keys`.
    """
    columns = _plain(rows, columns)
    n, seen, found = rows.count(), _sample(rows, columns, sample_rows), []
    for size in range(min(most, len(columns) - 1) + 1):
        open_ = []
        for s in combinations(columns, size):
            values = [tuple(r[c] for c in s) for r in seen]
            parts = len(set(values))
            for c in columns:
                if c in s or any(b == c and set(a) <= set(s) for a, b in found):
                    continue
                if len({(v, r[c]) for v, r in zip(values, seen, strict=True)}) == parts:
                    open_.append((s, c))
        with_ = {(s, c): tuple(x for x in columns if x in s or x == c) for s, c in open_}
        part = _counted(rows, [y for x in open_ for y in ((x[0], x[0]), (with_[x], x[0]))], SHARE, n)
        open_ = [x for x in open_ if part[x[0], x[0]][0] == part[with_[x], x[0]][0]]
        counts = _counted(rows, [(y, y) for x in open_ for y in (x[0], with_[x])], 1, n)
        found += [x for x in open_ if counts[x[0], x[0]][0] == counts[with_[x], with_[x]][0]]
    return found
