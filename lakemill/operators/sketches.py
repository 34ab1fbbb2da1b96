"""Sketches of distinct counts and quantiles that add up over loads.

An exact distinct count or median of two loads can't be had from those of each; a sketch's can,
by a union. A sketch is a binary column of a few kilobytes, whatever it has seen, so it is stored
by load and key like sums and counts. Task results are sketches too: no values are shuffled.

Bounds: a distinct count from 2**bits buckets has a relative standard error of 1.04 / sqrt(2**bits);
`distinct_error` is three of them. The rank of a quantile is off by `rank_error` at most, with a
probability of over 99 %.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 14
K = 400


def distinct_error(bits: int = BITS) -> float:
    return 3 * 1.04 / 2 ** (bits / 2)


def rank_error(k: int = K) -> float:
    return 2.3 / k**0.9


def sketched(rows: DataFrame, keys: list[str], distinct: dict[str, Column] | None = None, quantiles: dict[str, Column] | None = None, bits: int = BITS, k: int = K) -> DataFrame:
    """A row for each value of keys with a sketch column for each entry of distinct and of quantiles (numbers); nulls don't count."""
    made = [F.hll_sketch_agg(c, bits).alias(name) for name, c in (distinct or {}).items()]
    made += [F.kll_sketch_agg_double(c.cast("double"), k).alias(name) for name, c in (quantiles or {}).items()]
    return rows.groupBy(*keys).agg(*made)


def united(sketches: DataFrame, keys: list[str], distinct: list[str] = (), quantiles: list[str] = (), k: int = K) -> DataFrame:
    """Sketches of any number of loads as one row for each value of keys, which may be fewer columns than they were made by."""
    made = [F.hll_union_agg(c).alias(c) for c in distinct]
    made += [F.kll_merge_agg_double(c, k).alias(c) for c in quantiles]
    return sketches.groupBy(*keys).agg(*made)


def distinct_count(sketch: str) -> Column:
    return F.hll_sketch_estimate(sketch)


def quantile(sketch: str, share: float) -> Column:
    """The value that a share of the values doesn't exceed; null where nothing was seen."""
    seen = F.kll_sketch_get_n_double(sketch) > 0
    return F.when(seen, F.kll_sketch_get_quantile_double(sketch, F.lit(float(share))))
