"""Joins of two streams in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def answers_within(asked: DataFrame, answers: DataFrame, key: tuple[str, str], at: tuple[str, str], within: str) -> DataFrame:
    """Pairs of a row of asked and a row of answers with its key whose time is not before, and at most `within` after, its own.

    Both streams need watermarks. A row is kept until the other side's watermark shows that
    nothing can pair with it any more, so the state holds the rows of about the lateness and
    `within`, whatever the stream's length. Rows with a null key or time pair with nothing. Column
    names of the two must differ.
    """
    clash = {c.lower() for c in asked.columns} & {c.lower() for c in answers.columns}
    if clash:
        raise ValueError(f"both streams have columns {sorted(clash)}")
    near = (F.col(at[1]) >= F.col(at[0])) & (F.col(at[1]) <= F.col(at[0]) + F.expr(f"interval {within}"))
    return asked.join(answers, (F.col(key[0]) == F.col(key[1])) & near)


def first_answers(asked: DataFrame, pairs: DataFrame, row_id: str, answer: list[str]) -> DataFrame:
    """asked (as a table) with the columns answer of its earliest pair, in the order of these columns; null where it has none.

    Pairs may have come in any order and batches. row_id tells the rows of asked apart.
    """
    first = pairs.groupBy(F.col(row_id).alias("_id")).agg(F.min(F.struct(*answer)).alias("_first"))
    return asked.join(first, F.col(row_id) == F.col("_id"), "left").select(*[asked[c] for c in asked.columns], *[F.col("_first")[c].alias(c) for c in answer])
