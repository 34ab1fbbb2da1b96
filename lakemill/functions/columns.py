"""Column helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(column: str) -> Column:
    """A double amount with two decimals as a decimal, whose sums don't depend on the order of rows."""
    return F.col(column).cast("decimal(18,2)")


def json_int(column: str, path: str) -> Column:
    """The integer at path of a JSON text; null where there is none."""
    return F.get_json_object(column, path).try_cast("int")


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(a, b)
