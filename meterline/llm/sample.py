"""Bounded training samples whose cost at the driver does not grow with the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def within(rows: DataFrame, key: str, most: int) -> DataFrame:
    """Rows under a hash cutoff of ``key`` that leaves about half as many keys again as ``most``; all rows of small tables."""
    n = rows.agg(F.approx_count_distinct(key)).first()[0]
    return rows.where(F.xxhash64(key) <= -(1 << 63) + int(1.5 * most / n * (1 << 64))) if n > 2 * most else rows


def smallest(rows: DataFrame, key: str, most: int) -> list[Row]:
    """The ``most`` distinct rows with the smallest hash of ``key`` (ties by the row's values).

    A top-k would send up to ``most`` rows of every task to the driver.  Here a hash cutoff
    first leaves little more than are wanted, so what reaches the driver stays near ``most``
    rows at any size; repeated rows are collapsed before the shuffle.  An empty table gives an
    empty list.
    """
    return within(rows, key, most).distinct().orderBy(F.xxhash64(key), *rows.columns).limit(most).collect()
