"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], tie_break: Sequence[str] = ()
) -> DataFrame:
    """Keep the first row of each key in ``order``, ties decided by ``tie_break`` ascending.

    Spark limits every group to one row in each map task before the shuffle
    (``WindowGroupLimit``), so a key with very many copies stays cheap.
    """
    ties = [F.col(c).asc_nulls_first() for c in tie_break]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return (
        df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")
    )


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which any of the columns is NULL.

    One test per column: unlike ``dropna``, each can be pushed to the scan.
    """
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "duplicate_count") -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).filter(F.col(name) > 1)
