"""Duplicate keys: counting them and keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.operators.rules import free_name


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many keys occur more than once and how many rows are surplus."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return sizes.where(F.col("copies") > 1).agg(
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0).cast("bigint")).alias("surplus_rows"),
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first by ``order``, then by all other columns, nulls first.

    The order is total, so the result does not depend on how the data lies on
    disk. Spark limits each group before the shuffle (``WindowGroupLimit``), so
    that a hot key sends one row per map task and not all of its copies.
    """
    rest = [F.col(name).asc_nulls_first() for name in df.columns if name not in keys]
    ordering = [*order, *rest] or [F.lit(0)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering))
    name = free_name(df, "rank")
    return df.withColumn(name, rank).where(F.col(name) == 1).drop(name)
