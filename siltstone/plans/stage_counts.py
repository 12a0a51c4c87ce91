"""Rows of every zone, counted without building the zones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import credit
from siltstone.operators.rules import marking
from siltstone.plans.silver import CLEANERS


def row_counts(raw: Mapping[str, DataFrame], *, mob: int = 6) -> DataFrame:
    """(zone, table_name, row_count); each raw table is read once and nothing is joined.

    Silver marks the rows it would drop, so one aggregate counts both zones. The feature
    store has a row per key of silver financials, the label store one per loan row at ``mob``.
    """
    counted = None
    for table, df in raw.items():
        marked, mark = marking(df)
        marked = CLEANERS[table](marked, mark=mark)
        if table == "financials":
            lines = _with_keys(marked, mark)
        else:
            counts = {("bronze", table): F.count(F.lit(1)), ("silver", table): F.count_if(F.col(mark))}
            if table == "loan_daily":
                counts["gold", "label_store"] = F.count_if(F.col(mark) & (F.col("installment_num") == mob))
            lines = _lines(marked, counts)
        counted = lines if counted is None else counted.unionByName(lines)
    return counted


def _with_keys(marked: DataFrame, mark: str) -> DataFrame:
    """Financials: rows and keys. Rows are added up per key before the shuffle."""
    per_key = marked.groupBy(*credit.KEYS).agg(
        F.count(F.lit(1)).alias("all_rows"), F.count_if(F.col(mark)).alias("kept_rows")
    )
    return _lines(
        per_key,
        {
            ("bronze", "financials"): F.coalesce(F.sum("all_rows"), F.lit(0).cast("bigint")),
            ("silver", "financials"): F.coalesce(F.sum("kept_rows"), F.lit(0).cast("bigint")),
            ("gold", "feature_store"): F.count_if(F.col("kept_rows") > 0),
        },
    )


def _lines(df: DataFrame, counts: Mapping[tuple[str, str], Column]) -> DataFrame:
    """One row per counter of a single aggregate."""
    lines = [
        F.struct(F.lit(zone).alias("zone"), F.lit(table).alias("table_name"), F.col(f"n_{i}").alias("row_count"))
        for i, (zone, table) in enumerate(counts)
    ]
    counters = [counter.alias(f"n_{i}") for i, counter in enumerate(counts.values())]
    return df.agg(*counters).select(F.inline(F.array(*lines)))
