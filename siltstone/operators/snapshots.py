"""Monthly snapshots: the date spine, slices and unions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.validity import holds

SNAPSHOT = "snapshot_date"


def month_starts(start: date | str, end: date | str) -> list[date]:
    """First days of all months from the month of ``start`` through ``end``."""
    first, last = (date.fromisoformat(d) if isinstance(d, str) else d for d in (start, end))
    numbers = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [date(n // 12, n % 12 + 1, 1) for n in numbers]


def spine_between(start: Column, end: Column) -> Column:
    """Array of the first days of all months from the month of ``start`` through ``end``.

    Empty where ``end`` lies before that first month.
    """
    first = F.trunc(start, "MM").cast("date")
    months = F.sequence(first, end.cast("date"), F.expr("interval 1 month"))
    return F.when(first <= end, months).otherwise(F.array().cast("array<date>"))


def date_spine(df: DataFrame, column: str = SNAPSHOT) -> DataFrame:
    """One row per month between the smallest and the largest date of a column."""
    bounds = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return bounds.select(F.explode(spine_between(F.col("lo"), F.col("hi"))).alias(column))


def spine_counts(df: DataFrame, column: str = SNAPSHOT) -> DataFrame:
    """Rows per month of the spine; a month without rows counts 0.

    One pass: the counts, a row per date, give both the bounds and what is looked up.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    one = counts.agg(
        F.min(column).alias("lo"),
        F.max(column).alias("hi"),
        F.map_from_entries(F.collect_list(F.struct(column, "row_count"))).alias("found"),
    )
    return one.select("found", F.explode(spine_between(F.col("lo"), F.col("hi"))).alias(column)).select(
        column, F.coalesce(F.try_element_at("found", column), F.lit(0).cast("bigint")).alias("row_count")
    )


def on_snapshots(days: Iterable[date], column: str = SNAPSHOT) -> Column:
    """True for the rows of the given snapshots; null for a null date.

    A plain membership test, so that it prunes partitions.
    """
    return F.col(column).isin(*days)


def snapshot_slice(df: DataFrame, day: date | str, column: str = SNAPSHOT) -> DataFrame:
    """Rows of one snapshot."""
    literal = F.lit(date.fromisoformat(day) if isinstance(day, str) else day)
    return df.where(F.col(column) == literal)


def off_spine(df: DataFrame, days: Sequence[date], column: str = SNAPSHOT) -> DataFrame:
    """One row: all rows, and those whose date is null or no snapshot of the list."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(~holds(on_snapshots(days, column))).alias("off_spine"),
    )


def union_snapshots(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name; duplicates stay.

    The columns are checked first: a column missing in one of the frames is an error, and so
    is an empty list. Frames are united in pairs, and pairs of pairs: each frame is part of
    as many steps as the number of frames has binary digits, where a chain of unions would
    have the first one analysed again by every step.
    """
    if not frames:
        raise ValueError("no snapshots to union")
    columns = frames[0].columns
    for number, frame in enumerate(frames):
        if sorted(frame.columns) != sorted(columns):
            differing = sorted(set(columns) ^ set(frame.columns)) or "repeated names"
            raise ValueError(f"frame {number} differs from the first in {differing}")
    left = [frame if frame.columns == columns else frame.select(*map(_quoted, columns)) for frame in frames]
    while len(left) > 1:
        pairs = zip(left[::2], left[1::2], strict=False)
        left = [a.union(b) for a, b in pairs] + left[len(left) & ~1 :]
    return left[0]


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
