"""Dates in many forms: the shapes of a column's texts settle how each shape is read.

A shape is a form of writing, such as ``9/9/9999``. Most shapes have one reading. In those of
two small numbers the values decide: a number above 12 is a day, and where only the first (or
only the second) of the two ever passes 12, the whole shape is read day first (or month
first). Where neither passes 12, or both do, the caller's default holds for the texts that
can be read both ways.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_NAMES = (
    "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
    "sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
)
#: Shapes with one reading: the pattern, and the groups of year, month and day.
_PLAIN = {
    "yyyy-m-d": (r"^\s*(\d{4})-(\d{1,2})-(\d{1,2})\s*$", (1, 2, 3)),
    "yyyy/m/d": (r"^\s*(\d{4})/(\d{1,2})/(\d{1,2})\s*$", (1, 2, 3)),
    "yyyymmdd": (r"^\s*(\d{4})(\d{2})(\d{2})\s*$", (1, 2, 3)),
    "d name yyyy": (rf"(?i)^\s*(\d{{1,2}})[ -]({_NAMES})[ -](\d{{4}})\s*$", (3, 2, 1)),
    "name d, yyyy": (rf"(?i)^\s*({_NAMES}) (\d{{1,2}}),? (\d{{4}})\s*$", (3, 1, 2)),
}
#: Shapes that are read day first or month first.
_TWOFOLD = {
    "9/9/9999": r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})\s*$",
    "9-9-9999": r"^\s*(\d{1,2})-(\d{1,2})-(\d{4})\s*$",
    "9.9.9999": r"^\s*(\d{1,2})[.](\d{1,2})[.](\d{4})\s*$",
}
SHAPES = (*_PLAIN, *_TWOFOLD)
DAY_FIRST, MONTH_FIRST = "day", "month"


def shape(c: Column) -> Column:
    """The name of a text's shape; null where it has none."""
    found = None
    for name, pattern in [*((n, p) for n, (p, _) in _PLAIN.items()), *_TWOFOLD.items()]:
        found = F.when(c.rlike(pattern), F.lit(name)) if found is None else found.when(c.rlike(pattern), F.lit(name))
    return found


def date_shapes(df: DataFrame, column: str) -> DataFrame:
    """(shape, row_count, first_over, second_over): texts of each shape, and whether their first and second
    numbers ever pass 12 (null for shapes of one reading). One row per shape of the list above and one for
    all other texts, so the result is small whatever the column holds."""
    c = F.col(column)
    name = shape(c)
    first, second = F.lit(None).cast("int"), F.lit(None).cast("int")
    for kind, pattern in _TWOFOLD.items():
        first = F.when(F.col("shape") == kind, F.regexp_extract("text", pattern, 1).try_cast("int")).otherwise(first)
        second = F.when(F.col("shape") == kind, F.regexp_extract("text", pattern, 2).try_cast("int")).otherwise(second)
    return (
        df.where(c.isNotNull())
        .select(c.alias("text"), name.alias("shape"))
        .select("shape", first.alias("first"), second.alias("second"))
        .groupBy("shape")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            (F.max("first") > 12).alias("first_over"),
            (F.max("second") > 12).alias("second_over"),
        )
    )


def settle(shapes: DataFrame, default: str = MONTH_FIRST) -> dict[str, str]:
    """Which number comes first in each shape of two readings, from the rows of `date_shapes`.

    A shape whose values contradict each other keeps the default for what could be read both ways."""
    if default not in (DAY_FIRST, MONTH_FIRST):
        raise ValueError(f"default must be {DAY_FIRST!r} or {MONTH_FIRST!r}, not {default!r}")
    orders = dict.fromkeys(_TWOFOLD, default)
    for row in shapes.where(F.col("shape").isin(*_TWOFOLD)).collect():  # three rows at most
        if row["first_over"] != row["second_over"]:
            orders[row["shape"]] = DAY_FIRST if row["first_over"] else MONTH_FIRST
    return orders


def _date(year: Column, month: Column, day: Column) -> Column:
    """The date, null where there is none: numbers out of range never reach the cast."""
    in_range = month.between(1, 12) & day.between(1, 31) & (year >= 1)
    text = F.format_string("%04d-%02d-%02d", year, month, day)
    return F.when(in_range, text.try_cast("date"))


def free_date(c: Column, orders: Mapping[str, str] | None = None) -> Column:
    """Text to DATE by its shape; null for texts of no shape and days that do not exist.

    ``orders`` is what `settle` gives; month first where it is missing. A number above 12 is
    read as the day in either order.
    """
    orders = orders or {}
    number = lambda pattern, group: F.regexp_extract(c, pattern, group).try_cast("int")
    value = F.lit(None).cast("date")
    for kind, pattern in _TWOFOLD.items():
        first, second = number(pattern, 1), number(pattern, 2)
        if orders.get(kind, MONTH_FIRST) == DAY_FIRST:
            swap = second > 12
        else:
            swap = first <= 12
        month, day = F.when(swap, first).otherwise(second), F.when(swap, second).otherwise(first)
        value = F.when(c.rlike(pattern), _date(number(pattern, 3), month, day)).otherwise(value)
    for pattern, (year, month, day) in _PLAIN.values():
        if _NAMES in pattern:
            month_number = _month_number(F.regexp_extract(c, pattern, month))
        else:
            month_number = number(pattern, month)
        value = F.when(c.rlike(pattern), _date(number(pattern, year), month_number, number(pattern, day))).otherwise(value)
    return value


def _month_number(name: Column) -> Column:
    """1 to 12, by the first three letters."""
    at = F.call_function("position", F.lower(F.substring(name, 1, 3)), F.lit(_MONTHS))
    return F.floor((at + 2) / 3).cast("int")


def with_free_date(df: DataFrame, column: str, *, default: str = MONTH_FIRST) -> DataFrame:
    """The column as DATE, after one aggregate over it that settles the shapes."""
    orders = settle(date_shapes(df, column), default)
    return df.withColumn(column, free_date(F.col(column), orders))
