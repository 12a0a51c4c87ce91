"""Rules which apply only to the columns a table has.

Filters drop rows, or mark them: given the name of a column from `marking`, they only clear
it, so that one pass can tell the rows before and after all filters.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.validity import holds


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores after it until no column of the table has it, in any case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def marking(df: DataFrame) -> tuple[DataFrame, str]:
    """The table with one more column, true for now, and its name: the filters below clear it where they are
    told its name, instead of dropping rows."""
    mark = free_name(df, "kept")
    return df.withColumn(mark, F.lit(True)), mark


def _filtered(df: DataFrame, condition: Column, mark: str | None) -> DataFrame:
    if mark is None:
        return df.where(condition)
    return df.withColumn(mark, F.col(mark) & holds(condition))


def rewrite_present(df: DataFrame, rules: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Rewrites in one projection each named column that ``df`` has."""
    present = {name: rule(F.col(name)) for name, rule in rules.items() if name in df.columns}
    return df.withColumns(present) if present else df


def rewrite_numbers(
    df: DataFrame,
    *families: tuple[Sequence[str], Callable[[Sequence[Column]], Column], Callable[[Column], Column]],
) -> DataFrame:
    """Rewrites families of named columns, each by a rule that gives all of them as one array and one for its elements."""
    arrays, spread = {}, {}
    for names, rule, each in families:
        if names:
            array = free_name(df, f"numbers_{len(arrays)}")
            arrays[array] = rule([F.col(name) for name in names])
            spread |= {name: each(F.get(array, F.lit(i))) for i, name in enumerate(names)}
    return df.withColumns(arrays).withColumns(spread).drop(*arrays) if arrays else df


def keep_numbers(
    df: DataFrame, names: Sequence[str], rule: Callable[[Sequence[Column]], Column], *, mark: str | None = None
) -> DataFrame:
    """As `rewrite_numbers`; drops the rows with a null in any of them, or clears ``mark`` there.

    Such a row gives no array, so exploding drops it: the rule is evaluated once, where a
    filter would be pushed below the projection and evaluate it again. A condition over so
    many computed columns would also make the optimizer's constraint set explode.
    """
    if not names:
        return df
    numbers = free_name(df, "numbers")
    found, whole = rule([F.col(name) for name in names]), lambda array: F.forall(array, lambda n: n.isNotNull())
    if mark is None:
        return _spread(df.select("*", F.explode(F.filter(F.array(found), whole)).alias(numbers)), names, numbers)
    marked = _filtered(df.withColumn(numbers, found), whole(F.col(numbers)), mark)
    return _spread(marked, names, numbers)


def _spread(df: DataFrame, names: Sequence[str], numbers: str) -> DataFrame:
    return df.withColumns({name: F.get(numbers, F.lit(i)) for i, name in enumerate(names)}).drop(numbers)


def keep_where(
    df: DataFrame, columns: str | Sequence[str], condition: Callable[..., Column], *, required: bool = False,
    mark: str | None = None,
) -> DataFrame:
    """Keeps the rows whose columns meet the condition, or clears ``mark`` in the others; null counts as not met.

    Does nothing where ``df`` lacks one of the columns, unless they are ``required``.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    missing = [name for name in names if name not in df.columns]
    if missing and required:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df if missing else _filtered(df, condition(*[F.col(name) for name in names]), mark)


def drop_null_present(df: DataFrame, columns: Sequence[str], *, mark: str | None = None) -> DataFrame:
    """Drops, or marks, rows with a null in any of those named columns that ``df`` has.

    One condition per column: a single condition over all of them (as ``dropna``
    builds) makes the optimizer's constraint set grow exponentially in their
    number once the columns are computed ones.
    """
    present = [F.col(name).isNotNull() for name in columns if name in df.columns]
    return _filtered(df, reduce(Column.__and__, present), mark) if present else df
