"""Cleaning rules: dirty text to numbers, bands, categories and parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone import credit
from siltstone.functions.casts import fields_match, lenient_double, lenient_int

#: A text that `clean_number` reads once a currency sign is gone; an empty one too, so that null meets it.
_AMOUNT_FIELD = "[$]?[0-9.]*"
_DIRT_BUT_COMMAS = credit.DIRT.replace("[^", "[^,")


def digits_and_points(c: Column) -> Column:
    """Removes every character but digits and points, the minus sign included.

    Clean text is only searched, which costs a quarter of a replacement.
    """
    return F.when(c.rlike(credit.DIRT), F.regexp_replace(c, credit.DIRT, "")).otherwise(c)


def clean_number(
    c: Column, scale: int | None = None, *, on_null: str = "keep", keep_sign: bool = False
) -> Column:
    """Number hidden in dirty text, as DOUBLE.

    ``scale`` rounds half up to that many places. ``on_null`` is ``keep`` or
    ``zero``. Without ``keep_sign`` the minus sign counts as dirt (``-12.3_`` is
    12.3); with it, a minus before the first digit negates the value.
    """
    if on_null not in ("keep", "zero"):
        raise ValueError(f"on_null must be 'keep' or 'zero', not {on_null!r}")
    value = digits_and_points(c).try_cast("double")
    if keep_sign:
        value = F.when(c.rlike("^[^0-9.]*-[^0-9.]*[0-9.]"), -value).otherwise(value)
    if scale is not None:
        value = F.round(value, scale)
    return F.coalesce(value, F.lit(0.0)) if on_null == "zero" else value


def clean_numbers(columns: Sequence[Column], *, on_null: str = "keep", keep_sign: bool = False) -> Column:
    """`clean_number` of several texts, as one array.

    Where each text is clean but for a currency sign before it, a single match tells so.
    """
    texts = [c.cast("string") for c in columns]
    sure = fields_match(texts, [_AMOUNT_FIELD] * len(texts))
    plain = F.array(*[F.replace(c, F.lit("$"), F.lit("")) for c in texts])
    if keep_sign or on_null == "zero":
        rule = lambda c: clean_number(c, on_null=on_null, keep_sign=keep_sign)
        numbers = plain.try_cast("array<double>")
        if on_null == "zero":
            numbers = F.transform(numbers, lambda n: F.coalesce(n, F.lit(0.0)))
        return F.when(sure, numbers).otherwise(F.transform(F.array(*texts), rule))
    # Dirt is removed from the joined texts: a function over the elements of an array would keep
    # the plan around it from being compiled as one stage. A comma in a text is dirt as well.
    bare = [F.coalesce(F.replace(c, F.lit(","), F.lit("")), F.lit("")) for c in texts]
    cleaned = F.split(F.regexp_replace(F.concat_ws(",", *bare), _DIRT_BUT_COMMAS, ""), ",", -1)
    return F.when(sure, plain).otherwise(cleaned).try_cast("array<double>")


def coerce_number(c: Column, scale: int | None = None, *, on_null: str = "keep") -> Column:
    """Number from clean text only: nothing is stripped, so ``__10__`` has no value."""
    if on_null not in ("keep", "zero"):
        raise ValueError(f"on_null must be 'keep' or 'zero', not {on_null!r}")
    value = F.nanvl(lenient_double(c), F.lit(None).cast("double"))
    if scale is not None:
        value = F.round(value, scale)
    return F.coalesce(value, F.lit(0.0)) if on_null == "zero" else value


def int_without_underscores(c: Column) -> Column:
    """Text such as ``34_`` to INT, null where nothing readable is left."""
    return lenient_int(F.regexp_replace(c, "_", ""))


def band(
    c: Column,
    steps: Sequence[tuple[float | None, str]],
    *,
    above: float | None = None,
    default: str | None = None,
) -> Column:
    """Label of the first step whose inclusive upper bound holds the value.

    A step with bound ``None`` takes all larger values. Null, NaN and values not
    greater than ``above`` get ``default``.
    """
    outside = c.isNull() | F.isnan(c.cast("double"))
    if above is not None:
        outside = outside | (c <= above)
    ladder = F.when(outside, F.lit(default))
    for upper, label in steps:
        if upper is None:
            return ladder.otherwise(F.lit(label))
        ladder = ladder.when(c <= upper, F.lit(label))
    return ladder.otherwise(F.lit(default))


def category(c: Column, allowed: Sequence[str], *, canonical: bool = False, other: str = "Unknown") -> Column:
    """Case- and blank-insensitive match against ``allowed``, else ``other``.

    A match is given in proper case, blanks kept (``NM`` reads ``Nm``); with
    ``canonical`` it is given as spelt in ``allowed``.
    """
    key = F.upper(F.trim(c))
    if canonical:
        result = None
        for value in allowed:
            hit = key == value.upper()
            result = F.when(hit, F.lit(value)) if result is None else result.when(hit, F.lit(value))
        return result.otherwise(F.lit(other))
    return F.when(key.isin(*[value.upper() for value in allowed]), F.initcap(c)).otherwise(F.lit(other))


def exact_category(c: Column, allowed: Sequence[str], *, other: str = "Unknown") -> Column:
    """Case-sensitive match of the trimmed text against ``allowed``, else ``other``."""
    trimmed = F.trim(c)
    return F.when(trimmed.isin(*allowed), trimmed).otherwise(F.lit(other))


def joint_extract(c: Column, pattern: str, groups: Sequence[str]) -> dict[str, Column]:
    """Groups of one pattern as columns; all are null where the pattern does not match."""
    return {
        name: F.nullif(F.regexp_extract(c, pattern, index), F.lit(""))
        for index, name in enumerate(groups, start=1)
    }


def year_month_total(c: Column) -> Column:
    """Months in text like ``3 Years and 4 Months``; null unless both parts are there."""
    years = F.regexp_extract(c, r"(\d+)\s+Years?", 1).try_cast("int")
    months = F.regexp_extract(c, r"(\d+)\s+Months?", 1).try_cast("int")
    return F.try_add(F.try_multiply(years, F.lit(12)), months)


def flag_at_least(c: Column, threshold: float) -> Column:
    """1 where the value reaches the threshold, else (also for null) 0."""
    return F.when(c >= threshold, F.lit(1)).otherwise(F.lit(0))
