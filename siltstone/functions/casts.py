"""Typing rules for text columns.

Every function gives null (never an error) for text it cannot read, with ANSI
mode on or off.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INT_MIN = -(2**31)
INT_MAX = 2**31 - 1

# The patterns below tell readable text from other text before a cast: a cast that
# fails is an exception per value, up to a hundred times as dear as the match.
# Blanks and control characters may surround a number.
_SIGNED = r"^[\x00-\x20\x7F]*[+-]?"
_END = r"[\x00-\x20\x7F]*\z"
_SMALL_INTEGER = r"^-?[0-9]{1,9}\z"
_WITH_WHOLE_PART = _SIGNED + "[0-9]+(?:[.][0-9]*)?" + _END
_FRACTION_ONLY = _SIGNED + "[.][0-9]*" + _END
_FLOATING = (
    _SIGNED
    + r"(?:(?=[0-9.])[0-9]*[.]?[0-9]*(?:[eE][+-]?[0-9]+)?[dDfF]?|0[xX].*|[iI][nN][fF].*|[nN][aA][nN])"
    + _END
)
_ISO_DAY = r"^\d{4}-\d{2}-\d{2}\z"

# Patterns of one field for `fields_match`, without a comma. Days to the 28th exist in every month.
SMALL_INTEGER_FIELD = "-?[0-9]{1,9}"
SURE_DAY_FIELD = "[12][0-9]{3}-(?:0[1-9]|1[0-2])-(?:0[1-9]|1[0-9]|2[0-8])"


def fields_match(columns: Sequence[Column], patterns: Sequence[str]) -> Column:
    """True where every text matches its pattern as a whole, else (also for null) false.

    The texts are joined and searched once, which costs far less than a search per
    column. No pattern may accept a comma: then a comma in a text is one more than the
    joined pattern has. A pattern that accepts an empty text is met by null too.
    """
    joined = F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return joined.rlike("^" + ",".join(patterns) + r"\z")


def lenient_int(c: Column) -> Column:
    """Text to INT, dropping a fraction: ``3.7`` is 3, ``.5`` is 0, ``1e3`` is null."""
    return (
        F.when(c.rlike(_SMALL_INTEGER), c.try_cast("int"))
        .when(c.rlike(_WITH_WHOLE_PART), F.substring_index(c, ".", 1).try_cast("int"))
        .when(c.rlike(_FRACTION_ONLY), F.lit(0))
    )


def _small_integers(columns: Sequence[Column]) -> Column:
    return fields_match(columns, [SMALL_INTEGER_FIELD] * len(columns))


def _numbers(columns: Sequence[Column], rule: Callable[[Column], Column]) -> Column:
    """A rule to INT for several texts, as one array.

    Where all are plain integers, a single match tells so. An array also keeps the rule in
    the plan once and not per column, whose generated method would be too long to compile.
    """
    texts = F.array(*[c.cast("string") for c in columns])
    return F.when(_small_integers(columns), texts.try_cast("array<int>")).otherwise(F.transform(texts, rule))


def lenient_ints(columns: Sequence[Column]) -> Column:
    """`lenient_int` of several texts, as one array."""
    return _numbers(columns, lenient_int)


def lenient_double(c: Column) -> Column:
    """Text to DOUBLE, null where it is not a number."""
    return F.when(c.rlike(_FLOATING), c.try_cast("double"))


def double_to_int(c: Column) -> Column:
    """DOUBLE to INT: truncates toward zero, saturates at the INT bounds, NaN is 0.

    Expects a non-null value; null would give the lower bound.
    """
    return _bounded(F.nanvl(c, F.lit(0.0)))


def _bounded(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(float(INT_MIN))), F.lit(float(INT_MAX))).cast("int")


def int_or_default(
    c: Column, default: int = 0, *, strip: bool = False, min_value: int | None = None
) -> Column:
    """Text to INT through DOUBLE, with ``default`` for anything unreadable.

    ``strip`` first removes underscores (``7_`` reads 7 and not the default).
    ``min_value`` replaces smaller values by the default.
    """
    text = F.regexp_replace(c, "_", "") if strip else c
    value = double_to_int(F.coalesce(lenient_double(text), F.lit(float(default))))
    if min_value is not None:
        value = F.when(value >= min_value, value).otherwise(F.lit(default))
    return value


def is_whole(c: Column) -> Column:
    """True where a DOUBLE holds a whole number; false for null, NaN and infinity."""
    return F.coalesce(c == F.floor(c), F.lit(False))


def whole_number(c: Column) -> Column:
    """Text to INT where it holds a whole number (``10.0`` is 10), else null."""
    return whole_double(lenient_double(c))


def doubles(columns: Sequence[Column]) -> Column:
    """Texts to DOUBLE, as one array, null where one is not a number; suits texts of which most are."""
    return F.array(*[c.cast("string") for c in columns]).try_cast("array<double>")


def whole_double(value: Column) -> Column:
    """DOUBLE to INT where it is a whole number, else null."""
    return F.when(value == F.floor(value), _bounded(value))  # NaN is no whole number


def whole_numbers(columns: Sequence[Column]) -> Column:
    """`whole_number` of several texts, as one array."""
    return _numbers(columns, whole_number)


def strict_date(c: Column) -> Column:
    """Text to DATE in the form ``yyyy-MM-dd`` only: ``2023-1-1`` and ``2023-02-30`` are null."""
    return F.when(c.rlike(_ISO_DAY), c.try_cast("date"))


def lenient_date(c: Column) -> Column:
    """Text to DATE in any ISO-like form: ``2023-1-1`` is accepted."""
    return c.try_cast("date")


def cast_present(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Casts those of the named columns that ``df`` has; unreadable values become null."""
    present = {name: F.col(name).try_cast(kind) for name, kind in types.items() if name in df.columns}
    return df.withColumns(present) if present else df
