"""Validity predicates. Null means "cannot tell" unless wrapped in `holds`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions.casts import is_whole, lenient_date, lenient_double, strict_date

# Text formats of the credit tables.
CUSTOMER_ID = r"^CUS_0x[0-9a-fA-F]+$"
LOAN_ID = r"^CUS_0x[0-9a-fA-F]+_\d{4}_\d{2}_\d{2}$"
SSN = r"^\d{3}-\d{2}-\d{4}$"
ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"
PERSON_NAME = r"^[A-Za-z\s\-']+$"
PLAIN_NUMBER = r"^\d+(\.\d+)?$"
INTEGER = r"^[+-]?[0-9]+$"


def holds(condition: Column) -> Column:
    """The condition with null counted as false."""
    return F.coalesce(condition, F.lit(False))


def matches(c: Column, pattern: str) -> Column:
    return c.rlike(pattern)


def is_integer_text(c: Column) -> Column:
    return c.rlike(INTEGER)


def is_plain_number(c: Column) -> Column:
    """Digits with at most one point and nothing else; negatives fail."""
    return c.rlike(PLAIN_NUMBER)


def is_plain_non_negative(c: Column) -> Column:
    """Plain number text whose numeric value is not below zero."""
    return c.rlike(PLAIN_NUMBER) & (F.coalesce(lenient_double(c), F.lit(0.0)) >= 0)


def is_numeric(c: Column) -> Column:
    """Readable as a number, which NaN (greater than infinity here) is not."""
    return lenient_double(c) <= float("inf")


def is_whole_number(c: Column) -> Column:
    return is_whole(lenient_double(c))


def is_day(c: Column) -> Column:
    """A real calendar day written ``yyyy-MM-dd``."""
    return c.rlike(ISO_DAY) & strict_date(c).isNotNull()


def is_strict_day(c: Column) -> Column:
    return strict_date(c).isNotNull()


def is_any_day(c: Column) -> Column:
    return lenient_date(c).isNotNull()


def is_person_name(c: Column) -> Column:
    """2 to 50 letters, blanks, hyphens and apostrophes after trimming."""
    trimmed = F.trim(c)
    return (trimmed != "") & trimmed.rlike(PERSON_NAME) & F.length(trimmed).between(2, 50)


def day_fault(c: Column) -> Column:
    """Why a text is no strict day; null where it is one.

    A text that no lenient reading accepts has the wrong format; one that a
    lenient reading accepts is a date, but not a strict one.
    """
    return F.when(
        strict_date(c).isNull(),
        F.when(lenient_date(c).isNull(), F.lit("Invalid Format")).otherwise(
            F.lit("Valid Format but Invalid Date")
        ),
    )


def counts_agree(count: Column, kind: Column) -> Column:
    """A positive count needs a non-blank kind, a zero count a blank or missing one.

    A null count agrees with everything.
    """
    blank = kind.isNull() | (F.trim(kind) == "")
    return ~holds(((count > 0) & blank) | ((count == 0) & ~blank))
