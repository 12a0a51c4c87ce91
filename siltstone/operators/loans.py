"""Loan performance: summaries, days past due, labels and bad-rate curves.

The definitions of `with_days_past_due` and `performance_labels` are this
library's own: only the threshold rule ``dpd >= n`` and the two parameters
(days, months on book) were given.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.cleaning import flag_at_least

# The calendar repeats after this many months, which have this many days.
CYCLE_MONTHS, CYCLE_DAYS = 4800, 146_097


def loan_summary(df: DataFrame, keys: Sequence[str] = ("Customer_ID", "snapshot_date")) -> DataFrame:
    """Number of loans, their total amount and the largest overdue amount per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("loan_cnt"),
        F.sum("loan_amt").alias("loan_amt_sum"),
        F.max("overdue_amt").alias("max_overdue"),
    )


def with_days_past_due(df: DataFrame) -> DataFrame:
    """Adds ``mob``, ``installments_missed``, ``first_missed_date`` and ``dpd``.

    ``mob`` (months on book) is the installment number. A loan has missed
    ``ceil(overdue / due)`` installments (BIGINT), none where nothing is due or
    overdue; the first missed one lies that many months before the snapshot, and
    ``dpd`` (BIGINT) is the number of days since then. Where that month lies before
    year 1, ``first_missed_date`` is null and ``dpd`` counts on in the same calendar:
    whole cycles of 400 years and the months left over. A number of installments or of
    days beyond BIGINT is null, which `past_due` counts as past due.
    """
    overdue, due, day = F.col("overdue_amt"), F.col("due_amt"), F.col("snapshot_date")
    missed = F.col("installments_missed")
    owed = (overdue > 0) & (due > 0)
    ratio = F.try_divide(overdue, due)
    # Beyond BIGINT the first branch is null.
    whole = F.when(ratio < float(1 << 63), F.ceil(ratio))
    count = F.when(owed, whole).otherwise(F.lit(0)).cast("bigint")
    since_year_one = (F.year(day) - 1) * 12 + F.month(day) - 1
    first = F.when((missed > 0) & (missed <= since_year_one), F.add_months(day, -missed.cast("int")))
    left_over = F.datediff(day, F.add_months(day, -(missed % CYCLE_MONTHS).cast("int"))).cast("bigint")
    cycles = F.try_multiply(F.floor(missed / CYCLE_MONTHS).cast("bigint"), F.lit(CYCLE_DAYS).cast("bigint"))
    days = F.when(missed.isNull() | (missed > 0), F.try_add(cycles, left_over)).otherwise(F.lit(0))
    # Exploded, an array of one number is that number, and what follows is a generated method of its
    # own: together with the cleaning before it, one would be too long to be compiled.
    return (
        df.withColumns({"mob": F.col("installment_num"), "installments_missed": F.explode(F.array(count))})
        .withColumn("first_missed_date", first)
        .withColumn("dpd", F.when(day.isNotNull(), days).otherwise(F.lit(0)).cast("bigint"))
    )


def past_due(dpd: Column, days: int) -> Column:
    """1 from so many days past due on, else 0; null days are more than BIGINT holds."""
    return F.when(dpd.isNull(), F.lit(1)).otherwise(flag_at_least(dpd, days))


def performance_labels(df: DataFrame, *, dpd: int = 30, mob: int = 6) -> DataFrame:
    """Labels of the loans that are ``mob`` months old: 1 from ``dpd`` days past due on.

    Expects the columns of `with_days_past_due`.
    """
    return df.where(F.col("mob") == mob).select(
        "loan_id",
        "Customer_ID",
        past_due(F.col("dpd"), dpd).alias("label"),
        F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"),
        "snapshot_date",
    )


def bad_rate_by_mob(df: DataFrame, *, dpd: int = 30, started_before: date = date(2024, 1, 1)) -> DataFrame:
    """Share of rows at least ``dpd`` days past due per month on book, in order.

    Only loans that started before the given day count. Expects the columns of
    `with_days_past_due`.
    """
    return (
        df.where(F.col("loan_start_date") < F.lit(started_before))
        .groupBy("mob")
        .agg(
            F.avg(past_due(F.col("dpd"), dpd)).alias("bad_rate"),
            F.count(F.lit(1)).alias("row_count"),
        )
        .orderBy("mob")
    )


def at_installment(df: DataFrame, number: int = 10) -> DataFrame:
    """Rows of one installment number."""
    return df.where(F.col("installment_num") == number)
