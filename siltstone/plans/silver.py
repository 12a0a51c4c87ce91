"""Bronze to silver: raw text tables to clean, typed ones.

Every plan is narrow: one scan, one projection, one filter, no shuffle. Rules
for columns which a table lacks are skipped; the key columns are mandatory. With ``mark``,
a column from `rules.marking`, rows are not dropped: that column is cleared in them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import credit
from siltstone.functions.casts import (
    SMALL_INTEGER_FIELD,
    SURE_DAY_FIELD,
    cast_present,
    double_to_int,
    doubles,
    fields_match,
    int_or_default,
    is_whole,
    lenient_date,
    lenient_double,
    lenient_ints,
    strict_date,
    whole_double,
)
from siltstone.functions.cleaning import band, category, clean_number, clean_numbers, int_without_underscores
from siltstone.functions.validity import CUSTOMER_ID, LOAN_ID, SSN, counts_agree, matches
from siltstone.operators.rules import drop_null_present, keep_numbers, keep_where, rewrite_numbers, rewrite_present

_valid_customer = partial(matches, pattern=CUSTOMER_ID)
_valid_loan = partial(matches, pattern=LOAN_ID)
_valid_ssn = partial(matches, pattern=SSN)

_LOAN_IDS = ("loan_id", "Customer_ID")
#: The condition of a row that is kept, and a pattern of texts that are sure to meet it (see `fields_match`).
_LOAN_RULES: Mapping[str, tuple[Callable[[Column], Column], str]] = {
    "loan_id": (_valid_loan, r"CUS_0x[0-9a-fA-F]+_[0-9]{4}_[0-9]{2}_[0-9]{2}"),
    "Customer_ID": (_valid_customer, r"CUS_0x[0-9a-fA-F]+"),
    "loan_start_date": (lambda c: strict_date(c).isNotNull(), SURE_DAY_FIELD),
    "tenure": (lambda c: is_whole(lenient_double(c)), SMALL_INTEGER_FIELD),
    "installment_num": (lambda c: is_whole(lenient_double(c)), SMALL_INTEGER_FIELD),
}


def silver_clickstream(raw: DataFrame, *, mark: str | None = None) -> DataFrame:
    """Features as INT; drops rows with an unreadable feature or customer id."""
    df = keep_where(raw, "Customer_ID", _valid_customer, required=True, mark=mark)
    df = rewrite_present(df, {"snapshot_date": lenient_date})
    features = [name for name in credit.CLICK_FEATURES if name in df.columns]
    if not features:
        return df
    return keep_numbers(df, features, lenient_ints, mark=mark)


def silver_attributes(raw: DataFrame, *, mark: str | None = None) -> DataFrame:
    """Drops names; keeps valid ids and SSNs and ages 18 to 65; adds the age band."""
    df = keep_where(raw.drop("Name"), "Customer_ID", _valid_customer, required=True, mark=mark)
    df = keep_where(df, "SSN", _valid_ssn, mark=mark)
    if "Age" in df.columns:
        # Filtering by the age and not by its band keeps the condition small: the
        # optimizer writes the whole ladder out where a band is filtered.
        df = df.withColumn("Age", int_without_underscores(F.col("Age")))
        df = keep_where(df, "Age", lambda age: age.between(*credit.AGES_KEPT), mark=mark)
        df = df.withColumn("Age_Group", band(F.col("Age"), credit.AGE_BANDS))
    return cast_present(df, {"snapshot_date": "date"})


def silver_financials(
    raw: DataFrame,
    *,
    keep_sign: bool = False,
    keep_null_limit: bool = False,
    canonical_min_payment: bool = False,
    strip_counts: bool = False,
    min_count: int | None = None,
    mark: str | None = None,
) -> DataFrame:
    """Counts as INT, amounts as DOUBLE, payment behaviour split in two.

    Drops rows with a bad customer id, with a loan count that contradicts the
    loan type, without a loan type, or without a credit limit change.

    By default a minus sign in an amount is dropped like other dirt. With
    ``keep_sign`` it is kept, and rows with a negative value in a column that
    must not be negative are dropped. ``keep_null_limit`` keeps rows without a
    limit change, ``canonical_min_payment`` spells the answers Yes/No/NM,
    ``strip_counts`` reads ``7_`` as 7 and not 0, ``min_count`` zeroes smaller
    counts.
    """
    number = partial(clean_number, keep_sign=keep_sign)
    counts = partial(int_or_default, strip=strip_counts, min_value=min_count)
    df = keep_where(raw, "Customer_ID", _valid_customer, required=True, mark=mark)
    df = rewrite_present(
        df,
        {
            **{name: counts for name in credit.COUNT_COLUMNS},
            "Annual_Income": partial(number, scale=2),
            "Monthly_Inhand_Salary": partial(number, scale=2),
            "Changed_Credit_Limit": partial(number, scale=2),
            "Outstanding_Debt": partial(number, scale=2, on_null="zero"),
            "Credit_Utilization_Ratio": partial(number, scale=4, on_null="zero"),
            "Payment_of_Min_Amount": partial(
                category, allowed=credit.MIN_PAYMENT_ANSWERS, canonical=canonical_min_payment
            ),
            "Total_EMI_per_month": partial(number, scale=4, on_null="zero"),
            "Amount_invested_monthly": partial(number, scale=4, on_null="zero"),
            "Monthly_Balance": partial(number, scale=4, on_null="zero"),
            "snapshot_date": lenient_date,
        },
    )
    if "Payment_Behaviour" in df.columns:
        df = df.withColumns(
            {
                "Spend_Level": F.regexp_extract("Payment_Behaviour", credit.SPEND_LEVEL, 1),
                "Payment_Value": F.regexp_extract("Payment_Behaviour", credit.PAYMENT_VALUE, 1),
            }
        )
    df = keep_where(
        df,
        ["Num_of_Loan", "Type_of_Loan"],
        lambda count, kind: counts_agree(count, kind) & kind.isNotNull(),
        mark=mark,
    )
    return _keep_valid_amounts(df, keep_sign, keep_null_limit, mark)


def _keep_valid_amounts(df: DataFrame, keep_sign: bool, keep_null_limit: bool, mark: str | None) -> DataFrame:
    """Range filters, left out where the cleaning already implies them."""
    if keep_sign:
        for name in (
            "Credit_Utilization_Ratio",
            "Total_EMI_per_month",
            "Amount_invested_monthly",
            "Monthly_Balance",
        ):
            df = keep_where(df, name, lambda c: c >= 0, mark=mark)
        if keep_null_limit:
            return keep_where(df, "Changed_Credit_Limit", lambda c: c.isNull() | (c >= 0), mark=mark)
        return keep_where(df, "Changed_Credit_Limit", lambda c: c >= 0, mark=mark)
    return df if keep_null_limit else drop_null_present(df, ["Changed_Credit_Limit"], mark=mark)


def silver_loan_daily(raw: DataFrame, *, keep_sign: bool = False, mark: str | None = None) -> DataFrame:
    """Dates, counts and amounts typed; drops bad ids, start dates and counts."""
    # All that is checked stands in one condition: one match tells most rows that are kept.
    rules = {name: rule for name, rule in _LOAN_RULES.items() if name in raw.columns or name in _LOAN_IDS}
    sure = [rule[1] for rule in rules.values()]
    df = keep_where(
        raw,
        list(rules),
        lambda *texts: fields_match(texts, sure)
        | reduce(Column.__and__, [rule[0](c) for rule, c in zip(rules.values(), texts)]),
        required=True,
        mark=mark,
    )
    money, zero = partial(clean_numbers, keep_sign=keep_sign), lambda amount: F.coalesce(amount, F.lit(0.0))
    # Counts are cast without a match of their own: of rows that are kept, all are whole numbers.
    whole = double_to_int if mark is None else whole_double
    families = ((credit.LOAN_COUNT_COLUMNS, doubles, whole), (credit.LOAN_MONEY_COLUMNS, money, zero))
    df = rewrite_numbers(df, *[([name for name in names if name in df.columns], *rules) for names, *rules in families])
    # Of rows that are kept, the start date has been matched.
    started = lenient_date if mark is None else strict_date
    return rewrite_present(df, {"loan_start_date": started, "snapshot_date": lenient_date})


CLEANERS: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "clickstream": silver_clickstream,
    "attributes": silver_attributes,
    "financials": silver_financials,
    "loan_daily": silver_loan_daily,
}
