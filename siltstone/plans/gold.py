"""Silver to gold: the feature store and the label store."""

from __future__ import annotations

from pyspark.sql import DataFrame

from siltstone import credit
from siltstone.operators.joins import attach
from siltstone.operators.loans import loan_summary, performance_labels, with_days_past_due


def gold_features(
    clickstream: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    loan_daily: DataFrame | None = None,
) -> DataFrame:
    """One row per customer and month: financials, click features, age, occupation.

    Customers without financials are left out. With ``loan_daily`` the loan
    summary is added.
    """
    blocks = [
        clickstream.select(*credit.KEYS, *credit.CLICK_FEATURES),
        attributes.select(*credit.KEYS, "Age", "Occupation"),
    ]
    features = attach(financials, blocks, credit.KEYS)
    if loan_daily is None:
        return features
    return attach(features, [loan_summary(loan_daily, credit.KEYS)], credit.KEYS, dedup=False)


def gold_labels(loan_daily: DataFrame, *, dpd: int = 30, mob: int = 6) -> DataFrame:
    """Performance labels of all snapshots of the silver loan table."""
    return performance_labels(with_days_past_due(loan_daily), dpd=dpd, mob=mob)
