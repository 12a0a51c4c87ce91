"""Registered queries: each reads the whole driver tables below ``sf_dir``.

Some write tables on their way, into a new folder below that of spark.checkpoint.dir; a
result is read from there, so clear the folder when the results have been read.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import credit
from siltstone.functions import cleaning, validity
from siltstone.functions.casts import double_to_int, lenient_date
from siltstone.functions.free_dates import with_free_date
from siltstone.operators import loans, quality, sketches, snapshots
from siltstone.operators.dedup import duplicate_keys, keep_first
from siltstone.operators.rules import rewrite_present
from siltstone.plans import gold, quality_report
from siltstone.plans.backfill import Layout, all_months, backfill
from siltstone.plans.stage_counts import row_counts
from siltstone.plans.silver import CLEANERS, silver_financials, silver_loan_daily
from siltstone.sources.derived import CSV_COLUMNS, TABLES, csv_records, free_days, raw_table, raw_tables
from siltstone.sources.snapshot_store import (
    NoSnapshotsError, list_snapshots, read_month, read_snapshots, snapshot_counts, write_snapshots,
)
from siltstone.sources.text_files import read_csv_checked
from siltstone.sources.work_folder import work_folder

Query = Callable[[SparkSession, str], DataFrame]

SLICE_DAY = date(2023, 6, 1)
FIRST_YEAR = snapshots.month_starts("2023-01-01", "2023-12-01")


def _silver(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return CLEANERS[table](raw_table(spark, sf_dir, table))


def _bronze(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return rewrite_present(raw_table(spark, sf_dir, table), {"snapshot_date": lenient_date})


def _gold(spark: SparkSession, sf_dir: str, *, with_loans: bool = False) -> DataFrame:
    tables = [_silver(spark, sf_dir, name) for name in ("clickstream", "attributes", "financials")]
    if not with_loans:
        return gold.gold_features(*tables)
    return _rounded_sum(gold.gold_features(*tables, _silver(spark, sf_dir, "loan_daily")))


def _rounded_sum(df: DataFrame) -> DataFrame:
    """A sum of doubles depends on the order of addition; cents do not."""
    return df.withColumn("loan_amt_sum", F.round("loan_amt_sum", 2))


def _performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loans.with_days_past_due(_silver(spark, sf_dir, "loan_daily"))


# --- snapshots


def date_spine(spark, sf_dir):
    return snapshots.spine_counts(_bronze(spark, sf_dir, "loan_daily"))


def snapshot_slice(spark, sf_dir):
    return snapshots.snapshot_slice(_bronze(spark, sf_dir, "loan_daily"), SLICE_DAY)


def off_spine_rows(spark, sf_dir):
    return snapshots.off_spine(_bronze(spark, sf_dir, "loan_daily"), FIRST_YEAR)


def feature_store_union(spark, sf_dir):
    """The feature store, written once for all months, then united from one frame per month found there."""
    path = work_folder(spark, "feature-store")
    write_snapshots(_gold(spark, sf_dir), path, all_months())
    whole = read_snapshots(spark, path)
    try:
        days = list_snapshots(spark, path)
    except NoSnapshotsError:
        return whole
    return snapshots.union_snapshots([read_month(spark, path, day, whole) for day in days])


def label_store_union(spark, sf_dir):
    """The label stores of one year and of all other dates, their columns in another order."""
    labels = gold.gold_labels(_silver(spark, sf_dir, "loan_daily"))
    first = F.coalesce(snapshots.on_snapshots(FIRST_YEAR), F.lit(False))
    rest = labels.where(~first)
    return snapshots.union_snapshots([labels.where(first), rest.select(*reversed(rest.columns))])


def _mart(spark: SparkSession, sf_dir: str) -> Layout:
    """Bronze, silver and gold on disk: all months but one, that one by itself, and then another one again."""
    root = work_folder(spark, "mart")
    sources = raw_tables(spark, sf_dir)
    first = [day for day in all_months() if day != SLICE_DAY]
    for months in (first, [SLICE_DAY], first[-1:]):
        backfill(spark, sources, root, months)
    return Layout(root)


def mart_round_trip(spark, sf_dir):
    """The feature store read back from disk, after months of it were run by themselves and again."""
    return read_snapshots(spark, _mart(spark, sf_dir).table("gold", "feature_store"))


def mart_month_counts(spark, sf_dir):
    """Rows per month of every table on disk, from the footers of their files."""
    layout = _mart(spark, sf_dir)
    tables = [(zone, table) for zone in ("bronze", "silver") for table in TABLES]
    tables += [("gold", "feature_store"), ("gold", "label_store")]
    counts = [
        snapshot_counts(read_snapshots(spark, layout.table(zone, table)))
        .where(F.col("snapshot_date").isNotNull())
        .select(F.lit(zone).alias("zone"), F.lit(table).alias("table_name"), "snapshot_date", "row_count")
        for zone, table in tables
    ]
    return snapshots.union_snapshots(counts)


def csv_round_trip(spark, sf_dir):
    """Records written as CSV and read back: the rows, and the broken records with what is wrong with them."""
    folder = work_folder(spark, "csv")
    header = spark.range(1).select(F.lit(",".join(CSV_COLUMNS)).alias("value"))
    header.unionAll(csv_records(spark, sf_dir)).write.text(folder)
    read = read_csv_checked(spark, folder, CSV_COLUMNS, line_breaks=True)
    none = lambda names: {name: F.lit(None).cast("string") for name in names}
    return snapshots.union_snapshots(
        [read.rows.withColumns(none(("record", "reason"))), read.broken.drop("file").withColumns(none(CSV_COLUMNS))]
    )


def row_counts_by_stage(spark, sf_dir):
    """Rows of every table of every zone; each raw table is read once."""
    return row_counts(raw_tables(spark, sf_dir))


# --- silver


def silver_financials_options(spark, sf_dir):
    return silver_financials(
        raw_table(spark, sf_dir, "financials"),
        keep_sign=True,
        keep_null_limit=True,
        canonical_min_payment=True,
        strip_counts=True,
        min_count=0,
    )


def silver_loan_daily_signed(spark, sf_dir):
    return silver_loan_daily(raw_table(spark, sf_dir, "loan_daily"), keep_sign=True)


# --- cleaning


def clean_number_keep_sign(spark, sf_dir):
    return raw_table(spark, sf_dir, "financials").select(
        *credit.KEYS,
        cleaning.clean_number(F.col("Annual_Income"), 2, keep_sign=True).alias("annual_income"),
        cleaning.clean_number(F.col("Changed_Credit_Limit"), 2, keep_sign=True).alias("credit_limit"),
        cleaning.clean_number(F.col("Monthly_Balance"), 4, on_null="zero", keep_sign=True).alias("balance"),
    )


def number_coerce(spark, sf_dir):
    amounts = (
        "Credit_Utilization_Ratio",
        "Total_EMI_per_month",
        "Amount_invested_monthly",
        "Monthly_Balance",
    )
    incomes = ("Annual_Income", "Monthly_Inhand_Salary", "Changed_Credit_Limit")
    return raw_table(spark, sf_dir, "financials").select(
        *credit.KEYS,
        *[cleaning.coerce_number(F.col(name), 2).alias(name) for name in incomes],
        *[cleaning.coerce_number(F.col(name), 4, on_null="zero").alias(name) for name in amounts],
    )


def outstanding_debt(spark, sf_dir):
    return raw_table(spark, sf_dir, "financials").select(
        *credit.KEYS,
        cleaning.clean_number(F.col("Outstanding_Debt"), 2, on_null="zero").alias("Outstanding_Debt"),
    )


def min_payment_exact(spark, sf_dir):
    answer = cleaning.exact_category(F.col("Payment_of_Min_Amount"), credit.MIN_PAYMENT_ANSWERS)
    return quality.value_counts(raw_table(spark, sf_dir, "financials").select(answer.alias("answer")), "answer")


def behaviour_joint_split(spark, sf_dir):
    parts = cleaning.joint_extract(
        F.col("Payment_Behaviour"), credit.SPEND_AND_VALUE, ["Spend_Level", "Payment_Value"]
    )
    return raw_table(spark, sf_dir, "financials").select(
        *credit.KEYS, "Payment_Behaviour", *[part.alias(name) for name, part in parts.items()]
    )


def credit_history_months(spark, sf_dir):
    return raw_table(spark, sf_dir, "financials").select(
        *credit.KEYS,
        "Credit_History_Age",
        cleaning.year_month_total(F.col("Credit_History_Age")).alias("history_months"),
    )


def age_band_counts(spark, sf_dir):
    label = cleaning.band(cleaning.int_without_underscores(F.col("Age")), credit.AGE_BANDS)
    return quality.label_counts(raw_table(spark, sf_dir, "attributes"), label, credit.AGE_LABELS, "age_group")


def age_band_cut_open(spark, sf_dir):
    age = cleaning.coerce_number(F.regexp_replace("Age", "_", ""))
    whole = F.when(age.isNotNull(), double_to_int(age))
    label = cleaning.band(whole, credit.AGE_BANDS, above=0)
    return quality.label_counts(raw_table(spark, sf_dir, "attributes"), label, credit.AGE_LABELS, "age_group")


def age_band_invalid(spark, sf_dir):
    age = cleaning.coerce_number(F.col("Age"))
    label = cleaning.band(age, credit.AGE_BANDS[1:], above=17, default="Invalid")
    return quality.value_counts(raw_table(spark, sf_dir, "attributes").select(label.alias("age_group")), "age_group")


# --- quality


def _profile(table: str) -> Query:
    return lambda spark, sf_dir: quality_report.profile_table(raw_table(spark, sf_dir, table), table)


def null_profile(spark, sf_dir):
    return quality_report.null_report(raw_tables(spark, sf_dir))


def full_quality_report(spark, sf_dir):
    return quality_report.quality_report(raw_tables(spark, sf_dir))


def loan_type_conflicts(spark, sf_dir):
    agree = validity.counts_agree(cleaning.coerce_number(F.col("Num_of_Loan")), F.col("Type_of_Loan"))
    rule = quality.RowRule("loans_agree", "Type_of_Loan", agree)
    rows = quality.invalid_rows(raw_table(spark, sf_dir, "financials"), rule)
    return rows.select(*credit.KEYS, "Num_of_Loan", "Type_of_Loan")


def invalid_samples(spark, sf_dir):
    rule = quality.Rule("loan_id", "loan_id", lambda c: validity.matches(c, validity.LOAN_ID))
    return quality.invalid_samples(raw_table(spark, sf_dir, "loan_daily"), rule, 10)


def invalid_patterns(spark, sf_dir):
    rule = quality.Rule("numeric", "due_amt", validity.is_numeric)
    return quality.invalid_patterns(raw_table(spark, sf_dir, "loan_daily"), rule, 5)


def invalid_day_reasons(spark, sf_dir):
    raw = raw_table(spark, sf_dir, "loan_daily").select("loan_start_date")
    rule = quality.Rule("strict_day", "loan_start_date", validity.is_strict_day)
    reasons = quality.invalid_rows(raw, rule).select(
        "loan_start_date", validity.day_fault(F.col("loan_start_date")).alias("reason")
    )
    return reasons.groupBy("loan_start_date", "reason").agg(F.count(F.lit(1)).alias("row_count"))


def loan_day_patterns(spark, sf_dir):
    """The most frequent bad texts of both dates of a loan, each with what is wrong with it."""
    raw = raw_table(spark, sf_dir, "loan_daily")
    days = ("loan_start_date", "snapshot_date")
    return snapshots.union_snapshots([quality_report.day_patterns(raw, name) for name in days])


def invalid_loan_day_samples(spark, sf_dir):
    """Rows with a bad start date, with the columns that identify them."""
    rule = quality.Rule("strict_day", "loan_start_date", validity.is_strict_day)
    ids = ("loan_id", "Customer_ID", "installment_num")
    return quality.invalid_samples(raw_table(spark, sf_dir, "loan_daily"), rule, 20, ids=ids)


def invalid_customer_samples(spark, sf_dir):
    rule = quality.Rule("ssn", "SSN", lambda c: validity.matches(c, validity.SSN))
    return quality.invalid_samples(raw_table(spark, sf_dir, "attributes"), rule, ids=("Customer_ID", "Name"))


def invalid_distinct_by_sketch(spark, sf_dir):
    """Distinct failing values per rule, from the sketches stored for each month."""
    path = work_folder(spark, "sketches")
    columns = ("loan_id", "Customer_ID", "loan_start_date", *credit.LOAN_COUNT_COLUMNS, "due_amt", "paid_amt")
    rules = [rule for rule in quality_report.loan_rules() if rule.column in columns]
    sketches.store_sketches(_bronze(spark, sf_dir, "loan_daily"), "loan_daily", rules, path, all_months())
    return sketches.distinct_invalid(spark, path)


def free_day_texts(spark, sf_dir):
    """Days in many forms, read by the shapes that the whole column has."""
    texts = free_days(spark, sf_dir)
    return with_free_date(texts.withColumn("day", F.col("day_text")), "day")


def occupation_counts(spark, sf_dir):
    return quality.value_counts(raw_table(spark, sf_dir, "attributes"), "Occupation", nulls=True)


def unknown_occupation(spark, sf_dir):
    return raw_table(spark, sf_dir, "attributes").where(F.col("Occupation") == credit.UNKNOWN_OCCUPATION)


def distinct_occupations(spark, sf_dir):
    return quality.distinct_values(raw_table(spark, sf_dir, "attributes"), "Occupation")


def ssn_validity_counts(spark, sf_dir):
    valid = validity.holds(validity.matches(F.col("SSN"), validity.SSN))
    verdict = F.when(valid, F.lit("Valid")).otherwise(F.lit("Invalid"))
    return quality.value_counts(raw_table(spark, sf_dir, "attributes").select(verdict.alias("ssn")), "ssn")


def name_validity(spark, sf_dir):
    return raw_table(spark, sf_dir, "attributes").select(
        "Customer_ID", "Name", validity.holds(validity.is_person_name(F.col("Name"))).alias("valid_name")
    )


def age_histogram(spark, sf_dir):
    return quality.histogram(_silver(spark, sf_dir, "attributes"), "Age", 30)


# --- dedup, loans


def duplicate_keys_clickstream(spark, sf_dir):
    return duplicate_keys(raw_table(spark, sf_dir, "clickstream"), credit.KEYS)


def keep_first_clickstream(spark, sf_dir):
    return keep_first(raw_table(spark, sf_dir, "clickstream"), credit.KEYS)


def loan_summary(spark, sf_dir):
    return _rounded_sum(loans.loan_summary(_silver(spark, sf_dir, "loan_daily")))


def gold_labels(spark, sf_dir):
    return gold.gold_labels(_silver(spark, sf_dir, "loan_daily"))


def label_balance(spark, sf_dir):
    labels = gold_labels(spark, sf_dir)
    return labels.groupBy("snapshot_date", "label_def").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("label") == 1).alias("bad_count")
    )


def bad_rate_by_mob(spark, sf_dir):
    return loans.bad_rate_by_mob(_performance(spark, sf_dir))


def final_installment_rows(spark, sf_dir):
    return loans.at_installment(_silver(spark, sf_dir, "loan_daily"))


QUERIES: dict[str, Query] = {
    "date_spine": date_spine,
    "snapshot_slice": snapshot_slice,
    "off_spine_rows": off_spine_rows,
    "silver_clickstream": partial(_silver, table="clickstream"),
    "silver_attributes": partial(_silver, table="attributes"),
    "silver_financials": partial(_silver, table="financials"),
    "silver_loan_daily": partial(_silver, table="loan_daily"),
    "silver_financials_options": silver_financials_options,
    "silver_loan_daily_signed": silver_loan_daily_signed,
    "clean_number_keep_sign": clean_number_keep_sign,
    "number_coerce": number_coerce,
    "outstanding_debt": outstanding_debt,
    "min_payment_exact": min_payment_exact,
    "behaviour_joint_split": behaviour_joint_split,
    "credit_history_months": credit_history_months,
    "age_band_counts": age_band_counts,
    "age_band_cut_open": age_band_cut_open,
    "age_band_invalid": age_band_invalid,
    "null_profile": null_profile,
    "profile_clickstream": _profile("clickstream"),
    "profile_attributes": _profile("attributes"),
    "profile_financials": _profile("financials"),
    "profile_loans": _profile("loan_daily"),
    "quality_report": full_quality_report,
    "loan_type_conflicts": loan_type_conflicts,
    "invalid_samples": invalid_samples,
    "invalid_patterns": invalid_patterns,
    "invalid_day_reasons": invalid_day_reasons,
    "loan_day_patterns": loan_day_patterns,
    "invalid_loan_day_samples": invalid_loan_day_samples,
    "invalid_customer_samples": invalid_customer_samples,
    "occupation_counts": occupation_counts,
    "unknown_occupation": unknown_occupation,
    "distinct_occupations": distinct_occupations,
    "ssn_validity_counts": ssn_validity_counts,
    "name_validity": name_validity,
    "age_histogram": age_histogram,
    "duplicate_keys": duplicate_keys_clickstream,
    "keep_first": keep_first_clickstream,
    "loan_summary": loan_summary,
    "gold_features": _gold,
    "gold_features_with_loans": partial(_gold, with_loans=True),
    "dpd_columns": _performance,
    "gold_labels": gold_labels,
    "label_balance": label_balance,
    "bad_rate_by_mob": bad_rate_by_mob,
    "final_installment_rows": final_installment_rows,
    "mart_round_trip": mart_round_trip,
    "mart_month_counts": mart_month_counts,
    "csv_round_trip": csv_round_trip,
    "invalid_distinct_by_sketch": invalid_distinct_by_sketch,
    "free_day_texts": free_day_texts,
    "feature_store_union": feature_store_union,
    "label_store_union": label_store_union,
    "row_counts_by_stage": row_counts_by_stage,
}
