"""What the mart spends per row and per task: amounts checked by one match, short read tasks."""

import itertools
from datetime import date

import pytest
from pyspark.sql import functions as F

from siltstone import credit
from siltstone.functions.cleaning import clean_number, clean_numbers
from siltstone.plans import backfill as plan
from siltstone.plans.silver import silver_loan_daily
from siltstone.sources.derived import raw_table, raw_tables

AMOUNTS = [
    None, "", "$", "7", "7.50", "$7.50", "$$7", "7$", "-7", "$-7", "7_", "__7__", "1.2.3", ".", ".5", "1,5", ",", "$,",
    "1e3", " 7 ", "7\n", "NaN", "9" * 23, "٧", "€7",
]
READ_SIZE = "spark.sql.files.maxPartitionBytes"


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("on_null", ["keep", "zero"])
@pytest.mark.parametrize("keep_sign", [True, False])
def test_an_array_of_amounts_holds_what_the_rule_gives_for_each(spark, ansi, on_null, keep_sign):
    df = spark.createDataFrame(list(itertools.product(AMOUNTS, repeat=2)), "a string, b string")
    options = {"on_null": on_null, "keep_sign": keep_sign}
    both = clean_numbers([F.col("a"), F.col("b")], **options)
    rows = df.select(both, *[clean_number(F.col(name), **options) for name in ("a", "b")]).collect()
    assert len(rows) == len(AMOUNTS) ** 2
    assert all(row[0] == [row[1], row[2]] for row in rows)


def test_amounts_of_a_loan_are_checked_by_one_match(spark, sf_dir):
    silver = silver_loan_daily(raw_table(spark, sf_dir, "loan_daily"))
    assert len(credit.LOAN_MONEY_COLUMNS) == 5
    assert silver._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1


@pytest.mark.parametrize("own", [None, "64m"])
def test_a_backfill_reads_in_short_tasks_and_leaves_the_session_as_it_was(spark, sf_dir, tmp_path, monkeypatch, own):
    before = spark.conf.get(READ_SIZE, None)
    seen, cleaners = [], dict(plan.CLEANERS)

    def cleaned(table, bronze):
        seen.append(spark.conf.get(READ_SIZE))
        return cleaners[table](bronze)

    monkeypatch.setattr(plan, "CLEANERS", {t: lambda bronze, t=t: cleaned(t, bronze) for t in cleaners})
    spark.conf.unset(READ_SIZE) if own is None else spark.conf.set(READ_SIZE, own)
    try:
        counts = plan.backfill(spark, raw_tables(spark, sf_dir), str(tmp_path), [date(2023, 5, 1)])
        assert spark.conf.get(READ_SIZE, None) == own
    finally:
        spark.conf.unset(READ_SIZE) if before is None else spark.conf.set(READ_SIZE, before)
    assert set(seen) == {own or plan.READ_SIZE} and len(seen) == 4
    assert counts["silver", "loan_daily"].total > 0
