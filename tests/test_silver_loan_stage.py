"""Silver loans: one compiled stage from the bronze file on, with the values of the rules column by column."""

import re

import pytest
from pyspark.sql import functions as F

from siltstone import credit
from siltstone.functions.casts import whole_number
from siltstone.functions.cleaning import clean_number
from siltstone.plans.silver import silver_loan_daily

AMOUNTS = [None, "", "$", "7.50", "$7.50", "$$7", "-7", "7_", "1.2.3", ".", "1,5", ",", "1e3", " 7 ", "NaN", "9" * 23, "٧"]
COUNTS = ["10", "10.0", " 3", "2147483648", "1e2", "-4", "10.5", "first", None, "NaN"]
NAMES = ("loan_id", "Customer_ID", "loan_start_date", *credit.LOAN_COUNT_COLUMNS, *credit.LOAN_MONEY_COLUMNS)


@pytest.fixture
def bronze(spark, tmp_path):
    once = ("CUS_0x1_2023_01_01", "CUS_0x1", "2023-01-01")
    n = len(AMOUNTS)
    rows = [(*once, COUNTS[k], "1", *[AMOUNTS[(k + i * step) % n] for step in (1, 2, 3, 5, 7)])
            for k in range(len(COUNTS)) for i in range(n)]
    rows += [(*once, "1", count, *AMOUNTS[3:8]) for count in COUNTS]
    df = spark.createDataFrame(rows, ", ".join(f"{name} string" for name in NAMES))
    df.withColumn("snapshot_date", F.to_date(F.lit("2023-05-01"))).write.parquet(str(tmp_path / "bronze"))
    return spark.read.parquet(str(tmp_path / "bronze"))


def _codegen(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")


def test_silver_loans_are_one_stage_that_is_compiled(bronze):
    text = _codegen(silver_loan_daily(bronze))
    assert "Found 1 WholeStageCodegen subtrees" in text
    assert all(int(size) < 8000 for size in re.findall(r"maxMethodCodeSize:(\d+)", text))


@pytest.mark.parametrize("keep_sign", [True, False])
def test_values_are_those_of_the_rules_column_by_column(bronze, keep_sign):
    counts = {name: whole_number(F.col(name)) for name in credit.LOAN_COUNT_COLUMNS}
    amounts = {name: clean_number(F.col(name), on_null="zero", keep_sign=keep_sign) for name in credit.LOAN_MONEY_COLUMNS}
    expected = bronze.withColumns(counts | amounts).dropna(subset=list(counts))
    expected = expected.withColumn("loan_start_date", F.to_date("loan_start_date")).select(*NAMES)
    found = silver_loan_daily(bronze, keep_sign=keep_sign).select(*NAMES)
    assert found.schema.simpleString() == expected.schema.simpleString()
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(found) == rows(expected) and found.count() > len(AMOUNTS)
