"""Days past due of the raw loans: no generated method is left to the interpreter, and every row stays."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from siltstone.catalog.queries import QUERIES
from siltstone.operators.loans import with_days_past_due


@pytest.mark.parametrize("name", ["dpd_columns", "gold_labels"])
def test_days_past_due_are_compiled_with_default_settings(spark, sf_dir, name):
    """The virtual machine leaves methods of more than 8,000 bytes to its interpreter."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan()
    debug = spark._jvm.org.apache.spark.sql.execution.debug
    generated = getattr(getattr(debug, "package$"), "MODULE$").codegenStringSeq(plan)
    sizes = [generated.apply(i)._3().maxMethodCodeSize() for i in range(generated.size())]
    assert sizes and max(sizes) <= 8000


def test_rows_without_a_count_stay_and_columns_of_the_same_name_are_replaced(spark):
    day = date(2023, 5, 1)
    rows = [(2, 25.0, 10.0, day), (2, 25.0, 10.0, day), (None, None, None, None), (1, 1e300, 1e-5, day), (0, 5.0, 0.0, None)]
    df = spark.createDataFrame(rows, "installment_num int, overdue_amt double, due_amt double, snapshot_date date")
    df = df.withColumns({"Installments_Missed": F.lit("x"), "mob": F.lit("y")})
    found = with_days_past_due(df)
    assert [name.lower() for name in found.columns] == [*map(str.lower, df.columns), "first_missed_date", "dpd"]
    values = sorted(map(tuple, found.select("mob", "installments_missed", "first_missed_date", "dpd").collect()), key=str)
    assert values == sorted(
        [(2, 3, date(2023, 2, 1), 89)] * 2 + [(None, 0, None, 0), (1, None, None, None), (0, 0, None, 0)], key=str
    )
