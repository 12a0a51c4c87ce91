"""Several texts checked by one match: the same results as one check per column."""

import itertools

import pytest
from pyspark.sql import functions as F

from siltstone.catalog.queries import QUERIES
from siltstone.functions.casts import (
    SMALL_INTEGER_FIELD, SURE_DAY_FIELD, fields_match, lenient_int, lenient_ints, strict_date, whole_number,
    whole_numbers,
)
from siltstone.functions.validity import CUSTOMER_ID, LOAN_ID
from siltstone.operators.rules import marking
from siltstone.plans.silver import silver_clickstream, silver_loan_daily

TEXTS = [
    None, "", "7", "-7", "007", "+7", " 7 ", "7\n", "7.9", ".5", "1e3", "10.0", "10.5", "1,2", ",", "1,2,3", "bad", "-",
    "999999999", "9999999999", "-0", "NaN", "Infinity", "0x10", "1d",
]


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize(("together", "alone"), [(lenient_ints, lenient_int), (whole_numbers, whole_number)])
def test_an_array_of_numbers_holds_what_each_rule_gives(spark, ansi, together, alone):
    df = spark.createDataFrame(list(itertools.product(TEXTS, repeat=2)), "a string, b string")
    rows = df.select(together([F.col("a"), F.col("b")]).alias("both"), alone(F.col("a")), alone(F.col("b"))).collect()
    assert len(rows) == len(TEXTS) ** 2
    assert all(row[0] == [row[1], row[2]] for row in rows)


def test_a_match_of_all_fields_is_a_match_of_each(spark):
    df = spark.createDataFrame(list(itertools.product(TEXTS, repeat=2)), "a string, b string")
    each = [F.coalesce(c.rlike(rf"^{SMALL_INTEGER_FIELD}\z"), F.lit(False)) for c in (F.col("a"), F.col("b"))]
    both = fields_match([F.col("a"), F.col("b")], [SMALL_INTEGER_FIELD] * 2)
    assert df.where(~both.eqNullSafe(each[0] & each[1])).count() == 0
    assert df.where(both).count() == 25  # 7, -7, 007, 999999999, -0


def test_sure_days_are_days(spark):
    texts = [(f"{y}-{m:02d}-{d:02d}",) for y in ("1000", "2023", "2999") for m in range(14) for d in range(33)]
    df = spark.createDataFrame([*texts, ("0000-01-01",), ("2023-1-1",)], "day string")
    sure = df.where(fields_match([F.col("day")], [SURE_DAY_FIELD]))
    assert sure.count() == 3 * 12 * 28
    assert sure.where(strict_date(F.col("day")).isNull()).count() == 0


def clicks(spark):
    rows = [("CUS_0x1", "2023-01-01", a, b) for a, b in itertools.product(TEXTS, repeat=2)]
    return spark.createDataFrame(rows, "Customer_ID string, snapshot_date string, fe_1 string, fe_2 string")


def test_clicks_are_read_as_by_one_rule_per_feature(spark, ansi):
    raw = clicks(spark)
    numbers = raw.select(*[lenient_int(F.col(name)).alias(name) for name in ("fe_1", "fe_2")])
    wanted = sorted(tuple(row) for row in numbers.dropna().collect())
    silver = silver_clickstream(raw)
    assert silver.columns == raw.columns and dict(silver.dtypes)["fe_1"] == "int"
    assert sorted(tuple(row) for row in silver.select("fe_1", "fe_2").collect()) == wanted
    marked, mark = marking(raw)
    kept = silver_clickstream(marked, mark=mark)
    assert kept.count() == len(TEXTS) ** 2
    assert sorted(tuple(row) for row in kept.where(mark).select("fe_1", "fe_2").collect()) == wanted


def test_a_table_may_have_a_column_of_the_name_used_within(spark):
    silver = silver_clickstream(clicks(spark).withColumn("Numbers", F.lit("x")))
    assert silver.columns[-1] == "Numbers" and {row.Numbers for row in silver.collect()} == {"x"}


def test_loans_are_kept_as_by_one_rule_per_column(spark, ansi):
    ids = ["CUS_0xA_2023_01_01", "CUS_0xA_2023_01_01\n", "CUS_0xA,2023_01_01", "CUS_0xA", None]
    customers = ["CUS_0xA", "CUS_0xA\n", "BAD_1", None]
    days = ["2023-01-28", "2023-01-31", "2023-02-30", "2023-1-5", "0001-01-01", "2023-01-01,10", None]
    numbers = ["10", "10.0", "10.5", "1e1", "9999999999", "first", None]
    raw = spark.createDataFrame(
        list(itertools.product(ids, customers, days, numbers, numbers)),
        "loan_id string, Customer_ID string, loan_start_date string, tenure string, installment_num string",
    )
    kept = F.col("loan_id").rlike(LOAN_ID) & F.col("Customer_ID").rlike(CUSTOMER_ID)
    typed = raw.where(kept).select(
        "loan_id", "Customer_ID", strict_date(F.col("loan_start_date")), whole_number(F.col("tenure")),
        whole_number(F.col("installment_num")),
    )
    wanted = sorted(tuple(row) for row in typed.toDF(*raw.columns).dropna().collect())
    assert len(wanted) == 2 * 2 * 3 * 4 * 4
    assert sorted(tuple(row) for row in silver_loan_daily(raw).collect()) == wanted
    marked, mark = marking(raw)
    columns = raw.columns
    assert sorted(tuple(r) for r in silver_loan_daily(marked, mark=mark).where(mark).select(columns).collect()) == wanted


def test_tables_without_optional_columns_are_cleaned(spark):
    raw = spark.createDataFrame([("CUS_0xA_2023_01_01", "CUS_0xA"), ("x", "CUS_0xA")], "loan_id string, Customer_ID string")
    assert silver_loan_daily(raw).count() == 1
    assert silver_clickstream(raw.drop("loan_id")).columns == ["Customer_ID"]
    with pytest.raises(ValueError):
        silver_loan_daily(raw.drop("loan_id"))


@pytest.mark.parametrize("name", ["silver_clickstream", "silver_loan_daily"])
def test_generated_methods_are_compiled_with_default_settings(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan()
    generated = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$").codegenStringSeq(plan)
    assert max(generated.apply(i)._3().maxMethodCodeSize() for i in range(generated.size())) <= 8000


def test_features_are_read_once(spark, tmp_path):
    """No filter below the projection reads them a second time."""
    clicks(spark).write.parquet(str(tmp_path / "clicks"))
    plan = silver_clickstream(spark.read.parquet(str(tmp_path / "clicks")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat_ws(") == 1 and plan.count("Filter") == 1


def test_ids_of_loans_take_one_match(spark, sf_dir):
    plan = QUERIES["silver_loan_daily"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.split("\n") if "Filter" in line]
    assert any("concat_ws(" in line for line in filters)
