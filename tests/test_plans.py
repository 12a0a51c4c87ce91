"""What the physical plans must look like."""

import re

import pytest

from siltstone.catalog.queries import QUERIES
from siltstone.plans.quality_report import profile_table
from siltstone.sources.derived import TABLES, raw_table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


SAMPLES = {"invalid_samples", "invalid_loan_day_samples", "invalid_customer_samples"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert not re.search("Python|Pandas|ArrowEval|CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert ("MapInArrow" in plan) == (name in SAMPLES)


@pytest.mark.parametrize("name", sorted(SAMPLES))
def test_samples_are_cut_before_they_are_sent(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert plan.index("MapInArrow") > plan.rindex("Exchange")


def test_a_month_is_read_by_one_frame_only(spark, sf_dir):
    df = QUERIES["feature_store_union"](spark, sf_dir)
    assert "Union" in plan_of(df)
    scans = re.findall(r"FileScan [^\n]*Location: InMemoryFileIndex\((\d+) paths?\)", plan_of(df))
    months = {file.rsplit("/", 1)[0] for file in df.inputFiles()}
    assert len(scans) == len(months) > 20 and set(scans) == {"1"}


@pytest.mark.parametrize("table", TABLES)
def test_silver_has_no_shuffle(spark, sf_dir, table):
    plan = plan_of(QUERIES[f"silver_{table}"](spark, sf_dir))
    assert "Exchange" not in plan and "Window" not in plan
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_round_robin(spark, sf_dir, name):
    assert "RoundRobin" not in plan_of(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize(
    ("name", "scans"),
    [
        ("date_spine", 1),
        ("label_store_union", 2),
        ("gold_labels", 1),
        ("row_counts_by_stage", 4),
        ("null_profile", 4),
        ("quality_report", 4),
        ("loan_day_patterns", 2),
        ("gold_features_with_loans", 4),
    ],
)
def test_scans(spark, sf_dir, name, scans):
    assert plan_of(QUERIES[name](spark, sf_dir)).count("FileScan") == scans


@pytest.mark.parametrize("table", TABLES)
def test_profile_reads_its_table_once(spark, sf_dir, table):
    plan = plan_of(profile_table(raw_table(spark, sf_dir, table), table))
    assert plan.count("FileScan") == 1


def test_gold_shuffles_each_input_once(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["gold_features"](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange ") == plan.count("Exchange hashpartitioning") == 3
    assert plan.count("FileScan") == 3


def test_bad_rate_aggregates_before_the_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["bad_rate_by_mob"](spark, sf_dir))
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_avg")


def exchanges(plan):
    return re.findall(r"Exchange (\w+)", plan)


@pytest.mark.parametrize("name", sorted(name for name in QUERIES if name.startswith("profile_")))
def test_registered_profiles_send_counters_only(spark, sf_dir, name):
    """Every exchange follows a partial aggregate, and the registered plan reads its table once."""
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert plan.count("FileScan") == 1
    assert set(exchanges(plan)) <= {"SinglePartition", "hashpartitioning"}
    for part in plan.split("Exchange ")[1:]:
        assert "HashAggregate" in part.split("\n")[1] or "ObjectHashAggregate" in part.split("\n")[1]


def test_row_counts_join_nothing(spark, sf_dir):
    plan = plan_of(QUERIES["row_counts_by_stage"](spark, sf_dir))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_loans_are_compiled_with_default_settings(spark, sf_dir):
    """The virtual machine leaves methods of more than 8,000 bytes to its interpreter."""
    plan = QUERIES["silver_loan_daily"](spark, sf_dir)._jdf.queryExecution().executedPlan()
    debug = spark._jvm.org.apache.spark.sql.execution.debug
    generated = getattr(getattr(debug, "package$"), "MODULE$").codegenStringSeq(plan)
    sizes = [generated.apply(i)._3().maxMethodCodeSize() for i in range(generated.size())]
    assert sizes and max(sizes) <= 8000
