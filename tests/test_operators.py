"""Operators on small tables, and invariants between them."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from siltstone import credit
from siltstone.functions import validity
from siltstone.operators import dedup, joins, loans, quality, rules, sketches, snapshots
from siltstone.plans import silver
from siltstone.sources.derived import raw_table

JAN, FEB, MAR = date(2023, 1, 1), date(2023, 2, 1), date(2023, 3, 1)


def rows(df):
    return sorted([tuple(row) for row in df.collect()], key=str)


def test_month_starts():
    days = snapshots.month_starts(credit.FIRST_SNAPSHOT, credit.LAST_SNAPSHOT)
    assert len(days) == 24 and days[0] == JAN and days[-1] == date(2024, 12, 1)
    assert snapshots.month_starts("2023-01-20", "2023-03-01") == [JAN, FEB, MAR]
    assert snapshots.month_starts("2023-01-20", "2023-01-25") == [JAN]
    assert snapshots.month_starts("2023-02-01", "2023-01-01") == []


def test_spine_matches_month_starts(spark):
    for start, end in [(date(2022, 11, 30), date(2023, 2, 1)), (date(2023, 1, 20), date(2023, 1, 25))]:
        df = spark.createDataFrame([(start,), (end,)], "snapshot_date date")
        assert rows(snapshots.date_spine(df)) == [(d,) for d in snapshots.month_starts(start, end)]


def test_spine_counts_fills_gaps(spark):
    df = spark.createDataFrame([(JAN,), (JAN,), (MAR,)], "snapshot_date date")
    assert rows(snapshots.spine_counts(df)) == [(JAN, 2), (FEB, 0), (MAR, 1)]


def test_slice_and_off_spine(spark):
    df = spark.createDataFrame([(JAN, 1), (FEB, 2), (None, 3)], "snapshot_date date, x int")
    assert rows(snapshots.snapshot_slice(df, "2023-01-01")) == [(JAN, 1)]
    assert rows(snapshots.off_spine(df, [JAN])) == [(3, 2)]


def test_union_is_by_name(spark):
    a = spark.createDataFrame([(1, "a")], "x int, y string")
    b = spark.createDataFrame([("b", 2)], "y string, x int")
    assert rows(snapshots.union_snapshots([a, b, a])) == [(1, "a"), (1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        snapshots.union_snapshots([])
    with pytest.raises(Exception, match="x"):
        snapshots.union_snapshots([a, b.drop("x")]).collect()


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 1), (None, 1), (None, 2)], "k string, v int")
    assert rows(dedup.duplicate_keys(df, ["k"])) == [(2, 3)]
    assert rows(dedup.duplicate_keys(df.where("k = 'b'"), ["k"])) == [(0, 0)]


def test_keep_first_is_deterministic(spark):
    data = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "q"), ("b", 0, "p")]
    expected = [("a", 1, "y"), ("b", None, "q")]
    for shuffled in (data, data[::-1]):
        df = spark.createDataFrame(shuffled, "k string, v int, w string").repartition(3)
        assert rows(dedup.keep_first(df, ["k"])) == expected
    df = spark.createDataFrame(data, "k string, v int, w string")
    assert rows(dedup.keep_first(df, ["k"], [F.col("v").desc()])) == [("a", 2, "x"), ("b", 0, "p")]
    assert rows(dedup.keep_first(df.select("k"), ["k"])) == [("a",), ("b",)]


def test_keep_first_sends_one_row_per_hot_key_and_task(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    kept = dedup.keep_first(df, ["k"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")
    assert kept.count() == df.select("k").distinct().count()
    assert kept.where("k = 0").collect()[0].v == 0


def test_attach_does_not_fan_out(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, x int")
    block = spark.createDataFrame([("a", 10), ("a", 11), ("c", 12), (None, 13)], "k string, y int")
    assert rows(joins.attach(base, [block], ["k"])) == [("a", 1, 10), ("b", 2, None), (None, 3, None)]


def test_rules_skip_missing_columns(spark):
    df = spark.createDataFrame([("1",), (None,)], "a string")
    assert rules.rewrite_present(df, {"zzz": lambda c: c}) is df
    assert rules.drop_null_present(df, ["zzz"]) is df
    assert rows(rules.drop_null_present(df, ["a", "zzz"])) == [("1",)]
    assert rules.keep_where(df, "zzz", lambda c: c.isNotNull()) is df
    with pytest.raises(ValueError):
        rules.keep_where(df, "zzz", lambda c: c.isNotNull(), required=True)


def test_silver_needs_its_keys_only(spark):
    raw = spark.createDataFrame([("CUS_0x1",), ("BAD",), (None,)], "Customer_ID string")
    assert rows(silver.silver_attributes(raw)) == [("CUS_0x1",)]
    assert rows(silver.silver_clickstream(raw)) == [("CUS_0x1",)]
    assert rows(silver.silver_financials(raw)) == [("CUS_0x1",)]
    with pytest.raises(ValueError):
        silver.silver_loan_daily(raw)


def test_financial_rules(spark):
    columns = "Customer_ID string, Num_of_Loan string, Type_of_Loan string, Changed_Credit_Limit string, Monthly_Balance string"
    raw = spark.createDataFrame(
        [
            ("CUS_0x1", "3_", "Auto Loan", "1", "1"),  # 3_ reads 0 by default, which contradicts the type
            ("CUS_0x2", "2", "Auto Loan", "-5", "-7"),
            ("CUS_0x3", "2", "Auto Loan", "_", "1"),
            ("CUS_0x4", "-1", "Auto Loan", "1", "1"),
            ("CUS_0x5", "0", None, "1", "1"),
        ],
        columns,
    )
    default = {r.Customer_ID: r for r in silver.silver_financials(raw).collect()}
    assert set(default) == {"CUS_0x2", "CUS_0x4"}
    assert default["CUS_0x2"].Changed_Credit_Limit == 5.0 and default["CUS_0x2"].Monthly_Balance == 7.0
    signed = {r.Customer_ID for r in silver.silver_financials(raw, keep_sign=True).collect()}
    assert signed == {"CUS_0x4"}
    options = silver.silver_financials(raw, strip_counts=True, keep_null_limit=True)
    assert {r.Customer_ID for r in options.collect()} == {"CUS_0x1", "CUS_0x2", "CUS_0x3", "CUS_0x4"}


LOANS = "loan_id string, Customer_ID string, loan_start_date date, installment_num int, due_amt double, overdue_amt double, loan_amt double, snapshot_date date"


def test_days_past_due(spark):
    data = [
        ("none", "c", JAN, 1, 100.0, 0.0, 1.0, MAR),
        ("one", "c", JAN, 2, 100.0, 100.0, 1.0, MAR),
        ("part", "c", JAN, 2, 100.0, 101.0, 1.0, MAR),
        ("nodue", "c", JAN, 2, 0.0, 500.0, 1.0, MAR),
        ("huge", "c", JAN, 2, 0.01, 1e12, 1.0, MAR),
    ]
    df = loans.with_days_past_due(spark.createDataFrame(data, LOANS))
    found = {r.loan_id: (r.mob, r.installments_missed, r.first_missed_date, r.dpd) for r in df.collect()}
    assert found["none"] == (1, 0, None, 0)
    assert found["one"] == (2, 1, FEB, 28)
    assert found["part"] == (2, 2, JAN, 59)
    assert found["nodue"] == (2, 0, None, 0)
    cycles, rest = divmod(10**14, 4800)
    month = MAR.year * 12 + MAR.month - 1 - rest
    left_over = (MAR - date(month // 12, month % 12 + 1, MAR.day)).days
    assert found["huge"][1:] == (10**14, None, cycles * 146_097 + left_over)
    labels = loans.performance_labels(df, dpd=30, mob=2)
    assert {(r.loan_id, r.label, r.label_def) for r in labels.collect()} == {
        ("one", 0, "30dpd_2mob"), ("part", 1, "30dpd_2mob"), ("nodue", 0, "30dpd_2mob"), ("huge", 1, "30dpd_2mob")}
    assert rows(loans.bad_rate_by_mob(df, dpd=30)) == [(1, 0.0, 1), (2, 0.5, 4)]
    assert rows(loans.bad_rate_by_mob(df, dpd=30, started_before=JAN)) == []
    assert loans.at_installment(df, 1).count() == 1



def test_profile_counts_equal_filtering(spark, sf_dir):
    raw = raw_table(spark, sf_dir, "attributes")
    rule = quality.Rule("ssn", "SSN", lambda c: validity.matches(c, validity.SSN), distinct=True)
    absent = quality.Rule("ssn", "no_such_column", lambda c: c.isNotNull())
    found = quality.profile(raw, "t", [rule, absent]).collect()
    assert len(found) == 1
    bad = quality.invalid_rows(raw, rule)
    assert found[0].invalid == bad.count() > 0
    assert found[0].distinct_invalid == bad.select("SSN").distinct().count()
    assert found[0].total == raw.count() and found[0].passed is False


def test_samples_and_patterns(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",), ("1",), (None,)], "v string")
    rule = quality.Rule("integer", "v", validity.is_integer_text)
    assert [r.v for r in quality.invalid_samples(df, rule, 2).collect()] == [None, "x"]
    assert [tuple(r) for r in quality.invalid_patterns(df, rule, 5).collect()] == [("x", 2), ("y", 1)]
    assert [tuple(r) for r in quality.value_counts(df, "v", nulls=True).collect()][0] == ("x", 2)
    assert quality.distinct_values(df, "v").count() == 4


def test_label_counts_has_null_for_absent_labels(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "v string")
    assert rows(quality.label_counts(df, F.col("v"), ["a", "b"], "label")) == [(1, "a", 2), (2, "b", None)]


def test_histogram(spark):
    df = spark.range(31).select(F.col("id").cast("int").alias("x"))
    bins = quality.histogram(df, "x", 30).collect()
    assert len(bins) == 30 and bins[-1].row_count == 2 and sum(b.row_count for b in bins) == 31
    same = spark.createDataFrame([(5,), (5,), (None,)], "x int")
    assert rows(quality.histogram(same, "x")) == [(1, 2, 5, 5)]
    assert quality.histogram(same.where("x > 9"), "x").collect() == []


def test_silver_is_a_subset_with_valid_keys(spark, sf_dir):
    for table, clean in [
        ("clickstream", silver.silver_clickstream),
        ("attributes", silver.silver_attributes),
        ("financials", silver.silver_financials),
        ("loan_daily", silver.silver_loan_daily),
    ]:
        raw = raw_table(spark, sf_dir, table)
        kept = clean(raw)
        assert 0 < kept.count() < raw.count()
        assert kept.where(~validity.matches(F.col("Customer_ID"), validity.CUSTOMER_ID)).count() == 0


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    """A third of all rows share one key: the results are whole, the plans combine first."""
    df = spark.range(30_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("Customer_ID"),
        F.lit(JAN).alias("snapshot_date"),
        (F.col("id") / 10).alias("loan_amt"),
        F.col("id").cast("double").alias("overdue_amt"),
    )
    summary = loans.loan_summary(df)
    hot = summary.where("Customer_ID = 'hot'").collect()[0]
    assert (hot.loan_cnt, round(hot.loan_amt_sum, 2), hot.max_overdue) == (10_000, sum(range(0, 30_000, 3)) / 10, 29_997.0)
    assert summary.agg(F.sum("loan_cnt")).collect()[0][0] == 30_000
    assert rows(dedup.duplicate_keys(df, credit.KEYS)) == [(1, 9_999)]
    for result in (summary, dedup.duplicate_keys(df, credit.KEYS)):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert plan.rindex("partial_count") > plan.index("Exchange hashpartitioning")


def test_marking_tells_what_filters_drop(spark, sf_dir):
    for table, clean in silver.CLEANERS.items():
        raw = raw_table(spark, sf_dir, table)
        start, mark = rules.marking(raw)
        marked = clean(start, mark=mark)
        assert marked.count() == raw.count()
        kept = marked.where(mark).drop(mark)
        dropped = clean(raw)
        assert kept.columns == dropped.columns
        assert rows(kept) == rows(dropped) and 0 < dropped.count() < raw.count()


def test_column_names_switch_nothing(spark, sf_dir):
    """Tables may have columns of any name: none turns filters into marks, none is lost."""
    names = ("_kept", "kept", "KEPT_", "_rank", "rank", "Rank_")
    for table, clean in silver.CLEANERS.items():
        raw = raw_table(spark, sf_dir, table)
        more = raw.select("*", *[F.lit(i).alias(name) for i, name in enumerate(names)])
        cleaned = clean(more)
        assert rows(cleaned.drop(*names)) == rows(clean(raw))
        assert set(names) <= set(cleaned.columns)
        start, mark = rules.marking(more)
        assert mark not in more.columns and clean(start, mark=mark).count() == raw.count()
    first = dedup.keep_first(more, credit.KEYS)
    assert first.columns == more.columns
    assert rows(first.drop(*names)) == rows(dedup.keep_first(raw, credit.KEYS))


def test_many_frames_are_united_in_pairs(spark):
    frames = [spark.range(i, i + 2).select(F.col("id").alias("x"), F.lit(i).alias("y.z")) for i in range(150)]
    frames[7] = frames[7].select("`y.z`", "x")
    whole = snapshots.union_snapshots(frames)
    assert whole.count() == 300 and whole.agg(F.sum("`y.z`")).first()[0] == 2 * sum(range(150))
    depth = max(len(line) - len(line.lstrip(" :+-")) for line in whole._jdf.queryExecution().logical().toString().split("\n"))
    assert depth < 60  # a chain of 150 unions is three times as deep
    assert snapshots.union_snapshots(frames[:1]) is frames[0]
    with pytest.raises(ValueError, match="frame 2 differs"):
        snapshots.union_snapshots([frames[0], frames[1], frames[2].withColumnRenamed("x", "w")])


def test_smallest_distinct_rows_of_each_task(spark):
    df = spark.range(40_000, numPartitions=8).select(
        F.when(F.col("id") % 9 > 0, F.concat(F.lit("v"), F.col("id") % 5_000)).alias("v"), (F.col("id") % 3).alias("k")
    )
    found = quality.smallest_distinct(df, ["v", "k"], 25)
    want = df.distinct().orderBy(F.col("v").asc_nulls_first(), F.col("k").asc_nulls_first()).limit(25)
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in want.collect()]
    plan = quality.smallest_distinct(df, ["v", "k"], 25)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") > plan.rindex("Exchange")  # nothing is exchanged before tasks have cut their rows
    assert quality.smallest_distinct(df.limit(0), ["v", "k"], 5).collect() == []


def test_a_histogram_of_whole_numbers_reads_once(spark, sf_dir, tmp_path):
    path = str(tmp_path / "n")
    spark.range(5_000).select((F.col("id") * F.col("id") % 977).cast("int").alias("n"), F.rand(1).alias("d")).write.parquet(path)
    df = spark.read.parquet(path)
    found = quality.histogram(df, "n", 20)
    counts = {row.bin: (row.row_count, row.smallest, row.largest) for row in found.collect()}
    values = [row[0] for row in df.select("n").collect()]
    low, high = min(values), max(values)
    want = {}
    for value in values:
        want.setdefault(min(20, (value - low) * 20 // (high - low) + 1), []).append(value)
    assert counts == {b: (len(vs), min(vs), max(vs)) for b, vs in want.items()}
    assert found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("FileScan") == 1
    assert quality.histogram(df, "d", 20).agg(F.sum("row_count")).first()[0] == 5_000
    for odd in ([], [(None,)], [(3,), (3,)]):
        got = [tuple(r) for r in quality.histogram(spark.createDataFrame(odd, "n int"), "n", 4).collect()]
        assert got == ([(1, 2, 3, 3)] if odd == [(3,), (3,)] else [])


def test_amounts_beyond_bigint_count_as_past_due(spark):
    day = date(2024, 5, 1)
    df = spark.createDataFrame(
        [(1e300, 1.0, day), (9.3e18, 1.0, day), (2e18, 1.0, day), (float("inf"), 1.0, day), (100.0, 50.0, day), (0.0, 50.0, day),
         (1e300, 1.0, None), (5.0, 0.0, day)],
        "overdue_amt double, due_amt double, snapshot_date date",
    ).select("*", F.lit(6).alias("installment_num"), F.lit("L").alias("loan_id"), F.lit("C").alias("Customer_ID"))
    found = loans.with_days_past_due(df)
    got = [tuple(r) for r in found.select("installments_missed", "dpd").collect()]
    assert got == [(None, None), (None, None), (2 * 10**18, None), (None, None), (2, 61), (0, 0), (None, 0), (0, 0)]
    labels = [r.label for r in loans.performance_labels(found).collect()]
    assert labels == [1, 1, 1, 1, 1, 0, 0, 0]


def test_merged_sketches_stay_within_their_error(spark, tmp_path):
    months = snapshots.month_starts("2023-01-01", "2023-03-01")
    df = spark.range(240_000).select(
        F.concat(F.lit("bad"), F.col("id") % 90_000).alias("v"),
        F.element_at(F.array(*[F.lit(d) for d in months]), (F.col("id") % 3 + 1).cast("int")).alias("snapshot_date"),
    )
    rule = [quality.Rule("digits", "v", validity.is_integer_text), quality.Rule("missing", "w", validity.is_integer_text)]
    path = str(tmp_path / "sketches")
    sketches.store_sketches(df, "t", rule, path, months)
    row = sketches.distinct_invalid(spark, path).first()
    assert (row.total, row.invalid) == (240_000, 240_000)
    assert abs(row.distinct_invalid - 90_000) < 3 * 0.0082 * 90_000
    assert spark.read.parquet(path).count() == 3  # a row per month
    # A month that is run again replaces its own sketch only.
    few = spark.createDataFrame([("x", months[1]), ("y", months[1]), ("7", months[1]), (None, months[1])], "v string, snapshot_date date")
    sketches.store_sketches(few, "t", rule, path, months[1:2])
    row = sketches.distinct_invalid(spark, path, months[1:2]).first()
    assert (row.total, row.invalid, row.distinct_invalid) == (4, 3, 2)
    assert sketches.distinct_invalid(spark, path).first().total == 160_004
    with pytest.raises(ValueError):
        sketches.rule_sketches(few, "t", rule[1:])


def test_approximate_distinct_is_within_its_bound(spark):
    df = spark.range(60_000).select(F.concat(F.lit("x"), F.col("id") % 20_000).alias("id_text"))
    check = lambda c: c.rlike("^[0-9]+$")
    exact, near = (
        quality.profile(df, "t", [quality.Rule("digits", "id_text", check, distinct=True, within=within)]).first()
        for within in (None, 0.02)
    )
    assert exact.distinct_invalid == 20_000 and abs(near.distinct_invalid - 20_000) < 0.1 * 20_000
    assert exact.invalid == near.invalid == 60_000


def test_samples_carry_ids(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "x"), ("c", None), ("d", "1")], "id string, v string")
    rule = quality.Rule("number", "v", validity.is_integer_text)
    found = [tuple(row) for row in quality.invalid_samples(df, rule, 2, ids=["id"]).collect()]
    assert found == [("c", None), ("a", "x")]
    assert [tuple(row) for row in quality.invalid_samples(df, rule).collect()] == [(None,), ("x",)]


def test_every_rule_fails_somewhere_and_passes_somewhere(spark, sf_dir):
    from siltstone.catalog.queries import QUERIES

    for row in QUERIES["quality_report"](spark, sf_dir).collect():
        assert 0 < row.invalid < row.total, row


def test_both_halves_of_the_key_matter(spark, sf_dir):
    """The fixtures tell the feature join from one on either column alone."""
    from siltstone.plans.gold import gold_features
    from siltstone.sources.derived import TABLES

    click, attributes, financials = (
        silver.CLEANERS[name](raw_table(spark, sf_dir, name)) for name in TABLES if name != "loan_daily"
    )
    right = rows(gold_features(click, attributes, financials))
    for key in credit.KEYS:
        blocks = [click.select(key, *credit.CLICK_FEATURES), attributes.select(key, "Age", "Occupation")]
        base = dedup.keep_first(financials, credit.KEYS)
        joined = joins.attach(base, [dedup.keep_first(block, [key]) for block in blocks], [key], dedup=False)
        assert rows(joined.select(*gold_features(click, attributes, financials).columns)) != right
    assert dedup.duplicate_keys(attributes, credit.KEYS).first().duplicate_keys > 0
    assert dedup.duplicate_keys(financials, credit.KEYS).first().duplicate_keys > 0


def test_both_faults_of_a_day_occur(spark, sf_dir):
    from siltstone.catalog.queries import QUERIES

    found = QUERIES["loan_day_patterns"](spark, sf_dir)
    for name in ("loan_start_date", "snapshot_date"):
        reasons = {row.reason for row in found.where(F.col("column_name") == name).collect()}
        assert reasons == {"Invalid Format", "Valid Format but Invalid Date"}
