"""Typing and cleaning rules, value by value, with ANSI mode on and off."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from siltstone import credit
from siltstone.functions import casts, cleaning, validity


@pytest.fixture(params=["true", "false"], ids=["ansi", "legacy"])
def session(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", before)


def apply(session, values, rule, kind="string"):
    df = session.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    rows = df.select("i", rule(F.col("x")).alias("y")).collect()
    return [row.y for row in sorted(rows)]


def test_lenient_int(session):
    cases = {
        " 7 ": 7, "-3": -3, "3.7": 3, "5.": 5, "1e3": None, "+4": 4, "": None, "23_": None, ".5": 0,
        "-.5": 0, ".": 0, "+": None, "3.7.": None, "99999999999": None, "\t8\n": 8, "1 2": None, None: None,
        "2147483647": 2147483647, "2147483648.5": None, "-2147483648": -2147483648,
    }
    assert apply(session, list(cases), casts.lenient_int) == list(cases.values())


def test_lenient_int_equals_the_legacy_cast(spark):
    values = [" 7 ", "-3", "3.7", "5.", "1e3", "+4", "", "23_", ".5", "-.5", ".", "+", "-", "3.7.", "99999999999",
              "\t8\n", "1 2", None, "0x1", "007", "-0.9", "+.", "٣", "1_000", "--1", "1.2.3", " ", "\x008\x1f"]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = apply(spark, values, lambda c: c.cast("int"))
        assert apply(spark, values, casts.lenient_int) == legacy
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_lenient_double_equals_the_plain_cast(spark):
    values = ["1", " 1.5 ", "\t2\n", "-3", "+4", "5.", ".5", ".", "1e3", "1E-5", "1e", "7d", "7D", "7f", "0x1p3", "0x1.8P-1",
              "NaN", "nan", "inf", "-Infinity", "+INF", "infinity", "infx", "$5", "5_", "_", "", " ", None, "1,000", "1 2",
              "--1", "1-2", "1.2.3", "٣", "e5", "\x001\x1f", "-nan", "+nan", "1\x7f", "Infinityd", "1e400", "-1e-400"]
    assert str(apply(spark, values, casts.lenient_double)) == str(apply(spark, values, lambda c: c.try_cast("double")))


def test_strict_date_equals_the_formatter(spark):
    values = ["2023-01-01", "0000-01-01", "2024-02-29", "2023-02-29", "2023-13-01", "2023-00-10", "2023-01-01\n", "2023-01-01T",
              "2023-01-01 00:00", "20230101", "2023/01/01", "23-01-01", "٢٠٢٣-01-01", "9999-12-31", "", None, "2023-01-32"]
    # As text, since Python has no year 0.
    ours = apply(spark, values, lambda c: casts.strict_date(c).cast("string"))
    assert ours == apply(spark, values, lambda c: F.try_to_date(c, "yyyy-MM-dd").cast("string"))


def test_int_or_default(session):
    cases = {
        "7": 7, "7.9": 7, "-3.9": -3, "7_": 0, None: 0, "": 0, "x": 0, "3e10": 2147483647,
        "-3e10": -2147483648, "NaN": 0, "1e2": 100,
    }
    assert apply(session, list(cases), casts.int_or_default) == list(cases.values())
    assert apply(session, ["7_", "-2", "5"], lambda c: casts.int_or_default(c, strip=True)) == [7, -2, 5]
    assert apply(session, ["-2", "5"], lambda c: casts.int_or_default(c, min_value=0)) == [0, 5]


def test_whole_number(session):
    cases = {"10": 10, "10.0": 10, "10.5": None, None: None, "": None, "NaN": None, "Infinity": None,
             "-3": -3, "3e10": 2147483647, "1e19": None}
    assert apply(session, list(cases), casts.whole_number) == list(cases.values())


def test_dates(session):
    values = ["2023-01-01", "2023-1-1", "2023-02-30", " 2023-01-01", "2023-01-01x", "", None]
    day = date(2023, 1, 1)
    assert apply(session, values, casts.strict_date) == [day, None, None, None, None, None, None]
    lenient = apply(session, values, casts.lenient_date)
    assert lenient[:3] == [day, day, None]
    assert lenient[-2:] == [None, None]


def test_clean_number(session):
    cases = {"-12.3_": 12.3, "1.0E-5": 1.05, "1.2.3": None, "_": None, "": None, None: None, "$1,000.456": 1000.46}
    assert apply(session, list(cases), lambda c: cleaning.clean_number(c, 2)) == list(cases.values())
    zero = [0.0 if v is None else v for v in cases.values()]
    assert apply(session, list(cases), lambda c: cleaning.clean_number(c, 2, on_null="zero")) == zero
    signed = {"-12.3_": -12.3, "_-5": -5.0, "5-3": 53.0, "$-4": -4.0, "-": None, "4-": 4.0}
    assert apply(session, list(signed), lambda c: cleaning.clean_number(c, 2, keep_sign=True)) == list(signed.values())
    with pytest.raises(ValueError):
        cleaning.clean_number(F.col("x"), on_null="drop")


def test_rounding_is_half_up_on_the_decimal_text(session):
    assert apply(session, ["1.005", "2.675", "0.125"], lambda c: cleaning.clean_number(c, 2)) == [1.01, 2.68, 0.13]


def test_coerce_number_strips_nothing(session):
    cases = {"__10__": None, "12.345": 12.35, "-4": -4.0, "NaN": None, "1e2": 100.0, None: None}
    assert apply(session, list(cases), lambda c: cleaning.coerce_number(c, 2)) == list(cases.values())


def test_band(session):
    ages = [-5, 17, 18, 25, 26, 65, 66, 76, None]
    expected = ["<18", "<18", "18-25", "18-25", "26-35", "56-65", "66-75", "76+", None]
    assert apply(session, ages, lambda c: cleaning.band(c, credit.AGE_BANDS), "int") == expected
    opened = apply(session, [-5, 0, 1, 17], lambda c: cleaning.band(c, credit.AGE_BANDS, above=0), "int")
    assert opened == [None, None, "<18", "<18"]
    closed = apply(
        session,
        [17.0, 17.5, float("nan"), None, float("inf")],
        lambda c: cleaning.band(c, credit.AGE_BANDS[1:], above=17, default="Invalid"),
        "double",
    )
    assert closed == ["Invalid", "18-25", "Invalid", "Invalid", "76+"]
    assert apply(session, [1, 9], lambda c: cleaning.band(c, [(5, "low")], default="rest"), "int") == ["low", "rest"]


def test_category(session):
    answers = ["NM", " yes ", "maybe", None, "no"]
    rule = lambda c: cleaning.category(c, credit.MIN_PAYMENT_ANSWERS)
    assert apply(session, answers, rule) == ["Nm", " Yes ", "Unknown", "Unknown", "No"]
    canonical = lambda c: cleaning.category(c, credit.MIN_PAYMENT_ANSWERS, canonical=True)
    assert apply(session, answers, canonical) == ["NM", "Yes", "Unknown", "Unknown", "No"]
    exact = lambda c: cleaning.exact_category(c, credit.MIN_PAYMENT_ANSWERS)
    assert apply(session, answers, exact) == ["NM", "Unknown", "Unknown", "Unknown", "Unknown"]


def test_joint_extract(session):
    part = lambda name: lambda c: cleaning.joint_extract(c, credit.SPEND_AND_VALUE, ["a", "b"])[name]
    values = ["High_spent_Small_value_payments", "High_spent_Tiny_value", None, "Low_spent_Large_value"]
    assert apply(session, values, part("a")) == ["High", None, None, "Low"]
    assert apply(session, values, part("b")) == ["Small", None, None, "Large"]


def test_year_month_total(session):
    values = ["3 Years and 4 Months", "0 Years and 0 Months", "1 Year and 1 Month", "NA", None, "5 Years"]
    assert apply(session, values, cleaning.year_month_total) == [40, 0, 13, None, None, None]


def test_flag(session):
    assert apply(session, [29, 30, None], lambda c: cleaning.flag_at_least(c, 30), "int") == [0, 1, 0]


def test_validity(session):
    ok = lambda rule: lambda c: validity.holds(rule(c))
    assert apply(session, ["1", "-2", "3.7", "bad", None], ok(validity.is_integer_text)) == [True, True, False, False, False]
    assert apply(session, ["1", "1.5", "-1", "1.", None], ok(validity.is_plain_number)) == [True, True, False, False, False]
    assert apply(session, ["Ann O'Hara", "X", "John123", " Al ", "", None], ok(validity.is_person_name)) == [
        True, False, False, True, False, False]
    assert apply(session, ["2023-02-28", "2023-02-30", "2023-2-1", None], ok(validity.is_day)) == [
        True, False, False, False]
    assert apply(session, ["10", "10.0", "10.5", None, "x"], ok(validity.is_whole_number)) == [
        True, True, False, False, False]
    assert apply(session, ["1", "NaN", "x", None, "-inf", "Infinity"], ok(validity.is_numeric)) == [
        True, False, False, False, True, True]
    faults = apply(session, ["2023-01-01", "2023-1-1", "junk", None], validity.day_fault)
    assert faults == [None, "Valid Format but Invalid Date", "Invalid Format", "Invalid Format"]


def test_counts_agree(session):
    pairs = [(1, None), (1, " "), (0, "A"), (0, None), (0, " "), (2, "A"), (-1, "A"), (None, "A")]
    df = session.createDataFrame([(i, n, k) for i, (n, k) in enumerate(pairs)], "i int, n int, k string")
    rows = df.select("i", validity.counts_agree(F.col("n"), F.col("k")).alias("y")).orderBy("i").collect()
    assert [row.y for row in rows] == [False, False, False, True, True, True, True, True]


def test_fast_paths_change_nothing(spark):
    """The shortcuts for clean text against the plain definitions, on random text."""
    pick = random.Random(7)
    alphabet = " +-.0123456789123eE_$dfxNaIn\t,"
    values = ["".join(pick.choice(alphabet) for _ in range(pick.randint(0, 7))) for _ in range(4000)]
    days = ["".join(pick.choice("0123-") if pick.random() < 0.1 else c for c in "2023-02-11") for _ in range(2000)]
    x = F.col("x")
    number = x.try_cast("double")
    pairs = {
        "double": (casts.lenient_double(x), number),
        "whole": (casts.whole_number(x), F.when(number == F.floor(number), F.least(F.greatest(number, F.lit(-2147483648.0)), F.lit(2147483647.0)).cast("int"))),
        "count": (casts.int_or_default(x), casts.double_to_int(F.coalesce(number, F.lit(0.0)))),
        "strip": (cleaning.digits_and_points(x), F.regexp_replace(x, r"[^\d.]", "")),
        "day": (casts.strict_date(x), F.try_to_date(x, "yyyy-MM-dd")),
        "is_whole": (validity.holds(validity.is_whole_number(x)), validity.holds(number == F.floor(number))),
    }
    df = spark.createDataFrame([(v,) for v in values + days], "x string").repartition(8)
    flags = [F.count_if(~ours.eqNullSafe(plain)).alias(name) for name, (ours, plain) in pairs.items()]
    assert df.agg(*flags).collect()[0].asDict() == dict.fromkeys(pairs, 0)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        differing = df.where(~casts.lenient_int(x).eqNullSafe(x.cast("int"))).count()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert differing == 0
