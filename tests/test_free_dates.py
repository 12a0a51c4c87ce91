"""Dates by the shapes of a column's texts."""

from datetime import date

import pytest

from siltstone.functions import free_dates as fd


def parsed(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(3)
    return [row.t for row in fd.with_free_date(df, "t", **options).orderBy("i").collect()]


D = date(2023, 4, 3)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_plain_shapes(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        texts = ["2023-04-03", "2023-4-3", " 2023/04/3 ", "20230403", "3 Apr 2023", "3-april-2023", "APR 3, 2023", "April 03 2023"]
        assert parsed(spark, texts) == [D] * len(texts)
        for text in (None, "", "soon", "2023-13-01", "2023-02-30", "20231301", "0000-01-01", "3 Foo 2023", "3.4/2023", "1/2/23", "99/99/9999", "2023-04-03x"):
            assert parsed(spark, [text]) == [None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_the_values_settle_the_order(spark):
    april, march = date(2023, 4, 3), date(2023, 3, 4)
    assert parsed(spark, ["03/04/2023", "25/12/2023"]) == [april, date(2023, 12, 25)]
    assert parsed(spark, ["03/04/2023", "12/25/2023"]) == [march, date(2023, 12, 25)]
    # Each shape for itself.
    assert parsed(spark, ["03/04/2023", "25/12/2023", "03-04-2023", "12-25-2023", "03.04.2023"]) == [
        april, date(2023, 12, 25), march, date(2023, 12, 25), march,
    ]
    # Nothing tells, or the values contradict each other: the default, where a text can be read both ways.
    assert parsed(spark, ["03/04/2023"]) == [march]
    assert parsed(spark, ["03/04/2023"], default="day") == [april]
    both = ["03/04/2023", "25/12/2023", "12/25/2023"]
    assert parsed(spark, both) == [march, date(2023, 12, 25), date(2023, 12, 25)]
    assert parsed(spark, both, default="day") == [april, date(2023, 12, 25), date(2023, 12, 25)]
    with pytest.raises(ValueError):
        parsed(spark, both, default="year")


def test_shapes_are_counted_in_few_rows(spark):
    df = spark.createDataFrame([("1/2/2023",), ("13/2/2023",), ("x1",), ("x2",), (None,), ("2023-1-1",)], "t string")
    found = {r["shape"]: (r.row_count, r.first_over, r.second_over) for r in fd.date_shapes(df, "t").collect()}
    assert found == {"9/9/9999": (2, True, False), None: (2, None, None), "yyyy-m-d": (1, None, None)}
    assert parsed(spark, []) == []
