"""Data-quality profiles: rules counted in one pass, samples, distributions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.validity import holds

ANY_OF_FAMILY = "*"


@dataclass(frozen=True)
class Rule:
    """A named check of one column; null counts as a failure.

    ``distinct`` also asks for the number of distinct failing values: exactly, or
    with a relative standard deviation of ``within``, in a sketch of fixed size.
    The exact number makes a group per failing value, so choose ``within`` where
    a table may hold very many of them.
    """

    name: str
    column: str
    check: Callable[[Column], Column]
    distinct: bool = False
    within: float | None = None

    def passes(self) -> Column:
        return holds(self.check(F.col(self.column)))


@dataclass(frozen=True)
class RowRule:
    """A named check across several columns; ``column`` names it in the report."""

    name: str
    column: str
    condition: Column
    distinct: bool = False
    within: float | None = None

    def passes(self) -> Column:
        return holds(self.condition)


def family(name: str, columns: Sequence[str], check: Callable[[Column], Column]) -> list[Rule | RowRule]:
    """The same check on each column, and one for rows where all of them pass."""
    each = [Rule(name, column, check) for column in columns]
    together = reduce(lambda left, right: left & right, [rule.passes() for rule in each])
    return [*each, RowRule(name, ANY_OF_FAMILY, together)]


def profile(df: DataFrame, table: str, rules: Sequence[Rule | RowRule]) -> DataFrame:
    """One row per rule: rows in total, failing rows, nulls, and whether all pass.

    The table is read once, whatever the number of rules: each rule is one
    counter of a single aggregate, whose one row is then turned into rows.
    """
    known = set(df.columns)
    rules = [rule for rule in rules if isinstance(rule, RowRule) or rule.column in known]
    counters = [F.count(F.lit(1)).alias("total")]
    lines = []
    null_counters: dict[str, Column] = {}
    for index, rule in enumerate(rules):
        failing = ~rule.passes()
        counters.append(F.count_if(failing).alias(f"invalid_{index}"))
        distinct = F.lit(None).cast("bigint")
        if rule.distinct:
            bad = F.when(failing, F.col(rule.column))
            number = F.count_distinct(bad) if rule.within is None else F.approx_count_distinct(bad, rule.within)
            counters.append(number.alias(f"distinct_{index}"))
            distinct = F.col(f"distinct_{index}")
        nulls = F.lit(None).cast("bigint")
        if rule.column in known:
            name = f"nulls_{rule.column}"
            null_counters.setdefault(rule.column, F.count_if(F.col(rule.column).isNull()).alias(name))
            nulls = F.col(name)
        lines.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(rule.column).alias("column_name"),
                F.lit(rule.name).alias("rule_name"),
                F.col("total"),
                F.col(f"invalid_{index}").alias("invalid"),
                distinct.alias("distinct_invalid"),
                nulls.alias("null_count"),
                (F.col(f"invalid_{index}") == 0).alias("passed"),
            )
        )
    return df.agg(*counters, *null_counters.values()).select(F.inline(F.array(*lines)))


def null_counts(df: DataFrame, table: str) -> DataFrame:
    """Nulls and rows per column, in one pass."""
    counters = [F.count_if(F.col(name).isNull()).alias(f"nulls_{i}") for i, name in enumerate(df.columns)]
    lines = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(name).alias("column_name"),
            F.col(f"nulls_{i}").alias("null_count"),
            F.col("total"),
        )
        for i, name in enumerate(df.columns)
    ]
    return df.agg(F.count(F.lit(1)).alias("total"), *counters).select(F.inline(F.array(*lines)))


def invalid_rows(df: DataFrame, rule: Rule | RowRule) -> DataFrame:
    """The rows that fail a rule."""
    return df.where(~rule.passes())


def invalid_samples(df: DataFrame, rule: Rule, n: int = 10, *, ids: Sequence[str] = ()) -> DataFrame:
    """The ``n`` smallest distinct values that fail a rule.

    With ``ids``, the columns that identify a row: the first ``n`` distinct rows of ids and
    value, in the order of the value, then of the ids.
    """
    return smallest_distinct(invalid_rows(df, rule).select(*ids, rule.column), [rule.column, *ids], n)


def smallest_distinct(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` distinct rows in the order of the columns, which are all of the table's; nulls first.

    Each task keeps the ``n`` smallest rows it has met and sends no more than these, whatever
    the number of distinct rows; so this suits a small ``n``. Columns are text, numbers or dates.
    """

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            distinct = rows.group_by(list(order)).aggregate([])
            first = pc.sort_indices(distinct, sort_keys=[(name, "ascending") for name in order], null_placement="at_start")
            held = distinct.take(first.slice(0, n)).select(rows.column_names)
        if held is not None:
            yield from held.to_batches()

    ordering = [F.col(name).asc_nulls_first() for name in order]
    return df.mapInArrow(kept, df.schema).distinct().orderBy(*ordering).limit(n)


def invalid_patterns(
    df: DataFrame, rule: Rule, n: int = 5, *, reason: Callable[[Column], Column] | None = None
) -> DataFrame:
    """The ``n`` most frequent non-null values that fail a rule, ties by value.

    ``reason`` adds what it tells of a value: it is worked out for the ``n`` values only.
    """
    found = value_counts(invalid_rows(df, rule), rule.column).limit(n)
    return found if reason is None else found.withColumn("reason", reason(F.col(rule.column)))


def value_counts(df: DataFrame, column: str, *, nulls: bool = False) -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    rows = df if nulls else df.where(F.col(column).isNotNull())
    return (
        rows.groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.col("row_count").desc(), F.col(column).asc_nulls_first())
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column, null included."""
    return df.select(column).distinct()


def label_counts(df: DataFrame, label: Column, labels: Sequence[str], name: str) -> DataFrame:
    """Rows per label of a fixed list, in list order; a label without rows counts null.

    One pass and one output row per label: nothing is grouped or joined.
    """
    counters = [F.count_if(label == value).alias(f"n_{i}") for i, value in enumerate(labels)]
    lines = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(value).alias(name),
            F.nullif(F.col(f"n_{i}"), F.lit(0).cast("bigint")).alias("row_count"),
        )
        for i, value in enumerate(labels)
    ]
    return df.agg(*counters).select(F.inline(F.array(*lines)))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Rows per non-empty bin of equal width between the smallest and largest value.

    The last bin holds its upper bound. Nulls are left out; equal bounds give bin 1.

    A column of whole numbers is read once: its rows are counted per value, with partial
    counts, and the counts give both the bounds and the bins. Other columns may have a value
    per row, so they are read twice: for the bounds, which are two numbers, and for the bins.
    """
    value = F.col("value").cast("double")
    rows = df.select(F.col(column).alias("value")).where(value.isNotNull() & ~F.isnan(value))
    if df.schema[column].dataType.typeName() in ("byte", "short", "integer", "long"):
        rows = rows.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    else:
        rows = rows.withColumn("n", F.lit(1).cast("bigint"))
    # With counts, both uses of `rows` are one exchange, which Spark makes once.
    bounds = rows.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    # width_bucket is null for equal bounds.
    bucket = F.coalesce(F.width_bucket(value, bounds["lo"], bounds["hi"], F.lit(bins)), F.lit(1))
    bucket = F.least(bucket, F.lit(bins))
    return (
        rows.groupBy(bucket.cast("int").alias("bin"))
        .agg(F.sum("n").alias("row_count"), F.min("value").alias("smallest"), F.max("value").alias("largest"))
        .orderBy("bin")
    )
