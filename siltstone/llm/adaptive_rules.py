"""Quality rules with adaptive thresholds, in SQL functions only.

Each document is measured once. Per measure, language and source a quantile
sketch is built: counts of logarithmic bins with a relative width of 1/32, which
merge by addition, so tasks pre-aggregate and the same counts merge into the
sketch of a language or of everything. Fences come from quantiles of the
sketch and replace fixed cutoffs; documents are then joined with the fences of
their own group and judged. An upper fence lies beyond a high quantile of its group by
a multiple of that quantile's distance from the first quartile: shares are zero in most
documents, so their spread is that of the upper tail. A small distance, the noise, is the
least; it decides only where a group hardly varies.

Groups of fewer than MIN_DOCS documents have no reliable quantiles: they take the
merged sketch of their language, small languages the sketch of all documents.

Defined results: a null text has no words and fails the base rule; null languages
and sources are groups of their own; repeated rows count and are judged row by
row; an empty table gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.shared import WHITE, written

WINDOW = 5
MIN_WORDS = 10
REPEATED_PERCENT = 20
MIN_DOCS = 100
SYMBOLS = "#*$%&|<>"



@dataclass(frozen=True)
class Fence:
    """The upper fence lies beyond the quantile of so many percent by `reach` times its distance from the first
    quartile, by `noise` at least; a lower one so far below the first quartile."""

    percent: int
    reach: int
    noise: int
    lower: bool = False


#: Shares are in 1/10,000, word_length in 1/100 characters.
FENCES = {
    "symbol_share": Fence(75, 6, 100),
    "dup_line_share": Fence(99, 2, 2500),
    "repeat_share": Fence(95, 12, 1500),
    "word_length": Fence(75, 6, 50, lower=True),
}
#: The quantiles that are read from a sketch, in percent.
PERCENTS = sorted({25, *(fence.percent for fence in FENCES.values())})


def measure(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Columns `row` (the columns of docs to carry; all by default), `n_words`, `word_chars`, `n_symbols`, `n_dup_lines`,
    `n_repeat_words` and `n_lines` (lines with a word).

    Windows are compared by 64-bit hashes chained over their words. Each step
    is a projection of its own, so nothing is computed twice.
    """
    t = F.col("t")
    row = F.struct(*(docs[c] for c in carry or docs.columns))
    words = docs.select(row.alias("row"), F.coalesce(F.col(text), F.lit("")).alias("t")).select(
        "row", "t", F.array_remove(F.split(t, f"[{WHITE}]+"), "").alias("words"),
        F.filter(F.split(t, "\n"), lambda line: line.rlike(f"[^{WHITE}]")).alias("lines"),
    )
    n = F.size("words")
    windows = F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.xxhash64(*(F.col("words")[i + k] for k in range(WINDOW))),
    )
    hashed = words.select(
        "row",
        n.cast("long").alias("n_words"),
        F.length(F.translate("t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n > WINDOW, windows).otherwise(F.array().cast("array<long>")).alias("hashes"),
    )
    plain = ["row", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    placed = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    placed = hashed.select(
        *plain,
        F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), placed).alias("placed"),
    )
    at = F.col("placed")
    last = F.size("placed") - 1
    found = placed.select(
        *plain,
        F.sort_array(
            F.transform(
                F.filter(
                    "placed",
                    lambda e, i: F.when(i > 0, at[i - 1]["h"] == e["h"]).otherwise(False)
                    | F.when(i < last, at[i + 1]["h"] == e["h"]).otherwise(False),
                ),
                lambda e: e["i"],
            )
        ).alias("starts"),
    )
    starts = F.col("starts")
    covered = F.aggregate(
        F.transform(
            "starts",
            lambda p, j: F.when(j < F.size("starts") - 1, F.least(F.lit(WINDOW), starts[j + 1] - p)).otherwise(WINDOW),
        ),
        F.lit(0),
        lambda total, x: total + x,
    )
    return found.select(*plain, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words")
    )


def measures() -> Column:
    """Array of (measure, value): whole numbers, so that sketches do not depend on rounding."""
    n_words, n_lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    chars = F.greatest("word_chars", F.lit(1))

    def share(part: str, whole: Column) -> Column:
        return F.floor(F.col(part) * 10_000 / whole).cast("long")

    return F.array(
        *(
            F.struct(F.lit(name).alias("measure"), value.alias("value"))
            for name, value in (
                ("symbol_share", share("n_symbols", chars)),
                ("dup_line_share", share("n_dup_lines", n_lines)),
                ("repeat_share", share("n_repeat_words", n_words)),
                ("word_length", F.floor(F.col("word_chars") * 100 / n_words).cast("long")),
            )
        )
    )


def bin_of(value: Column) -> Column:
    """The lower bound of a value's bin: exact below 64, then the six leading bits."""
    drop = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(measured: DataFrame, lang: Column, source: Column) -> DataFrame:
    """(lang, source, measure, bin, n): the mergeable quantile sketch of each group.

    Only documents that pass the base rule enter: what fails anyway shifts no fence."""
    return (
        measured.select(
            lang.alias("lang"), source.alias("source"), F.explode_outer(F.when(~base_failed(), measures())).alias("m")
        )
        .filter("m IS NOT NULL")
        .groupBy("lang", "source", "m.measure", bin_of(F.col("m.value")).alias("bin"))
        .agg(F.count("*").alias("n"))
    )


_QUANTILES = ["docs", *(f"q{p}" for p in PERCENTS)]


def _quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Per keys and measure: docs, and a column per quantile, the lower bound of the bin that holds it.

    The bins of one group and measure are at most a few hundred, whatever the table."""
    group = Window.partitionBy(*keys, "measure")
    upto = group.orderBy("bin")
    merged = sketch.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))
    ranked = merged.withColumn("upto", F.sum("n").over(upto)).withColumn("docs", F.sum("n").over(group))
    return ranked.groupBy(*keys, "measure").agg(
        F.max("docs").alias("docs"),
        *(F.min(F.when(F.col("upto") * 100 >= F.col("docs") * p, F.col("bin"))).alias(f"q{p}") for p in PERCENTS),
    )


def fences(sketch: DataFrame) -> DataFrame:
    """(lang, source, <measure>_low, <measure>_high), one row for each group of the sketch."""
    own = _quantiles(sketch, ["lang", "source"])
    of_lang = _quantiles(sketch, ["lang"]).select(
        F.col("lang").alias("l"), F.col("measure").alias("lm"), F.struct(*_QUANTILES).alias("by_lang")
    )
    of_all = _quantiles(sketch, []).select(F.col("measure").alias("am"), F.struct(*_QUANTILES).alias("by_all"))
    chosen = (
        own.withColumn("by_own", F.struct(*_QUANTILES))
        .join(of_lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("measure") == F.col("lm")), "left")
        .join(of_all, F.col("measure") == F.col("am"), "left")
        .withColumn(
            "q",
            F.when(F.col("docs") >= MIN_DOCS, F.col("by_own"))
            .when(F.col("by_lang.docs") >= MIN_DOCS, F.col("by_lang"))
            .otherwise(F.col("by_all")),
        )
    )
    columns = []
    for name, fence in FENCES.items():
        here = F.col("measure") == name
        high, low = F.col(f"q.q{fence.percent}"), F.col("q.q25")
        beyond = F.greatest((high - low) * fence.reach, F.lit(fence.noise))
        columns.append(F.max(F.when(here, high + beyond)).alias(f"{name}_high"))
        if fence.lower:
            columns.append(F.max(F.when(here, low - beyond)).alias(f"{name}_low"))
    return chosen.groupBy("lang", "source").agg(*columns)


def adaptive_rules(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", carry: list[str] | None = None
) -> DataFrame:
    """`row` (the columns of docs to carry, all by default), the counts of `measure`, `base_failed` and `kept`.

    The measured table is written to the shared folder, as the sketch and the
    verdict both read it.
    """
    measured = written(measure(docs, text, carry and list(dict.fromkeys([*carry, lang, source]))), "measured")
    return _judged(measured, measured, lang, source).select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def kept_documents(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that the rules keep, with their columns.

    Docs are measured twice, for the sketch and for the verdict, so that texts are not stored again."""
    judged = _judged(measure(docs, text, [lang, source]), measure(docs, text), lang, source)
    return _where(judged, F.col("kept")).select("row.*")


def _where(df: DataFrame, condition: Column) -> DataFrame:
    """The rows that meet the condition. As a filter it would be pushed below the projections of
    `measure`, each of which would then be written out once per use, without end."""
    return df.select("*", F.explode_outer(F.when(condition, F.array(F.lit(1)))).alias("_met")).filter("_met = 1").drop("_met")


def _judged(for_sketch: DataFrame, measured: DataFrame, lang: str, source: str) -> DataFrame:
    """measured with `base_failed` and `kept`.

    The fences are written: their known size lets Spark broadcast them while they are small;
    beyond that the join shuffles, and adaptive execution splits a hot language and source."""
    row_lang, row_source = F.col("row")[lang], F.col("row")[source]
    sketch = written(sketches(for_sketch, row_lang, row_source), "sketch")
    limits = written(fences(sketch), "fences").select(F.struct("*").alias("fence"))
    judged = measured.withColumn("base_failed", base_failed()).join(
        limits,
        row_lang.eqNullSafe(F.col("fence.lang")) & row_source.eqNullSafe(F.col("fence.source")),
        "left",
    )
    verdict = ~F.col("base_failed")
    of = {name: F.element_at(measures(), i + 1)["value"] for i, name in enumerate(FENCES)}
    for name, fence in FENCES.items():
        verdict = verdict & F.coalesce(of[name] <= F.col(f"fence.{name}_high"), F.lit(True))
        if fence.lower:
            verdict = verdict & F.coalesce(of[name] >= F.col(f"fence.{name}_low"), F.lit(True))
    return judged.withColumn("kept", verdict)
