"""Mixing sources to target weights by Pareto order sampling, in SQL functions only.

Targets fill by water level: every source gets its weight's share of all words; a
source stops at MAX_REPEATS times its own size and what is over goes to the others
by weight, until none is above.

Within a source each document gets an expected number of copies around target /
source size: somewhat more for long documents, less for short ones, weighted so
that the expected words equal the target. The whole part is allocated for certain.
The fraction is the inclusion probability p of one more copy: documents are ranked
by (U / (1 - U)) / (p / (1 - p)) with U a hash of the row (Pareto order sampling) and
taken in this order up to the words that are left, so the sample has a fixed size in
words, to within half a document.

The place at which a source's order is cut is found digit by digit of the rank: each
level sums sizes per digit and keeps the one digit in which the cut falls, so a hot
source is never sorted in one task.

Defined results: a null text has size 0 and is never taken; null sources are one
source, the last in order; rows that repeat wholly are told apart by a row number,
which decides ties only between equal rows; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.shared import WHITE, written

MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
#: How far a document's expected copies may lie from its source's mean, as a share.
TILT = 0.5
#: Documents of this many words and more count as longest.
LONG = 4096
#: Ranks are whole numbers of 48 bits; each level of the search reads 12 of them.
RANK_BITS, DIGIT_BITS = 48, 12
#: The last digit's documents are sorted per source, if there are no more than this.
SORTED = 10_000


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{WHITE}]+")).cast("long")


def ordered_sources(sized: DataFrame) -> DataFrame:
    """(source, source_size, long_sum, weight): sources in code point order, null last.

    Ranks are offsets of range partitions plus places within them: no single task
    sorts all sources."""
    sums = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("longness")).alias("long_sum")
    )
    parts = int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(
        sums.repartitionByRange(parts, F.asc_nulls_last("source")).withColumn("part", F.spark_partition_id()),
        "sources",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.asc_nulls_last("source"))) - 1
    rank = F.col("offset") + F.col("place")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank % len(WEIGHTS) + 1).cast("int"))
    return (
        ranged.withColumn("place", place)
        .join(offsets, "part")
        .select("source", "source_size", "long_sum", weight.cast("long").alias("weight"))
    )


def water_level(sources: DataFrame) -> float:
    """The words per unit of weight at which all sources together take all words.

    Each round's sums are one aggregate; rounds end when no further source is above its cap."""
    level, cap = -1.0, F.col("source_size") * MAX_REPEATS
    while True:
        over = F.col("weight") * F.lit(level) > cap
        total, held, weight, n = sources.agg(
            F.sum("source_size"),
            F.sum(F.when(over, cap).otherwise(0)),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))),
            F.count(F.when(over, 1)),
        ).first()
        new = (total - held) / weight if weight else level
        if new <= level or not total:
            return max(level, 0.0) if total else 0.0
        level = new


def _plan(sources: DataFrame) -> DataFrame:
    level = water_level(sources)
    target = F.least(F.col("source_size") * F.lit(float(MAX_REPEATS)), F.col("weight") * F.lit(level))
    some = F.col("source_size") > 0
    rate = F.when(some, F.least(F.lit(float(MAX_REPEATS)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    return (
        sources.withColumn("target", target)
        .withColumn("rate", rate)
        .select(
            F.col("source").alias("of"), "source_size", "target", "rate",
            F.when(some, F.col("long_sum") / F.col("source_size")).otherwise(0.0).alias("mean_long"),
            F.when(F.col("rate") > 0, F.least(F.lit(TILT), MAX_REPEATS / F.col("rate") - 1)).otherwise(0.0).alias("tilt"),
        )
    )


def _placed(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds `whole` (certain copies), `p` (inclusion probability of one more) and `rank`."""
    tilted = 1 + F.col("tilt") * (F.col("longness") - F.col("mean_long")) / 1024
    expected = F.greatest(F.lit(0.0), F.least(F.lit(float(MAX_REPEATS)), F.col("rate") * tilted))
    odds = F.ln(F.col("u") / (1 - F.col("u"))) - F.ln(F.col("p") / (1 - F.col("p")))
    return (
        sized.join(plan, sized["source"].eqNullSafe(plan["of"]))
        .withColumn("expected", F.when(F.col("size") > 0, expected).otherwise(0.0))
        .withColumn("whole", F.floor("expected").cast("long"))
        .withColumn("p", F.col("expected") - F.col("whole"))
        .withColumn(
            "rank",
            F.when(
                (F.col("p") > 0) & (F.col("size") > 0),
                F.least(F.lit((1 << RANK_BITS) - 1), F.floor(F.lit(float(1 << RANK_BITS)) / (1 + F.exp(-odds)))),
            ).cast("long"),
        )
    )


def _digit(level: int) -> Column:
    """The level-th digit of the order: of the rank, then, between equal ranks, of the row's own hash."""
    levels = RANK_BITS // DIGIT_BITS
    at = F.col("rank") if level < levels else F.shiftrightunsigned(F.col("tie"), 64 - RANK_BITS)
    down = RANK_BITS - DIGIT_BITS * (level % levels + 1)
    return F.shiftrightunsigned(at, down).bitwiseAND((1 << DIGIT_BITS) - 1)


def _cuts(placed: DataFrame) -> tuple[DataFrame, list[str]]:
    """(cut_of, digits..., left): the digits in which each source's cut falls, and the words left in it.

    Sources whose words left exceed all that is ranked are not in it: all their documents are taken."""
    needs = placed.groupBy("source", "target").agg(F.sum(F.col("whole") * F.col("size")).alias("certain"))
    state = written(
        needs.select(F.col("source").alias("cut_of"), (F.col("target") - F.col("certain")).alias("left")), "cut"
    )
    digits: list[str] = []
    for level in range(2 * RANK_BITS // DIGIT_BITS):
        inside = within(placed, state, digits).select("source", "size", "left", *digits, _digit(level).alias("digit"))
        sums = inside.groupBy("source", "left", *digits, "digit").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("digit"))
        cut = sums.withColumn("upto", upto).filter(
            (F.col("upto") > F.col("left")) & (F.col("upto") - F.col("words") <= F.col("left"))
        )
        state = written(
            cut.select(
                F.col("source").alias("cut_of"), *digits, F.col("digit").alias(f"digit_{level}"),
                (F.col("left") - (F.col("upto") - F.col("words"))).alias("left"), "n",
            ),
            "cut",
        )
        digits = [*digits, f"digit_{level}"]
        if (state.agg(F.max("n")).first()[0] or 0) <= SORTED:
            break
    return state.drop("n"), digits


def within(placed: DataFrame, state: DataFrame, digits: list[str]) -> DataFrame:
    """The ranked rows that have the digits of their source's cut."""
    same = placed["source"].eqNullSafe(state["cut_of"])
    for level, name in enumerate(digits):
        same = same & (_digit(level) == state[name])
    return placed.filter("rank IS NOT NULL").join(state, same)


def pareto_mix(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", carry: list[str] | None = None
) -> DataFrame:
    """`row` (the columns of docs to carry, all by default), `size`, `source_size`, `target`, `copies`, `inclusion` (the
    probability of the last copy) for each row of docs; copies is 0 for what the mix leaves out.

    The sized rows are written once to the shared folder; every later step reads
    only the columns it needs. The tables joined to them hold a row per source.
    """
    size = word_count(F.col(text))
    u = (F.shiftrightunsigned(F.xxhash64(F.lit("pareto"), F.col(doc_id), F.col(text)), 12) + F.lit(0.5)) / F.lit(float(1 << 52))
    sized = written(
        docs.select(
            F.struct(*(docs[c] for c in carry or docs.columns)).alias("row"), F.col(source).alias("source"), size.alias("size"), u.alias("u"),
            F.monotonically_increasing_id().alias("row_no"),
        ).withColumn(
            "longness",
            F.least(F.lit(1024), F.floor(F.ln(1 + F.col("size")) / F.ln(F.lit(1.0 + LONG)) * 1024)).cast("long"),
        ),
        "sized",
    )
    plan = written(_plan(ordered_sources(sized)), "plan")
    placed = _placed(sized, plan).withColumn("tie", F.xxhash64("row_no"))
    state, digits = _cuts(placed.drop("row"))
    order = Window.partitionBy("source").orderBy("rank", F.shiftrightunsigned("tie", 64 - RANK_BITS), "row_no")
    middle = F.sum("size").over(order) - F.col("size") / 2
    last = written(
        within(placed.drop("row"), state, digits)
        .withColumn("middle", middle)
        .select(F.col("row_no").alias("last_no"), (F.col("middle") <= F.col("left")).alias("last_taken")),
        "last",
    )
    at_cut = F.lit(False)
    for level in reversed(range(len(digits))):
        mine, theirs = _digit(level), F.col(digits[level])
        at_cut = (mine < theirs) | ((mine == theirs) & at_cut)
    more = F.coalesce(F.col("last_taken"), F.when(F.col("cut_of_any"), at_cut).otherwise(True))
    return (
        placed.join(state.withColumn("cut_of_any", F.lit(True)), placed["source"].eqNullSafe(state["cut_of"]), "left")
        .join(last, F.col("row_no") == F.col("last_no"), "left")
        .select(
            "row", "size", "source_size", "target",
            (F.col("whole") + F.when(F.col("rank").isNotNull() & more, 1).otherwise(0)).alias("copies"),
            F.col("p").alias("inclusion"),
        )
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    copies = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return pareto_mix(docs).filter("copies > 0").select("row", copies.alias("copy")).select("row.*")
