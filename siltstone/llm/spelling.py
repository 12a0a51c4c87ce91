"""Spelling variants: words that differ by one letter, found by PartEnum signatures.

A word's letters, taken as a multiset, are a binary vector: one dimension per letter and
occurrence (the second `e` is not the first). One inserted, deleted or replaced letter
changes at most two dimensions. The dimensions are dealt into PARTS parts; two vectors that
differ in at most two dimensions agree in at least PARTS - 2 parts, so for every choice of
PARTS - 2 parts a signature of what the vector holds there is made, and near words share
one: this is exact.

Signatures are joined by equality, together with what else one edit leaves alone: the
lengths are equal or one apart, and either the first or the last half of the shorter word
is in both. So words of the same letters in another order hardly meet. Each pair that meets
is verified by its edit distance, inside the join. Groups of more than GROUP words under one
key are cut into blocks that meet all of the group, so no task gets a group whole and no
pair is left out.

Words are counted before anything else, with partial sums, so a word with a third of all
occurrences is one row per task. Forms are followed to their ends by doubling the reach:
a form has at least twice the count, so chains are short.

Defined results: texts that are null or empty hold no words; a null document id reads as
empty text; rows that repeat count again; ties between forms go to the smaller word in the
order of code points; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import Written, _follow, written

RUN = r"[A-Za-zÀ-ÿ]"
LETTERS, OCCURRENCES = 5, 3
#: One run in EVERY loses a letter.
EVERY = 97
#: A form has at least so many times the occurrences of the word.
TIMES = 2
PARTS = 4
#: Words under one key that are compared in one piece.
GROUP = 2048
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CHOICES = list(itertools.combinations(range(PARTS), PARTS - 2))


# ---------------------------------------------------------------- words


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    plain = F.octet_length(c) == F.length(c)  # then `lower` changes nothing else, and is faster
    return F.when(plain, F.lower(c)).otherwise(F.translate(c, _UPPER, _LOWER))


def word_counts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): runs of at least LETTERS letters, some of which lose one, that occur OCCURRENCES times or more."""
    runs = F.regexp_extract_all(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(f"{RUN}{{{LETTERS},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("found"))
    run = found.select("doc", ascii_lower(F.col("found")).alias("run"))
    drawn = run.select("run", F.crc32(F.concat("doc", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % EVERY == 0, shorter).otherwise(F.col("run"))
    return (
        drawn.select(word.alias("word"))
        .filter(F.length("word") >= LETTERS)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= OCCURRENCES)
    )


# ---------------------------------------------------------------- signatures


def signatures(word: str) -> list[int]:
    """One number per choice of parts: what the letters of the word hold in them."""
    held: list[list[str]] = [[] for _ in range(PARTS)]
    seen: dict[str, int] = {}
    for letter in word:
        turn = seen[letter] = seen.get(letter, 0) + 1
        dimension = f"{letter}{turn}"
        held[xxhash.xxh32_intdigest(dimension) % PARTS].append(dimension)
    inside = [",".join(sorted(part)) for part in held]
    return [xxhash.xxh64_intdigest(f"{i}:" + "|".join(inside[p] for p in c)) - (1 << 63) for i, c in enumerate(_CHOICES)]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column("word")
        marks = pa.array([signatures(w) for w in words.to_pylist()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([words, batch.column("n"), marks], ["word", "n", "signatures"])


def _keyed(words: DataFrame) -> DataFrame:
    """(key, word, n, own): the keys of a word beside words of its length or longer (own), and beside shorter ones."""
    signed = written(words.mapInArrow(_signed, "word string, n bigint, signatures array<bigint>"), "signatures")
    sides = signed.select("word", "n", "signatures", F.explode(F.array(F.lit(0), F.lit(1))).alias("less"))
    short = F.length("word") - F.col("less")
    half = F.floor(short / 2).cast("int")
    first = F.substring("word", F.lit(1), half)
    last = F.substring("word", (F.length("word") - (short - half) + 1).cast("int"), F.length("word"))
    halves = F.array(F.xxhash64(short, F.lit("first"), first), F.xxhash64(short, F.lit("last"), last))
    each = sides.select("word", "n", "signatures", (F.col("less") == 0).alias("own"), F.explode(halves).alias("half"))
    each = each.select("word", "n", "own", "half", F.explode("signatures").alias("signature"))
    return each.select(F.xxhash64("half", "signature").alias("key"), "word", "n", "own")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): each pair of words one edit apart, both ways round, once."""
    keyed = _keyed(words)
    # Nearly always none: keys under which many words meet.
    large = written(
        keyed.groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > GROUP)
        .select(F.col("key").alias("large"), F.ceil(F.col("size") / GROUP).cast("int").alias("blocks")),
        "large",
    )
    cut = keyed.join(large, F.col("key") == F.col("large"), "left")
    blocks = F.coalesce("blocks", F.lit(1))
    a = cut.filter("own").select(
        "key", F.pmod(F.xxhash64("word"), blocks).cast("int").alias("block"), F.col("word").alias("a"), F.col("n").alias("a_n")
    )
    b = cut.select(
        F.col("key").alias("key_b"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block_b"), F.col("word").alias("b"),
        F.col("n").alias("b_n"), "own",
    )
    once = ~F.col("own") | (F.col("a") < F.col("b"))  # words of one length meet both ways round
    near = F.levenshtein("a", "b", 1) == 1
    met = a.join(b, (F.col("key") == F.col("key_b")) & (F.col("block") == F.col("block_b")) & once & near)
    pairs = written(met.groupBy("a", "b").agg(F.first("a_n").alias("a_n"), F.first("b_n").alias("b_n")), "pairs")
    there = pairs.select(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
    back = pairs.select(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    return there.unionAll(back)


# ---------------------------------------------------------------- the operator


def spelling_variants(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n), a row per word."""
    words = written(word_counts(docs, doc_id=doc_id, text=text), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    judged = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.first("n").alias("own_n"), best.alias("best"))
    is_form = -F.col("best.less") >= TIMES * F.col("own_n")
    formed = written(
        judged.select(
            F.col("word").alias("of"), "n_near", F.when(is_form, F.col("best.near")).alias("form"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    steps = Written(formed.filter("form IS NOT NULL").selectExpr("of AS node", "form AS root"), "steps")
    roots = _follow(steps).df.select("node", "root")
    return (
        words.join(formed, F.col("word") == F.col("of"), "left")
        .join(roots, F.col("word") == F.col("node"), "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            "form_n",
        )
    )
