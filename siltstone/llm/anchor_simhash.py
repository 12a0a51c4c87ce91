"""SimHash near-duplicates by anchor points.

A document's fingerprint has a bit for each of 64 majority votes over the hashes of
its word shingles. Two fingerprints link if they differ in at most MAX_BITS bits.

The anchors are the words of a covering code: the product of two binary Golay codes
over bits 0-22 and 23-45. Every 46-bit value lies within RADIUS = 6 bits of an anchor
(3 in each half). A fingerprint is at home at its nearest anchor and is replicated
to every anchor within RADIUS + MAX_BITS (in either half within 3 + MAX_BITS). If two
fingerprints differ in at most MAX_BITS bits, each visits the other's home, so
comparing the guests of an anchor with those at home there misses no pair. The
fingerprints' own 64 bits decide.

Equal fingerprints are one node, so a group of copies costs one row whatever its size.
A fingerprint has at most 2,080 others within two bits: links grow in proportion.

Defined results: a null or empty text has no shingle and fingerprint 0, which links
like any other; a null doc_id is carried through, and is never the id of a component
that has another id; rows that repeat stay rows of their own; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import connected_components, written

SHINGLE = 3
MAX_BITS = 2
SEED = 42
RADIUS = 6
#: Golay code: 23 bits of which 12 are free; the generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
HALF_BITS, GENERATOR = 23, 0b101011100011


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: str | None) -> int:
    """64 majority votes over the shingles; ASCII letters are lowered, other letters stay."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends]
    n = max(1, len(words) - SHINGLE + 1)
    last = min(SHINGLE, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, dtype=np.int64)
    for low in range(0, n, 1 << 16):  # a very long text is voted on in pieces
        high = min(n, low + (1 << 16))
        hashes = np.array(
            [digest(line[a : b - 1], SEED) for a, b in zip(starts[low:high], ends[low + last : high + last], strict=True)],
            dtype="<u8",
        )
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * votes > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = np.fromiter((fingerprint(t) for t in batch.column("t").to_pylist()), dtype="<u8", count=batch.num_rows)
        rest = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "t"]
        names = [name for name in batch.schema.names if name != "t"]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(marks.view("<i8"))], [*names, "mark"])


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, mark): mark is the fingerprint as a signed 64-bit integer."""
    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t"))
    return picked.mapInArrow(_fingerprints, "doc_id bigint, mark bigint")


# ---------------------------------------------------------------- anchors


@cache
def _syndromes() -> np.ndarray:
    """The remainder of each 23-bit value by the generator: 0 for the words of the code."""
    table = np.arange(1 << HALF_BITS, dtype=np.uint32)
    for bit in range(HALF_BITS - 1, 10, -1):
        table ^= np.where(table >> bit & 1, np.uint32(GENERATOR << (bit - 11)), np.uint32(0)).astype(np.uint32)
    return table.astype(np.uint16)


@cache
def _steps(most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The changes of up to `most` bits that lead from a value to a code word, by the value's syndrome.

    Returns (first place per syndrome, changes, their numbers of bits), nearest first.
    """
    weight = np.bitwise_count(np.arange(1 << HALF_BITS, dtype=np.uint32))
    changes = np.flatnonzero(weight <= most).astype(np.uint32)
    of, size = _syndromes()[changes], weight[changes]
    order = np.lexsort((changes, size, of))
    first = np.searchsorted(of[order], np.arange(1 << 11 | 1))
    return first, changes[order], size[order]


def _halves(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    marks = marks.view(np.uint64)
    half = np.uint64((1 << HALF_BITS) - 1)
    return (marks & half).astype(np.uint32), (marks >> np.uint64(HALF_BITS) & half).astype(np.uint32)


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + n[0] - 1, start[1] .., one after the other."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)


def home_anchors(marks: np.ndarray) -> np.ndarray:
    """The nearest anchor of each mark: at most RADIUS bits away."""
    first, change, _ = _steps(RADIUS // 2 + MAX_BITS)
    low, high = (part ^ change[first[_syndromes()[part]]] for part in _halves(marks))
    return high.astype(np.int64) << HALF_BITS | low


def near_anchors(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into marks, anchor) for each anchor within RADIUS + MAX_BITS of a mark."""
    first, change, size = _steps(RADIUS // 2 + MAX_BITS)
    low, high = _halves(marks)
    at_low, at_high = _syndromes()[low].astype(np.int64), _syndromes()[high].astype(np.int64)
    n_low = first[at_low + 1] - first[at_low]
    n_high = first[at_high + 1] - first[at_high]
    row = np.repeat(np.arange(len(marks)), n_low)
    step_low = _ranges(first[at_low], n_low)
    step_high = _ranges(first[at_high][row], n_high[row])
    step_low, row = np.repeat(step_low, n_high[row]), np.repeat(row, n_high[row])
    near = size[step_low].astype(np.int64) + size[step_high] <= RADIUS + MAX_BITS
    row, step_low, step_high = row[near], step_low[near], step_high[near]
    return row, (high[row] ^ change[step_high]).astype(np.int64) << HALF_BITS | (low[row] ^ change[step_low])


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = batch.column("mark").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(home_anchors(marks)), pa.array(marks)], ["home", "a"])


def _guests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = batch.column("mark").to_numpy(zero_copy_only=False)
        for low in range(0, len(marks), 2000):
            part = marks[low : low + 2000]
            row, anchor = near_anchors(part)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(part[row])], ["anchor", "b"])


def mark_links(marks: DataFrame) -> DataFrame:
    """(a, b), a < b: the pairs of distinct marks that differ in at most MAX_BITS bits."""
    homes = marks.mapInArrow(_homes, "home bigint, a bigint")
    guests = marks.mapInArrow(_guests, "anchor bigint, b bigint")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    pairs = guests.join(homes, (F.col("anchor") == F.col("home")) & (F.col("a") != F.col("b")) & near)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def simhash_components(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, mark, component_id), a row per document.

    Distinct marks get their smallest doc_id; components of marks give each mark
    the smallest doc_id of all marks reachable; documents join this by their mark.
    """
    marked = written(fingerprints(docs, doc_id=doc_id, text=text), "marked")
    return marked.join(
        classes(marked.groupBy("mark").agg(F.min("doc_id").alias("low"))), F.col("mark") == F.col("of")
    ).select("doc_id", "mark", "component_id")


def _spread(marks: DataFrame) -> DataFrame:
    """The marks in as many tasks as a shuffle has, however few bytes they are: each becomes many guests."""
    return marks.select("mark").repartition(int(marks.sparkSession.conf.get("spark.sql.shuffle.partitions")), "mark")


def classes(marks: DataFrame) -> DataFrame:
    """(of, component_id) for each distinct mark of (mark, low)."""
    marks = written(marks, "marks")
    roots = connected_components(mark_links(_spread(marks)))
    rooted = marks.join(roots, F.col("mark") == F.col("node"), "left").select(
        F.col("mark").alias("of"), "low", F.coalesce("root", "mark").alias("root")
    )
    low = rooted.groupBy("root").agg(F.min("low").alias("component_id")).withColumnRenamed("root", "at")
    return rooted.join(low, F.col("root") == F.col("at")).select("of", "component_id")


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents whose id is the smallest of their component; of rows that share it, one.

    Rows without an id stay one per component that has no id at all."""
    marks = _row_marks(docs, text)
    own = F.col("row")[doc_id]
    first = F.min(F.struct(own.isNull().alias("none"), own.alias("id"), "row_no")).alias("first")
    low = written(marks.groupBy("mark").agg(first), "first")
    roots = connected_components(mark_links(_spread(low)))
    rooted = low.join(roots, F.col("mark") == F.col("node"), "left").select(F.coalesce("root", "mark").alias("root"), "first")
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row_no").alias("kept_no"))
    return marks.join(kept, F.col("row_no") == F.col("kept_no"), "left_semi").select("row.*")


def _row_marks(docs: DataFrame, text: str) -> DataFrame:
    """(row, row_no, mark), written once: row numbers and marks must not change between reads."""
    numbered = docs.select(
        F.struct("*").alias("row"), F.monotonically_increasing_id().alias("row_no"), F.col(text).alias("t")
    )
    fields = numbered.drop("t").schema
    return written(numbered.mapInArrow(_fingerprints, fields.add("mark", "long")), "marked")

