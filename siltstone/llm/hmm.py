"""Language model scoring by a hidden Markov model over word classes.

Tokens are words and one end per text. Each word has a class: the most frequent
training tokens are classes of their own, words seen once and words never seen share
the rare class, and the others go to tail classes by the hash of their last two bytes. How many
there are of both follows the square root of the number of distinct training tokens. A text's
probability is that of its class sequence under the hidden Markov model, times that of
each token within its class. Within a class, tokens have their smoothed share; in
the rare class half is for the token never seen, which leaving out one training token
at a time would make of each token seen once. All shares add up to one.

The model is trained by Baum-Welch on all training texts: each task runs the forward and
backward recursions over its texts and returns expected counts, which are added up across
partitions; the driver holds the model alone: a billion distinct tokens give 285,000 classes,
14 MB. Both training and
scoring run over each whole text, for many texts at a time, so likelihood and counts are
exact. Training keeps the forward variables of every PIECE-th step and computes those in
between again, so its memory does not grow with the length of a text times the states.

Texts are cut into tokens once. Each block of texts lists its distinct words with their
counts; the vocabulary is their sum over all blocks, and goes back to the blocks by
joins on words, so no task or driver ever holds the vocabulary.

Defined results: a null text is empty; an empty text is the end token alone; a null
doc_id is not held out; repeated rows train and are scored row by row; without training
texts every token is unknown and every score is that of unknown tokens; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import Written, written

FOLDS, HELD_OUT = 7, 2
STATES, ROUNDS = 6, 5
#: Classes per square root of the number of distinct training tokens: single words, and tails of words.
TOP, TAIL = 8.0, 1.0
#: Share of the class distribution of all training tokens in each state's emissions.
FLOOR = 0.01
#: Steps between the forward variables that training keeps.
PIECE = 512
BLOCK_BYTES = 16 << 20
#: Blocks that one task joins with their words.
BLOCKS_PER_TASK = 8
#: Texts whose recursions run side by side hold about this many tokens.
SIDE_BY_SIDE = 500_000
SEED = 11
END = b"\n"  # white space, so no word


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


# ---------------------------------------------------------------- tokens and vocabulary

_ENCODED = pa.schema(
    [("block", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("codes", pa.binary()),
     ("word", pa.binary()), ("code", pa.int32()), ("n", pa.int64())]
)
_ENCODED_DDL = "block bigint, doc_id bigint, held_out boolean, codes binary, word binary, code int, n bigint"


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (ASCII letters only) words, then the end."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


_ZSTD = pa.Codec("zstd", 1)


def packed(codes: np.ndarray) -> bytes:
    """Numbers as their number, then all their lowest bytes, all their second bytes and so on, compressed."""
    planes = codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(codes).to_bytes(8, "little") + _ZSTD.compress(planes, asbytes=True)


def unpacked(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(_ZSTD.decompress(raw[8:], 4 * n), dtype=np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(n)


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block of texts: a row per text with the codes of its tokens, and a row per distinct word
    with its code and its count in training texts."""
    context = TaskContext.get()
    block = (context.partitionId() if context else 0) << 24
    book: dict[bytes, int] = {}
    docs: list[tuple] = []
    trained: list[np.ndarray] = []
    size = 0

    def flushed() -> Iterator[pa.RecordBatch]:
        none, n = [None] * len(docs), len(book)
        # Codes by falling frequency: most are small, and pack well.
        order = np.argsort(-np.bincount(np.concatenate([d[2] for d in docs]), minlength=n), kind="stable")
        rank = np.empty(n, dtype=np.int32)
        rank[order] = np.arange(n, dtype=np.int32)
        words = list(book)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block] * len(docs), pa.int64()), pa.array([d[0] for d in docs], pa.int64()),
             pa.array([d[1] for d in docs], pa.bool_()), pa.array([packed(rank[d[2]]) for d in docs], pa.binary()),
             pa.array(none, pa.binary()), pa.array(none, pa.int32()), pa.array(none, pa.int64())], schema=_ENCODED
        )
        counts = np.bincount(np.concatenate([np.zeros(0, np.int32), *trained]), minlength=n)[order]
        yield pa.RecordBatch.from_arrays(
            [pa.array([block] * n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()),
             pa.nulls(n, pa.binary()), pa.array([words[i] for i in order], pa.binary()), pa.array(np.arange(n, dtype=np.int32)),
             pa.array(counts.astype(np.int64))], schema=_ENCODED
        )

    for batch in batches:
        ids, out = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist()
        texts = batch.column("t")
        for i in range(batch.num_rows):
            text = texts[i].as_py()
            add = book.setdefault
            codes = np.array([add(w, len(book)) for w in words_of(text)], dtype=np.int32)
            docs.append((ids[i], out[i], codes))
            if not out[i]:
                trained.append(codes)
            size += len(text or "")
            if size >= BLOCK_BYTES:
                yield from flushed()
                block, size = block + 1, 0
                book, docs, trained = {}, [], []
    if docs:
        yield from flushed()


def sizes(distinct: int) -> tuple[int, int]:
    """The numbers of classes of single words and of tails, for so many distinct training tokens."""
    return math.ceil(TOP * math.sqrt(distinct)), max(1, math.ceil(TAIL * math.sqrt(distinct)))


def _with_class(vocabulary: DataFrame, singles: int, tails: int) -> DataFrame:
    """(word, c, class): classes of single words, then of tails, then the rare one.

    The rows of single words grow with the square root of the vocabulary, and are broadcast."""
    top = vocabulary.filter("c > 1").orderBy(F.desc("c"), "word").limit(singles)
    rows = [(r["word"], i) for i, r in enumerate(top.collect())]
    ranked = vocabulary.sparkSession.createDataFrame(rows, "top binary, rank int")
    end = F.expr("substring(word, greatest(length(word) - 1, 1), 2)")
    tail = (F.lit(singles) + F.pmod(F.xxhash64(end), F.lit(tails))).cast("int")
    return vocabulary.join(F.broadcast(ranked), F.col("word") == F.col("top"), "left").select(
        "word", "c", F.when(F.col("c") <= 1, F.lit(singles + tails)).otherwise(F.coalesce("rank", tail)).alias("class")
    )


@dataclass
class Shares:
    """What scoring needs of the vocabulary: N, V, and per class the smoothed and the plain counts.

    The last class is the rare one."""

    tokens: int
    distinct: int
    smoothed: np.ndarray
    counts: np.ndarray

    def within(self, c: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log10 of a token's share of its class."""
        rarest, once = len(self.counts) - 1, self.counts[-1]
        rare = np.where(c == 0, 0.5 if once else 1.0, 0.5 / max(once, 1.0))
        plain = (c + 1) / np.maximum(self.smoothed[classes], 1.0)
        return np.log10(np.where(classes == rarest, rare, plain))


def _sequences(docs: DataFrame, coded: DataFrame, shares: Shares, parts: int) -> DataFrame:
    """Per text: counts, base score, the tokens' log10 shares within their classes, and the classes.

    Texts and words of a block meet by cogroup, in `parts` tasks: a block's size is bounded by
    BLOCK_BYTES and one text."""
    floor = float(np.log10(shares.tokens + shares.distinct + 1))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        size = int(right["code"].max()) + 1 if len(right) else 0
        c, classes = np.zeros(size, np.int64), np.zeros(size, np.int32)
        c[right["code"]], classes[right["code"]] = right["c"], right["class"]
        base, within = np.log10(c + 1.0) - floor, shares.within(c, classes)
        rows = [unpacked(x) for x in left["codes"]]
        return pd.DataFrame({
            "doc_id": left["doc_id"], "held_out": left["held_out"],
            "n_tokens": np.array([len(r) for r in rows], np.int64),
            "n_known": np.array([int((c[r] > 0).sum()) for r in rows], np.int64),
            "base_score": np.array([base[r].sum() for r in rows], np.float64),
            "within": np.array([within[r].sum() for r in rows], np.float64),
            "classes": [packed(classes[r]) for r in rows],
        })

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, within double, classes binary"
    left, right = docs.repartition(parts, "of"), coded.repartition(parts, "block")
    return left.groupBy("of").cogroup(right.groupBy("block")).applyInPandas(run, schema)


# ---------------------------------------------------------------- the hidden Markov model


@dataclass
class Model:
    start: np.ndarray  # [state]
    move: np.ndarray  # [state, next state]
    emit: np.ndarray  # [class, state]


def initial(shares: Shares) -> Model:
    """States that differ by random factors of the overall class distribution, and mostly stay."""
    rng = np.random.default_rng(SEED)
    emit = _overall(shares)[:, None] * np.exp(rng.normal(0, 1, (len(shares.smoothed), STATES)))
    move = np.full((STATES, STATES), 0.05 / max(1, STATES - 1))
    np.fill_diagonal(move, 0.95)
    return Model(np.full(STATES, 1 / STATES), move, emit / emit.sum(0))


def _overall(shares: Shares) -> np.ndarray:
    """The share of each class among training tokens; each class that has a word, and the rare one, has some."""
    smoothed = shares.smoothed.copy()
    smoothed[-1] += 1
    return smoothed / smoothed.sum()


class _Packed:
    """Sequences side by side, longest first: step t of all that have one lies together."""

    def __init__(self, sequences: list[np.ndarray]):
        self.order = np.argsort([-len(s) for s in sequences], kind="stable")
        length = np.array([len(sequences[i]) for i in self.order], dtype=np.int64)
        steps = int(length[0]) if len(length) else 0
        self.active = len(length) - np.searchsorted(length[::-1], np.arange(steps), side="right")
        self.first = np.r_[0, np.cumsum(self.active)]
        rank = np.repeat(np.arange(len(length)), length)
        step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        self.tokens = np.empty(int(length.sum()), dtype=np.int64)
        if len(length):
            self.tokens[self.first[step] + rank] = np.concatenate([sequences[i] for i in self.order])

    def span(self, t: int) -> slice:
        return slice(int(self.first[t]), int(self.first[t + 1]))


def _stretch(model: Model, packed: _Packed, alpha: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(forward variables, scales, emissions) of the tokens of steps low to high, from the variables before them.

    The forward variables are scaled to one at each step; the logs of the scales add up to
    the log likelihood."""
    ends = packed.first[low : high + 1].tolist()
    emit = model.emit[packed.tokens[ends[0] : ends[-1]]]
    kept, scales = np.empty_like(emit), np.empty(len(emit))
    for k in range(high - low):
        a, b = ends[k] - ends[0], ends[k + 1] - ends[0]
        now, scale = kept[a:b], scales[a:b]
        if low + k:
            np.matmul(alpha[: b - a], model.move, out=now)
            now *= emit[a:b]
        else:
            np.multiply(model.start, emit[a:b], out=now)
        np.add.reduce(now, 1, out=scale)
        now /= scale[:, None]
        alpha = now
    return kept, scales, emit


def forward(model: Model, packed: _Packed, keep: bool) -> tuple[np.ndarray, list[np.ndarray], tuple[np.ndarray, ...] | None]:
    """(log likelihood per sequence; if kept, the variables before each PIECE of steps, and the last stretch)."""
    n, steps = len(packed.order), len(packed.active)
    total, alpha, marks, last = np.zeros(n), np.empty((0, STATES)), [], None
    for low in range(0, steps, PIECE):
        high = min(low + PIECE, steps)
        if keep:
            marks.append(alpha)
        last = _stretch(model, packed, alpha, low, high)
        active = packed.active[low:high]
        rank = np.arange(active.sum()) - np.repeat(np.cumsum(active) - active, active)
        total += np.bincount(rank, np.log(last[1]), n)
        alpha = last[0][len(rank) - int(active[-1]) :].copy()
    out = np.empty(n)
    out[packed.order] = total
    return out, marks, last if keep else None


def expected(model: Model, packed: _Packed) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts (start, move, emit) of the sequences, and their log likelihood."""
    total, marks, last = forward(model, packed, True)
    start, move, emit = (np.zeros_like(part) for part in (model.start, model.move, model.emit))
    beta, back, steps = np.ones((0, STATES)), np.ascontiguousarray(model.move.T), len(packed.active)
    for low in range((len(marks) - 1) * PIECE, -1, -PIECE):
        high = min(low + PIECE, steps)
        alpha, scales, emission = last or _stretch(model, packed, marks[low // PIECE], low, high)
        last = None
        ends = packed.first[low : high + 1].tolist()
        emission /= scales[:, None]
        for k in range(high - low - 1, -1, -1):
            a, b = ends[k] - ends[0], ends[k + 1] - ends[0]
            if len(beta) < b - a:  # sequences that end here
                beta = np.concatenate([beta, np.ones((b - a - len(beta), STATES))])
            alpha[a:b] *= beta  # from here on: the posterior of the states
            if low + k:
                ahead = emission[a:b]
                ahead *= beta
                before = alpha[ends[k - 1] - ends[0] :][: b - a] if k else marks[low // PIECE][: b - a]
                move += before.T @ ahead
                beta = ahead @ back
        if not low:
            start = alpha[: ends[1] - ends[0]].sum(0)
        tokens = packed.tokens[ends[0] : ends[-1]]
        emit += np.stack([np.bincount(tokens, alpha[:, s], len(emit)) for s in range(STATES)], axis=1)
    return start, move * model.move, emit, float(total.sum())


def _groups(column: pa.Array) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """(places, sequences) of about SIDE_BY_SIDE tokens, of similar lengths."""
    sequences = [unpacked(raw) for raw in column.to_pylist()]
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    part: list[int] = []
    held = 0
    for i in order:
        part.append(i)
        held += len(sequences[i])
        if held >= SIDE_BY_SIDE:
            yield part, [sequences[j] for j in part]
            part, held = [], 0
    if part:
        yield part, [sequences[j] for j in part]


def baum_welch_round(sequences: DataFrame, model: Model, shares: Shares) -> tuple[Model, float]:
    """The model after one round over all sequences, and their log likelihood under the old one.

    Tasks return a count per state and class each; they are added up by place before the driver sees them."""
    classes = len(shares.smoothed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, move, emit, total = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((classes, STATES)), 0.0
        for batch in batches:
            for _, part in _groups(batch.column("classes")):
                a, b, c, d = expected(model, _Packed(part))
                start, move, emit, total = start + a, move + b, emit + c, total + d
        values = np.concatenate([[total], start, move.reshape(-1), emit.reshape(-1)])
        at = np.flatnonzero(values)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(values[at])], ["at", "value"])

    rows = (
        sequences.select("classes").mapInArrow(run, "at bigint, value double")
        .groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    )
    values = np.zeros(1 + STATES + STATES**2 + classes * STATES)
    values[rows.column("at").to_numpy()] = rows.column("value").to_numpy()
    start, move, emit = np.split(values[1:], np.cumsum([STATES, STATES**2]))
    start, move, emit = start + 0.1, move.reshape(STATES, STATES) + 0.1, emit.reshape(classes, STATES)
    overall = _overall(shares)[:, None]
    seen = emit.sum(0)
    emit = np.where(seen > 0, (1 - FLOOR) * emit / np.where(seen > 0, seen, 1) + FLOOR * overall, overall)
    return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit), float(values[0])


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for places, part in _groups(batch.column("classes")):
                score[places] = forward(model, _Packed(part), False)[0] / np.log(10)
            rest = [n for n in batch.schema.names if n not in ("classes", "within")]
            total = score + batch.column("within").to_numpy()
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), pa.array(total)], [*rest, "score"])

    return run


def hmm_scores(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row per document."""
    picked = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("t")
    )
    encoded = Written(picked.mapInArrow(_encoded, _ENCODED_DDL), "encoded")
    words = encoded.df.filter("word IS NOT NULL").select("block", "word", "code", "n")
    counts = Written(words.groupBy("word").agg(F.sum("n").alias("c")), "counts")
    singles, tails = sizes(counts.df.filter("c > 0").count())
    vocabulary = Written(_with_class(counts.df, singles, tails), "vocabulary")
    counts.drop()
    per_class = vocabulary.df.filter("c > 0").groupBy("class").agg(
        F.sum(F.col("c") + 1).alias("smoothed"), F.sum("c").alias("c"), F.count("*").alias("words")
    ).collect()  # a row per class
    none = np.zeros(singles + tails + 1)
    shares = Shares(sum(r["c"] for r in per_class), sum(r["words"] for r in per_class), none, none.copy())
    for r in per_class:
        shares.smoothed[r["class"]], shares.counts[r["class"]] = r["smoothed"], r["c"]
    coded = words.join(vocabulary.df.withColumnRenamed("word", "known"), F.col("word") == F.col("known")).select(
        "block", "code", "c", "class"
    )
    texts = encoded.df.filter("word IS NULL").select(F.col("block").alias("of"), "doc_id", "held_out", "codes")
    blocks = texts.select("of").distinct().count()
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(blocks / BLOCKS_PER_TASK))
    sequences = written(_sequences(texts, coded, shares, parts), "sequences")
    encoded.drop()
    vocabulary.drop()
    training = sequences.filter("NOT held_out")
    model = initial(shares)
    for _ in range(ROUNDS if shares.tokens else 0):
        model, _likelihood = baum_welch_round(training, model, shares)
    if not shares.tokens:
        model.emit[:] = _overall(shares)[:, None]
    return sequences.mapInArrow(
        _scored(model),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double",
    ).withColumn("train_tokens", F.lit(shares.tokens).cast("long"))
