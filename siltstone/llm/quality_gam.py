"""Quality classifier: a generalised additive model with pairwise interactions.

Log odds are a sum of lookup tables: one per feature over its quantile bins, one per
chosen pair of features over coarser bins. Tables are learnt by cyclic boosting: round
after round, each feature in turn gets a shallow tree fitted to the current residuals
of its bins, and a small step of it is added to its table. Pairs are then ranked by
what a tree with one cut on either axis would gain, and the best are boosted likewise.
Scoring adds the entries of a document's bins.

The model is fitted on at most SAMPLE labelled rows, drawn by a hash of their id; the
features come from whole texts and from nothing else. Rows are scored in batches.

Defined results: a null text counts as empty; an empty text has features and a score
like any other; a null doc_id is not held out and never trains; labels that repeat
count once, as the largest; without labels of both kinds, every score is the share of
label 1 (0.5 without any label); an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bound of the labelled rows that train the model.
SAMPLE = 20_000
FOLDS = 5
THRESHOLD = 0.3

BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 8
STEP, LEAVES = 0.1, 3

FEATURES = (
    "log_words", "word_length", "longest_word", "upper_share", "digit_share", "symbol_share", "other_share",
    "ended_share", "short_share", "after_same", "distinct_share", "top_share", "repeat_share",
    "dup_line_share", "line_words", "marked_share",
)
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_SYMBOL = np.array([chr(b) in "#*$%&|<>{}[]=+~^\\/_@!" for b in range(256)])


def features(text: str | None) -> list[float]:
    """FEATURES of one whole text; shares of nothing are 0."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    chars = max(1, int(counts[~_SPACE].sum()))
    lengths = list(map(len, words))
    seen = Counter(words)
    grams = set(zip(words, words[1:], words[2:], strict=False))
    lines = [x for x in (line.strip() for line in raw.split(b"\n")) if x]
    return [
        float(np.log1p(n)),
        chars / n,
        float(np.log1p(max(lengths))),
        float(counts[_UPPER].sum()) / chars,
        float(counts[_DIGIT].sum()) / chars,
        float(counts[_SYMBOL].sum()) / chars,
        float(counts[~(_LETTER | _DIGIT | _SPACE | _SYMBOL)].sum()) / chars,
        sum(w[-1] in b".,;:?" for w in words) / n,
        sum(x <= 3 for x in lengths) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        len(seen) / n,
        max(seen.values()) / n,
        1 - len(grams) / (n - 2) if n > 2 else 0.0,
        1 - len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
        sum(w[-1:] in b"#*$%&|!" for w in words) / n,
    ]


def matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([features(t) for t in texts], dtype=np.float64).reshape(len(texts), len(FEATURES))


@dataclass
class Model:
    """base + sum of tables[f][bin of f] + sum of pair_tables[p][coarse bin of a, of b]."""

    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[f], x[:, f], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[
                np.searchsorted(self.coarse[a], x[:, a], side="right"),
                np.searchsorted(self.coarse[b], x[:, b], side="right"),
            ]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Newton steps, held back where little data lies."""
    return g / (h + 2.0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 2.0)


def _shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The values of a tree of at most LEAVES leaves over ordered bins, grown by best gain."""
    parts = [(0, len(g))]
    while len(parts) < LEAVES:
        best = (1e-9, None, 0)
        for i, (low, high) in enumerate(parts):
            if high - low > 1:
                left_g, left_h = np.cumsum(g[low:high])[:-1], np.cumsum(h[low:high])[:-1]
                all_g, all_h = g[low:high].sum(), h[low:high].sum()
                gains = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
                k = int(gains.argmax())
                if gains[k] > best[0]:
                    best = (gains[k], i, low + k + 1)
        if best[1] is None:
            break
        low, high = parts[best[1]]
        parts[best[1] : best[1] + 1] = [(low, best[2]), (best[2], high)]
    out = np.zeros(len(g))
    for low, high in parts:
        out[low:high] = _leaf(g[low:high].sum(), h[low:high].sum())
    return out


def _cross_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, values) of the best tree with one cut on either axis of a grid."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    corner = lambda c: (c[:-1, :-1], c[:-1, -1:] - c[:-1, :-1], c[-1:, :-1] - c[:-1, :-1],
                        c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + c[:-1, :-1])
    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    quarters = list(zip(corner(cg), corner(ch), strict=True))
    gains = sum(_gain(x, y) for x, y in quarters)
    i, j = np.unravel_index(int(gains.argmax()), gains.shape)
    out = np.empty_like(g)
    for (x, y), where in zip(
        quarters,
        ((slice(None, i + 1), slice(None, j + 1)), (slice(None, i + 1), slice(j + 1, None)),
         (slice(i + 1, None), slice(None, j + 1)), (slice(i + 1, None), slice(j + 1, None))),
        strict=True,
    ):
        out[where] = _leaf(x[i, j], y[i, j])
    return float(gains[i, j] - _gain(cg[-1, -1], ch[-1, -1])), out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """The model of features x and labels y (0 or 1)."""
    rate = (y.sum() + 0.5) / (len(y) + 1) if 0 < y.sum() < len(y) else (y.mean() if len(y) else 0.5)
    rate = float(np.clip(rate, 1e-6, 1 - 1e-6))
    width = x.shape[1]
    if not 0 < y.sum() < len(y):
        none = [np.zeros(0)] * width
        return Model(float(np.log(rate / (1 - rate))), none, [np.zeros(1)] * width, none, [], [])
    cuts = [_cuts(x[:, f], BINS) for f in range(width)]
    coarse = [_cuts(x[:, f], PAIR_BINS) for f in range(width)]
    binned = [np.searchsorted(cuts[f], x[:, f], side="right") for f in range(width)]
    wide = [np.searchsorted(coarse[f], x[:, f], side="right") for f in range(width)]
    model = Model(float(np.log(rate / (1 - rate))), cuts, [np.zeros(len(c) + 1) for c in cuts], coarse, [], [])
    total = np.full(len(y), model.base)

    def residuals() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(width):
            g, h = residuals()
            size = len(model.tables[f])
            tree = STEP * _shallow_tree(np.bincount(binned[f], g, size), np.bincount(binned[f], h, size))
            model.tables[f] += tree
            total += tree[binned[f]]

    def grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        return np.bincount(wide[a] * shape[1] + wide[b], values, shape[0] * shape[1]).reshape(shape)

    g, h = residuals()
    ranked = sorted(
        ((_cross_tree(grid(a, b, g), grid(a, b, h))[0], -a, -b) for a in range(width) for b in range(a + 1, width)),
        reverse=True,
    )
    model.pairs = [(-a, -b) for _, a, b in ranked[:PAIRS]]
    model.pair_tables = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(model.pairs):
            g, h = residuals()
            tree = STEP * _cross_tree(grid(a, b, g), grid(a, b, h))[1]
            model.pair_tables[k] += tree
            total += tree[wide[a], wide[b]]
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = matrix(batch.column("t").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("y"), pa.array(list(x), type=pa.list_(pa.float64()))], ["id", "y", "x"]
        )


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """The model of at most SAMPLE labelled rows that are not held out.

    The sampled ids are broadcast: SAMPLE rows at most. So is what the driver collects, a row of
    FEATURES each; rows of docs that repeat an id train together only within SAMPLE rows."""
    known = (
        labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y"))
        .filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64(F.lit("fit"), "id"), "id")
        .limit(SAMPLE)
    )
    sampled = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("t")).join(
        F.broadcast(known), F.col("doc") == F.col("id")
    )
    rows = sampled.select("id", "y", "t").mapInArrow(_featured, "id bigint, y int, x array<double>")
    rows = rows.orderBy(F.xxhash64(F.lit("fit"), "id"), "id", "y", "x").limit(SAMPLE).toArrow()
    x = np.array(rows.column("x").to_pylist(), dtype=np.float64).reshape(rows.num_rows, len(FEATURES))
    return fit(x, rows.column("y").to_numpy().astype(np.float64))


def scored(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """`row` (all columns of docs) and `score`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [
                model.score(matrix(batch.column("t").slice(low, 1000).to_pylist()))
                for low in range(0, batch.num_rows, 1000)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.concatenate([np.zeros(0), *scores]))], ["row", "score"]
            )

    picked = docs.select(F.struct("*").alias("row"), F.col(text).alias("t"))
    return picked.mapInArrow(run, picked.select("row").schema.add("score", "double"))
