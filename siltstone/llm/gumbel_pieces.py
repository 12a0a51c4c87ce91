"""SentencePiece encoding by sampling distinct segmentations, and decoding.

A text's lattice holds every way to spell it with the pieces of a SentencePiece model. A
segmentation's weight is the product of its pieces' weights; its probability, its share
of all segmentations. SAMPLES distinct segmentations are drawn without replacement by
Gumbel top-k: each segmentation's log probability is perturbed by a Gumbel variable, and
the largest are emitted, in order. None but the emitted paths is ever spelt out: an A*
search keeps sets of segmentations, each with the exact maximum of its perturbed log
probabilities as bound. The best set yields its best path; the rest of the set splits
into one set per token of the path (the same tokens before it, another one there), whose
maxima are Gumbel variables truncated at the path's. The inclusion score of a
segmentation is the probability that it passes the first bound that was not emitted.

The random numbers are hashes of a row's seed, so reruns and retries agree.

Pieces never go beyond a word, so the lattice is a chain of word lattices. Many
texts are worked on together: the lattice of each distinct word is built once, and all
their paths advance side by side.

Weights: those of the model if it is a unigram model; a BPE model ranks its pieces, and
a piece of rank r has the weight 1 / (r + OFFSET). Characters without a piece are
spelt in bytes.

Defined results: a null or empty text has one segmentation, without pieces; a text with
fewer segmentations than SAMPLES yields all of them, with inclusion 1; equal rows have
equal seeds and equal samples; a null id is carried through; no rows give no rows.
Decoding turns the word mark back into a space, so a text that holds the mark itself
reads back with spaces.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
#: -log(-log(u)) of the largest u that `uniform` gives, rounded up.
LARGEST = 38.0
OFFSET = 10.0
MARK = "▁"
#: Texts of about this many characters are worked on together.
TOGETHER = 2_000_000
_PRIME = np.uint64(0x9E3779B97F4A7C15)

# What a random number is for.
_WALK, _BOUND, _TURN, _ROOT = range(4)


# ---------------------------------------------------------------- the model


class Pieces:
    """The pieces of a model, their log weights, and a trie of them."""

    def __init__(self, proto: bytes):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=proto)
        p = self.processor
        size = p.get_piece_size()
        plain = [i for i in range(size) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]
        set_of_plain = set(plain)
        texts = {p.id_to_piece(i): i for i in plain}
        scores = np.array([p.get_score(i) for i in range(size)], dtype=np.float64)
        # Ranks are whole numbers from 0 down; log probabilities are not.
        ranked = all(scores[i] <= 0 and float(scores[i]).is_integer() for i in plain)
        self.weight = -np.log(OFFSET - np.minimum(scores, 0.0)) if ranked else scores
        self.byte = np.array([p.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        self.byte_weight = float(self.weight[plain].min()) - 1.0
        self.longest = max(map(len, texts), default=1)
        # A trie of the pieces: state 0 is none; by character the state it begins, and by state and
        # class of the next character the state that follows.
        begins = {t[:k] for t in texts for k in range(1, len(t) + 1)}
        inner = sorted({t[:k] for t in texts for k in range(1, len(t))})
        state = {t: i for i, t in enumerate([*inner, *sorted(begins - set(inner))], 1)}
        later = sorted({c for t in texts for c in t[1:]})
        self.inner, self.kinds = len(inner), len(later) + 1
        self.kind = np.zeros(0x110000, dtype=np.int32)
        self.kind[[ord(c) for c in later]] = np.arange(1, self.kinds)
        self.root = np.zeros(0x110000, dtype=np.int32)
        self.next = np.zeros((self.inner + 1) * self.kinds, dtype=np.int32)
        self.piece = np.full(len(state) + 1, -1, dtype=np.int32)
        for t, i in state.items():
            if len(t) == 1:
                self.root[ord(t)] = i
            else:
                self.next[state[t[:-1]] * self.kinds + self.kind[ord(t[-1])]] = i
            self.piece[i] = texts.get(t, -1)
        # What each piece spells, side by side.
        spelt = [p.id_to_piece(i).replace(MARK, " ").encode() if i in set_of_plain else b"" for i in range(size)]
        for b in range(256):
            spelt[self.byte[b]] = bytes([b])
        self.spelling_sizes = np.array([len(x) for x in spelt], dtype=np.int64)
        self.spelling_from = np.cumsum(self.spelling_sizes) - self.spelling_sizes
        self.spellings = np.frombuffer(b"".join(spelt), dtype=np.uint8)


@lru_cache(maxsize=2)
def pieces_of(proto: bytes) -> Pieces:
    return Pieces(proto)


def marked(text: str) -> str:
    """The text as the model sees it: a word mark before it and for each space."""
    return MARK + text.replace(" ", MARK) if text else ""


# ---------------------------------------------------------------- lattices


class Lattices:
    """The lattices of distinct units of text: nodes are places before a character, by their distance to the
    unit's end; edges are pieces, together by node."""

    def __init__(self, chars: np.ndarray, length: np.ndarray, pieces: Pieces):
        stop = np.repeat(np.cumsum(length), length).astype(np.int32)
        n = len(chars)
        found_at: list[tuple[np.ndarray, np.ndarray]] = []
        kind = pieces.kind[chars]
        active, state = np.arange(n, dtype=np.int32), pieces.root[chars]
        self.degree = np.zeros(n, dtype=np.int32)
        for size in range(1, pieces.longest + 1):
            piece = pieces.piece[state]
            whole = piece >= 0
            found_at.append((active[whole], piece[whole]))
            self.degree[found_at[-1][0]] += 1
            if size == 1:
                spelt = np.flatnonzero(self.degree == 0)  # characters without a piece
                self.degree[spelt] += 1
            on = (state > 0) & (state <= pieces.inner) & (active + size < stop[active])
            active, state = active[on], state[on]
            state = pieces.next[state * pieces.kinds + kind[active + size]]
            on = state > 0
            active, state = active[on], state[on]
            if not len(active):
                break
        in_bytes = [pieces.byte[list(chr(chars[i]).encode("utf-8", "surrogatepass"))] for i in spelt]

        rest = stop - np.arange(n, dtype=np.int32)
        short = n and rest.max() < 1 << 15  # numbers of 16 bits are sorted by digits
        by_rest = np.argsort(rest.astype(np.int16) if short else rest, kind="stable")
        node = np.empty(n, dtype=np.int32)
        node[by_rest] = np.arange(n, dtype=np.int32)
        distance, self.degree = rest[by_rest], self.degree[by_rest]
        self.first = np.r_[0, np.cumsum(self.degree)]
        edges = int(self.first[-1])
        self.size, piece = np.ones(edges, dtype=np.int32), np.full(edges, -1, dtype=np.int32)
        free = self.first[node]  # by character: the place of its next edge
        origin = np.empty(edges, dtype=np.int32)
        origin[free[spelt]] = spelt
        spelt_edges = free[spelt].copy()
        free[spelt] += 1
        for size, (start, whole) in enumerate(found_at, 1):
            place = free[start]
            self.size[place], piece[place], origin[place] = size, whole, start
            free[start] += 1
        spelling = np.zeros(edges, dtype=np.int32)
        spelling[spelt_edges] = [len(b) for b in in_bytes]
        end = origin + self.size
        self.final = end == stop[origin]
        self.to = np.where(self.final, -1, node[np.minimum(end, n - 1)])
        self.at = node[origin]
        weight = np.where(piece >= 0, pieces.weight[piece], spelling * pieces.byte_weight)

        # Ids of an edge: one piece, or several bytes.
        self.n_ids = np.where(piece >= 0, 1, spelling)
        self.ids_from = np.cumsum(self.n_ids) - self.n_ids
        self.ids = np.empty(int(self.n_ids.sum()), dtype=np.int32)
        self.ids[self.ids_from[piece >= 0]] = piece[piece >= 0]
        for e, own in zip(spelt_edges, in_bytes, strict=True):
            self.ids[self.ids_from[e] : self.ids_from[e] + len(own)] = own

        # Sums of weights to the unit's end, from the end on: all nodes of one distance at once.
        self.mass = np.empty(n)
        value = np.empty(edges)
        last = int(distance[-1]) if n else 0
        bounds = np.searchsorted(distance, np.arange(1, last + 2))
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            if low == high:
                continue
            part = slice(int(self.first[low]), int(self.first[high]))
            value[part] = weight[part] + np.where(self.final[part], 0.0, self.mass[self.to[part]])
            at = self.first[low:high] - self.first[low]
            top = np.maximum.reduceat(value[part], at)
            spread = np.exp(value[part] - np.repeat(top, self.first[low + 1 : high + 1] - self.first[low:high]))
            self.mass[low:high] = top + np.log(np.add.reduceat(spread, at))
        #: Log probability of each edge among those of its node.
        self.log_q = value - self.mass[self.at]
        self.q = np.exp(self.log_q)
        running = np.cumsum(self.q)
        before = running[self.first[:-1]] - self.q[self.first[:-1]]
        #: Running sums within a node; the last edge takes what is left.
        self.upto = running - before[self.at]
        self.upto[self.first[1:] - 1] = 2.0
        #: The first node of each unit.
        self.entry = node[np.cumsum(length) - length]

    def drawn(self, at: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edges of the nodes that the numbers u fall on."""
        edge = self.first[at]
        over = np.flatnonzero(u >= self.upto[edge])
        while len(over):
            edge[over] += 1
            over = over[u[over] >= self.upto[edge[over]]]
        return edge


# ---------------------------------------------------------------- sampling


def uniform(seed: np.ndarray, use: int, salt: int, place: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that depend on nothing but the arguments."""
    stream = ((use + 1) * 0xD6E8FEB86659FD93 + salt * 0xA0761D6478BD642F) & (1 << 64) - 1
    x = seed.view(np.uint64) ^ np.uint64(stream)
    x = x + place.astype(np.uint64) * _PRIME
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def truncated(location: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel variables of the given locations, each below its bound."""
    return location - np.log(np.exp(location - bound) - np.log(u))


def _ranges(start: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.arange(counts.sum()) + np.repeat(start - _firsts(counts), counts)


def _units(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The characters of all texts, the lengths of their units (word marks and what follows), and units per text."""
    seen = [marked(t) for t in texts]
    chars = np.frombuffer("".join(seen).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    length = np.array([len(t) for t in seen], dtype=np.int64)
    is_mark = chars == ord(MARK)
    begins = is_mark.copy()
    begins[1:] &= ~is_mark[:-1]
    begins[_firsts(length)[length > 0]] = True
    at = np.flatnonzero(begins)
    return chars, np.diff(np.r_[at, len(chars)]), np.diff(np.searchsorted(at, np.r_[0, np.cumsum(length)]))


def _distinct(chars: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the number of each unit among the distinct ones, the first unit of each).

    Units are grouped by a hash and then compared, so equal numbers mean equal units."""
    first = _firsts(length)
    place = (np.arange(len(chars)) - np.repeat(first, length)).astype(np.uint64)
    value = (chars.astype(np.uint64) + _PRIME) * (place * np.uint64(0xBF58476D1CE4E5B9) + _PRIME)
    value ^= value >> np.uint64(29)
    value *= np.uint64(0x94D049BB133111EB)
    value ^= value >> np.uint64(32)
    _, firsts, unit = np.unique(np.add.reduceat(value, first), return_index=True, return_inverse=True)
    if (length[firsts[unit]] == length).all() and (chars[_ranges(first[firsts[unit]], length)] == chars).all():
        return unit, firsts
    units = [chars[a : a + c].tobytes() for a, c in zip(first, length, strict=True)]
    book = {t: i for i, t in enumerate(dict.fromkeys(units))}
    unit = np.array([book[t] for t in units])
    return unit, np.unique(unit, return_index=True)[1]


def _firsts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


class _Paths:
    """One path per text: edges in order, and the bounds of the sets that branch off. turn and excluded: the
    place at which a path left its parent, and the edges that are ruled out there, by text."""

    def __init__(self, edges: np.ndarray, counts: np.ndarray, turn: np.ndarray, excluded: np.ndarray, lattices: Lattices):
        self.edges, self.counts, self.turn, self.excluded = edges, counts, turn, excluded
        self.first = _firsts(counts)
        log_q = lattices.log_q[edges]
        total = np.cumsum(log_q)
        before = np.r_[0.0, total][self.first]
        self.log_prob = np.r_[0.0, total][self.first + counts] - before
        #: Log probability of the tokens before each; falls along a path.
        self.before = total - log_q - np.repeat(before, counts)
        self.bounds = np.full(len(edges), -np.inf)

    def places(self, token: np.ndarray, doc: np.ndarray, lattices: Lattices) -> np.ndarray:
        """How many characters lie before the given tokens of the given texts."""
        if not hasattr(self, "through"):
            self.through = np.r_[0, np.cumsum(lattices.size[self.edges], dtype=np.int64)]
        return self.through[token] - self.through[self.first[doc]]


def _walk(lattices: Lattices, at: np.ndarray, place: np.ndarray, seed: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Random paths from nodes to the ends of their units: (edges in order of walkers, their numbers)."""
    who = np.argsort(at)  # neighbours in the lattice stay neighbours in memory
    at, place, seed = at[who], place[who], seed[who]
    steps = np.zeros(len(who), dtype=np.int64)
    taken: list[tuple[np.ndarray, np.ndarray]] = []
    while len(who):
        edge = lattices.drawn(at, uniform(seed, _WALK, salt, place))
        taken.append((who, edge))
        steps[who] = len(taken)
        more = np.flatnonzero(~lattices.final[edge])
        who, edge, seed = who[more], edge[more], seed[more]
        place, at = place[more] + lattices.size[edge], lattices.to[edge]
    first = _firsts(steps)
    out = np.empty(int(steps.sum()), dtype=np.int64)
    for step, (who, edge) in enumerate(taken):
        out[first[who] + step] = edge
    return out, steps


def _branch_bounds(path: _Paths, perturbed: np.ndarray, has: np.ndarray, rank: int, seeds: np.ndarray, lattices: Lattices) -> None:
    """Draws the bounds of the sets that branch off a path, from its turn on.

    A Gumbel variable is below LARGEST: a set that cannot reach the best bound found needs none."""
    n = len(has)
    doc = np.repeat(np.arange(n), path.counts)
    lowest = np.where(has, 0.0, np.inf)
    for _ in range(2):  # first as if a bound of 0 were found, then by the best found
        at = np.flatnonzero((path.before >= (lowest - LARGEST)[doc]) & (path.bounds == -np.inf))
        of = doc[at]
        edge, place = path.edges[at], at - path.first[of]
        node = lattices.at[edge]
        left, others = 1 - lattices.q[edge], lattices.degree[node] - 1
        turned = np.flatnonzero(place == path.turn[of])
        gone = path.excluded[of[turned]]
        left[turned] -= np.where(gone >= 0, lattices.q[np.maximum(gone, 0)], 0.0).sum(1)
        others[turned] -= (gone >= 0).sum(1)
        open_ = (place >= path.turn[of]) & (others > 0) & (left > 0)
        at, of, left = at[open_], of[open_], left[open_]
        path.bounds[at] = truncated(
            path.before[at] + np.log(left), perturbed[of],
            uniform(seeds[of], _BOUND, rank, path.places(at, of, lattices)),
        )
        lowest = np.where(has, -np.inf, np.inf)
        np.maximum.at(lowest, of, path.bounds[at])


def segmentations(texts: list[str], seeds: np.ndarray, pieces: Pieces, samples: int) -> list[tuple[np.ndarray, ...]]:
    """Per rank, from the first: (text, ids, their first places, counts, log probability, perturbed, inclusion),
    for the texts that have that many segmentations."""
    n = len(texts)
    chars, unit_length, n_units = _units(texts)
    perturbed = -np.log(-np.log(uniform(seeds, _ROOT, 0, np.zeros(n, dtype=np.int64))))
    if not len(unit_length):
        zero, none = np.zeros(n), np.zeros(n, dtype=np.int64)
        return [(np.arange(n), np.zeros(0, np.int32), none, none, zero, perturbed, np.ones(n))]
    unit, firsts = _distinct(chars, unit_length)
    own = unit_length[firsts]
    lattices = Lattices(chars[_ranges(_firsts(unit_length)[firsts], own)], own, pieces)
    unit_doc = np.repeat(np.arange(n), n_units)
    through = np.cumsum(unit_length)
    unit_place = through - unit_length - np.r_[0, through][_firsts(n_units)][unit_doc]
    entry = lattices.entry[unit]

    def per_text(walkers: np.ndarray, steps: np.ndarray) -> np.ndarray:
        return np.bincount(walkers, steps, n).astype(np.int64)

    edges, steps = _walk(lattices, entry, unit_place, seeds[unit_doc], 0)
    none = np.full(n, -1)
    paths = [_Paths(edges, per_text(unit_doc, steps), none, np.full((n, samples), -1), lattices)]
    has = np.ones(n, dtype=bool)
    emitted = []
    for rank in range(samples):
        _branch_bounds(paths[-1], perturbed, has, rank, seeds, lattices)
        emitted.append((paths[-1], perturbed, has))
        # The best set of each text over all its paths.
        best, where, which = np.full(n, -np.inf), none.copy(), none.copy()
        for k, path in enumerate(paths):
            some = np.flatnonzero(path.counts)
            top = np.full(n, -np.inf)
            top[some] = np.maximum.reduceat(path.bounds, path.first[some]) if len(some) else 0.0
            better = top > best
            hit = np.flatnonzero(path.bounds > -np.inf)
            of = np.searchsorted(path.first + path.counts, hit, side="right")
            chosen = (path.bounds[hit] == top[of]) & better[of]
            where[of[chosen]] = hit[chosen]
            best, which = np.where(better, top, best), np.where(better, k, which)
        if rank + 1 == samples or not np.isfinite(best).any():
            break
        # Its best path: the parent's tokens before the turn, another edge there, a free walk after it.
        has, perturbed = np.isfinite(best), best
        mine = np.flatnonzero(has)
        turn, excluded = np.full(n, len(chars) + 1), np.full((n, samples), -1)
        turn_place, edge = np.zeros(n, dtype=np.int64), none.copy()
        prefix: list[tuple[np.ndarray, np.ndarray]] = []
        for k, path in enumerate(paths):
            of = mine[which[mine] == k]
            token = where[of]
            path.bounds[token] = -np.inf
            turn[of] = token - path.first[of]
            turn_place[of] = path.places(token, of, lattices)
            again = path.turn[of] == turn[of]
            excluded[of[again]] = path.excluded[of[again]]
            excluded[of, (excluded[of] >= 0).sum(1)] = path.edges[token]
            node = lattices.at[path.edges[token]]
            edge[of] = _another(lattices, node, excluded[of], uniform(seeds[of], _TURN, rank, turn_place[of]))
            prefix.append((of, path.edges[_ranges(path.first[of], turn[of])]))
        # What is left of the unit, then the units after it.
        going = mine[~lattices.final[edge[mine]]]
        after = np.flatnonzero((unit_place > turn_place[unit_doc]) & has[unit_doc])
        walkers = np.r_[going, unit_doc[after]]
        start = np.r_[lattices.to[edge[going]], entry[after]]
        place = np.r_[turn_place[going] + lattices.size[edge[going]], unit_place[after]]
        order = np.argsort(walkers, kind="stable")
        walkers, start, place = walkers[order], start[order], place[order]
        walked, steps = _walk(lattices, start, place, seeds[walkers], rank + 1)
        walked_counts = per_text(walkers, steps)
        counts = np.where(has, turn + 1, 0) + walked_counts
        first, edges = _firsts(counts), np.empty(int(counts.sum()), dtype=np.int64)
        for of, tokens in prefix:
            edges[_ranges(first[of], turn[of])] = tokens
        edges[first[mine] + turn[mine]] = edge[mine]
        edges[_ranges(np.where(has, first + turn + 1, 0), walked_counts)] = walked
        paths.append(_Paths(edges, counts, turn, excluded, lattices))
    out = []
    for path, g, has in emitted:
        n_ids = lattices.n_ids[path.edges]
        if (n_ids == 1).all():
            ids, per_doc = lattices.ids[lattices.ids_from[path.edges]], path.counts
        else:
            ids = lattices.ids[_ranges(lattices.ids_from[path.edges], n_ids)]
            per_doc = np.diff(np.r_[0, np.cumsum(n_ids)][np.r_[path.first, len(path.edges)]])
        # best: the first bound that was not emitted.
        gap = path.log_prob - np.where(np.isfinite(best), best, 0.0)
        inclusion = np.where(np.isfinite(best), -np.expm1(-np.exp(np.minimum(gap, 700.0))), 1.0)
        which = np.flatnonzero(has)
        out.append((which, ids, _firsts(per_doc)[which], per_doc[which], path.log_prob[which], g[which], inclusion[which]))
    return out


def _another(lattices: Lattices, node: np.ndarray, gone: np.ndarray, u: np.ndarray) -> np.ndarray:
    """An edge of each node that is not among the gone ones, by the edges' probabilities."""
    if not len(node):
        return node
    choice = lattices.first[node][:, None] + np.arange(int(lattices.degree[node].max()))
    allowed = choice < lattices.first[node + 1][:, None]
    allowed &= ~(choice[:, :, None] == gone[:, None, :]).any(2)
    running = np.cumsum(np.where(allowed, lattices.q[np.minimum(choice, len(lattices.q) - 1)], 0.0), axis=1)
    last = allowed.shape[1] - 1 - allowed[:, ::-1].argmax(1)
    pick = np.minimum((running <= (u * running[:, -1])[:, None]).sum(1), last)
    return choice[np.arange(len(node)), pick]


# ---------------------------------------------------------------- the operator


def model_bytes(model_file: str = MODEL_FILE) -> bytes:
    with open(model_file, "rb") as file:
        return file.read()


COLUMNS = ("sample", "n_pieces", "log_prob", "perturbed", "inclusion", "pieces", "reads_back")
_SAMPLED = "sample int, n_pieces int, log_prob double, perturbed double, inclusion double, pieces array<int>, reads_back boolean"


def sampled(docs: DataFrame, *, text: str = "text", samples: int = SAMPLES, model_file: str = MODEL_FILE, key: str = "doc_id") -> DataFrame:
    """`row` (all columns of docs but the text), and per sample: its rank from 1, the number of pieces, the log
    probability, the perturbed one, the inclusion score, the pieces, and whether they decode to the text.

    The model (its size is fixed) travels with the tasks, so it need not lie on each machine."""
    proto = model_bytes(model_file)
    rest = [docs[c] for c in docs.columns if c != text]
    picked = docs.select(
        F.struct(*rest, F.lit(0).alias("_")).alias("row"), F.xxhash64(F.lit("pieces"), F.col(key), F.col(text)).alias("seed"),
        F.coalesce(F.col(text), F.lit("")).alias("t"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(proto)
        for batch in batches:
            low = size = 0
            lengths = pa.compute.utf8_length(batch.column("t")).to_pylist()
            for high in range(1, batch.num_rows + 1):
                size += lengths[high - 1]
                if size >= TOGETHER or high == batch.num_rows:
                    yield from _samples_of(batch.slice(low, high - low), pieces, samples)
                    low, size = high, 0

    row = picked.select("row").schema.simpleString()[len("struct<row:") : -1]
    return picked.mapInArrow(run, f"row {row}, {_SAMPLED}").withColumn("row", F.col("row").dropFields("_") if rest else F.col("row"))


def _samples_of(batch: pa.RecordBatch, pieces: Pieces, samples: int) -> Iterator[pa.RecordBatch]:
    texts = batch.column("t").to_pylist()
    seeds = batch.column("seed").to_numpy()
    for rank, (which, ids, first, count, log_prob, g, inclusion) in enumerate(segmentations(texts, seeds, pieces, samples)):
        if len(which) == len(texts):
            lists = pa.ListArray.from_arrays(pa.array(np.r_[first, len(ids)].astype(np.int32)), pa.array(ids))
        else:
            lists = pa.array([ids[a : a + c] for a, c in zip(first, count, strict=True)], pa.list_(pa.int32()))
        back = reads_back(pieces, ids, count, [texts[i] for i in which])
        yield pa.RecordBatch.from_arrays(
            [batch.column("row").take(pa.array(which)), pa.array(np.full(len(which), rank + 1, np.int32)),
             pa.array(count.astype(np.int32)), pa.array(log_prob), pa.array(g), pa.array(inclusion), lists, pa.array(back, pa.bool_())],
            ["row", "sample", "n_pieces", "log_prob", "perturbed", "inclusion", "pieces", "reads_back"],
        )


def decoded(pieces: Pieces, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The texts, in UTF-8, of pieces side by side: counts says how many each text has."""
    size = pieces.spelling_sizes[ids]
    raw = pieces.spellings[_ranges(pieces.spelling_from[ids], size)].tobytes()
    ends = np.r_[0, np.cumsum(size)][np.cumsum(counts)].tolist()
    begins = [0, *ends[:-1]]
    # The mark that stands before the first word is no space of the text.
    return [raw[a + (raw[a : a + 1] == b" ") : b] for a, b in zip(begins, ends, strict=True)]


def reads_back(pieces: Pieces, ids: np.ndarray, counts: np.ndarray, texts: list[str]) -> list[bool]:
    read = decoded(pieces, ids, counts)
    return [a == b.replace(MARK, " ").encode("utf-8", "surrogatepass") for a, b in zip(read, texts, strict=True)]


def decode(encoded: DataFrame, *, pieces: str = "pieces", model_file: str = MODEL_FILE) -> DataFrame:
    """`row` (all columns of encoded) and `text`; null pieces give null. Bytes that are no UTF-8 read as U+FFFD."""
    proto = model_bytes(model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces_of(proto)
        for batch in batches:
            lists = batch.column("p")
            counts = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            read = decoded(model, lists.flatten().to_numpy(zero_copy_only=False), counts.astype(np.int64))
            texts = [r.decode("utf-8", "replace") if x.is_valid else None for r, x in zip(read, lists, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    picked = encoded.select(F.struct("*").alias("row"), F.col(pieces).cast("array<int>").alias("p"))
    return picked.mapInArrow(run, picked.select("row", F.lit("").cast("string").alias("text")).schema)
