"""Nearest neighbours by hierarchical navigable small-world graphs, one per shard.

Vectors are dealt into shards by a hash. A task builds the graph of one shard: each vector
gets a level by chance, and on each layer up to its level it links to near vectors that lie
in different directions. The graph is stored as a table, a row per vector with its links as
one flat array of places in the shard, layer after layer; so an index survives the loss of
the tasks that built it and serves any number of searches. A search sends each query to all
shards, descends each graph from its entry and walks the lowest layer with a beam of
BEAM vectors; the nearest of all shards are merged by a windowed limit, which Spark applies
before the shuffle.

Many vectors are inserted, and many queries searched, side by side: each step of the walk is
one set of array operations. Vectors of a batch find each other by comparing all of them.

Every vector is indexed. Scores are computed from the original vectors, in double
precision. The number of shards is that of shuffle partitions, or more where a shard
would hold over SHARD_VALUES numbers, so a task's memory is bounded. Equal vectors are one
node with their NEAREST + 1 smallest ids: no more of them can be among the nearest.

Defined results: ids are whole numbers. Vectors that are null, empty, zero or hold null or
non-finite components take no part, nor do rows without an id; vectors are compared with
vectors of their own length only; rows equal in id and vector count once; a row finds no row
of its own id; ties go to the smaller id; an empty table gives an empty result; other columns
are not read. Measured recall: see README.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.shared import written

NEAREST = 10
#: Links of a node on the layers above the lowest, which has twice as many.
LINKS = 16
#: Vectors kept while searching: for the links of a new node, and for a query.
BUILD_BEAM, BEAM = 96, 128
#: Numbers (vectors times their length) of a shard.
SHARD_VALUES = 1 << 23
#: Vectors inserted or searched side by side, and numbers held by one step of it.
BATCH, STEP_VALUES = 256, 1 << 20
SEED = 11


# ---------------------------------------------------------------- the graph


def levels(n: int, seed: int) -> np.ndarray:
    """A level per node: each layer has one in LINKS of the nodes of the layer below."""
    chance = np.random.default_rng([SEED, seed]).random(n)
    return np.floor(-np.log1p(-chance) / np.log(LINKS)).astype(np.int32)


#: A square beyond the range of a double counts as its largest number, so that only none is infinite.
_FARTHEST = np.finfo(np.float64).max


def _squared(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.minimum((x**2).sum(-1), _FARTHEST)


def distances(x: np.ndarray) -> np.ndarray:
    """The lengths of the rows of x, added up in order; beyond the range of squares, with scaled rows."""
    with np.errstate(over="ignore"):
        length = np.sqrt(np.cumsum(x**2, axis=1)[:, -1])
    most = np.abs(x).max(axis=1, initial=0.0)
    odd = (np.isinf(length) | (length < 1e-140)) & (most > 0) & np.isfinite(most)
    if odd.any():
        length[odd] = most[odd] * np.sqrt(np.cumsum((x[odd] / most[odd, None]) ** 2, axis=1)[:, -1])
    return length


class Graph:
    """Vectors, their levels and, by layer, the links of each node as a row of places (-1: none)."""

    def __init__(self, x: np.ndarray, level: np.ndarray):
        self.x, self.level = x, level
        layers = int(level.max()) + 1
        self.row = [np.cumsum(level >= k) - 1 for k in range(layers)]
        self.links = [
            np.full((int((level >= k).sum()), LINKS if k else 2 * LINKS), -1, dtype=np.int32) for k in range(layers)
        ]
        self.entry = 0

    def nearest(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, squared distances) of the vectors found for each query, nearest first; -1 and inf: none."""
        start = np.full(len(queries), self.entry)
        for layer in range(int(self.level[self.entry]), 0, -1):
            start = self._walk(layer, queries, start, 1)[0][:, 0]
        return self._walk(0, queries, start, beam)

    def _walk(self, layer: int, queries: np.ndarray, start: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(queries)
        links, row = self.links[layer], self.row[layer]
        place = np.full((n, beam), -1, dtype=np.int64)
        far = np.full((n, beam), np.inf)
        open_far = np.full((n, beam), np.inf)  # inf where a place has been expanded
        place[:, 0] = start
        far[:, 0] = open_far[:, 0] = _squared(self.x[start] - queries)
        seen = np.zeros((n, len(self.x)), dtype=bool)
        seen[np.arange(n), start] = True
        at = np.arange(n)
        while True:
            pick = open_far[at].argmin(1)
            on = np.isfinite(open_far[at, pick])
            at, pick = at[on], pick[on]
            if not len(at):
                break
            open_far[at, pick] = np.inf
            found = links[row[place[at, pick]]].astype(np.int64)
            new = (found >= 0) & ~seen[at[:, None], found]
            seen[at[:, None], np.where(new, found, place[at, pick][:, None])] = True
            distance = np.full(found.shape, np.inf)
            who, _ = np.nonzero(new)
            distance[new] = _squared(self.x[found[new]] - queries[at[who]])
            # The nearest of the old and the new ones stay.
            every = np.concatenate([far[at], distance], axis=1)
            keep = np.argpartition(every, beam - 1, axis=1)[:, :beam]
            far[at] = np.take_along_axis(every, keep, 1)
            place[at] = np.take_along_axis(np.concatenate([place[at], np.where(new, found, -1)], axis=1), keep, 1)
            open_far[at] = np.take_along_axis(np.concatenate([open_far[at], distance], axis=1), keep, 1)
        order = np.argsort(far, axis=1, kind="stable")
        return np.take_along_axis(place, order, 1), np.take_along_axis(far, order, 1)

    def insert(self, new: np.ndarray) -> None:
        """Links the next nodes, which are the places `new`, to those before them and to each other."""
        x = self.x[new]
        with np.errstate(over="ignore", invalid="ignore"):
            size = (x**2).sum(1)
            within = np.maximum(np.nan_to_num(size[:, None] + size - 2 * x @ x.T, nan=_FARTHEST, posinf=_FARTHEST), 0.0)
        np.fill_diagonal(within, np.inf)
        start = np.full(len(new), self.entry)
        top = int(self.level[self.entry]) if new[0] else -1
        for layer in range(int(max(top, self.level[new].max())), -1, -1):
            joins = np.flatnonzero(self.level[new] >= layer)
            place = np.full((len(joins), 0), -1, dtype=np.int64)
            far = np.full((len(joins), 0), np.inf)
            if layer <= top:
                passing = np.flatnonzero(self.level[new] < layer)
                if len(passing):
                    start[passing] = self._walk(layer, x[passing], start[passing], 1)[0][:, 0]
                if len(joins):
                    place, far = self._walk(layer, x[joins], start[joins], BUILD_BEAM)
                    start[joins] = place[:, 0]
            if not len(joins):
                continue
            near = np.argsort(within[np.ix_(joins, joins)], axis=1, kind="stable")[:, :BUILD_BEAM]
            place = np.concatenate([place, new[joins[near]]], axis=1)
            far = np.concatenate([far, np.take_along_axis(within[np.ix_(joins, joins)], near, 1)], axis=1)
            linked = self._spread(new[joins], place, far, LINKS)
            self.links[layer][self.row[layer][new[joins]], :LINKS] = linked
            self._link_back(layer, new[joins], linked)
        highest = new[self.level[new].argmax()]
        if not new[0] or self.level[highest] > self.level[self.entry]:
            self.entry = int(highest)

    def _spread(self, base: np.ndarray, place: np.ndarray, far: np.ndarray, most: int) -> np.ndarray:
        """Up to `most` places per row: near ones, first those nearer to the base than to any place taken before."""
        order = np.argsort(far, axis=1, kind="stable")
        place, far = np.take_along_axis(place, order, 1), np.take_along_axis(far, order, 1)
        out = np.full((len(base), most), -1, dtype=np.int32)
        step = max(1, STEP_VALUES // (place.shape[1] * self.x.shape[1] + 1))
        for low in range(0, len(base), step):
            at, d = place[low : low + step], far[low : low + step]
            v = self.x[at] - self.x[base[low : low + step], None]
            with np.errstate(over="ignore", invalid="ignore"):
                size = (v**2).sum(2)
                apart = size[:, :, None] + size[:, None] - 2 * v @ v.transpose(0, 2, 1)
            there = np.isfinite(d)
            taken, hidden = np.zeros(d.shape, dtype=bool), ~there
            for c in range(d.shape[1]):
                taken[:, c] = ~hidden[:, c] & (taken.sum(1) < most)
                hidden |= taken[:, c, None] & (apart[:, c] < d)
            rank = np.where(taken, 0, np.where(there, 1, 2))  # the nearest of the others fill up
            first = np.argsort(rank, axis=1, kind="stable")[:, :most]
            chosen = np.where(np.take_along_axis(there, first, 1), np.take_along_axis(at, first, 1), -1)
            out[low : low + step, : chosen.shape[1]] = chosen
        return out

    def _link_back(self, layer: int, base: np.ndarray, linked: np.ndarray) -> None:
        """Adds the opposite links; a node with too many keeps those in different directions."""
        who, slot = np.nonzero(linked >= 0)
        source, target = base[who], linked[who, slot].astype(np.int64)
        far = _squared(self.x[source] - self.x[target])
        order = np.lexsort((far, target))
        source, target, far = source[order], target[order], far[order]
        node, first, count = np.unique(target, return_index=True, return_counts=True)
        turn = np.arange(len(target)) - np.repeat(first, count)
        rows = self.row[layer][node]
        width = self.links[layer].shape[1]
        held = self.links[layer][rows].astype(np.int64)
        more = np.full((len(node), min(width, int(count.max(initial=0)))), -1, dtype=np.int64)
        fits = turn < more.shape[1]
        more[np.repeat(np.arange(len(node)), count)[fits], turn[fits]] = source[fits]
        # Two nodes of one batch may have chosen each other.
        more[(more[:, :, None] == held[:, None]).any(2)] = -1
        both = np.concatenate([held, more], axis=1)
        step = max(1, STEP_VALUES // (both.shape[1] * self.x.shape[1]))
        for low in range(0, len(node), step):
            at = both[low : low + step]
            distance = _squared(self.x[at] - self.x[node[low : low + step], None])
            distance[at < 0] = np.inf
            self.links[layer][rows[low : low + step]] = self._spread(node[low : low + step], at, distance, width)

    def join_up(self) -> None:
        """Links every node that no path from the entry reaches to the nearest of those that one does."""
        while True:
            reached = np.zeros(len(self.x), dtype=bool)
            reached[self.entry] = True
            edge = np.array([self.entry])
            while len(edge):
                found = np.unique(self.links[0][edge])
                edge = found[(found >= 0) & ~reached[found]]
                reached[edge] = True
            lost = np.flatnonzero(~reached)
            if not len(lost):
                return
            place = self.nearest(self.x[lost[:BATCH]], BEAM)[0][:, 0]
            node, which = np.unique(place, return_index=True)
            wide = np.full((len(self.x), 1), -1, dtype=np.int32)
            wide[node, 0] = lost[which]
            self.links[0] = np.concatenate([self.links[0], wide], axis=1)


def build(x: np.ndarray, seed: int) -> Graph:
    """The graph of the rows of x: batches of at most as many nodes as there are, up to BATCH."""
    graph = Graph(x, levels(len(x), seed))
    low = 0
    while low < len(x):
        high = min(len(x), low + max(1, min(BATCH, low, STEP_VALUES // x.shape[1])))
        if not low:
            high = min(len(x), LINKS)
        graph.insert(np.arange(low, high))
        low = high
    graph.join_up()
    return graph


# ---------------------------------------------------------------- as tables

_INDEX = "shard int, length int, place int, ids array<bigint>, vector array<double>, level int, counts array<int>, links array<int>"


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(values, kind))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, sizes) of a list column."""
    return column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[pa.RecordBatch]]:
    """The batches of each (shard, length) of a sorted partition in turn; a batch has rows of one group."""
    def pieces() -> Iterator[tuple[tuple, pa.RecordBatch]]:
        for batch in batches:
            shard, length = (batch.column(c).to_numpy() for c in ("shard", "length"))
            cut = np.flatnonzero((shard[1:] != shard[:-1]) | (length[1:] != length[:-1])) + 1
            for low, high in zip(np.r_[0, cut], np.r_[cut, len(shard)], strict=True):
                if high > low:
                    yield (int(shard[low]), int(length[low])), batch.slice(low, high - low)

    for _, group in groupby(pieces(), key=lambda item: item[0]):
        yield (piece for _, piece in group)


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return _flat(column)[0].astype(np.float64).reshape(-1, length)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Builds the graph of each group of rows (shard, length, ids, vector)."""
    for group in _groups(batches):
        rows = pa.Table.from_batches(group).combine_chunks()
        shard, length = rows.column("shard")[0].as_py(), rows.column("length")[0].as_py()
        x = _matrix(rows.column("vector").chunk(0), length)
        graph = build(x, shard)
        ids, sizes = _flat(rows.column("ids").chunk(0))
        ends = np.cumsum(sizes)
        step = max(1, STEP_VALUES // length)
        for low in range(0, len(x), step):
            place = np.arange(low, min(len(x), low + step))
            level = graph.level[place]
            counts = level.astype(np.int64) + 1
            links, per_layer = [], []
            for p, top in zip(place, level, strict=True):
                for layer in range(top + 1):
                    mine = graph.links[layer][graph.row[layer][p]]
                    mine = mine[mine >= 0]
                    links.append(mine)
                    per_layer.append(len(mine))
            layer_sizes = np.array(per_layer, dtype=np.int64)
            per_node = np.add.reduceat(layer_sizes, np.r_[0, np.cumsum(counts)[:-1]])
            part = slice(ends[low] - sizes[low], ends[place[-1]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(place), shard), pa.int32()), pa.array(np.full(len(place), length), pa.int32()),
                    pa.array(place, pa.int32()), _lists(ids[part], sizes[place], pa.int64()),
                    _lists(x[place].reshape(-1), np.full(len(place), length), pa.float64()), pa.array(level, pa.int32()),
                    _lists(layer_sizes, counts, pa.int32()), _lists(np.concatenate(links), per_node, pa.int32()),
                ],
                ["shard", "length", "place", "ids", "vector", "level", "counts", "links"],
            )


def _loaded(rows: pa.Table, length: int) -> Graph:
    """The graph of a shard, from its rows in order of place."""
    rows = rows.combine_chunks()
    level = rows.column("level").to_numpy()
    graph = Graph(_matrix(rows.column("vector").chunk(0), length), level)
    links, _ = _flat(rows.column("links").chunk(0))
    sizes, layers = _flat(rows.column("counts").chunk(0))
    node = np.repeat(np.arange(len(level)), layers)
    layer = np.arange(len(sizes)) - np.repeat(np.cumsum(layers) - layers, layers)
    begin = np.cumsum(sizes) - sizes
    for k in range(len(graph.links)):
        here = np.flatnonzero(layer == k)
        width = max(graph.links[k].shape[1], int(sizes[here].max(initial=0)))
        table = np.full((len(here), width), -1, dtype=np.int32)
        slot = np.arange(int(sizes[here].sum())) - np.repeat(np.cumsum(sizes[here]) - sizes[here], sizes[here])
        table[np.repeat(graph.row[k][node[here]], sizes[here]), slot] = links[np.repeat(begin[here], sizes[here]) + slot]
        graph.links[k] = table
    graph.entry = int(level.argmax())
    return graph


def _searched(nearest: int):
    """Answers the queries of each group: its index rows come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            held: list[pa.RecordBatch] = []
            graph = None
            for rows in group:
                asks = rows.column("query_id").is_valid().to_numpy(zero_copy_only=False)
                index = rows.filter(pa.array(~asks))
                if index.num_rows:
                    held.append(index)
                queries = rows.filter(pa.array(asks))
                if not queries.num_rows or not held:
                    continue
                length = queries.column("length")[0].as_py()
                if graph is None:
                    table = pa.Table.from_batches(held)
                    graph = _loaded(table, length)
                    ids, sizes = _flat(table.column("ids").combine_chunks())
                    begin = np.cumsum(sizes) - sizes
                step = max(1, min(BATCH, STEP_VALUES // (2 * LINKS * length)))
                for low in range(0, queries.num_rows, step):
                    part = queries.slice(low, step)
                    own = part.column("query_id").to_numpy()
                    q = _matrix(part.column("vector"), length)
                    place = graph.nearest(q, max(BEAM, nearest + 1))[0]
                    who, slot = np.nonzero(place >= 0)
                    exact = np.full(place.shape, np.inf)
                    exact[who, slot] = distances(graph.x[place[who, slot]] - q[who])
                    # The nearest, one more for the query's own node, and what ties with them.
                    last = np.partition(exact, nearest, axis=1)[:, nearest, None]
                    who, slot = np.nonzero((place >= 0) & (exact <= last))
                    at, score = place[who, slot], exact[who, slot]
                    copies = sizes[at]
                    turn = np.arange(int(copies.sum())) - np.repeat(np.cumsum(copies) - copies, copies)
                    found = ids[np.repeat(begin[at], copies) + turn]
                    who, score = np.repeat(who, copies), np.repeat(score, copies)
                    other = found != own[who]
                    found, who, score = found[other], who[other], score[other]
                    order = np.lexsort((found, score, who))
                    found, who, score = found[order], who[order], score[order]
                    _, first, count = np.unique(who, return_index=True, return_counts=True)
                    few = np.arange(len(who)) - np.repeat(first, count) < nearest
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(own[who[few]]), part.column("query_key").take(pa.array(who[few])),
                            pa.array(found[few]), pa.array(score[few]),
                        ],
                        ["query_id", "query_key", "vec_id", "score"],
                    )

    return run


# ---------------------------------------------------------------- the operator


def _usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, vector) of the rows that take part, each once."""
    value = F.col(embedding).cast("array<double>")
    finite = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), value.alias("vector"), finite.alias("finite"))
    return (
        rows.filter(F.col("id").isNotNull() & F.col("finite") & F.exists("vector", lambda v: v != 0))
        .select("id", "vector")
        .distinct()
    )


def _shards(nodes: DataFrame) -> int:
    partitions = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = nodes.agg(F.sum(F.size("vector").cast("long")).alias("n")).first()["n"] or 0
    return max(partitions, -(-values // SHARD_VALUES))


def build_index(
    vectors: DataFrame, *, nearest: int = NEAREST, vec_id: str = "vec_id", embedding: str = "embedding"
) -> tuple[DataFrame, int]:
    """The index as a written table, and its number of shards."""
    same = Window.partitionBy("vector").orderBy("id")
    nodes = written(
        _usable(vectors, vec_id, embedding)
        .withColumn("turn", F.row_number().over(same))
        .filter(F.col("turn") <= nearest + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("id")).alias("ids")),
        "nodes",
    )
    shards = _shards(nodes)
    key = F.xxhash64("vector")
    dealt = nodes.select(
        F.pmod(key, F.lit(shards)).cast("int").alias("shard"), F.size("vector").alias("length"), key.alias("place"), "ids", "vector"
    )
    index = (
        dealt.repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("shard", "length", "place", "vector")
        .mapInArrow(_indexed, _INDEX)
    )
    return written(index, "graph"), shards


def search(
    index: DataFrame, shards: int, queries: DataFrame, *, nearest: int = NEAREST, vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found for each row of `queries`."""
    asked = _usable(queries, vec_id, embedding)
    none = lambda kind: F.lit(None).cast(kind)
    asks = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.size("vector").alias("length"),
        none("int").alias("place"), none("array<bigint>").alias("ids"), "vector", none("int").alias("level"),
        none("array<int>").alias("counts"), none("array<int>").alias("links"), F.col("id").alias("query_id"),
        F.xxhash64("vector").alias("query_key"),
    )
    stored = index.withColumns({"query_id": none("bigint"), "query_key": none("bigint")})
    found = (
        stored.unionByName(asks)
        .repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("shard", "length", F.col("place").asc_nulls_last(), "query_id")
        .mapInArrow(_searched(nearest), "query_id bigint, query_key bigint, vec_id bigint, score double")
    )
    merged = Window.partitionBy("query_id", "query_key").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(merged))
        .filter(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, *, nearest: int = NEAREST, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest other rows of each row for which `is_query` holds."""
    index, shards = build_index(vectors, nearest=nearest, vec_id=vec_id, embedding=embedding)
    return search(index, shards, vectors.filter(is_query), nearest=nearest, vec_id=vec_id, embedding=embedding)
