"""Near-duplicate embeddings by cross-polytope hashing with multiprobe.

A vector's hash is the nearest signed axis after a fast random rotation: three rounds of
random signs and a Hadamard transform. Several hashes make the key of a bucket, and there are
several tables. In each table a vector is at home in one bucket and probes the buckets whose
axes are nearest. The number of hashes follows the number of vectors, so that a bucket
holds CROWD unrelated vectors at most, and each number of hashes has as many tables and probes as hold
the recall. Candidates are pairs of a vector at home and one that
probes; every candidate's cosine is computed in double precision, and pairs of THRESHOLD
or more link.

Buckets are first counted by key alone, so vectors are sent only where a pair can meet.
Large buckets are cut into blocks of homes by blocks of guests: a block pair is a group of
bounded size, and no candidate is left out. Pairs are never written: a group returns, per
vector, how many links it found and one edge to the smallest vector it is connected to.
A pair that meets in several tables is counted where it meets first, which both vectors'
keys tell.

Equal vectors are one node with a multiplicity. Measured recall: see README.

Defined results: ids are whole numbers; null, empty and zero vectors, and those with null or non-finite
components, link with nothing; vectors link only with vectors of their own length; rows
without an id link with nothing and are not kept; rows that repeat count as vectors of
their own; an empty table gives an empty result; other columns and labels are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import connected_components, written

THRESHOLD = 0.9
#: Tables and probes for each number of hashes.
TABLES_PROBES = {3: (10, 16), 4: (16, 24), 5: (32, 64)}
#: Unrelated vectors at home in a bucket, from which on there is one hash more.
CROWD = 256
#: Nearest axes of each hash among which probes are chosen.
_NEAREST = 4
#: Homes and guests of a block.
BLOCK = 1024
SEED = 7


# ---------------------------------------------------------------- hashing


def hashes_of(buckets: float, width: int) -> int:
    """The least number of hashes whose keys make that many buckets, of vectors padded to this width."""
    return next((k for k in TABLES_PROBES if buckets <= (2 * width) ** k), max(TABLES_PROBES))


@cache
def _signs(width: int, n: int) -> np.ndarray:
    rng = np.random.default_rng([SEED, width])
    return rng.choice([-1.0, 1.0], size=(n, 3, width))


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of the rows, by sums and differences alone."""
    n, width = x.shape
    step = 1
    while step < width:
        y = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x


def _padded(x: np.ndarray) -> np.ndarray:
    width = max(2, 1 << max(0, x.shape[1] - 1).bit_length())
    return np.pad(_unit(x), ((0, 0), (0, width - x.shape[1])))


def _unit(x: np.ndarray) -> np.ndarray:
    """The rows at length 1. Scaled first, so that no square leaves the range of a double."""
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


@cache
def _choices(hashes: int) -> np.ndarray:
    return np.array(list(itertools.product(range(_NEAREST), repeat=hashes)))


def keys(x: np.ndarray, buckets: float) -> np.ndarray:
    """(n, tables, probes) bucket keys of the rows of x (n, length): the first probe is home.

    Rows give the same keys whatever rows they come with."""
    n, length = x.shape
    unit = _padded(x)
    width = unit.shape[1]
    hashes = hashes_of(buckets, width)
    tables, probes = TABLES_PROBES[hashes]
    axes, loss = [], []
    for signs in _signs(width, tables * hashes):
        y = unit
        for s in signs:
            y = _hadamard(y * s)
        size = np.abs(y)
        near = min(_NEAREST, width)
        top = np.argsort(-size, axis=1, kind="stable")[:, :near]
        picked = np.take_along_axis(y, top, 1)
        height = np.abs(picked) / np.sqrt(float(width)) ** 3
        axis = 2 * top + (picked < 0)
        axes.append(np.pad(axis, ((0, 0), (0, _NEAREST - near)), mode="edge"))
        loss.append(np.pad((height[:, :1] - height) ** 2, ((0, 0), (0, _NEAREST - near)), constant_values=9.0))
    out = np.empty((n, tables, probes), dtype=np.int64)
    for t in range(tables):
        cost, key = 0.0, np.int64(length) * tables + t
        for h in range(hashes):
            pick = _choices(hashes)[:, h]
            cost = cost + loss[t * hashes + h][:, pick]
            key = key * (2 * width) + axes[t * hashes + h][:, pick]
        best = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        out[:, t] = np.take_along_axis(np.broadcast_to(key, cost.shape), best, 1)
    return out


def _vectors(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.split(values, np.cumsum(whole.value_lengths().to_numpy())[:-1]) if len(whole) else []


def _by_length(vectors: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) for each length of vector."""
    lengths = np.array([len(v) for v in vectors], dtype=np.int64)
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield at, np.stack([vectors[i] for i in at])


def _keyed(buckets: float):
    """A row per vector, table and probe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for at, x in _by_length(_vectors(batch.column("vector"))):
                for low in range(0, len(x), 2000):
                    found = keys(x[low : low + 2000], buckets)
                    n, tables, probes = found.shape
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(ids[at[low : low + 2000]], tables * probes)),
                            pa.array(found.reshape(-1)),
                            pa.array(np.tile(np.arange(probes) == 0, n * tables)),
                        ],
                        ["id", "bucket", "home"],
                    )

    return run


# ---------------------------------------------------------------- comparing


def _links(x: np.ndarray, homes: np.ndarray, guests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (home, guest) of the pairs of unit rows with a cosine of THRESHOLD or more."""
    cosine = x[homes] @ x[guests].T
    i, j = np.nonzero(cosine >= THRESHOLD - 1e-9)
    i, j = homes[i], guests[j]
    exact = np.einsum("ij,ij->i", x[i], x[j]) >= THRESHOLD  # the same sum in every table
    return i[exact], j[exact]


def _first_meeting(own: np.ndarray, i: np.ndarray, j: np.ndarray, ids: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Whether the pairs (home i, guest j) meet in `bucket` first: in no earlier table, and, if both
    are at home to each other in this one, with the smaller id at home."""
    out = np.empty(len(i), dtype=bool)
    for low in range(0, len(i), 50_000):
        part = slice(low, low + 50_000)
        a, b = own[i[part]], own[j[part]]
        visits_a = (b == a[:, :, :1]).any(2)
        visits_b = (a == b[:, :, :1]).any(2)
        table = (a[:, :, 0] == bucket[part, None]).argmax(1)
        first = (visits_a | visits_b).argmax(1)
        swapped = (ids[i[part]] > ids[j[part]]) & np.take_along_axis(visits_b, table[:, None], 1)[:, 0]
        out[part] = (first == table) & ~swapped
    return out


def _roots(n: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id connected to each of n places by the links (i, j)."""
    root = ids.copy()
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == root).all():
            return root
        root = new


def _compared(buckets: float):
    """Links within the groups of a sorted partition, group by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            key = [rows.column(c).to_numpy() for c in ("bucket", "home_block", "guest_block")]
            cut = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            ids, copies = rows.column("id").to_numpy(), rows.column("copies").to_numpy()
            home = rows.column("home").to_numpy(zero_copy_only=False)
            x = np.stack(_vectors(rows.column("vector")))
            unit = _unit(x)
            every = []
            for low, high in zip(np.r_[0, cut], np.r_[cut, len(ids)], strict=True):
                at = np.arange(low, high)
                i, j = _links(unit, at[home[low:high]], at[~home[low:high]])
                other = ids[i] != ids[j]
                every.append((i[other], j[other]))
            i, j = (np.concatenate(side) for side in zip(*every, strict=True))
            if not len(i):
                return
            used = np.unique(np.r_[i, j])
            of_used = keys(x[used], buckets)
            own = np.empty((len(ids), *of_used.shape[1:]), dtype=np.int64)
            own[used] = of_used
            new = _first_meeting(own, i, j, ids, key[0][i])
            links = np.bincount(i, copies[j] * new, len(ids)) + np.bincount(j, copies[i] * new, len(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[used]), pa.array(links[used].astype(np.int64)), pa.array(_roots(len(ids), i, j, ids)[used])],
                ["id", "links", "low"],
            )

        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            held = None
            if not rows.num_rows:
                continue
            key = [rows.column(c).to_numpy() for c in ("bucket", "home_block", "guest_block")]
            last = np.all([k == k[-1] for k in key], axis=0)
            start = len(last) - int(last.sum())  # the last group may go on in the next batch
            if start:
                for at, part in _lengths(rows.slice(0, start)):
                    del at
                    yield from found(part)
            held = rows.slice(start)
        if held is not None and held.num_rows:
            yield from found(held)

    return run


def _lengths(rows: pa.Table) -> Iterator[tuple[int, pa.Table]]:
    """The rows by length of vector: a bucket's key holds the length, so groups stay whole."""
    lengths = np.array([len(v) for v in _vectors(rows.column("vector"))])
    for length in np.unique(lengths):
        yield int(length), rows.filter(pa.array(lengths == length))


# ---------------------------------------------------------------- the operator


def near_duplicates(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row per vector."""
    value = F.col(embedding).cast("array<double>")
    finite = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    usable = F.col(vec_id).isNotNull() & value.isNotNull() & finite & F.exists(value, lambda v: v != 0)
    rows = written(
        vectors.select(
            F.col(vec_id).cast("long").alias("vec_id"), F.when(F.coalesce(usable, F.lit(False)), value).alias("value")
        ),
        "vectors",
    )
    nodes = written(
        rows.filter("value IS NOT NULL").groupBy("value").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")),
        "nodes",
    )
    packed = nodes.select("id", "copies", F.col("value").alias("vector"))
    buckets = nodes.count() / CROWD
    keyed = written(packed.select("id", "vector").mapInArrow(_keyed(buckets), "id bigint, bucket bigint, home boolean"), "keyed")
    meeting = (
        keyed.groupBy(F.col("bucket").alias("at"))
        .agg(F.count(F.when(F.col("home"), 1)).alias("homes"), F.count("*").alias("guests"))
        .filter("homes > 0 AND guests > 1")
        .select(
            "at",
            F.ceil(F.col("homes") / BLOCK).cast("int").alias("home_blocks"),
            F.ceil(F.col("guests") / BLOCK).cast("int").alias("guest_blocks"),
        )
    )
    sent = keyed.join(meeting, F.col("bucket") == F.col("at"))

    def blocks(own: str, other: str, as_home: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.col(f"{own}_blocks")).cast("int")
        return sent.filter("home" if as_home else "true").select(
            "id", "bucket", F.lit(as_home).alias("home"), block.alias(f"{own}_block"),
            F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block"),
        )

    placed = blocks("home", "guest", True).unionByName(blocks("guest", "home", False))
    held = packed.withColumnRenamed("id", "of")
    group = ["bucket", "home_block", "guest_block"]
    found = written(
        placed.join(held, F.col("id") == F.col("of"))
        .select(*group, "home", "id", "copies", "vector")
        .repartition(*group)
        .sortWithinPartitions(*group)
        .mapInArrow(_compared(buckets), "id bigint, links bigint, low bigint"),
        "found",
    )
    links = found.groupBy(F.col("id").alias("linked")).agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    known = (
        nodes.join(links, F.col("id") == F.col("linked"), "left")
        .join(roots, F.col("id") == F.col("node"), "left")
        .select(
            F.col("value").alias("same"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "id").alias("component_id"),
        )
    )
    component = F.coalesce("component_id", "vec_id")
    return rows.join(known, F.col("value") == F.col("same"), "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )

