"""Near-duplicate vectors in double precision, and their components, against brute force."""

import numpy as np
import pytest

from siltstone.llm import cross_polytope, splitters


def found(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in cross_polytope.near_duplicates(df).collect()}


def at_cosine(c, scale=1.0, length=16):
    """Two vectors of about this cosine."""
    a, b = np.zeros(length), np.zeros(length)
    a[0], b[0], b[1] = 1.0, c, np.sqrt(1 - c * c)
    return (a * scale).tolist(), (b * scale).tolist()


def test_cosines_just_beside_the_threshold(spark):
    rows = []
    for i, c in enumerate((0.9 + 1e-9, 0.9 - 1e-9, 0.95, 0.85)):
        a, b = (np.roll(v, 3 * i).tolist() for v in at_cosine(c, length=32))
        rows += [(10 * i, a), (10 * i + 1, b)]
    got = found(spark, rows)
    assert [got[10 * i + 1][:2] for i in range(4)] == [(1, 0), (0, 11), (1, 20), (0, 31)]


def test_magnitudes_do_not_matter(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=24)
    rows = [(i, (base * s + 1e-3 * s * rng.normal(size=24)).tolist()) for i, s in enumerate((1e300, 1.0, 1e-300, 3e150))]
    assert found(spark, rows) == {i: (3, 0, i == 0) for i in range(4)}


def test_components_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(40):  # chains: each vector is near the one before it only
        v = rng.normal(size=24)
        for _ in range(int(rng.integers(1, 6))):
            rows.append((len(rows) * 3, v.tolist()))
            v = v / np.linalg.norm(v) + 0.07 * rng.normal(size=24)
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    root = np.array([i for i, _ in rows])
    for _ in rows:
        root = np.array([min([root[i], *root[near[i]]]) for i in range(len(rows))])
    got = found(spark, rows)
    want = {rows[i][0]: (int(near[i].sum()), int(root[i]), bool(root[i] == rows[i][0])) for i in range(len(rows))}
    assert near.sum() > 60 and len(set(root)) < len(rows) - 30
    assert sum(got[k] == v for k, v in want.items()) >= 0.97 * len(want)


def brute_force(ids, x):
    """(links, smallest id reachable) of each row."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    root = np.array(ids)
    for _ in ids:
        root = np.array([min([root[i], *root[near[i]]]) for i in range(len(x))])
    return near.sum(1), root


def pairs_at(cosine, n, length, seed=4):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=(2, n, length))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (b * a).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    return a, cosine * a + np.sqrt(1 - cosine**2) * b


def test_the_number_of_hashes_follows_the_number_of_vectors():
    rows = [10**3, 10**8, 10**9, 10**12]
    assert [cross_polytope.hashes_of(n / cross_polytope.CROWD, 64) for n in rows] == [3, 3, 4, 5]
    assert [cross_polytope.hashes_of(n / cross_polytope.CROWD, 1024) for n in rows] == [3, 3, 3, 3]


@pytest.mark.parametrize("length", [24, 64, 128])
@pytest.mark.parametrize("hashes", [3, 4, 5])
def test_pairs_at_the_threshold_meet_with_any_number_of_hashes(hashes, length):
    a, b = pairs_at(0.9, 300, length)
    width = 1 << (length - 1).bit_length()
    buckets = (2.0 * width) ** hashes
    of_a, of_b = cross_polytope.keys(a, buckets), cross_polytope.keys(b, buckets)
    assert of_a.shape[1:] == cross_polytope.TABLES_PROBES[hashes]
    meet = (of_b == of_a[:, :, :1]).any(2) | (of_a == of_b[:, :, :1]).any(2)
    assert meet.any(1).mean() >= 0.97
    # Strangers meet less, the more hashes there are.
    strangers = (np.roll(of_b, 1, axis=0) == of_a[:, :, :1]).any(2)
    assert strangers.mean() <= 20.0 * of_a.shape[2] / buckets + 0.001


@pytest.mark.parametrize("hashes", [3, 4, 5])
def test_links_are_counted_once_with_any_number_of_hashes(spark, monkeypatch, hashes):
    a, b = pairs_at(0.93, 40, 24)
    x = np.concatenate([a, b, a[:5] + 0.001, a[:3]])
    ids = list(range(7, 7 + 2 * len(x), 2))
    monkeypatch.setattr(cross_polytope, "CROWD", (len(x) - 3) / 64.0**hashes)
    assert cross_polytope.hashes_of((len(x) - 3) / cross_polytope.CROWD, 32) == hashes
    got = found(spark, [(i, v.tolist()) for i, v in zip(ids, x)])
    links, root = brute_force(ids, x)
    want = {i: (int(n), int(r), bool(i == r)) for i, n, r in zip(ids, links, root)}
    assert sum(got[i] == want[i] for i in ids) >= 0.97 * len(ids)
    assert all(got[i][0] <= want[i][0] for i in ids)


def test_ranges_that_stay_overfull_lose_no_record(spark, sf_dir, monkeypatch):
    """Where the rounds of dividing end early, counts are still those of the last splitters."""
    from siltstone.llm.queries import op8_splitter_shards

    whole = op8_splitter_shards(spark, sf_dir).count()
    monkeypatch.setattr(splitters, "ROUNDS", 1)
    monkeypatch.setattr(splitters, "SAMPLED_PER_RANGE", 0.5)
    rows = op8_splitter_shards(spark, sf_dir).select("doc_id", "shard", "slot").collect()
    assert len(rows) == whole == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
