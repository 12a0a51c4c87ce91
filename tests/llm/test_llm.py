"""Each operator against brute force on a small fixture, and on nulls, empty and long texts, ties, repeated
rows, empty tables and extra columns."""

import base64
import collections
import hashlib
import itertools
import math
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from siltstone.llm import (
    adaptive_rules,
    anchor_simhash,
    cross_polytope,
    gumbel_pieces,
    hmm,
    pareto_mix,
    quality_gam,
    splitters,
    style_tree,
    warc,
)
from siltstone.llm.oracle import ORACLE
from siltstone.llm.queries import QUERIES
from siltstone.llm.shared import connected_components, new_path, written

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, row string, score string"


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, an empty and a very long text, ties, repeated rows, names that operators use themselves."""
    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    rows = [
        (1, None, "en", "a", 0), (2, "", None, "a", 0), (3, long, "en", None, 9), (4, "one two three", "en", "b", None),
        (5, "one two three", "en", "b", 3), (5, "one two three", "en", "b", 3), (None, "one two three", None, None, 1),
        (None, "no id\nat all", "en", "b", 1), (6, " \t\n ", "en", "a", 4), (7, "x" * 30_000, "de", "c", 5),
        (8, "Ünïcode 字 \x00 😀", "de", "c", 5), (9, "a b c d e f g h i j k l", "en", "b", 1),
    ]
    return spark.createDataFrame([(*r, "s", "r", "x") for r in rows], DOCS).repartition(3)


def words(text):
    return (text or "").encode().split()


# ---------------------------------------------------------------- registered queries


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    want = duck.execute(ORACLE[name]).df()
    order = list(got.columns)
    assert sorted(want.columns) == sorted(order)
    a, b = (x[order].sort_values(order[:2]).reset_index(drop=True).astype(object) for x in (got, want))
    assert len(a) == len(b) and ((a == b) | (a.isna() & b.isna())).all().all()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, sf_dir, tmp_path, name):
    for table in ("documents", "embeddings", "pages", "labels"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0


def test_native_operators_run_no_python(spark, sf_dir):
    for name in ("op4_adaptive_rules", "op6_pareto_mix"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian"))


# ---------------------------------------------------------------- shared


def test_components_of_random_graphs_chains_and_stars(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(200)] + [(9999, 9000 + i) for i in range(50)]
    low = {n: n for e in edges for n in e}
    for _ in range(100):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: low[n] for n in got}
    assert set(got) == {n for a, b in edges if a != b for n in (a, b)}


# ---------------------------------------------------------------- quality model


def test_quality_model_separates_held_out_labels(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # the smallest has too few labels
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_gam.train(docs, labels)
    rows = quality_gam.scored(docs, model).select("row.doc_id", "score").join(labels, "doc_id").collect()
    out = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(out) > 5
    assert sum((r["score"] >= 0.3) == r["quality"] for r in out) >= 0.9 * len(out)


def test_quality_tables_add_up_and_find_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(quality_gam.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(float)
    model = quality_gam.fit(x, y)
    assert (2, 5) in model.pairs
    assert ((model.score(x) >= 0.5) == y).mean() > 0.9
    row = x[:1]
    by_hand = model.base + sum(t[np.searchsorted(c, row[0, f], side="right")] for f, (t, c) in enumerate(zip(model.tables, model.cuts)))
    by_hand += sum(
        t[np.searchsorted(model.coarse[a], row[0, a], side="right"), np.searchsorted(model.coarse[b], row[0, b], side="right")]
        for (a, b), t in zip(model.pairs, model.pair_tables)
    )
    assert math.isclose(model.log_odds(row)[0], by_hand)


def test_quality_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    rows = quality_gam.scored(odd, quality_gam.train(odd, none)).select("row.*", F.col("score").alias("p")).collect()
    assert len(rows) == 12 and all(r["p"] == 0.5 and r["score"] == "x" for r in rows)
    labels = spark.createDataFrame([(3, 1), (4, 0), (5, 0), (5, 0), (7, 1), (9, None), (None, 1)], "doc_id bigint, quality int")
    rows = quality_gam.scored(odd, quality_gam.train(odd, labels)).collect()
    assert len(rows) == 12 and all(0 <= r["score"] <= 1 for r in rows)


# ---------------------------------------------------------------- WARC


def test_warc_round_trip_over_small_splits(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").unionAll(
        spark.createDataFrame(
            [(10**9, "u", None), (10**9 + 1, None, ""), (None, "x", "<p>a"), (10**9 + 2, "x\ny", "<p>a"),
             (10**9 + 2, "x", "<p>a"), (10**9 + 3, "m", "\x1f\x8b\x08 WARC/1.1\r\n\r\n" * 50), (10**9 + 4, "é", "z" * 300_000)],
            "page_id bigint, url string, html string",
        )
    )
    files = warc.write_archive(warc.with_revisits(pages), new_path(spark, "warc"), file_bytes=20_000)
    source = {r["page_id"]: (r["html"] or "").encode() for r in pages.collect()}
    for split in (700, 1 << 20):
        rows = warc.resolved(written(warc.read_archive(files, split_bytes=split), "records")).collect()
        assert len(rows) == pages.count() == files.agg(F.sum("records")).first()[0]
        assert all(r["digest_holds"] for r in rows)
        for r in rows:
            if r["page_id"] is not None:
                body = source[r["page_id"]]
                assert r["payload_bytes"] == len(body)
                assert r["digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode()
                assert r["payload"] is None if r["record_type"] == "revisit" else bytes(r["payload"]) == body
        kinds = {(r["page_id"], r["record_type"], r["refers_to_page"]) for r in rows if r["page_id"] is None or r["page_id"] >= 10**9}
        assert kinds >= {(10**9, "revisit", 10**9 + 1), (10**9 + 1, "response", None), (None, "revisit", 10**9 + 2), (10**9 + 2, "response", None)}


def test_warc_reads_long_headers_and_misses_none(spark):
    url = np.random.default_rng(5).bytes(2 << 20).hex()
    pages = spark.createDataFrame([(1, url, "abc"), (2, "b", "abcd")], "page_id bigint, url string, html string")
    files = warc.write_archive(warc.with_revisits(pages), new_path(spark, "warc"))
    records = written(warc.read_archive(files), "records")
    assert {r["page_id"]: r["url"] for r in warc.whole(records, files).collect()} == {1: url, 2: "b"}
    with pytest.raises(ValueError, match="1 records read of 2 written"):
        warc.whole(records.filter("page_id = 2"), files)


def test_uris_of_hadoop_are_known_to_arrow(tmp_path):
    assert [warc.arrow_uri(u) for u in ("s3a://b/k", "s3n://b/k", "s3://b/s3a:k", "file:/a/b", "file:///a", "hdfs://n/p")] == [
        "s3://b/k", "s3://b/k", "s3://b/s3a:k", "file:///a/b", "file:///a", "hdfs://n/p"
    ]
    assert warc.opened(f"file:{tmp_path}/x")[1] == f"{tmp_path}/x"


def test_warc_stores_small_payloads_each_time(spark):
    pages = spark.createDataFrame([(1, "a", "abc"), (2, "b", "abc"), (3, "c", "abcd"), (4, "d", "abcd")], "page_id bigint, url string, html string")
    rows = warc.with_revisits(pages, min_bytes=4).collect()
    assert {(r["page_id"], r["refers_to"]) for r in rows} == {(1, None), (2, None), (3, 4), (4, None)}


# ---------------------------------------------------------------- hidden Markov model


def test_forward_and_expected_counts_equal_enumeration():
    rng = np.random.default_rng(0)
    shares = hmm.Shares(100, 50, np.zeros(30), np.zeros(30))
    shares.smoothed[:20] = rng.integers(1, 9, 20)
    model = hmm.initial(shares)
    sequences = [rng.integers(0, 20, n).astype(np.int16) for n in (1, 4, 3, 4)]
    likelihood = hmm.forward(model, hmm._Packed(sequences), False)[0]
    start, move, emit = np.zeros(hmm.STATES), np.zeros((hmm.STATES,) * 2), np.zeros((30, hmm.STATES))
    for s, got in zip(sequences, likelihood):
        paths = {}
        for z in itertools.product(range(hmm.STATES), repeat=len(s)):
            p = model.start[z[0]] * np.prod([model.emit[c, k] for c, k in zip(s, z)])
            paths[z] = p * np.prod([model.move[a, b] for a, b in zip(z, z[1:])])
        total = sum(paths.values())
        assert math.isclose(got, math.log(total), rel_tol=1e-9)
        for z, p in paths.items():
            start[z[0]] += p / total
            for a, b in zip(z, z[1:]):
                move[a, b] += p / total
            for c, k in zip(s, z):
                emit[c, k] += p / total
    found = hmm.expected(model, hmm._Packed(sequences))
    assert all(np.allclose(a, b) for a, b in zip(found, (start, move, emit)))


def test_hmm_trains_on_whole_texts(spark, monkeypatch):
    rng = np.random.default_rng(6)
    shares = hmm.Shares(100, 50, np.zeros(30), np.zeros(30))
    shares.smoothed[:20] = rng.integers(1, 9, 20)
    model = hmm.initial(shares)
    texts = [rng.integers(0, 20, n).astype(np.int16) for n in (1, 511, 512, 513, 1024, 2000)]
    df = spark.createDataFrame([(hmm.packed(t),) for t in texts], "classes binary")
    got, likelihood = hmm.baum_welch_round(df, model, shares)
    assert math.isclose(likelihood, hmm.forward(model, hmm._Packed(texts), False)[0].sum(), rel_tol=1e-9)
    parts = hmm.expected(model, hmm._Packed(texts))
    monkeypatch.setattr(hmm, "PIECE", 10_000)
    whole = hmm.expected(model, hmm._Packed(texts))
    assert all(np.allclose(a, b) for a, b in zip(parts, whole))
    assert math.isclose(whole[0].sum(), len(texts)) and math.isclose(whole[1].sum(), sum(len(t) - 1 for t in texts))
    start, move = whole[0] + 0.1, whole[1] + 0.1
    assert np.allclose(got.start, start / start.sum()) and np.allclose(got.move, move / move.sum(1, keepdims=True))


def test_hmm_counts_base_and_gain(spark, sf_dir):
    rows = {r["doc_id"]: r for r in hmm.hmm_scores(documents(spark, sf_dir)).collect()}
    docs = documents(spark, sf_dir).collect()
    tokens = {d["doc_id"]: (d["text"] or "").encode().lower().split() + [b"\n"] for d in docs}
    out = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in tokens}
    counts = collections.Counter(itertools.chain.from_iterable(t for k, t in tokens.items() if not out[k]))
    n, v = sum(counts.values()), len(counts)
    for k, t in tokens.items():
        r = rows[k]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out[k], len(t), sum(w in counts for w in t), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
    held = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_hmm_token_shares_of_a_class_add_up_to_one():
    shares = hmm.Shares(0, 0, np.zeros(9), np.zeros(9))
    c = np.array([5, 3, 1, 1])
    classes = np.array([7, 7, 8, 8])
    np.add.at(shares.smoothed, classes, c + 1)
    np.add.at(shares.counts, classes, c)
    share = 10 ** shares.within(np.r_[c, 0], np.r_[classes, 8])
    assert np.allclose([share[:2].sum(), share[2:].sum()], 1)


def test_hmm_classes_grow_with_the_vocabulary(spark, sf_dir):
    assert [hmm.sizes(v) for v in (0, 1, 374_000, 10**9)] == [(0, 1), (8, 1), (4893, 612), (252_983, 31_623)]
    counts = spark.createDataFrame([(f"w{i}".encode(), 2000 - i) for i in range(1998)] + [(b"once", 1)], "word binary, c bigint")
    rows = {r["word"].decode(): r["class"] for r in hmm._with_class(counts, 40, 7).collect()}
    assert [rows[f"w{i}"] for i in range(40)] == list(range(40)) and rows["once"] == 47
    assert {rows[f"w{i}"] for i in range(40, 1998)} == set(range(40, 47))
    big = np.arange(0, 400_000, 7, dtype=np.int32)
    assert (hmm.unpacked(hmm.packed(big)) == big).all()


def test_hmm_odd_rows(spark, odd):
    rows = hmm.hmm_scores(odd).collect()
    assert len(rows) == 12 and all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert sorted(r["n_tokens"] for r in rows)[:3] == [1, 1, 1]


# ---------------------------------------------------------------- rules


def test_rules_odd_rows(spark, odd):
    rows = adaptive_rules.adaptive_rules(odd).select("row.*", "n_words", "n_repeat_words", "base_failed", "kept").collect()
    assert len(rows) == 12 and not any(r["kept"] for r in rows if r["base_failed"])
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["n_words"] == by_id[2]["n_words"] == by_id[6]["n_words"] == 0
    assert by_id[3]["n_repeat_words"] == 60_000 and by_id[9]["kept"]
    assert adaptive_rules.kept_documents(odd).columns == odd.columns
    assert adaptive_rules.kept_documents(odd).count() == sum(r["kept"] for r in rows)


def test_rules_overlapping_windows(spark):
    texts = ["a a a a a a", "a b c d e a b c d e", "a b c d e x a b c d e f", "a b c d e", "p q\n\np q\n \np q"]
    rows = adaptive_rules.measure(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    want = []
    for t in texts:
        w = t.split()
        c = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        want.append(len({j for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}))
    assert [r["n_repeat_words"] for r in rows] == want
    assert rows[4]["n_dup_lines"] == 2


def test_rules_fences_follow_the_group(spark):
    text = lambda i, mark: " ".join(f"v{i}x{j}{mark}" for j in range(40))
    rows = [(i, text(i, "#" if i % 3 else ""), "en", "plain") for i in range(200)]
    rows += [(1000 + i, text(i, "#" * 40), "en", "plain") for i in range(3)]
    rows += [(2000 + i, text(i, "#" * (38 + i % 5)), "en", "code") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    kept = {r["doc_id"] for r in adaptive_rules.kept_documents(docs).collect()}
    assert not kept & {1000, 1001, 1002}
    assert set(range(200)) <= kept and set(range(2000, 2200)) <= kept


# ---------------------------------------------------------------- embeddings


def test_cross_polytope_recall_and_exactness(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    noise = rng.normal(size=base[:900].shape)
    noise -= (noise * base[:900]).sum(1, keepdims=True) * base[:900]
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    cosine = rng.uniform(0.88, 0.97, 900)[:, None]
    x = np.concatenate([base, cosine * base[:900] + np.sqrt(1 - cosine**2) * noise, base[:5], np.tile(base[7], (40, 1)) + rng.normal(0, 0.01, (40, 64))])
    x = x.astype(np.float32).astype(np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    rows = {r["vec_id"]: r for r in cross_polytope.near_duplicates(df).collect()}
    got = np.array([rows[i]["n_links"] for i in range(len(x))])
    assert (got <= near.sum(1)).all()
    assert got.sum() >= 0.95 * near.sum()  # cosines near the threshold are the hardest
    assert all(rows[i]["component_id"] <= i and rows[i]["kept"] == (rows[i]["component_id"] == i) for i in rows)


def test_cross_polytope_odd_rows(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.01]), (3, [1.0, 2.0]), (3, [1.0, 2.0]), (4, None), (5, [0.0, 0.0]), (6, [1.0, float("nan")]),
            (7, [1.0, float("inf")]), (8, [1.0, None]), (9, []), (None, [1.0, 2.0]), (10, [1.0, 2.0, 0.0])]
    df = spark.createDataFrame([(*r, 0, True) for r in rows], "vec_id bigint, embedding array<float>, label int, kept boolean")
    got = collections.defaultdict(list)
    for r in cross_polytope.near_duplicates(df).collect():
        got[r["vec_id"]].append((r["n_links"], r["component_id"], r["kept"]))
    assert got[1] == [(3, 1, True)] and got[2] == [(3, 1, False)] and got[3] == [(3, 1, False)] * 2
    assert all(got[k] == [(0, k, True)] for k in (4, 5, 6, 7, 8, 9, 10))
    assert got[None] == [(0, None, False)]


def test_cross_polytope_blocks_lose_no_link(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=8) + rng.normal(0, 0.05, (60, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    monkeypatch.setattr(cross_polytope, "BLOCK", 7)
    rows = cross_polytope.near_duplicates(df).collect()
    unit = x.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.9).sum(1) - 1
    assert all(r["n_links"] == near[r["vec_id"]] for r in rows)


# ---------------------------------------------------------------- mixing


def water(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(3 * sizes[s] for s in capped)) / max(1, sum(weight[s] for s in free))
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in capped else weight[s] * level for s in names}
        capped |= over


def test_mix_targets_taken_and_reruns(spark, sf_dir):
    docs = documents(spark, sf_dir)
    rows = QUERIES["op6_pareto_mix"](spark, sf_dir).collect()
    source = {d["doc_id"]: d["source"] for d in docs.collect()}
    size = {d["doc_id"]: len(words(d["text"])) for d in docs.collect()}
    sizes = collections.Counter()
    for k, s in source.items():
        sizes[s] += size[k]
    targets = water(sizes)
    taken = collections.Counter()
    for r in rows:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[source[r["doc_id"]]]
        assert math.isclose(r["target"], targets[source[r["doc_id"]]], rel_tol=1e-9) and 0 <= r["taken"] <= 3 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= max(size[k] for k in source if source[k] == s)
    again = QUERIES["op6_pareto_mix"](spark, sf_dir).collect()
    assert {r["doc_id"]: r["taken"] for r in rows} == {r["doc_id"]: r["taken"] for r in again}


def test_mix_caps_and_deep_search(spark, monkeypatch):
    monkeypatch.setattr(pareto_mix, "SORTED", 2)
    rows = [(i, "w " * 3, "big") for i in range(2000)] + [(9000 + i, "w", "tiny") for i in range(5)] + [(7777, "same text", "same")] * 900
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    got = pareto_mix.pareto_mix(docs).select("row.*", "size", "copies", "target", "source_size").collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
    assert all(r["copies"] == 3 for r in by["tiny"])
    for rs in by.values():
        assert abs(sum(r["copies"] * r["size"] for r in rs) - rs[0]["target"]) <= max(r["size"] for r in rs)
    assert pareto_mix.mixed(docs).count() == sum(r["copies"] for r in got)


def test_mix_odd_rows(spark, odd):
    rows = pareto_mix.pareto_mix(odd).select("row.*", F.col("copies").alias("n"), "target").collect()
    assert len(rows) == 12 and all(0 <= r["n"] <= 3 for r in rows)
    assert all(r["n"] == 0 for r in rows if not words(r["text"]))
    assert pareto_mix.mixed(odd).columns == odd.columns


# ---------------------------------------------------------------- extraction



def test_style_tree_drops_furniture_by_role():
    page = """<!DOCTYPE html><html><head><title>x</title><script>var a="<p>no</p>";</script></head><body class="home nav-open">
    <header><h1>Site</h1></header><nav><ul><li>a</ul></nav><div class="cookie-notice">We use cookies</div><div id="sidebar">side</div>
    <article><header><h1>Title &amp; more</h1></header><p>One <b>bold</b>  two&nbsp;x<br>three<p>Second<ul><li>i1<li>i2</ul>
    <div class="ad">buy</div><section class="comments"><p>nice</p></section><form><label>Name</label></form>
    <p title="a>b">a &lt; b &#233; 5 < 6</article><footer>f</footer><!-- no --></body></html>"""
    texts = [b["text"] for b in style_tree.parse(page)[0]]
    assert texts == ["Title & more", "One bold two x three", "Second", "i1", "i2", "a < b é 5 < 6"]


def test_style_tree_learns_unmarked_furniture(spark):
    rng = np.random.default_rng(1)
    prose = lambda: " ".join(f"{w:x}" for w in rng.integers(0, 1 << 30, 12))
    pages, want = [], {}
    for i in range(40):
        body = [prose() for _ in range(4)]
        want[i] = "\n".join(body)
        inner = "".join(f"<p>{b}</p>" for b in body)
        pages.append((i, f"http://h.example/{i}", f"<body><div><div>Our shop</div></div><div>{inner}</div><div>All rights reserved</div>"))
    copies = [(100 + i, "http://h.example/c", pages[0][2]) for i in range(60)]  # copies do not make their text furniture
    few = [(200 + i, "http://few.example/", "<body><p>same</p>") for i in range(3)]
    df = spark.createDataFrame([*pages, *copies, *few], "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in style_tree.main_text(df).select("row.page_id", "text").collect()}
    assert {i: got[i] for i in want} == want
    assert got[100] == want[0] and got[200] == "same"


def extracted(spark, pages):
    df = spark.createDataFrame([(i, f"http://h.example/{i}", p) for i, p in pages.items()], "page_id bigint, url string, html string")
    return {r["page_id"]: r["text"] for r in style_tree.main_text(df).select("row.page_id", "text").collect()}


def test_style_tree_decides_inside_and_beside_articles(spark):
    rng = np.random.default_rng(2)
    prose = lambda: " ".join(f"{w:x}" for w in rng.integers(0, 1 << 30, 12))
    pages, want = {}, {}
    for i in range(40):
        body, beside = [prose() for _ in range(4)] + ["A passage of many"] * (i % 2), f"Written by {prose()}"
        want[i] = "\n".join([beside, *body])
        inner = "".join(f"<p>{b}</p>" for b in body)
        pages[i] = f"<body><div>Our shop</div><div>{beside}</div><main><div>Read our rules</div>{inner}</main><div>All rights</div>"
    assert extracted(spark, pages) == want


def test_style_tree_teasers_and_copies(spark):
    rng = np.random.default_rng(3)
    prose = lambda: " ".join(f"{w:x}" for w in rng.integers(0, 1 << 30, 12))
    stories = {i: [prose() for _ in range(4)] for i in range(40)}
    cards = "<article>Read next: one</article><article>Read next: two</article>"
    pages = {i: f"<body><div>{''.join(f'<p>{b}</p>' for b in body)}</div>{cards}" for i, body in stories.items()}
    assert extracted(spark, pages) == {i: "\n".join(body) for i, body in stories.items()}
    copies = {i: f"<body><article><p>{'</p><p>'.join(stories[0])}</p><p>copy {i}</p></article>" for i in range(40)}
    assert extracted(spark, copies) == {i: "\n".join([*stories[0], f"copy {i}"]) for i in range(40)}


@pytest.mark.parametrize("wrapper", ["class='content with-sidebar'", "class='no-sidebar'", "class='hasNav'", "id=top", "class='side-by-side'", "class=sidebar"])
def test_style_tree_names_of_wrappers(wrapper):
    of = lambda page: [b["text"] for b in style_tree.parse(page)[0]]
    assert of(f"<body><div {wrapper}><p>one</p><article>two</article></div>") == ["two"]
    assert of(f"<body><div {wrapper}><p>one one</p><p>two two</p></div><p>x") == ["one one", "two two", "x"]


def test_style_tree_names_and_links_are_priors(spark):
    of = lambda page: [b["text"] for b in style_tree.parse(page)[0]]
    names = ("notice", "alert", "share", "search", "related", "widget", "copyright")
    assert of(f"<article><p>some longer text of the page</p>{''.join(f'<p class={n}>{n}</p>' for n in names)}<p class=ad>buy</p></article>") == [
        "some longer text of the page", *names
    ]
    assert of("<body><div class=ad>longer than the article</div><article>text</article>") == ["text"]
    assert of("<body><p><a href=x>all of the page</a></p>") == ["all of the page"]
    rng = np.random.default_rng(4)
    prose = lambda: " ".join(f"{w:x}" for w in rng.integers(0, 1 << 30, 12))
    stories = {i: [prose() for _ in range(4)] for i in range(40)}
    pages = {
        i: f"<body><p>{a}</p><p>{b}</p><p class=notice>{c}</p><p><a href=x>{d}</a></p><p class=notice>same</p><p><a href=y>same too</a></p>"
        for i, (a, b, c, d) in stories.items()
    }
    assert extracted(spark, pages) == {i: "\n".join(s) for i, s in stories.items()}


def test_style_tree_collects_no_rows_of_a_host(spark, monkeypatch):
    def refused(*_):
        raise AssertionError("one row for all styles of a node")

    monkeypatch.setattr(style_tree.F, "collect_list", refused)
    pages = {i: f"<body><div>{'<p>x</p>' * (1 + i % 3)}</div><p>{i}</p>" for i in range(40)}
    assert extracted(spark, pages) == {i: str(i) for i in pages}


def test_style_tree_odd_pages(spark):
    odd = [(1, None, None), (2, "x", ""), (3, "http://a/", "just text"), (4, "http://a/", "<p>cut <a href='x"), (5, "http://a/", "<p>" * 3000 + "deep"),
           (6, "http://a/", "<script>never closed <p>x"), (None, "http://a/", "<p>&amp &a &#x41;</p>")]
    df = spark.createDataFrame([(*r, "t", "h") for r in odd], "page_id bigint, url string, html string, text string, host string")
    got = {r["page_id"]: r["new"] for r in style_tree.main_text(df).select("row.page_id", F.col("text").alias("new")).collect()}
    assert got == {1: "", 2: "", 3: "just text", 4: "cut", 5: "deep", 6: "", None: "& &a A"}


# ---------------------------------------------------------------- sharding


def test_shards_are_even_and_gapless(spark, sf_dir):
    rows = QUERIES["op8_splitter_shards"](spark, sf_dir).collect()
    docs = {d["doc_id"]: (d["text"] or "").encode() for d in documents(spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    total, largest = sum(len(t) + 16 for t in docs.values()), max(len(t) + 16 for t in docs.values())
    by = collections.defaultdict(list)
    for r in rows:
        assert r["size"] == len(docs[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(docs[r["doc_id"]])
        by[r["shard"]].append(r)
    for rs in by.values():
        assert sorted(r["slot"] for r in rs) == list(range(len(rs)))
        assert abs(sum(r["size"] for r in rs) - total / 40) <= largest


def test_shards_of_a_hot_key_and_odd_rows(spark, odd):
    same = spark.range(20_000).select(F.lit(5).alias("k"), F.lit(10).alias("n"))
    rows = splitters.splitter_shards(same, F.col("n"), [F.col("k")], 8).groupBy("shard").count().collect()
    assert [r["count"] for r in rows] == [2500] * 8
    got = splitters.splitter_shards(odd, F.octet_length("text"), [F.xxhash64("text"), F.col("doc_id")], 4)
    assert got.count() == 12 and got.select("row.*").columns == odd.columns


def test_shards_do_not_depend_on_the_ranges(spark, monkeypatch):
    """Many small ranges give the shards and slots of few large ones; records without size are split as well."""
    docs = spark.range(6_000).select((F.col("id") % 50).alias("k"), "id", F.when(F.col("id") % 3 > 0, F.col("id") % 90).alias("n"))
    order = lambda: sorted(
        (r["row"]["id"], r["shard"], r["slot"])
        for r in splitters.splitter_shards(docs, F.col("n"), [F.col("k"), F.col("id")], 3).collect()
    )
    few = order()
    monkeypatch.setattr(splitters, "RANGE_LOAD", 2_000)
    ranges = []
    counted = splitters._counted
    monkeypatch.setattr(splitters, "_counted", lambda df: ranges.append(counted(df)) or ranges[-1])
    assert order() == few
    assert len(ranges[-1]) > 200 and max(r["load"] - r["largest"] for r in ranges[-1]) <= 4_000
    ranges.clear()
    nothing = splitters.splitter_shards(docs, F.lit(0), [F.col("k")], 3)
    assert nothing.count() == 6_000 and max(r["n"] for r in ranges[-1]) <= 100


# ---------------------------------------------------------------- SimHash


def test_fingerprints_by_hand(spark, odd):
    def slow(text):
        w = [x.decode() for x in (text or "").encode().lower().split()]
        grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    texts = [None, "", "One", "one TWO", "A b c D", "É é x y z", "r r r r r r r", " \x0b a\x1fb c d e"]
    assert [anchor_simhash.fingerprint(t) for t in texts] == [slow(t) for t in texts]
    one = spark.createDataFrame([("a b c",)], "t string").select(F.xxhash64("t")).first()[0]
    assert anchor_simhash.fingerprint("A b C") == one % (1 << 64)


def test_anchors_cover_all_near_pairs():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 1 << 63, 300, dtype=np.int64)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(64, rng.integers(0, 3), replace=False):
            y[i] ^= np.int64(np.uint64(1 << int(b)).astype(np.int64))
    homes = anchor_simhash.home_anchors(x)
    row, anchor = anchor_simhash.near_anchors(y)
    near = set(zip(row.tolist(), anchor.tolist()))
    assert all((i, h) in near for i, h in enumerate(homes.tolist()))
    low = (x.view(np.uint64) & np.uint64((1 << 46) - 1)).astype(np.int64)
    assert np.bitwise_count(low ^ homes).max() <= anchor_simhash.RADIUS


def test_simhash_components_equal_brute_force(spark, sf_dir):
    rows = anchor_simhash.simhash_components(documents(spark, sf_dir)).collect()
    low = {r["doc_id"]: r["doc_id"] for r in rows}
    marks = {r["doc_id"]: r["mark"] % (1 << 64) for r in rows}
    pairs = [(a, b) for a, b in itertools.combinations(marks, 2) if (marks[a] ^ marks[b]).bit_count() <= 2]
    for _ in range(len(pairs) and 20):
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
    assert {r["doc_id"]: r["component_id"] for r in rows} == low


def test_simhash_odd_rows(spark, odd):
    rows = anchor_simhash.simhash_components(odd).collect()
    assert len(rows) == 12
    empty = [r for r in rows if r["doc_id"] in (1, 2, 6)]
    assert all(r["mark"] == 0 and r["component_id"] == 1 for r in empty)
    kept = anchor_simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted(r["doc_id"] or 0 for r in kept.collect())
    assert ids == [0, 1, 3, 4, 7, 8, 9]  # 0: the text that only a row without an id has


# ---------------------------------------------------------------- pieces


def every_segmentation(pieces, text):
    p = pieces.processor
    known = {p.id_to_piece(i): i for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i))}
    chars = gumbel_pieces.marked(text)

    def rest(i):
        if i == len(chars):
            yield (), 0.0
            return
        if chars[i] not in known:
            own = tuple(int(pieces.byte[b]) for b in chars[i].encode())
            for ids, w in rest(i + 1):
                yield own + ids, w + len(own) * pieces.byte_weight
        for j in range(i + 1, len(chars) + 1):
            if chars[i:j] in known:
                for ids, w in rest(j):
                    yield (known[chars[i:j]], *ids), w + pieces.weight[known[chars[i:j]]]

    found = dict(rest(0))
    total = np.logaddexp.reduce(list(found.values()))
    return {ids: w - total for ids, w in found.items()}


@pytest.mark.parametrize("text", ["the a", "héllo", "a\x01b", "x"])
def test_samples_follow_the_exact_distribution(text):
    pieces = gumbel_pieces.pieces_of(gumbel_pieces.model_bytes())
    every, n = every_segmentation(pieces, text), 20_000
    ranks = gumbel_pieces.segmentations([text] * n, np.arange(n) * 7919 + 5, pieces, 3)
    drawn, weights = [[None] * n for _ in range(3)], np.zeros(n)
    for k, (which, ids, first, count, log_prob, _, inclusion) in enumerate(ranks):
        weights[which] += np.exp(log_prob) / inclusion
        for i, a, c, lp in zip(which, first, count, log_prob):
            drawn[k][i] = tuple(ids[a : a + c].tolist())
            assert math.isclose(every[drawn[k][i]], lp, abs_tol=1e-9)
    assert all(len({x for x in d if x}) == sum(x is not None for x in d) == min(3, len(every)) for d in zip(*drawn))
    p = {s: math.exp(w) for s, w in every.items()}
    second = {s: sum(p[f] * p[s] / (1 - p[f]) for f in p if f != s) for s in p}
    for k, want in ((0, p), (1, second)):
        seen = collections.Counter(drawn[k])
        assert max(abs(seen[s] / n - want[s]) for s in want) < 0.02
    assert math.isclose(weights.mean(), 1, abs_tol=0.02)  # inclusion scores weigh samples to the whole


def test_pieces_round_trip_and_odd_rows(spark, odd):
    got = gumbel_pieces.sampled(odd).select("row.*", *gumbel_pieces.COLUMNS)
    rows = got.collect()
    assert all(r["reads_back"] for r in rows)
    ones = [r for r in rows if r["sample"] == 1]
    assert len(ones) == 12 and sum(r["n_pieces"] == 0 and r["inclusion"] == 1 for r in ones) == 2
    model = gumbel_pieces.pieces_of(gumbel_pieces.model_bytes()).processor
    texts = {tuple(r["row"]["pieces"]): r["text"] for r in gumbel_pieces.decode(got.select("pieces")).collect()}
    assert all(model.decode(list(k)) == v for k, v in texts.items())
    again = gumbel_pieces.sampled(odd.repartition(5)).select("row.doc_id", "sample", "pieces").collect()
    key = lambda r: (r["doc_id"] or 0, r["sample"], r["pieces"])
    assert sorted(map(key, again)) == sorted(map(key, rows))


# ---------------------------------------------------------------- the pipeline


def test_pipeline_stages_take_effect(spark, sf_dir):
    docs, names = documents(spark, sf_dir), documents(spark, sf_dir).columns
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    before = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
        assert docs.columns == names
        after = collections.Counter(r["doc_id"] for r in docs.collect())
        assert set(after) <= set(before) and after
        if name == "quality classifier":
            assert sum(quality.get(k) == 1 for k in before) == sum(quality.get(k) == 1 for k in after)
            assert sum(quality.get(k) == 0 for k in after) <= 0.5 * sum(quality.get(k) == 0 for k in before)
        if name == "SimHash near-dedup":
            marks = [anchor_simhash.fingerprint(before[k]["text"]) for k in after]
            assert all((a ^ b).bit_count() > 2 for a, b in itertools.combinations(marks, 2))
        before = {k: before[k] for k in after}
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == set(before) and all(r["reads_back"] for r in rows)
    assert corpus_pipeline.run(spark, sf_dir).count() == len(rows)


def test_pipeline_stages_on_odd_rows(spark, odd, tmp_path):
    spark.createDataFrame([(3, 1), (4, 0)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, str(tmp_path)).columns == odd.columns
        assert stage(spark, odd.limit(0), str(tmp_path)).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, odd, str(tmp_path)).count() > 0
