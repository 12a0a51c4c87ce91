"""The style tree against a second version of its own, on article text that must stay, and on deep pages."""

import math
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import style_tree


def prose(rng, n=12):
    return " ".join(f"{w:x}" for w in rng.integers(0, 1 << 30, n))


def frame(spark, pages):
    rows = [(i, f"http://h.example/{i}", p) for i, p in pages.items()]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)


def extracted(spark, pages):
    return {r["page_id"]: r["text"] for r in style_tree.main_text(frame(spark, pages)).select("row.page_id", "text").collect()}


def brute_importance(pages):
    """{key: importance below 1} of one host, by walking up from every node of every page."""
    distinct = {(tuple(b["key"] for b in blocks), tuple(sorted(n["key"] for n in nodes))): (blocks, nodes) for blocks, nodes in pages}
    # Pages differ by the keys of their blocks and the styles of their nodes.
    distinct = {(k, tuple(sorted((n["key"], n["style"]) for n in v[1]))): v for k, v in distinct.items()}
    total = len(distinct)
    up, styles, kinds, times = {}, defaultdict(Counter), defaultdict(dict), Counter()
    for blocks, nodes in distinct.values():
        for n in nodes:
            up[n["key"]] = n["up"]
            styles[n["key"]][n["style"]] += 1
            kinds[n["key"]][n["style"]] = n["kinds"]
        for text in {(b["node"], b["key"]) for b in blocks}:
            times[text] += 1
    share = lambda n: math.log(n) / math.log(max(total, 2))
    out = {key: 1 - share(n) for (_, key), n in times.items() if n > 1}
    branch = {}
    for node in up:
        under = []
        for (at, _), n in times.items():
            above = at
            while above is not None and above != node:
                above = up[above]
            if above == node:
                under.append((n, 1 - share(n)))
        looks = 1 - sum(c * math.log(c) for c in styles[node].values()) / sum(styles[node].values()) / math.log(max(total, 2))
        fade = style_tree.FADE ** (sum(kinds[node].values()) / len(kinds[node]))
        every = sum(n for n, _ in under)
        branch[node] = (1 - fade) * looks + fade * sum(n * v for n, v in under) / every if every else 1.0
    for node in up:
        least, above = 1.0, node
        while above is not None:
            least, above = min(least, branch[above]), up[above]
        out[node] = least
    return {k: v for k, v in out.items() if v < 1 - 1e-12}


def test_importance_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    pages = {}
    for i in range(30):
        menu = "".join(f"<li>Topic {k}" for k in range(1 + i % 3))
        note = "<section><div><p>Shared note</p></div></section>" if i % 4 == 0 else ""
        story = "".join(f"<p>{prose(rng, 5)}" for _ in range(int(rng.integers(1, 4))))
        pages[i] = f"<body><div><ul>{menu}</ul></div><div class=s{i % 2}><div>{story}</div>{note}</div><div>Imprint</div>"
    pages |= {100 + i: pages[3] for i in range(5)}  # copies count once
    parsed = style_tree.written(
        frame(spark, pages).select(F.lit("h").alias("host"), F.col("html").alias("page")).mapInArrow(
            style_tree._parsed, f"host string, blocks {style_tree._BLOCKS}, nodes {style_tree._NODES}"
        ),
        "parsed",
    )
    got = {r["low_key"]: r["importance"] for r in style_tree.low_branches(parsed).collect()}
    want = brute_importance([style_tree.tree(p) for p in pages.values()])
    assert {k for k, v in got.items() if v < 1 - 1e-12} == set(want) and len(want) > 15
    assert all(abs(got[k] - v) < 1e-9 for k, v in want.items())


def test_article_text_stays(spark):
    """Passages that few pages share, and passages in elements with names of furniture."""
    rng = np.random.default_rng(6)
    for pages_of_host, sharing in ((400, 12), (40, 24), (40, 10), (40, 9)):
        pages, want = {}, {}
        for i in range(pages_of_host):
            body = [prose(rng, 6) for _ in range(3)]
            shared = "<div class=abstract>An abstract that some pages share</div>" if i < sharing else ""
            pages[i] = f"<body><article>{shared}{''.join(f'<p>{b}' for b in body)}</article>"
            want[i] = "\n".join((["An abstract that some pages share"] if shared else []) + body)
        assert extracted(spark, pages) == want
    pages, want = {}, {}
    for i in range(40):
        a, b, c, d = (prose(rng) for _ in range(4))
        pages[i] = f"<body><article><p>{a}</p><div class=menu>{b}</div><div class='ad-free'>{c}</div><p id=sidebar>{d}</p></article>"
        want[i] = "\n".join((a, b, c, d))
    assert extracted(spark, pages) == want


def test_furniture_of_an_article_goes(spark):
    """The same names on text that all pages share; adverts and comments whatever their text."""
    rng = np.random.default_rng(7)
    pages, want = {}, {}
    for i in range(40):
        a, b = prose(rng), prose(rng)
        extra = f"<div class=ad>{prose(rng)}</div><section class=comments><p>{prose(rng)}</p></section>"
        pages[i] = f"<body><article><p>{a}</p><div class=menu>Home and more</div><p>{b}</p><div class=newsletter>Sign up now</div>{extra}</article>"
        want[i] = f"{a}\n{b}"
    assert extracted(spark, pages) == want


def test_the_tree_decides_on_pages_without_any_mark(spark):
    """No role, no class name: on all 60 pages the tree alone tells furniture from text."""
    rng = np.random.default_rng(8)
    pages, want = {}, {}
    for i in range(60):
        body = [prose(rng) for _ in range(3)]
        pages[i] = f"<body><div><p>Our shop</p><p>Contact us</p></div><div>{''.join(f'<p>{b}</p>' for b in body)}</div><div>All rights reserved</div>"
        want[i] = "\n".join(body)
    assert extracted(spark, pages) == want
    by_roles = {i: "\n".join(b["text"] for b in style_tree.parse(p)[0]) for i, p in pages.items()}
    assert all(by_roles[i] != want[i] for i in pages)


def test_deep_pages_take_memory_by_their_size():
    code = """
import resource, sys
from siltstone.llm import style_tree
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for page in ("<div>" * 100_000 + "deep", "<div class=menu>x" * 100_000, "<center><p>a" * 50_000, "<div>" * 50_000 + "</b></i></section>" * 50_000):
    blocks, nodes = style_tree.tree(page)
    assert blocks or "b" in page
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=style_tree.__file__.split("/siltstone/")[0])
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 200


def test_deep_pages_go_through(spark):
    deep = "<div>" * 3000
    pages = {i: f"<body>{deep}text {i}" for i in range(12)}
    assert extracted(spark, pages) == {i: f"text {i}" for i in pages}


@pytest.mark.parametrize(("names", "factor"), [
    ("ad-free", 1.0), ("adFree", 1.0), ("no-menu", 1.0), ("menu", style_tree.NAMED), ("ad", style_tree.FOREIGN),
    ("reader-comments", style_tree.FOREIGN), ("notice", style_tree.PERHAPS), ("story", 1.0),
])
def test_names(names, factor):
    assert style_tree._named("div", {"class": names}, True) == factor
