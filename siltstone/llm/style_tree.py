"""Main text of web pages by site style trees.

The pages of a host are merged into one tree: nodes are element paths, each with the
styles it was seen with (the sequence of its child elements) and the texts found
below it. Two entropies say how important a node is, both as shares of log M, M being the
host's different pages. Presentation: a node that looks the same on all pages has none over
its styles. Content: a text found on n pages has importance 1 - log n / log M, so a text on
all pages has none, whatever the number of pages that have its element. A branch's
importance blends its own presentation with the mean importance of the texts below it.
A block's importance is the least of its text's and its branches'; blocks whose weight
times importance is below LEAST are removed from each page.

The weight comes from the roles that HTML states: elements that never hold content
(scripts, forms, menus) have weight 0, as have landmarks. Class names of page furniture
and link text lower a weight, but not that of an element that holds an article or main
element or at least half of the page's text. In an article importance can outweigh such a
name: a passage that few pages share stays in an element named menu. The exceptions are names of
adverts and reader comments, whose texts differ from page to page as an article's do. Inside an article or main element blocks weigh MAIN, so that a passage stays
and only a text on nearly all pages goes. Where such elements hold at least half of a
page's text, what lies outside weighs BESIDE; if most of them would go there, the pages
are copies, and they stay. Hosts with fewer than MIN_PAGES different pages have no statistics:
their blocks have the importance UNKNOWN, so roles alone decide.

Pages are parsed once, in tasks; the trees are merged by aggregates over (host, node). A node
knows its parent only: sums over branches and the least importance on the way to the root
double their reach with each round of joins, so neither a page's size in memory nor the
number of rounds grows with the product of depth and size.
Equal pages of a host count once, so copies do not make a text look like furniture.

Defined results: a null or empty page has the text ''; a null url, or one without a
host, belongs to a host of its own; repeated rows are extracted row by row; an empty
table gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import Written, written

MIN_PAGES = 10
LEAST = 0.1
#: How fast a branch's own presentation loses to what lies below it, per kind of child.
FADE = 0.9
#: Weights of blocks in article or main elements, and of those beside them.
MAIN, BESIDE = 5.0, 0.5
#: Factors of blocks in elements named as adverts or comments, as other furniture, or perhaps as such, and of
#: those that are mostly links. In an article an importance of LEAST / (MAIN * NAMED) outweighs NAMED.
FOREIGN, NAMED, PERHAPS, LINKED = 0.01, 0.05, 0.3, 0.3
#: Importance on hosts without statistics: weights of LEAST / UNKNOWN and more stay.
UNKNOWN = 0.15

# Element and class names.
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "noembed", "xmp"}
_NEVER = _RAW | {
    "head", "select", "button", "option", "datalist", "svg", "math", "canvas", "audio", "video", "object", "embed", "map",
    "nav", "footer", "aside", "menu", "dialog", "form", "fieldset", "label", "input", "applet",
}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
    "u", "var", "wbr", "br", "img", "nobr", "label", "input",
}
_MAIN = {"article", "main"}
#: An opening tag ends these, if open.
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "optgroup": {"option", "optgroup"}, "body": {"head"},
}
#: ... but not beyond the nearest of these.
_HOLDS = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "blockquote", "td", "th", "nav", "aside"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form", "toolbar"}
#: Adverts and reader comments.
_FOREIGN = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo",
    "promotion", "comment", "comments", "reply", "replies", "respond", "disqus",
}
_FURNITURE = {
    "cookie", "cookies", "consent", "gdpr", "popup", "modal", "newsletter", "subscribe", "subscription", "signup", "nav",
    "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "masthead", "topbar", "footer", "sidebar", "login",
    "pagination", "pager",
}
#: Words that content may be named with as well.
_PERHAPS = {
    "banner", "notice", "notification", "alert", "overlay", "copyright", "widget", "related", "recommended", "share",
    "sharing", "social", "search", "toolbar", "disclaimer",
}
_OUTSIDE_PERHAPS = _PERHAPS | {"header", "side", "top", "bottom", "legal"}
#: A word after one of these says what an element has, not what it is.
_WITHOUT = {"with", "without", "has", "have", "no", "not", "non"}
#: ... as does one before these.
_FREE = {"free", "less", "off"}
#: On elements that hold the page or the article, only these class names count.
_FRAME = {"html", "body", "main", "article"}
_FRAME_FURNITURE = {"ad", "ads", "advert", "advertisement", "sponsored", "promo", "comment", "comments", "reply", "replies", "related"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*)(>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


#: The key of a page as a whole.
ROOT = _hash("")


class _Node:
    __slots__ = ("tag", "up", "key", "weight", "main", "children", "form", "named", "holds", "size", "factor")

    def __init__(self, tag: str, up: _Node | None, label: str, weight: int, main: bool, form: bool, named: float = 1.0):
        self.tag, self.up, self.weight, self.main, self.form, self.named = tag, up, weight, main, form, named
        self.key = _hash(f"{up.key}/{label}") if up else ROOT
        self.children: list[str] = []
        self.holds, self.size = False, 0  # whether an article or main element with text lies in it; length of its texts
        self.factor = 1.0  # of its name and those around it


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)}


def _weightless(tag: str, at: dict[str, str], main: bool) -> bool:
    """Whether the element is page furniture by its name or role."""
    if tag in _NEVER or tag == "header" and not main:
        return True
    if "hidden" in at or at.get("aria-hidden") == "true" or "display:none" in at.get("style", "").replace(" ", ""):
        return True
    return at.get("role", "").lower() in _ROLES


def _named(tag: str, at: dict[str, str], main: bool) -> float:
    """The factor of the element's class and id names."""
    names = set()
    for name in f"{at.get('class', '')} {at.get('id', '')}".split():
        words = [n.lower() for n in _NAMES.findall(name)]
        around = zip(["", *words], words, [*words[1:], ""], strict=False)
        names |= {w for before, w, after in around if before not in _WITHOUT and after not in _FREE}
    if tag in _FRAME:
        return FOREIGN if names & _FRAME_FURNITURE else 1.0
    if names & _FOREIGN:
        return FOREIGN
    return NAMED if names & _FURNITURE else PERHAPS if names & (_PERHAPS if main else _OUTSIDE_PERHAPS) else 1.0


def parse(page: str | None) -> tuple[list[dict], list[dict]]:
    """(blocks, nodes) of one page, where roles alone decide."""
    blocks, styles = tree(page)
    return [b for b in blocks if b["weight"] * UNKNOWN >= LEAST], styles


def tree(page: str | None) -> tuple[list[dict], list[dict]]:
    """(blocks, nodes) of one page, without weightless branches.

    A block is a run of text without a block-level boundary: text, its key and that of its node,
    whether it lies in an article or main element, and its weight. A node is (key, key of the
    element around it, style). What is kept grows with the page, not with its depth."""
    source = page or ""
    stack = [_Node("", None, "", 1, False, False)]
    blocks: list[dict] = []
    nodes: list[_Node] = [stack[0]]
    open_tags: Counter[str] = Counter()
    run: list[str] = []
    linked = size = 0
    links = 0

    def flush() -> None:
        nonlocal linked, size
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            top = stack[-1]
            if text and top.weight:
                blocks.append({
                    "text": text, "key": _hash(f"{top.key}\0{text}"), "at": top, "main": top.main, "form": top.form,
                    "links": 2 * linked > size,
                })
                top.size += len(text)
            run.clear()
        linked = size = 0

    def close(n: int) -> None:
        flush()
        open_tags.subtract(node.tag for node in stack[n:])
        del stack[n:]

    place = 0
    for found in _TOKEN.finditer(source):
        if found.start() < place:
            continue
        if found.start() > place:
            piece = source[place : found.start()]
            run.append(piece)
            size += len(piece)
            linked += len(piece) if links else 0
        place = found.end()
        if found[2] is None:
            continue
        tag, closing = found[2].lower(), found[1] == "/"
        if found[4] != ">":  # the page is cut off inside a tag
            break
        if tag in _INLINE:
            links = max(0, links + (-1 if closing else 1)) if tag == "a" else links
            if tag == "br" or tag == "img":
                run.append(" ")
            if tag not in _NEVER:
                continue
        if closing:
            if open_tags[tag] > 0:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            elif tag == "p":
                flush()
            continue
        flush()
        links = 0
        if tag in _VOID:
            continue
        ends = _ENDS.get(tag, set()) | ({"p"} if tag not in _INLINE else set())
        for i in range(len(stack) - 1, 0, -1):
            if not any(open_tags[t] > 0 for t in ends):
                break
            if stack[i].tag in ends:
                close(i)
            elif stack[i].tag in _HOLDS:
                break
        up = stack[-1]
        at = _attributes(found[3]) if found[3] else {}
        main = up.main or tag in _MAIN
        form = up.form or tag == "form"
        weight = up.weight and not (tag != "form" and _weightless(tag, at, up.main))
        label = f"{tag}.{at.get('class', '')}#{re.sub(r'[0-9]+', '0', at.get('id', ''))}"
        node = _Node(tag, up, label, int(bool(weight)), main, form, _named(tag, at, up.main) if weight and at else 1.0)
        up.children.append(label)
        if node.weight:
            nodes.append(node)
        stack.append(node)
        open_tags[tag] += 1
        if tag in _RAW and not found[3].endswith("/"):
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, place)
            place = end.start() if end else len(source)
            stack.pop()
            open_tags[tag] -= 1
            if not end:
                break
    else:
        if place < len(source):
            run.append(source[place:])
    flush()
    for n in reversed(nodes[1:]):  # from the leaves up
        n.up.size += n.size
        n.up.holds |= n.holds or n.tag in _MAIN and n.size > 0
    total, article = stack[0].size, any(b["main"] for b in blocks)
    for n in nodes[1:]:  # and down again
        # Beside an article, an element with a name of furniture stays one at any length.
        counts = n.named < 1 and not n.holds and (2 * n.size < total or article and not n.main and n.named <= NAMED)
        n.factor = min(n.up.factor, n.named if counts else 1.0)
    for b in blocks:
        at = b.pop("at")
        b["node"], b["weight"] = at.key, at.factor
        if b["links"] and not b["main"] and 2 * len(b["text"]) < total:
            b["weight"] *= LINKED
    size_of = lambda part: sum(len(b["text"]) * b["weight"] for b in part)
    mains = [b for b in blocks if b["main"]]
    # A form; one that holds most of the article, or of the page, is a frame around it.
    framed = {inner: 2 * size_of(b for b in part if b["form"]) > size_of(part) for inner, part in ((True, mains), (False, blocks))}
    blocks = [b for b in blocks if not b["form"] or framed[b["main"]]]
    main = size_of(b for b in blocks if b["main"])
    beside = BESIDE if main and 2 * main >= size_of(blocks) else 1.0
    for b in blocks:
        b["weight"] *= MAIN if b["main"] else beside
    looks: dict[int, set[str]] = {}  # a node's styles on this page, taken together
    ups: dict[int, int | None] = {}
    for n in nodes:
        looks.setdefault(n.key, set()).add(" ".join(n.children))
        ups[n.key] = n.up.key if n.up else None
    styles = [
        {"key": k, "up": ups[k], "style": _hash("|".join(sorted(v))), "kinds": len(set(" ".join(v).split()))}
        for k, v in looks.items()
    ]
    return blocks, styles


_BLOCKS = "array<struct<text:string,key:bigint,node:bigint,main:boolean,weight:double>>"
_NODES = "array<struct<key:bigint,up:bigint,style:bigint,kinds:bigint>>"
#: Characters of pages that are parsed together.
TOGETHER = 4_000_000


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = pa.list_(pa.struct([("text", pa.string()), ("key", pa.int64()), ("node", pa.int64()), ("main", pa.bool_()), ("weight", pa.float64())]))
    node = pa.list_(pa.struct([("key", pa.int64()), ("up", pa.int64()), ("style", pa.int64()), ("kinds", pa.int64())]))
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("page")), 0).to_numpy()
        part_of = (np.cumsum(sizes + 4000) // TOGETHER).astype(np.int64)
        for part_number in np.unique(part_of):
            at = np.flatnonzero(part_of == part_number)
            part = batch.slice(int(at[0]), len(at))
            pages = [tree(p) for p in part.column("page").to_pylist()]
            names = [n for n in batch.schema.names if n != "page"]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(n) for n in names), pa.array([b for b, _ in pages], block), pa.array([n for _, n in pages], node)],
                [*names, "blocks", "nodes"],
            )


def _share(of: str) -> Column:
    """ln of a count as a share of ln of the host's pages."""
    return F.ln(F.greatest(F.col(of), F.lit(1)).cast("double")) / F.ln(F.greatest(F.col("host_pages"), F.lit(2)).cast("double"))


def _summed_up(nodes: DataFrame) -> DataFrame:
    """The sums of `every` and `weighed` over each node and all below it, from (host, key, up, every, weighed).

    Each round adds what the nodes so many steps below have summed up, and doubles the steps."""
    table = Written(nodes.withColumn("next", F.col("up")), "tree")
    while not table.df.filter("next IS NOT NULL").isEmpty():
        now = table.df
        added = (
            now.filter("next IS NOT NULL")
            .groupBy(F.col("host").alias("to_host"), F.col("next").alias("to"))
            .agg(F.sum("every").alias("more"), F.sum("weighed").alias("more_weighed"))
        )
        above = now.select(F.col("host").alias("above_host"), F.col("key").alias("above"), F.col("next").alias("further"))
        wider = Written(
            now.join(added, (F.col("host") == F.col("to_host")) & (F.col("key") == F.col("to")), "left")
            .join(above, (F.col("host") == F.col("above_host")) & (F.col("next") == F.col("above")), "left")
            .select(
                "host", "key", "up", (F.col("every") + F.coalesce("more", F.lit(0))).alias("every"),
                (F.col("weighed") + F.coalesce("more_weighed", F.lit(0.0))).alias("weighed"), F.col("further").alias("next"),
            ),
            "tree",
        )
        table.drop()
        table = wider
    return table.df.drop("next")


def _least_above(nodes: DataFrame) -> DataFrame:
    """The least `importance` of each node and all above it, from (host, key, up, importance)."""
    table = Written(nodes.withColumnRenamed("up", "next"), "least")
    while not table.df.filter("next IS NOT NULL").isEmpty():
        now = table.df
        above = now.select(
            F.col("host").alias("above_host"), F.col("key").alias("above"), F.col("importance").alias("there"),
            F.col("next").alias("further"),
        )
        wider = Written(
            now.join(above, (F.col("host") == F.col("above_host")) & (F.col("next") == F.col("above")), "left").select(
                "host", "key", F.least("importance", "there").alias("importance"), F.col("further").alias("next")
            ),
            "least",
        )
        table.drop()
        table = wider
    return table.df.drop("next")


def low_branches(parsed: DataFrame) -> DataFrame:
    """(of, low_key, importance): texts and nodes of an importance below 1, that of a node being the least of its path's.

    Texts seen once have the importance 1; on hosts of fewer than MIN_PAGES different pages all nodes have UNKNOWN."""
    texts = F.array_distinct(F.transform("blocks", lambda b: F.struct(b["key"].alias("key"), b["node"].alias("node"))))
    pages = (
        parsed.groupBy("host", F.xxhash64("blocks.key", "nodes").alias("page"))
        .agg(F.first(texts).alias("texts"), F.first("nodes").alias("nodes"))
    )
    seen = pages.select("host", F.explode("texts").alias("b")).groupBy("host", "b.node", "b.key").agg(F.count("*").alias("n"))
    seen = written(seen, "seen")
    places = pages.select("host", F.explode("nodes").alias("n")).groupBy("host", "n.key", "n.up", "n.style").agg(
        F.count("*").alias("times"), F.max("n.kinds").alias("kinds")
    )
    plain_log = lambda x: F.ln(F.greatest(F.col(x), F.lit(1)).cast("double"))
    looked = written(
        places.groupBy("host", "key", "up").agg(
            F.sum("times").alias("m"), F.sum(F.col("times") * plain_log("times")).alias("alike"), F.avg("kinds").alias("kinds")
        ),
        "nodes",
    )
    # The root is on every page.
    hosts = looked.filter(F.col("key") == ROOT).select(F.col("host").alias("of_host"), F.col("m").alias("host_pages"))
    nodes = written(looked.join(hosts, F.col("host") == F.col("of_host")).drop("of_host"), "measured")
    held = seen.groupBy(F.col("host").alias("th"), "node").agg(
        F.sum("n").alias("every"), F.sum(F.col("n") * plain_log("n")).alias("repeated")
    )
    # The mean of 1 - ln n / ln M over the texts of a branch, each n times, from two sums.
    branch = nodes.filter(F.col("host_pages") >= MIN_PAGES).join(
        held, (F.col("host") == F.col("th")) & (F.col("key") == F.col("node")), "left"
    )
    every = F.coalesce("every", F.lit(0).cast("bigint"))
    shared = F.coalesce("repeated", F.lit(0.0)) / F.ln(F.col("host_pages").cast("double"))
    sums = _summed_up(branch.select("host", "key", "up", every.alias("every"), (every - shared).alias("weighed")))
    looks = 1 - F.col("alike") / F.col("m") / F.ln(F.col("host_pages").cast("double"))
    fade = F.pow(F.lit(FADE), F.col("kinds"))
    # A branch without texts removes nothing.
    mean = F.when(F.col("every") > 0, F.col("weighed") / F.col("every"))
    importance = F.coalesce((1 - fade) * looks + fade * mean, F.lit(1.0))
    about = nodes.select(F.col("host").alias("nh"), F.col("key").alias("nk"), "m", "alike", "kinds", "host_pages")
    measured = sums.join(about, (F.col("host") == F.col("nh")) & (F.col("key") == F.col("nk"))).select(
        "host", "key", "up", importance.alias("importance")
    )
    below = _least_above(measured)
    unknown = nodes.filter(F.col("host_pages") < MIN_PAGES).select("host", "key", F.lit(UNKNOWN).alias("importance"))
    own = (
        seen.filter("n > 1").withColumnRenamed("key", "text_key")
        .join(about.filter(F.col("host_pages") >= MIN_PAGES), (F.col("host") == F.col("nh")) & (F.col("node") == F.col("nk")))
        .select("host", F.col("text_key").alias("key"), (1 - _share("n")).alias("importance"))
    )
    low = own.unionByName(below).unionByName(unknown)
    return low.select(F.col("host").alias("of"), F.col("key").alias("low_key"), "importance").filter("importance < 1")


def main_text(pages: DataFrame, *, page: str = "html", url: str = "url") -> DataFrame:
    """`row` (all columns of pages but the page itself) and `text`, the blocks that stay, a line each.

    Blocks meet the low keys of their host in a join by key; only pages that lose a block come back from it."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1))
    rest = [pages[c] for c in pages.columns if c != page]
    picked = pages.select(F.struct(*rest).alias("row"), host.alias("host"), F.col(page).alias("page"))
    fields = picked.select("row", "host", F.lit(None).cast(_BLOCKS).alias("blocks"), F.lit(None).cast(_NODES).alias("nodes")).schema
    parsed = written(picked.mapInArrow(_parsed, fields).withColumn("id", F.monotonically_increasing_id()), "parsed")
    bars = F.transform(
        "blocks",
        lambda b, i: F.struct(
            i.alias("i"), b["weight"].alias("weight"), F.array(b["key"], b["node"]).alias("keys")
        ),
    )
    asked = parsed.select("id", "host", F.explode(F.filter(bars, lambda b: b["weight"] >= LEAST)).alias("b")).select(
        "id", "host", "b.i", "b.weight", F.explode("b.keys").alias("key")
    )
    low = written(low_branches(parsed), "low")
    gone = written(
        asked.join(low, (asked["host"] == low["of"]) & (asked["key"] == low["low_key"]))
        .filter(F.col("weight") * F.col("importance") < LEAST)
        .groupBy(F.col("id").alias("lost_by"))
        .agg(F.collect_set("i").alias("lost")),
        "gone",
    )
    total = lambda of: F.aggregate(of, F.lit(0), lambda n, b: n + F.length(b["text"]))
    none = F.array().cast("array<int>")
    every = F.when(F.size("blocks") > 0, F.sequence(F.lit(0), F.size("blocks") - 1)).otherwise(none)
    lost = F.coalesce("lost", none)
    joined = parsed.join(gone, F.col("id") == F.col("lost_by"), "left").select(
        "row", "blocks", every.alias("every"), lost.alias("lost"),
        F.filter("blocks", lambda b: b["main"]).alias("mains"),
        F.filter(F.transform(lost, lambda i: F.col("blocks")[i]), lambda b: b["main"]).alias("lost_mains"),
    )
    copies = (2 * total("lost_mains") > total("mains")) & (2 * total("mains") >= total("blocks"))
    really = F.when(copies, F.filter("lost", lambda i: ~F.col("blocks")[i]["main"])).otherwise(F.col("lost"))
    stays = F.filter(
        F.transform(F.array_except("every", really), lambda i: F.col("blocks")[i]), lambda b: b["weight"] >= LEAST
    )
    return joined.select("row", F.array_join(F.transform(stays, lambda b: b["text"]), "\n").alias("text"))
