"""Main text of web pages by a site style tree.

1. Every page becomes a tree of elements. Those of a host are merged by their path (tags and
   classes from the root, numbers in classes taken as the same): per path, how many pages have it, the ways its children follow each
   other (its styles) and the texts directly in it.
2. Importance, by entropy to the base of the number of pages: a path's presentation matters if
   its styles vary, its content if its texts are not the same on page after page. A branch's
   importance is that of its presentation and its children's, weighted as the tree is deep;
   it is computed by joins and aggregates on host and parent, from the deepest level up.
   Elements below ``MAX_DEPTH`` count as children of the one at that depth, as in browsers.
3. A page loses the branches that are of low importance together with all their own branches,
   and, whatever the host, what its tags and class names call menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
   or reader comments. The style tree decides inside the article (or main) element as outside;
   inside, the square root of the importance counts, which raises it. What holds the element
   is never cut for its importance. Of a page whose article is most of its text and would lose
   most of it so (near copies), the article stays whole, and a page that would lose all its
   text (a host of copies) is judged by its names alone.
   Doubtful names (such a word beside another, as in ``<div class="social-studies">``; but none of
   ``CERTAIN``) don't empty a page: where the page has no article and names leave less than
   ``NAMES_LEAVE`` of the text outside of the tags named above, the branch named so that holds most
   of that text is taken as unnamed, and so on inside it.
4. Where the article has most of the text that is left, what is outside goes, except a first-level
   heading; elsewhere (a teaser, a quote) the article is a branch like others.

The branches of low importance are joined to the pages by host: broadcast if their measured
size is below ``BROADCAST_BYTES``, else by a shuffle.

Null html is empty and gives an empty text. A page without a host is judged by its names
alone, as is one of a host with few pages. Repeated rows give a result each and count as pages.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlist.llm.shared import BROADCAST_BYTES, bound_batches, broadcast_if_small, stage

#: A branch below this importance goes; hosts of fewer pages are not judged.
LOW, MIN_PAGES = 0.2, 8
#: Weight of the children's importance, to the power of their number.
GAMMA = 0.9
#: Share of a page's text that its names must leave to be believed.
NAMES_LEAVE = 0.02
#: Levels of a style tree; also bounds the rounds of ``low_branches``.
MAX_DEPTH = 64

# Elements that hold no text of a page, and words of class names, ids and roles.
SILENT = {
    "script", "style", "noscript", "template", "head", "title", "nav", "footer", "aside", "form", "button", "select",
    "textarea", "input", "option", "iframe", "object", "svg", "canvas", "menu", "dialog", "audio", "video",
}
NOISE = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promotion",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "sidebar", "aside",
    "comment", "comments", "disqus", "reply", "replies", "respond", "cookie", "cookies", "consent", "gdpr", "notice", "notices",
    "alert", "popup", "modal", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social",
    "related", "recommended", "widget", "widgets", "pagination", "pager", "form", "search", "copyright", "contentinfo",
    "complementary", "skip", "toolbar",
}
CERTAIN = {"comment", "comments", "disqus", "respond", "replies", "cookie", "cookies", "consent", "gdpr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
MAIN = {"article", "main"}
HEADING = {"header", "masthead"}
#: An opening block ends an open paragraph; these end an open one of their own kind.
SELF_CLOSING = {"li", "dt", "dd", "tr", "td", "th", "option", "p"}

_ATTRS = r"""(?:"[^"]*"|'[^']*'|[^>"'])*+"""
_RAW = "script|style|noscript|template|textarea|title|iframe|svg"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b{_ATTRS}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>{_ATTRS})>|</?[a-zA-Z][^>]*>|<[!?][^>]*>",
    re.S | re.I,
)
_NUMBER = re.compile(r"[0-9]+")
_LAYOUT = re.compile(r"(?:has|with|without|no)[-_]")
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def events(html: str):
    """(kind, tag, attributes or text): kind 1 opens, -1 closes, 0 is text. Comments and the
    contents of raw elements are left out."""
    at = 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            yield 0, "", html[at : m.start()]
        at = m.end()
        if m["tag"]:
            yield (-1 if m["end"] else 1), m["tag"].lower(), m["attrs"]
        elif m["raw"]:
            yield 0, "", " "
    if at < len(html):
        yield 0, "", html[at:]


def names(attrs: str) -> tuple[str, set[str], bool]:
    """The classes, sorted, each number in them as 0, the words in class, id and role that name what isn't content,
    and whether each of them stands beside another word. Names of a layout ("has-sidebar") say nothing of the element itself."""
    classes, noise, doubtful = "", set(), True
    for key, a, b, c in _NAMES.findall(attrs):
        own = (a or b or c).lower().split()
        for name in own:
            said = set(filter(None, re.split(r"[^a-z]+", name))) if not _LAYOUT.match(name) else set()
            if said & NOISE:
                noise |= said & NOISE
                doubtful = doubtful and not said <= NOISE and not said & CERTAIN
        if key.lower() == "class":
            classes = ".".join(sorted({_NUMBER.sub("0", name) for name in own}))
    return classes, noise, bool(noise) and doubtful


class Node:
    __slots__ = ("tag", "path", "parent", "above", "depth", "children", "texts", "silent", "doubtful", "noisy", "main", "inside", "title", "cut")

    def __init__(
        self, tag: str, path: int, parent: "Node | None", silent: bool = False, named: bool = False, above: "Node | None" = None
    ):
        """``above`` is the parent in the style tree; ``silent`` says the tag holds no text of a page,
        ``named`` that the names say so."""
        self.tag, self.path, self.parent, self.above = tag, path, parent, above
        self.depth = above.depth + 1 if above else 0
        self.children: list[Node] = []
        self.texts: list[str] = []
        self.silent = bool(parent and parent.silent) or silent
        self.doubtful = False
        self.noisy = bool(parent and parent.noisy) or self.silent or named
        self.main = tag in MAIN and not self.noisy
        self.inside = self.main or bool(parent and parent.inside)
        self.title = tag == "h1" or bool(parent and parent.title)
        self.cut = False


def walk(html: str, unbelieved: frozenset = frozenset()):
    """(node, text or None) in page order: a node when it opens, and each stretch of text
    with the node it is directly in, character references decoded; breaks between blocks are
    the text of a space. The names of the opened elements numbered in ``unbelieved`` don't count."""
    import xxhash

    top, opened = Node("", 0, None), 0
    stack = [top]
    yield top, None
    for kind, tag, what in events(html):
        if kind == 0:
            yield stack[-1], entities.unescape(what)
            continue
        if tag not in INLINE:
            yield stack[-1], " "
        if kind == -1:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in VOID:
            continue
        closes = {tag} if tag in SELF_CLOSING else set()
        if tag not in INLINE:
            closes.add("p")
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in closes:
                del stack[k:]
                break
            if stack[k].tag not in INLINE and stack[k].tag not in SELF_CLOSING:
                break
        classes, noise, doubtful = names(what) if what.strip() else ("", set(), False)
        up = stack[-1]
        if up.inside:  # the heading of the article itself
            noise -= HEADING
        silent = tag in SILENT or (tag == "header" and not up.inside)
        # an article named so inside the article is a reader's comment or a teaser
        named = bool(noise) and (up.inside or tag not in {"html", "body", *MAIN}) and opened not in unbelieved
        opened += 1
        above = up if up.depth < MAX_DEPTH else up.above
        path = xxhash.xxh64_intdigest(f"{above.path}>{tag}.{classes}") >> 1
        node = Node(tag, path, up, silent, named, above)
        node.doubtful = named and doubtful
        above.children.append(node)
        stack.append(node)
        yield node, None


def _misnamed(places: list) -> list[int]:
    """The numbers of the doubtfully named elements that hold most of the text outside of silent
    tags, each in the one before it, where the names leave no article and next to nothing; else none."""
    size, left = {}, 0
    for node, text in places:
        if text and not node.silent and (n := len("".join(text.split()))):
            size[node] = size.get(node, 0) + n
            left += 0 if node.noisy else n
    whole = sum(size.values())
    if left >= NAMES_LEAVE * whole or any(node.main for node, _ in places):
        return []
    nodes = [node for node, text in places if text is None]
    for node in reversed(nodes[1:]):  # children come after their parents
        if node in size:
            size[node.parent] = size.get(node.parent, 0) + size[node]
    # the first is the top, which has no tag
    return [k for k, node in enumerate(nodes[1:]) if node.doubtful and 2 * size.get(node, 0) > whole]


def _places(html: str) -> list:
    """``walk``, without the names of as many elements, from outside, as it takes to leave some text."""
    places = list(walk(html))
    if chain := _misnamed(places):
        few = bisect_left(range(1, len(chain)), True, key=lambda k: not _misnamed(list(walk(html, frozenset(chain[:k])))))
        places = list(walk(html, frozenset(chain[: few + 1])))
    return places


def main_text(html: str, low: frozenset = frozenset()) -> str:
    """The text of a page without the branches that are noisy or whose path is in ``low``."""
    places, holders = _places(html), set()  # what has the article below it
    for node, text in places:
        up = node.parent if text is None and node.main else None
        while up and up not in holders:
            holders.add(up)
            up = up.parent
    for node, text in places:
        if text is None:
            node.cut = bool(node.parent and node.parent.cut) or (node.path in low and node not in holders)

    def text_of(chosen) -> str:
        kept = (t for n, t in places if t is not None and (t == " " or not n.noisy and chosen(n)))
        return " ".join("".join(kept).split())

    whole, article = text_of(lambda n: True), text_of(lambda n: n.inside)
    if low:
        left, left_article = text_of(lambda n: not n.cut), text_of(lambda n: n.inside and not n.cut)
        if 2 * len(article) > len(whole) and 2 * len(left_article) < len(article):
            for node, text in places:
                node.cut = node.cut and not node.inside
            left, left_article = text_of(lambda n: not n.cut), article
        if left:
            whole, article = left, left_article
        else:
            for node, text in places:
                node.cut = False
    if 2 * len(article) <= len(whole):
        return whole
    return text_of(lambda n: not n.cut and (n.inside or n.title))


def _page_rows(host: str, html: str):
    """(host, path, parent, depth, kind, feature, n): kind 0 counts styles, 1 texts, 2 the page
    itself, with feature 1 inside the article."""
    import xxhash

    nodes, counts, inside = [], {}, set()
    for node, text in walk(html):
        if text is None:
            nodes.append(node)
            if node.inside:
                inside.add(node.path)
        elif text.strip():
            node.texts.append(" ".join(text.split()))
    for node in nodes:
        style = "".join(f"{c.path}," for c in node.children)
        place = node.path, node.above.path if node.above else -1, node.depth
        for kind, feature in [(0, style)] + [(1, t) for t in node.texts]:
            key = (*place, kind, xxhash.xxh64_intdigest(feature) >> 1)
            counts[key] = counts.get(key, 0) + 1
        counts[(*place, 2, int(node.path in inside))] = 1
    return [(host, *key, n) for key, n in counts.items()]


def _features(batches):
    import pyarrow as pa

    names_ = ["host", "path", "parent", "depth", "kind", "feature", "n"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    for batch in batches:
        rows = [r for h, page in zip(batch.column("host"), batch.column("html")) for r in _page_rows(h.as_py(), page.as_py() or "")]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names_)


def style_trees(pages: DataFrame) -> DataFrame:
    """(host, path, parent, depth, inside, pages, style_importance, text_importance): the merged trees."""
    each = pages.filter("host IS NOT NULL").select("host", "html").mapInArrow(
        _features, "host string, path long, parent long, depth int, kind int, feature long, n long"
    )
    by_feature = each.groupBy("host", "path", "parent", "depth", "kind", "feature").agg(
        F.sum("n").alias("c"), F.sum(F.col("n") * F.log("n")).alias("c_log_c"), F.count(F.lit(1)).alias("pages")
    )
    style, words = F.col("kind") == 0, F.col("kind") == 1
    by_path = by_feature.groupBy("host", "path", "parent", "depth").agg(
        F.sum(F.when(F.col("kind") == 2, F.col("pages"))).alias("pages"),
        (F.max(F.when(F.col("kind") == 2, F.col("feature"))) == 1).alias("inside"),
        F.sum(F.when(style, F.col("c"))).alias("c"),
        F.sum(F.when(style, F.col("c") * F.log("c"))).alias("c_log_c"),
        F.avg(F.when(words, F.log("c") - F.col("c_log_c") / F.col("c"))).alias("spread"),
    )
    base = F.log("pages")
    return by_path.select(
        "host",
        "path",
        "parent",
        "depth",
        "inside",
        "pages",
        F.when(F.col("pages") > 1, (F.log("c") - F.col("c_log_c") / F.col("c")) / base).otherwise(1.0).alias("style_importance"),
        F.when(F.col("pages") > 1, 1 - F.col("spread") / base)
        .otherwise(F.when(F.col("spread").isNotNull(), 1.0))
        .alias("text_importance"),
    )


def low_branches(trees: DataFrame) -> DataFrame:
    """(host, low) from merged trees: paths whose branch is of low importance, all below them too.

    What only one page has is of importance 1 and so is all below it; of such paths, only their
    number by parent is needed. The others are rated a level at a time, the deepest first."""
    trees = stage(trees, "style-trees")
    once = trees.filter("pages = 1").groupBy(F.col("host").alias("_host"), F.col("parent").alias("_parent"))
    nodes = trees.filter("pages > 1").join(
        once.agg(F.count(F.lit(1)).alias("once")), (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_parent")), "left"
    )
    nodes = nodes.select(*trees.columns, F.coalesce("once", F.lit(0)).alias("once"))
    nodes = stage(nodes.sortWithinPartitions("depth"), "style-nodes")
    deepest = nodes.agg(F.max("depth")).first()[0]
    text, levels, below = F.col("text_importance"), [], None
    for depth in range(deepest if deepest is not None else -1, -1, -1):
        level = nodes.filter(F.col("depth") == depth)
        if below is None:
            level = level.withColumns({"n": F.lit(0), "total": F.lit(0.0), "all_low": F.lit(True)})
        else:
            level = level.join(below, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_parent")), "left")
        n_parts = F.coalesce("n", F.lit(0)) + F.col("once") + text.isNotNull().cast("int")
        mean = (F.coalesce("total", F.lit(0.0)) + F.col("once") + F.coalesce(text, F.lit(0.0))) / n_parts
        weight = F.pow(F.lit(GAMMA), n_parts)
        value = F.when(n_parts > 0, (1 - weight) * F.col("style_importance") + weight * mean).otherwise(1.0)
        rated = level.withColumn("value", value).select(
            "host", "path", "parent", "pages", "value",
            ((F.col("value") < F.when(F.col("inside"), LOW**2).otherwise(LOW)) & (F.col("once") == 0) & F.coalesce("all_low", F.lit(True))).alias("low"),
        )
        levels.append(stage(rated, "style-level"))
        below = levels[-1].groupBy(F.col("host").alias("_host"), F.col("parent").alias("_parent")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.min("low").alias("all_low")
        )
    if not levels:
        return nodes.select("host", F.array("path").alias("low"))
    low = reduce(DataFrame.union, levels).filter(F.col("low") & (F.col("pages") >= MIN_PAGES))
    return low.groupBy("host").agg(F.collect_list("path").alias("low"))


def _texts(batches):
    import pyarrow as pa

    for batch in batches:
        low, made, cache = batch.column("low").to_pylist(), [], {}
        for page, paths in zip(batch.column("html"), low):
            key = tuple(paths or ())
            made.append(main_text(page.as_py() or "", cache.setdefault(key, frozenset(key))))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(made, pa.string()), pa.array([len(t) for t in made], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def host_of(url: str = "url"):
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def extract(pages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    bound_batches(pages.sparkSession, 200)
    pages = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of().alias("host"))
    low = stage(low_branches(style_trees(pages)), "low-branches")
    low = broadcast_if_small(low.withColumnRenamed("host", "_host"), F.octet_length("_host") + 8 * F.size("low") + 64, broadcast_bytes)
    joined = pages.join(low, F.col("host") == F.col("_host"), "left")
    id_type = pages.schema["page_id"].dataType.simpleString()
    return joined.select("page_id", "url", "html", "low").mapInArrow(
        _texts, f"page_id {id_type}, url string, text string, n_chars long"
    )
