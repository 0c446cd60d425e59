"""Main text of web pages with site style trees.

Pages of a host are merged into one tree: a node is a path of tags and of class and id words without digits. What its pages
have there is compared: presentation by the sequence of child tags, content by sentences. Presentation importance is the entropy of
the sequences over the pages, content importance falls with the entropy of each sentence over the pages: a sentence that
many pages have says little. Both are carried up to the branches that hold them, and a branch's noise is the share of
repeated content, less where presentation varies. What the markup itself says of a node (a menu, an advert, an article) is one
more part of it. A branch whose noise is well above that of the sibling that holds most original text is removed.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import materialize
from .text import portions, released, squeezed

# Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta source track wbr param keygen frame".split())
SILENT = frozenset("script style noscript template svg math iframe object canvas audio video head title select textarea button".split())
ASIDE = frozenset("nav header footer aside form dialog menu".split())
BLOCK = frozenset("html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address hr br center details summary fieldset".split())
#: Words that name, alone or as the last part of a class, id or role, what surrounds an article.
NAMED = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo sidebar nav navbar navigation menu breadcrumb breadcrumbs header masthead footer cookie cookies consent notice notices popup modal newsletter subscribe subscription signup login search share sharing social related recommended comment comments respond replies disqus widget pagination pager copyright legal complementary contentinfo alert".split())
#: Last parts that say where or in what form the first part is; parts by which a name tells of something else than its node; owners of a header.
PLACES = frozenset("left right top bottom area wrapper wrap container box bar list section block slot links buttons inner outer widget widgets text form posts primary secondary main".split())
ABOUT = frozenset("has no not with without by is show hide".split())
CLOSERS = frozenset("p li dt dd tr td th option".split())
HOLDERS = frozenset("ul ol dl table div article section blockquote body".split())
OWNERS = frozenset("entry post article story content page".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Pages that must have a node before their agreement counts.
PAGES = 3
#: Noise added to nodes that markup names as surroundings, and to those beside a marked article.
NAME, BESIDE = 1.0, 0.06
#: A branch goes if its noise is more than SLACK + RATIO times that of the sibling with most original text.
SLACK, RATIO = 0.05, 1.5
#: Branches above a node, from the nearest on, to which its importance is carried.
LEVELS = 64
#: Bytes of the lists of removed nodes up to which they are broadcast, and parts of a host in the join beyond.
SMALL, SALTS = 64_000_000, 64
#: Tags of nothing but a name.
_OPENING, _CLOSING = re.compile(r"<([a-zA-Z][a-zA-Z0-9]*)>"), re.compile(r"</([a-zA-Z][a-zA-Z0-9]*)>")
_PARTS = re.compile(r"[-_]+")
_DIGITS = re.compile(r"[0-9]+")
_SENTENCE = re.compile(r"(?<=[.!?;:\u00b7|])\s+")
_MASK = 2**64 - 1


class Node:
    __slots__ = ("tag", "names", "children", "parent", "key", "texts", "own", "size", "holds", "inside")

    def __init__(self, tag: str, names: str, parent: "Node | None") -> None:
        self.tag, self.names, self.parent = tag, names, parent
        self.children: list[Node | str] = []
        self.key = self.own = self.size = 0
        self.texts: list[str] = []
        self.holds = False
        self.inside = parent is not None and (parent.inside or parent.tag == "article")

    def silent(self) -> bool:
        return self.tag in SILENT or self.names.startswith("hidden ")


class _Builder(HTMLParser):
    """A tolerant tree: void elements close themselves; p, li and table parts close their open like; strays are ignored."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", "", None)
        self.open: Counter[str] = Counter()

    def _leave(self, node: Node) -> None:
        """The element that holds node is the open one."""
        while self.at is not node.parent:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent

    def updatepos(self, i: int, j: int) -> int:
        """Lines are not counted."""
        return j

    def parse_starttag(self, i: int) -> int:
        """Tags without attributes at once, but for those whose content is read otherwise."""
        plain = _OPENING.match(self.rawdata, i)
        if plain and (tag := plain[1].lower()) in BLOCK:
            self.handle_starttag(tag, [])
            return plain.end()
        return super().parse_starttag(i)

    def parse_endtag(self, i: int) -> int:
        plain = _CLOSING.match(self.rawdata, i) if self.cdata_elem is None else None
        if plain:
            self.handle_endtag(plain[1].lower())
            return plain.end()
        return super().parse_endtag(i)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        names, hidden = "", False
        if attrs:
            known = dict(attrs)
            names = " ".join([str(known.get(a) or "") for a in ("class", "id", "role")])
            hidden = "hidden" in known or known.get("aria-hidden") == "true"
        if (tag in CLOSERS or (tag in BLOCK and tag != "br" and self.at.tag == "p")) and (self.open[tag] or self.open["p"]):
            like = self.at
            while like.parent is not None and like.tag not in HOLDERS and like.tag not in (tag, "p"):
                like = like.parent
            if like.parent is not None and like.tag in (tag, "p"):
                self._leave(like)
        node = Node(tag, ("hidden " if hidden else "") + names, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node
            self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if self.at.tag == tag and tag in ("svg", "math"):
            self._leave(self.at)

    def handle_endtag(self, tag: str) -> None:
        if self.open[tag] > 0:
            at = self.at
            while at.tag != tag:
                at = at.parent
            self._leave(at)

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


@lru_cache(maxsize=10_000)
def stable(names: str) -> str:
    """Class, id and role words of a node without digits, by which pages of a host share nodes."""
    return " ".join(sorted({w for w in _DIGITS.sub("", names).split() if w}))


@lru_cache(maxsize=10_000)
def _label(tag: str, names: str) -> bytes:
    return f"{tag} {stable(names)}".encode("utf-8", "surrogatepass")


def _ordered(html: str) -> list[Node]:
    """The visible nodes of a page, parents first; each node's key names its path."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    order, todo = [], [builder.root]
    while todo:
        node = todo.pop()
        if not node.silent():
            order.append(node)
            for child in node.children:
                if isinstance(child, Node):
                    child.key = xxhash.xxh64_intdigest(_label(child.tag, child.names), seed=node.key)
                    todo.append(child)
    return order


def tree_of(html: str) -> list[Node]:
    """The visible nodes of a page, parents first: texts are the node's own with single spaces, own is their length in visible letters and size that of the branch, and holds tells whether a non-empty article or main is in it."""
    order = _ordered(html)
    for node in reversed(order):
        for text in node.children:
            if isinstance(text, str) and not text.isspace():
                text = " ".join(text.split())
                node.texts.append(text)
                node.own += len(text) - text.count(" ")
        node.size += node.own
        node.holds = node.size > 0 and (node.holds or node.tag in ("article", "main"))
        if node.parent is not None:
            node.parent.size += node.size
            node.parent.holds |= node.holds
    return order


@lru_cache(maxsize=10_000)
def named(names: str) -> frozenset[str]:
    """The words of NAMED that a class, id or role says its node is."""
    out = set()
    for token in names.lower().split():
        parts = [p for p in _PARTS.split(token.rstrip("0123456789")) if p]
        if not parts or ABOUT & set(parts[:-1]):
            continue
        if parts[-1] in NAMED and not (parts[-1] == "header" and parts[0] in OWNERS):
            out.add(parts[-1])
        elif len(parts) > 1 and parts[0] in NAMED and parts[-1] in PLACES:
            out.add(parts[0])
    if names.lower().split() == ["side"]:
        out.add("side")
    return frozenset(out)


def surrounds(node: Node) -> bool:
    """Whether the markup says that a node is not part of an article."""
    words = set(named(node.names)) if node.names and node.tag not in ("html", "body", "article", "main") else set()
    if node.tag == "header" and not OWNERS & {t.split("-")[0].split("_")[0] for t in node.names.lower().split() if t.endswith("header")}:
        words.add("header")
    if (node.tag == "header" or words == {"header"}) and node.inside:
        words -= {"header"}
    return bool(words) or (node.tag in ASIDE and node.tag != "header")


def blocks(root: Node, removed) -> list[tuple[Node, str]]:
    """(nearest block element, text) of what stays, in page order; removed(node) cuts a branch."""
    out: list[tuple[Node, str]] = []
    held: list[str] = []

    def flush(owner: Node) -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append((owner, text))

    # An explicit stack, for trees deeper than Python's calls.
    todo: list[tuple[Node | str, Node, bool]] = [(root, root, True)]
    while todo:
        item, owner, opening = todo.pop()
        if isinstance(item, str):
            held.append(item)
        elif not opening:
            flush(item)
        elif item is root or not removed(item):
            block = item.tag in BLOCK
            if block:
                flush(owner)
                todo.append((item, item, False))
            inner = item if block else owner
            todo.extend((child, inner, True) for child in reversed(item.children))
    flush(root)
    return out


#: Kinds of counted facts of a node: its parent (with its own text's length), child sequences, sentences, branches it is in, pages where it holds an article, pages where it is named as surroundings.
INFO, STYLE, TEXT, WITHIN, HOLDS, NAMES = range(6)
#: In place of a parent, for headings and for inline elements.
HEADING, INLINE = -1, -2
#: The key of every root.
ROOT = 0


def page_nodes(html: str) -> dict[tuple[int, int, int], list[int]]:
    """Facts (node, kind, value) of a page with [n, mass], of the nodes that have visible text."""
    order = tree_of(html)
    out: dict[tuple[int, int, int], list[int]] = {}
    placed: set[int] = set()

    def told(node: int, kind: int, value: int, once: bool, mass: int = 0) -> None:
        fact = out.get((node, kind, value))
        if fact is None:
            out[node, kind, value] = [1, mass]
        else:
            fact[0] = 1 if once else fact[0] + 1
            fact[1] += mass

    for node in order:
        # Of a branch without visible text only the root counts.
        if not node.size and node.parent is not None:
            continue
        key = node.key
        inner = [c.tag for c in node.children if isinstance(c, Node) and not c.silent()]
        told(key, INFO, node.parent.key if node.parent else 0, True, node.own)
        told(key, STYLE, xxhash.xxh64_intdigest(" ".join(inner)), False)
        for text in node.texts:
            for sentence in _SENTENCE.split(text):
                told(key, TEXT, xxhash.xxh64_intdigest(sentence.encode("utf-8", "surrogatepass")), True)
        # Nodes of one key have one path.
        if (node.texts or len(inner) > 1) and key not in placed:
            placed.add(key)
            branch = node
            for _ in range(LEVELS):
                out[key, WITHIN, branch.key] = [1, 0]
                branch = branch.parent
                if branch is None:
                    break
        if node.holds:
            told(key, HOLDS, 0, True)
        elif 2 * node.size <= order[0].size and surrounds(node):
            told(key, NAMES, 0, True)
        # Headings say the same on many pages and are text all the same; inline parts go with their block.
        if node.tag in HEADINGS:
            told(key, INFO, HEADING, True)
        elif node.tag not in BLOCK and node.tag not in ASIDE:
            told(key, INFO, INLINE, True)
    return out


def main_text(html: str | None, low: set[int]) -> str:
    """The page's text without the branches whose keys are in low."""
    if not html:
        return ""
    return "\n".join(t for _, t in blocks(_ordered(html)[0], lambda n: n.silent() or n.key in low))


def host_of(url_column: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url_column).cast("string"), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def node_facts(pages: DataFrame) -> DataFrame:
    """(host, node, kind, value, n, mass): the facts of page_nodes() summed over the pages (host, html) of a host."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in portions(frames, "html"):
            found: dict[str, dict[tuple[int, int, int], list[int]]] = {}
            for host, html in zip(frame["host"], frame["html"]):
                known = found.setdefault(host, {})
                for fact, sums in page_nodes(html).items() if html else ():
                    total = known.get(fact)
                    if total is None:
                        known[fact] = sums
                    else:
                        total[0] += sums[0]
                        total[1] += sums[1]
            hosts = np.repeat(np.array(list(found), dtype=object), [len(known) for known in found.values()])
            facts = [fact for known in found.values() for fact in known]
            ids = [np.array([fact[k] & _MASK for fact in facts], dtype=np.uint64).view(np.int64) for k in (0, 2)]
            sums = np.array([total for known in found.values() for total in known.values()], dtype=np.int64).reshape(-1, 2)
            yield pd.DataFrame({"host": hosts, "node": ids[0], "kind": np.array([fact[1] for fact in facts], dtype=np.int32), "value": ids[1], "n": sums[:, 0], "mass": sums[:, 1]})

    facts = pages.mapInPandas(run, "host string, node long, kind int, value long, n long, mass long")
    return facts.groupBy("host", "node", "kind", "value").agg(F.sum("n").alias("n"), F.sum("mass").alias("mass"))


def importances(facts: DataFrame) -> DataFrame:
    """(host, node, parent, mass, own, marked, named, noise) of each node of facts: noise is its branch's share of repeated content, less where presentation varies."""

    def total(kind: int, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, value)), F.lit(0))

    n, nlogn = F.col("n"), F.col("n") * F.log("n")
    parent = ~F.col("value").isin(HEADING, INLINE)
    nodes = facts.groupBy("host", "node").agg(
        total(INFO, F.when(parent, n)).alias("m"),
        total(INFO, F.col("mass")).alias("own"),
        F.max(F.when((F.col("kind") == INFO) & parent, F.col("value"))).alias("parent"),
        *[F.max((F.col("kind") == INFO) & (F.col("value") == mark)).alias(name) for mark, name in ((HEADING, "heading"), (INLINE, "inline"))],
        total(STYLE, n).alias("styles"),
        total(STYLE, nlogn).alias("style_log"),
        total(TEXT, n).alias("texts"),
        total(TEXT, nlogn).alias("text_log"),
        total(HOLDS, n).alias("holds"),
        total(NAMES, n).alias("names"),
    )
    many = F.col("m") >= PAGES
    # Entropy of n_i out of s is log s - sum(n_i log n_i) / s; of a sentence on n of m pages it is log n.
    varied = F.when(many, 1 - F.col("style_log") / (F.col("styles") * F.log("styles"))).otherwise(0.0)
    repeated = F.when(many & ~F.col("heading"), F.col("text_log") / F.log("m")).otherwise(0.0)
    nodes = materialize(nodes.withColumn("varied", varied).withColumn("repeated", repeated).drop("styles", "style_log", "text_log"), "nodes")
    up = facts.where(F.col("kind") == WITHIN).select("host", "node", F.col("value").alias("branch"))
    own = nodes.select("host", "node", "texts", "repeated", "varied", F.col("own").alias("mass"))
    branches = up.join(own, ["host", "node"]).groupBy("host", F.col("branch").alias("node"))
    branches = branches.agg(F.sum("texts").alias("all"), F.sum("repeated").alias("loss"), F.max("varied").alias("varied"), F.sum("mass").alias("mass"))
    joined = nodes.drop("varied", "repeated", "texts").join(branches, ["host", "node"])
    noise = F.when(~F.col("heading") & ~F.col("inline") & (F.col("all") > 0), F.col("loss") / F.col("all") * (1 - F.col("varied"))).otherwise(0.0)
    return joined.select("host", "node", "parent", "mass", "own", (2 * F.col("holds") > F.col("m")).alias("marked"), (2 * F.col("names") > F.col("m")).alias("named"), noise.alias("noise"))


def low_nodes(pages: DataFrame) -> DataFrame:
    """(host, low): of pages (host, html), the nodes of each host's tree whose branches are removed, where there are any.

    A node's noise is that of importances(), NAME more if most of its pages name it as surroundings, and BESIDE more if it does
    not hold a marked article and a sibling does (of marked siblings, those with half the text of the largest count). Siblings are compared
    with the one of most original text, mass * (1 - noise); the parent's own text is one of them, without noise.
    """
    tree = materialize(importances(materialize(node_facts(pages), "facts")), "tree")
    marks = tree.where(F.col("node") != ROOT).groupBy("host", "parent").agg(F.max(F.when(F.col("marked"), F.col("mass"))).alias("most"))
    nodes = tree.where(F.col("node") != ROOT)
    beside = F.col("most").isNotNull() & ~(F.col("marked") & (2 * F.col("mass") >= F.col("most")))
    judged = nodes.join(marks, ["host", "parent"]).withColumn("noise", F.col("noise") + F.when(F.col("named"), NAME).otherwise(0.0) + F.when(beside, BESIDE).otherwise(0.0))
    weight = F.col("mass") * F.greatest(1 - F.col("noise"), F.lit(0.0))
    best = judged.groupBy("host", "parent").agg(F.max(F.struct(weight.alias("weight"), "mass", F.col("node"), F.col("noise").alias("noise"))).alias("best"))
    best = best.join(tree.select("host", F.col("node").alias("parent"), F.col("own")), ["host", "parent"], "left")
    base = F.when(F.coalesce("own", F.lit(0)) > F.col("best.weight"), 0.0).otherwise(F.col("best.noise"))
    low = judged.drop("own").join(best.select("host", "parent", base.alias("base")), ["host", "parent"]).where(F.col("noise") > SLACK + RATIO * F.col("base"))
    return low.groupBy("host").agg(F.array_sort(F.collect_set("node")).alias("low"))


def _with_low(source: DataFrame, low: DataFrame) -> DataFrame:
    """source with the list of its host: broadcast up to SMALL bytes, else joined in SALTS parts of each host, so that a large host is many tasks."""
    size = low.agg(F.sum(8 * F.size("low") + F.octet_length("host"))).first()[0] or 0
    if size <= SMALL:
        return source.join(F.broadcast(low), "host", "left")
    parts = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = source.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALTS)).cast("int"))
    return salted.join(parts, ["host", "salt"], "left").drop("salt")


def extract_main_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of each page.

    Null html is empty; a null or odd url is the host "". Character references are decoded, white space in a block is one space,
    blocks are trimmed and joined by line feeds in page order; nothing else is dropped or cut. Null ids and repeated rows pass
    (a repeated page counts again in its host's tree); other columns are ignored; an empty table gives no rows.
    """
    source = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).cast("string").alias("html"), host_of(url_column).alias("host"))
    low = materialize(low_nodes(source.select("host", "html")), "low")

    @F.pandas_udf("string")
    def extract(html: pd.Series, low: pd.Series) -> pd.Series:
        sets: dict[bytes, set] = {}
        out = []
        for z, nodes in zip(released(html), low):
            key = b"" if nodes is None else np.asarray(nodes).tobytes()
            if key not in sets:
                sets[key] = set() if nodes is None else {int(n) & _MASK for n in nodes}
            out.append(main_text(z.decode("utf-8", "surrogatepass") if z is not None else None, sets[key]))
        return pd.Series(out, dtype=object)

    joined = _with_low(source.select("page_id", "url", squeezed("html").alias("html"), "host"), low)
    return joined.select("page_id", "url", extract("html", "low").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
