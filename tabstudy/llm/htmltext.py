"""Main text of web pages by consensus of each host's pages.

Every page scores its containers and votes for the generalised paths (tags and classes, digits folded) of the best.
Votes are summed per host in Spark, and the winning path of the host tells where the text is on all
of its pages. A page that lacks the winning path falls back on its own best container.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabstudy.llm.components import written

HOT_HOSTS = 1000
PATH_CHARS = 400  # the part of a path above a longer one is folded to its digest
MOST = 2 / 3  # share of a wrapper's text that one container below it must hold to stand for it
STRAY = 0.1  # share of text straight in the body that is not taken for the article's
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article body center div main section td".split())
#: Elements that an opening tag ends, if they are open in the same container.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
LISTS = frozenset("ul ol dl table select menu".split())
#: Elements whose content is never text of the article.
DROPPED = frozenset(
    "head title nav footer aside form script style noscript template iframe object svg canvas audio video button "
    "select textarea input menu dialog search label fieldset".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert form".split())
#: Parts of class and id names that mark boilerplate.
MARKS = frozenset(
    "ad ads adv advert advertisement advertising adverts adsense advertorial aside banner breadcrumb breadcrumbs byline "
    "consent cookie cookies copyright footer gdpr login masthead menu modal nav navbar navigation newsletter notice "
    "notification overlay pager paginate pagination paywall popup privacy promo promoted promotion promotions recommended "
    "related search share sharing sidebar signup sitemap skip social sponsor sponsored subscribe subscription tags toolbar "
    "topbar widget".split()
)
READER_MARKS = frozenset("comment comments commentlist discussion disqus replies reply respond responses".split())
NEUTRAL = frozenset("has no with is without".split())


BODY_TAGS = frozenset(("article", "main", "h1"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Node:
    __slots__ = ("tag", "names", "role", "hidden", "parent", "items", "below")

    def __init__(self, tag: str, attrs: dict[str, str | None], parent: Node | None):
        self.tag, self.parent, self.items = tag, parent, []
        self.below: set[str] = set()  # which of BODY_TAGS are below
        self.names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower().split()
        self.role = (attrs.get("role") or "").lower()
        style = re.sub(r"\s", "", attrs.get("style") or "").lower()
        self.hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style


class PageTree(HTMLParser):
    """Builds a tree from markup that may leave elements open or close them in the wrong place."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#page", {}, None)
        self.open = self.root

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.close_until({"p"}, BLOCKS - {"p"})
        if tag in ENDS:
            self.close_until(ENDS[tag], LISTS)
        node = Node(tag, dict(attrs), self.open)
        self.open.items.append(node)
        above = self.open if tag in BODY_TAGS else None
        while above is not None and tag not in above.below:
            above.below.add(tag)
            above = above.parent
        if tag not in VOID:
            self.open = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "path", "iframe", "script", "span"):
            self.handle_endtag(tag)

    def close_until(self, tags, stops):
        """Close the nearest open element of ``tags``, unless one of ``stops`` is nearer."""
        node = self.open
        while node is not None and node.tag not in stops:
            if node.tag in tags:
                self.open = node.parent
                return
            node = node.parent

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        node = self.open
        while node is not None and node.tag != tag:
            if tag not in BLOCKS and node.tag in BLOCKS:
                return  # an inline element that was left open around blocks
            node = node.parent
        if node is not None and node.parent is not None:
            self.open = node.parent

    def handle_data(self, data):
        self.open.items.append(data)


def parse(html: str) -> Node:
    tree = PageTree()
    tree.feed(html)
    if re.match(r"<(?:!--|[a-zA-Z/!?])", tree.rawdata):
        tree.rawdata = ""  # a tag or comment that the page's end cuts off is no text
    tree.close()
    return tree.root


def is_boilerplate(node: Node, inside: bool, names: bool = True) -> bool:
    """Whether a subtree is no text of the article; ``inside``: below an article or main element.

    Headings inside are never told by their names, nor is any element where ``names`` is off.
    """
    tag = node.tag
    if tag in DROPPED or node.hidden or node.role in DROPPED_ROLES:
        return True
    if tag == "header":
        return not inside and node.below.isdisjoint(("article", "main"))
    if not names or not node.names or tag in ("html", "body", "main") or (inside and tag in HEADINGS):
        return False
    marked = False
    for name in node.names:
        parts = re.split(r"[-_:]+", name)
        if parts[0] in NEUTRAL:
            continue
        if not READER_MARKS.isdisjoint(parts):
            return tag != "article" or "comment" in parts
        marked = marked or not MARKS.isdisjoint(parts)
    return marked and tag != "article" and not node.below


def step_name(node: Node) -> str:
    names = sorted({re.sub(r"\d+", "#", n) for n in node.names})
    return ".".join([node.tag, *names])


def path_below(path: str, node: Node) -> str:
    """The path of ``node``, whose nearest container above has ``path``; its length is bounded."""
    if node.tag not in CONTAINERS and node.tag != "html":
        return path
    if len(path) > PATH_CHARS:
        path = "#" + hashlib.blake2b(path.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()
    return f"{path}>{step_name(node)}" if path else step_name(node)


class Holder:
    """A container while a page is scored: its path, the text whose nearest container it is, containers below."""

    __slots__ = ("path", "tag", "own", "total", "below")

    def __init__(self, path: str, tag: str):
        self.path, self.tag, self.own, self.total, self.below = path, tag, 0, 0, []


def candidate_scores(root: Node, names: bool = True) -> dict[str, int]:
    """Per generalised path, how much running text its candidate containers hold; linear in the page.

    Where article or main elements hold text, these and the containers beside them are candidates, each with the text whose nearest
    one it is; text below an article or main counts for that element. Elsewhere the candidate is sought from the
    outermost container down: a container gives way to the one below it that holds ``MOST`` of its text, unless it has
    text of its own (paragraphs beside that container belong to the same article); in html and body up to ``STRAY`` of it may be.
    """
    top = Holder("", "#page")
    made, bodies = [top], False
    stack = [(root, top, "", False)]
    while stack:
        node, holder, path, inside = stack.pop()
        for item in node.items:
            if isinstance(item, str):
                size = len(item.strip())
                holder.own += size
                bodies = bodies or (size > 0 and inside)
                continue
            if item.tag == "a" or is_boilerplate(item, inside, names):
                continue
            body = item.tag in ("article", "main")
            further = path_below(path, item)
            held = holder
            if (body and (not inside or item.tag == "article" and holder.tag == "main")) or (item.tag in CONTAINERS and not inside):
                held = Holder(further, item.tag)
                holder.below.append(held)
                made.append(held)
            stack.append((item, held, further, inside or body))
    scores: dict[str, int] = defaultdict(int)
    if bodies:
        for one in made[1:]:
            if one.own:
                scores[one.path] += one.own
        return dict(scores)
    for one in reversed(made):  # whatever is below a container was made after it
        one.total = one.own + sum(b.total for b in one.below)
    best = top
    while best.below:
        heaviest = max(best.below, key=lambda h: h.total)
        stray = STRAY * best.total if best.tag in ("body", "#page") else 0
        if best.own > stray or heaviest.total < MOST * best.total:
            break
        best = heaviest
    return {best.path: best.total} if best is not top and best.total else {}


def nodes_at(root: Node, path: str, names: bool = True) -> list[Node]:
    """Outermost containers with this generalised path, in page order, outside boilerplate."""
    found = []
    stack = [(root, "", False)]
    while stack:
        node, here, inside = stack.pop()
        if node.tag in CONTAINERS and here == path:
            found.append(node)
            continue
        inside = inside or node.tag in ("article", "main")
        below = [i for i in node.items if isinstance(i, Node) and not is_boilerplate(i, inside, names)]
        stack.extend((i, path_below(here, i), inside) for i in reversed(below))
    return found


def blocks_of(node: Node, names: bool = True) -> list[str]:
    """Texts of the blocks below a container, each with single spaces."""
    blocks, held = [], []

    def flush():
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            blocks.append(text)

    stack: list = [(node, True)]
    while stack:
        item, enters = stack.pop()
        if isinstance(item, str):
            held.append(item)
        elif not enters:
            flush()
        elif item.tag == "br":
            held.append(" ")
        elif item is node or not is_boilerplate(item, True, names):
            if item.tag in BLOCKS:
                flush()
                stack.append((item, False))
            stack.extend((i, True) for i in reversed(item.items))
    flush()
    return blocks


def best_path(scores: dict[str, int]) -> str | None:
    return max(scores, key=lambda p: (scores[p], -len(p), p), default=None)


def main_text(html: str, path: str | None) -> str:
    """Text at the host's path, or at the page's own best path if the host's is not on the page.

    Where the names of classes and ids would leave a page without any text, they are not heeded.
    """
    root = parse(html)
    nodes = nodes_at(root, path) if path else []
    texts = [b for n in nodes for b in blocks_of(n)]
    for names in (True, False):
        if not texts:
            own = best_path(candidate_scores(root, names))
            nodes = nodes_at(root, own, names) if own else [root]
            texts = [b for n in nodes or [root] for b in blocks_of(n, names)]
    return "\n\n".join(texts)


def url_host(url: Column) -> Column:
    """Lower-case host without port; empty where there is none."""
    found = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(found, F.lit(""))


def host_paths(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(host, path, votes): the winning path of every host.

    Each page gives 1000 votes, in proportion to the text its containers hold. Votes are whole numbers, so the sums do not
    depend on the order; ties go to the shorter path, then to the larger name.
    """

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes: dict[tuple[str, str], int] = defaultdict(int)
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                scores = candidate_scores(parse(html.as_py() or ""))
                total = sum(scores.values())
                for path, score in scores.items():
                    votes[host, path] += 1000 * score // total
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in votes], pa.string()),
                    pa.array([k[1] for k in votes], pa.string()),
                    pa.array(list(votes.values()), pa.int64()),
                ],
                names=["host", "path", "votes"],
            )

    cast = pages.select(url_host(F.col(url_column)).alias("host"), F.col(html_column).alias("html"))
    summed = (
        cast.mapInArrow(voted, "host string, path string, votes bigint")
        .groupBy("host", "path")
        .agg(F.sum("votes").alias("votes"))
    )
    order = F.struct("votes", (-F.char_length("path")).alias("shorter"), "path")
    return summed.groupBy("host").agg(F.max(order).alias("w")).select("host", "w.path", "w.votes")


def extract_text(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """(id, url, text, path): the main text of every page, and its host's winning path.

    Hosts that hold more than 1/``HOT_HOSTS`` of all pages are fewer than ``HOT_HOSTS`` whatever the table: their paths are
    broadcast, so that the pages of a very common host are not moved at all. The others meet their path in a join by host.

    Defined cases: a null or empty page has the empty text; a page without a host votes with all others
    of that kind; a page without any container gives all its text outside boilerplate; repeated rows vote and are
    returned once each; an empty table gives an empty table; other columns are not read. Long and deeply nested pages are
    read whole, in time and memory in proportion to their length: 100,000 open elements take some two seconds.
    """
    winners = written(host_paths(pages, url_column, html_column), "paths")
    id_type = pages.schema[id_column].dataType.simpleString()
    cast = pages.select(
        F.col(id_column).alias("id"),
        F.col(url_column).alias("url"),
        F.col(html_column).alias("html"),
        url_host(F.col(url_column)).alias("__host"),
    )
    sizes = cast.groupBy("__host").agg(F.count(F.lit(1)).alias("n"))
    total = pages.count()
    named = winners.select(F.col("host").alias("__host"), "path")
    hot = written(sizes.where(F.col("n") * HOT_HOSTS > total).select("__host").join(named, "__host", "left"), "hosts")
    common = cast.join(F.broadcast(hot), "__host").select("id", "url", "path", "html")
    rest = cast.join(F.broadcast(hot.select("__host")), "__host", "left_anti").join(named, "__host", "left")
    met = common.unionByName(rest.select("id", "url", "path", "html"))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(2).to_pylist()
            texts = [main_text(h.as_py() or "", p) for h, p in zip(batch.column(3), paths, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), batch.column(2)],
                names=[id_column, url_column, "text", "path"],
            )

    return met.mapInArrow(extracted, f"`{id_column}` {id_type}, `{url_column}` string, text string, path string")
