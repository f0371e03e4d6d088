"""Main text of web pages by consensus host paths.

1. Every page is parsed to a light tree and its containers are scored, those of one generalised path together: the path is
   the chain of tags with their classes (ids, for containers without classes), digits made '#', kept as a chained hash.
   The page votes for its best path, and names the paths of the containers that stand beside it.
2. Spark adds up the votes by (host, path). A host keeps every path that VOTE_SHARE of its pages voted for, with its side
   blocks: what stands beside it on SIDE_SHARE of its pages belongs to the template, not to an article.
3. Pages are parsed again and the text is taken from the first of their host's paths, most votes first, that with its side blocks
   covers KEEP_SHARE of the clean text outside links of the page's own best path; a page without one uses its own best. All elements of
   the path count, so an article in several parts stays whole; beside containers that are no explicit article, the headings, paragraphs
   and other text directly around them belong to it.

Text inside the container: navigation, headers, footers, asides, notices, adverts, forms, scripts, styles and comments are
left out, by element, role or class word. A block element ends a block; inside one, white space becomes one space. Tags and
attributes are cut as the HTML standard does: a quote inside a name or an unquoted value is an ordinary character, and a value whose
quote never closes swallows the rest of the page.

Defined results: a null or empty html, and a page without text, have an empty text; a null url belongs to the host '';
pages of any length and depth are parsed whole, in time that grows with their length; elements that a truncated page leaves open
are closed at its end; paths of equal votes go by their hash; repeated rows give repeated results; a null or very large page_id stays
as it is; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from hashlib import blake2b

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, cut, hot_join, table

#: Share of its host's pages that a path must win, of a path's pages that a side block must stand on, and of the page's own best text to be covered.
VOTE_SHARE, SIDE_SHARE, KEEP_SHARE = 0.01, 0.5, 0.9
#: Elements without a class count as parts of one article from this share of the largest on.
PART_SHARE = 0.25
#: Parts into which the pages of a host are dealt where the host paths are too many to be broadcast.
SALTS = 64

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
SKIPPED = frozenset(
    "head script style noscript template title textarea xmp iframe noembed noframes object svg math canvas audio video select option button input form fieldset nav aside footer dialog menu".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
CONTAINERS = frozenset("article main section div td body center table tbody tr".split())
#: A start tag of the key closes an open one of the values, unless one of the limits is in between.
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
SCOPES = frozenset("html body table td th caption article section div main nav aside footer header form button object template".split())

NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form status note".split())
#: Class and id words of what is not the article.
NOISE_WORDS = frozenset(
    """ad ads adbox advert adverts advertisement advertising adsense adslot banner banners breadcrumb breadcrumbs byline-share comment comments commentlist
    commenting disqus respond replies reply cookie cookies consent gdpr notice notices alert alerts warning-bar nav navbar navigation menu menus topnav subnav
    sidebar sidebars side-bar rail aside footer foot foot-links header masthead topbar toolbar share sharing social related recommended recommendations
    recirc more-stories newsletter signup subscribe subscription promo promos promotion promoted sponsor sponsored popup modal overlay lightbox widget
    widgets pagination pager paginator skip skiplink tags taglist login search searchform form copyright colophon outbrain taboola hidden sr-only""".split()
)
_NOISE_START = ("advert", "cookie", "breadcrumb", "sidebar", "newsletter", "sponsor", "navbar", "comment", "subscri", "disqus")
GOOD_WORDS = frozenset("article content entry post story body text main prose page-content article-body post-content entry-content".split())

# A tag's attributes by the HTML standard: names end at white space, '/', '>' or '='; only a value's first character can open a quote.
_VALUE = r"""(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)"""
_TOKEN = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?:[!?]|/(?![a-zA-Z]))[^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+{_VALUE}?+)?+)*+)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"?|'([^']*+)'?|([^\s>"'][^\s>]*+))?+)?+""")
_WORDS = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


class Node:
    """An element: its children are elements and strings (raw text between tags)."""

    __slots__ = ("tag", "attributes", "children", "parent", "noise", "in_article", "path", "length", "linked")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list = []
        self.noise, self.path = False, ""
        self.in_article = parent is not None and (parent.in_article or parent.tag == "article")
        self.length = self.linked = 0

    def words(self) -> list[str]:
        a = self.attributes
        return [w.lower() for w in _WORDS.split(a.get("class", "") + " " + a.get("id", "")) if w] if a else []


def _attributes(source: str) -> dict[str, str]:
    if not source or source.isspace() or source == "/":
        return {}
    out: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), entities.unescape(double or single or bare))
    return out


def is_noise(node: Node) -> bool:
    """Whether the element is no part of an article, by its tag, role, state or class words."""
    tag, a = node.tag, node.attributes
    if tag in SKIPPED:
        return True
    if tag == "header":  # a page's header goes; an article's own header may hold its heading
        return not node.in_article
    if not a or tag in ("html", "body", "article", "main"):
        return False
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or a.get("role", "").lower() in NOISE_ROLES:
        return True
    if "style" in a and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a["style"], re.I):
        return True
    if "class" in a or "id" in a:
        names = (a.get("class", "") + " " + a.get("id", "")).lower().split()
        return any(w in NOISE_WORDS for w in names) or any(w in NOISE_WORDS or w.startswith(_NOISE_START) for w in node.words())
    return False


def parse(source: str) -> Node:
    """A light tree of the page: void and raw elements, implied end tags, unmatched end tags ignored."""
    root = Node("#root", {}, None)
    here, at, size = root, 0, len(source)
    opened: dict[str, int] = {}  # open elements by tag, so that a tag that is not open is not looked for
    search = _TOKEN.search

    def leave(until: Node) -> Node:
        n = here
        while n is not until:
            opened[n.tag] -= 1
            n = n.parent
        return until

    while at < size:
        m = search(source, at)
        if m is None:
            here.children.append(source[at:])
            break
        if m.start() > at:
            here.children.append(source[at : m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        tag = name.lower()
        if m.group(1):
            up: Node | None = here if opened.get(tag) else None
            while up is not None and up.tag != tag:
                # an end tag does not reach out of the containers around it
                up = None if up.tag in ("td", "th", "table", "article", "body") and tag not in SCOPES else up.parent
            if up is not None and up.parent is not None:
                here = leave(up.parent)
            elif tag == "p":
                here.children.append(Node("p", {}, here))
            continue
        if tag in CLOSES_P:
            if opened.get("p"):
                here = leave(_close(here, {"p"}, SCOPES))
        elif tag in CLOSES:
            here = leave(_close(here, *CLOSES[tag]))
        node = Node(tag, _attributes(m.group(3)), here)
        node.noise = is_noise(node)
        here.children.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
            at = end.end() if end else size
            continue
        if not m.group(3).endswith("/") or tag not in ("svg", "math"):
            here = node
            opened[tag] = opened.get(tag, 0) + 1
    return root


def _close(here: Node, tags: set[str], limits: frozenset | set) -> Node:
    """The parent of the nearest open element of tags, or here if a limit comes first."""
    up: Node | None = here
    while up is not None and up.parent is not None:
        if up.tag in tags:
            return up.parent
        if up.tag in limits:
            return here
        up = up.parent
    return here


def _measure(node: Node, linked: bool = False) -> None:
    """Clean text lengths (and those in links) of every element."""
    stack = [(node, linked, False)]
    while stack:
        n, in_link, back = stack.pop()
        if back:
            for c in n.children:
                if type(c) is Node and not c.noise:
                    n.length += c.length
                    n.linked += c.linked
            continue
        stack.append((n, in_link, True))
        for c in n.children:
            if type(c) is Node:
                if not c.noise:
                    stack.append((c, in_link or c.tag == "a", False))
            else:
                k = len(c.strip())
                n.length += k
                if in_link:
                    n.linked += k


def step_of(node: Node) -> str:
    """The element's step in a generalised path."""
    if not node.attributes:
        return node.tag
    marks = sorted({_DIGITS.sub("#", c.lower()) for c in node.attributes.get("class", "").split()})
    if not marks and "id" in node.attributes and node.tag in CONTAINERS:
        marks = [_DIGITS.sub("#", node.attributes["id"].lower())]
    return ".".join([node.tag, *marks])


def is_explicit(node: Node) -> bool:
    """Whether the page itself calls the element its article."""
    a = node.attributes
    return node.tag in ("article", "main") or a.get("role", "").lower() in ("main", "article") or a.get("itemprop", "") == "articleBody"


def weight_of(node: Node) -> float:
    """What tag and class words say about an element."""
    weight = {"article": 1.6, "main": 1.3, "body": 0.9, "#root": 0.8, "table": 0.9, "tr": 0.8, "tbody": 0.9}.get(node.tag, 1.0)
    if node.attributes:
        if node.attributes.get("role", "").lower() in ("main", "article") or node.attributes.get("itemprop", "") == "articleBody":
            weight *= 1.4
        elif node.tag not in ("body", "article") and any(w in GOOD_WORDS for w in node.words()):
            weight *= 1.2
    return weight


class Group:
    """The containers of one generalised path: prose is their clean text outside links, score that times their weight."""

    __slots__ = ("path", "depth", "nodes", "prose", "score")

    def __init__(self, path: str, depth: int, nodes: list[Node]) -> None:
        if len(nodes) > 1 and "." not in step_of(nodes[0]) and nodes[0].tag != "article":
            # without a class in common only large ones that are no link lists are parts of one article
            most = max(n.length - n.linked for n in nodes)
            nodes = [n for n in nodes if n.length - n.linked >= PART_SHARE * most and n.length >= 2 * n.linked] or nodes
        self.path, self.depth, self.nodes = path, depth, nodes
        self.prose = sum(n.length - n.linked for n in nodes)
        self.score = self.prose * weight_of(nodes[0])


def path_groups(root: Node) -> list[Group]:
    """All container paths with clean text, best first; of equal scores the deeper one, as the others are wrappers of it."""
    _measure(root)
    found: dict[bytes, tuple[int, list[Node]]] = {}
    stack = [(root, 0, b"")]
    while stack:
        n, depth, path = stack.pop()
        if n.tag != "#root":
            path = blake2b(path + step_of(n).encode(errors="replace"), digest_size=8).digest()
        if n.length and (n.tag in CONTAINERS or n.tag == "#root"):
            n.path = path.hex()
            found.setdefault(path, (depth, []))[1].append(n)
        stack += [(c, depth + 1, path) for c in reversed(n.children) if type(c) is Node and c.length and not c.noise]
    groups = [Group(path.hex(), depth, nodes) for path, (depth, nodes) in found.items()]
    groups.sort(key=lambda g: (-g.score, -g.depth, g.path))
    return groups


def region(group: Group) -> list:
    """The path's elements, and what belongs to them beside them: text that is in no container of its own."""
    first = group.nodes[0]
    parent = first.parent
    if parent is None or is_explicit(first) or first.tag in ("td", "tr", "tbody", "#root", "body") or any(n.parent is not parent for n in group.nodes):
        return group.nodes
    own = set(map(id, group.nodes))
    beside = lambda c: type(c) is str or id(c) in own or (c.tag not in CONTAINERS and not c.noise and (c.length > 2 * c.linked or not c.length))
    return [c for c in parent.children if beside(c)]


def beside(root: Node, group: Group) -> dict[str, int]:
    """Clean text outside links that the group's region leaves out: by the path of the outermost containers it is in, '' for none."""
    kept, around = set(map(id, region(group))), set()
    for n in group.nodes:
        up = n.parent
        while up is not None and id(up) not in around:
            around.add(id(up))
            up = up.parent
    out: dict[str, int] = {}
    stack = [root] if id(root) in around else []
    while stack:
        n = stack.pop()
        for c in n.children:
            if id(c) in kept:
                continue
            if type(c) is str:
                if not c.isspace():
                    out[""] = out.get("", 0) + len(c.strip())
            elif c.length > c.linked and not c.noise:
                if id(c) in around:
                    stack.append(c)
                else:
                    out[c.path] = out.get(c.path, 0) + c.length - c.linked
    return out


def text_of(nodes: list) -> str:
    """Blocks of the elements and strings in page order, joined by single spaces."""
    blocks: list[str] = []
    part: list[str] = []

    def end() -> None:
        if part:
            text = " ".join(entities.unescape("".join(part)).split())
            if text:
                blocks.append(text)
            part.clear()

    stack: list = list(reversed(nodes))
    while stack:
        n = stack.pop()
        if n is None:
            end()
        elif type(n) is str:
            part.append(n)
        elif not n.noise:
            if n.tag == "header":  # an article's header: only its headings
                stack += [None, *reversed(_headings(n)), None]
                continue
            block = n.tag in BLOCKS
            if block:
                stack.append(None)
            stack += reversed(n.children)
            if block:
                stack.append(None)
    end()
    return " ".join(blocks)


def _headings(node: Node) -> list[Node]:
    """The headings inside an element, in page order."""
    out, stack = [], [node]
    while stack:
        n = stack.pop()
        if n.tag in HEADINGS:
            out.append(n)
        else:
            stack += [c for c in reversed(n.children) if type(c) is Node and not c.noise]
    return out


def vote(source: str | None) -> tuple[str, list[str]] | None:
    """The path of the page's best containers and those of the containers beside it; none for a page without text."""
    root = parse(source) if source else None
    found = path_groups(root) if root else []
    return (found[0].path, [p for p in beside(root, found[0]) if p]) if found and found[0].prose else None


def extract(source: str | None, paths: list[dict] | None) -> str:
    """The page's main text, by the first of the host's paths (path, sides) that covers enough of it."""
    root = parse(source) if source else None
    found = path_groups(root) if root else []
    if not found:
        return ""
    best = found[0]
    chosen = best
    by_path = {g.path: g for g in found} if paths else {}
    for p in paths or ():
        group = by_path.get(p["path"])
        if group is None:
            continue
        if group is not best and group.prose < KEEP_SHARE * best.prose:
            left, sides = beside(root, group), set(p["sides"])
            if group.prose + sum(n for path, n in left.items() if path in sides) < KEEP_SHARE * best.prose:
                continue
        chosen = group
        break
    return text_of(region(chosen))


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m.group(1).lower() if m else ""


def host_paths(pages: DataFrame) -> DataFrame:
    """host and paths (path, sides): the generalised paths that win VOTE_SHARE of its pages, most votes first, with their side blocks.

    Votes are added up in each task first. A host has 1 / VOTE_SHARE paths at most.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: dict[tuple[str, str, str], int] = {}
            for url, source in zip(batch["url"], batch["html"]):
                ballot = vote(source if isinstance(source, str) else None)
                if ballot is not None:
                    host = host_of(url if isinstance(url, str) else None)
                    for side in ("", *ballot[1]):
                        rows[host, ballot[0], side] = rows.get((host, ballot[0], side), 0) + 1
            yield pd.DataFrame([(*k, n) for k, n in rows.items()], columns=["host", "path", "side", "n"])

    cast = pages.select("url", "html").mapInPandas(run, "host string, path string, side string, n long")
    total = cut(cast.groupBy("host", "path", "side").agg(F.sum("n").alias("n")))
    wins = total.where("side = ''").select("host", "path", F.col("n").alias("wins"))
    hosts = wins.groupBy("host").agg(F.sum("wins").alias("pages"), F.count("*").alias("n_paths"))
    kept = cut(hot_join(wins, hosts, "host", "n_paths", 96).where(F.col("wins") >= F.lit(VOTE_SHARE) * F.col("pages")).select("host", "path", "wins"))
    key = F.concat_ws("\0", "host", "path").alias("key")
    rows = total.where("side <> ''").groupBy("host", "path").agg(F.count("*").alias("n_sides")).join(kept, ["host", "path"])
    sides = hot_join(total.where("side <> ''").select(key, "side", "n"), rows.select(key, "wins", "n_sides"), "key", "n_sides", 160)
    sides = sides.where((F.col("n") >= 2) & (F.col("n") >= F.lit(SIDE_SHARE) * F.col("wins"))).groupBy("key").agg(F.sort_array(F.collect_list("side")).alias("sides"))
    named = kept.withColumn("key", key).join(sides, "key", "left")
    order = F.sort_array(F.collect_list(F.struct((-F.col("wins")).alias("minus"), "path", F.coalesce("sides", F.array().cast("array<string>")).alias("sides"))))
    return named.groupBy("host").agg(F.transform(order, lambda s: F.struct(s["path"].alias("path"), s["sides"].alias("sides"))).alias("paths"))


def with_paths(pages: DataFrame, winners: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """pages (with host) and their host's paths; beyond limit bytes of paths a host's pages are dealt to SALTS tasks, which all get its paths."""
    size = winners.agg(F.count("*").alias("n"), F.max(F.length(F.to_json("paths"))).alias("longest")).first()
    if size["n"] * (64 + 2 * (size["longest"] or 0)) <= limit:
        return pages.join(F.broadcast(winners), "host", "left")
    dealt = winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("page_id", "url", F.length("html")), F.lit(SALTS)).cast("int")
    return pages.withColumn("salt", salt).join(dealt, ["host", "salt"], "left").drop("salt")


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row of pages (page_id, url, html). Ids cross to Python as text, since numbers beside nulls would turn to floats there."""
    winners = cut(host_paths(pages))
    host = F.lower(F.coalesce(F.nullif(F.regexp_extract("url", _HOST.pattern, 1), F.lit("")), F.lit("")))
    joined = with_paths(pages.select(F.col("page_id").cast("string").alias("page_id"), "url", "html", host.alias("host")), winners)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [extract(h if isinstance(h, str) else None, None if p is None else list(p)) for h, p in zip(batch["html"], batch["paths"])]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    found = joined.select("page_id", "url", "html", "paths").mapInPandas(run, "page_id string, url string, text string, n_chars long")
    return found.withColumn("page_id", F.col("page_id").cast("long"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"))


QUERIES = {"op3_main_text": op3_main_text}
ORACLES: dict[str, str] = {}
