"""Main text of web pages, with site templates removed.

Block elements are hashed with all that is in them. Spark counts within how many different contents of a host each hash
occurs, so that copies of a page count once; those within many are the site's template and are deleted, besides what
tags, roles and class names say is no part of the article.
"""

from __future__ import annotations

import functools
import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Collection, Iterator
from operator import and_

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnwork.session import materialise

#: Elements of HTML by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
DROPPED = frozenset(
    "script style textarea title noscript template iframe xmp noembed noframes head nav footer aside form button select "
    "option svg canvas object audio video dialog menu".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
BLOCKS = CLOSES_P | frozenset("li dt dd tr td th caption body html tbody thead tfoot".split())
SELF_CLOSING = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that may be templates, as opposed to running text.
CONTAINERS = frozenset("div section ul ol dl table header article main center details fieldset".split())
#: Words of class names, ids and roles that mark what is no part of an article.
CHROME = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments disqus replies reply respond "
    "related recommended pagination pager toolbar widget complementary contentinfo search skip dialog form".split()
)
#: Of these, words that also name what an article is about: with others beside them they count only where most text is links.
_TOPICS = frozenset("menu share sharing related search form skip social alert".split())
#: Words beside them that say that a part of the layout is meant after all.
_CONTROLS = frozenset("bar block box btn button buttons container count icon icons left link links list main panel right site tools top widget wrap wrapper".split())
#: Words before another that say what a layout has or lacks: "with-sidebar" is no sidebar.
_STATES = frozenset("has with no not without is".split())
# Quotes count after an equals sign only; a value without them ends at white space or the end of the tag.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+))*+)>|<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)""", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    """An element: tag, attributes' source and children, which are nodes and texts."""

    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []


def _tokens(page: str) -> Iterator[tuple[str, bool, str, str]]:
    """Text, or tag: (text, closing?, name, attributes). A tag that the page ends within is left out."""
    at = search = 0
    while True:
        start = page.find("<", search)
        if start < 0:
            break
        match = _TAG.match(page, start) or _LOOSE.match(page, start)
        if not match:
            if start + 1 < len(page) and (page[start + 1].isalpha() or page[start + 1] in "/!?"):
                if page[start + 1] == "/" and start + 2 < len(page) and not page[start + 2].isalpha():
                    search = start + 1
                    continue
                yield page[at:start], False, "", ""
                return
            search = start + 1
            if search >= len(page):
                break
            continue
        if start > at:
            yield page[at:start], False, "", ""
        at = search = match.end()
        name = (match[2] or "").lower()
        if not name:
            continue
        yield "", bool(match[1]), name, match[3]
        if name in RAW and not match[1]:
            end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            at = search = end.start() if end else len(page)
    if at < len(page):
        yield page[at:], False, "", ""


def parse(page: str) -> Node:
    """Tree of a page; end tags that are left out are put where HTML implies them."""
    root = Node("#")
    stack = [root]
    unclosed: Counter[str] = Counter()

    def close(names: Collection[str], until: Collection[str] = ()) -> None:
        if not any(unclosed[name] for name in names):  # an end tag without a start is not looked for
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                unclosed.subtract(n.tag for n in stack[i:])
                del stack[i:]
                return
            if stack[i].tag in until:
                return

    for text, closing, name, attributes in _tokens(page):
        if not name:
            stack[-1].children.append(text)
        elif closing:
            close((name,), () if name in BLOCKS else ("td", "th", "article", "main", "body"))
        else:
            if name in CLOSES_P:
                close(("p",), ("td", "th", "li", "div", "article", "section", "button", "body"))
            if name in SELF_CLOSING:
                close((name,) if name not in ("dt", "dd") else ("dt", "dd"), SELF_CLOSING[name])
            node = Node(name, attributes)
            stack[-1].children.append(node)
            if name not in VOID and not attributes.rstrip().endswith("/"):
                stack.append(node)
                unclosed[name] += 1
    return root


def subtree_hashes(root: Node) -> dict[int, int]:
    """Signed 64-bit hash of each element that may be a template, by ``id`` of the node: tags, attributes and texts."""
    found: dict[int, int] = {}
    # Children before parents, without recursion: pages may be nested deeply.
    order, pending = [], [root]
    while pending:
        node = pending.pop()
        order.append(node)
        pending += [c for c in node.children if isinstance(c, Node)]
    digests: dict[int, bytes] = {}
    for node in reversed(order):
        own = hashlib.blake2b(f"{node.tag} {node.attributes}".encode(), digest_size=8)
        for child in node.children:
            own.update(digests[id(child)] if isinstance(child, Node) else b"#" + " ".join(child.split()).encode())
        digests[id(node)] = own.digest()
        if node.tag in CONTAINERS:
            found[id(node)] = int.from_bytes(own.digest(), "little", signed=True)
    return found


def _hidden(node: Node) -> bool:
    if not node.attributes or node.tag in ("html", "body", "article", "main") and "class" not in node.attributes:
        return False
    for match in _ATTRIBUTE.finditer(node.attributes):
        name, value = match[1].lower(), match[2] or match[3] or match[4] or ""
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def _marks(node: Node) -> int:
    """How surely class, id or role say that this is no part of an article: 0 not, 1 by a word that may be its topic, 2 among
    other words, 3 alone.

    Ids of headings and sections are titles and say nothing.
    """
    found = 0
    if not node.attributes or node.tag in ("html", "body"):
        return found
    for match in _ATTRIBUTE.finditer(node.attributes):
        name, value = match[1].lower(), match[2] or match[3] or match[4] or ""
        if name not in ("class", "id", "role") or name == "id" and (node.tag in HEADINGS or node.tag == "section"):
            continue
        for token in value.split():
            words = [word.lower() for word in _NAME.findall(token)]
            marks = CHROME.intersection(words)
            if marks and words[0] not in _STATES:
                topic = marks <= _TOPICS and not marks.issuperset(words) and not _CONTROLS.intersection(words)
                found = max(found, 3 if words == [value.lower()] else 1 if topic else 2)
    return found


def _is_main(node: Node) -> bool:
    return node.tag == "main" or bool(re.search(r"role\s*=\s*[\"']?main\b", node.attributes))


def chrome(root: Node) -> set[int]:
    """``id`` of the elements to delete with all that is in them, by attributes.

    Hidden ones; and those marked by class, id or role, unless they hold the main element, the page's title (``h1``), all
    its articles, or, where the mark is not the only word, over half of the text of their article or else of the page. Where
    the mark may be a topic, as in "recipe-menu", half of an element's text within an article must be links as well.
    """
    gone: set[int] = set()
    order, pending = [], [(root, root)]
    while pending:
        node, region = pending.pop()
        if node.tag in DROPPED or _hidden(node):
            gone.add(id(node))
            continue
        if region is root and (node.tag == "article" or _is_main(node)):
            region = node
        order.append((node, region, _marks(node)))
        pending += [(c, region) for c in node.children if isinstance(c, Node)]
    sizes: dict[int, int] = {}
    titles: dict[int, bool] = {}
    articles: dict[int, int] = {}
    links: dict[int, int] = {}
    for node, _, marks in reversed(order):
        inner = [c for c in node.children if isinstance(c, Node) and id(c) not in gone]
        sizes[id(node)] = sum(sizes[id(c)] for c in inner) + sum(len(" ".join(c.split())) for c in node.children if isinstance(c, str))
        titles[id(node)] = any(titles[id(c)] or c.tag == "h1" or _is_main(c) for c in inner)
        articles[id(node)] = sum(articles[id(c)] for c in inner) + (node.tag == "article" and not marks)
        links[id(node)] = sizes[id(node)] if node.tag == "a" else sum(links[id(c)] for c in inner)
    for node, region, marks in order:
        if not marks or _is_main(node) and marks < 3 or titles[id(node)]:
            continue
        if marks == 1 and region is not root and region is not node and 2 * links[id(node)] < sizes[id(node)]:
            continue
        if articles[id(node)] and articles[id(node)] == articles[id(root)]:
            continue
        # An article is measured by the page, all else by the article or main that it is in.
        whole = sizes[id(root)] if region is node else sizes[id(region)]
        if marks == 3 or 2 * sizes[id(node)] <= whole:
            gone.add(id(node))
    return gone


def tree_contexts(root: Node) -> dict[int, int]:
    """For each hash of a subtree that may be a template, a hash of the texts around it.

    Around are the other texts of its outermost article or main, else of the page, in any order. Of several places
    within the page one counts.
    """
    hashes, gone, order, pending = subtree_hashes(root), chrome(root), [], [(root, root)]
    while pending:
        node, region = pending.pop()
        if id(node) in gone:
            continue
        if region is root and (node.tag == "article" or _is_main(node)):
            region = node
        order.append((node, region))
        pending += [(c, region) for c in node.children if isinstance(c, Node)]
    sums: dict[int, int] = {}
    for node, _ in reversed(order):
        total = 0
        for child in node.children:
            if isinstance(child, Node):
                total += sums.get(id(child), 0)
            elif text := " ".join(child.split()):
                total += int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little")
        sums[id(node)] = total % 2**64
    found: dict[int, int] = {}
    for node, region in order:
        if id(node) in hashes:
            around = (sums[id(region)] - sums[id(node)]) % 2**64 - 2**63
            found[hashes[id(node)]] = min(around, found.get(hashes[id(node)], around))
    return found


def main_text(page: str | None, templates: Collection[int] = ()) -> str:
    """The article's blocks, joined by two line breaks.

    The article is the longest ``article``, unless the longest ``main`` holds more than twice its text, else the body. Headings, paragraphs, list items
    and cells of an article are its text however often they recur; other blocks in ``templates`` are deleted.
    """
    if not page:
        return ""
    root = parse(page)
    hashes, gone = subtree_hashes(root) if templates else {}, chrome(root)
    candidates: dict[str, list[Node]] = {"article": [], "main": []}
    pending = [root]
    while pending:
        node = pending.pop()
        if id(node) in gone:
            continue
        if node.tag == "article" or _is_main(node):
            candidates["article" if node.tag == "article" else "main"].append(node)
        pending += [c for c in node.children if isinstance(c, Node)]
    article, main = (
        max((_blocks(n, templates, hashes, gone, True) for n in nodes), key=len, default="") for nodes in candidates.values()
    )
    if any(candidates.values()):
        return article if 2 * len(article) >= len(main) else main
    return _blocks(root, templates, hashes, gone, False)


def _blocks(top: Node, templates: Collection[int], hashes: dict[int, int], gone: Collection[int], in_article: bool) -> str:
    blocks: list[str] = []
    run: list[str] = []

    def end() -> None:
        text = " ".join(entities.unescape("".join(run)).split())
        run.clear()
        if text:
            blocks.append(text)

    pending: list[Node | str | None] = [top]
    while pending:
        item = pending.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            run.append(item)
        elif item.tag == "br":
            run.append(" ")
        else:
            if item is not top and (id(item) in gone or hashes.get(id(item)) in templates and hashes):
                end()
                continue
            if item.tag == "header" and not (in_article and _has_heading(item)):
                end()
                continue
            edge = [None] if item.tag in BLOCKS else []
            pending += [*edge, *reversed(item.children), *edge]
    end()
    return "\n\n".join(blocks)


def _has_heading(node: Node) -> bool:
    pending = [c for c in node.children if isinstance(c, Node)]
    while pending:
        child = pending.pop()
        if child.tag in HEADINGS:
            return True
        pending += [c for c in child.children if isinstance(c, Node)]
    return False


def host_of(url: str):
    """Lower-case host name of an address; null if it has none."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.nullif(host, F.lit(""))


def extract(
    pages: DataFrame, html: str = "html", url: str = "url", key: str = "page_id", min_pages: int = 5
) -> DataFrame:
    """Key, url, ``text`` (empty if none) and ``n_chars`` of every row.

    An element's subtree is a template if it occurs within ``min_pages`` different contents of its host: copies of a page
    or an article count once, however many, and keep their text. In an article only containers are deleted as such,
    never paragraphs, headings or the article itself. Null html is an empty page; null or odd addresses share one host. Rows with
    equal columns get equal results; other columns are ignored.
    """
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"),
        F.coalesce(host_of(url), F.lit("")).alias("host"),
    ).withColumn("digest", F.xxhash64("html"))
    kind = rows.schema["key"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(tree_contexts(parse(p)).items()) for p in batch.column("html").to_pylist()]
            columns = [batch.column(n) for n in ("key", "url", "host", "digest")]
            columns += [pa.array([[pair[k] for pair in pairs] for pairs in found], pa.list_(pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "url", "host", "digest", "trees", "around"])

    schema = f"key {kind}, url string, host string, digest bigint, trees array<bigint>, around array<bigint>"
    trees = materialise(rows.select("key", "url", "host", "digest", "html").mapInArrow(hashed, schema), "trees")
    seen = trees.select("host", F.inline(F.arrays_zip("trees", "around"))).toDF("host", "tree", "around").distinct()
    often = seen.groupBy("host", "tree").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages)
    often = materialise(often.select("host", "tree"), "templates")
    same = ["key", "url", "digest"]
    hits = trees.select(*same, "host", F.explode("trees").alias("tree")).join(often, ["host", "tree"])
    hits = materialise(hits.groupBy(*same).agg(F.collect_set("tree").alias("templates")), "hits")
    other = hits.toDF(*(f"_{c}" for c in same), "templates")
    joined = rows.join(other, functools.reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in same)), "left")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("html").to_pylist(), batch.column("templates").to_pylist(), strict=True)
            found = pa.array([main_text(p, frozenset(t or ())) for p, t in pairs], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("url"), found], ["key", "url", "text"])

    out = joined.select("key", "url", "html", "templates").mapInArrow(texts, f"key {kind}, url string, text string")
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))

