"""Main text of web pages: site templates are removed by recurring subtrees.

Every page is parsed to an element tree. Subtrees are hashed with their tags,
attributes and text, and Spark counts on how many pages of its host each hash
occurs. Subtrees that recur across many pages of a host are its template.
Pages of a host with the same text are copies and count as one page: what only
copies share is their article.

What is deleted: template subtrees, and elements whose tag, role, class or id
says that they are not the article (menus, headers, footers, sidebars, notices,
adverts, forms, comments, scripts). A class or id counts only as a whole word
whose head says so ("site-sidebar", "comment-list", not "no-sidebar" or
"related-work"), never for a paragraph, heading or list item, and never for the
element that alone holds the page's text: if names leave a page without text,
they are set aside. The <header> of an article holds its title and stays.

A page's article is its <article> elements and each <main> without one, else
its body. Inside an article a recurring paragraph, heading or list item is text
that several pages quote and stays; only recurring containers go. Elsewhere all
recurring blocks go. <html>, <body> and an element that alone holds all text of
the page or article are never template.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import Scratch, arrow_slices

MIN_PAGES = 5  # a template subtree occurs on at least so many pages of its host
MIN_SHARE = 0.1  # and on this share of them,
MANY_PAGES = 100  # or on so many, however large the host is

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg xmp".split())
DROPPED = RAW | frozenset("head nav header footer aside form button select dialog menu object canvas audio video".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img br".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption caption".split())
# a start tag that ends an open element of one of these tags
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
                   "main menu nav ol p pre section table ul".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
# a class or id whose head is one of these words, maybe with a plain word of layout behind it
NAMES = re.compile(r"(?:[a-z0-9]+[_-]+)*(?:ads?|advert|adverts|advertisement|advertising|sponsor|sponsors|sponsored|promo|promos|promotion|banner|nav|navbar|"
                   r"navigation|menu|breadcrumbs?|sidebar|header|footer|masthead|cookies?|consent|notice|popup|modal|newsletter|subscribe|signup|share|"
                   r"sharing|social|related|comments?|commentlist|respond|disqus|replies|pagination|pager|widget|skip|skiplink)"
                   r"(?:[_-]+(?:list|area|section|box|wrap|wrapper|container|block|bar|inner|items?|links?|thread|form|top|bottom|left|right|\d+))*", re.I)
NEGATIONS = ("no", "not", "has", "with", "without", "hide", "is")  # "no-sidebar" tells of a page without one
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|"
                    r"<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "attributes", "parts", "digest")

    def __init__(self, tag: str, attributes: dict[str, str]) -> None:
        self.tag, self.attributes, self.parts, self.digest = tag, attributes, [], 0


def parse(page: str | None) -> Node:
    """Element tree of a page; what is not well formed is closed where HTML implies it."""
    root = Node("#root", {})
    stack, text, at = [root], page or "", 0
    size = len(text)
    while at < size:
        less = text.find("<", at)
        if less < 0:
            stack[-1].parts.append(text[at:])
            break
        if less > at:
            stack[-1].parts.append(text[at:less])
        token = _TOKEN.match(text, less)
        if not token:
            stack[-1].parts.append("<")
            at = less + 1
            continue
        at = token.end()
        if token[1]:
            tag = token[1].lower()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
        elif token[2]:
            tag = token[2].lower()
            if tag in ENDS_P:
                _close(stack, {"p"})
            if tag in CLOSES:
                _close(stack, CLOSES[tag])
            attributes = {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in _ATTRIBUTE.finditer(token[3])} if token[3].strip() else {}
            node = Node(tag, attributes)
            stack[-1].parts.append(node)
            if tag in RAW:
                end = re.compile(f"</{re.escape(tag)}\\b[^>]*(?:>|\\Z)", re.I).search(text, at)
                node.parts.append(text[at:end.start() if end else size])
                at = end.end() if end else size
            elif tag not in VOID and not token[3].rstrip().endswith("/"):
                stack.append(node)
    return root


def _close(stack: list[Node], tags: set[str]) -> None:
    """End the nearest open element of ``tags`` if only inline elements or its own parts stand above it."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            del stack[k:]
            return
        if stack[k].tag not in INLINE and stack[k].tag not in ("td", "th"):
            return


def digest(root: Node) -> None:
    """Hash every subtree from its tag, attributes and children, white space runs counting as one space."""
    todo = [(root, False)]
    while todo:
        node, done = todo.pop()
        if not done:
            todo.append((node, True))
            todo += [(p, False) for p in node.parts if not isinstance(p, str)]
            continue
        state = xxhash.xxh64(node.tag, seed=7)
        for name in sorted(node.attributes):
            state.update(f"\x00{name}\x01{node.attributes[name]}")
        for part in node.parts:
            state.update("\x02" + " ".join(part.split()) if isinstance(part, str) else part.digest.to_bytes(8, "little"))
        node.digest = state.intdigest()


def named(node: Node) -> bool:
    """Whether a class or the id names something beside the article."""
    for word in (*node.attributes.get("class", "").split(), node.attributes.get("id", "")):
        if NAMES.fullmatch(word) and re.split("[_-]", word.lower())[0] not in NEGATIONS:
            return True
    return False


def boilerplate(node: Node, names: bool = True, inside: bool = False) -> bool:
    """Whether the element's own tag or attributes say that it isn't article text; ``inside``: it stands in an article."""
    if node.tag in DROPPED:
        return not (inside and node.tag == "header")
    a = node.attributes
    if not a or node.tag in ("html", "body", "article", "main"):
        return False
    if "hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in ROLES or _HIDDEN.search(a.get("style", "")):
        return True
    return names and node.tag not in PARAGRAPHS and named(node)


def article_roots(root: Node, names: bool = True) -> list[Node]:
    """The outermost <article> elements outside boilerplate and each <main> without one, in page order; else the whole page."""
    found: list[Node] = []
    holds: set[int] = set()  # <main> elements with an article inside
    todo: list[tuple[Node, Node | None]] = [(root, None)]
    while todo:
        node, main = todo.pop()
        if node.tag == "article":
            found.append(node)
            if main:
                holds.add(id(main))
            continue
        if node.tag == "main":
            found.append(node)
            main = node
        todo += [(p, main) for p in reversed(node.parts) if not isinstance(p, str) and not boilerplate(p, names)]
    return [n for n in found if id(n) not in holds] or [root]


def sole_containers(articles: list[Node], names: bool = True) -> set[int]:
    """Ids of the elements that alone hold all that an article or the page's body shows."""
    out = set()
    for node in articles:
        while node:
            shown = [p for p in node.parts if (p.strip() if isinstance(p, str) else not boilerplate(p, names, p.tag == "header" and node.tag in ("article", "main")) and shows_text(p, names))]
            body = [p for p in shown if not isinstance(p, str) and p.tag in ("html", "body")]
            node = body[0] if body else shown[0] if len(shown) == 1 and not isinstance(shown[0], str) else None
            out.add(id(node))
    return out


def shows_text(node: Node, names: bool = True) -> bool:
    """Whether an element holds text outside boilerplate."""
    todo = [node]
    while todo:
        for part in todo.pop().parts:
            if isinstance(part, str):
                if part.strip():
                    return True
            elif not boilerplate(part, names):
                todo.append(part)
    return False


def countable(root: Node) -> set[int]:
    """Hashes of the page's subtrees that can be template: blocks outside boilerplate, and containers inside the article."""
    digest(root)
    names = relies_on_names(root)
    roots = article_roots(root, names)
    articles = {id(x) for x in roots if x is not root}
    kept = articles | sole_containers(roots, names)
    out, todo = set(), [(root, False)]
    while todo:
        node, inside = todo.pop()
        inside |= id(node) in articles
        for part in node.parts:
            if not isinstance(part, str) and not boilerplate(part, names, inside):
                if part.tag not in INLINE and part.tag not in ("html", "body") and id(part) not in kept and not (inside and part.tag in PARAGRAPHS):
                    out.add(part.digest)
                todo.append((part, inside))
    return out


def main_text(page: str | None, template: frozenset[int] = frozenset()) -> str:
    """Article text of one page: blocks joined by line feeds, white space inside a block as one space."""
    root = parse(page)
    if template:
        digest(root)
    return text_of(root, template)


def relies_on_names(root: Node) -> bool:
    """Whether classes and ids may delete elements: not where that leaves a page without any of its text."""
    return bool(_text(root, frozenset(), True)) or not _text(root, frozenset(), False)


def text_of(root: Node, template: frozenset[int] = frozenset()) -> str:
    """``main_text`` of a parsed page, its subtrees hashed if there is a template."""
    return _text(root, template, relies_on_names(root))


def _text(root: Node, template: frozenset[int], names: bool) -> str:
    roots = article_roots(root, names)
    kept = sole_containers(roots, names) if template else set()
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(line)).split())
        if text:
            blocks.append(text)
        line.clear()

    for article in roots:
        inside = article is not root
        todo: list = [article]
        while todo:
            part = todo.pop()
            if part is None:
                flush()
            elif isinstance(part, str):
                line.append(part)
            elif part.tag == "br":
                line.append(" ")
            elif part is not article and (boilerplate(part, names, inside) or part.digest in template and part.tag not in INLINE
                                          and part.tag not in ("html", "body") and id(part) not in kept and not (inside and part.tag in PARAGRAPHS)):
                if part.tag not in INLINE and part.tag not in RAW:
                    flush()
            elif part.tag in INLINE:
                todo += reversed(part.parts)
            else:
                flush()
                todo.append(None)
                todo += reversed(part.parts)
        flush()
    return "\n".join(blocks)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, digest, page) of each page's subtrees, and once with no digest; copies have the same ``page``."""
    signed = lambda d: d - (1 << 64) if d >= 1 << 63 else d
    for part in arrow_slices(batches, "html", 1 << 22):
        hosts, digests, copies = [], [], []
        for host, page in zip(part.column(0).to_pylist(), part.column(1)):
            root = parse(page.as_py())
            own = countable(root)
            text = text_of(root)
            hosts += [host] * (len(own) + 1)
            digests += [None, *map(signed, own)]
            copies += [signed(xxhash.xxh64_intdigest(text) if text else root.digest)] * (len(own) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(digests, pa.int64()), pa.array(copies, pa.int64())],
                                         ["host", "digest", "page"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in arrow_slices(batches, "html", 1 << 22):
        texts = []
        for page, template in zip(part.column(2), part.column(3).to_pylist()):
            texts.append(main_text(page.as_py(), frozenset(d % (1 << 64) for d in template or ())))
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                         ["page_id", "url", "text", "n_chars"])


def host_of(url: str = "url") -> Column:
    """Lower-case host of a URL without user and port; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url).cast("string"), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def extract_main_text(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, many_pages: int = MANY_PAGES) -> DataFrame:
    """Rows (page_id, url, text, n_chars), one per row of ``pages`` (page_id, url, html).

    Null and empty pages, and pages without article text, have text '' and
    n_chars 0. Pages without a host (null or odd URL) share the empty host.
    Repeated rows stay and count as one page, like all pages of a host with
    the same text. Other columns are not read; an empty table gives no rows.

    Subtrees are told apart by page before they are counted, so copies and a
    host with most pages are no bottleneck. A host's template list holds at
    most the subtrees of its pages divided by the smaller of ``many_pages``
    and ``min_share`` of its pages.
    """
    scratch = Scratch(pages.sparkSession, "pages")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host_of().alias("host"))
    seen = scratch.table(rows.select("host", "html").mapInArrow(_subtrees, "host string, digest long, page long").distinct(), "subtrees")
    counts = scratch.table(seen.groupBy("host", "digest").agg(F.count(F.lit(1)).alias("n")), "counts")
    scratch.drop("subtrees")
    sizes = counts.where("digest IS NULL").select("host", F.col("n").alias("pages"))
    often = counts.where(F.col("digest").isNotNull() & (F.col("n") >= min_pages))
    template = often.join(sizes, "host").where((F.col("n") >= F.col("pages") * min_share) | (F.col("n") >= many_pages)).groupBy("host").agg(
        F.collect_list("digest").alias("template"))
    template = scratch.table(template, "template")
    return rows.join(template, "host", "left").select("page_id", "url", "html", "template").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long")
