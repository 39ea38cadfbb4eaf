"""Operator 2: main text of web pages by composite text density.

A tolerant parser makes the page a tree. Elements that never hold an article (scripts, styles, forms, menus, page
headers and footers, sidebars), and elements whose class, id or role says notice, advert, menu, comment or the like,
go first. A class of several words, such as alert-box, and a form remove no element that holds half of the page's text or more; one that
names comments does, unless the page's title or main element is in it. Inside an article (by its name, or a class such as post), classes of
paragraphs and headings remove nothing. For every node left, with C characters, T tags, LC link characters and LT link tags, the composite density is

    C / T * log(C * T / (LC * LT)) to the base of (C * LC / (C - LC) + LC_body * C / C_body + e)

where no divisor is below 1. A node's score is the sum of its children's densities. The node of the highest score
leads; the smallest density on its path from the body is the threshold, and the article is the subtree of the lowest
ancestor that holds every sibling region of at least that density. All text of that subtree is kept, block by block.

A null or empty page, and a page without text, gives the empty string. Unclosed, misnested and stray tags are mended
as browsers do for the common cases; whatever the page, parsing takes one pass and the tree one more.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

# Names of the HTML standard, and words that sites use in class, id and role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp plaintext".split())
NO_TEXT = frozenset("script style noscript template iframe noembed noframes head title nav footer aside form button select textarea input svg canvas object audio video dialog menu".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body html br caption td th tr tbody thead tfoot option".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th")}
SCOPES = frozenset("table ul ol dl div article section main body html td th select blockquote".split())
UNWANTED = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion promoted menu nav navbar navigation breadcrumb breadcrumbs sidebar aside footer masthead cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup login share sharing social related recommended recommendations popup modal overlay comment comments respond disqus reply replies pagination pager toolbar skip copyright".split()
)
STATES = frozenset("has with no without is js open of for and hoc".split())  # classes with one of them tell of a page's state, or are phrases
COMMENTS = frozenset("comment comments respond disqus reply replies".split())
POSTS = frozenset("post entry article story hentry".split())  # a class of just one of them is an article's
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre em strong b i code cite q".split())  # in an article, their classes say how text looks
ARTICLES = frozenset("article main section".split())
UNWANTED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
#: One attribute with its value; values are taken whole, so what stands in them is no attribute.
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s\"'>]+))?")
WORDS = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("name", "parent", "items", "chars", "tags", "link_chars", "link_tags", "density", "score", "gone", "doubtful", "post", "titled")

    def __init__(self, name: str, parent: "Node | None", gone: bool, doubtful: int = 0):
        self.name, self.parent, self.gone, self.doubtful = name, parent, gone, doubtful
        self.post = parent is not None and parent.post or name in ARTICLES  #: whether it is in an article, by name or class
        self.titled = False
        self.items: list = []  # texts and nodes, in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.score = 0.0


GONE, TALK, DOUBTFUL, STAYS = 3, 2, 1, 0


def _unwanted(name: str, attributes: dict[str, str], in_article: bool) -> int:
    if name == "form":
        return DOUBTFUL  # some sites wrap their pages in one
    if name in NO_TEXT or name == "header" and not in_article:
        return GONE
    if not attributes or name in ("html", "body", "article", "main"):
        return STAYS
    out = STAYS
    for key, value in attributes.items():
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in UNWANTED_ROLES:
            return GONE
        if key in ("class", "id") and not (in_article and name in RUNNING):
            for token in value.split():
                words = WORDS.findall(token)
                if not STATES.intersection(words) and any(w in UNWANTED or w == "header" and not in_article for w in words):
                    out = max(out, GONE if len(words) == 1 else TALK if COMMENTS.intersection(words) else DOUBTFUL)
    return out


def _attributes(text: str) -> dict[str, str]:
    """Attributes of a tag that tell what it is, in lower case; of a repeated one the first."""
    out: dict[str, str] = {}
    for key, value in ATTRIBUTE.findall(text):
        if (key := key.lower()) in ("class", "id", "role", "hidden", "aria-hidden"):
            out.setdefault(key, value.strip("\"'").lower())
    return out


def parse(page: str) -> Node:
    root = Node("html", None, False)
    stack, opened, at = [root], {"html": 1}, 0

    def close(names: tuple, scope: frozenset) -> None:
        """Ends the innermost open element of these names, if no element of scope stands between."""
        if not any(opened.get(n) for n in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name in names:
                for node in stack[k:]:
                    opened[node.name] -= 1
                del stack[k:]
                return
            if stack[k].name in scope:
                return

    while True:
        found = TOKEN.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text:
            stack[-1].items.append(text)
        if not found:
            return root
        at, name = found.end(), found[2]
        if not name:
            continue
        name = name.lower()
        if found[1]:
            close((name,), frozenset(("table",)) if name not in ("table", "html", "body", "article", "main", "section", "div") else frozenset())
            continue
        if name in CLOSES_P:
            close(("p",), SCOPES)
        for sibling in SIBLINGS.get(name, ()):
            close((sibling,), SCOPES - {"td", "th", name})
        if name == "html" or name == "body" and opened.get("body"):
            continue
        here = stack[-1]
        attributes = _attributes(found[3]) if found[3] else {}
        says = _unwanted(name, attributes, here.post)
        node = Node(name, here, here.gone or says == GONE, 0 if says == GONE else says)
        node.post = node.post or not POSTS.isdisjoint(attributes.get("class", "").split())
        node.titled = name in ("h1", "main")
        here.items.append(node)
        if name in VOID or (found[3] or "").endswith("/") and name in ("svg", "path"):
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            node.items.append(page[at : end.start()] if end else page[at:])
            at = end.end() if end else len(page)
            continue
        stack.append(node)
        opened[name] = opened.get(name, 0) + 1


def settle(root: Node) -> None:
    """Removes doubtful elements, but for those that hold half of the page's text or more; comments go whatever they hold, unless a page's title or main element is in them."""
    nodes = _order(root)
    for node in reversed(nodes):
        node.chars += sum(len(" ".join(x.split())) for x in node.items if isinstance(x, str))
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.titled |= node.titled
    most = root.chars / 2
    for node in nodes:
        node.gone = node.gone or node.doubtful == TALK and not node.titled or node.doubtful == DOUBTFUL and node.chars < most
        node.chars = 0


def _order(root: Node) -> list[Node]:
    """All nodes that stay, parents before children."""
    out, at = [root], 0
    while at < len(out):
        out += [x for x in out[at].items if isinstance(x, Node) and not x.gone]
        at += 1
    return out


def measure(root: Node) -> list[Node]:
    nodes = _order(root)
    for node in reversed(nodes):
        own = sum(len(" ".join(x.split())) for x in node.items if isinstance(x, str))
        node.chars += own
        if node.name == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    body = next((n for n in nodes if n.name == "body"), root)
    body_ratio = body.link_chars / max(1, body.chars)
    for node in nodes:
        c, t, lc, lt = node.chars, max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
        if c:
            base = math.log(c / max(1, c - node.link_chars) * node.link_chars + body_ratio * c + math.e)
            node.density = c / t * max(0.0, math.log(max(1.0, c * t / (lc * lt)))) / base
    for node in nodes:
        node.score = sum(x.density for x in node.items if isinstance(x, Node) and not x.gone) + (node.density if any(isinstance(x, str) and x.strip() for x in node.items) else 0.0)
    return nodes


def article(root: Node) -> Node:
    """The subtree that holds the article."""
    settle(root)
    nodes = measure(root)
    best = max(nodes, key=lambda n: (n.score, n.chars))
    path = [best]
    while path[-1].parent is not None and path[-1].name != "body":
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    # where the densest node is in an article or main element, that element is the region
    for n in path:
        if n.name in ("article", "main"):
            return n
    # siblings of the path that are as dense as the threshold belong to the article
    for up in reversed(path[1:]):
        dense = [x for x in up.items if isinstance(x, Node) and not x.gone and x.chars and x.density >= threshold]
        if len(dense) > 1:
            return up
    return best


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks, now = [], []

    def flush() -> None:
        text = " ".join("".join(now).split())
        if text:
            blocks.append(text)
        now.clear()

    stack: list = [article(parse(page))]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            now.append(entities.unescape(item))
        elif item is None:
            flush()
        elif not item.gone:
            block = item.name in BLOCK
            if block:
                flush()
                stack.append(None)
            stack += reversed(item.items)
    flush()
    return "\n".join(blocks)


def _texts(batches):
    for batch in batches:
        texts = [main_text(x) for x in batch.column(batch.schema.get_field_index("html")).to_pylist()]
        keep = [batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """pages: page_id, url, html. Returns page_id, url, text, n_chars for each page. No shuffle; a page is worked on alone."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(_texts, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
