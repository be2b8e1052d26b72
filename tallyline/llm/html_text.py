"""Main text of web pages by composite text density.

A page is read into a tree of block elements (inline elements belong to the block around them; links
are counted). For every node: characters, tags, characters in links and link tags of its subtree give
its density, the characters per tag adjusted by how much of them are links. A node's sum is the sum of
its children's densities; the node with the greatest sum, and the least density on its path from the
body as a threshold, mark the content: within every topmost node of at least that density, the
descendant with the greatest sum. Elements that are never part of an article (menus, forms, scripts and
the like, by tag, role or class name) are left out before; but a form, or an element that only its class or
id names furniture, stays where it holds most of the body's unlinked text. Where the page says which part is the article
(``article`` or ``main``) and the greatest sum lies in it, or around it with most of its unlinked text in
it, that part is taken whole; articles that are a lesser part of the content, such as teasers, stay in it.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard, and words sites name their furniture with.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
FURNITURE = frozenset(
    "head script style noscript template iframe object embed svg math canvas audio video map nav footer aside form "
    "button select option textarea input label fieldset dialog menu noembed noframes".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar toolbar dialog alert alertdialog status".split()
)
NAMES = re.compile(
    r"(?<!\S)(?:(?!(?:has|no|not|with|without)[_-])\S*?[_-])?(?:ads?|advert|adverts|advertisement|adsense|banner|breadcrumbs?|comments?|commentlist|cookies?|disqus|"
    r"footer|gdpr|masthead|menu|menus|modal|nav|navbar|navigation|newsletter|notices?|pagination|popup|promo|related|"
    r"replies|respond|share|sharing|sidebar|signup|skip|social(?![_-](?:sciences?|stud|hist|theor|polic|work|secur|justice))|sponsored|sponsor|subscribe|toolbar|widget)(?:$|[\s_-])"
)
# A content element's class may say where its sidebar is.
LAYOUT = re.compile(r"(?<!\S)(?:left|right|one|two|both|dual)[_-]sidebars?(?!\S)")
CONTENT = re.compile(r"(?<!\S)(?:content|main|article|post|entry|page|primary|wrap|wrapper|container|layout|site)(?!\S)")
# Comments may be longer than the article, so they must hold nearly all text to stay.
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|replies|respond)(?:$|[\s_-])")
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
ARTICLES = frozenset(["article", "main"])
LINE = 80  # unlinked characters under which density says little: there a third of them is most
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
# An open element of the left name ends before one of the right names begins, up to its container.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

TOKEN = re.compile(
    r"<!--(?:.*?-->|>|.*\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>?|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
BLANKS = re.compile(r"[ \t\n\r\f\v]+")


class Node:
    __slots__ = ("tag", "children", "chars", "tags", "link_chars", "link_tags", "density", "sum", "dropped", "doubt", "parts", "parent")

    def __init__(self, tag: str, parent: Node | None, dropped: bool, doubt: float | None = None):
        self.tag, self.parent, self.dropped, self.doubt = tag, parent, dropped, doubt
        self.children: list[Node] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0
        self.parts: list[str | Node] = []  # text pieces and children in page order


def furniture(tag: str, attributes: str, inside: list[Node]) -> float | None:
    """None: not furniture. Otherwise the share of the body's unlinked text that an element must exceed to
    stay; 1 where it goes in any case."""
    if tag in FURNITURE and tag != "form":
        return 1.0
    if tag == "header" and not any(node.tag in ARTICLES for node in inside):
        return 1.0
    found = 0.5 if tag == "form" else None
    if not attributes or tag in ("html", "body", "header"):
        return found
    named = {"class": "", "id": ""}
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return 1.0
        if name == "role" and value in ROLES:
            return 1.0
        if name in named and tag not in ARTICLES:
            named[name] = value
    for value in named.values():
        if value and NAMES.search(value):
            if LAYOUT.search(value) and CONTENT.search(" ".join(named.values())):
                value = LAYOUT.sub("", value)
                if not NAMES.search(value):
                    continue
            found = max(found or 0.0, 0.9 if COMMENTS.search(value) else 0.5)
    return found


def settle(root: Node) -> None:
    """Drop the elements in doubt that don't hold their share of the body's unlinked text."""
    order = [root]
    for node in order:
        order.extend(c for c in node.children if not c.dropped)
    if not any(node.doubt for node in order):
        return
    held: dict[int, int] = {}
    for node in reversed(order):
        own = sum(len(p.strip()) for p in node.parts if isinstance(p, str)) - node.link_chars
        held[id(node)] = own + sum(held.get(id(c), 0) for c in node.children)
    total = held[id(next((n for n in order if n.tag == "body"), root))]
    # Beside an article the page marks as such, an element must hold nearly all text.
    marked = any(n.tag in ARTICLES and held[id(n)] and not any(m.doubt for m in above(n)) for n in order)
    for node in order:
        if node.doubt and held[id(node)] <= max(node.doubt, 0.9 if marked else 0) * total:
            node.dropped = True


def parse(page: str) -> Node:
    """The tree of a page; text of dropped elements is not kept. Unclosed elements end with their
    container, stray end tags are passed over."""
    root = Node("html", None, False)
    stack, at, links = [root], 0, 0
    of_page: list[int] = []

    def text(raw: str) -> None:
        node = stack[-1]
        if not raw or node.dropped:
            return
        node.parts.append(html.unescape(raw) if "&" in raw else raw)
        if links:
            node.link_chars += len(raw.strip())

    def end(upto: int) -> None:
        del stack[upto:]

    while at < len(page):
        found = TOKEN.search(page, at)
        if not found:
            text(page[at:])
            break
        text(page[at : found.start()])
        at = found.end()
        closing, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in ("p", "br"):
                stack[-1].parts.append(" ")
            if tag not in INLINE and tag not in VOID:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        end(k)
                        links = 0 if tag not in INLINE else links
                        break
            continue
        if tag in RAW:
            done = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
            at = done.end() if done else len(page)
            continue
        if tag in INLINE:
            # Inline elements that are left out (by class or role) are skipped.
            share = furniture(tag, attributes, stack)
            done = skip(page, at, tag, stack) if share and tag not in FURNITURE else at
            if share and share < 1 and done - at >= LINE:
                of_page = of_page or [bare(page)]
                if bare(page[at:done]) > share * of_page[0]:
                    share = None
            if not share:
                if tag == "a":
                    links += 1
                    stack[-1].link_tags += 1
                    stack[-1].tags += 1
                continue
            if tag not in FURNITURE:
                at = done
                continue
        if tag in VOID:
            stack[-1].parts.append(" ")
            continue
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    end(k)
                    break
                if stack[k].tag in ("button", "table", "td", "th", "li", "div", "article", "section", "body"):
                    break
        if tag in ENDS:
            ended, within = ENDS[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in within:
                    break
                if stack[k].tag in ended:
                    end(k)
                    break
        if tag == "body" and any(n.dropped or n.doubt for n in stack):
            end(1)
        parent = stack[-1]
        share = None if parent.dropped else furniture(tag, attributes, stack)
        node = Node(tag, parent, parent.dropped or share == 1, share)
        parent.children.append(node)
        parent.parts.append(node)
        stack.append(node)
        links = 0
    settle(root)
    return root


def tags_of(page: str, at: int) -> Iterator[tuple[re.Match, bool, str]]:
    """The tags from ``at`` on: match, whether it is an end tag, name. What raw elements hold is passed over."""
    while found := TOKEN.search(page, at):
        at = found.end()
        closing, tag = (found[1], found[2]) if found[2] else (found[4], found[5])
        if not tag:
            continue
        yield found, bool(closing), tag.lower()
        if not closing and tag.lower() in RAW:
            done = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
            at = done.start() if done else len(page)


def skip(page: str, at: int, tag: str, stack: list[Node]) -> int:
    """The place after the end tag of an inline element that began before ``at``. One without an end tag in
    its block ends where the next block begins or ends."""
    depth, blocks, first = 1, [], None
    outer = {node.tag for node in stack}
    for found, closing, name in tags_of(page, at):
        if name == tag:
            depth += -1 if closing else 1
            if depth == 0:
                return found.end()
        if name in INLINE or name in VOID or name in RAW:
            continue
        if first is None and (not closing or name in outer):
            first = found.start()
        if not closing:
            if not blocks and (
                name in CLOSES_P and stack[-1].tag == "p" or name in ENDS and stack[-1].tag in ENDS[name][0]
            ):
                break
            blocks.append(name)
        elif name in blocks:
            while blocks.pop() != name:
                pass
        elif name in outer:
            break
    return len(page) if first is None else first


def bare(page: str) -> int:
    """Characters outside tags, links and raw elements."""
    count, at, links = 0, 0, 0
    for found, closing, name in tags_of(page, 0):
        if not links and at <= found.start():
            count += len(page[at : found.start()].strip())
        at = found.end()
        if name == "a":
            links = max(0, links - 1) if closing else links + 1
        elif not closing and name in RAW:
            done = re.compile(f"</{name}(?=[\\s/>])", re.I).search(page, at)
            at = done.start() if done else len(page)
    return count + (0 if links else len(page[at:].strip()))


def measure(root: Node) -> list[Node]:
    """Fill in counts, densities and sums; all kept nodes, parents before children."""
    order = [root]
    for node in order:
        node.children = [c for c in node.children if not c.dropped]
        node.parts = [p for p in node.parts if isinstance(p, str) or not p.dropped]
        order.extend(node.children)
    for node in reversed(order):
        node.chars = sum(len(p.strip()) for p in node.parts if isinstance(p, str)) + sum(c.chars for c in node.children)
        node.tags += sum(c.tags + 1 for c in node.children)
        node.link_chars += sum(c.link_chars for c in node.children)
        node.link_tags += sum(c.link_tags for c in node.children)
    body = next((n for n in order if n.tag == "body"), root)
    share = body.link_chars / max(body.chars, 1)
    for node in reversed(order):
        node.density = density(node, share)
        node.sum = sum(c.density for c in node.children)
    return order


def density(node: Node, share: float) -> float:
    """Characters per tag, lowered by the share of links; ``share`` is that of the whole body."""
    if not node.chars:
        return 0.0
    plain = max(node.chars - node.link_chars, 1)
    base = math.log(node.chars / plain * node.link_chars + share * node.chars + math.e)
    ratio = node.chars / max(node.link_chars, 1) * max(node.tags, 1) / max(node.link_tags, 1)
    return node.chars / max(node.tags, 1) * max(math.log(max(ratio, 1.0)), 1e-3) / math.log(max(base, 1 + 1e-9)) if base > 1 else node.chars / max(node.tags, 1)


def content_of(root: Node) -> list[Node]:
    """The nodes that make up the article, in page order."""
    order = measure(root)
    if not root.chars:
        return []
    best = max(order, key=lambda n: n.sum)
    if best.sum == 0:
        best = max(order, key=lambda n: n.density)
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    named = [n for n in path if n.tag in ARTICLES]
    if named:
        return [named[-1]]
    inside = [n for n in below(best) if n.tag in ARTICLES and n.chars]
    outer = [n for n in inside if not any(m.tag in ARTICLES for m in above(n))]
    if outer and (2 if plain(best) >= LINE else 3) * sum(map(plain, outer)) > plain(best):
        return outer
    threshold = min(n.density for n in path if n.tag != "html" or len(path) == 1)
    taken, open_nodes = [], [root]
    while open_nodes:
        node = open_nodes.pop()
        if node.density >= threshold and node.chars and node.tag not in ("html", "body") or node is best:
            inner = max([node, *below(node)], key=lambda n: n.sum)
            taken.append(inner if inner.sum > node.density else node)
        else:
            open_nodes.extend(reversed(node.children))
    return taken or [best]


def plain(node: Node) -> int:
    """Characters outside links."""
    return node.chars - node.link_chars


def below(node: Node) -> list[Node]:
    order = [node]
    for n in order:
        order.extend(n.children)
    return order[1:]


def above(node: Node) -> list[Node]:
    found = []
    while node.parent is not None:
        node = node.parent
        found.append(node)
    return found


def text_of(node: Node) -> str:
    """Blocks in page order, each end of a block a space."""
    out, todo = [], [node]
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            out.append(part)
        elif part.tag == "header":
            out.append(" ")
            todo.extend(reversed([n for n in below(part) if n.tag in HEADINGS]))
        else:
            todo.append(" ")
            todo.extend(reversed(part.parts))
            out.append(" ")
    return "".join(out)


def main_text(page: str | None) -> str:
    """The article of a page; empty for null, empty and article-less pages."""
    if not page:
        return ""
    return BLANKS.sub(" ", " ".join(text_of(n) for n in content_of(parse(page)))).strip(" ")


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars``.

    Null and empty html give an empty text; repeated rows are read each; other columns are ignored; an
    empty table gives an empty result. Pages stay where they are read: nothing is shuffled."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(
        _extractor(), f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )


def _extractor() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = [main_text(page.as_py()) for page in batch.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return run
