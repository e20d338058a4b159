"""Main text of web pages by tree scoring (operator 7).

A page becomes a tree of elements and its text blocks. Every block gives points for its length and commas to its container, half of them
to the container's parent and less to those above; a container's points are discounted by its link density. The best container is kept
with those of its siblings that score or read like it; what is kept never includes navigation, notices, forms and the like.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import slices

_ATTRIBUTES = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+"
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*+)({_ATTRIBUTES})>|<[!?/][^>]*+>", re.S)
_NAMES = re.compile(r"(?<![\w-])(class|id|role|style|hidden|aria-hidden|type)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+", re.I)

# Element names of the HTML standard, and words that name parts of a page that are not its article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
TEXTUAL = frozenset("p pre blockquote dd dt li td th h1 h2 h3 h4 h5 h6 figcaption summary address caption".split())
DROPPED = frozenset("head script style title noscript template nav footer aside form button select textarea input iframe object embed svg canvas audio video dialog menu frameset noframes noembed".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPE = frozenset("table ul ol dl div section article body html main td th".split())
UNWANTED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adsense|banners?|breadcrumbs?|combx|comments?|commentlist|community|consent|cookies?|disqus|disclaimer|footers?|gdpr|headers?|hidden|legal|login|masthead|menus?|modal|nav|navbar|navigation|newsletter|notices?|pager|pagination|popups?|promos?|promoted|promotion|recommended|related|replies|reply|respond|sharing|share|shoutbox|sidebars?|signup|site-?header|social|sponsors?|sponsored|subscribe|subscription|tags|teaser|toc|toolbar|widgets?)(?:$|[\s_-])|comment-?list|side-?bar|cookie|advert",
    re.I,
)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I) for tag in RAW}
#: A block gives points to so many of the elements that it lies in.
LEVELS = 8
#: Share of the best container's score with which an article or main element around it takes its place.
NAMED = 0.5
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())


class _Node:
    __slots__ = ("tag", "parent", "dropped", "score", "text", "linked", "order")

    def __init__(self, tag: str, parent: _Node | None, dropped: bool, order: int):
        self.tag, self.parent, self.dropped, self.order = tag, parent, dropped, order
        self.score, self.text, self.linked = 0.0, 0, 0


def _names_unwanted(value: str, strict: bool) -> bool:
    """Whether a class or id names a part of a page that is not its article: by any word of it, or if strict only by names all of whose words do."""
    if not strict:
        return UNWANTED.search(value) is not None
    return any(all(UNWANTED.fullmatch(word) for word in re.split("[_-]+", name) if word) for name in value.split())


def _unwanted(tag: str, attributes: str, inside_article: bool, strict: bool) -> bool:
    if tag in DROPPED or (tag == "header" and not inside_article):
        return True
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return False
    for name, a, b, c in _NAMES.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name in ("class", "id") and tag not in ("html", "body", "article", "main") and _names_unwanted(value, strict):
            return True
        if name in ("class", "id") and tag == "article" and re.search(r"comment|reply|respond|advert|sponsor|promo|related", value, re.I):
            return True
    return False


class _Open:
    """The open elements, innermost last, with the places of each tag's: every question about them takes one step, however deep a page is."""

    def __init__(self, root: _Node):
        self.stack, self.places, self.blocks = [root], {}, []

    def last(self, *tags: str) -> int:
        """The place of the innermost open element with one of the tags, 0 if there is none."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=0)

    def block(self) -> int:
        """The place of the innermost open block element, 0 if there is none."""
        return self.blocks[-1] if self.blocks else 0

    def push(self, node: _Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        if node.tag in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append(node)

    def cut(self, to: int) -> None:
        """Closes the elements from place ``to`` on."""
        while len(self.stack) > to:
            self.places[self.stack.pop().tag].pop()
        while self.blocks and self.blocks[-1] >= to:
            self.blocks.pop()


def _parse(page: str, strict: bool) -> tuple[list[_Node], list[tuple[_Node, str, int]]]:
    """The elements in page order, and the blocks (innermost block element, text, characters of it inside links); strict: see _names_unwanted."""
    root = _Node("", None, False, 0)
    nodes, blocks, opened = [root], [], _Open(root)
    parts: list[tuple[str, bool]] = []
    at = 0

    def close() -> None:
        nonlocal parts
        if parts:
            text = " ".join("".join(t for t, _ in parts).split())
            if text:
                blocks.append((opened.stack[opened.block()], text, sum(len(t) for t, linked in parts if linked)))
            parts = []

    def pop(to: int) -> None:
        if opened.block() >= to:
            close()
        opened.cut(to)

    def add(text: str) -> None:
        if text and not opened.stack[-1].dropped:
            parts.append((html.unescape(text), opened.last("a") > 0))

    last = page.rfind(">") + 1  # no markup ends after it, so none is looked for there
    for m in iter(lambda: _TOKEN.search(page, at, last), None):
        add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                at = len(page)
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not opened.last("p"):
                close()
            found = opened.last(tag)
            # an inline end tag doesn't reach out of the block element that it stands in
            if found and (tag in BLOCK or opened.block() < found):
                pop(found)
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID:
            if tag == "br":
                add("\n")
            elif tag in BLOCK:
                close()
            continue
        if tag in ("html", "body") and opened.last(tag):
            continue
        if tag in BLOCK:
            open_p = opened.last("p")
            if open_p and opened.last("table", "button", "object") < open_p:
                pop(open_p)
            ends = opened.last(*CLOSES.get(tag, ()))
            if ends and ends >= opened.last(*SCOPE):
                pop(ends)
            if tag != "head" and opened.last("head"):  # a head that was never closed
                pop(opened.places["head"][0])
            close()
        top = opened.stack[-1]
        dropped = top.dropped or _unwanted(tag, m[3], opened.last("article", "main") > 0, strict)
        node = _Node(tag, top, dropped, len(nodes))
        nodes.append(node)
        if not m[3].rstrip().endswith("/") or tag in BLOCK or tag == "a":
            opened.push(node)
    add(page[at:].split("<!--", 1)[0])
    close()
    return nodes, blocks


def main_text(page: str | None) -> str:
    """The blocks of a page's article, one a line; empty without any.

    The best container and those of its siblings that score or read like it are kept. An article or main element around the best container takes its place if it
    scores at least half as much, as with a title in a header of its own and all paragraphs in one section. Where nothing is left because some word
    of a class or id names something else (``legal-history``, ``community-garden``), only names all of whose words do are dropped. Takes time in proportion to the page.
    """
    return _scored(*_parse(page or "", False)) or _scored(*_parse(page or "", True))


def _scored(nodes: list[_Node], blocks: list[tuple[_Node, str, int]]) -> str:
    for node, text, linked in blocks:
        points = 1 + text.count(",") + min(len(text) / 100, 3.0)
        points *= 1 - min(1.0, linked / len(text))
        container, share = (node.parent or node) if node.tag in TEXTUAL else node, 1.0
        depth, up = 0, container
        while up is not None and depth < LEVELS:
            up.score += points * share
            depth, up = depth + 1, up.parent
            share = 0.5 if depth == 1 else 1 / (3 * depth)
        node.text, node.linked = node.text + len(text), node.linked + linked
    for n in reversed(nodes[1:]):  # what is inside an element comes after it
        n.parent.text, n.parent.linked = n.parent.text + n.text, n.parent.linked + n.linked
    for n in nodes:
        n.score *= (1 - n.linked / n.text if n.text else 0) * (1.5 if n.tag in ("article", "main") else 1)
    best = max(nodes, key=lambda n: (n.score, n.order))
    if not blocks or best.score <= 0:
        return ""
    around = best
    while around is not None and around.tag not in ("article", "main"):
        around = around.parent
    if around is not None and around.score >= NAMED * best.score:
        best = around
    kept = {best.order}
    if best.parent is not None:
        for n in nodes:
            if n.parent is best.parent and n is not best and n.text:
                density = n.linked / n.text
                if n.score >= max(10, 0.2 * best.score) or (n.tag in TEXTUAL and (density < 0.25 and n.text > 80 or density == 0)):
                    kept.add(n.order)
    inside = []
    for n in nodes:
        inside.append(n.order in kept or n.parent is not None and inside[n.parent.order])
    return "\n".join(text for node, text, _ in blocks if inside[node.order])


def extract(pages: DataFrame, page: str = "html") -> DataFrame:
    """pages with text (string, never null) and n_chars (its code points) after their other columns, in place of the column named by page.

    The whole page is read; a null one is empty and gives empty text, as does one without an article. Character references are decoded,
    white space inside a block becomes one space, blocks are joined by one line feed in page order. Columns of pages that are named text or
    n_chars are replaced. Repeated rows stay repeated; an empty table gives no rows.
    """
    keep = [c for c in pages.columns if c not in (page, "text", "n_chars")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "page"):
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array([main_text(p) for p in batch.column("page").to_pylist()], pa.string())], names=["row", "text"])

    # the other columns travel as one struct, so that no name of theirs can clash
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row") if keep else F.struct(F.lit(0)).alias("row"), F.col(page).cast("string").alias("page"))
    kind = rows.schema["row"].dataType.simpleString()
    found = rows.mapInArrow(each, f"row {kind}, text string")
    return found.select(*[F.col(f"row.`{c}`") for c in keep], "text", F.length("text").cast("bigint").alias("n_chars"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
