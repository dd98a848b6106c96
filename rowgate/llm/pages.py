"""Main text of web pages: blocks are labelled content or boilerplate by a minimum cut."""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose content is no text of the page; the first three run to the end of the page if unclosed.
RAW = ("script", "style", "textarea")
SKIPPED = (*RAW, "template", "noscript", "iframe", "object", "svg", "select")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({'|'.join(SKIPPED)})(?![\w:-])((?:\"[^\"]*\"|'[^']*'|[^'\">])*|[^>]*)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<[!?/][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_ENDS = {tag: re.compile(rf"</{tag}\s*>", re.IGNORECASE) for tag in SKIPPED}
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)

#: Elements that begin a block, elements without an end tag, and what ends an open element of a kind.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre "
    "section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}

#: Elements and words in class, id and role that speak against or for main text.
AGAINST = frozenset("head nav footer aside form menu dialog button label fieldset option".split())
FOR = frozenset("article main".split())
NAMES_AGAINST = frozenset(
    "ad ads adsense advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice pagination "
    "popup promo promoted recommended related reply respond share sharing sidebar signup social sponsor sponsored "
    "subscribe toolbar widget complementary contentinfo search".split()
)
NAMES_FOR = frozenset("article body content entry main post story text".split())


@dataclass
class Block:
    """Words of one block, the numbers of its enclosing elements, and what tells content from boilerplate."""

    text: str
    path: tuple[int, ...]
    tag: str
    linked: int
    against: bool
    inside: bool
    named: bool


def blocks(html: str) -> list[Block]:
    """The text blocks of a page in order. Broken markup is read as far as it goes: a paragraph ends where another
    block begins, end tags without a start are skipped, and what is left open ends with the page. An embedded element
    without an end tag is its tag alone, unless it holds raw text."""
    out: list[Block] = []
    # (tag, number, against, inside an article, named like content)
    stack: list[tuple[str, int, bool, bool, bool]] = [("", 0, False, False, False)]
    parts: list[str] = []
    linked, in_link, number, at = 0, False, 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(parts)).split())
        if text:
            tag, _, against, inside, named = stack[-1]
            out.append(Block(text, tuple(s[1] for s in stack), tag, min(linked, len(text)), against, inside, named))
        parts.clear()
        linked = 0

    def text_until(stop: int) -> None:
        nonlocal linked
        if stop > at:
            parts.append(html[at:stop])
            if in_link:
                linked += stop - at

    unclosed: set[str] = set()
    while token := _TOKEN.search(html, at):
        text_until(token.start())
        at = token.end()
        if token[1]:
            tag = token[1].lower()
            empty = tag == "svg" and token[2].endswith("/")
            if not empty and tag not in unclosed:
                stop = _ENDS[tag].search(html, at)
                if stop:
                    at = stop.end()
                elif tag in RAW:
                    at = len(html)
                else:
                    unclosed.add(tag)  # nor has any later one an end
            continue
        tag = (token[4] or "").lower()
        if not tag:
            continue
        end = token[3] == "/"
        if tag == "a":
            in_link = not end
        elif tag == "br":
            parts.append(" ")
        if tag not in BLOCKS:
            continue
        flush()
        if end:
            depth = max((i for i, s in enumerate(stack) if s[0] == tag), default=0)
            if depth:
                del stack[depth:]
            in_link = False
            continue
        if stack[-1][0] == "p":
            stack.pop()
        over = _CLOSES.get(tag)
        while over and stack[-1][0] in over:
            stack.pop()
        if tag in VOID:
            continue
        words = set()
        for found in _NAMES.finditer(token[5]):
            words |= set(re.split(r"[^a-z0-9]+", (found[1] or found[2] or found[3] or "").lower()))
        _, _, against, inside, named = stack[-1]
        number += 1
        # Names of the page as a whole, or of its article, say what else is on the page.
        whole = tag in FOR or tag in ("html", "body")
        against = against or tag in AGAINST or (tag == "header" and not inside)
        against = against or (not whole and bool(words & NAMES_AGAINST))
        stack.append((tag, number, against, inside or tag in FOR, named or bool(words & NAMES_FOR)))
    text_until(len(html))
    flush()
    return out


def evidence(block: Block) -> float:
    """Above zero for content, below for boilerplate: the capacity that ties a block to that side of the cut."""
    size = len(block.text)
    value = min(math.log1p(size) / 2, 3) - 1.5
    value += 1.5 if block.tag in ("p", "pre", "blockquote") or block.tag[:1] == "h" and block.tag[1:].isdigit() else -0.5
    value += 4 * block.inside + 2 * block.named - 12 * block.against
    value -= 4 * (block.linked / size)
    return value - 3 * ("©" in block.text)


def edges(found: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness: neighbours on the page, the more the deeper the element they share, and the first blocks of
    neighbouring elements of one parent."""
    out = []
    first: dict[int, int] = {}
    for i, block in enumerate(found):
        if i:
            a, b = found[i - 1].path, block.path
            shared = sum(1 for x, y in zip(a, b, strict=False) if x == y)
            out.append((i - 1, i, 0.5 + shared / max(len(a), len(b))))
        parent = block.path[-2] if len(block.path) > 1 else 0
        if parent in first and first[parent] < i - 1:
            out.append((first[parent], i, 0.5))
        first[parent] = i
    return out


def minimum_cut(gain: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source. ``gain`` above zero is a node's capacity from the source, below zero to the
    sink; ``links`` hold in both directions.

    Flow goes from nodes with gain left to nodes with loss left along shortest open paths. Once no gain can reach a
    node, none can reach those that lead to it either, so they are not searched again.
    """
    left = list(gain)
    room: list[dict[int, float]] = [{} for _ in gain]
    for a, b, capacity in links:
        room[a][b] = room[a].get(b, 0.0) + capacity
        room[b][a] = room[b].get(a, 0.0) + capacity
    closed = [False] * len(gain)
    for sink in range(len(gain)):
        while left[sink] < 0 and not closed[sink]:
            toward, queue, source = {sink: sink}, deque([sink]), -1
            while queue and source < 0:
                node = queue.popleft()
                for other in room[node]:
                    if other not in toward and not closed[other] and room[other][node] > 1e-12:
                        toward[other] = node
                        if left[other] > 0:
                            source = other
                            break
                        queue.append(other)
            if source < 0:
                for node in toward:
                    closed[node] = True
                break
            path, flow = [source], min(left[source], -left[sink])
            while path[-1] != sink:
                step = toward[path[-1]]
                flow = min(flow, room[path[-1]][step])
                path.append(step)
            for a, b in zip(path, path[1:], strict=False):
                room[a][b] -= flow
                room[b][a] += flow
            left[source] -= flow
            left[sink] += flow
            left[sink] = 0.0 if left[sink] > -1e-12 else left[sink]
            left[source] = 0.0 if left[source] < 1e-12 else left[source]
    keep = [value > 0 for value in left]
    queue = deque(i for i, k in enumerate(keep) if k)
    while queue:
        node = queue.popleft()
        for other, capacity in room[node].items():
            if capacity > 1e-12 and not keep[other]:
                keep[other] = True
                queue.append(other)
    return keep


def main_text(html: str | None) -> str:
    """The content blocks of a page, joined by an empty line."""
    found = blocks(html or "")
    keep = minimum_cut([evidence(b) for b in found], edges(found))
    return "\n\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for each row of ``pages``.

    Pages have no labels to learn from, so a block's evidence is a sum of fixed weights: its length, its element, links
    in it, and the elements, classes and ids around it. The cut weighs that against neighbours with the other label.
    Character references are decoded and white space inside a block becomes one space.

    Null and empty pages, and pages without content, give the empty text. Rows may repeat and ids may be null. Other
    columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [main_text(html.as_py()) for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
