"""Operator 5: main text of a page by minimum-cut labelling.

A page is read into blocks: runs of text between block-level tags, with the tags that contain them. A classifier gives each block
the cost of calling it boilerplate and of calling it content; these are its capacities from the source and to the sink. Neighbours
on the page, and blocks close together in the document tree, are tied by edges whose capacity is the price of labelling them
differently. The minimum cut is the labelling of least total cost, and what stays on the source's side is the main text.

The classifier adds two parts. Names that authors give to regions (``article``, ``nav``, class ``cookie-notice``, ...) are strong
evidence; the innermost named region counts. How blocks of such regions look (length, share of link text, sentence ends, tag) is
learned by a naive Bayes model on a bounded sample of pages, and decides where nobody named anything.

Cases: a null or empty page, and one with no content, gives an empty text; pages of any size are read whole; unclosed, stray and
truncated tags are tolerated; repeated rows are read each.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from linecross.llm.common import map_batches

#: Elements of HTML by what they mean here.
NEVER_TEXT = frozenset("script style template noscript head title iframe object svg canvas audio video select textarea button datalist math".split())
RAW = frozenset("script style title textarea iframe noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meta link nobr output q rp rt ruby s "
                   "samp small source span strike strong sub sup time tt u var wbr input".split())
CONTENT_TAGS = frozenset("article main".split())
BOILER_TAGS = frozenset("nav footer header aside form menu dialog fieldset".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
CONTENT_NAMES = frozenset("article content main post entry story body text prose".split())
BOILER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menus breadcrumb "
    "breadcrumbs header masthead topbar footer bottom copyright legal sidebar aside rail widget widgets related recommended popular trending "
    "more notice notices cookie cookies consent gdpr popup modal overlay alert newsletter subscribe subscription signup login share sharing "
    "social comment comments commentlist respond reply replies disqus discussion form search toolbar pagination pager tags meta skip".split())
#: An open element that a start tag of the key ends, as end tags of these may be left out.
ENDS = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"),
        "th": ("td", "th", "p"), "option": ("option",)}
_SCOPES = frozenset("ul ol dl table div section article main nav aside header footer body form td th".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(?=[a-zA-Z/!])[^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.S)
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")

#: Log-odds that a named region gives; learned evidence is held below it.
NAMED, LEARNED = 6.0, 2.0
#: Prices of different labels for neighbours of one parent, other neighbours, and blocks two apart in one parent.
TIE_PARENT, TIE_NEXT, TIE_NEAR = 0.8, 0.3, 0.4


class Block:
    __slots__ = ("text", "named", "parent", "tag", "linked")

    def __init__(self, text: str, named: int, parent: int, tag: str, linked: int):
        self.text, self.named, self.parent, self.tag, self.linked = text, named, parent, tag, linked


def _evidence(tag: str, attributes: str) -> int:
    """1 for a region named as content, -1 as boilerplate, -2 for one that is never shown, 0 for no name."""
    if tag in NEVER_TEXT:
        return -2
    found = -1 if tag in BOILER_TAGS else 1 if tag in CONTENT_TAGS else 0
    if attributes and "=" in attributes or "hidden" in attributes:
        for name, a, b, c, hidden in _ATTRIBUTE.findall(attributes):
            value = a or b or c
            name = name.lower()
            if hidden or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return -2
            if name == "role" and value.lower() in BOILER_ROLES:
                return -1
            if name in ("class", "id") and tag not in ("html", "body"):
                names = {n.lower() for n in _NAME.findall(value)}
                if names & BOILER_NAMES:
                    return -1
                if names & CONTENT_NAMES:
                    found = found or 1
            elif name == "role" and value.lower() in ("main", "article"):
                found = 1
    return found


def blocks_of(page: str) -> list[Block]:
    """Blocks of a page in order, without those that are never shown."""
    found: list[Block] = []
    # open elements: tag, innermost evidence, number
    stack: list[tuple[str, int, int]] = [("", 0, 0)]
    number, links, parts, linked, at, size = 0, 0, [], 0, 0, len(page)

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                block = next((e for e in reversed(stack) if e[0] not in INLINE), stack[0])
                found.append(Block(text, block[1], block[2], block[0], linked))
            parts, linked = [], 0

    def say(raw: str) -> None:
        nonlocal linked
        if stack[-1][1] > -2:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if links:
                linked += len(text)

    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag not in INLINE:
                flush()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    # A region's end also ends what was left open inside, an inline end only itself.
                    if tag in INLINE:
                        links -= tag == "a"
                        del stack[depth]
                    else:
                        links -= sum(e[0] == "a" for e in stack[depth:])
                        del stack[depth:]
                    break
                if stack[depth][0] in _SCOPES and (tag in INLINE or tag == "p" or tag == "li"):
                    break
            continue
        if tag == "br":
            say(" ")
            continue
        if tag not in INLINE:
            flush()
            # A new block ends an open paragraph; inline elements left open inside it end with it.
            for end in ENDS.get(tag, ("p",)):
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == end:
                        links -= sum(e[0] == "a" for e in stack[depth:])
                        del stack[depth:]
                        break
                    if stack[depth][0] in _SCOPES:
                        break
        if tag in VOID or m[3].endswith("/") and tag not in RAW:
            continue
        if tag in RAW:
            end = re.compile(f"</{tag}[\\s>/]", re.I).search(page, at)
            at = page.find(">", end.start()) + 1 or size if end else size
            continue
        own = _evidence(tag, m[3])
        number += 1
        links += tag == "a"
        before = stack[-1][1]
        stack.append((tag, before if before == -2 or not own else own, number))
    flush()
    return found


def look(block: Block) -> tuple[str, ...]:
    """Features of how a block looks."""
    n = len(block.text)
    return (f"tag {block.tag}", f"length {min(9, n.bit_length())}", f"links {10 * block.linked // n // 3 if n else 0}",
            f"ends {block.text[-1] in '.!?…”\"'}", f"words {min(6, block.text.count(' ').bit_length())}")


class BlockModel:
    """Naive Bayes over ``look``, learned from blocks of named regions."""

    def __init__(self, counts: dict[str, tuple[int, int]]):
        """``counts``: feature -> blocks that have it among boilerplate and among content."""
        self.odds = {name: math.log((c + 1.0) / (counts["*"][1] + 2.0)) - math.log((b + 1.0) / (counts["*"][0] + 2.0))
                     for name, (b, c) in counts.items() if name != "*"}

    def log_odds(self, block: Block) -> float:
        odds = sum(self.odds.get(name, 0.0) for name in look(block))
        return max(-LEARNED, min(LEARNED, odds)) + (NAMED * block.named if block.named else 0.0)


def minimum_cut(gain: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source: node capacities ``max(gain, 0)`` from it and ``max(-gain, 0)`` to the sink, and ties.

    Max-flow by shortest augmenting paths over residual capacities, all paths of a length in one sweep.
    """
    n = len(gain)
    edges: list[list[list]] = [[] for _ in range(n)]
    for a, b, capacity in ties:
        there, back = [b, capacity, None], [a, capacity, None]
        there[2], back[2] = back, there
        edges[a].append(there)
        edges[b].append(back)
    excess, room = [max(g, 0.0) for g in gain], [max(-g, 0.0) for g in gain]
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if excess[i] > 1e-9)
        for i in queue:
            level[i] = 0
        reached = False
        while queue:
            i = queue.popleft()
            reached = reached or room[i] > 1e-9
            for j, capacity, _ in edges[i]:
                if capacity > 1e-9 and level[j] < 0:
                    level[j] = level[i] + 1
                    queue.append(j)
        if not reached:
            return [x >= 0 for x in level]
        at = [0] * n
        for start in range(n):
            while level[start] == 0 and excess[start] > 1e-9:
                path, i = [], start
                while room[i] <= 1e-9:
                    while at[i] < len(edges[i]):
                        e = edges[i][at[i]]
                        if e[1] > 1e-9 and level[e[0]] == level[i] + 1:
                            break
                        at[i] += 1
                    if at[i] < len(edges[i]):
                        path.append(edges[i][at[i]])
                        i = path[-1][0]
                    elif path:
                        i = path.pop()[2][0]
                        at[i] += 1
                    else:
                        break
                if room[i] <= 1e-9:
                    break
                push = min([excess[start], room[i], *(e[1] for e in path)])
                excess[start] -= push
                room[i] -= push
                for e in path:
                    e[1] -= push
                    e[2][1] += push


def label_blocks(blocks: list[Block], model: BlockModel) -> list[bool]:
    """Content or not, for each block of a page."""
    gain = [model.log_odds(b) for b in blocks]
    ties = []
    for i in range(1, len(blocks)):
        same = blocks[i].parent == blocks[i - 1].parent or blocks[i].named == blocks[i - 1].named != 0
        ties.append((i - 1, i, TIE_PARENT if same else TIE_NEXT))
        if i > 1 and blocks[i].parent == blocks[i - 2].parent:
            ties.append((i - 2, i, TIE_NEAR))
    return minimum_cut(gain, ties)


def main_text(page: str | None, model: BlockModel) -> str:
    blocks = blocks_of(page or "")
    return "\n".join(b.text for b, content in zip(blocks, label_blocks(blocks, model)) if content)


def train_block_model(pages: DataFrame, sample: int = 400, column: str = "html") -> BlockModel:
    """Count how blocks of named regions look, on the ``sample`` pages with the smallest hashes; the driver gets the counts alone."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: dict[str, list[int]] = {"*": [0, 0]}
        for page in batch.column(0).to_pylist():
            for block in blocks_of(page or ""):
                if block.named:
                    for name in ("*", *look(block)):
                        counts.setdefault(name, [0, 0])[block.named > 0] += 1
        return pa.RecordBatch.from_pydict({"name": list(counts), "boilerplate": [c[0] for c in counts.values()],
                                           "content": [c[1] for c in counts.values()]})

    some = pages.select(F.col(column).alias("html")).where("html IS NOT NULL").orderBy(F.xxhash64("html")).limit(sample)
    counted = map_batches(some, run, "name string, boilerplate bigint, content bigint").groupBy("name").sum().collect()
    return BlockModel({"*": (0, 0)} | {r[0]: (r[1], r[2]) for r in counted})


def extract_text(pages: DataFrame, model: BlockModel, column: str = "html", text: str = "text") -> DataFrame:
    """All rows and columns but the page's source, and the main text; a column of the same name is replaced."""
    names = [c for c in pages.columns if c not in (text, column)]
    schema = ", ".join([*(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in names), f"`{text}` string"])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names),
                                           pa.array([main_text(p, model) for p in batch.column(column).to_pylist()], pa.string())], [*names, text])

    return map_batches(pages.select(*names, column), run, schema)
