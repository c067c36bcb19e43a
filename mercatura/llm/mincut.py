"""Main text of HTML pages by minimum-cut labelling.

A page is cut into blocks of text. A linear classifier on a block's place in the document (its
elements, their names and roles), its link density and its length gives the log odds of being
content: they become the capacities from the source (content) or to the sink (boilerplate). Names
of boilerplate cost by their share of an element's names, which length and neighbours can outweigh;
an article or main element inside lifts them, unless they are inside an article themselves. Names of readers'
comments count whole. A form that holds parts of a page (a heading, navigation, an article), or nothing to fill
in, is taken for a frame around the page and not for a form. What is styled not to show is no text.
Neighbouring blocks, and the next block under the same parent, are tied by edges that weigh more
the closer the two are in the DOM. The minimum cut is the labelling of least cost; blocks on the
source's side are the main text, in page order.

Each page is a small graph of its own, so the work is spread over the rows.

Edge cases: a NULL or empty page, or one without content, gives the empty string; unclosed and
stray tags are taken as browsers do; nothing is cut off, whatever the page's length; equal pages
give equal texts; other columns pass through and a column named like the result is replaced.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# HTML elements by what they do to text.
SKIPPED = frozenset(
    "script style head title noscript template iframe object embed svg canvas audio video"
    " textarea select option datalist annotation annotation-xml".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li"
    " main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul"
    " caption".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "tr": frozenset(["tr", "td", "th"]),
}
# A list item or cell does not close one outside its own list or table.
SCOPES = frozenset("ul ol menu dl table body html article section div".split())

# Elements, roles and names of things that are not the article.
ASIDE_ELEMENTS = frozenset("nav footer aside form menu dialog button label search".split())
ASIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu"
    " menubar toolbar".split()
)
ASIDE_NAMES = frozenset(
    "ad ads adv advert advertisement adverts adbox banner sponsor sponsored promo promotion"
    " nav navbar navigation menu breadcrumb breadcrumbs pagination pager"
    " footer header masthead topbar sidebar side rail widget"
    " cookie cookies consent gdpr notice notices popup modal overlay alert"
    " comment comments reply replies discussion disqus"
    " share sharing social related recommended newsletter subscribe signup login search form"
    " copyright legal disclaimer".split()
)
ARTICLE_ELEMENTS = frozenset(["article", "main"])
POST_NAMES = frozenset("article post entry story".split())
ARTICLE_NAMES = POST_NAMES | frozenset("content body main text".split())
# Names of readers' comments decide alone, whatever else an element is called.
COMMENT_NAMES = frozenset("comment comments reply replies discussion disqus".split())
# A name after one of the first says what an element has or lacks, not what it is; one before one of the
# second says what may be done.
ABOUT_OTHERS = frozenset("has with no without".split())
STATES = frozenset("open closed enabled disabled allowed status on off".split())


@dataclass(frozen=True)
class Costs:
    """Log odds of content that a block's traits add, and the weight of the ties."""

    base: float = -1.0
    aside: float = -9.0
    named_aside: float = -6.0
    in_article: float = 5.0
    named_article: float = 2.0
    paragraph: float = 1.0
    per_log_word: float = 0.5
    link_density: float = -4.0
    tie: float = 1.2


_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)",
    re.DOTALL,
)
_RAW_TEXT = frozenset("script style textarea title noscript iframe xmp".split())
# One attribute after the other, values with them, so that no word of a value is taken for a name.
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
_NAME = re.compile(r"[a-z]+")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b")
# What tells a form around a page from one to fill in: parts of a page, or nothing to fill in.
_FORM = re.compile(r"<form\b", re.I)
_FORM_PARTS = re.compile(
    r"<(?:(/)?(form)|(nav|header|footer|aside|main|article|h1)|(input|select|textarea|button))\b([^>]*)", re.I
)

# What holds for an element and all in it.
_NEUTRAL, _ASIDE, _ARTICLE, _NAMED, _HIDDEN, _ASIDE_IN_ARTICLE, _POST = range(7)


class _Element:
    __slots__ = ("block", "depth", "kind", "name", "parent", "share")

    def __init__(self, name: str, parent: _Element | None, kind: int, share: float = 0.0) -> None:
        self.name, self.parent, self.kind, self.share = name, parent, kind, share
        self.depth = parent.depth + 1 if parent else 0
        # The block it is in.
        self.block: _Element = self if parent is None or name in BLOCKS else parent.block


def _attributes(text: str) -> dict[str, str]:
    """By whole names; of repeated ones the first counts, as in browsers."""
    out: dict[str, str] = {}
    for key, value in _ATTRIBUTE.findall(text):
        out.setdefault(key.lower(), value.strip("\"'").lower())
    return out


def _aside_share(names: list[str]) -> float:
    own = [n for i, n in enumerate(names) if not i or names[i - 1] not in ABOUT_OTHERS]
    if any(n in COMMENT_NAMES and STATES.isdisjoint(own[i + 1 : i + 2]) for i, n in enumerate(own)):
        return 1.0
    return sum(n in ASIDE_NAMES for n in own) / len(own) if own else 0.0


def _page_wide(page: str) -> set[int]:
    """Where forms begin that hold parts of a page, or nothing to fill in."""
    out: set[int] = set()
    first = _FORM.search(page)
    if not first:
        return out
    start, has_parts, has_fields = -1, False, False
    for found in _FORM_PARTS.finditer(page, first.start()):
        closing, form, part, field, rest = found.groups()
        if form:
            # A form inside a form is none, as in browsers.
            if closing and start >= 0:
                if has_parts or not has_fields:
                    out.add(start)
                start = -1
            elif not closing and start < 0:
                start, has_parts, has_fields = found.start(), False, False
        elif part:
            has_parts = True
        elif field.lower() != "input" or _attributes(rest).get("type") != "hidden":
            has_fields = True
    if start >= 0 and (has_parts or not has_fields):
        out.add(start)
    return out


def _kind(name: str, attributes: str, above: int, share: float, wide: bool) -> tuple[int, float]:
    """What an element is, and the share of boilerplate in the names of it or of one around it.
    A wide form is around the page."""
    if above == _HIDDEN or name in SKIPPED:
        return _HIDDEN, share
    found = _attributes(attributes) if attributes and not attributes.isspace() else {}
    if "hidden" in found or found.get("aria-hidden") == "true" or _NOT_SHOWN.search(found.get("style", "")):
        return _HIDDEN, share
    role = found.get("role", "")
    if name in ARTICLE_ELEMENTS or role in ("main", "article"):
        # In an article, a mark is on a part of it, such as its comments, which may be articles too.
        return (above, share) if above in (_ARTICLE, _ASIDE_IN_ARTICLE) else (_ARTICLE, 0.0)
    if above in (_ASIDE, _ASIDE_IN_ARTICLE):
        return above, share
    if wide:
        return above, share
    if name in ASIDE_ELEMENTS or (name == "header" and above not in (_ARTICLE, _POST)) or role in ASIDE_ROLES:
        return (_ASIDE_IN_ARTICLE if above == _ARTICLE else _ASIDE), share
    if name in ("html", "body"):
        return above, share
    names = [_NAME.findall(found.get(key, "")) for key in ("class", "id")]
    own = max(map(_aside_share, names))
    if own == 0 and above in (_NEUTRAL, _NAMED):
        both = [*names[0], *names[1]]
        if not POST_NAMES.isdisjoint(both):
            return _POST, share
        if not ARTICLE_NAMES.isdisjoint(both):
            return _NAMED, share
    return above, max(share, own)


class Block:
    __slots__ = ("element", "linked", "text")

    def __init__(self, text: str, linked: int, element: _Element) -> None:
        self.text, self.linked, self.element = text, linked, element


def blocks(page: str) -> list[Block]:
    """The page's visible blocks of text, in order."""
    out: list[Block] = []
    here = _Element("#page", None, _NEUTRAL)
    wide = _page_wide(page)
    # How many elements of each name are open, so that no walk looks for one that is not.
    opened: Counter[str] = Counter()
    links = 0
    parts: list[str] = []
    linked: list[str] = []

    def end_block() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                inside = " ".join(html.unescape("".join(linked)).split()) if linked else ""
                out.append(Block(text, len(inside), owner))
            parts.clear()
            linked.clear()

    def close(last: _Element) -> None:
        nonlocal here
        while here is not last.parent:
            opened[here.name] -= 1
            here = here.parent  # type: ignore[assignment]

    owner = here
    at = 0
    while True:
        found = _MARKUP.search(page, at)
        stop = found.start() if found else len(page)
        if stop > at and here.kind != _HIDDEN:
            text = page[at:stop]
            if not parts:
                owner = here.block
            parts.append(text)
            if links:
                linked.append(text)
        if not found:
            break
        at = found.end()
        name = found.group(2)
        if name is None:
            continue
        name = name.lower()
        closing = found.group(1)
        if name == "br":
            if parts:
                parts.append(" ")
            continue
        is_block = name in BLOCKS
        if is_block:
            end_block()
            links = 0 if not closing else links
        if closing:
            if opened[name]:
                element = here
                while element.name != name:
                    element = element.parent  # type: ignore[assignment]
                if name == "a":
                    links = 0
                close(element)
            continue
        if is_block:
            # A paragraph ends where the next block begins, and with it what was left open in it.
            ends = [n for n in ("p", *CLOSED_BY.get(name, ())) if opened[n]]
            above: _Element | None = here if ends else None
            while above is not None and above.name not in SCOPES:
                if above.name in ends:
                    close(above)
                    break
                above = above.parent
        attributes = found.group(3)
        if name in VOID or attributes.endswith("/") and not is_block:
            continue
        around = name == "form" and found.start() in wide
        here = _Element(name, here, *_kind(name, attributes, here.kind, here.share, around))
        opened[name] += 1
        if name == "a":
            links = 1
        if name in _RAW_TEXT:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            close(here)
    end_block()
    return out


def log_odds(block: Block, costs: Costs) -> float:
    kind, share = block.element.kind, block.element.share
    total = costs.base
    if kind in (_ASIDE, _ASIDE_IN_ARTICLE):
        total += costs.aside
    else:
        place = {_ARTICLE: costs.in_article, _NAMED: costs.named_article, _POST: costs.named_article}.get(kind, 0.0)
        total += (1 - share) * place + share * costs.named_aside
    if block.element.name in ("p", "h1", "blockquote", "pre"):
        total += costs.paragraph
    total += costs.per_log_word * (block.text.count(" ") + 1).bit_length()
    return total + costs.link_density * block.linked / len(block.text)


def distance(a: _Element, b: _Element) -> int:
    """Steps between two elements of the tree."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent  # type: ignore[assignment]
        else:
            b = b.parent  # type: ignore[assignment]
        steps += 1
    return steps


def _edges(found: list[Block], tie: float) -> list[tuple[int, int, float]]:
    out = []
    last: dict[int, int] = {}
    for i, block in enumerate(found):
        if i:
            out.append((i - 1, i, tie / (1 + distance(found[i - 1].element, block.element))))
        parent = id(block.element.parent or block.element)
        before = last.get(parent)
        if before is not None and before != i - 1:
            out.append((before, i, tie / (1 + distance(found[before].element, block.element))))
        last[parent] = i
    return out


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the source's side of a minimum cut, after Dinic.

    Where several cuts cost the same, the one with the fewest nodes on that side."""
    n = len(odds)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def add(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(forth)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, value in enumerate(odds):
        if value > 0:
            add(source, i, value, 0.0)
        elif value < 0:
            add(i, sink, -value, 0.0)
    for a, b, weight in edges:
        add(a, b, weight, weight)
    least = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                b = to[e]
                if level[b] < 0 and room[e] > least:
                    level[b] = level[a] + 1
                    queue.append(b)
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        used = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                # Back to where the first edge of the path is full.
                k = next(i for i, e in enumerate(path) if room[e] <= least)
                a = to[path[k] ^ 1]
                del path[k:]
                continue
            own = out[a]
            while used[a] < len(own):
                e = own[used[a]]
                if room[e] > least and level[to[e]] == level[a] + 1:
                    break
                used[a] += 1
            if used[a] < len(own):
                path.append(own[used[a]])
                a = to[own[used[a]]]
            elif path:
                e = path.pop()
                a = to[e ^ 1]
                used[a] += 1
            else:
                break


def main_text(page: str | None, costs: Costs = Costs()) -> str:  # noqa: B008
    """The content blocks of a page, one a line."""
    found = blocks(page or "")
    odds = [log_odds(b, costs) for b in found]
    if not any(o > 0 for o in odds):
        return ""
    content = minimum_cut(odds, _edges(found, costs.tie))
    return "\n".join(b.text for b, kept in zip(found, content, strict=True) if kept)


def extract(df: DataFrame, page: str = "html", name: str = "text", costs: Costs = Costs()) -> DataFrame:  # noqa: B008
    """Replace the HTML of column ``page`` by its main text in column ``name``."""
    kept = [c for c in df.columns if c not in (page, name)]
    schema = T.StructType(
        [*(f for f in df.schema.fields if f.name in kept), T.StructField(name, T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x, costs) for x in batch.column(page).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(texts, pa.string())], [*kept, name]
            )

    return df.select(*kept, page).mapInArrow(run, schema)
