"""Main text of a web page by tag-path ratios.

A page is cut into blocks of text, each with its path of block elements from the
root (with classes; inline markup is no part of it). Over the blocks of a path, text
length and punctuation give its ratio: characters outside links per block, times
one plus the punctuation marks per block, smoothed along the page. The ratios are
fused from the leaves up: a block weighs its characters outside links times its
ratio, times the ratio's share of the page's highest, so that many short blocks
don't outweigh prose; a path through ``article`` or ``main`` counts ``SEMANTIC_WEIGHT``
times. An element weighs what all blocks inside weigh.

These weights decide on every page. From the top, the way goes down into the
wrapper that has ``ROOT_SHARE`` of the weight, as far as there is one; all blocks
below its end are content, however short. Of what stands beside the way, wrappers
that are mostly links go; so do bare text below ``THRESHOLD`` of the highest ratio on
pages that have such links, and article elements below it that stand beside other
content.

Elements that are never content by their name or role (scripts, forms, menus, page
headers and footers, asides) are left out before. A class or id marks an element as
an advert, a notice, reader comments and the like only by a whole name, and not
if the element has half of the page's weight (of reader comments, and on pages with
an ``article`` or ``main``: if one stands inside). Broken markup is read as browsers do: a block start ends
an open paragraph, an end tag without a start is ignored, open elements end with the
page, an unfinished tag, comment or script at the end is dropped; a quote is one only
after an equals sign.

Time and memory are in proportion to the page, however deep it is nested: elements
know their parents, paths are numbers. A null or empty page has the empty text. Pages
are independent, so repeated rows and ties need no rule.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

THRESHOLD = 0.5
SEMANTIC_WEIGHT = 3.0
#: the way to the root goes on while one wrapper has this share of the weight
ROOT_SHARE = 0.9
#: a wrapper is mostly links where they have this many times the characters outside
LINK_TIMES = 2

# Elements of HTML
BLOCKS = frozenset("""
    html body address article aside blockquote canvas center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre
    search section summary table tbody td tfoot th thead tr ul caption
""".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template object svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("nav footer aside form menu dialog button select fieldset search head datalist".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
    "option": {"option"}, "optgroup": {"option", "optgroup"},
}
SCOPES = frozenset("ul ol dl table html body article aside section div main".split())
# Words of a class or id that mark what is no content
MARKS = frozenset("""
    ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner
    nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager toolbar topbar
    footer masthead sidebar widget widgets related recommended trending
    comment comments reply replies respond disqus discussion
    cookie cookies consent gdpr notice notices alert popup modal overlay
    newsletter subscribe subscription signup login share sharing social search hidden skip
""".split())
# Those that mark a name which only begins with them
HEADS = frozenset("""
    ad ads advert adverts advertisement advertising sponsor sponsored nav navbar navigation menu submenu
    breadcrumb breadcrumbs pagination footer sidebar widget widgets related comment comments reply replies
    respond disqus cookie cookies consent gdpr newsletter subscribe
""".split())
# Words that say nothing beside a mark
NEUTRAL = frozenset("""
    list section wrapper wrap box area container block inner bar links buttons form group item items post page
    site top bottom left right main global primary secondary header title
""".split())
DISCUSSION = frozenset("comment comments reply replies respond disqus discussion".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
# Elements that only arrange others; those that frame a page; those whose own text is bare
WRAPPERS = frozenset("html body div section center table tbody tr td main article dl ul ol".split())
FRAMES = frozenset("html body".split())
BARE = frozenset("html body div center address".split())
SEMANTIC = frozenset("article main".split())
PUNCTUATION = re.compile(r"[.,;:!?¿¡…。，、；：！？]")

# every alternative begins with a character of its own and gives nothing back
TOKEN = re.compile(
    r"<!--(?:.*?(?:-->|--!>|\Z))|<[!?][^>]*+(?:>|\Z)"
    r"|</?([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[=\"'])*+)(?:>|\Z)",
    re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))")


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)} if "=" in raw else {}


def _mark(names: str) -> str:
    """The word of a class or id that marks an element, or none."""
    for name in names.split():
        words = [w.lower() for w in re.split(r"[-_]+|(?<=[a-z])(?=[A-Z])", name) if w]
        marks = [w for w in words if w in MARKS]
        if marks and (words[0] in HEADS or all(w in MARKS or w in NEUTRAL for w in words)):
            return marks[0]
    return ""


def _never(name: str, attributes: dict[str, str], raw: str, inside: bool) -> bool:
    """Whether an element is never content; ``inside``: it stands in an article or main element."""
    if name in ("html", "body", "main"):
        return False
    if name in NEVER or (name == "header" and not inside):
        return True
    style = attributes.get("style", "").replace(" ", "").lower()
    return (attributes.get("role", "").lower() in ROLES or attributes.get("aria-hidden") == "true"
            or "display:none" in style or re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", raw) is not None)


class Tree:
    """Block elements of a page in the order of their starts, and the blocks of text in them.

    Element 0 is the page; ``last`` is the last element inside each, so an element's
    contents are a range of numbers.
    """

    def __init__(self, page: str):
        self.name, self.parent, self.path, self.last = ["html"], [0], [0], [0]
        self.mark, self.never = [""], [False]
        self.blocks: list[tuple[int, str, int]] = []   # element, text, characters in links
        self.links_left_out = False
        self._paths: dict[tuple[int, str], int] = {}
        self._read(page)

    def _add(self, name: str, label: str, parent: int, mark: str, never: bool) -> int:
        number = len(self.name)
        self.name.append(name)
        self.parent.append(parent)
        self.path.append(self._paths.setdefault((self.path[parent], label), len(self._paths) + 1))
        self.last.append(number)
        self.mark.append(mark)
        self.never.append(never)
        return number

    def _read(self, page: str) -> None:
        stack: list[int] = []
        opened: Counter[str] = Counter()
        text: list[str] = []
        linked, in_link, inline_noise = 0, 0, []
        name_of = self.name

        def top() -> int:
            return stack[-1] if stack else 0

        def close() -> str:
            number = stack.pop()
            self.last[number] = len(name_of) - 1
            opened[name_of[number]] -= 1
            return name_of[number]

        def flush() -> None:
            nonlocal linked
            whole = " ".join(html.unescape("".join(text)).split())
            if whole and self.never[top()]:
                self.links_left_out |= linked > 0
            elif whole:
                self.blocks.append((top(), whole, linked))
            text.clear()
            linked = 0

        def add(piece: str) -> None:
            nonlocal linked
            if piece and not inline_noise:
                text.append(piece)
                if in_link:
                    linked += len(piece)

        at, end = 0, len(page)
        while at < end:
            found = TOKEN.search(page, at)
            if not found:
                add(page[at:])
                break
            add(page[at:found.start()])
            at = found.end()
            name = found[1]
            if name is None:
                continue
            name, raw, closing = name.lower(), found[2] or "", page[found.start() + 1] == "/"
            if page[at - 1] != ">":
                break
            if name in RAW:
                if not closing and not (raw.rstrip().endswith("/") and name in ("svg", "math")):
                    stop = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*+(?:>|\Z)", re.I).search(page, at)
                    at = stop.end() if stop else end
            elif name == "br" or name == "wbr":
                add(" " if name == "br" else "")
            elif closing:
                if name == "a":
                    in_link = max(in_link - 1, 0)
                if name in BLOCKS or name in NEVER:
                    flush()
                    in_link, inline_noise = 0, []
                    if opened[name]:
                        while close() != name:
                            pass
                elif inline_noise and name == inline_noise[-1]:
                    inline_noise.pop()
            elif name in BLOCKS or name in NEVER:
                flush()
                in_link, inline_noise = 0, []
                if stack and name_of[stack[-1]] == "p":
                    close()
                shuts = CLOSES.get(name)
                while shuts and stack and name_of[stack[-1]] not in SCOPES and name_of[stack[-1]] in shuts:
                    close()
                if name in VOID or (name in FRAMES and opened[name]):
                    continue
                if name == "body":
                    while stack and name_of[stack[-1]] != "html":
                        close()
                attributes = _attributes(raw)
                names = attributes.get("class", "")
                inside = opened["article"] > 0 or opened["main"] > 0
                mark = "" if name in ("html", "body", "main") else _mark(f"{names} {attributes.get('id', '')}")
                never = self.never[top()] or _never(name, attributes, raw, inside)
                label = name if name in FRAMES else ".".join([name, *names.split()])
                stack.append(self._add(name, label, top(), mark, never))
                opened[name] += 1
            elif name not in VOID:
                if name == "a":
                    in_link += 1
                if inline_noise:
                    inline_noise.append(name) if name == inline_noise[-1] else None
                elif raw and ("=" in raw or "hidden" in raw):
                    attributes = _attributes(raw)
                    if _never(name, attributes, raw, True) or _mark(f"{attributes.get('class', '')} {attributes.get('id', '')}"):
                        inline_noise.append(name)
        flush()
        while stack:
            close()
        self.last[0] = len(name_of) - 1

    def summed(self, values: list[float]) -> list[float]:
        """For each element the sum over the blocks inside, of one value per block."""
        out = [0.0] * len(self.name)
        for (element, _, _), value in zip(self.blocks, values):
            out[element] += value
        for element in range(len(out) - 1, 0, -1):
            out[self.parent[element]] += out[element]
        return out

    def inherited(self, own: list[bool]) -> list[bool]:
        """For each element whether it or one around it is so."""
        out = list(own)
        for element in range(1, len(out)):
            out[element] = out[element] or out[self.parent[element]]
        return out


def ratios(tree: Tree) -> tuple[list[float], list[float]]:
    """Ratio of the path of each block, and the same smoothed along the page."""
    sums: dict[int, list[float]] = {}
    for element, text, linked in tree.blocks:
        entry = sums.setdefault(tree.path[element], [0, 0, 0])
        entry[0] += max(len(text) - linked, 0)
        entry[1] += 1
        entry[2] += len(PUNCTUATION.findall(text))
    own = {p: chars / count * (1 + marks / count) for p, (chars, count, marks) in sums.items()}
    ratio = [own[tree.path[element]] for element, _, _ in tree.blocks]
    edged = [*ratio[:1], *ratio, *ratio[-1:]]
    return ratio, [(a + 2 * b + c) / 4 for a, b, c in zip(edged, edged[1:], edged[2:])]


def weights(tree: Tree, smooth: list[float]) -> list[float]:
    """What each block weighs: free characters times the fused ratio."""
    highest = max(smooth, default=0) or 1
    inside = tree.inherited([n in SEMANTIC for n in tree.name])
    return [max(len(text) - linked, 0) * value * value / highest * (SEMANTIC_WEIGHT if inside[element] else 1)
            for (element, text, linked), value in zip(tree.blocks, smooth)]


def _unmarked(tree: Tree) -> None:
    """Leave out blocks in marked elements, but for those that hold half of the weight or, of comments and on pages
    that have them, an article or main element."""
    if not any(tree.mark):
        return
    weight = tree.summed(weights(tree, ratios(tree)[1]))
    holds = [name in SEMANTIC and not mark for name, mark in zip(tree.name, tree.mark)]
    semantic = any(holds[element] for element, inside in enumerate(weight) if inside)
    for element in range(len(tree.name) - 1, 0, -1):
        holds[tree.parent[element]] = holds[tree.parent[element]] or holds[element]
    out = tree.inherited([
        bool(mark) and not (holds[e] if semantic or mark in DISCUSSION else weight[e] and weight[e] >= weight[0] / 2)
        for e, mark in enumerate(tree.mark)])
    tree.links_left_out |= any(linked and out[element] for element, _, linked in tree.blocks)
    tree.blocks = [b for b in tree.blocks if not out[b[0]]]


def _content(tree: Tree, ratio: list[float], weight: list[float], least: float) -> set[int]:
    """Numbers of the blocks below the end of the way, and of those beside it that are content too."""
    order = sorted(range(len(tree.blocks)), key=lambda i: tree.blocks[i][0])
    elements = [tree.blocks[i][0] for i in order]
    whole = tree.summed(weight)
    children: dict[int, list[int]] = {}
    for element in range(1, len(tree.name)):
        children.setdefault(tree.parent[element], []).append(element)

    def inside(element: int) -> list[int]:
        return order[bisect_left(elements, element):bisect_right(elements, tree.last[element])]

    here, levels, core = 0, [], []
    while True:
        below = children.get(here, [])
        way = max(below, key=whole.__getitem__, default=None)
        down = (tree.name[here] != "article" and way is not None and tree.name[way] in WRAPPERS
                and whole[way] >= ROOT_SHARE * whole[0])
        if not down and tree.name[here] not in FRAMES:
            core = inside(here)
            break
        # a frame is never the end of the way
        own = order[bisect_left(elements, here):bisect_right(elements, here)]
        levels.append([(None, [i]) for i in own] + [
            (tree.name[e], blocks) for e in below if not (down and e == way) and (blocks := inside(e))])
        if not down:
            break
        here = way
    kept, has_links = set(core), tree.links_left_out
    prose = tree.name[here] == "article" or any(
        name == "article" and max(ratio[i] for i in blocks) >= least for level in levels for name, blocks in level)
    for level in reversed(levels):
        rest = []
        for name, blocks in level:
            linked = sum(tree.blocks[i][2] for i in blocks)
            free = sum(max(len(tree.blocks[i][1]) - tree.blocks[i][2], 0) for i in blocks)
            if (name is None or name in WRAPPERS) and linked and linked >= LINK_TIMES * free:
                has_links = True
            else:
                rest.append((name, blocks))
        for name, blocks in rest:
            low = max(ratio[i] for i in blocks) < least
            bare = (name is None or name in WRAPPERS) and all(tree.name[tree.blocks[i][0]] in BARE for i in blocks)
            if not (low and (has_links and bare or name == "article" and not prose)):
                kept.update(blocks)
    return kept


def main_text(page: str | None, threshold: float = THRESHOLD) -> str:
    """Blocks of the content, joined by line feeds."""
    tree = Tree(page or "")
    _unmarked(tree)
    if not tree.blocks:
        return ""
    ratio, smooth = ratios(tree)
    weight = weights(tree, smooth)
    kept = _content(tree, ratio, weight, threshold * max(ratio)) if sum(weight) else set(range(len(tree.blocks)))
    return "\n".join(text for i, (_, text, _) in enumerate(tree.blocks) if i in kept)


def extract(df: DataFrame, page: str = "html", out: str = "text") -> DataFrame:
    """Add the main text of each page."""
    fields = [f for f in df.schema.fields if f.name.lower() != out.lower() or f.name == page]
    kept = [f for f in fields if f.name not in (page, out)]
    names = [f.name for f in kept]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{out}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [main_text(p) for p in batch.column(batch.schema.get_field_index(page)).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(made, pa.string())],
                                             names=[*names, out])

    return df.select(*[f"`{n}`" for n in [*names, page]]).mapInArrow(run, schema)
