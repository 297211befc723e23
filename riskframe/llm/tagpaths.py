"""Main text of web pages by tag-path ratios.

Text length and punctuation are summed per root-to-leaf tag path and divided by the path's
nodes.  Both ratios are smoothed along the page, fused, averaged per path, weighted if the path runs through elements
made for running text, and compared with a threshold.  The smallest element that holds all selected nodes is the
article, or an article or main element that holds at least half of their text; its headings and
short paragraphs come along, subtrees that are marked as something else do not, unless they hold
most of the selected text.

Cases: a null or empty page, or one without content, has an empty text; unclosed elements end
with their parents; an unclosed comment, script or style runs to the end of the page; pages of
any length are read whole; repeated rows have equal texts; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import workers_ready

#: A path is content from this share of the mean fused value on, the mean weighted by text.
THRESHOLD = 0.7
#: Weight of the value of paths through elements that are made for running text.
TEXT_WEIGHT = 2.0
TEXT_TAGS = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 dd figcaption".split())
#: Weights of the nodes around a node in the smoothing.
KERNEL = (0.25, 0.5, 0.25)
PUNCTUATION = frozenset(".,;:!?…。，、；：！？¿¡")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # a quote opens a value only directly behind its equals sign; elsewhere it is a sign like others
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>",
    re.S,
)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_PARTS = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
SKIPPED = frozenset(
    "head nav header footer aside form button select option label fieldset dialog menu svg canvas object audio video math".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HOLDERS = frozenset("html body main article section div center table tbody tr td ol ul dl figure details".split())
OUTERMOST = frozenset(["#", "html", "body"])
NEVER_MARKED = frozenset("html body main article".split())
CLOSES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}
LIMITS = frozenset("ul ol dl table body html article main section div".split())
INLINE = frozenset("b i em strong u s span font small big sub sup mark code q cite abbr time tt kbd var ins del".split())
#: Words in class, id or role that mark a subtree as something other than the article, alone or in a compound name.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs pagination pager sidebar aside complementary footer contentinfo header masthead comment comments "
    "commentlist disqus reply replies respond cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended widget copyright search form toolbar skip".split()
)
#: Words that only say what kind of box a mark is on ("ad-box"), and words that deny it ("no-sidebar").
PLAIN = frozenset(
    "area articles bar block body bottom box boxes btn button buttons col column container content cta field group holder icon "
    "icons inner input item items left link links list main module outer page panel placeholder post posts right row section "
    "site slot text top trail unit wrap wrapper zone".split()
)
DENIALS = frozenset("has no non not with without".split())
#: Shares of the selected text of a page that make a marked subtree the article after all: marked by a
#: compound name, and by a whole one (which takes ``SURE_BLOCKS`` blocks besides).
UNSURE_SHARE, SURE_SHARE, SURE_BLOCKS = 0.5, 0.9, 2


class _Element:
    __slots__ = ("tag", "parent", "skipped", "marked", "path", "holder")

    def __init__(self, tag: str, parent: _Element | None, skipped: bool, marked: float = 0.0):
        self.tag, self.parent, self.marked = tag, parent, marked
        self.skipped = skipped or (parent is not None and parent.skipped)
        above = parent.path if parent is not None else ""
        self.path = above if tag in INLINE else f"{above}/{tag}"
        self.holder = self if tag in HOLDERS or parent is None else parent.holder


def _hidden(tag: str, attributes: str) -> bool:
    if tag in SKIPPED:
        return True
    return tag not in NEVER_MARKED and bool(attributes.strip()) and bool(_HIDDEN.search(attributes))


def _marked(tag: str, attributes: str) -> float:
    """Share of the selected text that a subtree needs in spite of its marks; 0 without marks."""
    if tag in NEVER_MARKED or not attributes.strip():
        return 0.0
    share = 0.0
    for a, b, c in _NAMED.findall(attributes):
        for name in (a or b or c).lower().split():
            parts = _PARTS.findall(name)
            if MARKS.isdisjoint(parts):
                continue
            if len(parts) == 1:
                return SURE_SHARE
            if DENIALS.isdisjoint(parts) and (parts[-1] in MARKS or all(p in MARKS or p in PLAIN for p in parts)):
                share = UNSURE_SHARE
    return share


def text_nodes(page: str) -> tuple[list[tuple[_Element, str, int]], int]:
    """(element, text, block number) of the text outside skipped subtrees, in page order."""
    root = _Element("#", None, False)
    stack, nodes, block, at = [root], [], 0, 0
    while at < len(page):
        token = _TOKEN.search(page, at)
        text = page[at : token.start() if token else len(page)]
        if text and not stack[-1].skipped:
            nodes.append((stack[-1], html.unescape(text), block))
        if not token:
            break
        at = token.end()
        if token.group().startswith("<![CDATA["):
            if not stack[-1].skipped:
                nodes.append((stack[-1], token.group()[9:].removesuffix("]]>"), block))
            continue
        end, tag, attributes = token.group(1, 2, 3)
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            nodes.append((stack[-1], "\n", block))
            continue
        if tag in BLOCKS:
            block += 1
        if end:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag in INLINE and stack[k].tag in BLOCKS:
                    break
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        if tag in BLOCKS:
            _close_implied(stack, tag)
        if tag in VOID or attributes.rstrip().endswith("/") and tag not in BLOCKS:
            continue
        stack.append(_Element(tag, stack[-1], _hidden(tag, attributes), _marked(tag, attributes)))
    return [n for n in nodes if not n[0].skipped], block


def _close_implied(stack: list[_Element], tag: str) -> None:
    """A block ends an open paragraph; list items and cells end their like; an article ends an unclosed menu."""
    if tag in ("article", "main"):
        for k in range(1, len(stack)):
            if stack[k].skipped or stack[k].marked:
                del stack[k:]
                return
    ends = CLOSES.get(tag, frozenset())
    for k in range(len(stack) - 1, 0, -1):
        open_tag = stack[k].tag
        if open_tag == "p" or open_tag in ends or (open_tag in HEADINGS and tag in HEADINGS):
            del stack[k:]
            return
        if open_tag in LIMITS:
            return


def _smoothed(values: np.ndarray) -> np.ndarray:
    padded = np.concatenate([values[:1], values, values[-1:]])
    return KERNEL[0] * padded[:-2] + KERNEL[1] * padded[1:-1] + KERNEL[2] * padded[2:]


def selected_paths(nodes: list[tuple[str, str]]) -> set[str]:
    """Content paths of (path, text) nodes in page order."""
    paths, at = np.unique([p for p, _ in nodes], return_inverse=True)
    length = np.array([len(t) for _, t in nodes], dtype=float)
    points = np.array([sum(c in PUNCTUATION for c in t) for _, t in nodes], dtype=float)
    count = np.bincount(at)
    text_ratio = (np.bincount(at, length) / count)[at]
    point_ratio = (np.bincount(at, points) / count)[at]
    fused = np.sqrt(_smoothed(text_ratio) * (1 + _smoothed(point_ratio)))
    weight = np.array([1.0 if TEXT_TAGS.isdisjoint(p.split("/")) else TEXT_WEIGHT for p in paths])
    value = np.bincount(at, fused) / count * weight
    linked = np.array([p.endswith("/a") or "/a/" in p for p in paths])
    threshold = THRESHOLD * (value[at] * length).sum() / max(length.sum(), 1.0)
    good = (value >= min(threshold, value[~linked].max(initial=0.0))) & ~linked
    return {str(p) for p, g in zip(paths, good) if g}


def _without_marked(nodes: list[tuple[_Element, str, int]]) -> list[tuple[_Element, str, int]]:
    """``nodes`` without marked subtrees, but with those that hold so much of the selected text that they are the article."""
    marks: dict[_Element, list[_Element]] = {}
    for e, _, _ in nodes:
        if e not in marks:
            marks[e], above = [], e
            while above is not None:
                if above.marked:
                    marks[e].append(above)
                above = above.parent
    if not any(marks.values()):
        return nodes
    filled = [(e, t, b) for e, t, b in ((e, " ".join(t.split()), b) for e, t, b in nodes) if t]
    paths = selected_paths([(e.path, t) for e, t, _ in filled]) if filled else set()
    total, weight, held = 0, {}, {}
    for e, t, b in filled:
        if e.path in paths:
            total += len(t)
            for m in marks[e]:
                weight[m] = weight.get(m, 0) + len(t)
                held.setdefault(m, set()).add(b)

    def dropped(m: _Element) -> bool:
        few = m.marked == SURE_SHARE and len(held.get(m, ())) < SURE_BLOCKS
        return few or weight.get(m, 0) <= m.marked * total

    gone = {m for m in set().union(*marks.values()) if dropped(m)}
    return [n for n in nodes if gone.isdisjoint(marks[n[0]])]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    nodes = _without_marked(text_nodes(page)[0])
    filled = [(e, " ".join(t.split()), b) for e, t, b in nodes]
    filled = [n for n in filled if n[1]]
    if not filled:
        return ""
    paths = selected_paths([(e.path, t) for e, t, _ in filled])
    weight: dict[_Element, int] = {}
    total = 0
    for e, t, _ in filled:
        if e.path in paths:
            total += len(t)
            above = e
            while above is not None:
                weight[above] = weight.get(above, 0) + len(t)
                above = above.parent
    holders = [e for e in weight if e.tag in ("article", "main") and 2 * weight[e] >= total]
    if not holders:
        holders = [e for e, w in weight.items() if e.holder is e and w == total]
    depth = {e: e.path.count("/") for e in holders}
    holder = max(holders, key=lambda e: (depth[e], weight[e])) if holders else filled[0][0]
    return _joined(nodes, holder, paths)


def _joined(nodes: list[tuple[_Element, str, int]], holder: _Element, paths: set[str]) -> str:
    """Text of the blocks below ``holder``.  Links go with the text of their block; blocks of links alone are left out.

    In a page without an article element, blocks count that have selected text, headings, what lies between
    the first and the last of these blocks, and what shares the outermost wrapper of one.
    """
    loose = holder.tag in OUTERMOST
    blocks: dict[int, list[str]] = {}
    linking, filled, worded, selected, headed = set(), set(), set(), set(), set()
    wrappers: dict[int, _Element] = {}
    for e, t, b in nodes:
        above, linked, outer = e, False, None
        while above is not None and above is not holder:
            linked = linked or above.tag == "a" and (loose or above.parent is holder)
            outer = above if above.tag in HOLDERS and above.tag not in OUTERMOST else outer
            above = above.parent
        if above is None:
            continue
        blocks.setdefault(b, []).append(t)
        if outer is not None:
            wrappers[b] = outer
        if not t.strip():
            continue
        if linked:
            linking.add(b)
        else:
            filled.add(b)
            if any(c.isalnum() for c in t):
                worded.add(b)
            if e.path in paths:
                selected.add(b)
        if HEADINGS.intersection(e.path.split("/")):
            headed.add(b)
    kept = worded | (filled - linking)
    chosen = selected & kept
    if loose:
        within = {wrappers[b] for b in chosen if b in wrappers}
        first, last = min(chosen, default=0), max(chosen, default=-1)
        kept = headed | {b for b in kept if first <= b <= last or wrappers.get(b) in within}
    out = [" ".join("".join(parts).split()) for b, parts in sorted(blocks.items()) if b in kept]
    return "\n\n".join(t for t in out if t)


def extracted(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points)."""

    def run(page: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in page], dtype=object)

    run.__annotations__ = {"page": pd.Series, "return": pd.Series}
    text = F.pandas_udf(run, "string")(F.col("html"))
    found = workers_ready(pages).select("page_id", "url", text.alias("text"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
