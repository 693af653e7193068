"""Main-text extraction by minimum-cut labelling.

A page becomes a row of text blocks.  A linear classifier prices each block as
content or boilerplate; the prices are capacities to the two terminals of a
graph whose other edges tie blocks that follow each other, and siblings, by
their distance in the document tree.  The minimum cut (by maximum flow) gives
the labelling of least total cost; the content side is the page's text.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import unescape
from math import exp, log2

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section
summary table tbody td tfoot th thead tr ul""".split())
#: Elements whose content is never text of the page.
SILENT = frozenset("""audio button canvas datalist iframe map noframes noscript object optgroup option script select
style svg template textarea title video""".split())
RAW = frozenset("script style textarea title noframes iframe".split())
#: Opening the key closes an open element of the value, up to a container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("table ul ol dl div section article body select menu".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog fieldset search".split())
#: Of these, a form or fieldset and any element flagged for a word may be a wrapper.
HARD_TAGS = BOILER_TAGS - {"form", "fieldset"} | {"header"}
BOILER_WORDS = frozenset("""ad ads adbox adsense advert adverts advertisement advertising alert banner breadcrumb
breadcrumbs comment comments commentlist complementary consent contentinfo cookie cookies copyright dialog
disclaimer disqus footer footnav form gdpr masthead menu modal nav navbar navigation newsletter
notice notification overlay pager pagination paywall popup promo promoted replies
respond sharebar sidebar signin signup skip sponsor sponsored subscribe
subscription toolbar widget widgets""".split())
#: Names that boilerplate and ordinary text share: evidence that other evidence may outweigh.
HINT_WORDS = frozenset("discussion legal login privacy promotion recommended related reply search share sharing social".split())
CONTENT_WORDS = frozenset("article articlebody content entry main post story text".split())
HEAD_WORDS = frozenset({"header", "banner", "masthead"})
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
TAG_END = re.compile(r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>""")
ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: The classifier: log-odds that a block is content.
WEIGHTS = {"bias": -0.4, "article": 3.0, "content_name": 1.0, "paragraph": 0.8, "heading": 0.6, "item": -0.4,
           "length": 0.5, "sentence": 0.5, "links": -4.0, "hint": -2.5, "boiler": -8.0}
ADJACENT, SIBLING, REACH = 0.8, 0.6, 2.0
HINT_SHARE = 0.8          # of the unlinked text that is not boilerplate: hints on more of it tell nothing
WRAPPER_SHARE, WRAPPER_CHARS = 0.8, 200      # unlinked text a wrapper holds: of what no other flag marks, at least
FAR = 16                  # steps at which an edge weighs nothing any more


class Block:
    __slots__ = ("parts", "linked", "tag", "holder", "flag", "boiler", "article", "named", "hint")

    def __init__(self, top):
        self.parts, self.linked = [], 0
        self.holder = top.holder if top else None          # the block element around the text
        self.tag = self.holder.tag if self.holder else ""
        self.flag = top.flag if top else None              # the nearest boilerplate element around it
        self.boiler = bool(top and top.hidden)
        self.article = bool(top and top.article)
        self.named = bool(top and top.named)
        self.hint = bool(top and top.hint)


class Element:
    __slots__ = ("tag", "holder", "parent", "depth", "flag", "above", "soft", "hidden", "void", "article", "named", "hint")

    def __init__(self, tag, up, attrs):
        self.tag = tag
        self.parent = up.holder if up else None            # among block elements, as is depth
        self.holder = self if tag in BLOCK else self.parent
        self.depth = (self.parent.depth if self.parent else 0) + (tag in BLOCK)
        self.article = tag in ("article", "main") or attrs.get("role") in ("main", "article") or bool(up and up.article)
        words = {w.lower() for k in ("class", "id", "role", "aria-label") for w in WORD.findall(attrs.get(k, ""))}
        own = tag in BOILER_TAGS or tag == "header" and not self.article
        if tag not in ("html", "body", "main", "article"):
            bad = words & BOILER_WORDS
            own = own or bool(bad - HEAD_WORDS) or bool((words & HEAD_WORDS) and not self.article)
        hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" \
            or "display:none" in attrs.get("style", "").replace(" ", "").lower()
        self.hidden = hidden or bool(up and up.hidden)
        self.above = up.flag if up else None
        self.flag = self if own else self.above
        self.soft = tag not in HARD_TAGS                   # may be a wrapper of the whole page or its main part
        self.void = False
        if not self.hidden and (tag == "main" or attrs.get("role") == "main"):
            e = self.above
            while e and not e.void:
                e.void, e = e.soft, e.above
        self.named = bool(words & CONTENT_WORDS) or bool(up and up.named)
        main = tag in ("html", "body", "main", "article") or attrs.get("role") in ("main", "article")
        self.hint = not main and (bool(words & HINT_WORDS) or bool(up and up.hint))


def blocks(html: str) -> list[Block]:
    """Text blocks in page order, from one pass over the page; an element
    that is cut off by the page's end counts as closed there."""
    out: list[Block] = []
    stack: list[Element] = []
    open_: dict[str, int] = {}
    block: Block | None = None
    silent = links = 0

    def pop_to(at: int):
        nonlocal silent, links
        for e in stack[at:]:
            open_[e.tag] -= 1
            silent -= e.tag in SILENT
            links -= e.tag == "a"
        del stack[at:]

    def close(tags: set, stop: frozenset = SCOPE) -> bool:
        if not any(open_.get(t) for t in tags):
            return False
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].tag in tags:
                pop_to(k)
                return True
            if stack[k].tag in stop:
                return False
        return False

    def text(piece: str):
        nonlocal block
        if silent or not piece:
            return
        if block is None:
            if piece.isspace():
                return
            block = Block(stack[-1] if stack else None)
            out.append(block)
        block.parts.append(piece)
        if links:
            block.linked += len(piece.strip())

    pos, end = 0, len(html)
    while pos < end:
        at = html.find("<", pos)
        if at < 0 or at + 1 >= end:
            text(unescape(html[pos:]))
            break
        if at > pos:
            text(unescape(html[pos:at]) if "&" in html[pos:at] else html[pos:at])
        if html.startswith("<!--", at):
            stop = html.find("-->", at + 4)
            pos = end if stop < 0 else stop + 3
            continue
        after = html[at + 1]
        if after in "!?":
            stop = html.find(">", at)
            pos = end if stop < 0 else stop + 1
            continue
        closing = after == "/"
        name = NAME.match(html, at + 1 + closing)
        if not name:
            text("<")
            pos = at + 1
            continue
        tag = name.group().lower()
        ends = TAG_END.match(html, name.end())
        stop = ends.end() if ends else html.find(">", name.end()) + 1
        if not stop:
            break                                   # cut off inside a tag
        pos = stop
        if tag in BLOCK:
            block = None
        elif tag == "br":
            if block is not None:
                block.parts.append(" ")
            continue
        if closing:
            if open_.get(tag):
                close({tag}, frozenset())
            continue
        if tag in VOID:
            continue
        if tag in BLOCK:
            close({"p"})
        if tag in CLOSES:
            close(CLOSES[tag])
        if html[stop - 2] == "/" and tag not in BLOCK and tag not in SILENT:
            continue
        attrs = {}
        if stop - name.end() > 1:
            for k, a, b, c in ATTR.findall(html, name.end(), stop - 1):
                attrs.setdefault(k.lower(), a or b or c)
        stack.append(Element(tag, stack[-1] if stack else None, attrs))
        open_[tag] = open_.get(tag, 0) + 1
        silent += tag in SILENT
        links += tag == "a"
        if tag in RAW:
            found = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(html, pos)
            pos = found.start() if found else end
    unwrap(out)
    return out


def unwrap(found: list[Block]) -> None:
    """Mark boilerplate blocks.  A name that ordinary text has too is a hint,
    forgotten where it covers nearly all the text that is left.  A flagged element does not mark what it holds
    if it is a wrapper: it holds the main element, or nearly all the unlinked
    text that no other flagged element marks.  Text under a wrapper counts for
    the flagged element next above, so nested wrappers are seen one by one."""

    def active(e: Element | None) -> Element | None:
        path = []
        while e and e.void:
            path.append(e)
            e = e.above
        for p in path:
            p.above = e                                    # paths stay short
        return e

    own: dict[Element | None, int] = {None: 0}
    for b in found:
        if not b.boiler:
            e = active(b.flag)
            own[e] = own.get(e, 0) + max(0, len("".join(b.parts).strip()) - b.linked)
    e = max(own, key=own.get)
    while e and e.soft and own[e] >= max(WRAPPER_CHARS, WRAPPER_SHARE * (own[e] + own[None])):
        e.void = True
        up = active(e.above)
        own[up] = own.get(up, 0) + own.pop(e)
        e = up
    told = [0, 0]
    for b in found:
        b.boiler = b.boiler or active(b.flag) is not None
        if not b.boiler:
            told[b.hint] += max(0, len("".join(b.parts).strip()) - b.linked)
    if told[True] >= HINT_SHARE * sum(told):
        for b in found:
            b.hint = False


def log_odds(block: Block, text: str) -> float:
    w = WEIGHTS
    words = text.count(" ") + 1
    s = w["bias"] + w["length"] * min(4.0, max(-3.0, log2(words) - 3))
    s += w["article"] * block.article + w["content_name"] * block.named
    s += w["paragraph"] * (block.tag in ("p", "blockquote", "pre")) + w["heading"] * (block.tag[:1] == "h" and block.tag[1:].isdigit())
    s += w["item"] * (block.tag in ("li", "td", "th", "dt", "dd"))
    s += w["sentence"] * (text[-1] in ".!?:;\"'”»)")
    s += w["hint"] * block.hint
    return s + w["links"] * min(1.0, block.linked / len(text)) + w["boiler"] * block.boiler


def steps_between(a: Element | None, b: Element | None) -> int:
    """Steps from one element to another in the tree, FAR if there are more."""
    steps = 0
    while a is not b and steps < FAR:
        if a is not None and (b is None or a.depth >= b.depth):
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def ties(found: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: each block with the next one and with the next one
    under the same parent, weaker with distance in the tree."""
    out, last = [], {}
    ups = [b.holder.parent if b.holder else None for b in found]
    for i, up in enumerate(ups):
        if i and (steps := steps_between(ups[i - 1], up)) < FAR:
            out.append((i - 1, i, ADJACENT * exp(-steps / REACH)))
        if id(up) in last:
            out.append((last[id(up)], i, SIBLING))
        last[id(up)] = i
    return out


def min_cut(score: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Content side of the least cut: terminal capacity ``score`` (positive to
    content, negative to boilerplate), symmetric ``edges``.

    A block whose own price is at least the sum of its edges keeps its sign in
    some least cut; such blocks are settled first and their edges become part
    of their neighbours' prices.  Maximum flow labels the rest.
    """
    n = len(score)
    own = [int(round(s * 1000)) for s in score]
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for i, j, w in edges:
        w = int(round(w * 1000))
        if i != j and w:
            near[i][j] = near[i].get(j, 0) + w
            near[j][i] = near[j].get(i, 0) + w
    total = [sum(x.values()) for x in near]
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] is not None or abs(own[i]) < total[i] or own[i] == 0 and total[i]:
            continue
        label[i] = own[i] > 0
        for j, w in near[i].items():
            if label[j] is None:
                own[j] += w if label[i] else -w
                total[j] -= w
                todo.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        for i, content in zip(rest, _flow(rest, own, near)):
            label[i] = content
    return [bool(x) for x in label]


def _flow(nodes: list[int], own: list[int], near: list[dict[int, int]]) -> list[bool]:
    """Blocking-flow maximum flow; true for the nodes on the source's side."""
    index = {v: k for k, v in enumerate(nodes)}
    n = len(nodes)
    s, t = n, n + 1
    cap: list[dict[int, int]] = [{} for _ in range(n + 2)]
    for k, v in enumerate(nodes):
        for j, w in near[v].items():
            if j in index:
                cap[k][index[j]] = w
        if own[v] > 0:
            cap[s][k], cap[k][s] = own[v], 0
        elif own[v] < 0:
            cap[k][t], cap[t][k] = -own[v], 0
    while True:
        level = {s: 0}
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for v, c in cap[u].items():
                if c > 0 and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if t not in level:
            return [k in level for k in range(n)]
        arcs = {u: iter(list(cap[u])) for u in level}
        path = [s]
        while path:
            u = path[-1]
            if u == t:
                push = min(cap[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    cap[a][b] -= push
                    cap[b][a] = cap[b].get(a, 0) + push
                cut = next(k for k, (a, b) in enumerate(zip(path, path[1:])) if cap[a][b] == 0)
                del path[cut + 1:]
                arcs[path[-1]] = iter([v for v in cap[path[-1]] if cap[path[-1]][v] > 0])
                continue
            for v in arcs[u]:
                if cap[u][v] > 0 and level.get(v) == level[u] + 1:
                    path.append(v)
                    break
            else:
                level[u] = -1
                path.pop()


def main_text(html: str) -> str:
    """Content blocks joined by an empty line; white space inside a block is
    one space."""
    found, texts = [], []
    for b in blocks(html):
        if t := " ".join("".join(b.parts).split()):
            found.append(b)
            texts.append(t)
    keep = min_cut([log_odds(b, t) for b, t in zip(found, texts)], ties(found))
    return "\n\n".join(t for t, k in zip(texts, keep) if k)


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Null or empty html, and pages without content, give the empty text.  Null
    ids and urls pass through; repeated rows keep a row each; an empty table
    gives an empty result; other columns are not read.
    """

    @F.pandas_udf("string")
    def text_of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in parts:
            yield pd.Series([main_text(h or "") for h in htmls], dtype=object)

    out = pages.select("page_id", "url", text_of(F.coalesce(F.col("html"), F.lit(""))).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
