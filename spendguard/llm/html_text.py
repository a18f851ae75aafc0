"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text at block-level tags. Each block gets two costs from a linear classifier over plain
features (the elements and class names around it, links, length, punctuation): that of calling it content and that of
calling it boilerplate. They are the capacities of its edges to the two terminals. Blocks that follow one another, and
the nearest blocks of one parent, are tied by edges that weigh more the closer the two are in the document tree. The
cut of least capacity, found by max-flow, separates content from boilerplate; what is at a tie is content.

Blocks whose costs differ by more than all their edges together are settled beforehand, which changes no minimum; in
practice little is left for the flow.

Class names of an element say nothing about its content where it holds the page's ``main`` element, an ``article`` with
half of the page's prose, or nearly all of that prose; nor does a ``form`` there. Names such as ``with-sidebar`` or
``no-comments`` describe a layout and are not read.

Scripts, styles, comments and the page's head never become blocks. Character references are decoded, white space in a
block becomes one space, blocks are joined by line feeds. Nothing is shortened.

Defined cases: a null, empty or textless page gives an empty text; unclosed or stray tags are read as browsers do,
roughly: a block's end closes what was open in it, an unknown end is ignored; a ``<`` that starts no tag is text.
Repeated rows give repeated rows; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']++|"[^"<>]*+"|'[^'<>]*+'|["'])*+)>""")
_ATTRIBUTE = re.compile(r"""(class|id|role|style|aria-hidden|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[a-z]+")
_LAYOUT = re.compile(r"(?<!\S)(?:with|without|has|no|js|is)[-_]\S*")

#: Elements whose content is no text of the page.
RAW = {"script", "style", "title", "textarea", "template", "iframe", "noscript", "svg", "annotation", "annotation-xml", "object", "select"}
#: Elements that begin and end a block; the others stand within one.
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead tr ul button label".split()
)
VOID = {"hr"}
#: Blocks that a block of the same kind, or their parent's end, closes.
SHORT = {"p", "li", "dt", "dd", "td", "th", "tr", "option", "h1", "h2", "h3", "h4", "h5", "h6"}

#: The classifier: cost of calling a block boilerplate, less that of calling it content.
ELEMENT = {
    "article": 4.0, "main": 3.0, "nav": -8.0, "footer": -8.0, "aside": -8.0, "form": -7.0, "menu": -7.0, "dialog": -7.0,
    "button": -6.0, "label": -6.0, "option": -6.0, "fieldset": -6.0, "p": 1.0, "pre": 1.0, "blockquote": 1.0, "h1": 1.0,
    "h2": 0.5, "h3": 0.5, "figcaption": 0.5, "li": -0.5, "header": -6.0,
}
CLASS_WORDS = {
    **dict.fromkeys("article content entry story post main".split(), 2.0),
    **dict.fromkeys(
        "ad ads advert adverts advertisement advertising adsbygoogle banner sponsor sponsored promo promotion cookie cookies consent gdpr "
        "notice popup modal overlay newsletter subscribe subscription signup login sidebar widget related recommended "
        "share sharing social comment comments reply replies discussion disqus menu nav navbar navigation breadcrumb "
        "breadcrumbs footer masthead toolbar pagination copyright legal alert skip hidden".split(),
        -8.0,
    ),
}
BIAS, PER_WORD, MOST_WORDS, LINKED, STOPS = -1.0, 0.12, 20, -5.0, 0.8
#: Strength of an edge between blocks that are 0, 1, 2, ... steps apart in the tree.
TIE = (0.9, 0.6, 0.4, 0.25, 0.1)
SCALE = 1000


@dataclass
class Block:
    """Text of one block; ``path`` has the numbers of the open elements, ``prior`` the sum of their weights."""

    text: str
    path: tuple[int, ...]
    prior: float
    linked: int


def _class_weight(tag: str, attributes: str, inside_article: bool) -> float:
    weight = 0.0
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id", "role"):
            if tag not in ("body", "html", "article", "main"):
                names = _NAME.findall(_LAYOUT.sub(" ", value))
                found = [CLASS_WORDS[w] for w in names if w in CLASS_WORDS]
                if "header" in names and not inside_article and not found:
                    found = [ELEMENT["header"]]  # of the page; an entry's header belongs to it
                weight += min(found, default=0.0) if found and min(found) < 0 else max(found, default=0.0)
        elif name == "hidden" or name == "aria-hidden" and value == "true" or "display:none" in value.replace(" ", ""):
            weight -= HIDDEN
    return weight


PROSE = 6  # words from which on a block counts as prose, if few of them are links
ARTICLE_SHARE, WRAPPER_SHARE = 0.5, 0.9
HIDDEN = 100.0


def _wrappers(found: list[Block], tags: list[str]) -> set[int]:
    """Numbers of the elements around the page's main part."""
    under: dict[int, int] = {}
    around: dict[int, tuple[int, ...]] = {}
    total = 0
    for block in found:
        words = block.text.count(" ") + 1
        if words < PROSE or 2 * block.linked > len(block.text):
            words = 0
        total += words
        for k, number in enumerate(block.path):
            under[number] = under.get(number, 0) + words
            if tags[number] in ("article", "main"):
                around[number] = block.path[:k]
    most = {number for number, words in under.items() if words and words >= WRAPPER_SHARE * total}
    for number, above in around.items():
        if tags[number] == "main" or under[number] and under[number] >= ARTICLE_SHARE * total:
            most.update(above)
    return most


def blocks(page: str) -> list[Block]:
    """The blocks of a page, in order."""
    out: list[Block] = []
    parts: list[str] = []
    open_: list[tuple[str, int, bool]] = []  # element, its number, whether in an article
    tags, weights = [""], [0.0]  # of the elements, by number
    classes: dict[int, float] = {}
    linked, in_link = 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, tuple(x[1] for x in open_), 0.0, min(linked, len(text))))
            parts.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if in_link:
                linked += len(text)

    at, n = 0, len(page)
    lowered = None
    while at < n:
        mark = page.find("<", at)
        if mark < 0:
            say(page[at:])
            break
        say(page[at:mark])
        if page.startswith("<!--", mark):
            end = page.find("-->", mark + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), mark):
            end = page.find(">", mark)
            at = n if end < 0 else end + 1
            continue
        tag = _TAG.match(page, mark)
        if not tag:
            say("<")
            at = mark + 1
            continue
        at = tag.end()
        closing, name, attributes = tag.group(1), tag.group(2).lower(), tag.group(3)
        if name in RAW and not closing:
            if attributes.endswith("/") and name in ("svg", "iframe", "object"):
                continue
            lowered = lowered if lowered is not None else page.translate(_LOWER)
            end = lowered.find(f"</{name}", at)
            shut = page.find(">", end) if end >= 0 else -1
            at = n if shut < 0 else shut + 1
            if name in ("title", "textarea", "select"):
                flush()
        elif name == "a":
            in_link = 0 if closing else 1
        elif name == "br":
            say(" ")
        elif name in BLOCK:
            flush()
            if closing:
                for k in range(len(open_) - 1, -1, -1):
                    if open_[k][0] == name:
                        del open_[k:]
                        break
                if name not in SHORT:
                    in_link = 0
            elif name not in VOID:
                while open_ and open_[-1][0] in SHORT and (name == open_[-1][0] or open_[-1][0] == "p" or open_[-1][0][0] == "h"):
                    open_.pop()
                inside = bool(open_) and open_[-1][2]
                number = len(tags)
                tags.append(name)
                weights.append(0.0 if inside and name == "header" else ELEMENT.get(name, 0.0))
                if attributes and (by_class := _class_weight(name, attributes, inside)):
                    classes[number] = by_class
                open_.append((name, number, inside or name in ("article", "main")))
    flush()
    around = _wrappers(out, tags) if classes or "form" in tags else set()
    for number, weight in classes.items():
        if number not in around or weight > 0 or weight <= -HIDDEN:
            weights[number] += weight
    for number in around:
        if tags[number] == "form":
            weights[number] -= ELEMENT["form"]
    for block in out:
        block.prior = sum([weights[number] for number in block.path])
    return out


_LOWER = {c: c + 32 for c in range(65, 91)}


def leaning(block: Block) -> float:
    """Above 0 for content: the classifier's costs, without the neighbours."""
    words = block.text.count(" ") + 1
    share = block.linked / len(block.text)
    stops = block.text.endswith((".", "!", "?", "…", ":", '"', "”"))
    return BIAS + block.prior + PER_WORD * min(words, MOST_WORDS) + LINKED * share + STOPS * stops


def ties(found: list[Block]) -> list[tuple[int, int, int]]:
    """Edges ``(i, j, capacity)``: neighbours on the page, and the nearest earlier block of the same parent."""
    edges: dict[tuple[int, int], float] = {}
    of_parent: dict[tuple[int, ...], int] = {}
    for j, block in enumerate(found):
        if j:
            a, b = found[j - 1].path, block.path
            common = 0
            while common < min(len(a), len(b)) and a[common] == b[common]:
                common += 1
            apart = max(len(a), len(b)) - common
            edges[j - 1, j] = TIE[min(apart, len(TIE) - 1)]
        parent = block.path[:-1]
        i = of_parent.get(parent)
        if i is not None:
            edges[i, j] = edges.get((i, j), 0.0) + TIE[1] / 2
        of_parent[parent] = j
    return [(i, j, round(c * SCALE)) for (i, j), c in edges.items()]


def least_cut(lean: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Whether each node is on the content side of a least cut; ties are content.

    ``lean``: capacity from the source less that to the sink. ``edges`` hold both ways.
    """
    lean = list(lean)
    near: list[dict[int, int]] = [{} for _ in lean]
    for i, j, c in edges:
        if c > 0:
            near[i][j] = near[i].get(j, 0) + c
            near[j][i] = near[j].get(i, 0) + c
    label: list[bool | None] = [None] * len(lean)
    todo = deque(range(len(lean)))
    while todo:  # nodes that no neighbour can turn
        i = todo.popleft()
        if label[i] is None and abs(lean[i]) > sum(near[i].values()):
            label[i] = lean[i] > 0
            for j, c in near[i].items():
                lean[j] += c if label[i] else -c
                del near[j][i]
                todo.append(j)
            near[i] = {}
    rest = [i for i, x in enumerate(label) if x is None]
    room = {i: dict(near[i]) for i in rest}
    give = {i: max(0, lean[i]) for i in rest}
    take = {i: max(0, -lean[i]) for i in rest}
    while True:  # shortest augmenting paths, from nodes that have flow to give
        came: dict[int, int] = {i: -1 for i in rest if give[i]}
        queue, end = deque(came), -1
        while queue and end < 0:
            i = queue.popleft()
            if take[i]:
                end = i
                break
            for j, c in room[i].items():
                if c and j not in came:
                    came[j] = i
                    queue.append(j)
        if end < 0:
            break
        flow, i = take[end], end
        while came[i] >= 0:
            flow, i = min(flow, room[came[i]][i]), came[i]
        flow = min(flow, give[i])
        give[i] -= flow
        take[end] -= flow
        i = end
        while came[i] >= 0:
            room[came[i]][i] -= flow
            room[i][came[i]] += flow
            i = came[i]
    # The sink's side: nodes from which the sink can still be reached.
    sunk = deque(i for i in rest if take[i])
    seen = set(sunk)
    while sunk:
        j = sunk.popleft()
        for i in room[j]:
            if i not in seen and room[i][j]:
                seen.add(i)
                sunk.append(i)
    return [i not in seen if x is None else x for i, x in enumerate(label)]


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    content = least_cut([round(SCALE * leaning(b)) for b in found], ties(found))
    return "\n".join(b.text for b, keep in zip(found, content, strict=True) if keep)


def extract(pages: DataFrame, id_: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page."""

    @pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(p) for p in batch], dtype=object)

    found = pages.select(F.col(id_).alias("page_id"), F.col(url).alias("url"), text(F.col(page)).alias("text"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
