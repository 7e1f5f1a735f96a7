"""Main text of web pages from flat text blocks.

A page is cut into blocks of text at block-level tags. Each block has its word
count and link density, those of the blocks before and after it, and what its
enclosing elements say (an article around it, a menu, form, advert and the
like). A decision tree, grown on a small labelled table, keeps or drops it.
"""

from __future__ import annotations

import html as references
import re
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from dimforge.llm.common import ship

# Element names of HTML.
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol optgroup
option p pre section summary table tbody td tfoot th thead title tr ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements whose content is no text of the page.
RAW = ("script", "style", "noscript", "template", "textarea", "select", "svg", "iframe", "object", "canvas", "math",
       "video", "audio", "head")
# Elements that are closed by their own end tag or by that of one around them.
NESTED = frozenset("""address article aside blockquote body button caption center dd details dialog dl div dt fieldset
figure figcaption footer form header label li main menu nav ol section summary table tbody td tfoot th thead tr
ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
AROUND_TAGS = frozenset("aside button dialog fieldset footer form label menu nav".split())
AROUND_ROLES = frozenset("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation
search toolbar""".split())
AROUND_NAMES = frozenset("""ad ads adsense advert advertisement adverts advertising affiliate alert banner breadcrumb
breadcrumbs ccpa comment commentlist comments consent cookie cookiebar cookies copyright cta disclaimer
discussion disqus donate dropdown footer form gdpr hidden legal login menu modal nav navbar
navigation newsletter notice notification outbrain overlay pager pagination paging popup privacy promo promoted promos
promotion rail recommended recommendations related replies reply respond responses search share sharing sidebar signup
skip social sponsor sponsored subscribe subscription taboola teaser toolbar topbar warning widget widgets""".split())
# Only outside the article; within it they hold its title.
TOP_NAMES = frozenset("header masthead".split())
MAIN_TAGS = frozenset(("article", "main"))
MAIN_NAMES = frozenset("article articlebody content entry maincontent post postbody story storybody".split())

# In a compound name these say where or what kind of box it is; a compound of
# them and surroundings is surroundings, with any other word it is not.
PLAIN_PARTS = frozenset("""above after area bar before below block bottom box btn button buttons card column container
content fixed global group header head holder inner item items left link links list main modal module outer page panel
post posts primary right row secondary section site slot small stories sub tag tags text title top unit user wrap
wrapper article""".split()) | AROUND_NAMES | TOP_NAMES
# Left open, these hold the rest of the page.
SWALLOWING = frozenset(("script", "style"))

TAG = re.compile(r"""<!--[\s\S]*?(?:-->|\Z)|<!\[CDATA\[[\s\S]*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                 r"""|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"'<]|"[^"]*"|'[^']*')*+)>"""
                 r"""|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)(?:>|\Z)""")
ATTRIBUTE = re.compile(r"""([A-Za-z-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    inside: bool
    around: bool
    heading: bool


FEATURES = ("around", "inside", "page_has_main", "heading", "words", "link_density", "words_before", "density_before",
            "words_after", "density_after")
# The labelled table: features in the order of FEATURES, then 1 for main text.
LABELLED = (
    # within an article
    (0, 1, 1, 1, 6, 0.0, 5, 0.0, 9, 0.0, 1), (0, 1, 1, 1, 9, 1.0, 4, 1.0, 40, 0.0, 1),
    (0, 1, 1, 0, 60, 0.0, 6, 0.0, 45, 0.05, 1), (0, 1, 1, 0, 3, 0.0, 60, 0.0, 45, 0.0, 1),
    (0, 1, 1, 0, 1, 0.0, 8, 0.0, 20, 1.0, 1), (0, 1, 1, 0, 2, 0.0, 3, 1.0, 2, 1.0, 1),
    (0, 1, 1, 0, 25, 0.4, 30, 0.1, 12, 0.0, 1), (0, 1, 1, 0, 8, 0.5, 50, 0.0, 50, 0.0, 1),
    (0, 1, 1, 0, 120, 0.02, 0, 0.0, 0, 0.0, 1), (0, 1, 1, 0, 14, 0.0, 0, 0.0, 14, 0.0, 1),
    (0, 1, 1, 0, 5, 1.0, 60, 0.0, 4, 1.0, 0), (0, 1, 1, 0, 4, 1.0, 5, 1.0, 4, 1.0, 0),
    (0, 1, 1, 0, 2, 1.0, 30, 0.0, 1, 1.0, 0), (0, 1, 1, 0, 12, 0.95, 9, 0.9, 20, 0.0, 0),
    # what surrounds an article: menus, adverts, forms, notices, comments
    (1, 0, 1, 0, 1, 1.0, 1, 1.0, 1, 1.0, 0), (1, 0, 1, 0, 7, 0.0, 1, 1.0, 6, 0.0, 0),
    (1, 0, 1, 0, 30, 0.0, 80, 0.0, 0, 0.0, 0), (1, 0, 1, 1, 3, 0.0, 40, 0.0, 12, 0.0, 0),
    (1, 0, 1, 0, 90, 0.05, 30, 0.0, 60, 0.0, 0), (1, 1, 1, 0, 40, 0.0, 50, 0.0, 50, 0.0, 0),
    (1, 1, 1, 1, 5, 0.0, 50, 0.0, 10, 0.0, 0), (1, 1, 1, 0, 3, 0.0, 50, 0.0, 50, 0.0, 0),
    (1, 0, 0, 0, 50, 0.0, 20, 0.0, 50, 0.0, 0), (1, 0, 0, 1, 6, 0.0, 20, 0.0, 50, 0.0, 0),
    (1, 1, 1, 0, 150, 0.1, 90, 0.0, 80, 0.0, 0), (1, 0, 0, 0, 2, 1.0, 2, 1.0, 2, 1.0, 0),
    # unnamed blocks beside an article
    (0, 0, 1, 0, 6, 0.0, 0, 0.0, 7, 0.0, 0), (0, 0, 1, 0, 25, 0.1, 4, 1.0, 30, 0.0, 0),
    (0, 0, 1, 1, 5, 0.0, 4, 1.0, 3, 1.0, 0), (0, 0, 1, 0, 60, 0.0, 90, 0.0, 2, 1.0, 0),
    (0, 0, 1, 0, 4, 1.0, 4, 1.0, 4, 1.0, 0), (0, 0, 1, 0, 12, 0.0, 60, 0.0, 0, 0.0, 0),
    # pages without a named article: lengths and links of neighbours decide
    (0, 0, 0, 0, 60, 0.0, 5, 0.0, 50, 0.1, 1), (0, 0, 0, 0, 35, 0.1, 3, 1.0, 40, 0.0, 1),
    (0, 0, 0, 0, 20, 0.0, 40, 0.0, 30, 0.0, 1), (0, 0, 0, 0, 18, 0.2, 0, 0.0, 0, 0.0, 1),
    (0, 0, 0, 0, 5, 0.0, 45, 0.0, 50, 0.0, 1), (0, 0, 0, 1, 6, 0.0, 3, 1.0, 50, 0.0, 1),
    (0, 0, 0, 1, 5, 0.0, 60, 0.0, 40, 0.0, 1), (0, 0, 0, 0, 12, 0.0, 8, 0.0, 40, 0.0, 1),
    (0, 0, 0, 0, 90, 0.05, 90, 0.05, 4, 1.0, 1), (0, 0, 0, 0, 7, 0.0, 70, 0.0, 20, 0.0, 1),
    (0, 0, 0, 0, 1, 1.0, 1, 1.0, 1, 1.0, 0), (0, 0, 0, 0, 6, 0.0, 2, 1.0, 2, 1.0, 0),
    (0, 0, 0, 0, 30, 0.8, 20, 0.9, 25, 0.7, 0), (0, 0, 0, 0, 4, 0.0, 3, 1.0, 0, 0.0, 0),
    (0, 0, 0, 1, 3, 0.0, 4, 1.0, 3, 1.0, 0), (0, 0, 0, 0, 15, 0.6, 50, 0.0, 4, 1.0, 0),
    (0, 0, 0, 0, 3, 0.0, 0, 0.0, 4, 1.0, 0), (0, 0, 0, 0, 8, 1.0, 60, 0.0, 50, 0.0, 0),
)
# The same blocks between other neighbours: (words, link density) of a block
# and its label, once for each pair of neighbours.
NEIGHBOURS = ((0, 0.0), (2, 1.0), (3, 0.0), (60, 0.0))
REPEATED = (
    (0, 1, 1, 0, 1, 0.0, 1), (0, 1, 1, 0, 4, 0.0, 1), (0, 1, 1, 0, 10, 0.1, 1), (0, 1, 1, 0, 70, 0.0, 1),
    (0, 1, 1, 1, 5, 0.0, 1), (0, 1, 1, 0, 4, 1.0, 0),
    (0, 0, 1, 0, 4, 0.0, 0), (0, 0, 1, 0, 25, 0.0, 0), (0, 0, 1, 0, 90, 0.0, 0), (0, 0, 1, 0, 3, 1.0, 0),
    (1, 0, 1, 0, 8, 0.0, 0), (1, 0, 1, 0, 60, 0.0, 0), (1, 1, 1, 0, 6, 0.0, 0), (1, 1, 1, 0, 60, 0.0, 0),
    (1, 0, 0, 0, 60, 0.0, 0), (1, 0, 0, 0, 6, 0.0, 0),
    (0, 0, 0, 0, 90, 0.1, 1), (0, 0, 0, 0, 3, 1.0, 0), (0, 0, 0, 0, 25, 0.8, 0),
)
# On a page without a named article the same block is main text or not by its
# neighbours: per pair of them, (words of a block, label) each.
NONE, MENU, SHORT_TEXT, PROSE = NEIGHBOURS
BETWEEN = (
    (PROSE, PROSE, ((3, 1), (4, 1), (8, 1), (12, 1), (18, 1), (40, 1))),
    (MENU, PROSE, ((3, 0), (8, 1), (12, 1), (18, 1), (40, 1))),
    (SHORT_TEXT, PROSE, ((3, 0), (8, 1), (12, 1), (18, 1), (40, 1))),
    (NONE, PROSE, ((3, 0), (8, 1), (12, 1), (18, 1), (40, 1))),
    (PROSE, MENU, ((3, 0), (8, 1), (12, 1), (18, 1), (40, 1))),
    (PROSE, SHORT_TEXT, ((3, 0), (8, 1), (12, 1), (18, 1), (40, 1))),
    (PROSE, NONE, ((3, 0), (8, 1), (12, 1), (18, 1), (40, 1))),
    (MENU, MENU, ((3, 0), (8, 0), (12, 0), (18, 0), (60, 1))),
    (MENU, SHORT_TEXT, ((3, 0), (8, 0), (12, 0), (18, 0), (60, 1))),
    (MENU, NONE, ((3, 0), (8, 0), (12, 0), (18, 0), (60, 1))),
    (SHORT_TEXT, MENU, ((3, 0), (8, 0), (12, 0), (40, 1))),
    (SHORT_TEXT, SHORT_TEXT, ((3, 0), (8, 0), (12, 0), (40, 1))),
    (SHORT_TEXT, NONE, ((3, 0), (8, 0), (12, 0), (40, 1))),
    (NONE, MENU, ((3, 0), (8, 0), (12, 0), (40, 1))),
)


def labelled_table() -> np.ndarray:
    rows = [*LABELLED, *((*r[:-1], *before, *after, r[-1])
                         for r in REPEATED for before in NEIGHBOURS for after in NEIGHBOURS),
            *((0, 0, 0, 0, words, 0.0, *before, *after, label)
              for before, after, own in BETWEEN for words, label in own)]
    return np.array(rows, np.float64)


DEPTH = 8


def grow(x: np.ndarray, y: np.ndarray, depth: int = DEPTH) -> tuple | int:
    """A decision tree by Gini impurity: a label, or (feature, threshold, tree
    up to the threshold, tree above it). Ties go to the earlier feature, then
    the lower threshold."""
    major = int(2 * y.sum() >= len(y))
    if depth == 0 or y.min() == y.max():
        return major
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            impurity = sum(2 * part.mean() * (1 - part.mean()) * len(part) for part in (y[low], y[~low]))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, float(cut), low)
    if best is None:
        return major
    _, f, cut, low = best
    return f, cut, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


def trained_tree() -> tuple | int:
    table = labelled_table()
    return grow(table[:, :-1], table[:, -1].astype(int))


def decide(tree: tuple | int, row: tuple) -> bool:
    while not isinstance(tree, int):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return bool(tree)


def _names(attributes: str) -> tuple[set[str], set[str], set[str], bool]:
    """Names of class and id, joined, with the words of compounds that are made
    of surroundings and plain parts; joined only; roles; whether it is hidden."""
    words: set[str] = set()
    whole: set[str] = set()
    roles: set[str] = set()
    hidden = False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m.group(1).lower(), (m.group(2) or "").strip("\"'").lower()
        if name in ("class", "id"):
            for v in value.split():
                parts = [p for p in re.split(r"[^a-z0-9]+", v) if p]
                whole.add("".join(parts))
                if all(p in PLAIN_PARTS or any(map(str.isdigit, p)) for p in parts):
                    words.update(parts)
        elif name == "role":
            roles.add(value)
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            hidden = True
        elif name == "style" and "display:none" in value.replace(" ", ""):
            hidden = True
    return words | whole, whole, roles, hidden


def blocks(page: str) -> list[Block]:
    """All text blocks of a page in order, empty ones left out."""
    out: list[Block] = []
    held: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, bool]] = [("", False, False)]
    in_link, heading = False, False

    def flush() -> None:
        words = "".join(held).split()
        if words:
            _, inside, around = stack[-1]
            out.append(Block(" ".join(words), len(words), len(" ".join(linked).split()), inside, around, heading))
        held.clear()
        linked.clear()

    def text(raw: str) -> None:
        if raw:
            raw = references.unescape(raw)
            held.append(raw)
            if in_link:
                linked.append(raw)

    at, size = 0, len(page)
    while at < size:
        m = TAG.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        name = (m.group(2) or m.group(5) or "").lower()
        if not name:
            continue
        closing = (m.group(1) or m.group(4)) == "/"
        attributes = m.group(3) if m.group(2) else m.group(6)
        if name in RAW and not closing:
            if name in BLOCK:
                flush()
            if not attributes.endswith("/"):
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = end.end() if end else (size if name in SWALLOWING else at)
            held.append(" ")
            continue
        if name == "br":
            held.append(" ")
        elif name == "a":
            in_link = not closing
        elif name in BLOCK:
            flush()
            heading = name in HEADINGS and not closing
            if name in NESTED:
                if closing:
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] == name:
                            del stack[i:]
                            break
                    in_link = False
                elif not attributes.endswith("/"):
                    _, inside, around = stack[-1]
                    words, whole, roles, hidden = _names(attributes) if attributes.strip() else (set(), set(), set(), False)
                    main = name in MAIN_TAGS or "main" in roles or bool(whole & MAIN_NAMES)
                    inside |= main
                    # A part of a compound name does not make these surroundings.
                    if name == "body" or name in MAIN_TAGS or "main" in roles:
                        words = whole
                    around |= (name in AROUND_TAGS or hidden or bool(roles & AROUND_ROLES) or bool(words & AROUND_NAMES)
                               or not inside and (name == "header" or bool(words & TOP_NAMES)))
                    stack.append((name, inside, around))
    flush()
    return out


def main_text(page: str | None, tree: tuple | int) -> str:
    """Blocks that the tree keeps, joined by line feeds."""
    found = blocks(page or "")
    if not found:
        return ""
    # A named part is the article only if it holds most of the page's own words;
    # a teaser beside unnamed prose is not.
    free = [(b.words - b.linked, b.inside) for b in found if not b.around]
    inside = sum(n for n, named in free if named)
    has_main = any(named for _, named in free) and 2 * inside >= sum(n for n, _ in free)
    none = (0, 0.0)
    near = [none, *((b.words, b.linked / b.words) for b in found), none]
    kept = []
    for b, before, own, after in zip(found, near, near[1:], near[2:]):
        if decide(tree, (b.around, b.inside and has_main, has_main, b.heading, *own, *before, *after)):
            kept.append(b.text)
    return "\n".join(kept)


def main_text_column(page: Column) -> Column:
    ship()
    tree = trained_tree()

    @F.pandas_udf("string")
    def extract(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, tree) for p in pages], dtype=object)

    return extract(page)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """``id, url, text, n_chars`` for every row of ``pages``.

    White space inside a block is one space; character references are decoded;
    nothing is cut. A null or empty page, or one without main text, has the
    empty text. Null ids and urls and repeated rows are passed through; other
    columns are not read; an empty table gives an empty result.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("u"),
                        main_text_column(F.col(html_col)).alias("t"))
    return rows.select(F.col("id").alias(id_col), F.col("u").alias(url_col), F.col("t").alias("text"),
                       F.length("t").cast("long").alias("n_chars"))
