"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into flat blocks at block-level tags.  Each block has its word count and link density, those of the
blocks before and behind it, and where it stands (inside an article or main element, inside a container whose tag, role, class or id names
page furniture, in a heading).  A decision tree trained on the small labelled table below decides which blocks are main text.
Where it leaves a page without any, the blocks outside furniture that are not mostly links are taken, and if there are none, those in containers whose
names may also be a topic ("discussion", "responses").

Defined cases: null and empty html give an empty text; markup may be unclosed, nested wrongly or cut off anywhere; comments, scripts, styles, form
controls, hidden elements and the document head never give text, but a button within a sentence does; ``br`` is white space; text of any length is kept whole; repeated rows are extracted
alike; an empty table gives an empty result; other columns pass through, an older ``text``/``n_chars`` column is replaced.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import with_fields

# HTML element names by their role.
SKIPPED = frozenset("head script style noscript template svg annotation annotation-xml iframe object canvas audio video map select textarea "
                    "datalist title".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BREAKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
                   "tbody td tfoot th thead tr ul".split())
CONTAINERS = BREAKS - frozenset("p hr h1 h2 h3 h4 h5 h6 html body".split())
# Open elements that end where one of these begins.
ENDED_BY = {"li": "li", "dt": "dt dd", "dd": "dt dd", "td": "td th", "th": "td th", "tr": "td th tr"}
LINES = frozenset("p h1 h2 h3 h4 h5 h6".split())
FURNITURE_TAGS = frozenset("nav aside footer form dialog menu search".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class, id and role attributes that name page furniture, and those that name an article.
FURNITURE = frozenset("ad ads advert adverts advertisement advertising adsense adsbygoogle alert banner bottombar breadcrumb breadcrumbs "
                      "comment comments commentlist complementary consent contentinfo cookie cookies copyright dialog disclaimer discussion disqus "
                      "feedback footer gdpr login masthead menu menubar modal nav navbar navigation newsletter notice notices notification "
                      "outbrain pager pagination paywall popup promo promoted promotion recommended related replies reply respond responses search share "
                      "sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola toc toolbar topbar widget widgets".split())
# Of those, words that may as well be what an article is about ("market-share", "job-search", "discussion"): they count alone or with the parts
# below, not as the id of a section, and not where a page would be left without text.
TOPICS = frozenset("alert complementary consent copyright disclaimer discussion feedback menu notice notices related replies reply respond responses "
                   "search share skip social sponsor".split())
# Of those, words that still name furniture at either end of a longer name: "related-articles", "notice-info".
NAMING = TOPICS & frozenset("notice notices related".split())
# With one of these a class says something about the page, not what the element is: "has-sidebar", "cookies-not-set".
ABOUT = frozenset("disable disabled enable enabled free has hide no non not show with without".split())
# Words that name a thing together with one of those: "comment-list", "site-footer".
PARTS = frozenset("area aside bar block blocks body bottom box btn button buttons card cards column container content div element fixed form global group "
                  "head header heading holder icon icons inline inner item items label left link links list main message module outer overlay page "
                  "panel post posts primary region right row secondary section site slot sticky sub text thread title top ui unit wrap wrapper".split())
# Furniture that keeps what it holds, articles included.
FIRM_TAGS = frozenset("nav aside footer dialog".split())
FIRM = frozenset("comment comments commentlist discussion disqus outbrain recommended related replies reply respond responses sponsored taboola".split())
# Elements that hold the article; words in their attributes do not make them furniture.
HOLDERS = frozenset("html body main article".split())
ARTICLE = frozenset("article articlebody blogpost content entry main maincontent post postbody postcontent story storybody".split())
WORDS = re.compile(r"[a-z]+|[0-9]+")

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                 r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)

FEATURES = ("words", "links", "words_before", "links_before", "words_behind", "links_behind", "place", "furniture", "heading")

# Labelled blocks: the features in the order above, then 1 for main text.  place: 1 inside an article element,
# 0 outside one, 0.5 where the page has none.  Link shares are 0 to 1.  Blocks of any length between any neighbours are main text
# inside an article, and are not outside the article of a page or in furniture:
BY_PLACE = tuple((words, 0.0, *before, *behind, place, furniture, 0, int(place == 1 and not furniture))
                 for words in (1, 6, 18, 60, 300) for before in ((0, 0.0), (3, 1.0), (40, 0.0)) for behind in ((0, 0.0), (3, 1.0), (40, 0.0))
                 for place, furniture in ((1, 0), (1, 1), (0, 0), (0, 1), (0.5, 1)))
LABELLED = BY_PLACE + (
    # paragraphs, titles and short lines of articles
    (80, 0.00, 8, 0.0, 60, 0.0, 1, 0, 0, 1), (45, 0.05, 80, 0.0, 30, 0.1, 1, 0, 0, 1), (8, 0.00, 12, 0.0, 80, 0.0, 1, 0, 1, 1),
    (3, 0.00, 120, 0.0, 9, 0.0, 1, 0, 0, 1), (1, 0.00, 2, 0.0, 10, 0.0, 1, 0, 0, 1), (5, 0.00, 5, 1.0, 6, 0.0, 1, 0, 1, 1),
    (25, 0.40, 30, 0.0, 0, 0.0, 1, 0, 0, 1), (12, 0.75, 40, 0.0, 50, 0.0, 1, 0, 0, 1), (300, 0.00, 20, 0.0, 10, 0.0, 1, 0, 0, 1),
    (6, 0.50, 60, 0.0, 60, 0.0, 1, 0, 0, 1), (10, 0.00, 0, 0.0, 0, 0.0, 1, 0, 0, 1), (2, 0.00, 1, 1.0, 1, 1.0, 1, 0, 0, 1),
    (15, 0.85, 60, 0.0, 60, 0.0, 1, 0, 0, 1), (4, 0.00, 300, 0.0, 8, 0.0, 1, 0, 0, 1), (9, 0.00, 200, 0.0, 14, 0.0, 1, 0, 0, 1),
    (20, 0.90, 30, 0.0, 8, 0.0, 1, 0, 0, 1), (9, 0.70, 12, 0.0, 25, 0.0, 1, 0, 0, 1), (30, 0.80, 0, 0.0, 40, 0.0, 1, 0, 0, 1),
    # linked paragraphs, sources and table cells of articles
    (4, 1.00, 4, 1.0, 5, 1.0, 1, 0, 0, 1), (2, 1.00, 50, 0.0, 3, 1.0, 1, 0, 0, 1), (7, 1.00, 6, 1.0, 0, 0.0, 1, 0, 0, 1),
    (6, 1.00, 40, 0.0, 40, 0.0, 1, 0, 0, 1), (1, 1.00, 1, 0.0, 1, 1.0, 1, 0, 0, 1),
    # furniture inside articles: adverts, notices, comments, share bars
    (20, 0.00, 60, 0.0, 60, 0.0, 1, 1, 0, 0), (60, 0.00, 30, 0.0, 40, 0.0, 1, 1, 0, 0), (3, 1.00, 80, 0.0, 3, 1.0, 1, 1, 0, 0),
    (2, 0.00, 90, 0.0, 30, 0.0, 1, 1, 1, 0), (150, 0.00, 4, 0.0, 3, 0.0, 1, 1, 0, 0), (12, 0.10, 12, 0.0, 12, 0.0, 1, 1, 0, 0),
    # outside the article of a page
    (1, 1.00, 0, 0.0, 1, 1.0, 0, 1, 0, 0), (1, 1.00, 1, 1.0, 1, 1.0, 0, 1, 0, 0), (14, 0.00, 1, 1.0, 10, 0.0, 0, 1, 0, 0),
    (30, 0.00, 60, 0.0, 0, 0.0, 0, 1, 0, 0), (30, 0.00, 60, 0.0, 0, 0.0, 0, 0, 0, 0), (9, 0.00, 1, 1.0, 12, 0.0, 0, 0, 0, 0),
    (4, 0.00, 0, 0.0, 5, 1.0, 0, 0, 1, 0), (45, 0.10, 90, 0.0, 3, 1.0, 0, 0, 0, 0), (80, 0.00, 40, 0.0, 40, 0.0, 0, 0, 0, 0),
    (70, 0.00, 10, 0.0, 4, 0.0, 0, 1, 0, 0), (5, 0.00, 70, 0.0, 70, 0.0, 0, 1, 1, 0), (2, 0.00, 3, 1.0, 3, 1.0, 0, 0, 0, 0),
    # pages without an article element: long blocks with few links, and short ones beside them
    (80, 0.00, 8, 0.0, 60, 0.0, 0.5, 0, 0, 1), (40, 0.10, 60, 0.0, 12, 0.0, 0.5, 0, 0, 1), (25, 0.20, 6, 0.0, 35, 0.0, 0.5, 0, 0, 1),
    (18, 0.00, 40, 0.0, 3, 1.0, 0.5, 0, 0, 1), (8, 0.00, 1, 1.0, 80, 0.0, 0.5, 0, 1, 1), (5, 0.00, 60, 0.0, 55, 0.0, 0.5, 0, 1, 1),
    (4, 0.00, 70, 0.0, 45, 0.0, 0.5, 0, 0, 1), (12, 0.00, 30, 0.0, 25, 0.1, 0.5, 0, 0, 1), (200, 0.00, 2, 1.0, 2, 1.0, 0.5, 0, 0, 1),
    (3, 0.00, 90, 0.0, 30, 0.0, 0.5, 0, 0, 1), (11, 0.00, 2, 1.0, 45, 0.0, 0.5, 0, 1, 1), (22, 0.00, 0, 0.0, 0, 0.0, 0.5, 0, 0, 1),
    # furniture of such pages
    (2, 1.00, 0, 0.0, 60, 0.0, 0.5, 0, 0, 0), (5, 1.00, 3, 0.0, 120, 0.0, 0.5, 0, 0, 0), (8, 0.90, 70, 0.0, 90, 0.0, 0.5, 0, 0, 0),
    (14, 0.80, 2, 1.0, 40, 0.0, 0.5, 0, 0, 0), (3, 1.00, 80, 0.0, 45, 0.0, 0.5, 0, 0, 0),
    (2, 1.00, 2, 1.0, 2, 1.0, 0.5, 0, 0, 0), (3, 0.00, 2, 1.0, 2, 1.0, 0.5, 0, 0, 0), (6, 0.80, 4, 1.0, 80, 0.0, 0.5, 0, 0, 0),
    (9, 0.60, 60, 0.0, 4, 1.0, 0.5, 0, 0, 0), (4, 0.00, 3, 1.0, 6, 0.9, 0.5, 0, 1, 0), (15, 0.70, 10, 0.8, 12, 0.9, 0.5, 0, 0, 0),
    (20, 0.90, 30, 0.0, 5, 1.0, 0.5, 0, 0, 0), (5, 0.00, 12, 0.8, 0, 0.0, 0.5, 0, 0, 0), (30, 0.00, 60, 0.0, 0, 0.0, 0.5, 1, 0, 0),
    (60, 0.00, 50, 0.0, 50, 0.0, 0.5, 1, 0, 0), (8, 0.00, 60, 0.0, 60, 0.0, 0.5, 1, 1, 0), (1, 1.00, 80, 0.0, 30, 0.0, 0.5, 1, 0, 0),
    (4, 0.00, 5, 0.0, 0, 0.0, 0.5, 0, 0, 0), (3, 0.00, 0, 0.0, 4, 1.0, 0.5, 0, 0, 0), (7, 0.00, 4, 0.6, 3, 1.0, 0.5, 0, 0, 0),
)


def grow_tree(rows, depth: int = 8, leaf: int = 3):
    """Classification tree by Gini impurity over rows of (features ..., label): nested (feature, cut, low, high) or a label.
    Of equally good splits the first feature and lowest cut win, so training is reproducible."""
    ones = sum(r[-1] for r in rows)
    if depth == 0 or ones in (0, len(rows)):
        return int(2 * ones >= len(rows))

    def impurity(part):
        p = sum(r[-1] for r in part) / len(part)
        return len(part) * p * (1 - p)

    best = None
    for f in range(len(rows[0]) - 1):
        values = sorted({r[f] for r in rows})
        for a, b in zip(values, values[1:]):
            cut = (a + b) / 2
            low, high = [r for r in rows if r[f] <= cut], [r for r in rows if r[f] > cut]
            if min(len(low), len(high)) < leaf:
                continue
            cost = impurity(low) + impurity(high)
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, cut)
    if best is None:
        return int(2 * ones >= len(rows))
    _, f, cut = best
    return (f, cut, grow_tree([r for r in rows if r[f] <= cut], depth - 1, leaf),
            grow_tree([r for r in rows if r[f] > cut], depth - 1, leaf))


def decide(tree, row) -> int:
    while isinstance(tree, tuple):
        f, cut, low, high = tree
        tree = low if row[f] <= cut else high
    return tree


def _hidden(attributes: str) -> bool:
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m.group(1).lower(), (m.group(2) or "").strip("\"'").replace(" ", "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value):
            return True
    return False


def _named(words: list[str], topics: bool) -> set[str]:
    """Furniture words by which a class or id names its element: all of them if the other words only say what kind of thing it
    is, else those at either end that are no topics."""
    found = FURNITURE.intersection(words)
    if not topics:
        found -= TOPICS
    if not found or not ABOUT.isdisjoint(words):
        return set()
    if all(w in FURNITURE or w in PARTS for w in words):
        return found
    return found & {words[0], words[-1]} - (TOPICS - NAMING)


def _marks(tag: str, attributes: str, topics: bool = True) -> tuple[bool, bool, bool, bool]:
    """(furniture, article, header, firm) by element name and attributes; firm furniture keeps the articles in it.
    Without ``topics``, names that may be what a text is about do not count."""
    furniture, article, header, firm = tag in FURNITURE_TAGS, tag in ("article", "main"), tag == "header", tag in FIRM_TAGS
    if _hidden(attributes):
        furniture = firm = True
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m.group(1).lower(), (m.group(2) or "").strip("\"'")
        if name in ("style", "hidden", "aria-hidden"):
            continue
        for token in value.split():
            words = [w for w in WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower()) if len(w) > 1 and not w.isdigit()]
            header |= "header" in words and all(w in FURNITURE or w in PARTS for w in words)
            named = _named(words, topics and not (name == "id" and tag == "section"))
            if FURNITURE.isdisjoint(words):
                article |= not ARTICLE.isdisjoint(words)
            elif named and tag not in HOLDERS:
                furniture = True
                firm |= not FIRM.isdisjoint(named)
    return furniture, article and not furniture, header, firm


def blocks(page: str, topics: bool = True) -> list[dict]:
    """Flat text blocks in page order: text, words, words inside links, and where the block stands.  A block of nothing but button
    labels is furniture."""
    out: list[dict] = []
    stack: list[tuple[str, bool, bool, bool, bool]] = []  # container, and whether it lies in furniture, an article, a header, firm furniture
    parts: list[str] = []
    linked, in_link, heading, pressed, in_button = 0, 0, False, 0, 0
    furniture = article = header = firm = False

    def close():
        nonlocal parts, linked, heading, pressed
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                n = text.count(" ") + 1
                out.append({"text": text, "words": n, "linked": linked, "article": article,
                            "furniture": furniture or (header and not article) or pressed >= n, "heading": heading})
        parts, linked, pressed = [], 0, 0

    def say(text: str):
        nonlocal linked, pressed
        if "&" in text:
            text = html.unescape(text)
        parts.append(text)
        if in_link or in_button:
            n = len(text.split())
            linked += n if in_link else 0
            pressed += n if in_button else 0

    at, skipping, depth = 0, "", 0
    for m in TAG.finditer(page):
        if m.start() < at:
            continue
        if not skipping and m.start() > at:
            say(page[at:m.start()])
        at = m.end()
        name = m.group(2) or m.group(5)
        if name is None:
            continue
        tag, closing, attributes = name.lower(), bool(m.group(1) or m.group(4)), m.group(3) or m.group(6) or ""
        if skipping:
            if tag == skipping:
                depth += -1 if closing else 1
                skipping = skipping if depth else ""
            elif (skipping == "head" and tag == "body") or (skipping not in SKIPPED and tag in BREAKS):
                skipping = ""  # an unclosed head ends where the body begins, a hidden phrase with its block
            if skipping:
                continue
        if tag in SKIPPED:
            if not closing and not attributes.endswith("/"):
                if tag in ("script", "style", "textarea", "title"):  # raw text: ends only at its own end tag
                    end = re.compile(rf"</{tag}\s*>?", re.I).search(page, at)
                    at = end.end() if end else len(page)
                else:
                    skipping, depth = tag, 1
            continue
        if tag not in BREAKS and tag not in VOID and not closing and attributes and not attributes.endswith("/") and _hidden(attributes):
            skipping, depth = tag, 1
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = 0 if closing else 1
        elif tag == "button":
            in_button = 0 if closing else 1
        elif tag in BREAKS:
            close()
            in_link = in_button = 0
            heading = tag in HEADINGS and not closing
            if not closing:
                ended = LINES.union(ENDED_BY.get(tag, "").split())
                if stack and stack[-1][0] in ended:
                    while stack and stack[-1][0] in ended:
                        stack.pop()
                    furniture, article, header, firm = stack[-1][1:] if stack else (False, False, False, False)
            if tag in CONTAINERS:
                if closing:
                    k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
                    if k is not None:
                        del stack[k:]
                    furniture, article, header, firm = stack[-1][1:] if stack else (False, False, False, False)
                elif not attributes.endswith("/"):
                    f, a, top, hard = _marks(tag, attributes, topics)
                    firm = firm or hard
                    if tag in ("article", "main") and not firm:  # ends furniture such as a wrapper with a sidebar's class
                        furniture = False
                    furniture, article, header = furniture or f, article or a, header or top
                    stack.append((tag, furniture, article, header, firm))
            elif not closing and attributes and _marks(tag, attributes, topics)[0]:
                firm = firm or _marks(tag, attributes, topics)[3]
                stack.append((tag, True, article, header, firm))
                furniture = True
            elif closing and stack and stack[-1][0] == tag:
                stack.pop()
                furniture, article, header, firm = stack[-1][1:] if stack else (False, False, False, False)
    if not skipping and at < len(page):
        say(page[at:])
    close()
    return out


def extract(page: str | None, tree) -> str:
    """Main text of one page: its main-text blocks joined by line breaks."""
    found = blocks(page or "")
    kept = _main(found, tree)
    if not kept:  # short texts without an article element
        kept = [b["text"] for b in found if not b["furniture"] and 2 * b["linked"] <= b["words"]]
    if not kept and any(b["furniture"] for b in found):
        kept = _main(blocks(page, topics=False), tree)
    return "\n".join(kept)


def _main(found: list[dict], tree) -> list[str]:
    has_article = any(b["article"] and not b["furniture"] for b in found)
    size = [(0, 0.0), *((b["words"], min(1.0, b["linked"] / b["words"])) for b in found), (0, 0.0)]
    kept = []
    for i, b in enumerate(found, 1):
        place = (1 if b["article"] else 0) if has_article else 0.5
        row = (*size[i], *size[i - 1], *size[i + 1], place, int(b["furniture"]), int(b["heading"]))
        if decide(tree, row):
            kept.append(b["text"])
    return kept


def main_text(pages: DataFrame, html_col: str = "html", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``pages`` with the main text and its number of code points in place of the html."""
    base = pages.select(*[c for c in pages.columns if c not in (text_col, chars_col)])
    at = base.columns.index(html_col)
    rest = [i for i in range(len(base.columns)) if i != at]
    tree = grow_tree(LABELLED)

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                text = [extract(page, tree) for page in part.column(at).to_pylist()]
                yield pa.record_batch([*(part.column(i) for i in rest), pa.array(text, pa.string()),
                                       pa.array([len(t) for t in text], pa.int64())],
                                      names=[*(part.schema.names[i] for i in rest), text_col, chars_col])

    return base.mapInArrow(run, with_fields(base.drop(html_col), **{text_col: T.StringType(), chars_col: T.LongType()}))
