"""Main text of HTML pages from flat text blocks.

A page is read once into flat blocks (text between block-level tags) with
their word count, link density, the same of their neighbours, and what
encloses them.  A decision tree, trained on the small labelled table below,
says which blocks are main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import batch, bounded_batches, table

#: Tags that end a text block.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td
tfoot th thead title tr ul""".split())
#: Elements whose content is never text of the page: those that hold characters up to their own end tag, and those that hold elements.
RAW = frozenset("script style title textarea iframe".split())
SKIPPED = frozenset("noscript template select button svg math object canvas audio video".split())
#: Start tags that may stand in a head; any other, or text, ends it.
HEAD_TAGS = frozenset("html head base basefont bgsound link meta noscript template".split()) | RAW - {"textarea", "iframe"}
#: Elements that enclose something else than the article, and names (of class, id, role) that say so.
BOILER_TAGS = frozenset("nav footer aside form menu dialog".split())
MAIN_TAGS = frozenset(("article", "main"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HINT = re.compile(r"""\b(?:(?:class|id|role|aria-label)\s*=\s*)(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
BOILER_NAME = re.compile(r"""(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|alert|popup|modal|newsletter|subscri\w*
|nav\w*|menu\w*|breadcrumbs?|sidebar|side-?bar|widget|(?:related|recommend\w*|share|sharing|social)(?=$|\s|[_-]+(?:posts?|articles?|stor(?:y|ies)
|news|links?|buttons?|btns?|bar|box|list|icons?|media|items?|content|block|widget|section|topics?|pages?|tools?|panel|this|us|container|wrapper)\b)|comments?|commentlist|disqus|replies|reply|respond
|footer|foot|masthead|site-?header|page-?header|header|login|signup|search|toolbar|pagination|pager|contentinfo|navigation|complementary)s?(?=$|[\s_-])""", re.I | re.X)
#: Comments, declarations and tags; a quote opens a value only after "=", and one without its end runs to the page's end.
PART = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)*+)(?:>|\Z)", re.S)
NAMES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "boiler", "main", "page_has_main", "heading")

#: Labelled blocks: NAMES (words, link density; the same of the block before and after; inside a menu, advert, form, notice or comment;
#: inside article or main; page has such; heading), then 1 for main text.
LABELLED = (
    (40, 0.0, 60, 0.0, 55, 0.0, 0, 1, 1, 0, 1), (1, 0.0, 12, 0.0, 90, 0.0, 0, 1, 1, 0, 1), (9, 0.0, 0, 0.0, 9, 0.0, 0, 1, 1, 1, 1),
    (3, 0.0, 1, 1.0, 3, 0.0, 0, 1, 1, 1, 1), (120, 0.02, 8, 0.0, 0, 0.0, 0, 1, 1, 0, 1), (12, 0.6, 80, 0.0, 70, 0.1, 0, 1, 1, 0, 1),
    (2, 1.0, 40, 0.0, 30, 0.0, 0, 1, 1, 0, 1), (5, 0.0, 0, 0.0, 0, 0.0, 0, 1, 1, 0, 1), (300, 0.0, 2, 0.0, 15, 0.0, 0, 1, 1, 0, 1),
    (8, 0.0, 1, 1.0, 8, 0.0, 0, 1, 1, 1, 1), (4, 0.0, 150, 0.0, 14, 0.0, 0, 1, 1, 0, 1), (22, 0.3, 4, 1.0, 4, 1.0, 0, 1, 1, 0, 1),
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 1, 0, 0), (8, 0.0, 1, 1.0, 9, 0.0, 1, 0, 1, 0, 0), (14, 0.0, 60, 0.0, 0, 0.0, 1, 0, 1, 0, 0),
    (60, 0.0, 90, 0.0, 70, 0.0, 1, 0, 1, 0, 0), (45, 0.0, 100, 0.0, 30, 0.0, 1, 1, 1, 0, 0), (6, 0.5, 80, 0.0, 40, 0.0, 1, 1, 1, 0, 0),
    (3, 1.0, 40, 0.0, 3, 1.0, 1, 1, 1, 0, 0), (25, 0.0, 8, 0.0, 8, 0.0, 1, 1, 1, 1, 0), (200, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 0, 0),
    (7, 0.0, 70, 0.0, 70, 0.0, 1, 0, 0, 1, 0), (12, 0.2, 0, 0.0, 40, 0.0, 1, 0, 0, 0, 0), (2, 1.0, 2, 1.0, 2, 1.0, 1, 0, 0, 0, 0),
    (6, 0.0, 1, 1.0, 9, 0.0, 0, 0, 1, 0, 0), (50, 0.0, 3, 0.0, 9, 0.0, 0, 0, 1, 0, 0), (10, 1.0, 1, 1.0, 1, 1.0, 0, 0, 1, 0, 0),
    (90, 0.1, 60, 0.0, 0, 0.0, 0, 0, 1, 0, 0), (4, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1, 1, 0), (15, 0.0, 80, 0.0, 6, 0.5, 0, 0, 1, 0, 0),
    (45, 0.0, 60, 0.0, 55, 0.0, 0, 0, 0, 0, 1), (30, 0.1, 5, 0.0, 40, 0.0, 0, 0, 0, 0, 1), (110, 0.02, 2, 1.0, 3, 1.0, 0, 0, 0, 0, 1),
    (25, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (8, 0.0, 50, 0.0, 60, 0.0, 0, 0, 0, 0, 1), (7, 0.0, 2, 1.0, 80, 0.0, 0, 0, 0, 1, 1),
    (5, 0.0, 45, 0.0, 25, 0.0, 0, 0, 0, 0, 1), (18, 0.2, 30, 0.0, 50, 0.0, 0, 0, 0, 0, 1), (9, 0.0, 0, 0.0, 40, 0.0, 0, 0, 0, 1, 1),
    (50, 0.0, 3, 1.0, 45, 0.0, 0, 0, 0, 0, 1), (45, 0.0, 50, 0.0, 1, 1.0, 0, 0, 0, 0, 1), (60, 0.05, 0, 0.0, 2, 1.0, 0, 0, 0, 0, 1),
    (24, 0.0, 2, 1.0, 2, 0.0, 0, 0, 0, 0, 1), (2, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0, 0), (6, 0.9, 40, 0.0, 3, 1.0, 0, 0, 0, 0, 0), (30, 0.8, 50, 0.0, 50, 0.0, 0, 0, 0, 0, 0),
    (20, 1.0, 60, 0.0, 80, 0.0, 0, 0, 0, 0, 0), (4, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0, 0), (6, 0.0, 3, 1.0, 4, 0.0, 0, 0, 0, 0, 0),
    (5, 0.0, 4, 0.0, 3, 0.6, 0, 0, 0, 0, 0), (8, 0.4, 6, 0.5, 5, 0.5, 0, 0, 0, 0, 0), (3, 0.0, 5, 0.0, 4, 0.0, 0, 0, 0, 1, 0),
)


class Tree:
    """CART by Gini impurity, split at midpoints, until leaves are pure."""

    def __init__(self, rows: np.ndarray, y: np.ndarray, least: int = 1):
        self.value = float(y.mean()) if len(y) else 0.0
        self.split: tuple[int, float] | None = None
        if self.value in (0.0, 1.0) or len(y) < 2 * least:
            return
        best = (np.inf, 0, 0.0)
        for f in range(rows.shape[1]):
            cuts = np.unique(rows[:, f])
            for cut in (cuts[1:] + cuts[:-1]) / 2:
                left = rows[:, f] <= cut
                if least <= left.sum() <= len(y) - least:
                    gini = sum(len(part) * part.mean() * (1 - part.mean()) for part in (y[left], y[~left]))
                    best = min(best, (gini, f, float(cut)))
        if best[0] < np.inf:
            self.split = best[1:]
            left = rows[:, best[1]] <= best[2]
            self.low, self.high = Tree(rows[left], y[left], least), Tree(rows[~left], y[~left], least)

    def predict(self, rows: np.ndarray) -> np.ndarray:
        if self.split is None:
            return np.full(len(rows), self.value > 0.5)
        left = rows[:, self.split[0]] <= self.split[1]
        out = np.empty(len(rows), bool)
        out[left], out[~left] = self.low.predict(rows[left]), self.high.predict(rows[~left])
        return out


def trained() -> Tree:
    data = np.array(LABELLED, np.float64)
    return Tree(data[:, :-1], data[:, -1])


def _names(attributes: str) -> str:
    return " ".join(a or b or c for a, b, c in HINT.findall(attributes)) if attributes else ""


def blocks(page: str) -> list[tuple[str, int, float, int, int, int]]:
    """(text, words, link density, boiler, main, heading) of each block with
    text, in page order.  Unclosed elements end with an enclosing element's
    end, or with the page, skipped ones too; a head ends with the first tag or
    text that may not stand in it.  An unclosed element of RAW ends with the
    head or the skipped element around it, else with the page, as in browsers.
    A tag that the page's end cuts off is markup.  Time is linear in the depth
    of the page."""
    out: list = []
    text: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, int, int]] = []  # open containers: tag, boiler so far, main so far
    opened: Counter = Counter()  # start tags without an end tag, outside of skipped elements
    absent: set[str] = set()  # names without an end tag in the rest of the page
    held: Counter = Counter()  # tags in the stack
    inner: Counter = Counter()  # tags in the stack from hidden on
    hidden: int | None = None  # where the outermost open skipped element stands in the stack
    links = heading = 0
    in_head = False
    at, size = 0, len(page)

    def flush() -> None:
        if text:
            words = html.unescape("".join(text)).split()
            if words:
                boiler, main = (stack[-1][1], stack[-1][2]) if stack else (0, 0)
                inside = len(html.unescape("".join(linked)).split())
                out.append((" ".join(words), len(words), min(1.0, inside / len(words)), boiler, main, int(heading > 0)))
            text.clear()
            linked.clear()

    def add(piece: str) -> None:
        nonlocal in_head
        if piece and hidden is None and not (in_head and piece.isspace()):
            in_head = False
            text.append(piece)
            if links:
                linked.append(piece)

    def push(tag: str, boiler: int, main: int) -> None:
        stack.append((tag, boiler, main))
        held[tag] += 1
        if hidden is not None:
            inner[tag] += 1

    def pop() -> str:
        nonlocal hidden
        tag = stack.pop()[0]
        held[tag] -= 1
        if hidden is not None:
            inner[tag] -= 1
            if len(stack) <= hidden:
                hidden = None
                inner.clear()
        return tag

    def pop_to(tag: str) -> None:
        while pop() != tag:
            pass

    def show() -> None:
        while hidden is not None:
            pop()

    def end_of(tag: str) -> re.Match | None:
        got = None if tag in absent else re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
        if not got:
            absent.add(tag)
        return got

    def after_raw(tag: str) -> int:
        """Where the page goes on after an element of RAW that begins at ``at``."""
        around = next(stack[i][0] for i in range(len(stack) - 1, -1, -1) if stack[i][0] in SKIPPED) if hidden is not None else None
        own = end_of(tag)
        if own and tag == "script":  # scripts write tags
            return own.end()
        bound = None
        if (around or in_head) and around not in absent:
            bound = re.compile(rf"</{around}\b" if around else r"</head\b|<body\b", re.I).search(page, at, own.start() if own else size)
        if around and not own and not bound:
            absent.add(around)
        return bound.start() if bound else own.end() if own else at if around in ("svg", "math") else size

    while at < size:
        found = PART.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at:found.start()])
        at = found.end()
        close, tag, attributes = found.group(1), found.group(2), found.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        alone = tag in VOID or attributes.rstrip().endswith("/")
        if in_head:
            if close and tag not in ("head", "body", "html"):
                if inner[tag]:
                    pop_to(tag)
                continue
            if close or tag == "body" or hidden is None and tag not in HEAD_TAGS:
                in_head = False
                show()
            elif hidden is None and tag not in RAW and (tag not in SKIPPED or not end_of(tag)):
                continue
        if hidden is not None:
            inside = (close or tag in ("button", "select")) and inner[tag] > 0  # these don't nest
            if inside:
                pop_to(tag)
            elif close and opened[tag] or tag == "body" and not close and opened["head"] and not opened["body"]:
                show()
            if hidden is not None and not close and not alone:
                if tag in RAW:
                    at = after_raw(tag)
                else:
                    push(tag, *stack[-1][1:])
            if hidden is not None or close and inside:
                continue
        if not close and tag in RAW and not alone:
            if tag not in BLOCK_TAGS:
                add(" ")
            elif not in_head:
                flush()
            at = after_raw(tag)
            continue
        if not close and tag in SKIPPED and not alone:
            add(" ")
            hidden = len(stack)
            push(tag, *(stack[-1][1:] if stack else (0, 0)))
            continue
        if tag == "head" and not close:
            flush()
            in_head = True
            opened[tag] += 1
            continue
        if not alone and not close:
            opened[tag] += 1
        elif close and opened[tag]:
            opened[tag] -= 1
        if tag == "a":
            links = 0 if close else 1
        elif tag == "br":
            add(" ")
        if tag not in BLOCK_TAGS:
            if not close and tag not in VOID and BOILER_NAME.search(_names(attributes)) and not attributes.rstrip().endswith("/") and tag in ("span", "ins", "section"):
                flush()
                push(tag, 1, stack[-1][2] if stack else 0)
            elif close and held[tag]:
                flush()
                pop_to(tag)
            continue
        flush()
        links = 0
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            heading = 0 if close else 1
        elif not close:
            heading = 0
        if tag in ("p", "hr", "li", "dd", "dt", "tr", "td", "th", "option", "optgroup", "html", "body") or tag[0] == "h" and tag[1:].isdigit():
            named = not close and tag not in ("html", "body", "hr") and bool(attributes) and BOILER_NAME.search(_names(attributes))
            if stack and stack[-1][0] == "." + tag:  # a named paragraph or cell ends with the next one
                pop()
            if named:
                push("." + tag, 1, stack[-1][2] if stack else 0)
            continue
        if close:
            if held[tag]:
                pop_to(tag)
            continue
        boiler, main = (stack[-1][1], stack[-1][2]) if stack else (0, 0)
        if tag in MAIN_TAGS and not boiler:
            main = 1
        elif tag in BOILER_TAGS or tag == "header" and not main or attributes and tag not in MAIN_TAGS and BOILER_NAME.search(_names(attributes)):
            boiler = 1
        push(tag, boiler, main)
    flush()
    return out


def table_of(found: list) -> np.ndarray:
    """NAMES of each block; before the first and after the last stand zeros."""
    own = np.array([(w, d) for _, w, d, _, _, _ in found], np.float64).reshape(-1, 2)
    edge = np.zeros((1, 2))
    has_main = np.full((len(found), 1), float(any(b[4] and not b[3] for b in found)))
    flags = np.array([(b[3], b[4]) for b in found], np.float64).reshape(-1, 2)
    heading = np.array([[b[5]] for b in found], np.float64).reshape(-1, 1)
    return np.hstack([own, np.vstack([edge, own])[:-1], np.vstack([own, edge])[1:], flags, has_main, heading])


def main_text(page: str | None, tree: Tree) -> tuple[str, int, int]:
    """(main text, blocks, blocks kept)."""
    found = blocks(page or "")
    if not found:
        return "", 0, 0
    keep = tree.predict(table_of(found))
    parts = [b[0] for b, k in zip(found, keep) if k]
    return "\n\n".join(parts), len(found), len(parts)


def extract(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, url, text, n_chars, n_blocks, n_kept.

    Null or empty html gives an empty text; repeated rows and null ids are
    extracted row by row; extra columns are ignored; an empty table gives an
    empty result.  One scan, no shuffle; a page is held once.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).cast("string").alias("_html"))
    types = [("text", pa.string()), ("n_chars", pa.int64()), ("n_blocks", pa.int64()), ("n_kept", pa.int64())]

    def run(batches):
        tree = trained()
        for b in batches:
            got = [main_text(p, tree) for p in b.column(2).to_pylist()]
            schema = pa.schema([("_id", b.column(0).type), ("_url", b.column(1).type), *types])
            yield batch(schema, b.column(0), b.column(1), [t for t, _, _ in got], [len(t) for t, _, _ in got], [n for _, n, _ in got], [k for _, _, k in got])

    kinds = [rows.schema[c].dataType.simpleString() for c in ("_id", "_url")]
    return rows.mapInArrow(run, f"_id {kinds[0]}, _url {kinds[1]}, text string, n_chars long, n_blocks long, n_kept long").withColumnsRenamed({"_id": id_col, "_url": url_col})


def op7_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars", "n_blocks", "n_kept")
