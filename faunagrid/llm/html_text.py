"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is read once from its start to its end, each step in time linear in what it reads, and cut
at block-level tags into text blocks in page order. Each block is described by its own and its
neighbours' word counts and link densities, by how strongly the nearest marked element that
holds it is marked (by its name, or by words of its class or id), by the share of the page's words in
that element, and by articles around it and elsewhere. A decision tree, grown from the small
labelled table below when a worker starts, tells content from the rest: no mark decides by itself.

Defined cases: a null page counts as empty and has an empty text; a page without any markup is one
block; unclosed elements end with the element that holds them, or with the page; a comment, script,
style, title or tag that is never closed hides what follows, as in browsers; output columns replace
input columns of the same names; repeated rows are extracted alike.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faunagrid.llm.storage import arrow_map, table

#: Elements whose content is no markup, and is left out; elements that are left out with what they hold, and those of
#: them that a block ends; inline elements; elements that are never closed.
RAW = "script style title textarea iframe noembed noframes"
DROPPED = "noscript template object canvas audio video svg select button datalist"
ENDED = "svg select button datalist"
INLINE = "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark math optgroup option q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr"
VOID = "area base br col embed hr img input link meta param source track wbr"
#: Elements, roles, and words of classes and ids that hold navigation, notices, adverts, forms or reader comments.
OUTSIDE = "nav footer aside menu dialog"
ROLES = "navigation banner contentinfo complementary search dialog alertdialog form menu menubar toolbar"
WORDS = (
    "ad ads adbox advert adverts advertisement adsense sponsor sponsored promo promoted promotion banner nav navbar navigation menu breadcrumb "
    "breadcrumbs header masthead footer sidebar aside cookie cookies consent notice gdpr popup modal overlay newsletter subscribe signup "
    "share sharing social related recommended widget login search form pagination pager toolbar skip hidden"
)
COMMENTS = "comment comments respond disqus replies"
#: Words before those that make them tell of a layout, as in no-sidebar.
LAYOUT = "no not non with without has have hide show"
INSIDE = "article main"

_SETS = {k: frozenset(v.split()) for k, v in {"raw": RAW, "dropped": DROPPED, "ended": ENDED, "inline": INLINE, "void": VOID, "outside": OUTSIDE, "roles": ROLES, "words": WORDS + " " + COMMENTS, "comments": COMMENTS, "layout": LAYOUT, "inside": INSIDE}.items()}
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
#: The next attribute of a tag, or its end. Nothing is read twice but for a quote that is never closed, of which a page has two at most.
_ATTRIBUTE = re.compile(r"""[\s/]*+(?:(>)|([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+))?)?|=)""")
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in _SETS["raw"]}
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "mark", "share", "inside", "main", "heading"]
#: The labelled table: the features in that order, then 1 for content. links: share of characters in links, in percent; mark: 3 for an
#: element or role, or comments, 2 where all words of a class or an id are marked, 1 where some are; share: of the page's words in the
#: marked element, in percent; inside: held by an article or main; main: share of the page's words that are, in percent.
LABELLED = """
  1 100   0   0   1 100 3  6 0 80 0 0
  1 100   1 100   1 100 3  6 0  0 0 0
  1 100   1 100   8   0 3  8 0 70 0 0
 40   0   1 100  11   0 3 30 0 60 0 0
 80   5   1 100  60   0 3 45 0  0 0 0
 12   0   1 100  10   0 3 12 0  0 0 0
  9   0   2 100   7   0 3 10 0 70 0 0
 14   0  80   0   0   0 3  8 0 85 0 0
 25   0  90   0  30   0 3 20 1 70 0 0
 60   0  70   0  40   0 3 35 1 55 0 0
 30   0  40   0  30   0 3 70 0 10 0 0
 50   0  40   0  60   0 3 80 0  0 0 0
 20   0  30   0  20   0 3 60 1 40 0 0
  2   0   5   0   9   0 3 30 0  0 1 0
200   0  60   0  80   0 3 60 0  0 0 0
  9   0   1 100  40   0 2  8 0 80 0 0
  3   0   1 100  10   0 2  5 0 60 0 0
 14   0  80   0   0   0 2 10 0 50 0 0
 25   0  90   0  30   0 2 15 1 70 0 0
 60   0  70   0  40   0 2 30 1 60 0 0
 45   0   1 100  11   0 2 40 0 30 0 0
 20   0   6   0  12   0 2 45 0 20 0 0
  2   0  90   0  25   0 2  5 1 70 1 0
  1 100  70   0   1 100 2  4 1 80 0 0
 15   0  20   0  20   0 2 10 1 80 0 0
  8   0  10   0  15   0 2  6 1 85 0 0
 30   0  40   0  30   0 2 25 1 75 0 0
  3   0  20   0  10   0 2  8 1 90 1 0
 12   0   4   0   6   0 2 48 0  0 0 0
 30   0  50   0  40   0 2 20 0  0 0 0
 40   0  30   0  50   0 2 85 0  0 0 1
 15   0  12   0  40   0 2 75 0  0 0 1
 90   3   8   0  70   0 2 90 0  0 0 1
  3   0   2 100  30   0 2 95 0  0 1 1
  2 100   1 100   3 100 2 90 0  0 0 0
  5  80   2 100  10   0 2 80 0  0 0 0
 30   0  20   0  30   0 2 90 1 80 0 1
  4   0   1 100   3   0 2 85 1 60 0 1
  1   0   3   0   2   0 2 70 1 55 0 1
  9   0   2 100  40   0 2 80 0 60 0 0
 40   0  10   0  40   0 2 90 0 50 0 0
 20   0  30   0  25   0 1 20 1 70 0 1
  3   0  40   0  20   0 1 15 1 60 1 1
 60   0  20   0  40   0 1 40 1 90 0 1
  1   0   2   0   1   0 1 90 1 50 0 1
  5   0   8   0   7   0 1  8 1 80 0 1
  2 100  60   0   3 100 1  3 1 90 0 0
  4  90  50   0   2 100 1  4 1 80 0 0
  6  60  40   0   1 100 1  5 1 80 0 0
  1 100   1 100   1 100 1  8 0  0 0 0
  4  80   3  90  40   0 1  5 0  0 0 0
  8   0   1 100   5   0 1 10 0  0 0 0
 10   0  60   0   0   0 1  6 0  0 0 0
 12   0  50   0  20   0 1 12 0 70 0 0
 30   0   4   0  50   0 1 30 0 50 0 0
 25   0  20   0  30   0 1 25 0  0 0 0
 40   0  50   0  40   0 1 60 0  0 0 1
 50   0  30   0  60   0 1 90 0  0 0 1
 12   0  30   0  40   0 1 80 0  0 0 1
  5   0  10   0  30   0 1 85 0  0 1 1
 10   0  12   0  60   0 0  0 1 70 1 1
  8   0  40   0  10   0 0  0 1 60 1 1
  3   0   9   0  45   0 0  0 1 80 1 1
  2   0  70   0  30   0 0  0 1 90 1 1
  1   0   8   0   2   0 0  0 1 15 1 1
  1   0   9   0   1   0 0  0 1 10 0 1
 30   0  10   0  80   0 0  0 1 75 0 1
 80   2  30   0  60   0 0  0 1 85 0 1
120   0  80   0   6   0 0  0 1 95 0 1
 60  10  90   0  40   0 0  0 1 80 0 1
 20  30  90   0  40   0 0  0 1 80 0 1
  2   0   9   0  60   0 0  0 1 60 0 1
  1   0  60   0  50   0 0  0 1 70 0 1
  4   0   2   0   3   0 0  0 1 20 0 1
200   1  90   0  12   0 0  0 1 97 0 1
 15   0  12   0   0   0 0  0 1 50 0 1
  4   0   1   0   0   0 0  0 1 90 0 1
 10   0   1 100  40   0 0  0 1 70 1 1
 12   0   1 100   8   0 0  0 1 40 0 1
  3   0   1 100   5   0 0  0 1 30 0 1
 20   0  30   0   2 100 0  0 1 85 0 1
  3   0  20   0   1 100 0  0 1 75 0 1
  9 100  40   0   8 100 0  0 1 85 0 0
  6 100  55   0  50   0 0  0 1 80 0 0
  4  75  60   0  12  95 0  0 1 85 0 0
  2 100  30   0   3 100 0  0 1 70 0 0
 12  90  60   0  10  95 0  0 1 80 0 0
  1 100   1 100  12   0 0  0 0  0 0 0
  3  90   2 100   2 100 0  0 0  0 0 0
  4  80   3  90  40   0 0  0 0  0 0 0
  6  40  60   0   3 100 0  0 0  0 0 0
  4   0  50   0  20   0 0  0 0 60 1 0
  2   0   3 100   2  90 0  0 0  0 0 0
  4   0   1 100   3 100 0  0 0  0 0 0
  3   0   1 100   4 100 0  0 0  0 0 0
  5   0   1 100   0   0 0  0 0  0 0 0
  4   0  12   0   0   0 0  0 0  0 0 0
  6  30   8   0   3 100 0  0 0  0 0 0
  7  60  15   0   2 100 0  0 0  0 0 0
 20  85   5 100   8  90 0  0 0  0 0 0
 40   0  60   0  55   0 0  0 0  0 0 1
 90   3   8   0  70   0 0  0 0  0 0 1
 25  10  60   0  50   0 0  0 0  0 0 1
 12   0  70   0  45   0 0  0 0  0 0 1
  6   0  80   0  60   0 0  0 0  0 0 1
 10   0  12   0  70   0 0  0 0  0 1 1
  5   0  60   0  50   0 0  0 0  0 1 1
 30   0   5   0   0   0 0  0 0  0 0 1
  9   0   1 100  45   0 0  0 0  0 1 1
 40   0   1 100  50   0 0  0 0  0 0 1
 30   0   2 100  60   0 0  0 0  0 0 1
 50   0   1 100   1 100 0  0 0  0 0 1
 40   0  50   0   1 100 0  0 0  0 0 1
 19   6   4   0   6   0 0  0 0  0 0 1
  6   0  19   0  17   0 0  0 0  0 0 1
 17   0   6   0  10   0 0  0 0  0 0 1
 15   0  10   0  20   0 0  0 0  0 0 1
 20   0  15   0   8   0 0  0 0  0 0 1
  8   0  15   0  12   0 0  0 0  0 0 1
 10   0   8   0  10   0 0  0 0  0 0 1
  5   0  20   0  18   0 0  0 0  0 0 1
 12   0   3   0  15   0 0  0 0  0 0 1
  3   0   9   0   9   0 0  0 0  0 0 1
 18   0  18   0  18   0 0  0 0  0 0 1
 25   0  30   0  25   0 0  0 0  0 0 1
 45   0  20   0  15   0 0  0 0  0 0 1
100   0 100   0 100   0 0  0 0  0 0 1
 20   0  20   0   6   0 0  0 0  0 0 1
 20   0   5   0  20   0 0  0 0  0 0 1
  4   0   2 100  19   0 0  0 0  0 1 1
  4   0  15   0  19   0 0  0 0  0 1 1
  5   0  10   0   8   0 0  0 0  0 1 1
 20   0  15   0  18   0 1 15 0  0 0 0
 12   0   9   0   8   0 1 20 0  0 0 0
 35   0  20   0  20   0 1 30 0  0 0 0
 15   0  15   0  15   0 2 85 0  0 0 1
  6   0  12   0   9   0 2 90 0  0 0 1
 20   0   4   0  20   0 2 90 0  0 0 1
 20   0  20   0   5   0 2 90 0  0 0 1
 60   0  60   0  60   0 2 95 0  0 0 1
  4   0  15   0  19   0 2 92 0  0 1 1
 20   0  20   0  20   0 2 90 1 80 0 1
 60   0  60   0  60   0 2 95 1 90 0 1
  4   0   3 100  20   0 2 90 1 70 1 1
 15   0  20   0  10   0 2 90 0 55 0 0
  8   0   3 100  30   0 2 85 0 70 0 0
 70   0  20   0  60   0 2 95 0 45 0 0
 15   0  15   0  15   0 1 90 0  0 0 1
 20   0  20   0   5   0 1 85 0  0 0 1
 20   0  20   0  20   0 1 30 1 70 0 1
 15   0  20   0  20   0 1 25 0 60 0 0
 20   0  20   0  20   0 1 90 0 60 0 0
 15   0   1 100  10   0 0  0 0 70 0 0
 40   0  60   0   5   0 0  0 0 60 0 0
  4   0   2 100  20   0 0  0 0 80 0 0
  2   0   3   0  10   0 0  0 0 50 1 0
  8   0  40   0   0   0 0  0 0 30 0 0
 90   0  40   0  30   0 0  0 0 40 0 0
 60   0  50   0  40   0 0  0 0  8 0 1
 30   0  20   0  60   0 0  0 0  5 0 1
 12   0  40   0  30   0 0  0 0  6 0 1
  4   0   2   0  50   0 0  0 0  7 1 1
  1 100   2 100   1 100 0  0 0  8 0 0
"""

Block = tuple[str, int, int, int, int, int, int, int]
State = tuple[int, int, int, int, bool]  # mark, marked element, inside, heading, dropped


def after(page: str, mark: str, at: int) -> int:
    """Where the next ``mark`` ends; -1 if there is none."""
    found = page.find(mark, at)
    return found + len(mark) if found >= 0 else -1


def attributes(page: str, at: int) -> tuple[int, list[tuple[str, str]], bool]:
    """From after a tag's name: where the tag ends (-1 if it doesn't), its attributes, and whether it closes itself."""
    found = []
    while True:
        m = _ATTRIBUTE.match(page, at)
        if m is None:
            return -1, found, False
        at = m.end()
        if m[1]:
            return at, found, page[at - 2] == "/"
        if m[2]:
            found.append((m[2].lower(), m[3] or m[4] or m[5] or ""))


def blocks(page: str) -> list[Block]:
    """(text, words, links, mark, share, inside, main, heading), as in the table, of each block with text."""
    found: list[tuple[str, int, int, State]] = []
    parts: list[tuple[str, bool]] = []
    stack: list[tuple[str, State]] = []
    counts: dict[str, int] = {}  # of open elements by name, so that an end tag without its start costs nothing
    holders, words_in = [0], [0]  # of each marked element the one around it, and its words; 0 stands for none
    link = False
    plain: State = (0, 0, 0, 0, False)
    state = plain

    def close() -> None:
        if parts:
            text = " ".join(html.unescape("".join(x for x, _ in parts)).split())
            if text:
                linked = " ".join(html.unescape("".join(x for x, a in parts if a)).split())
                words = text.count(" ") + 1
                found.append((text, words, round(100 * len(linked) / len(text)), state))
                words_in[state[1]] += words
            parts.clear()

    def push(name: str, new: State) -> None:
        nonlocal state
        state = new
        stack.append((name, new))
        counts[name] = counts.get(name, 0) + 1

    def pop() -> None:
        nonlocal state
        counts[stack.pop()[0]] -= 1
        state = stack[-1][1] if stack else plain

    def end(name: str) -> None:
        """Closes the innermost element of a name, and those in it."""
        if counts.get(name):
            while stack[-1][0] != name:
                pop()
            pop()

    at, size = 0, len(page)
    while 0 <= at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at and not state[4]:
            parts.append((page[at:start], link))
        at = start + 1
        ending = page.startswith("/", at)
        named = _NAME.match(page, at + ending)
        if named is None:
            if page.startswith(("!", "?", "/"), at):  # comments and the like
                mark = "-->" if page.startswith("!--", at) else "]]>" if page.startswith("![CDATA[", at) else ">"
                at = after(page, mark, at)
            elif start < size and not state[4]:
                parts.append(("<", link))
            continue
        name = named[0].lower()
        at, tags, empty = attributes(page, named.end())
        if at < 0:
            break
        if name in _SETS["raw"]:
            if not ending:
                last = _ENDS[name].search(page, at)
                at = after(page, ">", last.end()) if last else -1
            parts.append((" ", link))
        elif name in _SETS["dropped"]:
            if ending:
                end(name)
            elif not (empty and name == "svg"):
                push(name, (*state[:4], True))
            parts.append((" ", link))
        elif name == "br":
            parts.append((" ", link))
        elif name == "a":
            link = not ending
        elif name not in _SETS["inline"]:
            close()
            link = False
            if ending:
                end(name)
            elif name not in _SETS["void"]:
                while stack and stack[-1][0] in _SETS["ended"]:
                    pop()
                if stack and (stack[-1][0] == "p" or stack[-1][0] == name and name in ("li", "dt", "dd", "tr", "td", "th")):
                    pop()  # its end tag may be left out
                mark, holder, inside, _, gone = state
                own = 0 if name in ("html", "body") else 3 if name in _SETS["outside"] or name == "header" and not inside else max(2 * (name == "form"), marked(tags))
                if own:
                    holders.append(holder)
                    words_in.append(0)
                    mark, holder = own, len(holders) - 1
                inside |= name in _SETS["inside"] or ("role", "main") in tags
                push(name, (mark, holder, int(inside), int(len(name) == 2 and name[0] == "h" and name[1].isdigit()), gone))
    close()
    total = max(1, sum(words_in))
    main = round(100 * sum(x[1] for x in found if x[3][2] and x[3][0] < 3) / total)
    for i in range(len(holders) - 1, 0, -1):
        words_in[holders[i]] += words_in[i]
    return [(text, words, links, mark, round(100 * words_in[holder] / total) if mark else 0, inside, main, heading) for text, words, links, (mark, holder, inside, heading, _) in found]


def marked(tags: list[tuple[str, str]]) -> int:
    """How strongly a tag's attributes tell that it holds no content, as in the table."""
    most = 0
    for name, value in tags:
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "role" and value.lower() in _SETS["roles"]:
            return 3
        if name == "style" and "display:none" in value.lower().replace(" ", ""):
            return 3
        if name in ("class", "id"):
            for token in value.split():
                words = [x for x in re.split(r"[^a-z0-9]+", _CAMEL.sub("-", token).lower()) if x]
                held = [x for x in words if x in _SETS["words"]]
                if held and words[0] not in _SETS["layout"]:
                    most = max(most, 3 if words[0] in _SETS["comments"] else 2 if len(held) == len(words) else 1)
    return most


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8) -> tuple:
    """A decision tree by Gini impurity: (feature, threshold, left, right), or (share of content,)."""
    share = float(y.mean())
    best = (0.0, None, None)
    impurity = 2 * share * (1 - share)
    if depth and impurity:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for low, high in zip(values, values[1:], strict=False):
                cut = (low + high) / 2
                left = x[:, f] <= cut
                a, b = y[left].mean(), y[~left].mean()
                gain = impurity - (left.mean() * 2 * a * (1 - a) + (~left).mean() * 2 * b * (1 - b))
                if gain > best[0] + 1e-12:
                    best = (gain, f, cut)
    if best[1] is None:
        return (share,)
    left = x[:, best[1]] <= best[2]
    return best[1], best[2], grow(x[left], y[left], depth - 1), grow(x[~left], y[~left], depth - 1)


def judge(tree: tuple, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0] > 0.5)
    f, cut, below, above = tree
    left = x[:, f] <= cut
    out = np.zeros(len(x), bool)
    out[left], out[~left] = judge(below, x[left]), judge(above, x[~left])
    return out


@lru_cache(maxsize=1)
def tree() -> tuple:
    data = np.array([line.split() for line in LABELLED.strip().splitlines()], float)
    return grow(data[:, :-1], data[:, -1])


def features(found: list[Block]) -> np.ndarray:
    own = np.array([x[1:3] for x in found], float).reshape(-1, 2)
    nothing = np.zeros((1, 2))
    return np.hstack([own, np.vstack([nothing, own])[:-1], np.vstack([own, nothing])[1:], np.array([x[3:] for x in found], float).reshape(-1, 5)])


def main_text(page: str) -> str:
    found = blocks(page)
    if not found:
        return ""
    return " ".join(x[0] for x, keep in zip(found, judge(tree(), features(found)), strict=True) if keep)


def extract(df: DataFrame, page: str = "html") -> DataFrame:
    """``df`` with ``text``, the main text of each page, and ``n_chars``, its code points."""
    df = df.drop(*({"text", "n_chars"} - {page}))
    at = df.columns.index(page)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(x or "") for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())], [*batch.schema.names, "text", "n_chars"])

    return arrow_map(df, texts, T.StructType([*df.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))


def op6_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.col("html"))
    return extract(pages).select("page_id", "url", "text", "n_chars")
