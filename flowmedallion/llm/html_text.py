"""Main-text extraction: the maximum-scoring subsequence of a page's words and tags.

A page is read as a sequence of words and tags.  Words score positive and tags negative;
one linear scan finds the contiguous run with the highest sum, the content region.  The
weights come from labelled pages, those that mark their article by an article element:
a tag weighs the log odds of standing inside a labelled article rather than outside, never
above zero, and so does a word by whether it is a link, never below zero unless it is one.

Elements that are no content by their name, role, class or id (menus, adverts, comments and
so on, see BARRED and BARRED_NAMES) are no part of the sequence.  A class, id or role tells
that only if it consists of such names and of words for parts of a page (HELPERS).  No element
is left out that holds an article or main element; nor is one, forms included, for its names
if it holds most of the page's words, unless they are comments.  Pages of which nothing would
be left are read again without names.  Within an article or main element tags cost nothing, at its
borders they do.  The run decides what is content; of a run most of whose
score lies in one article or main element, the part outside that element is cut.

Text is taken in page order: character references are decoded, white space within a block
becomes one space, blocks are joined by line feeds, empty ones vanish.  A null or empty page
gives empty text, as does a page without words.  Pages are taken whole.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmedallion.llm.batches import append_columns, slices, small_batches, utf8

FIT_PAGES = 3_000
"""About so many pages are read for the weights: a hashed share of all."""

# Fixed values of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body canvas caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style textarea title".split()
"""Elements whose content is no markup; without an end tag they run to the end of the page."""
CLOSED = frozenset("noscript template iframe svg math object head select xmp noframes".split())
"""Elements that are no content as far as an end tag; without one, only their tag goes."""
# Elements and words of class, id and role that are no content.
BARRED = frozenset("nav footer aside form button menu dialog label fieldset input".split())
BARRED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot sponsor sponsored sponsors promo promotion promoted banner "
    "cookie cookies consent gdpr notice notices notification alert alerts popup modal overlay newsletter subscribe subscription "
    "signup signin login register paywall nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar sidebars "
    "aside widget widgets related recommended recommendations trending share sharing social footer header masthead topbar toolbar "
    "comment comments commentlist respond reply replies disqus discussion copyright legal pagination pager skip search searchbox "
    "complementary contentinfo navigation tags taglist byline-links outbrain taboola hidden".split()
)
COMMENTS = frozenset("comment comments commentlist respond reply replies disqus discussion".split())
HELPERS = frozenset(
    "area bar block bottom box button buttons col column container content desktop div fixed group inner item items left link links list "
    "main mobile outer panel post posts primary right row secondary section site slot sticky title top unit wrap wrapper".split()
)
WRAPPERS = frozenset("form fieldset label".split())

# Attributes; quotes enclose a value only behind an equals sign.
REST = r"""(?:[^>=]|=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*)?)*"""
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # Foreign elements that close themselves; the slash of an unquoted value is part of the value.
    r"""|<(?:svg|math|iframe|object)(?=[\s/>])(?:[^>=/]|/(?!>)|=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*)?)*+/>"""
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])" + REST + r">.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>" + REST + r")(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
CLOSING = re.compile(r"</(" + "|".join(sorted(CLOSED)) + r")\s*>", re.I)
BODY = re.compile(r"<body(?=[\s/>])", re.I)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""\b(?:hidden(?=[\s/>]|\Z)|aria-hidden\s*=\s*["']?true|display\s*:\s*none)""", re.I)
PART = re.compile(r"[^a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
HOMES = ("article", "main")

Token = tuple[str, str, str]
"""Kind (word, open, close), then text or tag name, then the tag's attributes."""


def read(page: str) -> list[Token]:
    """Words come as runs of text between tags.

    A head ends at its end tag or at the body, whichever comes first.
    """
    ends: dict[str, list[int]] = {}
    for m in CLOSING.finditer(page):
        ends.setdefault(m[1].lower(), []).append(m.end())
    body = BODY.search(page)
    out, at = [], 0
    while m := TOKEN.match(page, at):
        at = m.end()
        if (text := m["text"]) is not None:
            out.append(("word", text, ""))
        elif m["name"]:
            name = m["name"].lower()
            if name in CLOSED and not m["close"]:
                known = ends.get(name, [])
                end = known[k] if (k := bisect_right(known, at)) < len(known) else None
                if name == "head" and body and body.start() >= at and (end is None or body.start() < end):
                    end = body.start()
                if end is not None:
                    at = end
                    continue
            out.append(("close" if m["close"] else "open", name, m["rest"]))
        if at == len(page):
            break
    return out


def barred(name: str, rest: str, at_home: bool) -> str:
    """Why an element is no content, or nothing: element, wrapper, comments or name; headers count as content
    inside an article or main element."""
    if name in WRAPPERS:
        return "wrapper"
    if name in BARRED or name == "header" and not at_home:
        return "element"
    if not rest or name in ("html", "body", *HOMES):
        return ""
    if HIDDEN.search(rest):
        return "name"
    for groups in NAMED.findall(rest):
        for told in next(filter(None, groups), "").split():
            parts = [p for p in PART.split(CAMEL.sub(" ", told).lower()) if p and not p.isdigit()]
            names = [p for p in parts if p in BARRED_NAMES and not (at_home and p == "header")]
            if names and all(p in names or p in HELPERS for p in parts):
                return "comments" if COMMENTS.intersection(names) else "name"
    return ""


def element_ends(tokens: list[Token]) -> list[int | None]:
    """For each opening token the place after its element, None if nothing closes it; one pass from the left for
    elements, which close the latest open one of their name, and one from the right for paragraphs, which end before the next block."""
    ends: list[int | None] = [None] * len(tokens)
    waiting: dict[str, list[int]] = {}
    for i, (kind, name, _) in enumerate(tokens):
        if kind == "open":
            if name in VOID:
                ends[i] = i + 1
            else:
                waiting.setdefault(name, []).append(i)
        elif kind == "close" and waiting.get(name):
            ends[waiting[name].pop()] = i + 1
    behind = len(tokens)
    for i in range(len(tokens) - 1, -1, -1):
        kind, name, _ = tokens[i]
        if kind == "open" and name == "p":
            ends[i] = behind
        if kind == "open" and name in BLOCKS:
            behind = i
        elif kind == "close" and name == "p":
            behind = i + 1
    return ends


def content(tokens: list[Token], by_name: bool = True) -> tuple[list[bool], list[tuple[int, int]]]:
    """Which tokens are not inside a barred element, and the spans of article and main elements."""
    ends = element_ends(tokens)
    words, homes_before, linked = [0], [0], False  # unlinked words and homes before each token
    for kind, name, _ in tokens:
        if name == "a" and kind != "word":
            linked = kind == "open"
        words.append(words[-1] + (len(name.split()) if kind == "word" and not linked else 0))
        homes_before.append(homes_before[-1] + (kind == "open" and name in HOMES))
    keep, homes, home_end = [True] * len(tokens), [], 0
    i = 0
    while i < len(tokens):
        kind, name, rest = tokens[i]
        if kind == "open":
            why = barred(name, rest, home_end > i)
            if why and (by_name or why == "element"):
                end = ends[i]
                if end is not None:
                    most = why in ("wrapper", "name") and 2 * (words[end] - words[i]) > words[-1]
                    if not most and homes_before[end] == homes_before[i]:
                        keep[i:end] = [False] * (end - i)
                        i = end
                        continue
            elif name in HOMES:
                end = ends[i] or len(tokens)
                homes.append((i, end))
                home_end = max(home_end, end)
        i += 1
    return keep, homes


def kinds(tokens: list[Token]) -> Iterator[tuple[str, int]]:
    """Each token's feature and how often it counts: words by whether they are links, tags by name."""
    linked = 0
    for kind, name, _ in tokens:
        if kind == "word":
            yield ("link" if linked else "word"), len(name.split())
        else:
            if name == "a":
                linked = 1 if kind == "open" else 0
            yield (f"{kind} {name}" if name in BLOCKS or name in INLINE else f"{kind} other"), 1


DEFAULT = {"word": 1.0, "link": -0.5, "tag": -0.5}
"""Weights where no page is labelled; a tag without a weight of its own costs half a word."""
HOME_LINK = 0.01
"""Score of a link's word within an article or main element."""


def weights_of(inside: Counter, outside: Counter) -> dict[str, float]:
    """Weights from counts of features inside and outside labelled articles."""
    out = dict(DEFAULT)
    for feature in inside.keys() | outside.keys():
        odds = math.log((inside[feature] + 1) / (outside[feature] + 1))
        if feature == "word":
            out[feature] = min(3.0, max(0.5, odds))
        elif feature == "link":
            out[feature] = min(1.0, max(-3.0, odds))
        else:
            out[feature] = min(-0.25, max(-6.0, odds))
    out["tag"] = -0.5 * out["word"]
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """The first run with the highest positive sum; (0, 0) if there is none."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, found = total, (start, i + 1)
    return found


def scored(tokens: list[Token], keep: list[bool], homes: list[tuple[int, int]], weights: dict[str, float]) -> list[float]:
    """Each token's score; within an article or main element tags cost nothing and links are worth a little."""
    turn = [0] * (len(tokens) + 1)
    for a, b in homes:
        turn[a + 1] += 1
        turn[max(a + 1, b - 1)] -= 1
    out = []
    for (feature, n), kept, depth in zip(kinds(tokens), keep, accumulate(turn[:-1])):
        own = weights.get(feature, weights["tag"])
        if depth and feature != "word" and feature.split()[-1] not in HOMES:
            own = HOME_LINK if feature == "link" else 0.0
        out.append(own * n if kept else 0.0)
    return out


def main_text(page: str, weights: dict[str, float]) -> str:
    tokens = read(page)
    for by_name in (True, False):
        keep, homes = content(tokens, by_name)
        scores = scored(tokens, keep, homes, weights)
        start, end = best_run(scores)
        if end:
            break
    gains = [0.0, *accumulate(max(s, 0.0) for s in scores)]
    most = 0.7 * (gains[end] - gains[start])
    inner = [(max(a, start), min(b, end)) for a, b in homes if a < end and b > start]
    held = [(b - a, a, b) for a, b in inner if gains[b] - gains[a] >= most > 0]
    if held:
        _, start, end = min(held)
    blocks: list[list[str]] = [[]]
    for i in range(start, end):
        kind, name, _ = tokens[i]
        if kind == "word":
            if keep[i]:
                blocks[-1].append(html.unescape(name))
        elif name == "br":
            blocks[-1].append(" ")
        elif name in BLOCKS and blocks[-1]:
            blocks.append([])
    texts = (" ".join("".join(parts).split()) for parts in blocks)
    return "\n".join(filter(None, texts))


def learn_weights(pages: DataFrame, page: str = "html", fit_pages: int = FIT_PAGES) -> dict[str, float]:
    """Weights from pages with exactly one article element; without any, DEFAULT."""
    texts = pages.filter(f"{page} is not null").select(F.col(page).alias("html"))
    share = min(1.0, fit_pages / max(1, texts.count()))
    chosen = texts.filter(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bool, Counter] = {True: Counter(), False: Counter()}
        for batch in batches:
            for piece in slices(batch, "html"):
                for data in utf8(piece.column("html")):
                    tokens = read(data.decode(errors="replace"))
                    keep, homes = content(tokens)
                    marked = [(a, b) for a, b in homes if tokens[a][1] == "article"]
                    if len(marked) == 1:
                        for i, (feature, n) in enumerate(kinds(tokens)):
                            if keep[i]:
                                counts[marked[0][0] < i < marked[0][1] - 1][feature] += n
        rows = [(inside, feature, n) for inside, counted in counts.items() for feature, n in counted.items()]
        cols = list(zip(*rows, strict=True)) or [(), (), ()]
        types = (pa.bool_(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["inside", "feature", "n"])

    found = small_batches(chosen).mapInArrow(count, "inside boolean, feature string, n long").groupBy("inside", "feature").agg(F.sum("n").alias("n"))
    inside, outside = Counter(), Counter()
    for r in found.collect():  # features are a fixed set
        (inside if r["inside"] else outside)[r["feature"]] += r["n"]
    return weights_of(inside, outside) if inside["word"] else dict(DEFAULT)


def with_main_text(df: DataFrame, weights: dict[str, float], page: str = "html", name: str = "text") -> DataFrame:
    """Add the main text of each page as column ``name``; a column called so is replaced."""

    def make() -> Callable:
        def work(pages: list[bytes | None]) -> list[pa.Array]:
            return [pa.array([main_text(data.decode(errors="replace"), weights) if data else "" for data in pages], pa.string())]

        return work

    return append_columns(df, page, f"{name} string", make)
