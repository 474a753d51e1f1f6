"""Main text of web pages as the maximum-scoring run of tokens.

A page is a sequence of words and tags. Words score positive, tags negative, and so do words
in links and in parts that are no content by their element or by the names they carry. The
contiguous run of the highest sum, found in one linear scan, is the content region; its
blocks, without the parts just named, are the text.

Weights are learned from labelled pages: those that mark their content by an ``article`` or
``main`` element. A token's weight is the logarithm of how much likelier it is inside the marked
part than outside, over counts of all labelled pages. Known element names are counted, others
together, so the weights are few. The scan decides on labelled pages too; only marked parts
that its region does not reach are added, each by a scan of its own.

A null or empty page has an empty text. Pages are read whole and broken markup is read on:
unknown closings are skipped, open elements end with their parents or the page.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolwright.llm.common import column, in_slices

# Names of elements and of page parts.
#: Elements whose edges end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split())
#: Elements that stand in a line of text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements without an end.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are no content.
OUTSIDE = frozenset(
    "aside button canvas datalist dialog footer form frameset head iframe input menu nav noscript object optgroup option select svg template textarea title audio video map".split())
#: Elements whose content is no markup.
RAW = frozenset("script style noembed noframes xmp plaintext".split())
#: Words of a class, id or role that name a part which is no content.
PARTS = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies disqus footer gdpr "
    "login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager paginate pagination paywall popup promo promoted promotion "
    "recommendations recommended related replies reply respond search share sharing sidebar signin signup social sponsor sponsored subscribe subscription toolbar "
    "topbar tracking widget widgets".split())
#: Names that mean a part of the page only outside its content.
PAGE_PARTS = frozenset("header".split())
#: Words of a layout, which may stand beside a part's word in its name; any other word there means something else.
LAYOUT = frozenset(
    "a area articles bar big block body bottom bottoms box btn button buttons card col column container content controls default el element entry feed fixed footers form full group "
    "head heading holder icons inline inner item items js label large left links list main media mobile module network outer page panel post posts primary region right row secondary "
    "section sections site slot small space sticky stories text thread title top unit view wrap wrapper zone".split())
#: Quotations and the like within the content, whose names are not looked at.
QUOTES = frozenset("blockquote pre figure table".split())
#: Elements that are the content, whatever their names.
CONTENT = frozenset("article main".split())
#: Headings count as one class.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose names are not looked at.
UNNAMED = frozenset("html body h1 h2 h3 h4 h5 h6 p".split())
#: Names that tell a content element is a part after all.
CONTENT_PARTS = frozenset("ad ads advert advertisement comment comments promo promoted related replies reply respond sponsored teaser".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
NAMES = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?=[\s/]|$))""", re.I)
PIECES = re.compile(r"[^a-zA-Z0-9]+|(?<=[a-z])(?=[A-Z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: Weight of a tag, or of a part's text, within marked content.
LIGHT = -0.01
#: Classes of words: in content, in a link, in a part that is no content.
WORD, LINKED, PART, PART_TAG = "word", "linked word", "part word", "part tag"
#: Weight of a tag that no labelled page has: of a block, and within a line.
NEW_BLOCK, NEW_INLINE = -1.5, -0.1


def names_a_part(name: str, attributes: str, inside: bool, named: bool = True) -> bool:
    """Whether an element's class, id, role (unless not ``named``) or style says that it is no content."""
    if not attributes or name in UNNAMED:
        return False
    named = named and not (inside and name in QUOTES)
    for key, value in NAMES.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "style":
            if HIDDEN.search(value):
                return True
        elif key == "hidden":
            return True
        elif key == "aria-hidden":
            if value.lower() == "true":
                return True
        elif named:
            for one in value.split():
                words = {w.lower() for w in PIECES.split(one) if w and not w.isdigit()}
                known = CONTENT_PARTS if name in CONTENT else PARTS if inside else PARTS | PAGE_PARTS
                if words & known and words <= known | PARTS | PAGE_PARTS | LAYOUT:
                    return True
    return False


def tokens(page: str, wrappers: frozenset[int] = frozenset(), found_wrappers: set[int] | None = None) -> Iterator[tuple[str, str, bool, bool]]:
    """Tokens of a page in order: (kind, text, in the marked content, in a part that is no content).

    Kinds: an element's name for its start, ``/name`` for its end, and for text one of the word classes.
    ``wrappers`` are numbers of elements whose names do not count. ``found_wrappers`` takes those that
    should not: what holds a page's first content element where none stands free, or half of the text of a page without any.
    """
    open_: list[tuple[str, bool, bool]] = []  # name, part, content
    names: Counter[str] = Counter()  # of open elements
    by_name: list[tuple[int, int]] = []  # open parts that only their names make parts: place in open_, number
    number = free = shown = 0
    holders: list[int] = []
    sizes: Counter[int] = Counter()
    parts = links = content = 0
    at, end = 0, len(page)
    while at < end:
        found = TAG.search(page, at)
        text = page[at : found.start() if found else end]
        if text:
            if found_wrappers is not None and parts == len(by_name):
                size = len(text.strip())
                shown += size
                if by_name:
                    sizes[by_name[0][1]] += size
            yield (PART if parts else LINKED if links else WORD), text, content > 0, parts > 0
        if not found:
            break
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        if found[1] or found[4]:
            if name in INLINE:
                if name == "a" and links:
                    links -= 1
                    yield "/a", "", content > 0, parts > 0
                continue
            was = parts > 0
            if names[name]:
                while open_:
                    n, part, held = open_.pop()
                    names[n] -= 1
                    if by_name and by_name[-1][0] == len(open_):
                        by_name.pop()
                    parts -= part
                    content -= held
                    if n == name:
                        break
                links = 0
            yield "/" + name, "", content > 0, was
            continue
        if name in RAW:
            close = re.compile(rf"</{name}\s*>", re.I).search(page, at) if name != "plaintext" else None
            at = close.end() if close else end
            yield name, "", content > 0, parts > 0
            continue
        if name in INLINE:
            links += name == "a"
            yield name, "", content > 0, parts > 0
            continue
        if name in VOID or (found[3] or found[6] or "").endswith("/"):
            yield name, "", content > 0, parts > 0
            continue
        if name in ("p", "li", "td", "th", "tr", "dt", "dd", "option") and open_ and open_[-1][0] == name:
            _, part, held = open_.pop()  # its end is left out
            names[name] -= 1
            if by_name and by_name[-1][0] == len(open_):
                by_name.pop()
            parts -= part
            content -= held
        number += 1
        attributes = found[3] or found[6] or ""
        part = name in OUTSIDE or (name == "header" and not content) or names_a_part(name, attributes, content > 0, number not in wrappers)
        holds = name in CONTENT and not part and not parts
        free += holds
        if name in CONTENT and not part and by_name and parts == len(by_name) and not holders:
            holders = [k for _, k in by_name]
        if part and name not in OUTSIDE and name not in CONTENT and name != "header" and not names_a_part(name, attributes, content > 0, False):
            by_name.append((len(open_), number))
        yield name, "", content > 0, part or parts > 0
        open_.append((name, part, holds))
        names[name] += 1
        parts += part
        content += holds
    if found_wrappers is not None and not free:
        most = max(sizes, key=sizes.__getitem__, default=0)
        found_wrappers.update(holders or ([most] if 2 * sizes[most] > shown else []))


def parsed(page: str) -> list[tuple[str, str, bool, bool]]:
    """Tokens of a page, where names of its wrappers do not count."""
    known: set[int] = set()
    while True:
        more: set[int] = set()
        out = list(tokens(page, frozenset(known), more))
        if more <= known:
            return out
        known |= more


def _class(kind: str, part: bool) -> str:
    """The class under which a token is counted; tags of a part that is no content tell nothing about other tags."""
    if kind in (WORD, LINKED, PART):
        return kind
    if part:
        return PART_TAG
    name = kind.lstrip("/")
    if name in HEADINGS:
        return "heading"
    return name if name in BLOCKS or name in INLINE or name in RAW or name in OUTSIDE else "other"


def count_tokens(page: str) -> Counter[tuple[str, bool]]:
    """Tokens of a labelled page by class and by whether the marked content holds them; none of other pages."""
    out: Counter[tuple[str, bool]] = Counter()
    marked = False
    for kind, text, content, part in parsed(page):
        marked |= content
        n = len(text.split()) if kind in (WORD, LINKED, PART) else 1
        if n:
            out[_class(kind, part), content] += n
    return out if marked else Counter()


def weigh(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Weights of all classes: words positive, tags and words that are no content negative."""
    inside, outside = (sum(n for (_, c), n in counts.items() if c is side) + 1 for side in (True, False))

    def ratio(name: str) -> float:
        return math.log((counts.get((name, True), 0) + 0.5) / inside) - math.log((counts.get((name, False), 0) + 0.5) / outside)

    out = {PART: -0.02, PART_TAG: -1.0, LINKED: -0.5} | {name: min(-0.05, max(-12.0, ratio(name))) for name in {n for n, _ in counts} | {"other"}}
    out[WORD] = min(1.0, max(0.2, ratio(WORD)))
    # bounded, so that a link or an advert within the content does not cut it in two: its text is left out anyway
    out[PART] = min(-0.01, max(-0.02, ratio(PART)))
    out[PART_TAG] = min(-0.05, max(-1.0, ratio(PART_TAG)))
    out[LINKED] = min(-0.1, max(-1.0, ratio(LINKED)))
    return out


def best_run(values: list[float], begin: int, end: int) -> tuple[int, int]:
    """The run of the highest sum within ``begin`` to ``end``, in one scan; empty if no sum is positive."""
    total = best = 0.0
    first, out = begin, (begin, begin)
    for i in range(begin, end):
        total += values[i]
        if total > best:
            best, out = total, (first, i + 1)
        elif total <= 0:
            total, first = 0.0, i + 1
    return out


def extract(page: str, weights: dict[str, float]) -> str:
    """Text of a page's content region: blocks in order, two line ends between them.

    The best run of the whole page counts, whether or not the page marks anything. Marked parts that it does not
    touch are regions of their own, with their best run. A run's first and last block are taken whole.
    """
    found = parsed(page)
    values, block_of, block = [], [], 0
    for kind, text, content, part in found:
        if kind in (WORD, LINKED, PART):
            weight = weights.get(PART if part else kind, 0.0)
            # what is left out anyway does not cut marked content in two
            values.append(max(weight, LIGHT) if content and part else weight * len(text.split()))
        else:
            name = kind.lstrip("/")
            block += name not in INLINE
            weight = weights.get(_class(kind, part), NEW_INLINE if name in INLINE or content else NEW_BLOCK)
            values.append(max(weight, LIGHT) if content and part else weight)
        block_of.append(block)
    begin, end = best_run(values, 0, len(found))
    runs = [(begin, end)] if end > begin else []
    at = 0
    while at < len(found):
        last = at + 1
        if found[at][2]:
            while last < len(found) and found[last][2]:
                last += 1
            if end <= at or begin >= last:
                run = best_run(values, at, last)
                runs += [run] if run[1] > run[0] else []
        at = last
    taken = {block_of[i] for a, b in runs for i in range(a, b) if found[i][0] in (WORD, LINKED) and not found[i][3] and not found[i][1].isspace()}
    texts: dict[int, list[str]] = {}
    for number, (kind, text, _, part) in zip(block_of, found):
        if part or number not in taken:
            continue
        if kind in (WORD, LINKED, "br", "wbr"):
            texts.setdefault(number, []).append(" " if kind == "br" else text)
    out = (" ".join(html.unescape("".join(t)).split()) for t in texts.values())
    return "\n\n".join(t for t in out if t)


def learn(pages: DataFrame) -> dict[str, float]:
    """Weights from all labelled pages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[tuple[str, bool]] = Counter()
        for batch in in_slices(batches, "html", 4 << 20):
            for page in batch.column("html"):
                total.update(count_tokens(page.as_py() or ""))
        rows = [(name, side, n) for (name, side), n in total.items()]
        names, sides, n = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sides, pa.bool_()), pa.array(n, pa.int64())], ["name", "inside", "n"])

    counted = pages.select(column(pages, "html", "string").alias("html")).mapInArrow(run, "name string, inside boolean, n long")
    found = counted.groupBy("name", "inside").agg(F.sum("n").alias("n")).collect()
    return weigh({(r["name"], r["inside"]): r["n"] for r in found})


def extract_pages(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Rows (page_id, url, text, n_chars) of all pages."""
    if weights is None:
        weights = learn(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "html", 4 << 20):
            texts = [extract(page.as_py() or "", weights) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    rows = pages.select(column(pages, "page_id", "long").alias("page_id"), column(pages, "url", "string").alias("url"), column(pages, "html", "string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
