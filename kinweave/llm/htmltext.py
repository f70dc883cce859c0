"""HTML extraction: flat text blocks, classified by a decision tree, joined into the main text.

A page is cut into flat blocks at block-level tags. Each block has its word
count, its link density (share of its words inside links), those of the blocks
before and after it, and where it stands: inside the page's main element,
inside furniture (navigation, forms, asides, comments and elements that are
named like that or hidden), or a heading. A decision tree, trained on the labelled table
below, says which blocks are text of the article. Whole pages are processed in
Python, a page at a time.

Defined edge cases: a null or empty html, and one without article text, gives
''; a tag cut off at the end of the page is dropped; repeated rows each get a
row; null page_id and url stay null; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

#: Elements that begin and end a block.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements whose content is no text of the page, up to their end tag. Of RAW ones that never end, the rest of the page is content; of others without an end tag only the tag is dropped.
OPAQUE = frozenset("script style title noscript template textarea select iframe svg math object applet noframes datalist button canvas audio video".split())
RAW, FOREIGN = frozenset(("script", "style")), frozenset(("svg", "math"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold no article text; header only outside the main element, where it may hold the title.
FURNITURE = frozenset("nav aside footer form menu dialog fieldset".split())
#: Parts of class, id and role that name furniture, unless a word before them says that the element is only around it or beside it.
NAMED = re.compile(r"(?<![a-z])(?<!has-)(?<!has_)(?<!with-)(?<!with_)(?<!no-)(?<!no_)(?<!without-)(?:ads?|advert\w*|adsense|banner|promo\w*|sponsor\w*|nav\w*|menus?|side-?_?bar|comments?|comment-?\w*|disqus|repl(?:y|ies)|respond|footer|header|masthead|cookies?|consent|gdpr|notices?|alert|disclaimer|newsletter|subscri\w*|sign-?up|login|search|share|sharing|social|related|recommend\w*|breadcrumbs?|pagination|pager|widget|popup|modal|overlay|toolbar|contentinfo|complementary|navigation)(?![a-z])", re.I)
COMMENTS = re.compile(r"(?<![a-z])(?:comment|disqus|repl(?:y|ies)|respond)", re.I)
MAIN_NAMED = re.compile(r"(?<![a-z])(?:main|articlebody|article-?body|post-?content|entry-?content)(?![a-z])", re.I)
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|itemprop|hidden|aria-hidden|style)(?![\w-])\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>|<[!?/][^>]*>|<[a-zA-Z!?/][^>]*\Z", re.S)
SPACES = re.compile(r"\s+")
UNQUOTED = re.compile(r"=\s*[^\s\"'>]+/\Z")
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: What an open element is: the main element; furniture by its tag or for being hidden, or comments; furniture by its name, in which a main element may still begin.
OPEN_MAIN, OPEN_FURNITURE, OPEN_NAMED = 1, 2, 3

#: The labelled table. Columns: place (1 inside the main element, 0 the page has none, -1 outside it), furniture, heading, words, link density in percent, words and density of the block before, words and density of the block after (0, 0 at the ends), label (1 article).
LABELLED = """
 1 0 1  9   0  6 100 60   0 1 | 1 0 0 60   0  9   0 45   0 1 | 1 0 0 45   5 60   0 30   0 1 | 1 0 0  1   0 60   0 25   0 1 | 1 0 0  3   0  9   0  2   0 1
 1 0 0 25  60 30   0 40   0 1 | 1 0 0  2 100 40   0 30   0 1 | 1 0 0 12   0 20   0  7  50 1 | 1 0 0 200  2 90   0  0   0 1 | 1 0 1  4   0 80   0 70   0 1
 1 0 0  8   0  0   0  0   0 1 | 1 0 0 30   0  5 100 12   0 1 | 1 0 0 15 100 50   0 60   0 1 | 1 0 0  5   0 10   0 10 100 1 | 1 0 0 90   0 12   0  3   0 1
 1 1 0  6 100 80   0  5 100 0 | 1 1 0 25   0 60   0 30   0 0 | 1 1 0 50   0 40   0 10   0 0 | 1 1 1  2   0 70   0 20   0 0 | 1 1 0  9   0 25   0 60   0 0
 1 0 0  6   0  5   0  4   0 1 | 1 0 0  2 100  1 100 60   0 1 | 1 0 0  9   0 50   0  0   0 1 | 1 0 0  5   0  2 100  1 100 1 | 1 0 0  7   0 60   0  3 100 1
 1 0 0 10  50  3 100  2 100 1 | 1 0 0  3   0  0   0  2 100 1 | 1 0 0  2   0  1 100 60   0 1 | 1 0 0 12 100 60   0 14 100 1 | 1 0 1  3   0 12   0  4 100 1
 1 0 0  4   0  3 100  4 100 1 | 1 0 0  8   0 90   0  0   0 1 | 1 0 0 18   0 50   0  9   0 1 | 1 0 0 14   5 200  0  0   0 1 | 1 0 0 30  70 40   0 10  90 1
-1 0 0  2 100  1 100  2 100 0 | -1 0 0 25   0  3 100 40   0 0 | -1 0 0 60   0 10   0 55   0 0 | -1 0 1  5   0 12   0 30   0 0 | -1 0 0  8   0 90   0  0   0 0
-1 0 0 18   0 50   0  9   0 0 | -1 0 0 120  0 60   0 80   0 0 | -1 1 0  3 100  3 100  3 100 0 | -1 1 0 30   0 60   0  9   0 0 | -1 1 0 70   0 10   0  0   0 0
-1 1 1  4   0 50   0 12   0 0 | -1 1 0  1 100  1 100  1 100 0 | -1 1 0 14   5 200  0  0   0 0 | -1 0 0  4   0  2 100  9   0 0 | -1 0 0 40   3 30   0 20   0 0
 0 0 0 60   0 40   0 70   0 1 | 0 0 0 35   5  8   0 45   0 1 | 0 0 0 90   2 60   0 10   0 1 | 0 0 1  7   0  3 100 55   0 1 | 0 0 1  5   0 70   0 60   0 1
 0 0 0 22   0 50   0 40   0 1 | 0 0 0  4   0 60   0 50   0 1 | 0 0 0  9   0 45   0 30   0 1 | 0 0 0 28  10 33   0 60   0 1 | 0 0 0 18   0 10   0 44   0 1
 0 0 0  1   0 48   0 52   0 1 | 0 0 0 120  0  0   0  0   0 1 | 0 0 0 16   0 40   0 25   0 1 | 0 0 1 10   0  0   0 80   0 1 | 0 0 0 50   8  6   0 30   0 1
 0 0 0  2 100  2 100  3 100 0 | 0 0 0  3 100  0   0  2 100 0 | 0 0 0  6  90  4 100 50   0 0 | 0 0 0 20  80 10  90 15  85 0 | 0 0 0  7   0 60   0  3 100 0
 0 0 0  5   0  2 100  1 100 0 | 0 0 0  9   0 50   0  0   0 0 | 0 0 0  4   0  3 100  4 100 0 | 0 0 0 30  70 40   0 10  90 0 | 0 0 0  2   0  1 100 60   0 0
 0 0 0 12 100 60   0 14 100 0 | 0 0 0  6   0  5   0  4   0 0 | 0 0 0  3   0  0   0  2 100 0 | 0 0 1  3   0 12   0  4 100 0 | 0 0 0 10  50  3 100  2 100 0
 0 0 0 40   0  5   0  3   0 1 | 0 0 0 55   0 30   0  6   0 1 | 0 0 0 30   2 12   0  0   0 1 | 0 0 0 80   0 50   0  2 100 1 | 0 0 0 45   0  8   0  2 100 1
 0 0 0 33   0 40   0  9   0 1 | 0 0 0 27   0  2 100 35   0 1 | 0 0 0 150  0  1 100  4 100 1 | 0 0 0 64   0  3   0  5  80 1 | 0 0 0 24   0  0   0  8   0 1
-1 0 0 150  0  5   0  4   0 0 | -1 0 0 90   0 40   0  0   0 0 | -1 0 0 70   0 80   0 100  0 0 | -1 0 1 6    0 10   0 90   0 0 | -1 0 0 30  40 12   0 40  60 0
-1 0 0 200  0  0   0  0   0 0 | -1 0 0 75   0 60   0 12   0 0 | -1 0 0 45   0 200  0 60   0 0 | -1 0 0 10   0  9   0 35   0 0 | -1 0 0 100  5 30   0 20   0 0
 0 0 1  4   0  0   0 60   0 1 | 0 0 1  3   0  2 100 40   0 1 | 0 0 1  6   0  5   0 35   0 1 | 0 0 1  2   0 45   0 50   0 1 | 0 0 0  6   0 40   0 25   0 1
 0 0 1  8   0  1   0 70   0 1 | 0 0 1  5   0  9   0 28   0 1 | 0 0 0 11   0 30   0 50   0 1 | 0 0 0  3   0 70   0 30   0 1 | 0 0 0  7   0  4   0  3   0 0
 0 0 1  2   0  2 100 45   0 1 | 0 0 1  1   0  3 100 38   0 1 | 0 0 1  2   0  0   0 50   0 1 | 0 0 1  1   0 12   0 90   0 1 | 0 0 1  2   0  1 100 28   0 1
 0 0 0 40  95 60   0 55   0 0 | 0 0 0 60  90 45   0 70   0 0 | 0 0 0 26  85 80   0 60   0 0 | 0 0 0 90  98 30   0 45   0 0 | 0 0 0 34  60 55   0 40   0 0
 0 0 0 40  30 60   0 55   0 1 | 0 0 0 60  20 45   0 70   0 1 | 0 0 0 26  25 80   0 60   0 1 | 0 0 0 90  12 30   0 45   0 1 | 0 0 0 34   0 55   0 40   0 1
 0 0 0 14  80 50   0 35   0 0 | 0 0 0 10 100 70   0 44   0 0 | 0 0 0 9   90 33   0 60   0 0 | 0 0 0 13  15 50   0 35   0 1 | 0 0 0 12   5 70   0 44   0 1
 0 0 0 30   0 20  95 25   0 1 | 0 0 0 8    0 30  95  9  90 0 | 0 0 0 36  92  2 100 3 100 0 | 0 0 0 55  88  4  80 50   0 0 | 0 0 0 47  10 12  90 50   0 1
 0 1 0 40   0 60   0 50   0 0 | 0 1 0  3 100  2 100  3 100 0 | 0 1 0 15   0 60   0 30   0 0 | 0 1 0 80   0 20   0 40   0 0 | 0 1 1  3   0 60   0 30   0 0
"""
FEATURES = ("place", "furniture", "heading", "words", "density", "words_before", "density_before", "words_after", "density_after")
DEPTH = 9


def labelled() -> list[tuple[tuple[int, ...], int]]:
    rows = [tuple(map(int, r.split())) for r in LABELLED.replace("\n", "|").split("|") if r.strip()]
    return [(r[:-1], r[-1]) for r in rows]


def grow(rows: list[tuple[tuple[int, ...], int]], depth: int = DEPTH):
    """A tree by Gini impurity: a label, or (feature, limit, tree up to the limit, tree above). Ties go to the first feature and the smallest limit."""
    ones = sum(y for _, y in rows)
    label = int(2 * ones >= len(rows))
    if depth == 0 or ones in (0, len(rows)):
        return label
    gini = lambda n, k: 2 * k * (n - k) / n
    best = None
    for f in range(len(FEATURES)):
        values = sorted({x[f] for x, _ in rows})
        for low, high in zip(values, values[1:], strict=False):
            limit = (low + high) / 2
            n = sum(x[f] <= limit for x, _ in rows)
            k = sum(y for x, y in rows if x[f] <= limit)
            cost = gini(n, k) + gini(len(rows) - n, ones - k)
            if best is None or cost < best[0] - 1e-9:
                best = (cost, f, limit)
    if best is None:
        return label
    _, f, limit = best
    return f, limit, grow([r for r in rows if r[0][f] <= limit], depth - 1), grow([r for r in rows if r[0][f] > limit], depth - 1)


@lru_cache
def tree():
    return grow(labelled())


def classify(x: tuple[float, ...], node=None) -> int:
    node = tree() if node is None else node
    while not isinstance(node, int):
        f, limit, low, high = node
        node = low if x[f] <= limit else high
    return node


@lru_cache
def _end_of(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I)


def _names(attributes: str) -> tuple[str, bool]:
    """class, id, role and itemprop of a tag, and whether it is hidden."""
    found = {k.lower(): x or y or z for k, x, y, z in reversed(ATTRIBUTE.findall(attributes))}
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or bool(HIDING.search(found.get("style", "")))
    return " ".join(found.get(k, "") for k in ("class", "id", "role", "itemprop")), hidden


def blocks(page: str) -> list[dict]:
    """text, words, linked (words inside links), place, furniture and heading of each block with text, in page order."""
    out: list[dict] = []
    parts: list[tuple[str, bool]] = []
    opened: list[tuple[str, int]] = []
    state = {OPEN_MAIN: 0, OPEN_FURNITURE: 0, OPEN_NAMED: 0}
    heading, link, named_p = False, False, False

    def flush():
        if parts:
            text = SPACES.sub(" ", "".join(p for p, _ in parts)).strip()
            if text:
                linked = len("".join(p if inside else " " for p, inside in parts).split())
                out.append({"text": text, "words": len(text.split(" ")), "linked": linked, "main": state[OPEN_MAIN] > 0, "furniture": state[OPEN_FURNITURE] + state[OPEN_NAMED] > 0 or named_p, "heading": heading})
            parts.clear()

    def close(to: int):
        while len(opened) > to:
            _, kind = opened.pop()
            if kind:
                state[kind] -= 1

    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        run = page[at : m.start() if m else n]
        if run:
            parts.append((entities.unescape(run), link))
        if not m:
            break
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        closing = bool(m["close"] or m["close2"])
        if name in OPAQUE:
            rest = m["rest"] or m["rest2"] or ""
            # only foreign elements close themselves, and a slash that ends an unquoted value doesn't
            if not closing and not (name in FOREIGN and rest.endswith("/") and not UNQUOTED.search(rest)):
                end = _end_of(name).search(page, at)
                at = end.end() if end else n if name in RAW else at
            continue
        if name == "a":
            link = not closing
        elif name == "br":
            parts.append((" ", link))
        elif name in BLOCK:
            flush()
            heading = name in HEADING and not closing
            named_p = False
            if name in VOID:
                continue
            if closing:
                if name != "p":
                    k = next((k for k in range(len(opened) - 1, -1, -1) if opened[k][0] == name), None)
                    if k is not None:
                        close(k)
                link = False
            elif name != "p":
                if name in ("li", "dd", "dt", "td", "th", "tr", "option") and opened and opened[-1][0] == name:
                    close(len(opened) - 1)
                names, hidden = _names(m["rest"] or m["rest2"] or "")
                kind = 0
                if name in FURNITURE or hidden or name == "header" and not state[OPEN_MAIN]:
                    kind = OPEN_FURNITURE
                elif name not in ("html", "body", "main") and name not in HEADING and NAMED.search(names):
                    kind = OPEN_FURNITURE if COMMENTS.search(names) else OPEN_NAMED
                elif name in ("article", "main") or MAIN_NAMED.search(names) and name in ("div", "section"):
                    kind = OPEN_MAIN
                    if name in ("article", "main"):  # what is around the article is no furniture, whatever its name
                        opened[:] = [(x, 0 if k == OPEN_NAMED else k) for x, k in opened]
                        state[OPEN_NAMED] = 0
                if kind:
                    state[kind] += 1
                opened.append((name, kind))
            else:
                names, hidden = _names(m["rest"] or m["rest2"] or "")
                named_p = hidden or bool(NAMED.search(names))
    flush()
    return out


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    has_main = any(b["main"] and not b["furniture"] for b in found)
    size = [(b["words"], 100 * b["linked"] / b["words"]) for b in found]
    kept = []
    for i, b in enumerate(found):
        place = (1 if b["main"] else -1) if has_main else 0
        before, after = size[i - 1] if i else (0, 0), size[i + 1] if i + 1 < len(size) else (0, 0)
        if classify((place, int(b["furniture"]), int(b["heading"]), *size[i], *before, *after)):
            kept.append(b["text"])
    return "\n\n".join(kept)


def _extract(batches):
    for batch in batches:
        texts = [main_text(h.as_py()) for h in batch.column("html")]
        yield pa.RecordBatch.from_arrays([batch.column("page_id").cast(pa.int64()), batch.column("url").cast(pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of pages."""
    return pages.select("page_id", "url", "html").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
