"""Main text of web pages: the maximum-scoring contiguous run of words and tags, with weights from labelled pages."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|textarea|select|title|head)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|[^<]+|<", re.S | re.I)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
#: Fixed values of HTML: elements that break text into blocks, those without an end tag, and those that hold others.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HOLDERS = frozenset("address article aside body details dialog div dl fieldset figure footer form header li main menu nav ol section table ul".split())
#: Elements that HTML itself sets apart from an article. A header is one too, unless an article or main element holds it.
ASIDE = frozenset("nav footer aside form button dialog menu fieldset".split())
#: Where nothing was learned of a class, id or role: it names an aside if it is made of these words, or of these and of plain ones.
ASIDE_WORDS = frozenset("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer form header login masthead menu modal nav navbar navigation newsletter notice popup promo promoted related replies respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
PLAIN_WORDS = frozenset("area bar block bottom box button buttons container global group icons inline inner item left link links list main middle outer page panel posts primary right rail row secondary section side site slot small thread top unit wrap wrapper".split())
#: Fixed values of HTML: elements that hold a whole article or page.
FRAMES = frozenset("html body article main".split())
#: Labelled pages from which weights are learned, about: a page takes part by its hash.
SAMPLE = 20_000
#: A class, id or role was learned to name asides if so many of its elements stood outside of articles, and at most this share inside.
OFTEN, INSIDE = 20, 0.05


@dataclass
class Weights:
    """word: score of a word by the kind of element that holds it; tag: cost of a tag by its kind; asides: names (class, id or
    role) of elements that stand outside of articles. Kinds that no labelled page has take a default that depends on whether
    they stand in an aside. An aside within other content is passed over: nothing in it counts."""

    word: dict[str, float] = field(default_factory=dict)
    tag: dict[str, float] = field(default_factory=dict)
    asides: frozenset[str] = frozenset()

    def of(self, what: str, kind: str, text: str) -> float:
        if kind.endswith(".within"):
            return 0.0
        away = kind.endswith(".aside")
        if what == "words":
            return len(text.split()) * self.word.get(kind, 0.01 if away else 1.0)
        return -self.tag.get(f"{what} {kind}", 20.0 if away else 0.5)


def away(kind: str) -> bool:
    return kind.endswith((".aside", ".within"))


def _names(attributes: str) -> tuple[str, ...]:
    """The words of an element's class, id and role."""
    return tuple(" ".join(a or b or c for a, b, c in NAMED.findall(attributes)).lower().split()) if "=" in attributes else ()


@lru_cache(100_000)
def _set_apart(name: str) -> bool:
    parts = [x for x in re.split(r"[_-]+|\d+", name) if x]
    return any(x in ASIDE_WORDS for x in parts) and all(x in ASIDE_WORDS or x in PLAIN_WORDS for x in parts)


def _is_aside(element: str, names: tuple[str, ...], within: bool, asides: frozenset[str]) -> bool:
    if element in ASIDE or element == "header" and not within:
        return True
    return element not in ("html", "body", "article", "main") and any(n in asides or _set_apart(n) for n in names)


def tokens(page: str, asides: frozenset[str] = frozenset()) -> Iterator[tuple[str, str, str, tuple[str, ...]]]:
    """(what, kind, text, names): what is open, close or words; kind is that of the tag, or of the element that holds the
    words: the element's name, then .aside if it is one or in one, or .within if that aside is held by more than the body.

    Comments and elements whose content isn't text on the page are left out. End tags without a start are tokens that
    close nothing; a new paragraph or list item ends an open one.
    """
    stack: list[tuple[str, str, tuple[str, ...]]] = []
    for m in TOKEN.finditer(page):
        name = (m[3] or "").lower()
        if name:
            if m[2]:
                kind, names = name, ()
                if any(n == name for n, _, _ in stack):
                    while stack[-1][0] != name:
                        stack.pop()
                    _, kind, names = stack.pop()
                yield "close", kind, name, names
            else:
                names = _names(m[4] or "")
                if name in BLOCKS and stack and stack[-1][0] in ("p", "b", "i", "em", "strong", "span", "a") and any(n == "p" for n, _, _ in stack):
                    while stack and stack[-1][0] not in HOLDERS:
                        stack.pop()
                if name == "li" and stack and stack[-1][0] == "li":
                    stack.pop()
                held = stack[-1][1] if stack else ""
                if away(held):
                    kind = f"{name}.{held.rpartition('.')[2]}"
                elif _is_aside(name, names, any(n in ("article", "main") for n, _, _ in stack), asides):
                    kind = f"{name}.{'within' if stack and stack[-1][0] not in ('html', 'body') else 'aside'}"
                else:
                    kind = name
                if name not in EMPTY and not (m[4] or "").endswith("/"):
                    stack.append((name, kind, names))
                yield "open", kind, name, names
        elif m[0][0] != "<" or m[0] == "<":
            holder = next((k for n, k, _ in reversed(stack) if n in HOLDERS or away(k)), "body")
            yield "words", holder, m[0], ()


def region(page: list[tuple], weights: Weights) -> tuple[int, int]:
    """First and last + 1 token of the best contiguous run (Kadane's scan); of equal ones the first, (0, 0) if none is over 0."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, (what, kind, text, *_) in enumerate(page):
        total += weights.of(what, kind, text)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best and what == "words":
            best, found = total, (start, i + 1)
    return found


def text_of(page: str, weights: Weights) -> str:
    """Blocks of the best region without what stands in asides, joined by a blank line."""
    found = list(tokens(page, weights.asides))
    start, end = region(found, weights)
    blocks, block = [], []
    for what, kind, text, _ in found[start:end]:
        if what == "words":
            if not away(kind):
                block.append(text)
        elif text in BLOCKS:
            blocks.append(block)
            block = []
        elif text == "br":
            block.append(" ")
    return "\n\n".join(x for x in (" ".join(html.unescape("".join(b)).split()) for b in [*blocks, block]) if x)


def fit(pages: DataFrame, *, text: str = "html", sample: int = SAMPLE) -> Weights:
    """Weights from labelled pages: those whose markup names the article (one article or main element, not in an aside);
    about sample pages, by a hash of the page.

    Tasks count for each class, id and role of elements that don't hold the named region how often it stands inside and
    outside of it; a name of which OFTEN elements or more stood outside, and few inside, is one of asides. With these known, they
    count for each kind of element how many words it holds inside and outside, and for each kind of tag how often it stands
    there; counts are united by a grouped sum. A word scores the share of its kind's words that are inside, 0.01 at least. A
    tag costs 0.02 and 4 times the share of its kind that is outside, 40 times for those that frame articles and for asides; the
    region's own tags cost as if outside. Without labelled pages all weights are defaults.
    """

    def counter(asides: frozenset[str] | None):
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            inside, outside = Counter(), Counter()
            for batch in batches:
                for value in batch.column(0):
                    page = list(tokens(value.as_py() or "", asides or frozenset()))
                    marks = [i for i, (what, kind, _, _) in enumerate(page) if what != "words" and kind in ("article", "main")]
                    if len(marks) < 2 or page[marks[0]][0] != "open":
                        continue
                    for i, (what, kind, words, names) in enumerate(page):
                        into = inside if marks[0] < i < marks[-1] else outside
                        if asides is not None:
                            into[("words " if what == "words" else f"{what} ") + kind] += len(words.split()) if what == "words" else 1
                        elif what == ("close" if i < marks[0] else "open") and i not in (marks[0], marks[-1]):
                            into.update(names)
            kinds = list(inside.keys() | outside.keys())
            yield pa.RecordBatch.from_pydict({"kind": pa.array(kinds, pa.string()), "n1": pa.array([inside[k] for k in kinds], pa.int64()), "n0": pa.array([outside[k] for k in kinds], pa.int64())})

        return count

    n = pages.count()
    own = pages.select(F.col(text).cast("string").alias("_html"))
    if n > sample:
        own = own.filter(F.pmod(F.xxhash64("_html"), F.lit(1_000_000)) < F.lit(int(1_000_000 * sample / n)))

    def counts(asides: frozenset[str] | None) -> DataFrame:
        every = own.mapInArrow(counter(asides), "kind string, n1 long, n0 long").groupBy("kind").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
        return every.withColumn("share", (F.col("n1") + 0.01) / (F.col("n1") + F.col("n0") + 0.02))

    asides = frozenset(r["kind"] for r in counts(None).filter((F.col("n0") >= OFTEN) & (F.col("share") <= INSIDE)).select("kind").collect())
    weights = Weights(asides=asides)
    for r in counts(asides).collect():
        what, _, kind = r["kind"].partition(" ")
        if what == "words":
            weights.word[kind] = max(0.01, r["share"])
        else:
            weights.tag[r["kind"]] = 0.02 + (40 if kind in FRAMES or away(kind) else 4) * (1 - r["share"])
    return weights


def extract(pages: DataFrame, weights: Weights, *, text: str = "html", out: str = "text") -> DataFrame:
    """pages with the main text of each whole page: character references decoded, blanks inside a block one space, blocks
    in page order joined by a blank line. Null and empty pages, and pages without words, give an empty text; equal pages equal
    ones. Other columns stay, but for one named like out, which is replaced; an empty table gives no rows."""

    @F.pandas_udf("string")
    def extracted(values):
        import pandas as pd

        return pd.Series([text_of(v or "", weights) for v in values], dtype=object)

    return pages.withColumn(out, extracted(F.col(text)))
