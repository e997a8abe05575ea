"""Main text of pages by the maximum-scoring contiguous region.

A page is read as words and tags. Words score by where they stand: what their nearest telling element
is, and whether they are in a link; tags cost. The weights are log-odds learned from pages that
label themselves, by one article element: how much commoner each kind is inside than outside. Elements that
are never article text teach the weight of such elements and no other, so a list of an article does not pay for
the lists of menus, and what was seen little stays near where it began. A linear scan keeps the best sum so far and
finds the region with the largest. Where most words of the region are one article element's, the region is that
element, from its first word to its last: a short last paragraph or a list of links does not have to earn its place.

Words of the region are kept unless an element over them is never article text: by its name, because it is hidden,
or because all words of one of its classes, its id or its role say so. A header goes, unless it is the article's own,
which holds its title.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gnomon.llm.common import only, table

#: Pages that weights are learned from, about.
FIT_PAGES = 5000
#: Elements of HTML by what they do to text.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
NEVER = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "template", "nav", "header", "footer", "aside", "form", "button", "select", "option", "svg", "dialog", "menu", "head"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "keygen", "param"}
#: Words of a class, id or role that tell what an element is not, and words that only tell where it
#: stands or how it looks. "side-effects" and "share-price" have others, and tell nothing.
ASIDE = re.compile(r"ads?|advert\w*|upsell\w*|paywall|teasers?|comment\w*|sponsor\w*|promo\w*|banner|cookie\w*|consent|notice|popup|modal|newsletter|subscribe|signup|share|sharing|social|related|recommend\w*|sidebar|side|menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|comments?|respond|replies|disqus|widgets?|toolbar|login|search|pagination|pager|complementary|contentinfo")
LAYOUT = re.compile(r"|premium|post|page|site|main|content|top|bottom|left|right|inner|outer|box|bar|block|slot|unit|list|item|links?|wrap|wrapper|container|area|section|panel|group|row|col|column|form|field|buttons?|icons?|text|title|js|ui|primary|secondary|global|mobile|desktop|sticky|fixed|\d+")
#: Words that tell it of plain containers only: a paper's section may be its discussion.
THREAD, CONTAINERS = re.compile(r"discussions?|thread|talk"), {"div", "ul", "ol", "dl"}
#: A style that hides.
HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\s*(?:!important\s*)?(?:;|$)")
_ATTRIBUTE = r"""([^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+"""
ATTRIBUTE = re.compile(_ATTRIBUTE)
#: An attribute's value is quoted only where a quote follows the equals sign and is closed; other quotes are letters.
TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<!(?!--)[^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|</[^a-zA-Z>][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/=]++|" + re.sub(r"\((?=[^?])", "(?:", _ATTRIBUTE) + r")*+)(?:>|\Z)", re.S)
#: An element that is no article text costs the region so much at most, however long it is.
ASIDE_COST = 2.0
#: What a tag costs before anything was seen of it, and at most; how many sightings that is worth.
TAG_COST, TAG_MOST, SEEN = -0.2, -0.6, 50.0
#: The share of the region's words that one article element has to have for the region to become that element.
MOSTLY = 0.6
SPACE = re.compile(r"\s+")
#: Elements that close when one of these opens.
_ENDS_P = BLOCK - {"br"}


@dataclass(slots=True)
class Open:
    """An open element, and what those over it say of its text."""

    name: str
    over: Open | None
    aside: bool = False
    link: bool = False
    #: The innermost article or main element, counted from 1; below 0 for a main one.
    article: int = 0
    near: str = "none"

    @property
    def kind(self) -> str:
        """What kind of place a word stands in."""
        return "aside" if self.aside else "link" if self.link else self.near


#: Elements that tell what their text is.
TELLING = {"p", "li", "td", "th", "dd", "dt", "blockquote", "pre", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "div", "section", "body"}


def is_aside(name: str, attributes: str, over: Open) -> bool:
    """Whether an element is no article text."""
    if name in NEVER:
        return not (name == "header" and over.article)
    if name in ("html", "body"):
        return False
    plain = name in ("article", "main")
    for found in ATTRIBUTE.finditer(attributes):
        key, value = found[1].lower(), (found[2] or found[3] or found[4] or "").lower()
        if key == "hidden" and value != "until-found" or key == "aria-hidden" and value == "true" or key == "style" and HIDDEN.search(value):
            return True
        if key in ("class", "id", "role") and not plain:
            for said in value.split():
                parts = re.split("[-_]+", said)
                told = [bool(ASIDE.fullmatch(x)) or name in CONTAINERS and bool(THREAD.fullmatch(x)) for x in parts]
                if any(told) and all(t or LAYOUT.fullmatch(x) for t, x in zip(told, parts, strict=True)):
                    return True
    return False


def pieces(page: str) -> list[tuple[str, str, Open]]:
    """Text runs and tags in order: (kind, text or tag name, innermost open element).

    kind is "t" for text and "b" for a block edge, "i" for an inline tag. Text of raw elements and
    comments is left out. End tags close what they name, if it is open; a block closes an open
    paragraph; elements that an enclosing end tag closes go too. Each tag is opened and closed once, so
    the time is that of the page's length, however deep its elements lie.
    """
    out: list[tuple[str, str, Open]] = []
    top = Open("", None)
    open_: Counter[str] = Counter()
    at, n, articles = 0, len(page), 0

    def close(name: str) -> None:
        nonlocal top
        while open_[name]:
            open_[top.name] -= 1
            done, top = top.name == name, top.over
            if done:
                break

    while at < n:
        m = TAG.search(page, at)
        raw = page[at : m.start()] if m else page[at:]
        if raw:
            out.append(("t", html.unescape(raw), top))
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            close(name)
        else:
            if name in _ENDS_P:
                close("p")
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else n
            elif name not in VOID and not m[3].endswith("/"):
                article = top.article
                if name in ("article", "main"):
                    articles += 1
                    article = articles if name == "article" else article if article > 0 else -articles
                top = Open(name, top, top.aside or is_aside(name, m[3], top), top.link or name == "a", article, name if name in TELLING else top.near)
                open_[name] += 1
        out.append(("b" if name in BLOCK else "i", name, top))
    return out


def evidence(page: str) -> tuple[Counter[str], Counter[str]]:
    """Kinds of words and tags inside and outside of the page's one article element, if it has one."""
    inside, outside = Counter(), Counter()
    found = pieces(page)
    if sum(1 for k, name, top in found if k == "b" and name == "article" and top.name == "article") != 1:
        return inside, outside
    for k, x, top in found:
        to = inside if top.article > 0 else outside
        if k == "t":
            to["w:" + top.kind] += len(x.split())
        elif x != "article":
            to["t:aside" if top.aside else "t:" + x] += 1
    return inside, outside


def weights(inside: Counter[str], outside: Counter[str]) -> dict[str, float]:
    """Log-odds of every kind. Words' are cut to [-4, 4], and score without evidence as their kind should: a
    little in text, against in links and asides. Tags always cost, TAG_COST where little was seen of them and never more
    than TAG_MOST, so that a few words pay for the element that they stand in."""
    total_in, total_out = sum(inside.values()) + 1, sum(outside.values()) + 1
    out = {"w:" + k: 0.5 for k in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "article", "main", "li", "td", "blockquote", "pre", "dd", "figcaption")} | {"w:aside": -2.0, "w:link": -1.0}
    for k in {*inside, *outside}:
        out[k] = max(-4.0, min(4.0, log((inside[k] + 1) / total_in) - log((outside[k] + 1) / total_out)))
        if k.startswith("t:"):
            n = inside[k] + outside[k]
            out[k] = max(TAG_MOST, min(-0.1, (n * out[k] + SEEN * TAG_COST) / (n + SEEN)))
    # A word in plain text never counts against the region, a link or an aside never for it.
    for k in out:
        if k in ("w:link", "w:aside"):
            out[k] = min(out[k], -0.5)
        elif k in ("w:p", "w:h1", "w:article", "w:main"):
            out[k] = max(out[k], 0.5)
    return out


def values(found: list[tuple[str, str, Open]], weight: dict[str, float]) -> Iterator[float]:
    """The score of every piece."""
    paid = 0.0
    for k, x, top in found:
        if k == "t":
            # Words straight in an article count as text, whatever holds the article.
            plain = bool(top.article) and top.kind in ("div", "section", "body", "none")
            value = len(x.split()) * (weight.get("w:p", 0.5) if plain else weight.get("w:" + top.kind, -0.2))
        else:
            value = weight.get("t:aside" if top.aside else "t:" + x, TAG_COST)
        if top.aside:
            value = max(value, paid - ASIDE_COST)
            paid -= value
        else:
            paid = 0.0
        yield value


def best_region(scores: Iterable[float]) -> tuple[int, int]:
    """First and end of the contiguous run with the largest sum, the first of equals; none if no sum is above 0."""
    best, run, start, region = 0.0, 0.0, 0, (0, 0)
    for i, value in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += value
        if run > best:
            best, region = run, (start, i + 1)
    return region


def whole_article(found: list[tuple[str, str, Open]], first: int, end: int) -> tuple[int, int]:
    """The region, or the outermost article element that has most of its words; without a region the article
    element with most words, if there is one. Words that are no article text do not count."""
    over: dict[int, int] = {}
    words: Counter[int] = Counter()
    own: Counter[int] = Counter()
    spans: dict[int, list[int]] = {}
    for i, (k, x, top) in enumerate(found):
        at = top.article
        if at > 0:
            if at not in over:
                # The article that this one stands in, if any.
                outer = top
                while outer is not None and outer.article == at:
                    outer = outer.over
                over[at], spans[at] = outer.article if outer is not None and outer.article > 0 else 0, [i, i]
            spans[at][1] = i + 1
        if k == "t" and not top.aside:
            n = len(x.split())
            own[at] += n
            if first <= i < end:
                words[at] += n
    counted = words if end > first else own
    total, sums, best = sum(counted.values()), Counter(), 0
    for at in sorted(over, reverse=True):
        sums[at] += counted[at]
        if over[at]:
            sums[over[at]] += sums[at]
            spans[over[at]] = [min(spans[over[at]][0], spans[at][0]), max(spans[over[at]][1], spans[at][1])]
    if end > first:
        best = next((at for at in sorted(over) if sums[at] >= MOSTLY * total > 0), 0)
    elif sums:
        best = max(over, key=lambda at: (sums[at], -at))
    return (spans[best][0], spans[best][1]) if best and sums[best] else (first, end)


def extract(page: str, weight: dict[str, float]) -> str:
    """The article's blocks, one a line."""
    found = pieces(page)
    first, end = whole_article(found, *best_region(values(found, weight)))
    blocks, line = [], []
    for k, x, top in found[first:end]:
        if k == "b":
            blocks.append("".join(line))
            line = []
        elif k == "t" and not top.aside:
            line.append(x)
    blocks.append("".join(line))
    clean = (SPACE.sub(" ", b).strip() for b in blocks)
    return "\n".join(b for b in clean if b)


def fit(pages: DataFrame, page: str = "html", key: str = "page_id", count: int = FIT_PAGES) -> dict[str, float]:
    """Weights from about `count` pages, drawn by a hash of the key."""
    n = pages.count()
    own = only(pages, key, page).toDF("key", "page").where("page IS NOT NULL")
    drawn = own.where(F.pmod(F.xxhash64("key", F.lit("pages")), F.lit(1_000_000)) < min(1.0, count / max(1, n)) * 1_000_000).select("page")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[tuple[str, bool]] = Counter()
        for batch in batches:
            for p in batch.column(0).to_pylist():
                for where, own in zip((True, False), evidence(p), strict=True):
                    for k, v in own.items():
                        total[k, where] += v
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in total], pa.string()), pa.array([w for _, w in total], pa.bool_()), pa.array(list(total.values()), pa.int64())], ["kind", "inside", "n"])

    counts = {True: Counter(), False: Counter()}
    # Kinds are names of elements: pages can make up any, so only the usual ones come to the driver.
    usual = [*("t:" + x for x in sorted(BLOCK | {"a", "b", "i", "em", "strong", "span", "img", "u", "small", "sup", "sub", "code"})), *("w:" + x for x in ("aside", "link", "none", "p", "li", "td", "th", "dd", "dt", "blockquote", "pre", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "div", "section", "body"))]
    for r in drawn.mapInArrow(run, "kind string, inside boolean, n bigint").where(F.col("kind").isin(usual)).groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect():
        counts[r["inside"]][r["kind"]] += r["n"]
    return weights(counts[True], counts[False])


def main_text(pages: DataFrame, weight: dict[str, float], page: str = "html", keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """keys and text of every whole page; blocks are joined by a line feed.

    White space within a block is one space. A null or empty page, and one without any article words,
    has an empty text. Repeated rows and null keys stay, very long pages are read whole, other columns are not
    read, and an empty table gives an empty one.
    """
    own, n = only(pages, *keys, page), len(keys)
    schema = ", ".join([*(f"`{k}` {own.schema[k].dataType.simpleString()}" for k in keys), "text string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                out = [extract(p or "", weight) for p in batch.column(n).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(out, pa.string())], [*keys, "text"])

    return own.mapInArrow(run, schema)


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, null, empty and repeated ones too; an empty table gives an empty one."""
    pages = table(spark, sf_dir, "pages")
    return main_text(pages, fit(pages)).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
