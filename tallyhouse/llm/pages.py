"""Main text of web pages by the distribution of text over lines."""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from .common import python_ready, read_table

# Lines per window, and the text a window must have in a page that does not mark its article.
WINDOW, SURGE = 3, 86

# Element names of HTML, and words that class and id use for what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead title tr ul".split()
)
RAW = frozenset("script style textarea title noscript template iframe noframes noembed xmp".split())
OUTSIDE = frozenset(
    "nav footer aside form head menu button select dialog svg math object canvas audio video map search".split()
)
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side nav navbar "
    "navigation menu breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "comment comments reply replies disqus respond pagination pager toolbar widget skip".split()
)
CLOSES_P = BLOCKS - {"body", "html", "head", "title"}

_PART = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|[^<]+|<""", re.S)
_NAMES = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")


def _set_apart(attributes: str) -> bool:
    if "=" not in attributes:
        return False
    return any(
        word in OUTSIDE_WORDS for found in _NAMES.findall(attributes) for word in _SPLIT.split("".join(found).lower())
    )


class Line:
    __slots__ = ("text", "size", "in_article")

    def __init__(self, text: str, size: int, in_article: bool):
        self.text, self.size, self.in_article = text, size, in_article


def lines_of(page: str) -> tuple[list[Line], bool]:
    """The page's blocks in order, each one line, and whether the page marks an article.

    Text of menus, adverts and the like has size 0; so has the text of links outside a
    marked article.
    """
    lines: list[Line] = []
    parts: list[str] = []
    size = linked = 0
    open_tags: list[tuple[str, bool, bool]] = []
    depth_out = depth_article = depth_link = 0
    marks = False

    def close():
        nonlocal parts, size, linked
        text = _SPACE.sub(" ", references.unescape("".join(parts))).strip()
        if text:
            lines.append(Line(text, size if depth_article else size - linked, depth_article > 0))
        parts, size, linked = [], 0, 0

    def pop():
        nonlocal depth_out, depth_article, depth_link
        name, out, article = open_tags.pop()
        depth_out -= out
        depth_article -= article
        depth_link -= name == "a"

    at, end = 0, len(page)
    while at < end:
        found = _PART.match(page, at)
        at = found.end()
        name = found.group(2)
        if name is None:
            text = found.group()
            if text.startswith(("<!", "<?")) or depth_out:
                continue
            parts.append(text)
            length = len(text.strip())
            size += length
            linked += length if depth_link else 0
            continue
        name = name.lower()
        if found.group(1):
            if name in BLOCKS:
                close()
            if any(tag[0] == name for tag in reversed(open_tags)):
                while open_tags[-1][0] != name:
                    pop()
                pop()
            continue
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        if name in BLOCKS:
            close()
            if name in CLOSES_P and any(tag[0] == "p" for tag in open_tags):
                # A paragraph ends where the next block begins, with all that was left open in it.
                last = max(i for i, tag in enumerate(open_tags) if tag[0] == "p")
                if not any(tag[0] in BLOCKS for tag in open_tags[last + 1 :]):
                    while len(open_tags) > last:
                        pop()
        elif name == "br":
            parts.append(" ")
        if name in VOID or found.group(3).endswith("/"):
            continue
        article = name in ("article", "main")
        heading = name == "header" and depth_article > 0
        out = name in OUTSIDE or (name == "header" and not heading) or (
            name not in ("html", "body", "article", "main") and not heading and _set_apart(found.group(3))
        )
        marks = marks or (article and not depth_out)
        article = article and not depth_out
        open_tags.append((name, out, article))
        depth_out += out
        depth_article += article
        depth_link += name == "a"
    close()
    return lines, marks


def main_lines(sizes: list[int], surge: int = SURGE, window: int = WINDOW) -> list[bool]:
    """Which lines lie between a surge and the next dive of the text sums over sliding windows.

    A surge is a window with more than `surge` characters, after which text goes on; the
    dive is the next window without any. Lines without text of their own are left out.
    """
    sums = [sum(sizes[i : i + window]) for i in range(len(sizes))]
    keep = [False] * len(sizes)
    inside = False
    for i, total in enumerate(sums):
        if not inside and total > surge:
            inside = True
        elif inside and total == 0:
            inside = False
        keep[i] = inside and sizes[i] > 0
    return keep


def main_text(page: str | None) -> str:
    """The article's text: blocks in page order, one a line; empty if there is none.

    Where the page marks its article or main part, lines outside have no size and any text
    is a surge, so that short articles are whole too. Null and empty pages have no text.
    """
    lines, marks = lines_of(page or "")
    if marks:
        keep = main_lines([line.size if line.in_article else 0 for line in lines], surge=0)
    else:
        keep = main_lines([line.size for line in lines])
        if not any(keep):
            keep = main_lines([line.size for line in lines], surge=0)
    return "\n".join(line.text for line, kept in zip(lines, keep) if kept)


@pandas_udf(StringType())
def _main_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in batches:
        yield pd.Series([main_text(p) for p in pages], dtype=object)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of `pages`; other columns are ignored."""
    python_ready(pages.sparkSession)
    found = pages.select("page_id", "url", _main_texts("html").alias("text"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op7_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))
