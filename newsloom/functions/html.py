"""Pages: entities, article fields."""

from __future__ import annotations

import html as _html
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsloom.functions.text import collapse


def unescape(c: Column) -> Column:
    """Text with every HTML entity resolved and spaces collapsed; only texts with ``&`` travel to Python."""

    @F.pandas_udf("string")
    def resolve(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else _html.unescape(t))

    return collapse(F.when(F.contains(c, F.lit("&")), resolve(F.when(F.contains(c, F.lit("&")), c))).otherwise(c))


# Where pages name their title and description, in order of preference; elements that hold running text, hidden text, or the article.
TITLE_NAMES = ("og:title", "twitter:title", "title")
SUMMARY_NAMES = ("description", "og:description", "twitter:description")
BLOCKS, HIDDEN, CONTAINERS = ("p", "h2", "li"), ("script", "style", "noscript"), ("article", "main", "body")


class _Page(HTMLParser):
    """One walk over a page: named metadata, headings, and blocks of text with the containers they stand in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.named: dict[str, str] = {}
        self.heads: dict[str, list[str]] = {"title": [], "h1": []}
        self.blocks: list[tuple[frozenset[str], list[str]]] = []
        self.open: dict[str, int] = {}
        self.block: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "meta":
            a = {k: v or "" for k, v in attrs}
            for key in (a.get("property"), a.get("name")):
                if key and a.get("content", "").strip():
                    self.named.setdefault(key.strip().lower(), a["content"])
            return
        if tag in BLOCKS:
            self.block = []
            self.blocks.append((frozenset(t for t in CONTAINERS if self.open.get(t)), self.block))
        self.open[tag] = self.open.get(tag, 0) + 1

    def handle_endtag(self, tag: str) -> None:
        if self.open.get(tag):
            self.open[tag] -= 1
        if tag in BLOCKS:
            self.block = None

    def handle_data(self, data: str) -> None:
        if any(self.open.get(t) for t in HIDDEN):
            return
        for t, found in self.heads.items():
            if self.open.get(t):
                found.append(data)
        if self.block is not None:
            self.block.append(data)


def _clean(parts: list[str] | str) -> str:
    return " ".join((parts if isinstance(parts, str) else " ".join(parts)).split())


def article_fields(page: str, least: int = 40) -> tuple[str | None, str | None, str | None]:
    """Title, summary and text of one page; the text is its blocks of at least ``least`` characters, inside the article where one is marked."""
    p = _Page()
    p.feed(page)
    p.close()
    inside = next((t for t in CONTAINERS if any(t in c for c, _ in p.blocks)), None)
    blocks = [b for b in (_clean(x) for c, x in p.blocks if inside is None or inside in c) if len(b) >= least]
    pick = lambda names: next((_clean(p.named[n]) for n in names if n in p.named), None)
    title = pick(TITLE_NAMES) or _clean(p.heads["title"]) or _clean(p.heads["h1"])
    return title or None, pick(SUMMARY_NAMES) or (blocks[0] if blocks else None), "\n".join(blocks) or None


@F.pandas_udf(StructType().add("title", "string").add("summary", "string").add("text", "string"))
def _fields(pages: pd.Series) -> pd.DataFrame:
    rows = [article_fields(x) if x else (None, None, None) for x in pages]
    return pd.DataFrame(rows, columns=["title", "summary", "text"])


def article(page: Column) -> Column:
    """Struct (title, summary, text) of a page, whole texts; null and empty pages have none of them."""
    return _fields(page)
