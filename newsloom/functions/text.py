"""Column builders for text: matching, sentences, packed strings, addresses. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: ASCII punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def ascii_upper(c: Column) -> Column:
    """Upper case of the letters a-z only, the same in every engine."""
    return F.translate(c, LOWER, UPPER)


def blank_to_null(c: Column) -> Column:
    t = F.btrim(c.cast("string"))
    return F.when(t != "", t)


def collapse(c: Column) -> Column:
    """One space for every run of white space, none at the ends."""
    return F.btrim(F.regexp_replace(c, r"\s+", " "))


def match_form(c: Column) -> Column:
    """Text prepared for cue matching: upper case, punctuation to spaces, single spaces; null gives ''."""
    return collapse(F.translate(ascii_upper(F.coalesce(c, F.lit(""))), PUNCTUATION, " " * len(PUNCTUATION)))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def contains_any(c: Column, terms: Sequence[str]) -> Column:
    """Whether the upper-cased text holds any of the terms; null text holds none."""

    def any_of(t: Column) -> Column:
        out = F.lit(False)
        for term in terms:
            out = out | F.contains(t, F.lit(term))
        return out

    return bound(ascii_upper(F.coalesce(c, F.lit(""))), any_of)


def term_hits(c: Column, terms: Sequence[str]) -> Column:
    """Number of the terms that the upper-cased text holds as substrings."""

    def count(t: Column) -> Column:
        out = F.lit(0)
        for term in terms:
            out = out + F.contains(t, F.lit(term)).cast("int")
        return out

    return bound(ascii_upper(F.coalesce(c, F.lit(""))), count)


def cue_hits(form: Column, cues: Column) -> Column:
    """Number of cues found as whole words or phrases; both sides in match form (see :func:`match_form`)."""
    padded = F.concat(F.lit(" "), form, F.lit(" "))
    return F.size(F.filter(cues, lambda q: (q != "") & F.contains(padded, F.concat(F.lit(" "), q, F.lit(" ")))))


def matched_cues(form: Column, cues: Column) -> Column:
    """Distinct cues found, in cue order."""
    padded = F.concat(F.lit(" "), form, F.lit(" "))
    return F.array_distinct(F.filter(cues, lambda q: (q != "") & F.contains(padded, F.concat(F.lit(" "), q, F.lit(" ")))))


def sentences(c: Column, least: int = 40) -> Column:
    """Sentences of at least ``least`` characters: cut after a closing mark, at ``||`` and at line breaks."""
    parts = F.split(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+\|\|\s+", "\n"), r"([.!?])\s+", "$1\n"), r"\n+")
    return F.filter(F.transform(parts, F.btrim), lambda s: F.length(s) >= least)


def context(parts: Sequence[Column], fallback: Column, terms: Sequence[str], keep: int = 5) -> tuple[Column, Column]:
    """The sentences that hold most of the terms, joined, and the sum of their hits.

    parts: texts in order; fallback: used where they have no sentence. Sentences without a hit and
    repeated ones are dropped; the rest is ordered by hits, length and text, all descending. Every text is split once.
    """

    def scored(every: Column) -> Column:
        rows = F.transform(F.array_distinct(every), lambda s: F.struct(term_hits(s, terms).alias("hits"), F.length(s).alias("size"), s.alias("text")))
        return F.slice(F.sort_array(F.filter(rows, lambda x: x["hits"] > 0), asc=False), 1, keep)

    def told(best: Column) -> Column:
        joined = F.array_join(F.transform(best, lambda x: x["text"]), " || ")
        return F.struct(F.when(F.size(best) > 0, joined).alias("text"), F.aggregate(best, F.lit(0), lambda a, x: a + x["hits"]).cast("double").alias("score"))

    own = F.flatten(F.array(*[sentences(p) for p in parts]))
    every = bound(own, lambda o: F.when(F.size(o) > 0, o).otherwise(sentences(fallback)))
    both = bound(scored(every), told)
    return both["text"], both["score"]


def split_list(c: Column) -> Column:
    """Values of a ``;`` list without ``,offset`` suffixes and empty items."""
    items = F.transform(F.split(F.coalesce(c, F.lit("")), ";"), lambda v: F.btrim(F.split_part(v, F.lit(","), F.lit(1))))
    return F.filter(items, lambda v: v != "")


def geo_labels(c: Column) -> Column:
    """Distinct two-letter codes of a locations field in order, else GLOBAL."""
    found = F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("#([A-Z]{2})#"), F.lit(1))))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("GLOBAL")))


def tone(c: Column) -> Column:
    """Leading number of a comma-separated field."""
    return F.regexp_extract(c, r"^\s*(-?\d+(?:\.\d+)?)", 1).try_cast("double")


def event_time(stamp: Column, day: Column) -> Column:
    """Time of a 14-digit stamp, else of an 8-digit one, else the start of ``day``; bad stamps are passed over."""
    full = F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss"))
    date = F.try_to_timestamp(stamp, F.lit("yyyyMMdd"))
    return F.coalesce(full, date, day.cast("timestamp")).cast("timestamp_ntz")


def page_title(c: Column) -> Column:
    """Title inside a PAGE_TITLE element with the common entities resolved."""
    t = F.regexp_extract(F.coalesce(c, F.lit("")), r"(?is)<PAGE_TITLE>(.*?)</PAGE_TITLE>", 1)
    for entity, plain in (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(plain))
    return blank_to_null(collapse(t))


def strip_tags(c: Column) -> Column:
    """Text of a page: scripts, styles and tags gone, spaces single."""
    bare = F.regexp_replace(c, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    return collapse(F.regexp_replace(bare, r"(?s)<[^>]*>", " "))


def host(c: Column) -> Column:
    """Host of an address in lower case without ``www.`` and port; null where there is none."""
    h = F.regexp_extract(F.lower(F.btrim(c)), r"^[a-z][a-z0-9+.-]*://([^/?#:@]+)", 1)
    return F.when(h != "", F.regexp_replace(h, r"^www\.", ""))


def path(c: Column) -> Column:
    """Path of an address without query and fragment."""
    return F.regexp_replace(F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), r"[?#].*$", "")


def canonical_url(c: Column) -> Column:
    """Host and path in lower case without query, fragment and trailing slash."""
    return F.concat(host(c), F.regexp_replace(F.lower(path(c)), r"/+$", ""))


def slug_title(c: Column, words: int = 16) -> Column:
    """Words of the last path segment as a title of at most ``words`` words; segments of digits give null."""
    seg = F.regexp_replace(F.regexp_extract(F.regexp_replace(path(c), r"/+$", ""), r"([^/]*)$", 1), r"\.[A-Za-z]{2,5}$", "")
    parts = F.filter(F.split(seg, r"[-_+]+"), lambda w: (w != "") & ~w.rlike(r"^\d+$"))
    return blank_to_null(F.array_join(F.slice(parts, 1, words), " "))


def clip(c: Column, size: int) -> Column:
    """At most ``size`` characters, cut back to a word boundary."""
    return F.when(F.length(c) <= size, c).otherwise(F.regexp_replace(F.substring(c, 1, size), r"\s+\S*$", ""))


# Public suffixes of two labels.
SUFFIXES = ("co.uk", "com.au", "com.br", "com.cn", "com.tw", "co.jp", "co.in", "co.nz", "org.uk", "gov.uk", "europa.eu")


def root_domain(c: Column) -> Column:
    """Last two labels of a domain, three where the last two are a public suffix."""
    d = F.regexp_replace(F.regexp_replace(F.lower(F.btrim(c)), r":\d+$", ""), r"^www\.", "")
    last = lambda k: F.substring_index(d, ".", -k)
    return F.when(last(2).isin(*SUFFIXES), last(3)).otherwise(last(2))


def first_text(*cols: Column) -> Column:
    """First of the texts that is neither null nor blank."""
    return F.coalesce(*[F.when(F.btrim(c) != "", c) for c in cols])
