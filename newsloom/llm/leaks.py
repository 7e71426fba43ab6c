"""Evaluation texts leaking into training text: greedy string tiling over shared word seeds.

Both sides are cut into rolling Karp-Rabin hashes of ``tile`` consecutive words. Documents and items that
share a seed are tiled: the longest match of unmarked words is marked on both sides, again and again,
until no match of ``tile`` words is left. The tiles do not overlap, so their sum measures how much of the
item the document holds even when its passages come in another order.

The items travel to the documents: a task holds a set of items of bounded size with their seeds, cuts its
documents into words once, finds seeds and tiles on the spot. Documents are never shuffled; only the matches
leave a task. Items beyond the bound make further sets, each of which is one pass over the documents' words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.cut import materialize

BASE = np.uint64(0x9E3779B97F4A7C15)
#: BASE * INVERSE is 1 modulo 2**64.
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null text has none."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), F.array().cast("array<string>"))


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def rolling(tokens: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes of every window of ``width`` words, modulo 2**64."""
    n = len(tokens) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    t, h = tokens.astype(np.uint64), np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            h = h * BASE + t[k : k + n]
        h ^= h >> np.uint64(29)
    return h


def _prefix(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all prefixes and powers of the base: any window's hash is one subtraction."""
    powers = np.ones(len(tokens) + 1, np.uint64)
    total = np.zeros(len(tokens) + 1, np.uint64)
    with np.errstate(over="ignore"):
        powers[1:] = np.cumprod(np.full(len(tokens), BASE))
        back = np.cumprod(np.full(len(tokens), INVERSE))
        total[1:] = np.cumsum(tokens.astype(np.int64).view(np.uint64) * back)
    return total, powers


def _windows(prefix: tuple[np.ndarray, np.ndarray], taken: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows of unmarked words and their hashes."""
    total, powers = prefix
    n = len(total) - width
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.flatnonzero(taken[width:] == taken[:n])
    with np.errstate(over="ignore"):
        return at, (total[at + width] - total[at]) * powers[at]


def tiles(a: np.ndarray, b: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in a, start in b, length) of non-overlapping matches, longest first.

    The length of the longest match is found by halving, with the hashes of all windows of one length at a
    time, so a text that repeats itself costs no more than another: no list of all pairs of seeds is made.
    """
    pa_, pb = _prefix(a), _prefix(b)
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    out: list[tuple[int, int, int]] = []
    high = min(len(a), len(b))
    while high >= least:
        taken = [np.r_[0, np.cumsum(~f)] for f in (free_a, free_b)]

        def shared(width: int, taken: list[np.ndarray] = taken) -> bool:
            return bool(np.isin(_windows(pa_, taken[0], width)[1], _windows(pb, taken[1], width)[1]).any())

        if not shared(least):
            break
        low, step = least, 1
        while low + step <= high and shared(low + step):
            low, step = low + step, 2 * step
        top = min(high, low + step - 1)
        while low < top:
            mid = (low + top + 1) // 2
            low, top = (mid, top) if shared(mid) else (low, mid - 1)
        (ia, ha), (ib, hb) = _windows(pa_, taken[0], low), _windows(pb, taken[1], low)
        at: dict[int, list[int]] = {}
        for j, h in zip(ib[::-1].tolist(), hb[::-1].tolist()):
            at.setdefault(h, []).append(j)
        some = np.isin(ha, hb)
        for i, h in zip(ia[some].tolist(), ha[some].tolist()):
            places = at[h]  # the next unmarked one is last; marked ones never come back
            while places and not free_b[places[-1] : places[-1] + low].all():
                places.pop()
            if places and free_a[i : i + low].all() and (a[i : i + low] == b[places[-1] : places[-1] + low]).all():
                j = places[-1]
                free_a[i : i + low] = free_b[j : j + low] = False
                out.append((i, j, low))
        high = low - 1
    return out


def _lists(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return col.flatten().to_numpy(zero_copy_only=False), col.offsets.to_numpy()


class _Items:
    """A set of items in the form a task looks them up: sorted seeds, the items of each, and the words of every item."""

    def __init__(self, rows: pa.Table, width: int):
        self.ids = rows.column("id").to_numpy()
        flat, offsets = _lists(rows.column("tokens").combine_chunks())
        self.words = [flat[offsets[k] : offsets[k + 1]] for k in range(len(self.ids))]
        seed = [np.unique(rolling(w, width).view(np.int64)) for w in self.words]
        every = np.concatenate(seed) if seed else np.empty(0, np.int64)
        owner = np.repeat(np.arange(len(seed)), [len(x) for x in seed])
        order = np.argsort(every, kind="stable")
        self.seeds, first = np.unique(every[order], return_index=True)
        self.owners, self.start = owner[order], np.r_[first, len(every)]

    def met(self, flat: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, item) places of the texts and items that share a seed."""
        h = rolling(flat, width).view(np.int64)
        if not len(h) or not len(self.seeds):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        where = np.minimum(np.searchsorted(self.seeds, h), len(self.seeds) - 1)
        pos = np.flatnonzero(self.seeds[where] == h)
        text = np.searchsorted(offsets, pos, "right") - 1
        inside = pos + width <= offsets[text + 1]  # windows that start in one text and end in another are no seeds
        text, where = text[inside], where[pos[inside]]
        text, where = np.unique(np.stack([text, where]), axis=1) if len(text) else (text, where)
        count = self.start[where + 1] - self.start[where]
        item = self.owners[np.repeat(self.start[where] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())] if len(where) else where
        pairs = np.unique(np.stack([np.repeat(text, count), item]), axis=1) if len(where) else np.empty((2, 0), np.int64)
        return pairs[0], pairs[1]


def leaks(documents: DataFrame, items: DataFrame, tile: int = 12, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "item_text", seeds_held: int = 4_000_000) -> DataFrame:
    """Every document that shares at least ``tile`` consecutive words with an item.

    seeds_held: words of the items that one set holds, and sends to every task (some 24 bytes each); they are counted
    first and the items dealt into as many sets as needed, at least one item each. Rows without id and null or short texts
    match nothing; repeated ids count once: of documents the row that holds most of an item, of items any. Returns
    (doc_id, item_id, tiles, longest, covered, item_words, coverage): number of tiles, words of the longest, words of the
    item they cover, and that share.
    """
    spark = documents.sparkSession
    docs = documents.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("id"), word_hashes(F.col(text)).alias("tokens"))
    tests = items.filter(F.col(item_id).isNotNull()).select(F.col(item_id).cast("long").alias("id"), word_hashes(F.col(item_text)).alias("tokens")).filter(F.size("tokens") >= tile).dropDuplicates(["id"])
    tests = materialize(tests, "items")
    total = tests.agg(F.sum(F.size("tokens"))).first()[0] or 0
    sets = max(1, min(-(-total // max(1, seeds_held)), tests.count()))
    if sets > 1:  # the words of the documents are read once for every set
        docs = materialize(docs.filter(F.size("tokens") >= tile), "words")
    fields = [("id", pa.int64()), ("item", pa.int64()), ("tiles", pa.int32()), ("longest", pa.int32()), ("covered", pa.int32()), ("item_words", pa.int32())]
    schema, spec = pa.schema(fields), "id long, item long, tiles int, longest int, covered int, item_words int"

    def one_set(some: DataFrame) -> DataFrame:
        sent = spark.sparkContext.broadcast(_Items(some.toArrow(), tile))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = sent.value
            for b in batches:
                flat, offsets = _lists(b.column(1))
                offsets = offsets.astype(np.int64) - offsets[0]
                rows = []
                for t, i in zip(*(x.tolist() for x in held.met(flat, offsets, tile))):
                    got = tiles(flat[offsets[t] : offsets[t + 1]], held.words[i], tile)
                    if got:
                        rows.append((b.column(0)[t].as_py(), int(held.ids[i]), len(got), max(x[2] for x in got), sum(x[2] for x in got), len(held.words[i])))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], schema=schema)

        return docs.mapInArrow(run, spec)

    of = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(sets))
    found = [one_set(tests.filter(of == k) if sets > 1 else tests) for k in range(sets)]
    out = reduce(DataFrame.unionByName, found)
    best = out.groupBy("id", "item").agg(F.max(F.struct("covered", "longest", "tiles", "item_words")).alias("m")).select("id", "item", "m.*")
    return best.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "tiles", "longest", "covered", "item_words", (F.col("covered") / F.col("item_words")).alias("coverage"))
