"""Near-duplicate records with small edits: an inverted index with count filtering on positional bytes.

A record is the set of its distinct words. Two sets as similar as asked for share a known number of words,
so, with words put in one order from rare to frequent, they share one of the first few: the index lists a
record under each of those (prefix filter), and no such pair can miss another there. A record also carries
a row of positional bytes of its words from there on: every word turns over one bit of one byte. The bytes of
two records differ in at most as many bits as the words differ; so pairs of a list that have too few words left,
or whose bytes differ in more bits than the similarity allows, are dropped, and the rest is verified on the words
themselves. The filters are bounds and not chances: every pair at or above the similarity is a link. Identical word sets are one class from the start.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.cut import materialize
from newsloom.operators.components import components

BYTES = 32
SLOTS = 1 << 20
ROWS = "id long, n int, early int, s0 long, s1 long, s2 long, s3 long, words array<long>"
POSTINGS = "key long, id long, n int, rest int, s0 long, s1 long, s2 long, s3 long"
NAMES = [f.split()[0] for f in POSTINGS.split(", ")]
EPS = 1e-9
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def slot(words: np.ndarray) -> np.ndarray:
    return ((words.view(np.uint64) >> np.uint64(20)) % np.uint64(SLOTS)).astype(np.int64)


def positional_bytes(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of ``BYTES`` bytes, as 64-bit numbers, of word sets given as concatenated 64-bit word hashes; every word turns over one bit."""
    at = (mixed(flat.view(np.uint64)) % np.uint64(8 * BYTES)).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    odd = np.bincount(row * 8 * BYTES + at, minlength=(len(offsets) - 1) * 8 * BYTES).astype(np.uint8) & 1
    return np.packbits(odd.reshape(-1, 8 * BYTES), axis=1).view(np.uint64)


def turned(words: np.ndarray) -> np.ndarray:
    """The row of every single word: the bit that it turns over in :func:`positional_bytes`."""
    at = mixed(words.view(np.uint64)) % np.uint64(8 * BYTES)
    out = np.zeros((len(words), BYTES // 8), np.uint64)
    out[np.arange(len(words)), (at >> np.uint64(6)).astype(np.int64)] = np.uint64(1) << ((at & np.uint64(56)) + np.uint64(7) - (at & np.uint64(7)))
    return out


def record_counts(sets: DataFrame) -> np.ndarray:
    """Records per word in hashed counters: at most ``SLOTS`` numbers come to the driver, whatever the corpus."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for b in batches:
            total += np.bincount(slot(b.column(0).flatten().to_numpy(zero_copy_only=False)), minlength=SLOTS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["slot", "n"])

    got = sets.select("words").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SLOTS, np.int64)
    out[got.column("slot").to_numpy()] = got.column("n").to_numpy()
    return out


def _rows(sets: DataFrame, similarity: float) -> DataFrame:
    """(id, words) -> records with their size, positional bytes and first words in the common order.

    Of n words the first n - ceil(t n) + 1 are listed. ``early`` counts those that suffice for the smaller set of
    a pair, n - ceil(2 t n / (1 + t)) + 1: the larger one has at least as many words.
    """
    sent = sets.sparkSession.sparkContext.broadcast(record_counts(sets))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 2000):
                b = whole.slice(lo, 2000)
                offsets = b.column(1).offsets.to_numpy().astype(np.int64)
                flat, offsets = b.column(1).flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]
                n = np.diff(offsets)
                order = np.lexsort((flat, sent.value[slot(flat)], np.repeat(np.arange(len(n)), n)))
                listed = n - np.ceil(similarity * n - EPS).astype(np.int64) + 1
                listed, early = np.clip(listed, 1, n), n - np.ceil(2 * similarity / (1 + similarity) * n - EPS).astype(np.int64) + 1
                rank = np.arange(len(flat)) - np.repeat(offsets[:-1], n)
                first = flat[order][rank < np.repeat(listed, n)]
                s = positional_bytes(flat, offsets).view(np.int64)
                words = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(listed)], pa.int32()), pa.array(first))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int32()), pa.array(early, pa.int32()), *(pa.array(s[:, k]) for k in range(4)), words], names=["id", "n", "early", "s0", "s1", "s2", "s3", "words"])

    return sets.select("id", "words").mapInArrow(run, ROWS)


def _postings(rows: DataFrame, crowd: int) -> DataFrame:
    """Rows of the index: a record under each of its first words, with ``rest``, the number of its words from there on, and their positional bytes.

    A list of more than ``crowd`` records is dealt into sub-lists of about that size, and every two of them are
    one list of the index, so that all its pairs meet, in many tasks.
    """
    sent = rows.sparkSession.sparkContext.broadcast(record_counts(rows))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                ident, n = (b.column(k).to_numpy() for k in range(2))
                word, offsets = b.column(6).flatten().to_numpy(zero_copy_only=False), b.column(6).offsets.to_numpy().astype(np.int64)
                offsets = offsets - offsets[0]
                size = np.diff(offsets)
                record, start = np.repeat(np.arange(len(n)), size), np.repeat(offsets[:-1], size)
                before = np.zeros((len(word), BYTES // 8), np.uint64)  # bytes of the words up to this one, over all records
                before[1:] = np.bitwise_xor.accumulate(turned(word), axis=0)[:-1]
                s = np.stack([b.column(k).to_numpy() for k in range(2, 6)], axis=1).view(np.uint64)[record] ^ before ^ before[start]
                parts = -(-sent.value[slot(word)] // crowd)
                own = (mixed(ident.view(np.uint64))[record] % np.maximum(parts, 1).astype(np.uint64)).astype(np.int64)
                for lo in range(0, len(word), 20_000):
                    p = parts[lo : lo + 20_000]
                    row = lo + np.repeat(np.arange(len(p)), np.maximum(p - 1, 1))
                    other = np.arange(len(row)) - np.searchsorted(row, row)
                    other += (other >= own[row]) & (parts[row] > 1)
                    low, high = np.minimum(own[row], other), np.maximum(own[row], other)
                    with np.errstate(over="ignore"):
                        dealt = mixed(word[row].view(np.uint64) ^ mixed((low * np.int64(1 << 31) + high + 1).view(np.uint64))).view(np.int64)
                    key, of = np.where(parts[row] > 1, dealt, word[row]), record[row]
                    rest = (n[of] - (row - start[row])).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ident[of]), pa.array(n[of]), pa.array(rest), *(pa.array(s[row, k].view(np.int64)) for k in range(4))], names=NAMES)

    return rows.select("id", "n", "s0", "s1", "s2", "s3", "words").mapInArrow(run, POSTINGS)


def _candidates(postings: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of the lists of the index whose sizes, places and positional bytes allow the similarity.

    Sets of m and n words must share c (m + n) of them, c = similarity / (1 + similarity). In the list of the first word they
    share, all of these are among the words from there on: both sets have as many left, and the bytes of what is left differ
    in at most rest - 2 c m of the one and rest - 2 c n of the other together. A pair is found there, whatever its other lists say.
    A long list is cut into bands by size, each with the largest ``rest`` first, so two bands meet in a rectangle of pairs that
    have enough words left; there 64 or 128 bits into which the bytes are folded are compared first.
    """
    c, area, few, width, most = similarity / (1 + similarity), 1 << 15, 64, 256, 64

    def near(a: np.ndarray, b: np.ndarray, n: np.ndarray, rest: np.ndarray, s: list[np.ndarray]) -> np.ndarray:
        need = c * (n[a] + n[b])
        ok = np.flatnonzero(np.minimum(rest[a], rest[b]) >= need - EPS)
        a, b = a[ok], b[ok]
        bits = sum(np.bitwise_count(x[a] ^ x[b]).astype(np.int64) for x in s)
        return ok[bits <= rest[a] + rest[b] - 2 * need[ok] + EPS]

    def pairs(key: np.ndarray, n: np.ndarray, rest: np.ndarray, s: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions of pairs; lists are sorted by size."""
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        stop = np.r_[start[1:], len(key)]
        size = stop - start
        at = np.flatnonzero(np.repeat(size, size) <= few)
        for k in range(1, few):
            at = at[at + k < len(key)]
            at = at[key[at] == key[at + k]]
            if not len(at):
                break
            ok = near(at, at + k, n, rest, s)
            yield at[ok], at[ok] + k
        for lo, hi in zip(start[size > few].tolist(), stop[size > few].tolist()):
            yield from long_list(lo, hi, n, rest, s)

    def long_list(lo: int, hi: int, n: np.ndarray, rest: np.ndarray, s: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = max(width, -(-(hi - lo) // most))
        order = lo + np.lexsort((-rest[lo:hi], np.arange(hi - lo) // step))
        m, left, (s0, s1, s2, s3) = n[order], rest[order], (x[order] for x in s)
        two = (s0 ^ s2, s1 ^ s3)
        one = two[0] ^ two[1]
        spare = np.floor(left - 2 * c * m + EPS)  # bits that may differ for this side; rounded down, so the other side gets one more
        spare = spare.astype(np.int8 if np.abs(spare).max() < 60 else np.int32)
        more = spare + spare.dtype.type(1)
        wide, first, second = np.empty(area, np.uint64), np.empty(area, np.uint8), np.empty(area, np.uint8)
        bands = [(k, min(k + step, hi - lo)) for k in range(0, hi - lo, step)]
        least, largest = [int(m[a:b].min()) for a, b in bands], [int(m[a:b].max()) for a, b in bands]
        falling = -left

        def enough(band: int, need: float) -> int:
            a, b = bands[band]
            return a + int(np.searchsorted(falling[a:b], -need + EPS, "right"))

        for x in range(len(bands)):
            for y in range(x, len(bands)):
                if least[y] * similarity > largest[x] + EPS:
                    break
                need = c * (least[x] + least[y])
                p, end, q, last = bands[x][0], enough(x, need), bands[y][0], enough(y, need)
                while p < end and q < last:
                    b = slice(q, min(q + area, last))
                    a = slice(p, min(end, p + max(1, area // (b.stop - q))))
                    shape = (a.stop - p, b.stop - q)
                    w, f, g = (t[: shape[0] * shape[1]].reshape(shape) for t in (wide, first, second))
                    if spare[a].mean() + spare[b].mean() < 10:
                        np.bitwise_count(np.bitwise_xor(one[a, None], one[None, b], out=w), out=f)
                    else:
                        np.bitwise_count(np.bitwise_xor(two[0][a, None], two[0][None, b], out=w), out=f)
                        np.bitwise_count(np.bitwise_xor(two[1][a, None], two[1][None, b], out=w), out=g)
                        np.add(f, g, out=f)
                    differ = f.view(np.int8) if spare.dtype == np.int8 else f  # 128 bits become -128, which the last test drops
                    i, j = np.divmod(np.flatnonzero(differ <= spare[a, None] + more[None, b]), shape[1])
                    i, j = order[p + i], order[q + j]
                    if x == y:
                        i, j = i[i != j], j[i != j]
                    ok = near(i, j, n, rest, s)
                    yield i[ok], j[ok]
                    p, q = (a.stop, bands[y][0]) if b.stop == last else (p, b.stop)
                    if x == y and p == a.stop:
                        q = p

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None
        for b in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            rest = new if rest is None else [np.concatenate(x) for x in zip(rest, new)]
            cut = int(np.searchsorted(rest[0], rest[0][-1])) if len(rest[0]) else 0  # the last list may go on
            if cut:
                yield from found([c[:cut] for c in rest])
                rest = [c[cut:] for c in rest]
        if rest is not None and len(rest[0]):
            yield from found(rest)

    def found(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, ident, n, rest = cols[:4]
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for i, j in pairs(key, n.astype(np.int64), rest.astype(np.int64), [c.view(np.uint64) for c in cols[4:]]):
            for lo in range(0, len(i), 200_000):
                held.append((ident[i[lo : lo + 200_000]], ident[j[lo : lo + 200_000]]))
                if sum(len(x) for x, _ in held) >= 100_000:
                    yield batch(held)
                    held = []
        if held:
            yield batch(held)

    def batch(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        x, y = (np.concatenate(side) for side in zip(*held))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    parts = int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return postings.repartition(parts, "key").sortWithinPartitions("key", "n", "id").mapInArrow(run, "a long, b long").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    one = pairs.join(sets.select(F.col("id").alias("a"), F.col("words").alias("wa")), "a").join(sets.select(F.col("id").alias("b"), F.col("words").alias("wb")), "b")
    both = F.size(F.array_intersect("wa", "wb"))
    return one.select("a", "b", (both / (F.size("wa") + F.size("wb") - both)).alias("similarity")).filter(F.col("similarity") >= similarity)


def near_duplicates(records: DataFrame, similarity: float = 0.8, crowd: int = 1 << 18) -> DataFrame:
    """Group records whose sets of distinct words are similar.

    records: (id long, words array<string or long>), one row per record; repeated ids count once, null ids
    and empty or null word sets take no part. similarity: shared words over all words of both, above 0.
    crowd: records above which a list of the index is dealt into sub-lists, of which every two are compared; a record is in
    the index once more for every further sub-list, so small ones multiply the index. The result does not depend on it.

    Returns (id, class_id, representative, links): the smallest id of the group, of the records with
    the same words, and the number of other word sets the record is linked to; every record has one row.
    """
    if not 0 < similarity <= 1:
        raise ValueError(f"similarity {similarity}: above 0, at most 1")
    words = F.array_sort(F.array_distinct(F.filter("words", lambda w: w.isNotNull())))
    hashed = records.filter("id is not null").select(F.col("id").cast("long").alias("id"), F.transform(words, lambda w: F.xxhash64(w)).alias("words")).filter(F.size("words") > 0).dropDuplicates(["id"])
    hashed = materialize(hashed.select("id", "words", F.xxhash64(F.array_sort("words")).alias("h")), "records")
    classes = materialize(hashed.groupBy("h").agg(F.min("id").alias("representative")), "classes")
    ids = hashed.select("id", "h")
    sets = materialize(hashed.select("id", "words").join(classes.select(F.col("representative").alias("id")), "id", "left_semi"), "sets")
    rows = materialize(_rows(sets, similarity), "rows")
    links = materialize(_verified(_candidates(_postings(rows, crowd), similarity), sets, similarity), "links")
    group = components(links)
    degree = links.select(F.col("a").alias("representative")).union(links.select("b")).groupBy("representative").agg(F.count(F.lit(1)).alias("links"))
    out = ids.join(classes, "h").join(group.withColumnRenamed("node", "representative"), "representative", "left").join(degree, "representative", "left")
    return out.select("id", F.coalesce("component", "representative").alias("class_id"), "representative", F.coalesce("links", F.lit(0)).alias("links"))


def title_words(title: Column, summary: Column, address: Column) -> Column:
    """Lower-cased runs of letters and digits of title and summary; a null title gives way to the address's last path segment, decoded."""
    path = F.regexp_replace(F.regexp_replace(address, r"[?#].*$", ""), r"/+$", "")
    slug = F.regexp_extract(path, r"([^/]*)$", 1)
    text = F.concat_ws(" ", F.coalesce(title, F.try_url_decode(F.regexp_replace(slug, r"\+", "%2B")), slug), summary)
    return F.regexp_extract_all(F.lower(F.replace(text, F.lit("&amp;"), F.lit("&"))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
