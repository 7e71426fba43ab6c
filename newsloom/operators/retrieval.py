"""Hybrid retrieval: exact nearest neighbours, lexical and metadata scores, fusion, diversification."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import vectors


def nearest(collection: DataFrame, queries: DataFrame, k: int, ident: str = "vec_id", vector: str = "embedding", block: int = 512, most: int = 100_000) -> DataFrame:
    """The ``k`` most similar vectors (cosine) of every query, without the query itself.

    The queries travel to the collection in sets of at most ``most``, dealt by id and counted first: every task keeps the best ``k`` of its
    own vectors per query, and only those are shuffled. Each set is one pass over the collection. Ties are broken by id.
    """
    sets = max(1, -(-queries.count() // most))
    if sets == 1:
        return _nearest(collection, queries, k, ident, vector, block)
    of = F.pmod(F.xxhash64(F.col(ident).cast("long")), F.lit(sets))
    parts = [_nearest(collection, queries.filter(of == i), k, ident, vector, block) for i in range(sets)]
    return reduce(DataFrame.unionByName, parts)


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)


def _better(ids: np.ndarray, scores: np.ndarray, new_ids: np.ndarray, new_scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of two lists per query the ``k`` best entries, by score and then by id."""
    i, s = np.concatenate([ids, new_ids], axis=1), np.concatenate([scores, new_scores], axis=1)
    order = np.lexsort((i, -s), axis=1)[:, :k]
    return np.take_along_axis(i, order, 1), np.take_along_axis(s, order, 1)


def _best_of(q: np.ndarray, q_ids: np.ndarray, v: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of the vectors for every query; ``own`` ascending, so that ties keep the smaller ids."""
    s = q @ v.T
    s[q_ids[:, None] == own[None, :]] = -np.inf
    top = np.argsort(-s, axis=1, kind="stable")[:, :k]
    return own[top], np.take_along_axis(s, top, 1)


def _nearest(collection: DataFrame, queries: DataFrame, k: int, ident: str, vector: str, block: int) -> DataFrame:
    """One set of queries of :func:`nearest`."""
    rows = queries.select(ident, vector).filter(F.col(vector).isNotNull()).toArrow().to_pydict()
    q_ids = np.array(rows[ident], np.int64)
    sent = collection.sparkSession.sparkContext.broadcast((q_ids, _unit(np.array(rows[vector], np.float64)) if len(q_ids) else np.zeros((0, 1))))

    def run(batches):  # noqa: ANN001, ANN202
        ids, qs = sent.value
        best_i, best_s = np.full((len(ids), k), np.iinfo(np.int64).max), np.full((len(ids), k), -np.inf)
        for pdf in batches:
            if not len(pdf) or not len(ids):
                continue
            pdf = pdf.sort_values(ident)
            own, v = pdf[ident].to_numpy(), _unit(np.stack(pdf[vector].to_numpy()).astype(np.float64))
            for lo in range(0, len(ids), block):
                at = slice(lo, lo + block)
                best_i[at], best_s[at] = _better(best_i[at], best_s[at], *_best_of(qs[at], ids[at], v, own, k), k)
        for lo in range(0, len(ids), 4096):
            i, s = best_i[lo : lo + 4096], best_s[lo : lo + 4096]
            ok = np.isfinite(s)
            yield pd.DataFrame({"query_id": np.repeat(ids[lo : lo + 4096], ok.sum(axis=1)), ident: i[ok], "score": s[ok]})

    part = collection.select(ident, vector).filter(F.col(vector).isNotNull()).mapInPandas(run, f"query_id long, {ident} long, score double")
    return _first(part, ident, k)


def _first(hits: DataFrame, ident: str, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(ident))
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", ident, "score", "rank")


# --- an index of cells ---------------------------------------------------------------------------------


def centroids(collection: DataFrame, cells: int, ident: str = "vec_id", vector: str = "embedding", sample: int = 50_000, rounds: int = 8) -> np.ndarray:
    """Unit centroids of spherical k-means over a sample of about ``sample`` vectors chosen by a hash of their id (the bound of the fit)."""
    known = collection.select(ident, vector).filter(F.col(vector).isNotNull())
    n = known.count()
    if n > sample:
        known = known.filter(F.pmod(F.xxhash64(ident, F.lit(5)), F.lit(1 << 20)) < max(1, round((1 << 20) * sample / n)))
    rows = known.toArrow().sort_by(ident).to_pydict()
    v = _unit(np.array(rows[vector], np.float64)) if rows[ident] else np.zeros((1, 1))
    c = v[np.linspace(0, len(v) - 1, min(cells, len(v))).astype(int)]
    for _ in range(rounds):
        of = (v @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, of, v)
        c = np.where(np.linalg.norm(total, axis=1, keepdims=True) > 0, _unit(total), c)
    return c


def _cells(df: DataFrame, c: np.ndarray, count: int, ident: str, vector: str) -> DataFrame:
    """(ident, vector, cell): every vector with its ``count`` nearest cells."""
    sent = df.sparkSession.sparkContext.broadcast(c)

    def run(batches):  # noqa: ANN001, ANN202
        for pdf in batches:
            if len(pdf):
                s = _unit(np.stack(pdf[vector].to_numpy()).astype(np.float64)) @ sent.value.T
                top = np.argpartition(-s, min(count, s.shape[1]) - 1, axis=1)[:, :count]
                out = pdf.loc[pdf.index.repeat(top.shape[1])]
                yield out.assign(cell=top.ravel().astype(np.int32))

    return df.select(ident, vector).filter(F.col(vector).isNotNull()).mapInPandas(run, f"{ident} long, {vector} array<float>, cell int")


def indexed(collection: DataFrame, c: np.ndarray, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The index: every vector with the cell of its nearest centroid."""
    return _cells(collection, c, 1, ident, vector)


def search(index: DataFrame, c: np.ndarray, queries: DataFrame, k: int, probes: int = 8, ident: str = "vec_id", vector: str = "embedding", group: int = 20_000) -> DataFrame:
    """The ``k`` most similar vectors of every query among those of its ``probes`` nearest cells, scored exactly.

    A cell of more than ``group`` vectors is dealt into blocks and its queries are sent to each, and likewise the other way round, so a crowded
    cell is many tasks of bounded size. Recall depends on ``probes``; with as many as there are cells the result is exact.
    """
    asked = _cells(queries, c, probes, ident, vector)
    # one row per cell, as many as centroids
    size = index.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / group).cast("int").alias("parts")).join(asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / group).cast("int").alias("cuts")), "cell")
    size = F.broadcast(size)
    deal = lambda n: F.pmod(F.xxhash64(ident), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = index.join(size, "cell").withColumn("part", deal("parts")).withColumn("cut", every("cuts")).select("cell", "part", "cut", ident, vector)
    b = asked.join(size, "cell").withColumn("cut", deal("cuts")).withColumn("part", every("parts")).select("cell", "part", "cut", ident, vector)

    def best(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return pd.DataFrame({"query_id": [], ident: [], "score": []})
        x = x.sort_values(ident)
        own, v = x[ident].to_numpy(), _unit(np.stack(x[vector].to_numpy()).astype(np.float64))
        out = []
        for lo in range(0, len(y), 512):
            ids, q = y[ident].to_numpy()[lo : lo + 512], _unit(np.stack(y[vector].to_numpy()[lo : lo + 512]).astype(np.float64))
            i, s = _best_of(q, ids, v, own, k)
            ok = np.isfinite(s)
            out.append(pd.DataFrame({"query_id": np.repeat(ids, ok.sum(axis=1)), ident: i[ok], "score": s[ok]}))
        return pd.concat(out)

    keys = ["cell", "part", "cut"]
    return _first(a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInPandas(best, f"query_id long, {ident} long, score double"), ident, k)


def probes_for(index: DataFrame, c: np.ndarray, queries: DataFrame, k: int, recall: float = 0.95, sample: int = 200, ident: str = "vec_id", vector: str = "embedding") -> int:
    """Cells to probe for a recall: the fewest that hold this share of the true neighbours of about ``sample`` queries.

    The neighbours are found exactly, in one pass over the collection; each is looked up in the index, and what counts is how near
    its cell is to the query. Data without structure need most cells, clustered data few.
    """
    n = queries.count()
    some = queries.select(ident, vector).filter(F.col(vector).isNotNull())
    if n > sample:
        some = some.filter(F.pmod(F.xxhash64(ident, F.lit(7)), F.lit(1 << 20)) < max(1, round((1 << 20) * sample / n)))
    rows = some.toArrow().to_pydict()
    if not rows[ident]:
        return len(c)
    place = (-(_unit(np.array(rows[vector], np.float64)) @ c.T)).argsort(axis=1).argsort(axis=1)
    row = {q: r for r, q in enumerate(rows[ident])}
    hits = nearest(index.select(ident, vector), some, k, ident, vector).join(index.select(ident, "cell"), ident).select("query_id", "cell").collect()  # k rows a sampled query
    at = sorted(int(place[row[h["query_id"]], h["cell"]]) for h in hits)
    return at[min(len(at) - 1, int(np.ceil(recall * len(at))) - 1)] + 1 if at else len(c)


def lexical(query: Sequence[str], tokens: Column, text: Column) -> Column:
    """0.8 of the share of query words present, repeated ones counted again, and 0.2 for the whole phrase."""
    words = [w.lower() for w in query if w]
    if not words:
        return F.lit(0.0)
    hit = sum((F.array_contains(tokens, w).cast("double") for w in words), F.lit(0.0))
    return 0.8 * hit / len(words) + 0.2 * F.contains(F.lower(text), F.lit(" ".join(words))).cast("double")


def fused(dense: Column, lexical_score: Column, metadata: Column) -> Column:
    """0.55 dense, 0.25 lexical, 0.20 metadata; dense already scaled to 0..1."""
    return 0.55 * dense + 0.25 * lexical_score + 0.20 * metadata


def scaled(df: DataFrame, score: str) -> DataFrame:
    """Adds ``<score>_scaled`` between the smallest and largest score of the frame; all equal gives 1."""
    lo, hi = df.agg(F.min(score)).scalar(), df.agg(F.max(score)).scalar()
    return df.withColumn(f"{score}_scaled", vectors.minmax(F.col(score), lo, hi))


def _choices(most: int, agree: int) -> list[int]:
    """Masks of the choices of ``agree`` of ``most + agree`` blocks of a 64-bit fingerprint.

    By pigeonhole two fingerprints at most ``most`` bits apart are equal under at least one of these masks: more blocks in a
    choice make its lists shorter and the choices more.
    """
    parts = most + agree
    edges = [round(64 * k / parts) for k in range(parts + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(block, agree)]


def fingerprint_classes(df: DataFrame, ident: str, simhash: str) -> DataFrame:
    """(ident, class_id): every record with the smallest id among the records of its fingerprint; ids are distinct, null fingerprints have no class."""
    own = df.filter(F.col(simhash).isNotNull() & F.col(ident).isNotNull()).select(F.col(ident), F.col(simhash).alias("__h")).distinct()
    one = own.groupBy("__h").agg(F.min(ident).alias("class_id"))
    return own.join(one, "__h").select(ident, "class_id")


def fingerprint_pairs(df: DataFrame, ident: str, simhash: str, most: int = 6, agree: int | None = None) -> DataFrame:
    """Pairs of different fingerprints at most ``most`` bits apart, over class representatives.

    Equal fingerprints are one class, so a crowd of copies meets nobody twice. agree: blocks in a key (see :func:`_choices`); by default as
    many as keep the keys longer than the number of fingerprints needs (some 16, 21 or 26 bits), which changes the work and never the
    result. Returns (a, b, bits) of the smallest ids of the classes; :func:`fingerprint_classes` has the members.
    """
    one = df.filter(F.col(simhash).isNotNull()).groupBy(F.col(simhash).alias("h")).agg(F.min(ident).alias("id"))
    if agree is None:
        n = one.count()
        agree = next((g for g in (2, 3) if n <= 1 << (64 * g // (most + g) + 4)), 4)
    masks = _choices(most, agree)
    kind = one.select("id").schema["id"].dataType.simpleString()

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 5000):
                b = whole.slice(lo, 5000)
                h = b.column(1).to_numpy().view(np.uint64)
                for n, m in enumerate(masks):
                    key = (h & np.uint64(m)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), n, np.int32)), pa.array(key), *b.columns], names=["part", "bits", "id", "h"])

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = one.select("id", "h").mapInArrow(keyed, f"part int, bits long, id {kind}, h long").repartition(parts, "part", "bits").sortWithinPartitions("part", "bits")
    near = lists.mapInArrow(lambda batches: _near_in_lists(batches, most), f"a {kind}, b {kind}, bits int")
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "bits").distinct()


def _near_in_lists(batches: Iterable[pa.RecordBatch], most: int, held: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """Pairs at most ``most`` bits apart of every list of equal (part, bits); lists are whole and follow each other."""

    def pairs(t: pa.Table) -> Iterator[pa.RecordBatch]:
        part, bits, h = (t.column(c).to_numpy() for c in ("part", "bits", "h"))
        h = h.view(np.uint64)
        new = np.r_[True, (part[1:] != part[:-1]) | (bits[1:] != bits[:-1])]
        stop = np.r_[np.flatnonzero(new)[1:], len(h)]
        end = stop[np.cumsum(new) - 1]
        at, k = np.arange(len(h)), 1
        while len(at := at[at + k < end[at]]):  # every record with the k-th after it in its list
            for lo in range(0, len(at), held):
                x = at[lo : lo + held]
                apart = np.bitwise_count(h[x] ^ h[x + k])
                ok = np.flatnonzero(apart <= most)
                if len(ok):
                    yield pa.RecordBatch.from_arrays([*(t.column("id").take(pa.array(i)).combine_chunks() for i in (x[ok], x[ok] + k)), pa.array(apart[ok].astype(np.int32))], names=["a", "b", "bits"])
            k += 1

    rest: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        if not b.num_rows:
            continue
        rest.append(b)
        rows += b.num_rows
        if rows < held:
            continue
        t = pa.Table.from_batches(rest)
        part, bits = t.column("part").to_numpy(), t.column("bits").to_numpy()
        cut = int(np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (bits[1:] != bits[:-1])])[-1])  # the last list may go on
        if cut:
            yield from pairs(t.slice(0, cut))
        rest = t.slice(cut).to_batches()
        rows = t.num_rows - cut
    if rest:
        yield from pairs(pa.Table.from_batches(rest))


def diversified(hits: DataFrame, query: str, order: Sequence[Column], url: str, simhash: str, keep: int, most: int = 6, heads: int = 64) -> DataFrame:
    """The first ``keep`` hits of every query that are no near copies of a hit kept before: another address and path, and more than ``most`` bits apart.

    The list is greedy, so it is settled row by row, on the first ``heads`` hits of a query only (the feature: a short list for readers).
    """
    w = Window.partitionBy(query).orderBy(*order)
    short = hits.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= heads)
    short = short.withColumn("__path", F.regexp_replace(F.regexp_replace(F.lower(url), r"^[a-z][a-z0-9+.-]*://", ""), r"[?#].*$|/+$", ""))

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        kept: list[int] = []
        seen: set[str] = set()
        prints: list[int] = []
        for k, (path, h) in enumerate(zip(*(pdf.sort_values("place")[c] for c in ("__path", simhash)))):
            near = not pd.isna(h) and any(((int(h) ^ x) & ((1 << 64) - 1)).bit_count() <= most for x in prints)
            if len(kept) < keep and not near and not (path and path in seen):
                kept.append(k)
                seen.add(path)
                prints += [] if pd.isna(h) else [int(h)]
        return pdf.sort_values("place").iloc[kept]

    return short.groupBy(query).applyInPandas(settle, short.schema).drop("__path")


def widening(df: DataFrame, score: str, thresholds: Sequence[float], most: int, ident: str) -> DataFrame:
    """Records by falling thresholds until ``most`` are found: adds ``phase`` (from 1).

    One pass finds every record's phase and the sizes of the phases; phases past the one that fills the list are
    not sorted. Inside a phase the better score comes first, then the smaller id.
    """
    phase = F.lit(None).cast("int")
    for k, t in reversed(list(enumerate(thresholds, 1))):
        phase = F.when(F.col(score) >= t, k).otherwise(phase)
    # thresholds fall, so the first that holds is the phase
    found = df.withColumn("phase", phase).filter("phase is not null")
    sizes = {r["phase"]: r["count"] for r in found.groupBy("phase").count().collect()}  # one row per threshold
    need, last = 0, 0
    for k in range(1, len(thresholds) + 1):
        last = k
        need += sizes.get(k, 0)
        if need >= most:
            break
    return found.filter(F.col("phase") <= last).orderBy("phase", F.desc(score), ident).limit(most)
