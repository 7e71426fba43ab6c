"""Shapes of the plans that matter at scale, and texts that repeat themselves."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from newsloom.llm import cap, leaks, terms


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def naive_tiles(a, b, least):
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    while True:
        best = []
        longest = least
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and free_a[i + k] and free_b[j + k] and a[i + k] == b[j + k]:
                    k += 1
                if k > longest:
                    longest, best = k, [(i, j)]
                elif k == longest:
                    best.append((i, j))
        if not best:
            return out
        for i, j in best:
            if all(free_a[i : i + longest]) and all(free_b[j : j + longest]):
                free_a[i : i + longest] = free_b[j : j + longest] = [False] * longest
                out.append((i, j, longest))


def test_tiles_are_the_greedy_ones():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ([rng.randrange(rng.choice([2, 3, 9])) for _ in range(rng.randrange(1, 40))] for _ in range(2))
        least = rng.randrange(1, 6)
        assert leaks.tiles(np.array(a), np.array(b), least) == naive_tiles(a, b, least)


def test_tiles_of_repetition():
    began = time.time()
    assert leaks.tiles(np.zeros(200_000, np.int64), np.zeros(3_000, np.int64), 12) == [(0, 0, 3_000)]
    assert sum(x[2] for x in leaks.tiles(np.tile([1, 2], 50_000), np.r_[np.tile([1, 2], 500), 7, np.tile([2, 1], 300)], 12)) == 1600
    assert time.time() - began < 20


def test_documents_are_not_shuffled(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b c d e f g h i j k l "), F.col("id").cast("string")).alias("text"))
    items = spark.createDataFrame([(1, "x a b c d e f g h i j k l y")], "item_id long, item_text string")
    got = leaks.leaks(docs, items)
    p = plan(got)
    assert got.count() == 1000 and "Join" not in p and p.count("Exchange") == 1  # of the matches, by document and item
    assert "tokens" not in p[: p.index("MapInArrow")]


def test_records_are_not_joined_on_their_contributor(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).alias("day"), F.lit("a.example").alias("dom"), F.rand(1).alias("s"))
    got = cap.over_cap(df, "day", F.col("dom"), [F.col("s")], "doc_id", share=0.1)
    p = plan(got)
    assert "SortMergeJoin" not in p and "hashpartitioning(day" not in p and "hashpartitioning(contributor" not in p
    assert got.filter("kept").count() == 66 + 66 + 66


def test_ranks_where_runs_cross_tasks(spark):
    rows = [(k, "abc"[min(k // 7, 2)] if k < 30 else "d" if k % 2 else None) for k in range(60)]
    df = spark.createDataFrame(rows, "id long, key string")
    for parts in (1, 3, 8, 40):
        got = {(r.key, r.id): r.rank for r in cap.ranked(df, ["key"], [F.col("id").asc()], parts).collect()}
        want, seen = {}, {}
        for i, k in sorted(rows):
            seen[k] = seen.get(k, 0) + 1
            want[k, i] = seen[k]
        assert got == want


def test_bitmaps_do_not_depend_on_tasks(spark):
    """A term's bitmaps, united over the tasks that built them, name the same records however the table is cut; two terms can be intersected."""
    rng = random.Random(5)
    rows = [(k, "f", rng.sample("abcdef", rng.randrange(1, 5))) for k in range(3000)]
    df = spark.createDataFrame(rows, "id long, field string, terms array<string>").withColumn("number", F.col("id") * 40)

    def bitmaps(some):
        out = {}
        for r in terms.term_bitmaps(some, hold=500).collect():
            out.setdefault((r.term, r.container), []).append(bytes(r.bitmap))
        return {k: terms.union(v) for k, v in out.items()}

    one, other = bitmaps(df.coalesce(1)), bitmaps(df.repartition(5))
    assert one == other and len({c for _, c in one}) == 2
    both = sum(terms.cardinality(terms.intersection(one["a", c], one["b", c])) for c in (0, 1))
    assert both == sum("a" in t and "b" in t for _, _, t in rows)
    got = {r.term: r.docs for r in terms.term_frequencies(df.repartition(5), ident="id").collect()}
    assert got == {t: sum(t in x for _, _, x in rows) for t in "abcdef"}
