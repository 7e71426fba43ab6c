"""Ranks, index search, diversification, guarded SQL, pages, rule files, stores and intermediate tables."""

import json
import os
import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsloom import cut
from newsloom.functions import html, ids
from newsloom.operators import ranks, retrieval, rules, safe_sql, tables
from newsloom.plans import evidence
from newsloom.sources import readers, sinks

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranks_without_gathering_a_key(spark):
    rng = random.Random(1)
    rows = [(k, rng.choice(["hot", "hot", "b", None]), rng.choice([None, 1.0, 2.0, 3.5])) for k in range(500)]
    df = spark.createDataFrame(rows, "id long, g string, v double")
    for parts in (1, 7):
        got = {r.id: r.rank for r in ranks.ranked(df, ["g"], [F.col("v").asc_nulls_first(), F.col("id").asc()], parts).collect()}
        want = {}
        for g in {r[1] for r in rows}:
            for n, (_, _, i) in enumerate(sorted((v is not None, v or 0, i) for i, x, v in rows if x == g), 1):
                want[i] = n
        assert got == want
    assert "hashpartitioning(g" not in plan(ranks.ranked(df, ["g"], [F.col("id").asc()]))
    q = {r.g: (r.a, r.b) for r in ranks.quantiles(df, "g", "v", [0.2, 0.75], ["a", "b"]).collect()}
    for g in {r[1] for r in rows}:
        v = [v for _, x, v in rows if x == g and v is not None]
        assert q[g] == pytest.approx((np.quantile(v, 0.2), np.quantile(v, 0.75)))
    assert ranks.ranked(df.limit(0), ["g"], [F.col("id").asc()]).count() == 0 and ranks.quantiles(df.filter("v is null"), "g", "v", [0.5], ["m"]).filter("m is not null").count() == 0


def test_round_robin_takes_turns(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 90, "big").otherwise("small").alias("s"))
    got = tables.round_robin(df, "s", [F.asc("id")]).collect()
    assert [r.s for r in got[:4]] == ["big", "small", "big", "small"] and len(got) == 100


def test_packets(spark):
    got = rules.packets(spark.range(1003), [F.asc("id")], 100).collect()
    assert {(r.id // 100 + 1, r.id % 100 + 1) for r in got} == {(r.packet, r.place) for r in got} and all(r.packet == r.id // 100 + 1 for r in got)


def test_index_search_recall(spark):
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(40, 16))
    v = (middle[rng.integers(0, 40, 3000)] + 0.4 * rng.normal(size=(3000, 16))).astype(np.float32)
    v[1000:2000] = v[1000]  # a third of all are copies
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id long, embedding array<float>")
    q = df.filter("vec_id % 20 = 0")
    exact = {}
    for r in retrieval.nearest(df, q, 10).collect():
        exact.setdefault(r.query_id, set()).add(r.vec_id)
    c = retrieval.centroids(df, 48)
    index = cut.materialize(retrieval.indexed(df, c), "index")
    assert index.count() == 3000  # every row is in the index
    got = {}
    probes = retrieval.probes_for(index, c, q, 10)
    assert probes <= 12  # data in clusters
    for r in retrieval.search(index, c, q, 10, probes=probes, group=400).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(got[k] & exact[k]) for k in exact) / sum(map(len, exact.values())) >= 0.9
    every = {}
    for r in retrieval.search(index, c, q, 10, probes=48, group=400).collect():
        every.setdefault(r.query_id, set()).add(r.vec_id)
    assert every == exact


@pytest.mark.parametrize("d", ["/root/testdata/sf0.01"])
def test_index_search_recall_on_the_tables(spark, d):
    if not os.path.isdir(d):
        pytest.skip("no test tables")
    e = spark.read.parquet(f"{d}/embeddings.parquet")
    q = e.filter("vec_id % 20 = 0")
    exact = {(r.query_id, r.vec_id) for r in retrieval.nearest(e, q, 5).collect()}
    c = retrieval.centroids(e, 32)
    index = cut.materialize(retrieval.indexed(e, c), "index")
    probes = retrieval.probes_for(index, c, q, 5)
    got = {(r.query_id, r.vec_id) for r in retrieval.search(index, c, q, 5, probes=probes).collect()}
    print("probes", probes, "recall", len(got & exact) / len(exact))
    assert len(got & exact) >= 0.9 * len(exact)


@pytest.mark.parametrize("agree", [1, 2, 3, 4])
def test_fingerprint_pairs_brute_force(spark, agree):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = [b ^ sum(1 << x for x in rng.sample(range(64), rng.randrange(10))) for b in base for _ in range(4)]
    sign = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(k, sign(p)) for k, p in enumerate(prints)], "id long, h long")
    first = {}
    for k, p in enumerate(prints):
        first.setdefault(p, k)
    want = {(min(a, b), max(a, b), (x ^ y).bit_count()) for x, a in first.items() for y, b in first.items() if a < b and (x ^ y).bit_count() <= 6}
    assert {tuple(r) for r in retrieval.fingerprint_pairs(df, "id", "h", 6, agree).collect()} == want and want


def test_fingerprint_pairs_in_a_small_plan(spark):
    """The keys of a fingerprint are rows of a pass and no expressions that the driver plans; a list longer than a block is whole."""
    rng = random.Random(6)
    df = spark.createDataFrame([(k, rng.getrandbits(12) << 3 | rng.getrandbits(3)) for k in range(1500)], "id long, h long")
    got = retrieval.fingerprint_pairs(df, "id", "h", 2, 4)
    assert len(got._jdf.queryExecution().optimizedPlan().toString()) < 2000
    first = {}
    for r in df.collect():
        first[r.h] = min(r.id, first.get(r.h, r.id))
    want = {(min(a, b), max(a, b), (x ^ y).bit_count()) for x, a in first.items() for y, b in first.items() if x < y and (x ^ y).bit_count() <= 2}
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    blocks = (pa.RecordBatch.from_pydict({"part": pa.array([0] * 7, pa.int32()), "bits": [0] * 7, "id": list(range(7 * k, 7 * k + 7)), "h": list(range(7 * k, 7 * k + 7))}) for k in range(5))
    near = {tuple(r.values()) for b in retrieval._near_in_lists(blocks, 1, held=10) for r in b.to_pylist()}
    assert near == {(x, y, 1) for x in range(35) for y in range(x + 1, 35) if (x ^ y).bit_count() == 1}


def test_text_simhash(spark):
    df = spark.createDataFrame([(1, "Alpha beta gamma"), (2, "gamma BETA, alpha alpha"), (3, None), (4, " -- "), (5, "alpha " * 50_000)], "id long, t string")
    got = {r.id: r.h for r in df.select("id", ids.text_simhash(F.col("t")).alias("h")).collect()}
    assert got[1] == got[2] and got[3] is None and got[4] is None and got[5] is not None


def test_diversified(spark):
    rows = [(1, "https://a.example/x?u=1", 9.0, 0), (1, "http://a.example/x", 8.0, 255), (1, "https://b.example/y", 7.0, 1), (1, "https://c.example/z", 6.0, (1 << 40) - 1), (1, None, 5.0, None), (2, "https://a.example/x", 1.0, 0)]
    df = spark.createDataFrame(rows, "q long, url string, s double, h long")
    got = [(r.q, r.s) for r in retrieval.diversified(df, "q", [F.desc("s")], "url", "h", 2).orderBy("q", F.desc("s")).collect()]
    assert got == [(1, 9.0), (1, 6.0), (2, 1.0)]  # same page, and one bit apart, are passed over
    assert retrieval.diversified(df.limit(0), "q", [F.desc("s")], "url", "h", 2).count() == 0


def test_guarded_sql_refuses_functions_and_files(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "secret"))
    spark.range(5).createOrReplaceTempView("numbers")
    for ok in ("SELECT count(*) AS n FROM numbers", "SELECT id, (SELECT max(id) FROM numbers) AS m FROM numbers WHERE id IN (SELECT id FROM numbers)", "WITH a AS (SELECT id FROM numbers) SELECT upper(cast(id AS string)) FROM a"):
        assert safe_sql.guarded(spark, ok).count() >= 1
    for bad in (
        "SELECT reflect('java.lang.System', 'getProperty', 'user.home')", f"SELECT * FROM parquet.`{tmp_path}/secret`", "SELECT * FROM range(10)", "SELECT id FROM numbers WHERE java_method('java.lang.System', 'nanoTime') > 0",
        "SELECT (SELECT reflect('a', 'b')) FROM numbers", "SELECT id FROM numbers WHERE EXISTS (SELECT * FROM csv.`/etc/passwd`)", "SELECT input_file_name() FROM numbers", "SELECT * FROM other",
    ):
        with pytest.raises(ValueError):
            safe_sql.guarded(spark, bad)
    with pytest.raises(ValueError):
        safe_sql.guarded(spark, "SELECT * FROM numbers", views=["other"])


def test_article_fields(spark):
    page = """<html><head><meta content='Desc &amp; more' name="Description"><title>Plain</title><meta content="Best title" property="og:title"><script>var p = "<p>no</p>"</script></head>
      <body><p>This paragraph stands outside the article and is long enough.</p><article><h2>A heading that is quite long, forty letters or more</h2><p>short</p><p>The first paragraph of the article has <b>enough</b> letters in it.</p>
      <ul><li>An item of a list that is also long enough to be kept here.</li></ul></article></body></html>"""
    assert html.article_fields(page) == ("Best title", "Desc & more", "A heading that is quite long, forty letters or more\nThe first paragraph of the article has enough letters in it.\nAn item of a list that is also long enough to be kept here.")
    assert html.article_fields("<h1>Only</h1>") == ("Only", None, None) and html.article_fields("plain text") == (None, None, None)
    many = "<p>" + "x" * 50 + "</p>"
    df = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, many * 500), (5, "<p" * 1000)], "id long, t string")
    got = {r.id: r.a for r in df.select("id", html.article(F.col("t")).alias("a")).collect()}
    assert got[1].title == "Best title" and got[2].text is None and got[3].title is None and got[4].text.count("\n") == 499  # whole pages


def test_rule_files(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"version": 1, "factors": [{"label": "a", "patterns": ["X"]}, {"label": "b"}]}))
    got = rules.load(spark, str(path), "factors")
    assert [r["label"] for r in got] == ["a", "b"] and [tuple(r) for r in rules.table(spark, got, "label string, patterns array<string>").collect()] == [("a", ["X"]), ("b", None)]
    with pytest.raises(ValueError):
        rules.load(spark, str(path), "assets")
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    ordered = [("x > 3", "high", 2), ("x > 0", "low", 1)]
    assert [tuple(r.m) for r in df.select(rules.first_match(ordered, ["name", "n"], ["string", "int"]).alias("m")).collect()] == [("low", 1), ("high", 2), (None, None)]
    assert [r.m for r in df.select(rules.all_matches([(c, n) for c, n, _ in ordered]).alias("m")).collect()] == [["low"], ["high", "low"], []]


def test_store(spark, tmp_path):
    root = str(tmp_path / "store")
    one = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id long, day string").withColumn("day", F.col("day").cast("date"))
    sinks.write_store({"a": one, "b": one}, root, {"a": "day", "b": "day"})
    sinks.write_store({"a": one.filter("id = 2").withColumn("id", F.lit(9).cast("long")), "b": one.limit(0)}, root, {"a": "day", "b": "day"})  # a day again
    assert sorted((r.table, str(r.dt), r.rows) for r in sinks.read_manifest(spark, root).collect()) == [(t, d, 1) for t in "ab" for d in ("2024-01-01", "2024-01-02")]
    assert sorted(r.id for r in readers.store_days(spark, root, "a").collect()) == [1, 9] and [r.id for r in readers.from_manifest(spark, root, "a", ["2024-01-02"]).collect()] == [9]
    sinks.clear_day(spark, root, ["a", "b"], "2024-01-01")
    assert sinks.read_manifest(spark, root).count() == 2 and sinks.read_manifest(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        readers.from_manifest(spark, root, "a", ["2024-01-01"])


def test_intermediate_tables(spark):
    t = cut.materialize(spark.range(3), "x")
    path = t._newsloom_path
    assert t.count() == 3 and cut.exists(spark, path)
    cut.release(t)
    assert not cut.exists(spark, path)


def test_no_local_folder_on_a_cluster():
    code = """
import types, newsloom.cut as cut
class Conf:
    def get(self, *_): return None
s = types.SimpleNamespace(conf=Conf(), sparkContext=types.SimpleNamespace(master="spark://host:7077", applicationId="a"))
try:
    cut.shared_dir(s)
except RuntimeError as e:
    print("refused", e)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT}, timeout=120)
    assert "refused" in out.stdout and "spark.checkpoint.dir" in out.stdout


def test_evidence_of_a_fixed_case(spark):
    """A direct document ranks above one that names only the factor, and one that names neither loses its points."""
    cues = evidence.rule_cues(spark.createDataFrame([("resources", "crude_supply"), ("resources", "gas_storage")], "asset string, factor string"))
    docs = spark.createDataFrame(
        [(1, "Crude supply falls", "The crude supply outage hits storage", "market_wrap", 0.9), (2, "Talks go on", "Supply of crude", None, None), (3, "Weather", None, "general_news", 0.1), (4, None, None, None, None)], "doc_id long, title string, summary string, source_type string, confidence double"
    ).withColumn("context", F.lit(None).cast("string")).withColumn("context_score", F.lit(2.0)).withColumn("event_time", F.lit(None).cast("timestamp")).withColumn("url", F.col("doc_id").cast("string"))
    e = evidence.strength(evidence.relevance(evidence.forms(docs).crossJoin(F.broadcast(cues.filter("factor = 'crude_supply'")))))
    got = {r.doc_id: r for r in e.collect()}
    # title: phrase, crude, supply (3) and asset words (2); text: 3 and 3; bonus 3; 2 * 0.9; title 1, summary 0.5
    assert got[1].relevance == 8 * 3 + 4 * 3 + 6 * 2 + 3 * 3 + 3 + 1.8 + 1.5 and got[1].mode == "direct" and got[1].grade == "strong"
    assert got[2].title_factor == 0 and got[2].mode == "direct" and got[3].relevance == 0.2 + 1.0 - 5.0 and got[4].relevance == -5.0 and got[4].grade == "weak"
    best = evidence.rerank(e.unionByName(e), ["asset", "factor"], 10).orderBy("rank").collect()
    assert [r.doc_id for r in best] == [1, 2]  # once each, and only positive ones where some are
