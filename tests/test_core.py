"""Core operators against plain versions on small fixtures."""

import os
import random

import pytest
from pyspark.sql import functions as F

from newsloom.functions import ids, text, vectors
from newsloom.operators import retrieval, safe_sql, sampling, tables
from newsloom.operators.components import components
from newsloom.plans import graph
from newsloom.sources import readers, sinks


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


def test_components(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(100, 160)] + [(rng.randrange(1, 60), rng.randrange(1, 60)) for _ in range(40)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_text_functions(spark):
    s = F.lit
    assert one(spark, text.match_form(s("Red-Sea  oil_price (up)!"))) == "RED SEA OIL PRICE UP"
    assert one(spark, text.cue_hits(text.match_form(s("war in software")), F.array(s("WAR"), s("SOFT")))) == 1
    assert one(spark, text.page_title(s("<PAGE_TITLE>Shock &amp; oil</PAGE_TITLE>"))) == "Shock & oil"
    assert one(spark, text.host(s("HTTPS://WWW.Site.example:443/a?b"))) == "site.example"
    assert one(spark, text.slug_title(s("https://x.example/a/oil-shock-12-rises.html?u=1"))) == "oil shock rises"
    assert one(spark, text.clip(s("one two three"), 9)) == "one two"
    assert one(spark, text.root_domain(s("www.News.site.co.uk:80"))) == "site.co.uk"
    assert one(spark, text.strip_tags(s("<p>a<script>x</script> b</p>"))) == "a b"
    assert one(spark, F.array_join(text.geo_labels(s("1#Y#YM#YM#1#2#3;4#E#EG#EG01#1#2#3")), ",")) == "EG,YM"
    assert one(spark, F.array_join(text.geo_labels(F.lit(None).cast("string")), ",")) == "GLOBAL"
    assert one(spark, text.tone(s("-4.5,1,2"))) == -4.5
    assert str(one(spark, text.event_time(s("20250102"), F.lit("2025-01-03").cast("date")))) == "2025-01-02 00:00:00"
    assert str(one(spark, text.event_time(s("bad"), F.lit("2025-01-03").cast("date")))) == "2025-01-03 00:00:00"


def test_context(spark):
    title, body = "A bank story that is certainly longer than forty letters.", "Court and port and bank meet here in a long enough sentence. Nothing to see in this other long sentence at all."
    t, score = text.context([F.lit(title), F.lit(body)], F.lit(""), ["BANK", "COURT", "PORT"])
    assert one(spark, t).startswith("Court and port") and one(spark, score) == 4.0
    t, score = text.context([F.lit("short")], F.lit(None).cast("string"), ["BANK"])
    assert one(spark, t) is None and one(spark, score) == 0.0


def test_simhash_and_pairs(spark):
    rows = [(1, ["a", "b", "c", "d"]), (2, ["a", "b", "c", "d"]), (3, ["q", "r", "s"])]
    df = spark.createDataFrame(rows, "id long, t array<string>").select("id", ids.simhash(F.col("t")).alias("h"))
    h = {r.id: r.h for r in df.collect()}
    assert h[1] == h[2] != h[3]
    near = spark.createDataFrame([(1, 0), (2, 0b111), (3, (1 << 40) - 1), (4, 0), (5, None)], "id long, h long")
    assert [(r.a, r.b, r.bits) for r in retrieval.fingerprint_pairs(near, "id", "h", 6).collect()] == [(1, 2, 3)]


def test_members_of_fingerprint_classes(spark):
    near = spark.createDataFrame([(1, 0), (2, 0b111), (3, (1 << 40) - 1), (4, 0), (4, 0), (5, None), (6, 0b111)], "id long, h long")
    got = retrieval.fingerprint_classes(near, "id", "h").collect()
    assert sorted((r.id, r.class_id) for r in got) == [(1, 1), (2, 2), (3, 3), (4, 1), (6, 2)]


def test_every_copy_is_in_the_pairs(spark):
    from newsloom.catalog.retrieval import fingerprints
    from newsloom.queries import queries

    d = "/root/testdata/sf0.001"
    if os.path.isdir(d):
        by = {}
        for r in fingerprints(spark, d).distinct().collect():
            by.setdefault(r.fingerprint, []).append(r.doc_id)
        want = {(min(x), i, 0) for x in by.values() for i in x if i != min(x)}
        got = [tuple(r) for r in queries()["tx25_fingerprint_pairs"](spark, d).select("a", "b", "bits").collect()]
        assert {x for x in got if x[2] == 0} == want and want and len(got) == len(set(got))
        assert {r.doc_id for r in queries()["tx25_fingerprint_classes"](spark, d).collect()} == {i for x in by.values() for i in x}


def test_nearest(spark):
    rng = random.Random(1)
    rows = [(k, [rng.gauss(0, 1) for _ in range(8)]) for k in range(60)] + [(99, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = retrieval.nearest(df, df.filter("vec_id % 20 = 0"), 3).collect()

    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) ** 0.5 * sum(x * x for x in b) ** 0.5)

    for q in (0, 20, 40):
        want = sorted(((-cos(rows[q][1], v), i) for i, v in rows if v and i != q))[:3]
        assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == [i for _, i in want]
    with pytest.raises(Exception, match="shorter"):
        df.filter("vec_id < 3").select(vectors.truncate(F.col("embedding"), 9)).collect()


def test_nearest_ties_and_sets(spark):
    ids = list(range(1, 61))
    random.Random(4).shuffle(ids)
    rows = [(i, [1.0, 0.0]) for i in ids] + [(100 + i, [0.0, 1.0]) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    for most in (100_000, 2):
        got = retrieval.nearest(df, df.filter("vec_id in (30, 1, 2, 50, 60)"), 3, most=most).collect()
        for q in (30, 1, 2, 50, 60):
            assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == [i for i in range(1, 6) if i != q][:3]
        assert len(got) == 15


def test_days_append_and_catalog(spark, tmp_path):
    df = spark.createDataFrame([(1, "2025-01-01"), (2, "2025-01-02")], "k long, d string")
    sinks.write_days(df, str(tmp_path / "days"), "d")
    sinks.write_days(df.filter("k = 2").withColumn("k", F.lit(7).cast("long")), str(tmp_path / "days"), "d")
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "days")).collect()) == [1, 7]
    sinks.append_new(spark, df.union(df), str(tmp_path / "app"), "k")
    sinks.append_new(spark, df.union(spark.createDataFrame([(3, "x")], df.schema)), str(tmp_path / "app"), "k")
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "app")).collect()) == [1, 2, 3]
    first = readers.new_files(spark, str(tmp_path / "days"))
    assert first.count() > 0 and readers.new_files(spark, str(tmp_path / "days"), first).count() == 0


def test_line_formats(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": 1}\nnot json\n')
    rows = readers.json_lines(spark, str(tmp_path / "a.jsonl"), "k long").collect()
    assert sorted((r.k, r._corrupt) for r in rows if r.k) == [(1, None)] and any(r._corrupt == "not json" for r in rows)
    (tmp_path / "a.xml").write_text("<r><i><t>one</t></i><i><t>two</t></i></r>")
    assert sorted(r.t for r in readers.xml_rows(spark, str(tmp_path / "a.xml"), "i", "t string").collect()) == ["one", "two"]
    (tmp_path / "a.txt").write_text("__label__keep some text\nplain\n")
    assert [tuple(r) for r in readers.labelled_lines(spark, str(tmp_path / "a.txt")).collect()] == [("keep", "some text")]
    with pytest.raises(Exception, match="exactly one day"):
        readers.single_day(spark.createDataFrame([("2025-01-01",), ("2025-01-02",)], "d string"), "d").collect()


def test_links_need_the_day_before(spark):
    p = spark.createDataFrame([("2025-01-01", "oil", 2, 1.0), ("2025-01-02", "oil", 5, 3.0), ("2025-01-04", "oil", 1, 1.0)], "bucket_time string, f string, doc_count int, narrative_score double").withColumn("bucket_time", F.col("bucket_time").cast("date"))
    assert [(str(r.bucket_time), r.doc_count_delta) for r in graph.links(p, ["f"]).collect()] == [("2025-01-02", 3)]


def test_graph_from_candidates(spark):
    raw = spark.createDataFrame(
        [("20250102124500", "2025-01-02", "ft.com", "https://e.example/red-sea-oil", "Red Sea oil", "SHIPPING,30;OIL,30", "-4.0,0", "1#Yemen#YM#YM#1#2#0;1#Egypt#EG#EG#1#2#1")] * 2 + [("20250102", "2025-01-02", None, "https://r.example/fed", None, "INTEREST_RATE,5", None, None)],
        "record_datetime string, partition_date string, source_common_name string, document_identifier string, title string, v2_themes string, v2_tone string, v2_locations string",
    )
    docs = graph.documents(raw)
    assert docs.count() == 2
    m = graph.match_factors(docs, [("oil", "OIL"), ("shipping", "SHIPPING"), ("rates", "INTEREST_RATE")])
    assert sorted(r.factor_label for r in m.collect()) == ["oil", "rates", "shipping"]
    got = sorted((r.factor_label, r.geo_label, round(r.classification_confidence, 2)) for r in graph.mentions(docs, m).collect())
    assert got == [("oil", "EG", 0.71), ("oil", "YM", 0.71), ("rates", "GLOBAL", 0.63), ("shipping", "EG", 0.71), ("shipping", "YM", 0.71)]


def test_guarded_sql(spark):
    spark.range(500).createOrReplaceTempView("numbers")
    assert safe_sql.guarded(spark, "WITH a AS (SELECT id FROM numbers) SELECT * FROM a WHERE id > 3").count() == 200
    for bad in ("DROP VIEW numbers", "INSERT INTO numbers VALUES (1)", "SELECT 1; SELECT 2", "SET x = 1", "CREATE TABLE t AS SELECT 1", "nonsense"):
        with pytest.raises(ValueError):
            safe_sql.guarded(spark, bad)


def test_small_tables(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, None)], "k long, v string"), spark.createDataFrame([(2, "y"), (3, "z")], "k long, v string")
    assert sorted(map(tuple, tables.upsert(a, b, "k").collect())) == [(1, "x", "keep"), (2, "y", "update"), (3, "z", "insert")]
    assert sorted(r.k for r in tables.unseen(a, b, ["k"]).collect()) == [1]
    m = tables.scores(spark.createDataFrame([("a", "a", 3), ("a", "b", 1), ("b", "b", 2)], "truth string, predicted string, n long"))
    assert {r.label: (r.support, round(r.precision, 3), round(r.recall, 3)) for r in m.collect()} == {"a": (4, 1.0, 0.75), "b": (2, 0.667, 1.0)}


def test_capped_sample(spark):
    rows = [("keep", "big.example", k) for k in range(50)] + [("keep", f"s{k}.example", 100 + k) for k in range(4)]
    got = sampling.capped_sample(spark.createDataFrame(rows, "label string, domain string, k long"), "label", "domain", "k", 10).collect()
    assert len(got) == 10 and sum(r.domain == "big.example" for r in got) == 6 and len({r.k for r in got}) == 10


def test_range_overlap(spark):
    rng = random.Random(3)
    span = lambda n, most: [(k, a, a + rng.randrange(most)) for k in range(n) for a in [rng.randrange(-500, 5000)]]
    index, wanted = span(60, 400), span(90, 900) + [(500, -9000, 9000), (501, 9000, 9001), (502, 7, 6)]
    i, w = spark.createDataFrame(index, "chunk long, lo long, hi long"), spark.createDataFrame(wanted, "part long, lo long, hi long")
    want = sorted((p, c) for p, a, b in wanted if a <= b for c, x, y in index if x <= b and a <= y)
    for bins in (1, 7, 4096):
        assert sorted((r.part, r.chunk) for r in tables.overlapping(i, w, bins).collect()) == want
    assert tables.overlapping(i.limit(0), w).count() == 0


def test_range_index_covers_every_id(spark):
    from newsloom.queries import queries

    d = "/root/testdata/sf0.001"
    if os.path.isdir(d):
        got = queries()["jn16_range_index"](spark, d).agg(F.sum("lines"), F.max("part")).first()
        lines = spark.read.parquet(f"{d}/lineitem.parquet")
        assert got[0] == lines.count() and got[1] == spark.read.parquet(f"{d}/orders.parquet").agg(F.max("o_orderkey")).first()[0] // 1000


def test_whole_bodies(spark, tmp_path):
    from newsloom.queries import queries

    cols = ("title", "summary_text", "body_text", "all_names", "v2_organizations", "v2_persons", "v2_themes", "v2_locations")
    row = (1, "t", None, "b" * 9000 + "end", *[None] * 5)
    spark.createDataFrame([row], "doc_id long, " + ", ".join(f"{c} string" for c in cols)).write.parquet(f"{tmp_path}/bronze_candidates.parquet")
    got = queries()["prj06_whole_text"](spark, str(tmp_path)).first().joined
    assert "b" * 9000 + "end" in got


def test_upsert_of_whole_tables(spark):
    from newsloom.queries import queries

    d = "/root/testdata/sf0.001"
    if os.path.isdir(d):
        keys = {r[0] for r in queries()["jn25_upsert_tables"](spark, d).select("c_custkey").collect()}
        assert keys == {r[0] for t, k in (("customer", "c_custkey"), ("supplier", "s_suppkey")) for r in spark.read.parquet(f"{d}/{t}.parquet").select(k).collect()}
