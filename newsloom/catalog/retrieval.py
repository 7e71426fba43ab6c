"""Text, vector and retrieval operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.catalog import query, read
from newsloom.catalog.relations import SILVER, UP
from newsloom.cut import materialize
from newsloom.functions import ids, text, vectors
from newsloom.operators import retrieval, safe_sql, sampling
from newsloom.plans import graph

S = SparkSession
PUNCT = "!\"#$%&''()*+,-./:;<=>?@[\\]^_`{{|}}~"
FORM = "trim(regexp_replace(translate(" + UP.format("coalesce({0}, '')") + ", '" + PUNCT + "', '" + " " * 32 + "'), '\\s+', ' ', 'g'))"
SENTENCES = "list_filter(list_transform(string_split_regex(regexp_replace(regexp_replace(coalesce({0},''), '\\s+\\|\\|\\s+', chr(10), 'g'), '([.!?])\\s+', '\\1' || chr(10), 'g'), '\\n+'), lambda x : trim(x)), lambda x : length(x) >= 40)"
TERMS = ["BANK", "COURT", "PORT", "PRICES", "INDEX"]


@query("tx01_match_form", f"SELECT doc_id, {FORM.format('title')} AS form FROM graph_doc_nodes_daily")
def tx01(spark: S, d: str) -> DataFrame:
    return read(spark, d, "graph_doc_nodes_daily").select("doc_id", text.match_form(F.col("title")).alias("form"))


@query("tx02_cue_hits", f"SELECT doc_id, " + " + ".join(f"CAST(contains(' ' || {FORM.format('title')} || ' ', ' {c} ') AS INTEGER)" for c in ("BANK OF", "PORT", "NOTES FROM", "UNDER NEW FOCUS")) + " AS hits FROM graph_doc_nodes_daily")
def tx02(spark: S, d: str) -> DataFrame:
    cues = F.array(*map(F.lit, ("BANK OF", "PORT", "NOTES FROM", "UNDER NEW FOCUS")))
    n = read(spark, d, "graph_doc_nodes_daily").select("doc_id", text.match_form(F.col("title")).alias("form"))
    return n.select("doc_id", text.cue_hits(F.col("form"), cues).alias("hits"))


@query("tx03_matched_cues", "SELECT doc_id, array_to_string(list_filter(['BANK OF', 'PORT', 'NOTES FROM'], lambda c : contains(' ' || form || ' ', ' ' || c || ' ')), ',') AS cues FROM (SELECT doc_id, " + FORM.format("title") + " AS form FROM graph_doc_nodes_daily)")
def tx03(spark: S, d: str) -> DataFrame:
    cues = F.array(*map(F.lit, ("BANK OF", "PORT", "NOTES FROM")))
    n = read(spark, d, "graph_doc_nodes_daily").select("doc_id", text.match_form(F.col("title")).alias("form"))
    return n.select("doc_id", F.array_join(text.matched_cues(F.col("form"), cues), ",").alias("cues"))


@query("tx05_factor_classification", f"SELECT f.factor_group, count(DISTINCT b.doc_id) AS docs FROM bronze_candidates b JOIN factor_dictionary f ON contains({UP.format('coalesce(b.v2_themes, chr(32))')}, upper(f.factor_label)) GROUP BY 1")
def tx05(spark: S, d: str) -> DataFrame:
    docs = read(spark, d, "bronze_candidates").select("doc_id", text.ascii_upper(F.coalesce("v2_themes", F.lit(" "))).alias("match_text")).distinct()
    rules = [(r[1], r[0].upper()) for r in read(spark, d, "factor_dictionary").select("factor_label", "factor_group").collect()]  # 40 rows, fixed
    return graph.match_factors(docs, rules, "doc_id").groupBy(F.col("factor_label").alias("factor_group")).agg(F.count_distinct("doc_id").alias("docs"))


@query("tx06_sentences", f"SELECT doc_id, len(s) AS n, array_to_string(s, chr(10)) AS sentences FROM (SELECT doc_id, {SENTENCES.format('summary_text')} AS s FROM bronze_candidates)")
def tx06(spark: S, d: str) -> DataFrame:
    s = text.sentences(F.col("summary_text"))
    return read(spark, d, "bronze_candidates").select("doc_id", F.size(s).cast("long").alias("n"), F.array_join(s, "\n").alias("sentences"))


_OWN = " || ".join(SENTENCES.format(c) for c in ("title", "summary_text", "body_text"))
_BEST = "list_slice(list_reverse_sort(list_filter(list_transform(list_distinct(CASE WHEN len(own) > 0 THEN own ELSE rest END), lambda x : struct_pack(hits := " + " + ".join(f"CAST(contains({UP.format('x')}, '{t}') AS INTEGER)" for t in TERMS) + ", size := length(x), t := x)), lambda q : q.hits > 0)), 1, 5)"


@query("tx07_context", f"SELECT doc_id, CASE WHEN len(best) > 0 THEN array_to_string(list_transform(best, lambda q : q.t), ' || ') END AS context, CAST(coalesce(list_sum(list_transform(best, lambda q : q.hits)), 0) AS DOUBLE) AS score FROM (SELECT doc_id, {_BEST} AS best FROM (SELECT doc_id, {_OWN} AS own, {SENTENCES.format('relevant_text')} AS rest FROM bronze_candidates))")
def tx07(spark: S, d: str) -> DataFrame:
    b = read(spark, d, "bronze_candidates")
    t, score = text.context([F.col("title"), F.col("summary_text"), F.col("body_text")], F.col("relevant_text"), TERMS)
    return b.select("doc_id", F.struct(t.alias("context"), score.alias("score")).alias("c")).select("doc_id", "c.*")


@query("tx08_relevance", f"SELECT m.doc_id, m.factor_label, CASE WHEN contains(' ' || form || ' ', ' ' || upper(replace(m.factor_label, '_', ' ')) || ' ') THEN 1.0 ELSE 0.0 END AS relevance FROM (SELECT DISTINCT doc_id, factor_label FROM silver_factor_mentions WHERE factor_label IS NOT NULL) m JOIN (SELECT DISTINCT doc_id, {FORM.format('title')} AS form FROM graph_doc_nodes_daily) n USING (doc_id)")
def tx08(spark: S, d: str) -> DataFrame:
    m = read(spark, d, SILVER).filter("factor_label is not null").select("doc_id", "factor_label").distinct()
    n = read(spark, d, "graph_doc_nodes_daily").select("doc_id", text.match_form(F.col("title")).alias("form")).distinct()
    hit = text.cue_hits(F.col("form"), F.array(F.upper(F.replace("factor_label", F.lit("_"), F.lit(" ")))))
    return m.join(n, "doc_id").select("doc_id", "factor_label", hit.cast("double").alias("relevance"))


@query("tx15_embedding_text", "SELECT doc_id, concat_ws(chr(10), 'title: ' || nullif(trim(title),''), 'summary: ' || nullif(trim(summary_text),''), 'source: ' || source_domain) AS packed FROM bronze_candidates")
def tx15(spark: S, d: str) -> DataFrame:
    part = lambda name, c: F.concat(F.lit(f"{name}: "), c)
    return read(spark, d, "bronze_candidates").select("doc_id", F.concat_ws("\n", part("title", F.nullif(F.trim("title"), F.lit(""))), part("summary", F.nullif(F.trim("summary_text"), F.lit(""))), part("source", F.col("source_domain"))).alias("packed"))


@query("tx16_lexical_text", "SELECT doc_id, lower(concat_ws(' ', title, summary_text, market_context_text)) AS lexical FROM bronze_candidates")
def tx16(spark: S, d: str) -> DataFrame:
    return read(spark, d, "bronze_candidates").select("doc_id", F.lower(F.concat_ws(" ", "title", "summary_text", "market_context_text")).alias("lexical"))


@query("tx19_truncate", "SELECT vec_id, round(list_sum(list_transform(CAST(embedding[1:16] AS DOUBLE[]), lambda x : x * x)), 6) AS energy FROM embeddings")
def tx19(spark: S, d: str) -> DataFrame:
    e = read(spark, d, "embeddings").select("vec_id", vectors.truncate(F.col("embedding"), 16).alias("v"))
    return e.select("vec_id", F.round(vectors.dot(F.col("v"), F.col("v")), 6).alias("energy"))


@query("tx20_nearest", """WITH q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS a FROM embeddings WHERE vec_id % 20 = 0), s AS (SELECT query_id, e.vec_id, list_cosine_similarity(a, CAST(e.embedding AS DOUBLE[])) AS c FROM q JOIN embeddings e ON e.vec_id <> query_id)
  SELECT query_id, vec_id, round(c, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, vec_id) AS rank FROM s) WHERE rank <= 5""")
def tx20(spark: S, d: str) -> DataFrame:
    e = read(spark, d, "embeddings")
    return retrieval.nearest(e, e.filter("vec_id % 20 = 0"), 5).select("query_id", "vec_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query("tx20_indexed_search")
def tx20_indexed(spark: S, d: str) -> DataFrame:
    """The same queries over an index of cells, of which as many are probed as a recall of 0.95 needs; recall is measured in the tests."""
    e = read(spark, d, "embeddings")
    c = retrieval.centroids(e, 32)
    index, asked = materialize(retrieval.indexed(e, c), "index"), e.filter("vec_id % 20 = 0")
    return retrieval.search(index, c, asked, 5, probes=retrieval.probes_for(index, c, asked, 5))


@query("tx21_lexical_score", "SELECT doc_id, round(0.8 * (CAST(contains(' ' || t || ' ', ' notes ') AS INTEGER) + CAST(contains(' ' || t || ' ', ' from ') AS INTEGER)) / 2 + 0.2 * CAST(contains(lower(title), 'notes from') AS INTEGER), 6) AS score FROM (SELECT doc_id, title, regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g') AS t FROM graph_doc_nodes_daily WHERE title IS NOT NULL)")
def tx21(spark: S, d: str) -> DataFrame:
    n = read(spark, d, "graph_doc_nodes_daily").filter("title is not null")
    tokens = F.split(F.regexp_replace(F.lower("title"), "[^a-z0-9]+", " "), " ")
    return n.select("doc_id", F.round(retrieval.lexical(["notes", "from"], tokens, F.col("title")), 6).alias("score"))


@query("tx23_fused_score", """WITH x AS (SELECT doc_id, coalesce(market_context_score, 0) AS dense, CAST(contains(lower(coalesce(title,'')), 'bank') AS DOUBLE) AS lex, coalesce(source_priority, 0) / 5 AS meta FROM graph_doc_nodes_daily), b AS (SELECT min(dense) AS lo, max(dense) AS hi FROM x)
  SELECT doc_id, round(0.55 * CASE WHEN hi = lo THEN 1.0 ELSE (dense - lo) / (hi - lo) END + 0.25 * lex + 0.20 * meta, 6) AS score FROM x, b""")
def tx23(spark: S, d: str) -> DataFrame:
    n = read(spark, d, "graph_doc_nodes_daily").select("doc_id", F.coalesce("market_context_score", F.lit(0.0)).alias("dense"), F.contains(F.lower(F.coalesce("title", F.lit(""))), F.lit("bank")).cast("double").alias("lex"), (F.coalesce("source_priority", F.lit(0)) / 5).alias("meta"))
    return retrieval.scaled(n, "dense").select("doc_id", F.round(retrieval.fused(F.col("dense_scaled"), F.col("lex"), F.col("meta")), 6).alias("score"))


def fingerprints(spark: S, d: str) -> DataFrame:
    docs = read(spark, d, "documents").filter("trim(text) <> ''")
    return docs.select("doc_id", ids.text_simhash(F.col("text")).alias("fingerprint")).filter("fingerprint is not null")


@query("tx24_simhash")
def tx24(spark: S, d: str) -> DataFrame:
    return fingerprints(spark, d)


@query("tx25_fingerprint_pairs")
def tx25(spark: S, d: str) -> DataFrame:
    """Pairs of different fingerprints at most six bits apart over class representatives, and with 0 bits every other member of a class with its representative."""
    got = materialize(fingerprints(spark, d), "fingerprints")
    pairs = retrieval.fingerprint_pairs(got, "doc_id", "fingerprint", 6)
    member = retrieval.fingerprint_classes(got, "doc_id", "fingerprint").filter("doc_id <> class_id")
    return pairs.unionByName(member.select(F.col("class_id").alias("a"), F.col("doc_id").alias("b"), F.lit(0).cast(pairs.schema["bits"].dataType).alias("bits")))


@query("tx25_fingerprint_classes")
def tx25_classes(spark: S, d: str) -> DataFrame:
    """Every document that has words with its class of equal fingerprints."""
    return retrieval.fingerprint_classes(fingerprints(spark, d), "doc_id", "fingerprint")


@query("tx25_diversified")
def tx25_diversified(spark: S, d: str) -> DataFrame:
    """For every day the ten best documents that are no near copies of a better one."""
    n = read(spark, d, "graph_doc_nodes_daily").select("doc_id", "partition_date", "document_identifier", "title", "market_context_score").distinct()
    n = n.withColumn("h", ids.text_simhash(F.col("title")))
    got = retrieval.diversified(n, "partition_date", [F.desc_nulls_last("market_context_score"), F.asc("doc_id")], "document_identifier", "h", 10)
    return got.select("partition_date", "doc_id", "place")


@query("tx32_phased_search", "SELECT doc_id, min(phase) AS phase FROM (SELECT doc_id, 1 AS phase FROM graph_doc_nodes_daily WHERE market_context_score >= 8 UNION ALL SELECT doc_id, 2 FROM graph_doc_nodes_daily WHERE market_context_score >= 4 UNION ALL SELECT doc_id, 3 FROM graph_doc_nodes_daily WHERE market_context_score >= 1) GROUP BY 1")
def tx32(spark: S, d: str) -> DataFrame:
    s = F.col("market_context_score")
    phase = F.when(s >= 8, 1).when(s >= 4, 2).when(s >= 1, 3)  # one pass: the first phase that reaches a record
    return read(spark, d, "graph_doc_nodes_daily").groupBy("doc_id").agg(F.min(phase).alias("phase")).filter("phase is not null")


@query("ex15_intraday", "SELECT hour, factor_label, n FROM (SELECT hour, factor_label, n, row_number() OVER (PARTITION BY hour ORDER BY n DESC, factor_label) AS r FROM (SELECT date_trunc('hour', event_time) AS hour, factor_label, count(*) AS n FROM silver_factor_mentions WHERE bucket_time = DATE '2022-01-04' AND factor_label IS NOT NULL GROUP BY 1, 2)) WHERE r <= 3")
def ex15(spark: S, d: str) -> DataFrame:
    m = read(spark, d, SILVER).filter("bucket_time = date'2022-01-04' and factor_label is not null")
    h = m.groupBy(F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("hour"), "factor_label").agg(F.count(F.lit(1)).alias("n"))
    return graph.top_per_group(h, ["hour"], [F.desc("n"), F.asc("factor_label")], 3).drop("rank")


@query("ex18_guarded_sql", "SELECT factor_group, count(*) AS n FROM factor_dictionary GROUP BY 1")
def ex18(spark: S, d: str) -> DataFrame:
    read(spark, d, "factor_dictionary").createOrReplaceTempView("factor_dictionary")
    return safe_sql.guarded(spark, "SELECT factor_group, count(*) AS n FROM factor_dictionary GROUP BY factor_group")


@query("wn10_quota_pick", """WITH a AS (SELECT DISTINCT doc_id, market_context_score AS s, tone FROM graph_doc_nodes_daily), x AS (SELECT doc_id, 'strong' AS stratum FROM (SELECT doc_id FROM a WHERE s >= 8 ORDER BY doc_id LIMIT 100)), y AS (SELECT doc_id, 'negative' AS stratum FROM (SELECT doc_id FROM a WHERE tone <= -4 AND doc_id NOT IN (SELECT doc_id FROM x) ORDER BY doc_id LIMIT 100))
  SELECT * FROM x UNION ALL SELECT * FROM y""")
def wn10(spark: S, d: str) -> DataFrame:
    n = read(spark, d, "graph_doc_nodes_daily").select("doc_id", "market_context_score", "tone")
    return sampling.quota_pick(n, "doc_id", [("strong", "market_context_score >= 8", 100), ("negative", "tone <= -4", 100)], "doc_id").select("doc_id", "stratum")


@query("wn11_capped_sample", """WITH n AS (SELECT DISTINCT source_type, source_domain, doc_id FROM graph_doc_nodes_daily WHERE source_type IS NOT NULL AND source_domain IS NOT NULL), a AS (SELECT *, row_number() OVER (PARTITION BY source_type, source_domain ORDER BY doc_id) AS k FROM n),
  s AS (SELECT *, CASE WHEN k <= 3 THEN 0 WHEN k <= 6 THEN 1 ELSE 2 END AS step FROM a WHERE k <= 12) SELECT * FROM (SELECT source_type, source_domain, doc_id, step, row_number() OVER (PARTITION BY source_type ORDER BY step, doc_id) AS pick FROM s) WHERE pick <= 200""")
def wn11(spark: S, d: str) -> DataFrame:
    n = read(spark, d, "graph_doc_nodes_daily").filter("source_type is not null and source_domain is not null").select("source_type", "source_domain", "doc_id").distinct()
    return sampling.capped_sample(n, "source_type", "source_domain", "doc_id", 200)


@query("cl01_term_hits", f"SELECT doc_id, " + " + ".join(f"CAST(contains({UP.format('coalesce(text, chr(32))')}, '{t}') AS INTEGER)" for t in TERMS) + " AS hits FROM documents")
def cl01(spark: S, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", text.term_hits(F.col("text"), TERMS).alias("hits"))


@query("cl02_cluster_score", f"SELECT doc_id, round(least(1.0, 0.12 * (" + " + ".join(f"CAST(contains({UP.format('coalesce(text, chr(32))')}, '{t}') AS INTEGER)" for t in TERMS) + ")), 6) AS score FROM documents")
def cl02(spark: S, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", F.round(F.least(F.lit(1.0), F.lit(0.12) * text.term_hits(F.col("text"), TERMS)), 6).alias("score"))
