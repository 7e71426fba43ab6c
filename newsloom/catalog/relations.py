"""Joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.catalog import query, read
from newsloom.functions import text
from newsloom.operators import ranks, tables
from newsloom.plans import graph
from newsloom.sources import readers

S = SparkSession
SILVER, NODES, BRONZE = "silver_factor_mentions", "graph_doc_nodes_daily", "bronze_candidates"
UP = "translate({}, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"
ROLLUP = """SELECT bucket_time, factor_label, geo_label, CAST(count(DISTINCT doc_id) AS INTEGER) AS doc_count, CAST(count(*) AS INTEGER) AS mention_count, CAST(count(DISTINCT source_id) AS INTEGER) AS unique_sources,
  avg(tone) AS tone_mean, avg(abs(coalesce(tone, 0.0))) AS avg_abs_tone, avg(novelty) AS novelty_mean, CAST(count(DISTINCT CASE WHEN tone <= -5 THEN doc_id END) AS INTEGER) AS negative_tail_count,
  CAST(count(DISTINCT CASE WHEN tone >= 5 THEN doc_id END) AS INTEGER) AS positive_tail_count, avg(classification_confidence) AS confidence_mean, min(event_time) AS first_seen, max(event_time) AS last_seen,
  count(DISTINCT source_id) / nullif(count(DISTINCT doc_id), 0) AS source_dispersion FROM silver_factor_mentions GROUP BY 1, 2, 3"""
SCORED = f"SELECT *, doc_count * (0.5 + coalesce(source_dispersion, 0.0)) * (1.0 + coalesce(avg_abs_tone, 0.0) / 5.0) AS narrative_score FROM ({ROLLUP})"
PAIR = """SELECT m.bucket_time, m.factor_label, f.factor_group AS asset_label, m.geo_label, CAST(count(DISTINCT doc_id) AS INTEGER) AS doc_count, CAST(count(*) AS INTEGER) AS mention_count, CAST(count(DISTINCT source_id) AS INTEGER) AS unique_sources,
  avg(tone) AS tone_mean, avg(abs(coalesce(tone, 0.0))) AS avg_abs_tone, avg(2.0 + CASE WHEN m.tone < 0 THEN 1 ELSE 0 END) AS relevance_mean, count(DISTINCT source_id) / nullif(count(DISTINCT doc_id), 0) AS source_dispersion
  FROM silver_factor_mentions m JOIN factor_dictionary f ON f.factor_label = m.factor_label GROUP BY 1, 2, 3, 4"""
PAIR_SCORED = f"SELECT *, doc_count * (0.5 + coalesce(source_dispersion, 0.0)) * (1.0 + coalesce(avg_abs_tone, 0.0) / 5.0) * (0.5 + coalesce(relevance_mean, 0.0) / 8.0) AS narrative_score FROM ({PAIR})"


def panel(spark: S, d: str) -> DataFrame:
    return graph.rollup(read(spark, d, SILVER), ["bucket_time", "factor_label", "geo_label"]).withColumn("narrative_score", graph.factor_score())


def pair_mentions(spark: S, d: str) -> DataFrame:
    dim = F.broadcast(read(spark, d, "factor_dictionary").select("factor_label", F.col("factor_group").alias("asset_label")))  # 40 rows, fixed
    relevance = F.lit(2.0) + F.when(F.col("tone") < 0, 1).otherwise(0)
    return read(spark, d, SILVER).join(dim, "factor_label").withColumn("asset_factor_relevance", relevance)


def pair_panel(spark: S, d: str) -> DataFrame:
    m = pair_mentions(spark, d)
    p = graph.rollup(m, ["bucket_time", "factor_label", "asset_label", "geo_label"], extra=[F.avg("asset_factor_relevance").alias("relevance_mean")])
    return p.withColumn("narrative_score", graph.pair_score())


def stored_panel(spark: S, d: str) -> DataFrame:
    """The factor panel as reports read it: built once a session, then a stored table."""
    return readers.kept(panel(spark, d), d, "panel")


def stored_pair_panel(spark: S, d: str) -> DataFrame:
    return readers.kept(pair_panel(spark, d), d, "pair panel")


def rounded(df: DataFrame, *names: str, digits: int = 8) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# --- joins -------------------------------------------------------------------------------------------


@query("jn01_pattern_join", f"""SELECT b.doc_id, f.factor_label, count(*) AS n FROM bronze_candidates b JOIN factor_dictionary f ON contains({UP.format("concat_ws(' | ', b.v2_themes, b.all_names, b.v2_organizations, b.title, b.summary_text)")}, upper(f.factor_label)) GROUP BY 1, 2""")
def jn01(spark: S, d: str) -> DataFrame:
    b = read(spark, d, BRONZE)
    docs = b.select("doc_id", text.ascii_upper(F.concat_ws(" | ", "v2_themes", "all_names", "v2_organizations", "title", "summary_text")).alias("match_text"))
    # the rules are the configuration: 40 rows, fixed
    rules = [(r[0], r[0].upper()) for r in read(spark, d, "factor_dictionary").select("factor_label").collect()]
    return graph.match_factors(docs, rules, "doc_id").groupBy("doc_id", "factor_label").agg(F.count(F.lit(1)).alias("n"))


@query("jn02_hint_join", "SELECT DISTINCT m.doc_id, f.factor_group AS asset_label FROM silver_factor_mentions m JOIN factor_dictionary f ON f.factor_label = m.factor_label WHERE f.factor_group NOT IN ('macro')")
def jn02(spark: S, d: str) -> DataFrame:
    required = spark.createDataFrame([("macro",)], "asset_label string")
    return pair_mentions(spark, d).join(F.broadcast(required), "asset_label", "left_anti").select("doc_id", "asset_label").distinct()


@query("jn03_gated_pattern_join", f"""SELECT DISTINCT m.doc_id, f.factor_group AS asset_label FROM silver_factor_mentions m JOIN factor_dictionary f ON f.factor_label = m.factor_label JOIN graph_doc_nodes_daily n ON n.doc_id = m.doc_id WHERE contains({UP.format("coalesce(n.title,'')")}, {UP.format("f.factor_group")})""")
def jn03(spark: S, d: str) -> DataFrame:
    titles = read(spark, d, NODES).select("doc_id", text.ascii_upper(F.coalesce("title", F.lit(""))).alias("t"))
    m = pair_mentions(spark, d).select("doc_id", "asset_label").distinct()
    return m.join(titles, "doc_id").filter(F.contains("t", text.ascii_upper(F.col("asset_label")))).select("doc_id", "asset_label").distinct()


@query("jn04_anti_join_insert", "SELECT DISTINCT b.doc_id FROM bronze_candidates b LEFT JOIN graph_doc_nodes_daily n ON n.doc_id = b.doc_id WHERE n.doc_id IS NULL")
def jn04(spark: S, d: str) -> DataFrame:
    return tables.unseen(read(spark, d, BRONZE).select("doc_id").distinct(), read(spark, d, NODES), ["doc_id"])


@query("jn05_semi_join", "SELECT doc_id, title FROM graph_doc_nodes_daily WHERE doc_id IN (SELECT doc_id FROM silver_factor_mentions WHERE tone <= -5)")
def jn05(spark: S, d: str) -> DataFrame:
    return read(spark, d, NODES).join(read(spark, d, SILVER).filter("tone <= -5").select("doc_id"), "doc_id", "left_semi").select("doc_id", "title")


@query("jn06_not_in", "SELECT DISTINCT factor_label FROM factor_dictionary WHERE factor_label NOT IN (SELECT factor_label FROM silver_factor_mentions WHERE bucket_time = DATE '2022-01-03' AND factor_label IS NOT NULL)")
def jn06(spark: S, d: str) -> DataFrame:
    return tables.unseen(read(spark, d, "factor_dictionary").select("factor_label").distinct(), read(spark, d, SILVER).filter("bucket_time = date'2022-01-03' and factor_label is not null"), ["factor_label"])


@query("jn07_hash_exclusion", "SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')")
def jn07(spark: S, d: str) -> DataFrame:
    return read(spark, d, "orders").select("o_orderkey").join(read(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query("jn08_dictionary_lookups", "SELECT n_name, r_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def jn08(spark: S, d: str) -> DataFrame:
    nation, region = read(spark, d, "nation"), read(spark, d, "region")
    per = read(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))  # reduced before it meets the dictionaries
    j = per.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("n_name", "r_name").agg(F.sum("customers").alias("customers"))


@query("jn09_not_exists_keys", "SELECT DISTINCT a.doc_id, a.factor_id, a.geo_id FROM silver_factor_mentions a WHERE NOT EXISTS (SELECT 1 FROM silver_factor_mentions b WHERE b.bucket_time = DATE '2022-01-03' AND b.doc_id = a.doc_id AND b.factor_id = a.factor_id AND b.geo_id = a.geo_id)")
def jn09(spark: S, d: str) -> DataFrame:
    m = read(spark, d, SILVER)
    keys = ["doc_id", "factor_id", "geo_id"]
    return tables.unseen(m.select(*keys).distinct(), m.filter("bucket_time = date'2022-01-03'"), keys)


@query("jn10_unnest", "SELECT geo, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, unnest(CAST(json(geo_labels_json) AS VARCHAR[])) AS geo FROM graph_doc_nodes_daily) GROUP BY 1")
def jn10(spark: S, d: str) -> DataFrame:
    e = read(spark, d, NODES).select("doc_id", F.explode(F.from_json("geo_labels_json", "array<string>")).alias("geo"))
    return e.groupBy("geo").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("docs"))


@query("jn11_day_lag_links", f"""WITH g AS ({SCORED}) SELECT p.bucket_time AS prior_bucket_time, c.bucket_time, c.factor_label, c.geo_label, p.doc_count AS prior_doc_count, c.doc_count, round(p.narrative_score, 8) AS prior_score, round(c.narrative_score, 8) AS narrative_score,
  c.doc_count - p.doc_count AS doc_count_delta, round(c.narrative_score - p.narrative_score, 8) AS score_delta FROM g c JOIN g p ON p.factor_label = c.factor_label AND p.geo_label = c.geo_label AND p.bucket_time = c.bucket_time - 1""")
def jn11(spark: S, d: str) -> DataFrame:
    return rounded(graph.links(panel(spark, d).select("bucket_time", "factor_label", "geo_label", "doc_count", "narrative_score"), ["factor_label", "geo_label"]), "prior_score", "narrative_score", "score_delta")


@query("jn12_day_lag_pair_links", f"""WITH g AS ({PAIR_SCORED}) SELECT p.bucket_time AS prior_bucket_time, c.bucket_time, c.factor_label, c.asset_label, c.geo_label, p.doc_count AS prior_doc_count, c.doc_count, round(p.narrative_score, 8) AS prior_score, round(c.narrative_score, 8) AS narrative_score,
  c.doc_count - p.doc_count AS doc_count_delta, round(c.narrative_score - p.narrative_score, 8) AS score_delta FROM g c JOIN g p ON p.factor_label = c.factor_label AND p.asset_label = c.asset_label AND p.geo_label = c.geo_label AND p.bucket_time = c.bucket_time - 1""")
def jn12(spark: S, d: str) -> DataFrame:
    p = pair_panel(spark, d).select("bucket_time", "factor_label", "asset_label", "geo_label", "doc_count", "narrative_score")
    return rounded(graph.links(p, ["factor_label", "asset_label", "geo_label"]), "prior_score", "narrative_score", "score_delta")


@query("jn13_mention_evidence", "SELECT m.doc_id, m.factor_label, n.title, n.market_context_score FROM silver_factor_mentions m JOIN graph_doc_nodes_daily n ON n.doc_id = m.doc_id WHERE m.bucket_time = DATE '2022-01-04'")
def jn13(spark: S, d: str) -> DataFrame:
    m = read(spark, d, SILVER).filter("bucket_time = date'2022-01-04'").select("doc_id", "factor_label")
    return m.join(read(spark, d, NODES).select("doc_id", "title", "market_context_score"), "doc_id")


@query("jn14_two_aggregates", "SELECT a.factor_label, a.docs, b.geos FROM (SELECT factor_label, count(DISTINCT doc_id) AS docs FROM silver_factor_mentions GROUP BY 1) a JOIN (SELECT factor_label, count(DISTINCT geo_label) AS geos FROM silver_factor_mentions GROUP BY 1) b USING (factor_label)")
def jn14(spark: S, d: str) -> DataFrame:
    m = read(spark, d, SILVER).filter("factor_label is not null")
    return m.groupBy("factor_label").agg(F.count_distinct("doc_id").alias("docs"), F.count_distinct("geo_label").alias("geos"))  # same key: one shuffle serves both


@query("jn15_deferred_payload", "WITH s AS (SELECT DISTINCT doc_id, market_context_score FROM graph_doc_nodes_daily WHERE market_context_score IS NOT NULL ORDER BY market_context_score DESC, doc_id LIMIT 100) SELECT s.doc_id, s.market_context_score, b.summary_text FROM s LEFT JOIN (SELECT DISTINCT doc_id, summary_text FROM bronze_candidates) b USING (doc_id)")
def jn15(spark: S, d: str) -> DataFrame:
    short = read(spark, d, NODES).select("doc_id", "market_context_score").distinct().filter("market_context_score is not null").orderBy(F.desc("market_context_score"), "doc_id").limit(100)
    # a top-100 report: the short list travels to the heavy columns, not the other way round
    heavy = read(spark, d, BRONZE).select("doc_id", "summary_text").join(F.broadcast(short.select("doc_id")), "doc_id", "left_semi").distinct()
    return short.join(heavy, "doc_id", "left")


@query("jn16_range_overlap", "SELECT a.o_orderkey // 1000 AS part, count(*) AS lines FROM orders a JOIN lineitem l ON l.l_orderkey = a.o_orderkey WHERE a.o_orderkey BETWEEN 500 AND 9000 GROUP BY 1")
def jn16(spark: S, d: str) -> DataFrame:
    o = read(spark, d, "orders").filter("o_orderkey between 500 and 9000").select("o_orderkey")
    lines = read(spark, d, "lineitem").filter("l_orderkey between 500 and 9000").select("l_orderkey")  # the range prunes row groups on both sides
    return o.join(lines, o.o_orderkey == lines.l_orderkey).groupBy(F.floor(F.col("o_orderkey") / 1000).cast("long").alias("part")).agg(F.count(F.lit(1)).alias("lines"))


@query("jn16_range_index", """WITH c AS (SELECT l_orderkey // 1536 AS chunk, min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem GROUP BY 1), r AS (SELECT o_orderkey // 1000 AS part, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders GROUP BY 1)
  SELECT part, count(DISTINCT chunk) AS chunks, count(l_orderkey) AS lines FROM r JOIN c ON c.lo <= r.hi AND r.lo <= c.hi LEFT JOIN lineitem ON l_orderkey // 1536 = chunk AND l_orderkey BETWEEN r.lo AND r.hi GROUP BY 1""")
def jn16_index(spark: S, d: str) -> DataFrame:
    """Every range of order ids with the chunks of lines whose ids overlap it and the lines in them."""
    lines = read(spark, d, "lineitem").select("l_orderkey", F.floor(F.col("l_orderkey") / 1536).alias("chunk"))
    ranges = tables.range_index(read(spark, d, "orders"), F.floor(F.col("o_orderkey") / 1000).cast("long"), "o_orderkey").withColumnRenamed("chunk", "part")
    met = tables.overlapping(tables.range_index(lines, F.col("chunk"), "l_orderkey"), ranges)
    per = lines.groupBy("chunk", "l_orderkey").agg(F.count(F.lit(1)).alias("n"))  # reduced before it meets the ranges
    per = met.join(per, "chunk", "left").groupBy("part", "chunk").agg(F.coalesce(F.sum(F.when(F.col("l_orderkey").between(F.col("lo"), F.col("hi")), F.col("n"))), F.lit(0)).alias("lines"))
    return per.groupBy("part").agg(F.count(F.lit(1)).alias("chunks"), F.sum("lines").alias("lines"))


@query("jn18_shared_factors", "WITH f AS (SELECT DISTINCT geo_label, factor_label FROM silver_factor_mentions WHERE factor_label IS NOT NULL) SELECT a.geo_label AS left_geo, b.geo_label AS right_geo, count(*) AS shared FROM f a JOIN f b ON a.factor_label = b.factor_label AND a.geo_label < b.geo_label GROUP BY 1, 2")
def jn18(spark: S, d: str) -> DataFrame:
    sets = read(spark, d, SILVER).filter("factor_label is not null").groupBy("geo_label").agg(F.collect_set("factor_label").alias("f"))  # at most one entry per factor
    a, b = sets.select(F.col("geo_label").alias("left_geo"), F.explode("f").alias("x")), sets.select(F.col("geo_label").alias("right_geo"), F.explode("f").alias("x"))
    return a.join(b, "x").filter("left_geo < right_geo").groupBy("left_geo", "right_geo").agg(F.count(F.lit(1)).alias("shared"))


@query("jn19_coalesced_left_joins", "SELECT n.doc_id, coalesce(n.title, b.title) AS title, coalesce(b.summary_text, n.market_context_text) AS summary FROM (SELECT DISTINCT doc_id, title, market_context_text FROM graph_doc_nodes_daily) n LEFT JOIN (SELECT DISTINCT doc_id, title, summary_text FROM bronze_candidates) b ON b.doc_id = n.doc_id")
def jn19(spark: S, d: str) -> DataFrame:
    n = read(spark, d, NODES).select("doc_id", "title", "market_context_text").distinct()
    b = read(spark, d, BRONZE).select("doc_id", F.col("title").alias("t"), "summary_text").distinct()
    return n.join(b, "doc_id", "left").select("doc_id", F.coalesce("title", "t").alias("title"), F.coalesce("summary_text", "market_context_text").alias("summary"))


@query("jn20_hit_counts", f"SELECT doc_id, CAST(contains(x,'BANK') AS INTEGER) + CAST(contains(x,'COURT') AS INTEGER) + CAST(contains(x,'PORT') AS INTEGER) AS hits FROM (SELECT doc_id, {UP.format('coalesce(relevant_text, chr(32))')} AS x FROM bronze_candidates)")
def jn20(spark: S, d: str) -> DataFrame:
    return read(spark, d, BRONZE).select("doc_id", text.term_hits(F.col("relevant_text"), ["BANK", "COURT", "PORT"]).alias("hits"))


@query("jn21_multiplier_lookup", "SELECT m.factor_label, count(*) AS n, round(coalesce(max(w.weight), 1.0), 4) AS weight FROM silver_factor_mentions m LEFT JOIN (VALUES ('court_ruling', 1.5), ('rate_path', 0.8)) w(factor_label, weight) ON w.factor_label = m.factor_label GROUP BY 1")
def jn21(spark: S, d: str) -> DataFrame:
    w = spark.createDataFrame([("court_ruling", 1.5), ("rate_path", 0.8)], "factor_label string, weight double")
    per = read(spark, d, SILVER).groupBy("factor_label").agg(F.count(F.lit(1)).alias("n"))
    return per.join(F.broadcast(w), "factor_label", "left").fillna(1.0, ["weight"])  # two rows


@query("jn22_fallback_lookup", """WITH q AS (SELECT source_domain, max(source_priority) AS prio FROM graph_doc_nodes_daily WHERE source_domain IS NOT NULL GROUP BY 1)
  SELECT b.source_domain, count(*) AS n, max(coalesce(q.prio, r.prio, 0)) AS prio FROM bronze_candidates b LEFT JOIN q ON q.source_domain = b.source_domain LEFT JOIN q r ON r.source_domain = lower(trim(b.source_domain)) GROUP BY 1""")
def jn22(spark: S, d: str) -> DataFrame:
    q = read(spark, d, NODES).filter("source_domain is not null").groupBy("source_domain").agg(F.max("source_priority").alias("prio"))
    b = read(spark, d, BRONZE).groupBy("source_domain").agg(F.count(F.lit(1)).alias("n"))
    return tables.lookup(b, q.withColumnRenamed("source_domain", "dom"), [(F.col("source_domain"), "dom"), (F.lower(F.trim("source_domain")), "dom")], "prio", F.lit(0))


@query("jn23_override", "SELECT c.c_custkey, coalesce(CASE WHEN s.s_suppkey IS NOT NULL THEN s.s_name END, c.c_name) AS c_name FROM customer c LEFT JOIN supplier s ON s.s_suppkey = c.c_custkey")
def jn23(spark: S, d: str) -> DataFrame:
    over = read(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"))
    return tables.override(read(spark, d, "customer").select("c_custkey", "c_name"), over, "c_custkey", ["c_name"])


@query("jn25_upsert", "SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, coalesce(n.c_acctbal, o.c_acctbal) AS c_acctbal, CASE WHEN o.c_custkey IS NULL THEN 'insert' WHEN n.c_custkey IS NULL THEN 'keep' ELSE 'update' END AS change FROM (SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 3 <> 0) o FULL JOIN (SELECT c_custkey, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_custkey % 2 = 0) n ON n.c_custkey = o.c_custkey")
def jn25(spark: S, d: str) -> DataFrame:
    c = read(spark, d, "customer").select("c_custkey", "c_acctbal")
    return tables.upsert(c.filter("c_custkey % 3 <> 0"), c.filter("c_custkey % 2 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1), "c_custkey")


@query("jn25_upsert_tables", "SELECT coalesce(c_custkey, s_suppkey) AS c_custkey, coalesce(s_acctbal, c_acctbal) AS c_acctbal, CASE WHEN c_custkey IS NULL THEN 'insert' WHEN s_suppkey IS NULL THEN 'keep' ELSE 'update' END AS change FROM customer FULL JOIN supplier ON s_suppkey = c_custkey")
def jn25_tables(spark: S, d: str) -> DataFrame:
    """Whole tables by key: no customer and no supplier is left out."""
    new = read(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"))
    return tables.upsert(read(spark, d, "customer").select("c_custkey", "c_acctbal"), new, "c_custkey")


@query("jn26_exclude_labelled", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM subject_labels)")
def jn26(spark: S, d: str) -> DataFrame:
    return tables.unseen(read(spark, d, "documents").select("doc_id"), read(spark, d, "subject_labels"), ["doc_id"])


@query("jn27_rows_with_vectors", "SELECT l.doc_id, l.subject, e.label FROM subject_labels l JOIN embeddings e ON e.vec_id = l.doc_id")
def jn27(spark: S, d: str) -> DataFrame:
    e = read(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "label")
    return read(spark, d, "subject_labels").join(e, "doc_id").select("doc_id", "subject", "label")


@query("jn28_coverage_status", "SELECT status, count(*) AS n FROM (SELECT e.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 'labelled' WHEN d.text IS NOT NULL THEN 'corpus' ELSE 'missing' END AS status FROM (SELECT DISTINCT doc_id FROM documents UNION SELECT vec_id FROM embeddings) e LEFT JOIN (SELECT DISTINCT doc_id FROM subject_labels) l ON l.doc_id = e.doc_id LEFT JOIN documents d ON d.doc_id = e.doc_id) GROUP BY 1")
def jn28(spark: S, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    every = docs.select("doc_id").union(read(spark, d, "embeddings").select("vec_id")).distinct()
    lab = read(spark, d, "subject_labels").select("doc_id").distinct().withColumn("lab", F.lit(True))
    j = every.join(lab, "doc_id", "left").join(docs.select("doc_id", F.col("text").isNotNull().alias("has")), "doc_id", "left")
    return j.groupBy(F.when(F.col("lab"), "labelled").when(F.col("has"), "corpus").otherwise("missing").alias("status")).agg(F.count(F.lit(1)).alias("n"))


# --- aggregates --------------------------------------------------------------------------------------

R = "bucket_time, factor_label, geo_label, doc_count, mention_count, unique_sources, round(tone_mean, 8) AS tone_mean, round(avg_abs_tone, 8) AS avg_abs_tone, round(novelty_mean, 8) AS novelty_mean, negative_tail_count, positive_tail_count, round(confidence_mean, 8) AS confidence_mean, first_seen, last_seen, round(source_dispersion, 8) AS source_dispersion"


@query("ag01_factor_rollup", f"SELECT {R} FROM ({ROLLUP})")
def ag01(spark: S, d: str) -> DataFrame:
    p = graph.rollup(read(spark, d, SILVER), ["bucket_time", "factor_label", "geo_label"])
    return rounded(p, "tone_mean", "avg_abs_tone", "novelty_mean", "confidence_mean", "source_dispersion")


@query("ag02_pair_panel", f"SELECT bucket_time, factor_label, asset_label, geo_label, doc_count, mention_count, unique_sources, round(tone_mean, 8) AS tone_mean, round(relevance_mean, 8) AS relevance_mean, round(narrative_score, 8) AS narrative_score FROM ({PAIR_SCORED})")
def ag02(spark: S, d: str) -> DataFrame:
    p = pair_panel(spark, d).select("bucket_time", "factor_label", "asset_label", "geo_label", "doc_count", "mention_count", "unique_sources", "tone_mean", "relevance_mean", "narrative_score")
    return rounded(p, "tone_mean", "relevance_mean", "narrative_score")


@query("ag03_exact_distinct", "SELECT geo_label, count(DISTINCT doc_id) AS docs, count(DISTINCT source_id) AS sources, count(DISTINCT factor_label) AS factors FROM silver_factor_mentions GROUP BY 1")
def ag03(spark: S, d: str) -> DataFrame:
    return read(spark, d, SILVER).groupBy("geo_label").agg(F.count_distinct("doc_id").alias("docs"), F.count_distinct("source_id").alias("sources"), F.count_distinct("factor_label").alias("factors"))


@query("ag04_conditional_distinct", "SELECT factor_label, count(DISTINCT CASE WHEN tone <= -5 THEN doc_id END) AS low, count(DISTINCT CASE WHEN tone >= 5 THEN doc_id END) AS high FROM silver_factor_mentions GROUP BY 1")
def ag04(spark: S, d: str) -> DataFrame:
    t = lambda c: F.count_distinct(F.when(c, F.col("doc_id")))
    return read(spark, d, SILVER).groupBy("factor_label").agg(t(F.col("tone") <= -5).alias("low"), t(F.col("tone") >= 5).alias("high"))


@query("ag05_ratio", "SELECT factor_label, round(count(DISTINCT source_id) / nullif(count(DISTINCT doc_id), 0), 8) AS ratio FROM silver_factor_mentions GROUP BY 1")
def ag05(spark: S, d: str) -> DataFrame:
    return read(spark, d, SILVER).groupBy("factor_label").agg(F.round(F.count_distinct("source_id") / F.nullif(F.count_distinct("doc_id"), F.lit(0)), 8).alias("ratio"))


@query("ag06_max_then_sum", "SELECT factor_label, round(sum(w), 6) AS mass FROM (SELECT factor_label, source_id, max(source_weight) AS w FROM silver_factor_mentions GROUP BY 1, 2) GROUP BY 1")
def ag06(spark: S, d: str) -> DataFrame:
    inner = read(spark, d, SILVER).groupBy("factor_label", "source_id").agg(F.max("source_weight").alias("w"))
    return inner.groupBy("factor_label").agg(F.round(F.sum("w"), 6).alias("mass"))


@query("ag07_ordered_list", "SELECT r_name, string_agg(n_name, ',' ORDER BY n_nationkey) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def ag07(spark: S, d: str) -> DataFrame:
    n = read(spark, d, "nation").join(F.broadcast(read(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))  # 5 rows, fixed
    return n.groupBy("r_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda s: s["n_name"]), ",").alias("nations"))


@query("ag08_sorted_set", "SELECT doc_id, string_agg(DISTINCT factor_label, ',' ORDER BY factor_label) AS factors FROM silver_factor_mentions GROUP BY 1")
def ag08(spark: S, d: str) -> DataFrame:
    return read(spark, d, SILVER).groupBy("doc_id").agg(F.nullif(F.array_join(F.array_sort(F.collect_set("factor_label")), ","), F.lit("")).alias("factors"))


@query("ag09_top_factors", f"SELECT factor_label, CAST(sum(doc_count) AS BIGINT) AS docs, round(sum(narrative_score), 6) AS score FROM ({SCORED}) GROUP BY 1 ORDER BY score DESC, factor_label LIMIT 25")
def ag09(spark: S, d: str) -> DataFrame:
    g = stored_panel(spark, d).groupBy("factor_label").agg(F.sum("doc_count").alias("docs"), F.round(F.sum("narrative_score"), 6).alias("score"))
    return g.orderBy(F.desc("score"), "factor_label").limit(25)


@query("ag10_top_assets", f"SELECT asset_label, CAST(sum(doc_count) AS BIGINT) AS docs, round(sum(narrative_score), 6) AS score FROM ({PAIR_SCORED}) GROUP BY 1 ORDER BY score DESC, asset_label LIMIT 25")
def ag10(spark: S, d: str) -> DataFrame:
    g = stored_pair_panel(spark, d).groupBy("asset_label").agg(F.sum("doc_count").alias("docs"), F.round(F.sum("narrative_score"), 6).alias("score"))
    return g.orderBy(F.desc("score"), "asset_label").limit(25)


NARR = """SELECT asset_label, factor_label, count(*) AS n, count(DISTINCT source_id) AS sources, round(count(*) * (0.5 + count(DISTINCT source_id) / count(*)) * (0.5 + avg(rel) / 8) * (1 + avg(abs(tone)) / 5), 6) AS score
  FROM (SELECT DISTINCT m.doc_id, f.factor_group AS asset_label, m.factor_label, m.source_id, m.bucket_time, m.tone, 2.0 + CASE WHEN m.tone < 0 THEN 1 ELSE 0 END AS rel FROM silver_factor_mentions m JOIN factor_dictionary f ON f.factor_label = m.factor_label) GROUP BY 1, 2"""


def narratives(spark: S, d: str) -> DataFrame:
    m = pair_mentions(spark, d).select("doc_id", "asset_label", "factor_label", "source_id", "bucket_time", "tone", F.col("asset_factor_relevance").alias("rel")).distinct()
    n, s = F.count(F.lit(1)), F.count_distinct("source_id")
    return m.groupBy("asset_label", "factor_label").agg(n.alias("n"), s.alias("sources"), F.round(n * (0.5 + s / n) * (0.5 + F.avg("rel") / 8) * (1 + F.avg(F.abs("tone")) / 5), 6).alias("score"))


@query("ag11_asset_narratives", f"SELECT * FROM ({NARR}) WHERE asset_label = 'macro' ORDER BY score DESC NULLS LAST, factor_label LIMIT 20")
def ag11(spark: S, d: str) -> DataFrame:
    return narratives(spark, d).filter("asset_label = 'macro'").orderBy(F.desc_nulls_last("score"), "factor_label").limit(20)


@query("ag12_asset_narratives_bulk", f"SELECT * FROM ({NARR})")
def ag12(spark: S, d: str) -> DataFrame:
    return narratives(spark, d)


@query("ag13_asset_timeline", "SELECT asset_label, bucket_time, factor_label, count(*) AS n, round(count(*) * (0.5 + count(DISTINCT source_id) / count(*)) * (1 + avg(abs(coalesce(tone, 0))) / 5), 6) AS score FROM (SELECT DISTINCT m.doc_id, f.factor_group AS asset_label, m.factor_label, m.source_id, m.bucket_time, m.tone FROM silver_factor_mentions m JOIN factor_dictionary f ON f.factor_label = m.factor_label) GROUP BY 1, 2, 3")
def ag13(spark: S, d: str) -> DataFrame:
    m = pair_mentions(spark, d).select("doc_id", "asset_label", "factor_label", "source_id", "bucket_time", "tone").distinct()
    n, s = F.count(F.lit(1)), F.count_distinct("source_id")
    return m.groupBy("asset_label", "bucket_time", "factor_label").agg(n.alias("n"), F.round(n * (0.5 + s / n) * (1 + F.avg(F.abs(F.coalesce("tone", F.lit(0.0)))) / 5), 6).alias("score"))


@query("ag14_store_summary", "SELECT 'bronze' AS layer, count(*) AS n, count(DISTINCT doc_id) AS docs, min(partition_date) AS first_day, max(partition_date) AS last_day FROM bronze_candidates UNION ALL SELECT 'nodes', count(*), count(DISTINCT doc_id), min(partition_date), max(partition_date) FROM graph_doc_nodes_daily UNION ALL SELECT 'silver', count(*), count(DISTINCT doc_id), min(bucket_time), max(bucket_time) FROM silver_factor_mentions")
def ag14(spark: S, d: str) -> DataFrame:
    def one(layer: str, name: str, day: str) -> DataFrame:
        return read(spark, d, name).agg(F.lit(layer).alias("layer"), F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("docs"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))

    return one("bronze", BRONZE, "partition_date").unionByName(one("nodes", NODES, "partition_date")).unionByName(one("silver", SILVER, "bucket_time"))


TYPES = ["click", "view", "purchase"]


@query("ag15_pivot", "SELECT CAST(ts AS DATE) AS day, round(sum(CASE WHEN event_type = 'click' THEN value ELSE 0 END), 6) AS click, round(sum(CASE WHEN event_type = 'view' THEN value ELSE 0 END), 6) AS view, round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END), 6) AS purchase FROM events GROUP BY 1")
def ag15(spark: S, d: str) -> DataFrame:
    w = read(spark, d, "events").groupBy(F.to_date("ts").alias("day")).pivot("event_type", TYPES).agg(F.round(F.sum("value"), 6))
    return w.fillna(0.0, TYPES)


@query("ag16_hourly_counts", "SELECT date_trunc('hour', event_time) AS hour, count(*) AS mentions FROM silver_factor_mentions GROUP BY 1")
def ag16(spark: S, d: str) -> DataFrame:
    return graph.hourly(read(spark, d, SILVER))


@query("ag17_hourly_factor_stats", "SELECT date_trunc('hour', event_time) AS hour, factor_label, count(*) AS n, round(avg(tone), 8) AS tone_mean FROM silver_factor_mentions GROUP BY 1, 2")
def ag17(spark: S, d: str) -> DataFrame:
    return read(spark, d, SILVER).groupBy(F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("hour"), "factor_label").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("tone"), 8).alias("tone_mean"))


@query("ag18_source_inventory", "SELECT source_domain, min(source_priority) AS low, max(source_priority) AS high, count(*) AS n, count(DISTINCT partition_date) AS days FROM graph_doc_nodes_daily GROUP BY 1")
def ag18(spark: S, d: str) -> DataFrame:
    return read(spark, d, NODES).groupBy("source_domain").agg(F.min("source_priority").alias("low"), F.max("source_priority").alias("high"), F.count(F.lit(1)).alias("n"), F.count_distinct("partition_date").alias("days"))


@query("ag19_label_counters", "SELECT d.source, count(*) FILTER (l.subject = 'markets') AS markets, count(*) FILTER (l.subject = 'law') AS law, count(*) AS n FROM subject_labels l JOIN documents d ON d.doc_id = l.doc_id GROUP BY 1")
def ag19(spark: S, d: str) -> DataFrame:
    j = read(spark, d, "subject_labels").join(read(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return j.groupBy("source").agg(F.count_if(F.col("subject") == "markets").alias("markets"), F.count_if(F.col("subject") == "law").alias("law"), F.count(F.lit(1)).alias("n"))


RATERS = "SELECT a.subject AS truth, b.subject AS predicted, count(*) AS n FROM subject_labels a JOIN subject_labels b ON a.doc_id = b.doc_id AND a.rater < b.rater WHERE a.subject IS NOT NULL AND b.subject IS NOT NULL GROUP BY 1, 2"
PRF = f"""SELECT label, support, CASE WHEN called > 0 THEN hit / called ELSE 0.0 END AS precision, CASE WHEN support > 0 THEN hit / support ELSE 0.0 END AS recall,
  CASE WHEN hit > 0 THEN 2.0 * (hit / called) * (hit / support) / (hit / called + hit / support) ELSE 0.0 END AS f1 FROM (SELECT coalesce(t.label, p.label) AS label, CAST(coalesce(support, 0) AS BIGINT) AS support, coalesce(hit, 0) AS hit, coalesce(called, 0) AS called
  FROM (SELECT truth AS label, sum(n) AS support, sum(CASE WHEN truth = predicted THEN n ELSE 0 END) AS hit FROM ({RATERS}) GROUP BY 1) t FULL JOIN (SELECT predicted AS label, sum(n) AS called FROM ({RATERS}) GROUP BY 1) p ON p.label = t.label)"""


def raters(spark: S, d: str) -> DataFrame:
    lab = read(spark, d, "subject_labels")
    a, b = lab.select("doc_id", F.col("subject").alias("one"), F.col("rater").alias("ra")), lab.select("doc_id", F.col("subject").alias("two"), F.col("rater").alias("rb"))
    return tables.confusion(a.join(b, "doc_id").filter("ra < rb"), "one", "two")


@query("ag20_confusion", RATERS)
def ag20(spark: S, d: str) -> DataFrame:
    return raters(spark, d)


@query("ag21_precision_recall", f"SELECT label, support, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1 FROM ({PRF})")
def ag21(spark: S, d: str) -> DataFrame:
    return rounded(tables.scores(raters(spark, d)), "precision", "recall", "f1")


@query("ag22_averages", f"SELECT round(avg(f1), 8) AS macro_f1, round(sum(f1 * support) / sum(support), 8) AS weighted_f1, round(sum(recall * support) / sum(support), 8) AS accuracy FROM ({PRF})")
def ag22(spark: S, d: str) -> DataFrame:
    return rounded(tables.averages(tables.scores(raters(spark, d))), "macro_f1", "weighted_f1", "accuracy")


@query("ag23_rate_by_cutoff", "SELECT c.cutoff, count(*) FILTER (classification_confidence >= c.cutoff) AS n, round(avg(CASE WHEN classification_confidence >= c.cutoff THEN CASE WHEN tone < 0 THEN 1.0 ELSE 0.0 END END), 8) AS rate FROM silver_factor_mentions, (VALUES (0.55), (0.7), (0.85), (0.9)) c(cutoff) GROUP BY 1")
def ag23(spark: S, d: str) -> DataFrame:
    # four fixed cutoffs inside one pass instead of a join
    cells = F.array(*[F.struct(F.lit(c).alias("cutoff"), (F.col("classification_confidence") >= c).alias("on")) for c in (0.55, 0.7, 0.85, 0.9)])
    e = read(spark, d, SILVER).select(F.explode(cells).alias("c"), F.when(F.col("tone") < 0, 1.0).otherwise(0.0).alias("neg"))
    return e.groupBy(F.col("c.cutoff").cast("decimal(3,2)").alias("cutoff")).agg(F.count_if("c.on").alias("n"), F.round(F.avg(F.when(F.col("c.on"), F.col("neg"))), 8).alias("rate"))


@query("ag24_band_quality", "SELECT CASE WHEN market_context_score >= 6 THEN 'high' WHEN market_context_score >= 2 THEN 'mid' ELSE 'low' END AS band, count(*) AS n, round(avg(tone), 8) AS tone_mean FROM graph_doc_nodes_daily WHERE market_context_score IS NOT NULL GROUP BY 1")
def ag24(spark: S, d: str) -> DataFrame:
    band = F.when(F.col("market_context_score") >= 6, "high").when(F.col("market_context_score") >= 2, "mid").otherwise("low")
    return read(spark, d, NODES).filter("market_context_score is not null").groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("tone"), 8).alias("tone_mean"))


@query("ag25_cluster_metrics", "SELECT lang, count(*) AS n, round(avg(CASE WHEN n_chars > 1000 THEN 1.0 ELSE 0.0 END), 8) AS long_rate, count(*) - count(DISTINCT text) AS repeats, round(avg(n_chars), 6) AS size FROM documents GROUP BY 1")
def ag25(spark: S, d: str) -> DataFrame:
    long = F.avg(F.when(F.col("n_chars") > 1000, 1.0).otherwise(0.0))
    return read(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.round(long, 8).alias("long_rate"), (F.count(F.lit(1)) - F.count_distinct("text")).alias("repeats"), F.round(F.avg("n_chars"), 6).alias("size"))


@query("ag26_dominant_label", "SELECT source, lang, n, round(n / total, 8) AS share FROM (SELECT source, lang, count(*) AS n, sum(count(*)) OVER (PARTITION BY source) AS total, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, lang NULLS LAST) AS r FROM documents WHERE lang IS NOT NULL GROUP BY 1, 2) WHERE r = 1")
def ag26(spark: S, d: str) -> DataFrame:
    c = read(spark, d, "documents").filter("lang is not null").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("source"))
    return tables.keep_first(c.withColumn("share", F.round(F.col("n") / total, 8)), ["source"], [F.desc("n"), F.asc("lang")])


@query("ag27_group_quantile", "SELECT factor_label, round(quantile_cont(source_weight, 0.2), 8) AS q20, round(median(source_weight), 8) AS q50 FROM silver_factor_mentions GROUP BY 1")
def ag27(spark: S, d: str) -> DataFrame:
    return rounded(ranks.quantiles(read(spark, d, SILVER), "factor_label", "source_weight", [0.2, 0.5], ["q20", "q50"]), "q20", "q50")


@query("ag28_any_in_family", "SELECT source_domain, bool_or(market_context_score >= 8) AS strong, bool_and(coalesce(tone, 0) < 0) AS all_negative FROM graph_doc_nodes_daily GROUP BY 1")
def ag28(spark: S, d: str) -> DataFrame:
    return read(spark, d, NODES).groupBy("source_domain").agg(F.bool_or(F.col("market_context_score") >= 8).alias("strong"), F.bool_and(F.coalesce("tone", F.lit(0.0)) < 0).alias("all_negative"))


@query("ag29_disagreement", "SELECT subject, n, wrong, round(wrong / n * log2(n + 1), 8) AS weight FROM (SELECT a.subject, count(*) AS n, count(*) FILTER (a.subject <> b.subject) AS wrong FROM subject_labels a JOIN subject_labels b ON a.doc_id = b.doc_id AND a.rater < b.rater GROUP BY 1)")
def ag29(spark: S, d: str) -> DataFrame:
    lab = read(spark, d, "subject_labels")
    a, b = lab.select("doc_id", "subject", F.col("rater").alias("ra")), lab.select("doc_id", F.col("subject").alias("other"), F.col("rater").alias("rb"))
    g = a.join(b, "doc_id").filter("ra < rb").groupBy("subject").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("subject") != F.col("other")).alias("wrong"))
    return g.withColumn("weight", F.round(F.col("wrong") / F.col("n") * F.log2(F.col("n") + 1), 8))


@query("ag30_errors", "SELECT round(avg(abs(tone - market_context_score)), 8) AS mae, round(sqrt(avg(pow(tone - market_context_score, 2))), 8) AS rmse FROM graph_doc_nodes_daily")
def ag30(spark: S, d: str) -> DataFrame:
    gap = F.col("tone") - F.col("market_context_score")
    return read(spark, d, NODES).agg(F.round(F.avg(F.abs(gap)), 8).alias("mae"), F.round(F.sqrt(F.avg(gap * gap)), 8).alias("rmse"))


@query("ag31_signal_sums", "SELECT user_id, round(sum(CASE event_type WHEN 'purchase' THEN 3 WHEN 'click' THEN 1 ELSE -1 END * value), 6) AS signal, count(*) AS n FROM events GROUP BY 1")
def ag31(spark: S, d: str) -> DataFrame:
    w = F.when(F.col("event_type") == "purchase", 3).when(F.col("event_type") == "click", 1).otherwise(-1)
    return read(spark, d, "events").groupBy("user_id").agg(F.round(F.sum(w * F.col("value")), 6).alias("signal"), F.count(F.lit(1)).alias("n"))


@query("ag33_day_ranking", "SELECT bucket_time, factor_label, round(sum(source_weight), 6) AS mass, count(DISTINCT source_domain) AS sources, count(DISTINCT doc_id) AS docs FROM silver_factor_mentions GROUP BY 1, 2")
def ag33(spark: S, d: str) -> DataFrame:
    return read(spark, d, SILVER).groupBy("bucket_time", "factor_label").agg(F.round(F.sum("source_weight"), 6).alias("mass"), F.count_distinct("source_domain").alias("sources"), F.count_distinct("doc_id").alias("docs"))


@query("ag36_factor_frequency", "SELECT factor_label, count(DISTINCT geo_label) AS places FROM silver_factor_mentions GROUP BY 1")
def ag36(spark: S, d: str) -> DataFrame:
    return read(spark, d, SILVER).groupBy("factor_label").agg(F.count_distinct("geo_label").alias("places"))


@query("ag37_score_histogram", "SELECT CAST(floor(least(market_context_score, 9.999) / 2) AS BIGINT) AS band, count(*) AS n FROM graph_doc_nodes_daily GROUP BY 1")
def ag37(spark: S, d: str) -> DataFrame:
    return read(spark, d, NODES).groupBy(F.floor(F.least("market_context_score", F.lit(9.999)) / 2).cast("long").alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("ag38_batch_status", "SELECT suite, count(*) AS n, count(*) FILTER (length(item_text) >= 300) AS long, count(*) FILTER (item_text IS NULL) AS missing FROM eval_items GROUP BY 1")
def ag38(spark: S, d: str) -> DataFrame:
    return read(spark, d, "eval_items").groupBy("suite").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.length("item_text") >= 300).alias("long"), F.count_if(F.col("item_text").isNull()).alias("missing"))


# --- windows -----------------------------------------------------------------------------------------


@query("wn01_rolling_factor", f"""SELECT bucket_time, factor_label, geo_label, round(avg(tone_mean) OVER w, 8) AS mean30, round(stddev_samp(tone_mean) OVER w, 8) AS std30 FROM ({ROLLUP}) WINDOW w AS (PARTITION BY factor_label ORDER BY bucket_time, geo_label ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def wn01(spark: S, d: str) -> DataFrame:
    w = Window.partitionBy("factor_label").orderBy("bucket_time", "geo_label").rowsBetween(-29, 0)
    return stored_panel(spark, d).select("bucket_time", "factor_label", "geo_label", F.round(F.avg("tone_mean").over(w), 8).alias("mean30"), F.round(F.stddev_samp("tone_mean").over(w), 8).alias("std30"))


@query("wn02_rolling_pair", f"""SELECT bucket_time, factor_label, asset_label, geo_label, round(avg(tone_mean) OVER w, 8) AS mean30 FROM ({PAIR}) WINDOW w AS (PARTITION BY asset_label, factor_label ORDER BY bucket_time, geo_label ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def wn02(spark: S, d: str) -> DataFrame:
    w = Window.partitionBy("asset_label", "factor_label").orderBy("bucket_time", "geo_label").rowsBetween(-29, 0)
    return stored_pair_panel(spark, d).select("bucket_time", "factor_label", "asset_label", "geo_label", F.round(F.avg("tone_mean").over(w), 8).alias("mean30"))


@query("wn03_zscore", f"""SELECT bucket_time, factor_label, geo_label, round(CASE WHEN sd IS NULL OR sd = 0 THEN NULL ELSE (tone_mean - mu) / sd END, 6) AS zscore FROM (SELECT *, avg(tone_mean) OVER w AS mu, stddev_samp(tone_mean) OVER w AS sd FROM ({ROLLUP}) WINDOW w AS (PARTITION BY factor_label ORDER BY bucket_time, geo_label ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))""")
def wn03(spark: S, d: str) -> DataFrame:
    z = graph.zscore(stored_panel(spark, d), ["factor_label"], ["bucket_time", "geo_label"])
    return z.select("bucket_time", "factor_label", "geo_label", F.round("zscore", 6).alias("zscore"))


@query("wn04_top_per_hour", "SELECT hour, factor_label, n, rank FROM (SELECT hour, factor_label, n, row_number() OVER (PARTITION BY hour ORDER BY n DESC, factor_label) AS rank FROM (SELECT date_trunc('hour', event_time) AS hour, factor_label, count(*) AS n FROM silver_factor_mentions WHERE factor_label IS NOT NULL GROUP BY 1, 2)) WHERE rank <= 3")
def wn04(spark: S, d: str) -> DataFrame:
    h = read(spark, d, SILVER).filter("factor_label is not null").groupBy(F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("hour"), "factor_label").agg(F.count(F.lit(1)).alias("n"))
    return graph.top_per_group(h, ["hour"], [F.desc("n"), F.asc("factor_label")], 3)


@query("wn05_top_per_asset", f"SELECT asset_label, factor_label, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY asset_label ORDER BY score DESC NULLS LAST, factor_label) AS rank FROM ({NARR})) WHERE rank <= 5")
def wn05(spark: S, d: str) -> DataFrame:
    return graph.top_per_group(narratives(spark, d), ["asset_label"], [F.desc_nulls_last("score"), F.asc("factor_label")], 5).select("asset_label", "factor_label", "score", "rank")


@query("wn06_dense_ids", "SELECT factor_label, 1000 + row_number() OVER (ORDER BY factor_label) AS id FROM (SELECT DISTINCT factor_label FROM silver_factor_mentions WHERE factor_label IS NOT NULL)")
def wn06(spark: S, d: str) -> DataFrame:
    labels = read(spark, d, SILVER).filter("factor_label is not null").select("factor_label").distinct()  # a dictionary, tens of rows
    return labels.withColumn("id", F.lit(1000).cast("long") + F.row_number().over(Window.orderBy("factor_label")))


@query("wn07_keep_first", "SELECT doc_id, document_identifier FROM (SELECT doc_id, document_identifier, row_number() OVER (PARTITION BY document_identifier ORDER BY partition_date, doc_id) AS r FROM bronze_candidates WHERE document_identifier IS NOT NULL) WHERE r = 1")
def wn07(spark: S, d: str) -> DataFrame:
    b = read(spark, d, BRONZE).filter("document_identifier is not null").select("doc_id", "document_identifier", "partition_date")
    return tables.keep_first(b, ["document_identifier"], [F.asc("partition_date"), F.asc("doc_id")]).select("doc_id", "document_identifier")


@query("wn08_minmax", "SELECT part.p_partkey, round(CASE WHEN hi = lo THEN 1.0 ELSE (p_retailprice - lo) / (hi - lo) END, 8) AS scaled FROM part, (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part)")
def wn08(spark: S, d: str) -> DataFrame:
    from newsloom.functions.vectors import minmax

    p = read(spark, d, "part").select("p_partkey", "p_retailprice")
    lo, hi = p.agg(F.min("p_retailprice")).scalar(), p.agg(F.max("p_retailprice")).scalar()  # two numbers instead of a window over everything
    return p.select("p_partkey", F.round(minmax(F.col("p_retailprice"), lo, hi), 8).alias("scaled"))


@query("wn09_round_robin", "SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256(CAST(doc_id AS VARCHAR)), doc_id) AS turn FROM documents")
def wn09(spark: S, d: str) -> DataFrame:
    return tables.round_robin(read(spark, d, "documents").select("doc_id", "lang"), "lang", [F.sha2(F.col("doc_id").cast("string"), 256), F.asc("doc_id")]).select("doc_id", "lang", F.col("turn").cast("long").alias("turn"))


@query("wn12_sample_per_group", "SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY sha256(CAST(doc_id AS VARCHAR)), doc_id) AS r FROM documents) WHERE r <= 50")
def wn12(spark: S, d: str) -> DataFrame:
    return graph.top_per_group(read(spark, d, "documents").select("source", "doc_id"), ["source"], [F.sha2(F.col("doc_id").cast("string"), 256).asc(), F.asc("doc_id")], 50).select("source", "doc_id")


@query("wn13_best_per_domain", "WITH u AS (SELECT source_domain, title, doc_id, market_context_score, row_number() OVER (PARTITION BY source_domain, lower(title) ORDER BY market_context_score DESC NULLS LAST, doc_id) AS r FROM graph_doc_nodes_daily WHERE title IS NOT NULL) SELECT source_domain, doc_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY source_domain ORDER BY market_context_score DESC NULLS LAST, doc_id) AS rank FROM u WHERE r = 1) WHERE rank <= 3")
def wn13(spark: S, d: str) -> DataFrame:
    n = read(spark, d, NODES).filter("title is not null").select("source_domain", "title", "doc_id", "market_context_score").withColumn("low", F.lower("title"))
    order = [F.desc_nulls_last("market_context_score"), F.asc("doc_id")]
    return graph.top_per_group(tables.keep_first(n, ["source_domain", "low"], order), ["source_domain"], order, 3).select("source_domain", "doc_id", "rank")


@query("wn14_domain_penalty", "SELECT doc_id, round(market_context_score - 0.05 * greatest(0, r - 2), 6) AS adjusted FROM (SELECT doc_id, market_context_score, row_number() OVER (PARTITION BY partition_date, source_domain ORDER BY market_context_score DESC, doc_id) AS r FROM (SELECT DISTINCT doc_id, partition_date, source_domain, market_context_score FROM graph_doc_nodes_daily WHERE market_context_score IS NOT NULL))")
def wn14(spark: S, d: str) -> DataFrame:
    n = read(spark, d, NODES).filter("market_context_score is not null").select("doc_id", "partition_date", "source_domain", "market_context_score").distinct()
    r = F.row_number().over(Window.partitionBy("partition_date", "source_domain").orderBy(F.desc("market_context_score"), "doc_id"))
    return n.withColumn("r", r).select("doc_id", F.round(F.col("market_context_score") - F.lit(0.05) * F.greatest(F.lit(0), F.col("r") - 2), 6).alias("adjusted"))


@query("wn15_rank_bonus", "SELECT doc_id, factor_label, rank, round(1.0 / (60 + rank), 8) AS bonus FROM (SELECT doc_id, factor_label, row_number() OVER (PARTITION BY doc_id ORDER BY factor_label) AS rank FROM (SELECT DISTINCT doc_id, factor_label FROM silver_factor_mentions))")
def wn15(spark: S, d: str) -> DataFrame:
    m = read(spark, d, SILVER).select("doc_id", "factor_label").distinct().withColumn("rank", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.asc_nulls_last("factor_label"))))
    return m.withColumn("bonus", F.round(1.0 / (60 + F.col("rank")), 8))


# --- sorts and sets ----------------------------------------------------------------------------------


@query("st01_factor_daily", f"SELECT bucket_time, factor_label, geo_label, round(narrative_score, 8) AS narrative_score FROM ({SCORED}) ORDER BY bucket_time DESC, narrative_score DESC, factor_label, geo_label LIMIT 100")
def st01(spark: S, d: str) -> DataFrame:
    p = rounded(stored_panel(spark, d).select("bucket_time", "factor_label", "geo_label", "narrative_score"), "narrative_score")
    return p.orderBy(F.desc("bucket_time"), F.desc("narrative_score"), "factor_label", "geo_label").limit(100)


@query("st02_tone_tails", "SELECT factor_label, CAST(sum(neg) AS BIGINT) AS low, CAST(sum(pos) AS BIGINT) AS high FROM (SELECT factor_label, bucket_time, geo_label, count(DISTINCT CASE WHEN tone <= -5 THEN doc_id END) AS neg, count(DISTINCT CASE WHEN tone >= 5 THEN doc_id END) AS pos FROM silver_factor_mentions GROUP BY 1, 2, 3) GROUP BY 1 ORDER BY low DESC, high DESC, factor_label LIMIT 20")
def st02(spark: S, d: str) -> DataFrame:
    g = stored_panel(spark, d).groupBy("factor_label").agg(F.sum("negative_tail_count").alias("low"), F.sum("positive_tail_count").alias("high"))
    return g.orderBy(F.desc("low"), F.desc("high"), "factor_label").limit(20)


@query("st03_crossovers", f"""WITH g AS ({SCORED}) SELECT c.bucket_time, c.factor_label, c.geo_label, round(c.narrative_score - p.narrative_score, 8) AS score_delta, c.doc_count - p.doc_count AS doc_count_delta FROM g c JOIN g p ON p.factor_label = c.factor_label AND p.geo_label = c.geo_label AND p.bucket_time = c.bucket_time - 1
  ORDER BY c.bucket_time DESC, abs(round(c.narrative_score - p.narrative_score, 8)) DESC, abs(c.doc_count - p.doc_count) DESC, c.factor_label, c.geo_label LIMIT 100""")
def st03(spark: S, d: str) -> DataFrame:
    x = rounded(graph.links(stored_panel(spark, d), ["factor_label", "geo_label"]), "score_delta").select("bucket_time", "factor_label", "geo_label", "score_delta", "doc_count_delta")
    return x.orderBy(F.desc("bucket_time"), F.desc(F.abs("score_delta")), F.desc(F.abs("doc_count_delta")), "factor_label", "geo_label").limit(100)


@query("st05_evidence_order", "SELECT DISTINCT doc_id, source_priority, market_context_score FROM graph_doc_nodes_daily ORDER BY CASE WHEN market_context_score IS NULL THEN 1 ELSE 0 END, source_priority DESC NULLS LAST, market_context_score DESC NULLS LAST, doc_id LIMIT 200")
def st05(spark: S, d: str) -> DataFrame:
    n = read(spark, d, NODES).select("doc_id", "source_priority", "market_context_score").distinct()
    return n.orderBy(F.col("market_context_score").isNull().cast("int"), F.desc_nulls_last("source_priority"), F.desc_nulls_last("market_context_score"), "doc_id").limit(200)


FACTORS = ["court_ruling", "rate_path", "price_pressure"]


@query("st08_nearest_days", f"""WITH v AS (SELECT bucket_time, {", ".join(f"sum(CASE WHEN factor_label = '{f}' THEN narrative_score ELSE 0 END) AS f{k}" for k, f in enumerate(FACTORS))} FROM ({SCORED}) GROUP BY 1)
  SELECT a.bucket_time, round(sqrt(pow(a.f0 - b.f0, 2) + pow(a.f1 - b.f1, 2) + pow(a.f2 - b.f2, 2)), 6) AS distance FROM v a, (SELECT * FROM v WHERE bucket_time = DATE '2022-01-07') b WHERE a.bucket_time < DATE '2022-01-07'""")
def st08(spark: S, d: str) -> DataFrame:
    return rounded(graph.similar_days(stored_panel(spark, d), FACTORS, "2022-01-07"), "distance", digits=6)


@query("so01_union_distinct", "SELECT doc_id FROM bronze_candidates UNION SELECT doc_id FROM graph_doc_nodes_daily UNION SELECT doc_id FROM silver_factor_mentions")
def so01(spark: S, d: str) -> DataFrame:
    pick = lambda n: read(spark, d, n).select("doc_id")
    return pick(BRONZE).union(pick(NODES)).union(pick(SILVER)).distinct()


@query("so02_days_to_relink", "SELECT DISTINCT x AS bucket_time FROM (SELECT partition_date AS x FROM graph_build_partitions UNION SELECT partition_date + 1 FROM graph_build_partitions) WHERE x IS NOT NULL")
def so02(spark: S, d: str) -> DataFrame:
    return graph.days_to_relink(read(spark, d, "graph_build_partitions").select(F.col("partition_date").alias("bucket_time"))).filter("bucket_time is not null")


@query("so03_select_distinct", "SELECT DISTINCT doc_id, factor_label, source_domain, bucket_time FROM silver_factor_mentions")
def so03(spark: S, d: str) -> DataFrame:
    return read(spark, d, SILVER).select("doc_id", "factor_label", "source_domain", "bucket_time").distinct()


@query("so04_new_days", "SELECT DISTINCT partition_date FROM bronze_candidates WHERE partition_date NOT IN (SELECT partition_date FROM graph_build_partitions WHERE partition_date <= DATE '2022-01-04')")
def so04(spark: S, d: str) -> DataFrame:
    done = read(spark, d, "graph_build_partitions").filter("partition_date <= date'2022-01-04'")
    return tables.unseen(read(spark, d, BRONZE).select("partition_date").filter("partition_date is not null").distinct(), done, ["partition_date"])


@query("so05_stack", "SELECT c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier")
def so05(spark: S, d: str) -> DataFrame:
    return read(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).unionByName(read(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")))


@query("so08_merge_best", "SELECT doc_id, max(score) AS score FROM (SELECT doc_id, market_context_score AS score FROM graph_doc_nodes_daily UNION ALL SELECT doc_id, tone FROM graph_doc_nodes_daily) GROUP BY 1")
def so08(spark: S, d: str) -> DataFrame:
    n = read(spark, d, NODES)
    return n.select("doc_id", F.col("market_context_score").alias("score")).union(n.select("doc_id", "tone")).groupBy("doc_id").agg(F.max("score").alias("score"))
