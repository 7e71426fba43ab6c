"""Further operators: null handling, dates, overrides, combinations, pages, models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.catalog import query, read
from newsloom.catalog.relations import BRONZE, NODES, PAIR_SCORED, SILVER, UP, pair_panel, rounded
from newsloom.cut import scratch
from newsloom.functions import html, text
from newsloom.operators import learning, tables
from newsloom.plans import graph
from newsloom.sources import readers, sinks

S = SparkSession


@query("src10_many_files", "SELECT 'customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier")
def src10(spark: S, d: str) -> DataFrame:
    rows = [readers.parquet_union(spark, f"{d}/{n}.parquet").agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n")) for n in ("customer", "supplier")]
    return rows[0].unionByName(rows[1])


@query("src13_window_and_all", "SELECT 'window' AS scope, count(*) AS n FROM graph_doc_nodes_daily WHERE partition_date = DATE '2022-01-04' UNION ALL SELECT 'all', count(*) FROM silver_factor_mentions")
def src13(spark: S, d: str) -> DataFrame:
    near = read(spark, d, NODES).filter("partition_date = date'2022-01-04'").agg(F.lit("window").alias("scope"), F.count(F.lit(1)).alias("n"))
    return near.unionByName(read(spark, d, SILVER).agg(F.lit("all").alias("scope"), F.count(F.lit(1)).alias("n")))


@query("src17_xml_scan", "SELECT r_regionkey, r_name FROM region")
def src17(spark: S, d: str) -> DataFrame:
    path = scratch(spark, "xml")
    read(spark, d, "region").select("r_regionkey", "r_name").write.format("xml").option("rowTag", "region").save(path)
    return readers.xml_rows(spark, path, "region", "r_regionkey int, r_name string")


@query("snk05_replace_days", "SELECT bucket_time, count(*) AS n FROM silver_factor_mentions GROUP BY 1")
def snk05(spark: S, d: str) -> DataFrame:
    path, m = scratch(spark, "replace"), read(spark, d, SILVER).select("bucket_time", "doc_id", "factor_label")
    sinks.write_days(m.limit(5), path, "bucket_time")  # a broken first run of some days
    sinks.write_days(m, path, "bucket_time")
    return spark.read.parquet(path).groupBy("bucket_time").agg(F.count(F.lit(1)).alias("n"))


@query("snk09_case_update", "SELECT doc_id, CASE WHEN source_priority >= 4 THEN 'wrap' WHEN source_priority >= 3 THEN 'specialist' WHEN source_priority IS NULL THEN 'unknown' ELSE 'general' END AS kind FROM graph_doc_nodes_daily")
def snk09(spark: S, d: str) -> DataFrame:
    p = F.col("source_priority")
    return read(spark, d, NODES).select("doc_id", F.when(p >= 4, "wrap").when(p >= 3, "specialist").when(p.isNull(), "unknown").otherwise("general").alias("kind"))


@query("snk13_zstd_writer", "SELECT count(*) AS n, sum(length(title)) AS letters FROM graph_doc_nodes_daily")
def snk13(spark: S, d: str) -> DataFrame:
    path = scratch(spark, "zstd")
    read(spark, d, NODES).select("doc_id", "title").write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("title")).alias("letters"))


@query("prj24_min_score", "SELECT doc_id, market_context_score FROM graph_doc_nodes_daily WHERE market_context_score >= 4")
def prj24(spark: S, d: str) -> DataFrame:
    return read(spark, d, NODES).filter("market_context_score >= 4").select("doc_id", "market_context_score")


@query("prj35_domain_shape", "SELECT source_domain, count(*) AS n FROM graph_doc_nodes_daily WHERE regexp_matches(source_domain, '^[a-z]+-online\\.') GROUP BY 1")
def prj35(spark: S, d: str) -> DataFrame:
    return read(spark, d, NODES).filter(F.col("source_domain").rlike(r"^[a-z]+-online\.")).groupBy("source_domain").agg(F.count(F.lit(1)).alias("n"))


@query("jn17_single_row_join", "SELECT o_orderkey, o_totalprice > m.a AS above FROM orders, (SELECT avg(o_totalprice) AS a FROM orders) m")
def jn17(spark: S, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    return o.select("o_orderkey", (F.col("o_totalprice") > o.agg(F.avg("o_totalprice")).scalar()).alias("above"))


@query("jn24_prefer_existing", "SELECT n.doc_id, coalesce(nullif(trim(n.title), ''), nullif(trim(b.title), ''), nullif(trim(b.summary_text), ''), 'untitled') AS title FROM (SELECT DISTINCT doc_id, title FROM graph_doc_nodes_daily) n LEFT JOIN (SELECT DISTINCT doc_id, title, summary_text FROM bronze_candidates) b USING (doc_id)")
def jn24(spark: S, d: str) -> DataFrame:
    b = read(spark, d, BRONZE).select("doc_id", F.col("title").alias("t"), "summary_text").distinct()
    full = lambda c: F.nullif(F.trim(c), F.lit(""))
    return read(spark, d, NODES).select("doc_id", "title").distinct().join(b, "doc_id", "left").select("doc_id", F.coalesce(full("title"), full("t"), full("summary_text"), F.lit("untitled")).alias("title"))


@query("jn29_source_audit", "SELECT s.source, s.n, coalesce(l.labels, 0) AS labels, m.target_share FROM (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1) s LEFT JOIN (SELECT source, count(*) AS labels FROM documents JOIN subject_labels USING (doc_id) GROUP BY 1) l USING (source) LEFT JOIN mix_targets m USING (source)")
def jn29(spark: S, d: str) -> DataFrame:
    docs = read(spark, d, "documents").filter("source is not null").select("doc_id", "source")
    n = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    lab = docs.join(read(spark, d, "subject_labels").select("doc_id"), "doc_id").groupBy("source").agg(F.count(F.lit(1)).alias("labels"))
    return n.join(lab, "source", "left").fillna(0, ["labels"]).join(read(spark, d, "mix_targets").select("source", "target_share"), "source", "left")


@query("ag32_probe_profile", "SELECT source, round(avg(CASE WHEN r <= 6 THEN long END), 8) AS rate, count(*) FILTER (r <= 6) AS probed FROM (SELECT source, CASE WHEN n_chars > 800 THEN 1.0 ELSE 0.0 END AS long, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) GROUP BY 1")
def ag32(spark: S, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select("source", "doc_id", F.when(F.col("n_chars") > 800, 1.0).otherwise(0.0).alias("long"))
    return graph.top_per_group(docs, ["source"], [F.asc("doc_id")], 6).groupBy("source").agg(F.round(F.avg("long"), 8).alias("rate"), F.count(F.lit(1)).alias("probed"))


@query("ag35_source_confidence", "SELECT factor_label, CASE WHEN count(DISTINCT source_domain) >= 20 THEN 'high' WHEN count(DISTINCT source_domain) >= 5 THEN 'medium' ELSE 'low' END AS confidence FROM silver_factor_mentions GROUP BY 1")
def ag35(spark: S, d: str) -> DataFrame:
    n = F.count_distinct("source_domain")
    return read(spark, d, SILVER).groupBy("factor_label").agg(F.when(n >= 20, "high").when(n >= 5, "medium").otherwise("low").alias("confidence"))


@query("st04_pair_crossovers", f"""WITH g AS ({PAIR_SCORED}) SELECT c.bucket_time, c.factor_label, c.geo_label, round(c.narrative_score - p.narrative_score, 8) AS score_delta FROM g c JOIN g p ON p.factor_label = c.factor_label AND p.asset_label = c.asset_label AND p.geo_label = c.geo_label AND p.bucket_time = c.bucket_time - 1 WHERE c.asset_label = 'macro'
  ORDER BY c.bucket_time DESC, abs(round(c.narrative_score - p.narrative_score, 8)) DESC, c.factor_label, c.geo_label LIMIT 100""")
def st04(spark: S, d: str) -> DataFrame:
    p = pair_panel(spark, d).filter("asset_label = 'macro'")
    x = rounded(graph.links(p, ["factor_label", "asset_label", "geo_label"]), "score_delta").select("bucket_time", "factor_label", "geo_label", "score_delta")
    return x.orderBy(F.desc("bucket_time"), F.desc(F.abs("score_delta")), "factor_label", "geo_label").limit(100)


@query("st09_best_sentences", "SELECT doc_id, array_to_string(list_slice(list_reverse_sort(s), 1, 2), '|') AS best FROM (SELECT doc_id, list_filter(string_split(coalesce(summary_text, ''), '. '), lambda x : length(x) >= 40) AS s FROM bronze_candidates)")
def st09(spark: S, d: str) -> DataFrame:
    s = F.filter(F.split(F.coalesce("summary_text", F.lit("")), r"\. "), lambda x: F.length(x) >= 40)
    return read(spark, d, BRONZE).select("doc_id", F.array_join(F.slice(F.sort_array(s, asc=False), 1, 2), "|").alias("best"))


@query("so06_array_sets", "SELECT doc_id, len(list_intersect(g, ['GE','ZE','TL'])) AS both, len(list_filter(list_distinct(g), lambda x : NOT list_contains(['GE','ZE','TL'], x))) AS only FROM (SELECT doc_id, coalesce(CAST(json(geo_labels_json) AS VARCHAR[]), []) AS g FROM graph_doc_nodes_daily)")
def so06(spark: S, d: str) -> DataFrame:
    g, fixed = F.coalesce(F.from_json("geo_labels_json", "array<string>"), F.array().cast("array<string>")), F.array(*map(F.lit, ("GE", "ZE", "TL")))
    return read(spark, d, NODES).select("doc_id", F.size(F.array_intersect(g, fixed)).cast("long").alias("both"), F.size(F.array_except(g, fixed)).cast("long").alias("only"))


@query("so07_combinations", "SELECT a.r_name AS first, b.r_name AS second, c.r_name AS third FROM region a JOIN region b ON a.r_regionkey < b.r_regionkey JOIN region c ON b.r_regionkey < c.r_regionkey")
def so07(spark: S, d: str) -> DataFrame:
    """Combinations of three out of a handful of rows, built inside one array."""
    items = read(spark, d, "region").groupBy().agg(F.array_sort(F.collect_list(F.struct("r_regionkey", "r_name"))).alias("r"))  # 5 rows, fixed
    a = items.select("r", F.posexplode("r").alias("i", "x")).select("r", "i", F.col("x.r_name").alias("first"))
    b = a.select("r", "i", "first", F.posexplode("r").alias("j", "y")).filter("i < j").select("r", "j", "first", F.col("y.r_name").alias("second"))
    return b.select("j", "first", "second", F.posexplode("r").alias("k", "z")).filter("j < k").select("first", "second", F.col("z.r_name").alias("third"))


@query("sc01_nulls", "SELECT doc_id, coalesce(nullif(trim(title), ''), 'none') AS t, CAST(source_priority AS VARCHAR) AS p, title IS NULL AS no_title FROM graph_doc_nodes_daily")
def sc01(spark: S, d: str) -> DataFrame:
    return read(spark, d, NODES).select("doc_id", F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.lit("none")).alias("t"), F.col("source_priority").cast("string").alias("p"), F.col("title").isNull().alias("no_title"))


@query("sc03_concat", "SELECT doc_id, concat_ws('|', source_domain, source_type) AS a, source_domain || '/' || source_type AS b FROM graph_doc_nodes_daily")
def sc03(spark: S, d: str) -> DataFrame:
    return read(spark, d, NODES).select("doc_id", F.concat_ws("|", "source_domain", "source_type").alias("a"), F.concat("source_domain", F.lit("/"), "source_type").alias("b"))


@query("sc08_unescape")
def sc08(spark: S, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", html.unescape(F.col("text")).alias("plain"))


@query("sc14_try_cast", "SELECT DISTINCT dates, TRY_CAST(split_part(dates, '#', 4) AS INTEGER) AS year, try_strptime(split_part(dates, '#', 4), '%Y') IS NOT NULL AS ok FROM bronze_candidates WHERE dates IS NOT NULL")
def sc14(spark: S, d: str) -> DataFrame:
    y = F.split_part("dates", F.lit("#"), F.lit(4))
    return read(spark, d, BRONZE).filter("dates is not null").select("dates", y.try_cast("int").alias("year"), F.try_to_timestamp(y, F.lit("yyyy")).isNotNull().alias("ok")).distinct()


@query("sc16_date_arithmetic", "SELECT DISTINCT partition_date, partition_date - 1 AS before, partition_date + 7 AS week, date_diff('day', DATE '2022-01-01', partition_date) AS days FROM graph_doc_nodes_daily WHERE partition_date IS NOT NULL")
def sc16(spark: S, d: str) -> DataFrame:
    p = F.col("partition_date")
    return read(spark, d, NODES).filter("partition_date is not null").select(p, F.date_sub(p, 1).alias("before"), F.date_add(p, 7).alias("week"), F.datediff(p, F.lit("2022-01-01").cast("date")).cast("long").alias("days")).distinct()


@query("sc20_rounding", "SELECT p_partkey, round(p_retailprice, 1) AS one, floor(p_retailprice) AS low, ceil(p_retailprice) AS high FROM part")
def sc20(spark: S, d: str) -> DataFrame:
    p = F.col("p_retailprice")
    return read(spark, d, "part").select("p_partkey", F.round(p, 1).alias("one"), F.floor(p).cast("double").alias("low"), F.ceil(p).cast("double").alias("high"))


@query("sc23_empty_arrays", "SELECT doc_id, len(CASE WHEN geo_labels_json IS NULL THEN CAST([] AS VARCHAR[]) ELSE CAST(json(geo_labels_json) AS VARCHAR[]) END) AS n FROM graph_doc_nodes_daily")
def sc23(spark: S, d: str) -> DataFrame:
    none = F.array().cast("array<string>")
    return read(spark, d, NODES).select("doc_id", F.size(F.when(F.col("geo_labels_json").isNull(), none).otherwise(F.from_json("geo_labels_json", "array<string>"))).cast("long").alias("n"))


@query("sc25_case", "SELECT event_type, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 0 END AS code, count(*) AS n FROM events GROUP BY 1, 2")
def sc25(spark: S, d: str) -> DataFrame:
    code = F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "view", 2).otherwise(0)
    return read(spark, d, "events").groupBy("event_type", code.alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query("tx12_article_fields")
def tx12(spark: S, d: str) -> DataFrame:
    """Title, summary and blocks of text of every corpus text, read as a page."""
    return read(spark, d, "documents").select("doc_id", html.article(F.col("text")).alias("a")).select("doc_id", "a.title", "a.summary", F.col("a.text").alias("body"))


@query("tx13_enrich_from_pages", "SELECT b.doc_id, coalesce(b.summary_text, n.market_context_text) AS summary FROM (SELECT DISTINCT doc_id, summary_text, document_identifier FROM bronze_candidates) b LEFT JOIN (SELECT document_identifier, min(market_context_text) AS market_context_text FROM graph_doc_nodes_daily WHERE document_identifier IS NOT NULL GROUP BY 1) n USING (document_identifier)")
def tx13(spark: S, d: str) -> DataFrame:
    pages = read(spark, d, NODES).filter("document_identifier is not null").groupBy("document_identifier").agg(F.min("market_context_text").alias("market_context_text"))  # one fetch per address
    b = read(spark, d, BRONZE).select("doc_id", "summary_text", "document_identifier").distinct()
    return b.join(pages, "document_identifier", "left").select("doc_id", F.coalesce("summary_text", "market_context_text").alias("summary"))


@query("tx17_derived_title", "SELECT doc_id, substr(coalesce(nullif(trim(title), ''), nullif(trim(market_context_text), ''), nullif(trim(relevant_text), '')), 1, 280) AS derived FROM bronze_candidates")
def tx17(spark: S, d: str) -> DataFrame:
    full = lambda c: F.nullif(F.trim(c), F.lit(""))
    return read(spark, d, BRONZE).select("doc_id", F.substring(F.coalesce(full("title"), full("market_context_text"), full("relevant_text")), 1, 280).alias("derived"))


@query("tx22_metadata_score", f"SELECT doc_id, round(0.45 * CASE WHEN contains({UP.format('coalesce(title, chr(32))')}, 'BANK') THEN 1 ELSE 0 END + 0.35 * CASE WHEN source_type = 'market_wrap' THEN 1 ELSE 0 END + 0.20 * coalesce(source_priority, 0) / 5, 6) AS score FROM graph_doc_nodes_daily")
def tx22(spark: S, d: str) -> DataFrame:
    one = lambda c: F.when(c, 1).otherwise(0)
    s = 0.45 * one(F.contains(text.ascii_upper(F.coalesce("title", F.lit(" "))), F.lit("BANK"))) + 0.35 * one(F.col("source_type") == "market_wrap") + 0.20 * F.coalesce("source_priority", F.lit(0)) / 5
    return read(spark, d, NODES).select("doc_id", F.round(s, 6).alias("score"))


@query("tx27_kmeans")
def tx27(spark: S, d: str) -> DataFrame:
    return learning.spherical_kmeans(read(spark, d, "embeddings"), 10)


@query("cl06_text_classifier")
def cl06(spark: S, d: str) -> DataFrame:
    """Subject predicted for every corpus text by a model trained on the labelled sample."""
    docs = read(spark, d, "documents").filter("trim(text) <> ''").select("doc_id", "text")
    train = docs.join(read(spark, d, "subject_labels").filter("subject is not null").select("doc_id", "subject"), "doc_id")
    return learning.classify(learning.text_classifier(train, "subject", "text"), docs, ["doc_id"])


@query("wn16_keyset_page", "SELECT DISTINCT doc_id, title FROM graph_doc_nodes_daily WHERE doc_id > 1000000000000000000 ORDER BY doc_id LIMIT 50")
def wn16(spark: S, d: str) -> DataFrame:
    return read(spark, d, NODES).filter("doc_id > 1000000000000000000").select("doc_id", "title").distinct().orderBy("doc_id").limit(50)


@query("ag39_stage_metrics", "SELECT count(*) AS rows_in, count(*) FILTER (tone IS NOT NULL) AS with_tone FROM silver_factor_mentions")
def ag39(spark: S, d: str) -> DataFrame:
    return read(spark, d, SILVER).agg(F.count(F.lit(1)).alias("rows_in"), F.count_if(F.col("tone").isNotNull()).alias("with_tone"))


@query("cl15_fill_overrides", "SELECT source_domain, coalesce(o.label, 'default') AS label FROM (SELECT DISTINCT source_domain FROM graph_doc_nodes_daily WHERE source_domain IS NOT NULL) LEFT JOIN (VALUES ('zindzouenwire.invalid', 'wire')) o(source_domain, label) USING (source_domain)")
def cl15(spark: S, d: str) -> DataFrame:
    known = spark.createDataFrame([("zindzouenwire.invalid", "wire")], "source_domain string, label string")
    every = read(spark, d, NODES).filter("source_domain is not null").select("source_domain").distinct()
    rest = tables.unseen(every, known, ["source_domain"]).withColumn("label", F.lit("default"))
    return rest.unionByName(known.join(every, "source_domain", "left_semi"))


@query("ag34_overlap_ranking", "SELECT geo_label, round(5 * count(DISTINCT factor_label) + 2 * count(DISTINCT source_domain) + sum(coalesce(source_weight, 0)), 6) AS impact FROM silver_factor_mentions GROUP BY 1")
def ag34(spark: S, d: str) -> DataFrame:
    s = 5 * F.count_distinct("factor_label") + 2 * F.count_distinct("source_domain") + F.sum(F.coalesce("source_weight", F.lit(0.0)))
    return read(spark, d, SILVER).groupBy("geo_label").agg(F.round(s, 6).alias("impact"))


@query("cl08_decision_band", "SELECT doc_id, CASE WHEN classification_confidence >= 0.9 AND novelty IS NOT NULL THEN 'auto' WHEN classification_confidence >= 0.7 THEN 'band' ELSE 'review' END AS band, count(*) AS n FROM silver_factor_mentions GROUP BY 1, 2")
def cl08(spark: S, d: str) -> DataFrame:
    c = F.col("classification_confidence")
    band = F.when((c >= 0.9) & F.col("novelty").isNotNull(), "auto").when(c >= 0.7, "band").otherwise("review")
    return read(spark, d, SILVER).groupBy("doc_id", band.alias("band")).agg(F.count(F.lit(1)).alias("n"))
