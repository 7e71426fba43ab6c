"""Queries of the day build from candidates to panels, and what is left of text operators: embedding, enrichment, routing, payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.catalog import SQL, query, read, store  # noqa: F401
from newsloom.catalog.evidence import all_impacts, steps
from newsloom.catalog.relations import BRONZE, UP
from newsloom.cut import materialize, scratch
from newsloom.functions import vectors
from newsloom.operators import rules
from newsloom.plans import evidence as ev
from newsloom.plans import graph
from newsloom.sources import readers, sinks

S = SparkSession

# --- a day from candidates to panels -----------------------------------------------------------------------

_DOCS = SQL["prj01_documents"].replace("SELECT doc_key, event_time, source_domain, title, summary_text, tone, geos, match_size FROM", "SELECT doc_key, CAST(event_time AS DATE) AS day, source_domain, tone, geos, match_text FROM", 1)
_DOCS = _DOCS.replace("length(concat_ws(' | ',", "(concat_ws(' | ',").replace(" AS match_size", " AS match_text").replace("CASE WHEN len(list_sort", "CASE WHEN len(list_sort")
_MENTIONS = f"""SELECT d.doc_key, d.day, d.source_domain, d.tone, f.factor_label, unnest(string_split(d.geos, ',')) AS geo_label, least(0.95, 0.55 + 0.08 * count(*) OVER (PARTITION BY d.doc_key)) AS confidence
  FROM ({_DOCS}) d JOIN factor_dictionary f ON contains({UP.format('d.match_text')}, upper(f.factor_label))"""


def built(spark: S, d: str) -> tuple[DataFrame, DataFrame]:
    """Documents and mentions of the candidates under the rules of the dictionary."""
    docs = materialize(graph.documents(read(spark, d, BRONZE)), "documents")
    pairs = [(r[0], r[0].upper()) for r in read(spark, d, "factor_dictionary").select("factor_label").collect()]  # the rules: 40 rows, fixed
    return docs, materialize(graph.mentions(docs, graph.match_factors(docs, pairs)), "mentions")


@query("prj00_built_mentions", f"SELECT doc_key, day AS bucket_time, factor_label, geo_label, round(confidence, 6) AS confidence FROM ({_MENTIONS})")
def built_mentions(spark: S, d: str) -> DataFrame:
    """Candidates -> documents -> factor matches -> document x factor x place."""
    return built(spark, d)[1].select("doc_key", "bucket_time", "factor_label", "geo_label", F.round("classification_confidence", 6).alias("confidence"))


@query("snk02_built_store", f"""WITH m AS ({_MENTIONS}), d AS ({_DOCS}), p AS (SELECT day, factor_label, geo_label, count(DISTINCT doc_key) AS docs FROM m GROUP BY 1, 2, 3) SELECT 'documents' AS "table", day AS dt, count(*) AS "rows" FROM d WHERE day IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'mentions', day, count(*) FROM m WHERE day IS NOT NULL GROUP BY 2 UNION ALL SELECT 'factor_panel', day, count(*) FROM p WHERE day IS NOT NULL GROUP BY 2 UNION ALL SELECT 'factor_links', c.day, count(*) FROM p c JOIN p b ON b.factor_label = c.factor_label AND b.geo_label = c.geo_label AND b.day = c.day - 1 GROUP BY 2""")
def built_store(spark: S, d: str) -> DataFrame:
    """The whole build, written as a store: documents, mentions, the daily panel with z-scores, and links to the day before."""
    docs, m = built(spark, d)
    panel = graph.rollup(m.withColumn("novelty", F.lit(None).cast("double")), ["bucket_time", "factor_label", "geo_label"], doc="doc_key", source="source_domain").withColumn("narrative_score", graph.factor_score())
    panel = materialize(graph.zscore(panel, ["factor_label", "geo_label"], ["bucket_time"]), "panel")
    link = graph.links(panel.select("bucket_time", "factor_label", "geo_label", "doc_count", "narrative_score"), ["factor_label", "geo_label"])
    parts = {"documents": docs.withColumn("bucket_time", F.to_date("event_time")).drop("partition_date"), "mentions": m, "factor_panel": panel, "factor_links": link}
    root = scratch(spark, "built")
    sinks.write_store({n: t.filter("bucket_time is not null") for n, t in parts.items()}, root, dict.fromkeys(parts, "bucket_time"))
    return sinks.read_manifest(spark, root).select("table", "dt", "rows")


@query("ag09_from_store", f"WITH m AS ({_MENTIONS}), p AS (SELECT day, factor_label, geo_label, count(DISTINCT doc_key) AS docs FROM m GROUP BY 1, 2, 3) SELECT factor_label, CAST(sum(docs) AS BIGINT) AS docs FROM p WHERE day IS NOT NULL GROUP BY 1 ORDER BY docs DESC, factor_label LIMIT 25")
def ag09_store(spark: S, d: str) -> DataFrame:
    """The top-25 report read from a stored panel."""
    root = scratch(spark, "panels")
    panel = graph.rollup(built(spark, d)[1].withColumn("novelty", F.lit(None).cast("double")), ["bucket_time", "factor_label", "geo_label"], doc="doc_key", source="source_domain")
    sinks.write_store({"panel": panel.filter("bucket_time is not null")}, root, {"panel": "bucket_time"})
    return readers.store_days(spark, root, "panel").groupBy("factor_label").agg(F.sum("doc_count").alias("docs")).orderBy(F.desc("docs"), "factor_label").limit(25)


# --- text ------------------------------------------------------------------------------------------------

_WORDS = "regexp_extract_all(lower(coalesce(title, '')), '[a-z0-9]+')"


@query("tx18_hashed_embedding", f"SELECT doc_id, array_to_string(list_transform(range(0, 16), lambda b : len(list_filter(w, lambda x : CAST('0x' || substr(md5(x), 1, 8) AS BIGINT) % 16 = b))), ',') AS counts FROM (SELECT DISTINCT doc_id, {_WORDS} AS w FROM graph_doc_nodes_daily)")
def tx18(spark: S, d: str) -> DataFrame:
    """The embedding that needs no model: words counted in buckets of their hash (here as counts, before they are brought to length one)."""
    n = read(spark, d, "graph_doc_nodes_daily").select("doc_id", F.regexp_extract_all(F.lower(F.coalesce("title", F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0)).alias("w")).distinct()
    return n.select("doc_id", F.array_join(F.transform(vectors.hashed_counts(F.col("w"), 16), lambda x: x.cast("long").cast("string")), ",").alias("counts"))


@query("tx13_capped_enrichment", """WITH need AS (SELECT document_identifier AS url, max(source_priority) AS p FROM bronze_candidates WHERE (summary_text IS NULL OR trim(summary_text) = '') AND document_identifier IS NOT NULL GROUP BY 1), pick AS (SELECT url FROM need ORDER BY p DESC NULLS LAST, url LIMIT 200),
  page AS (SELECT document_identifier AS url, min(market_context_text) AS t FROM graph_doc_nodes_daily WHERE document_identifier IN (SELECT url FROM pick) GROUP BY 1) SELECT doc_id, coalesce(nullif(trim(summary_text), ''), t) AS summary, nullif(trim(summary_text), '') IS NULL AND t IS NOT NULL AS fetched FROM (SELECT DISTINCT doc_id, summary_text, document_identifier FROM bronze_candidates) b LEFT JOIN page ON page.url = b.document_identifier""")
def tx13_capped(spark: S, d: str) -> DataFrame:
    """Summaries filled from pages: every address is fetched once, the most important two hundred at most (the cap on fetching)."""
    b, full = read(spark, d, BRONZE), F.nullif(F.trim("summary_text"), F.lit(""))
    need = b.filter(full.isNull() & F.col("document_identifier").isNotNull()).groupBy(F.col("document_identifier").alias("url")).agg(F.max("source_priority").alias("p"))
    pick = need.orderBy(F.desc_nulls_last("p"), "url").limit(200).select("url")
    pages = read(spark, d, "graph_doc_nodes_daily").select(F.col("document_identifier").alias("url"), "market_context_text").join(F.broadcast(pick), "url", "left_semi").groupBy("url").agg(F.min("market_context_text").alias("t"))
    j = b.select("doc_id", "summary_text", F.col("document_identifier").alias("url")).distinct().join(F.broadcast(pages), "url", "left")  # at most two hundred pages
    return j.select("doc_id", F.coalesce(full, "t").alias("summary"), (full.isNull() & F.col("t").isNotNull()).alias("fetched"))


ROUTES = [("contains(q, 'why') or contains(q, 'cause')", "cause"), ("contains(q, 'when') or contains(q, 'date')", "time"), ("contains(q, 'who') or contains(q, 'whose')", "actor"), ("contains(q, 'how many') or contains(q, 'how much')", "amount"), ("contains(q, 'where')", "place"), ("contains(q, 'conclude')", "conclusion"), ("true", "other")]


@query("ex20_question_routes", "SELECT route, count(*) AS n FROM (SELECT CASE " + " ".join(f"WHEN {c} THEN '{n}'" for c, n in ROUTES) + " END AS route FROM (SELECT lower(coalesce(item_text, '')) AS q FROM eval_items)) GROUP BY 1")
def ex20(spark: S, d: str) -> DataFrame:
    """Questions by class: the first rule that holds, and one for the rest."""
    q = read(spark, d, "eval_items").select(F.lower(F.coalesce("item_text", F.lit(""))).alias("q"))
    return q.select(rules.first_match(ROUTES, ["route"], ["string"])["route"].alias("route")).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@query("ex12_day_frame", steps("bf", """SELECT bf.day, '{"day":"' || bf.day || '","factors":[' || list_aggregate(list_transform(fs, lambda q : '"' || q || '"'), 'string_agg', ',') || '],"matched":' || len(matched) || ',"unresolved":' || len(unresolved) || ',"narratives":' || n || '}' AS frame FROM bf JOIN (SELECT day, count(*) AS n FROM im GROUP BY 1) c ON c.day = bf.day"""))
def ex12(spark: S, d: str) -> DataFrame:
    """What a tool answers about a day, as one JSON object."""
    impact, state = all_impacts(spark, d)
    best = ev.best_fit(ev.fits(impact, state)).join(impact.groupBy("day").agg(F.count(F.lit(1)).alias("narratives")), "day")
    frame = F.struct(F.col("day").cast("string").alias("day"), "factors", F.size("matched").alias("matched"), F.size("unresolved").alias("unresolved"), "narratives")
    return best.select("day", F.to_json(frame).alias("frame"))


@query("ex23_evidence_object", SQL["tx30_claim_status"].replace(" SELECT factor_label, top, supporting, CASE", " SELECT bucket, count(*) AS claims, sum(supporting) AS documents FROM (SELECT supporting, CASE CASE", 1).replace("ELSE 'unsupported' END AS status FROM g", "ELSE 'unsupported' END WHEN 'confirmed' THEN 'validated' WHEN 'refined' THEN 'refined' WHEN 'contradicted' THEN 'contradicted' ELSE 'unsupported' END AS bucket FROM g) GROUP BY 1", 1))
def ex23(spark: S, d: str) -> DataFrame:
    """Claims by the bucket their status falls in, with the documents behind them."""
    from newsloom.catalog.evidence import tx30

    bucket = F.when(F.col("status") == "confirmed", "validated").otherwise(F.col("status"))
    return tx30(spark, d).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("claims"), F.sum("supporting").alias("documents"))
