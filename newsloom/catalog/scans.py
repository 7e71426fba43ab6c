"""Scans, sinks, projections and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.catalog import query, read
from newsloom.cut import scratch
from newsloom.functions import ids, text
from newsloom.plans import graph
from newsloom.sources import readers, sinks

S = SparkSession


def _tmp(spark: S, name: str) -> str:
    return scratch(spark, name)


@query("src01_union_scan", "SELECT partition_date, count(*) AS n FROM bronze_candidates WHERE partition_date IN (DATE '2022-01-04', DATE '2022-01-05') GROUP BY 1")
def src01(spark: S, d: str) -> DataFrame:
    df = readers.parquet_union(spark, f"{d}/bronze_candidates.parquet", day="partition_date", days=["2022-01-04", "2022-01-05"])
    return df.groupBy("partition_date").agg(F.count(F.lit(1)).alias("n"))


@query("src02_schema_probe", "SELECT lower(column_name) AS name FROM (DESCRIBE SELECT * FROM bronze_candidates)")
def src02(spark: S, d: str) -> DataFrame:
    return spark.createDataFrame([(c.lower(),) for c in read(spark, d, "bronze_candidates").columns], "name string")


@query("src03_alias_columns", "SELECT doc_id, nullif(trim(title),'') AS title, nullif(trim(summary_text),'') AS summary, nullif(trim(body_text),'') AS body, CAST(NULL AS VARCHAR) AS author FROM bronze_candidates")
def src03(spark: S, d: str) -> DataFrame:
    b = read(spark, d, "bronze_candidates")
    return b.select("doc_id", readers.alias(b, graph.TITLES).alias("title"), readers.alias(b, graph.SUMMARIES).alias("summary"), readers.alias(b, graph.BODIES).alias("body"), readers.alias(b, ("author", "byline")).alias("author"))


@query("src04_partition_dates", "SELECT DISTINCT partition_date FROM bronze_candidates WHERE partition_date IS NOT NULL")
def src04(spark: S, d: str) -> DataFrame:
    return readers.partition_dates(read(spark, d, "bronze_candidates"), "partition_date")


@query("src05_path_dates", "SELECT source_glob, TRY_CAST(nullif(regexp_extract(source_glob, 'dt=(\\d{4}-\\d{2}-\\d{2})', 1),'') AS DATE) AS day FROM graph_build_partitions")
def src05(spark: S, d: str) -> DataFrame:
    return read(spark, d, "graph_build_partitions").select("source_glob", readers.date_in_path(F.col("source_glob")).alias("day"))


@query("src06_pushdown_scan", "SELECT doc_id, partition_date, document_identifier FROM bronze_candidates WHERE partition_date BETWEEN DATE '2022-01-03' AND DATE '2022-01-05' AND regexp_matches(coalesce(v2_themes,''), '(SHOCK|RISK)')")
def src06(spark: S, d: str) -> DataFrame:
    b = read(spark, d, "bronze_candidates").filter("partition_date between date'2022-01-03' and date'2022-01-05'")
    return b.filter(F.coalesce("v2_themes", F.lit("")).rlike("(SHOCK|RISK)")).select("doc_id", "partition_date", "document_identifier")


@query("src07_source_count", "SELECT count(*) AS n FROM bronze_candidates WHERE partition_date >= DATE '2022-01-04' AND regexp_matches(coalesce(v2_themes,''), 'ECON_')")
def src07(spark: S, d: str) -> DataFrame:
    b = read(spark, d, "bronze_candidates").filter("partition_date >= date'2022-01-04'").filter(F.coalesce("v2_themes", F.lit("")).rlike("ECON_"))
    return b.agg(F.count(F.lit(1)).alias("n"))


@query("src09_file_catalog")
def src09(spark: S, d: str) -> DataFrame:
    """Files of the input by content hash, those already in the catalog left out."""
    done = readers.new_files(spark, f"{d}/nation.parquet")
    return readers.new_files(spark, f"{d}/region.parquet", done).select("sha256", "bytes")


@query("src11_pruned_scan", "SELECT doc_id, source_domain, tone FROM graph_doc_nodes_daily WHERE source_priority >= 2")
def src11(spark: S, d: str) -> DataFrame:
    return read(spark, d, "graph_doc_nodes_daily").filter("source_priority >= 2").select("doc_id", "source_domain", "tone")


@query("src14_csv_scan", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation")
def src14(spark: S, d: str) -> DataFrame:
    path = _tmp(spark, "csv")
    sinks.write_csv(read(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey"), path)
    return readers.csv(spark, path)


@query("src16_json_lines_scan", "SELECT doc_id, subject, rater FROM subject_labels")
def src16(spark: S, d: str) -> DataFrame:
    path = _tmp(spark, "jsonl")
    sinks.write_json_lines(read(spark, d, "subject_labels").select("doc_id", "subject", "rater"), path)
    return readers.json_lines(spark, path, "doc_id long, subject string, rater string").filter("_corrupt is null").drop("_corrupt")


@query("src20_vector_scroll", "SELECT vec_id, label FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents WHERE lang = 'de')")
def src20(spark: S, d: str) -> DataFrame:
    need = read(spark, d, "documents").filter("lang = 'de'").select(F.col("doc_id").alias("vec_id"))
    return read(spark, d, "embeddings").join(need, "vec_id", "left_semi").select("vec_id", "label")


@query("src22_single_day", "SELECT max(partition_date) AS partition_date FROM bronze_candidates WHERE partition_date = DATE '2022-01-04' HAVING count(DISTINCT partition_date) = 1")
def src22(spark: S, d: str) -> DataFrame:
    return readers.single_day(read(spark, d, "bronze_candidates").filter("partition_date = date'2022-01-04'"), "partition_date")


@query("src24_corpus_projection", """SELECT doc_id, partition_date, regexp_replace(regexp_extract(lower(trim(document_identifier)), '^[a-z][a-z0-9+.-]*://([^/?#:@]+)', 1), '^www\\.', '') AS domain,
  coalesce(title, '') AS title, substr(coalesce(relevant_text, ''), 1, 4000) AS excerpt FROM bronze_candidates WHERE document_identifier IS NOT NULL""")
def src24(spark: S, d: str) -> DataFrame:
    b = read(spark, d, "bronze_candidates").filter("document_identifier is not null")
    return b.select("doc_id", "partition_date", text.host(F.col("document_identifier")).alias("domain"), F.coalesce("title", F.lit("")).alias("title"), F.substring(F.coalesce("relevant_text", F.lit("")), 1, 4000).alias("excerpt"))


@query("src25_embedding_rows", "SELECT DISTINCT doc_id, partition_date, title FROM bronze_candidates WHERE partition_date BETWEEN DATE '2022-01-03' AND DATE '2022-01-06' ORDER BY partition_date, doc_id LIMIT 200")
def src25(spark: S, d: str) -> DataFrame:
    b = read(spark, d, "bronze_candidates").filter("partition_date between date'2022-01-03' and date'2022-01-06'")
    return b.select("doc_id", "partition_date", "title").distinct().orderBy("partition_date", "doc_id").limit(200)


@query("src26_compat_view", "SELECT doc_id, partition_date, title, CAST(NULL AS VARCHAR) AS summary_text, CAST(NULL AS VARCHAR) AS v2_themes, tone FROM graph_doc_nodes_daily")
def src26(spark: S, d: str) -> DataFrame:
    return readers.compatible(read(spark, d, "graph_doc_nodes_daily"), [("doc_id", "long"), ("partition_date", "date"), ("title", "string"), ("summary_text", "string"), ("v2_themes", "string"), ("tone", "double")])


@query("src27_labelled_lines", "SELECT subject AS label, trim(regexp_replace(coalesce(rater,'none'), '\\s+', ' ', 'g')) AS text FROM subject_labels WHERE subject IS NOT NULL")
def src27(spark: S, d: str) -> DataFrame:
    path = _tmp(spark, "lines")
    labels = read(spark, d, "subject_labels").filter("subject is not null")
    sinks.write_lines(labels, sinks.train_line(F.col("subject"), F.coalesce("rater", F.lit("none"))), path)
    return readers.labelled_lines(spark, path)


@query("src28_answer_import", "SELECT item_id, suite AS label FROM eval_items")
def src28(spark: S, d: str) -> DataFrame:
    items = read(spark, d, "eval_items")
    packed = F.to_json(F.array(F.struct(F.col("item_id").alias("id"), F.col("suite").alias("label"))))
    answers = items.select(F.concat(F.lit("Here you are:\n```json\n"), packed, F.lit("\n```\n")).alias("answer"))
    rows = answers.select(F.inline(readers.answer_rows(F.col("answer"), "id: bigint, label: string")))
    return rows.join(items.select(F.col("item_id").alias("id")), "id", "left_semi").select(F.col("id").alias("item_id"), "label")


@query("snk01_day_partitions", "SELECT partition_date, count(*) AS n, count(DISTINCT doc_id) AS docs FROM graph_doc_nodes_daily GROUP BY 1")
def snk01(spark: S, d: str) -> DataFrame:
    path, nodes = _tmp(spark, "days"), read(spark, d, "graph_doc_nodes_daily")
    sinks.write_days(nodes, path, "partition_date")
    sinks.write_days(nodes.filter("partition_date = date'2022-01-04'"), path, "partition_date")  # written again: replaced, not added
    return spark.read.parquet(path).groupBy("partition_date").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("docs"))


@query("snk03_sorted_chunks", "SELECT count(*) AS n, min(doc_id) AS low, max(doc_id) AS high FROM graph_doc_nodes_daily")
def snk03(spark: S, d: str) -> DataFrame:
    path = _tmp(spark, "chunks")
    sinks.write_chunks(read(spark, d, "graph_doc_nodes_daily").select("doc_id", "title", "market_context_text"), path, "doc_id")
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))


@query("snk04_manifest", 'SELECT partition_date, count(*) AS "rows" FROM graph_doc_nodes_daily GROUP BY 1')
def snk04(spark: S, d: str) -> DataFrame:
    return sinks.manifest(read(spark, d, "graph_doc_nodes_daily"), "partition_date")


@query("snk16_train_lines", "SELECT '__label__' || subject || ' ' || trim(regexp_replace(coalesce(rater,''), '\\s+', ' ', 'g')) AS value FROM subject_labels WHERE subject IS NOT NULL")
def snk16(spark: S, d: str) -> DataFrame:
    path = _tmp(spark, "train")
    sinks.write_lines(read(spark, d, "subject_labels").filter("subject is not null"), sinks.train_line(F.col("subject"), F.coalesce("rater", F.lit(""))), path)
    return spark.read.text(path)


@query("snk24_append_new", "SELECT count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT DISTINCT doc_id FROM bronze_candidates)")
def snk24(spark: S, d: str) -> DataFrame:
    path, b = _tmp(spark, "append"), read(spark, d, "bronze_candidates").select("doc_id", "partition_date", "title")
    sinks.append_new(spark, b.filter("partition_date <= date'2022-01-05' or partition_date is null"), path, "doc_id")
    sinks.append_new(spark, b, path, "doc_id")  # only ids not stored yet are added
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("docs"))


@query("snk25_size_projection", "SELECT partition_date, count(*) * 1000.0 / 4 AS bytes FROM bronze_candidates GROUP BY 1")
def snk25(spark: S, d: str) -> DataFrame:
    n = read(spark, d, "bronze_candidates").groupBy("partition_date").agg(F.count(F.lit(1)).alias("n"))
    return n.select("partition_date", sinks.projected_bytes(F.col("n").cast("double"), F.lit(4.0), F.lit(1000.0)).alias("bytes"))


# --- projections -------------------------------------------------------------------------------------


@query("prj01_bronze", """SELECT substr(sha256(document_identifier), 1, 16) AS doc_key, min(partition_date) AS first_day, count(*) AS n FROM bronze_candidates WHERE document_identifier IS NOT NULL GROUP BY 1""")
def prj01(spark: S, d: str) -> DataFrame:
    b = read(spark, d, "bronze_candidates").filter("document_identifier is not null")
    return b.select(ids.sha_id(F.col("document_identifier")).alias("doc_key"), "partition_date").groupBy("doc_key").agg(F.min("partition_date").alias("first_day"), F.count(F.lit(1)).alias("n"))


@query("prj02_event_time", """SELECT doc_id, coalesce(try_strptime(record_datetime, '%Y%m%d%H%M%S'), try_strptime(record_datetime, '%Y%m%d'), CAST(partition_date AS TIMESTAMP)) AS parsed FROM bronze_candidates""")
def prj02(spark: S, d: str) -> DataFrame:
    return read(spark, d, "bronze_candidates").select("doc_id", text.event_time(F.col("record_datetime"), F.col("partition_date")).alias("parsed"))


@query("prj03_source_domain", """SELECT doc_id, lower(coalesce(nullif(trim(source_domain),''), nullif(regexp_replace(regexp_extract(lower(trim(document_identifier)), '^[a-z][a-z0-9+.-]*://([^/?#:@]+)', 1), '^www\\.', ''),''), 'unknown')) AS domain FROM bronze_candidates""")
def prj03(spark: S, d: str) -> DataFrame:
    return read(spark, d, "bronze_candidates").select("doc_id", F.lower(F.coalesce(text.blank_to_null(F.col("source_domain")), text.host(F.col("document_identifier")), F.lit("unknown"))).alias("domain"))


@query("prj04_tone", "SELECT doc_id, TRY_CAST(nullif(regexp_extract(v2_tone, '^\\s*(-?\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE) AS parsed FROM bronze_candidates")
def prj04(spark: S, d: str) -> DataFrame:
    return read(spark, d, "bronze_candidates").select("doc_id", text.tone(F.col("v2_tone")).alias("parsed"))


@query("prj05_page_title", """SELECT doc_id, nullif(trim(regexp_replace(replace(replace(replace(replace(replace(regexp_extract(coalesce(gkg_extras,''), '(?is)<PAGE_TITLE>(.*?)</PAGE_TITLE>', 1), '&quot;', '"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\\s+', ' ', 'g')), '') AS page_title FROM bronze_candidates""")
def prj05(spark: S, d: str) -> DataFrame:
    return read(spark, d, "bronze_candidates").select("doc_id", text.page_title(F.col("gkg_extras")).alias("page_title"))


@query("prj06_relevant_text", """SELECT doc_id, nullif(trim(concat_ws(' || ', coalesce(title,''), coalesce(summary_text,''), substr(coalesce(body_text,''),1,4000), coalesce(all_names,''), coalesce(v2_organizations,''), coalesce(v2_persons,''), coalesce(v2_themes,''), coalesce(v2_locations,''))), '') AS joined FROM bronze_candidates""")
def prj06(spark: S, d: str) -> DataFrame:
    parts = [F.coalesce("title", F.lit("")), F.coalesce("summary_text", F.lit("")), F.substring(F.coalesce("body_text", F.lit("")), 1, 4000)]
    parts += [F.coalesce(c, F.lit("")) for c in ("all_names", "v2_organizations", "v2_persons", "v2_themes", "v2_locations")]
    return read(spark, d, "bronze_candidates").select("doc_id", F.nullif(F.trim(F.concat_ws(" || ", *parts)), F.lit("")).alias("joined"))


@query("prj06_whole_text", """SELECT doc_id, nullif(trim(concat_ws(' || ', coalesce(title,''), coalesce(summary_text,''), coalesce(body_text,''), coalesce(all_names,''), coalesce(v2_organizations,''), coalesce(v2_persons,''), coalesce(v2_themes,''), coalesce(v2_locations,''))), '') AS joined FROM bronze_candidates""")
def prj06_whole(spark: S, d: str) -> DataFrame:
    """As prj06_relevant_text, with bodies of any length."""
    parts = [F.coalesce(c, F.lit("")) for c in ("title", "summary_text", "body_text", "all_names", "v2_organizations", "v2_persons", "v2_themes", "v2_locations")]
    return read(spark, d, "bronze_candidates").select("doc_id", F.nullif(F.trim(F.concat_ws(" || ", *parts)), F.lit("")).alias("joined"))


@query("prj07_match_text", """SELECT doc_id, translate(concat_ws(' | ', v2_themes, all_names, v2_organizations, title, summary_text), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS match_text FROM bronze_candidates""")
def prj07(spark: S, d: str) -> DataFrame:
    return read(spark, d, "bronze_candidates").select("doc_id", text.ascii_upper(F.concat_ws(" | ", "v2_themes", "all_names", "v2_organizations", "title", "summary_text")).alias("match_text"))


@query("prj08_geo_labels", """SELECT doc_id, CASE WHEN len(g) = 0 THEN 'GLOBAL' ELSE array_to_string(g, ',') END AS geos FROM (SELECT doc_id, list_sort(list_distinct(regexp_extract_all(coalesce(v2_locations,''), '#([A-Z]{2})#', 1))) AS g FROM bronze_candidates)""")
def prj08(spark: S, d: str) -> DataFrame:
    return read(spark, d, "bronze_candidates").select("doc_id", F.array_join(text.geo_labels(F.col("v2_locations")), ",").alias("geos"))


@query("prj09_doc_key", "SELECT doc_id, substr(sha256(document_identifier), 1, 16) AS doc_key, substr(sha256(source_domain || '|' || document_identifier), 1, 16) AS cluster_key FROM bronze_candidates")
def prj09(spark: S, d: str) -> DataFrame:
    return read(spark, d, "bronze_candidates").select("doc_id", ids.sha_id(F.col("document_identifier")).alias("doc_key"), ids.sha_id(F.concat("source_domain", F.lit("|"), "document_identifier")).alias("cluster_key"))


@query("prj12_contains_any", "SELECT doc_id, (contains(translate(coalesce(title,''), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), 'BANK') OR contains(translate(coalesce(title,''), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), 'NOTES FROM')) AS hit FROM bronze_candidates")
def prj12(spark: S, d: str) -> DataFrame:
    return read(spark, d, "bronze_candidates").select("doc_id", text.contains_any(F.col("title"), ["BANK", "NOTES FROM"]).alias("hit"))


@query("prj13_confidence", "SELECT doc_id, round(least(0.95, 0.55 + 0.08 * count(DISTINCT factor_label)), 6) AS confidence FROM silver_factor_mentions GROUP BY doc_id")
def prj13(spark: S, d: str) -> DataFrame:
    n = F.count_distinct("factor_label")
    return read(spark, d, "silver_factor_mentions").groupBy("doc_id").agg(F.round(F.least(F.lit(0.95), F.lit(0.55) + F.lit(0.08) * n), 6).alias("confidence"))


@query("prj19_optional_range", "SELECT doc_id, event_time FROM graph_doc_nodes_daily WHERE partition_date >= DATE '2022-01-04'")
def prj19(spark: S, d: str) -> DataFrame:
    df, low, high = read(spark, d, "graph_doc_nodes_daily"), "2022-01-04", None
    df = df.filter(F.col("partition_date") >= F.lit(low).cast("date")) if low else df
    df = df.filter(F.col("partition_date") <= F.lit(high).cast("date")) if high else df
    return df.select("doc_id", "event_time")


@query("prj22_theme_filter", "SELECT doc_id FROM bronze_candidates WHERE regexp_matches(v2_themes, '(COURT|RULING|JUDGE)')")
def prj22(spark: S, d: str) -> DataFrame:
    return read(spark, d, "bronze_candidates").filter(F.col("v2_themes").rlike("(COURT|RULING|JUDGE)")).select("doc_id")


@query("prj23_payload_filter", """SELECT doc_id, source_type FROM graph_doc_nodes_daily WHERE partition_date BETWEEN DATE '2022-01-04' AND DATE '2022-01-06' AND source_type IN ('general_news','market_wrap') AND list_has_any(CAST(json(geo_labels_json) AS VARCHAR[]), ['GE','ZE','TL'])""")
def prj23(spark: S, d: str) -> DataFrame:
    n = read(spark, d, "graph_doc_nodes_daily").filter("partition_date between date'2022-01-04' and date'2022-01-06'").filter(F.col("source_type").isin("general_news", "market_wrap"))
    return n.filter(F.arrays_overlap(F.from_json("geo_labels_json", "array<string>"), F.array(*map(F.lit, ("GE", "ZE", "TL"))))).select("doc_id", "source_type")


@query("prj25_needs_enrichment", "SELECT doc_id, NOT (length(trim(coalesce(body_text,''))) >= 500 OR (length(trim(coalesce(summary_text,''))) >= 160 AND length(trim(coalesce(title,''))) >= 40)) AS needs FROM bronze_candidates")
def prj25(spark: S, d: str) -> DataFrame:
    size = lambda c: F.length(F.trim(F.coalesce(c, F.lit(""))))
    return read(spark, d, "bronze_candidates").select("doc_id", (~((size("body_text") >= 500) | ((size("summary_text") >= 160) & (size("title") >= 40)))).alias("needs"))


@query("prj26_url_allowed", "SELECT doc_id, regexp_matches(coalesce(document_identifier,''), '(?i)^https?://[^/?#]+') AS allowed FROM bronze_candidates")
def prj26(spark: S, d: str) -> DataFrame:
    return read(spark, d, "bronze_candidates").select("doc_id", F.coalesce("document_identifier", F.lit("")).rlike("(?i)^https?://[^/?#]+").alias("allowed"))


@query("prj27_evidence_text", "SELECT doc_id, coalesce(CASE WHEN trim(market_context_text) <> '' THEN market_context_text END, CASE WHEN trim(summary_text) <> '' THEN summary_text END, CASE WHEN trim(title) <> '' THEN title END, CASE WHEN trim(substr(body_text,1,400)) <> '' THEN substr(body_text,1,400) END, relevant_text) AS evidence FROM bronze_candidates")
def prj27(spark: S, d: str) -> DataFrame:
    b = read(spark, d, "bronze_candidates")
    return b.select("doc_id", F.coalesce(text.first_text(F.col("market_context_text"), F.col("summary_text"), F.col("title"), F.substring("body_text", 1, 400)), F.col("relevant_text")).alias("evidence"))


@query("prj28_clip", "SELECT doc_id, CASE WHEN length(summary_text) <= 120 THEN summary_text ELSE regexp_replace(substr(summary_text, 1, 120), '\\s+\\S*$', '') END AS clipped FROM bronze_candidates WHERE summary_text IS NOT NULL")
def prj28(spark: S, d: str) -> DataFrame:
    return read(spark, d, "bronze_candidates").filter("summary_text is not null").select("doc_id", text.clip(F.col("summary_text"), 120).alias("clipped"))


@query("prj29_root_domain", """WITH c AS (SELECT DISTINCT source_domain, regexp_replace(regexp_replace(lower(trim(source_domain)), ':\\d+$', ''), '^www\\.', '') AS dom FROM graph_doc_nodes_daily WHERE source_domain IS NOT NULL), p AS (SELECT source_domain, dom, string_split(dom, '.') AS p FROM c)
  SELECT source_domain, CASE WHEN len(p) <= 2 THEN dom WHEN p[len(p)-1] IN ('co','com','org','net','gov','ac') THEN array_to_string(p[len(p)-2:], '.') ELSE array_to_string(p[len(p)-1:], '.') END AS root FROM p""")
def prj29(spark: S, d: str) -> DataFrame:
    return read(spark, d, "graph_doc_nodes_daily").filter("source_domain is not null").select("source_domain").distinct().select("source_domain", text.root_domain(F.col("source_domain")).alias("root"))


@query("prj30_canonical_title", "SELECT doc_id, trim(regexp_replace(regexp_replace(lower(title), '\\s+', ' ', 'g'), '\\s+[-|]\\s+[^-|]{2,40}$', '')) AS canonical FROM graph_doc_nodes_daily WHERE title IS NOT NULL")
def prj30(spark: S, d: str) -> DataFrame:
    t = F.regexp_replace(F.regexp_replace(F.lower("title"), r"\s+", " "), r"\s+[-|]\s+[^-|]{2,40}$", "")
    return read(spark, d, "graph_doc_nodes_daily").filter("title is not null").select("doc_id", F.trim(t).alias("canonical"))


@query("prj31_label_collapse", "SELECT subject, CASE WHEN subject IN ('markets','macro','energy','metals') THEN 'keep' WHEN subject IS NULL THEN NULL ELSE 'drop' END AS coarse, count(*) AS n FROM subject_labels GROUP BY 1, 2")
def prj31(spark: S, d: str) -> DataFrame:
    coarse = F.when(F.col("subject").isin("markets", "macro", "energy", "metals"), "keep").when(F.col("subject").isNotNull(), "drop")
    return read(spark, d, "subject_labels").groupBy("subject", coarse.alias("coarse")).agg(F.count(F.lit(1)).alias("n"))


@query("prj32_hash_split", "SELECT doc_id, CASE WHEN CAST('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 10 < 1 THEN 'valid' ELSE 'train' END AS part FROM documents")
def prj32(spark: S, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", ids.split_name(F.col("doc_id")).alias("part"))


@query("prj34_json_probe", "SELECT doc_id, coalesce(json_extract_string(metadata_json, '$.source_table'), json_extract_string(metadata_json, '$.table')) AS source_table, json_extract_string(metadata_json, '$.batch') AS batch FROM bronze_candidates")
def prj34(spark: S, d: str) -> DataFrame:
    j = lambda k: F.get_json_object("metadata_json", f"$.{k}")
    return read(spark, d, "bronze_candidates").select("doc_id", F.coalesce(j("source_table"), j("table")).alias("source_table"), j("batch").alias("batch"))


# --- scalar functions --------------------------------------------------------------------------------


@query("sc02_case_and_length", "SELECT doc_id, lower(title) AS low, length(title) AS size, replace(title, 'a', 'o') AS changed, substr(title, 3, 7) AS cut FROM graph_doc_nodes_daily")
def sc02(spark: S, d: str) -> DataFrame:
    return read(spark, d, "graph_doc_nodes_daily").select("doc_id", F.lower("title").alias("low"), F.length("title").alias("size"), F.replace("title", F.lit("a"), F.lit("o")).alias("changed"), F.substring("title", 3, 7).alias("cut"))


@query("sc04_position", "SELECT doc_id, strpos(title, 'from') AS at, contains(title, 'week') AS has FROM graph_doc_nodes_daily WHERE title IS NOT NULL")
def sc04(spark: S, d: str) -> DataFrame:
    return read(spark, d, "graph_doc_nodes_daily").filter("title is not null").select("doc_id", F.locate("from", F.col("title")).alias("at"), F.contains("title", F.lit("week")).alias("has"))


@query("sc05_regex", "SELECT doc_id, regexp_extract(title, '([A-Z][a-z]+) ([A-Z][a-z]+)', 2) AS second, regexp_replace(title, '[0-9]+', '#', 'g') AS masked, len(regexp_extract_all(title, '[A-Z]')) AS capitals FROM graph_doc_nodes_daily WHERE title IS NOT NULL")
def sc05(spark: S, d: str) -> DataFrame:
    t = read(spark, d, "graph_doc_nodes_daily").filter("title is not null")
    return t.select("doc_id", F.regexp_extract("title", "([A-Z][a-z]+) ([A-Z][a-z]+)", 2).alias("second"), F.regexp_replace("title", "[0-9]+", "#").alias("masked"), F.size(F.regexp_extract_all("title", F.lit("[A-Z]"), F.lit(0))).cast("long").alias("capitals"))


@query("sc07_split_list", "SELECT doc_id, len(v) AS n, array_to_string(v, '|') AS items FROM (SELECT doc_id, list_filter(list_transform(string_split(coalesce(v2_themes,''), ';'), lambda x : trim(string_split(x, ',')[1])), lambda x : x <> '') AS v FROM bronze_candidates)")
def sc07(spark: S, d: str) -> DataFrame:
    v = text.split_list(F.col("v2_themes"))
    return read(spark, d, "bronze_candidates").select("doc_id", F.size(v).cast("long").alias("n"), F.array_join(v, "|").alias("items"))


@query("sc09_strip_tags", "SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(text, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS bare FROM documents WHERE text LIKE '%<%'")
def sc09(spark: S, d: str) -> DataFrame:
    return read(spark, d, "documents").filter(F.contains("text", F.lit("<"))).select("doc_id", text.strip_tags(F.col("text")).alias("bare"))


@query("sc10_url_parts", "SELECT doc_id, regexp_replace(regexp_extract(lower(trim(document_identifier)), '^[a-z][a-z0-9+.-]*://([^/?#:@]+)', 1), '^www\\.', '') || regexp_replace(lower(regexp_replace(regexp_replace(document_identifier, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '[?#].*$', '')), '/+$', '') AS canonical FROM bronze_candidates WHERE document_identifier IS NOT NULL")
def sc10(spark: S, d: str) -> DataFrame:
    return read(spark, d, "bronze_candidates").filter("document_identifier is not null").select("doc_id", text.canonical_url(F.col("document_identifier")).alias("canonical"))


@query("sc11_slug_title")
def sc11(spark: S, d: str) -> DataFrame:
    return read(spark, d, "bronze_candidates").select("doc_id", text.slug_title(F.col("document_identifier")).alias("slug_title"))


@query("sc12_hashes", "SELECT doc_id, sha256(coalesce(title,'')) AS sha, md5(coalesce(title,'')) AS md FROM graph_doc_nodes_daily")
def sc12(spark: S, d: str) -> DataFrame:
    t = F.coalesce("title", F.lit(""))
    return read(spark, d, "graph_doc_nodes_daily").select("doc_id", F.sha2(t, 256).alias("sha"), F.md5(t).alias("md"))


@query("sc15_time_parts", "SELECT doc_id, CAST(event_time AS DATE) AS day, date_trunc('hour', event_time) AS hour, CAST(event_time AS DATE) + 1 AS next_day, date_diff('day', DATE '0001-01-01', CAST(event_time AS DATE)) + 1 AS ordinal FROM graph_doc_nodes_daily")
def sc15(spark: S, d: str) -> DataFrame:
    day = F.to_date("event_time")
    return read(spark, d, "graph_doc_nodes_daily").select(
        "doc_id", day.alias("day"), F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("hour"), F.date_add(day, 1).cast("timestamp_ntz").cast("date").alias("next_day"), (F.datediff(day, F.lit("0001-01-01").cast("date")) + 1).cast("long").alias("ordinal")
    )


@query("sc19_arithmetic", "SELECT event_id, round(sqrt(abs(value)), 8) AS root, round(ln(1 + abs(value)), 8) AS log1p, greatest(0.0, least(1.0, value / 100)) AS clamped, round(pow(value, 2), 6) AS square FROM events")
def sc19(spark: S, d: str) -> DataFrame:
    v = F.col("value")
    return read(spark, d, "events").select("event_id", F.round(F.sqrt(F.abs(v)), 8).alias("root"), F.round(F.log1p(F.abs(v)), 8).alias("log1p"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), v / 100)).alias("clamped"), F.round(F.pow(v, F.lit(2)), 6).alias("square"))


@query("sc21_array_functions", "SELECT doc_id, len(g) AS n, len(list_distinct(g)) AS distinct_n, array_to_string(list_sort(g), ',') AS sorted FROM (SELECT doc_id, coalesce(CAST(json(geo_labels_json) AS VARCHAR[]), []) AS g FROM graph_doc_nodes_daily)")
def sc21(spark: S, d: str) -> DataFrame:
    g = F.coalesce(F.from_json("geo_labels_json", "array<string>"), F.array().cast("array<string>"))
    return read(spark, d, "graph_doc_nodes_daily").select("doc_id", F.size(g).cast("long").alias("n"), F.size(F.array_distinct(g)).cast("long").alias("distinct_n"), F.array_join(F.array_sort(g), ",").alias("sorted"))


@query("sc24_json_build", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def sc24(spark: S, d: str) -> DataFrame:
    packed = F.to_json(F.struct(F.get_json_object("props", "$.k").alias("k"), "event_type"))
    return read(spark, d, "events").select("event_id", F.get_json_object(packed, "$.k").cast("long").alias("k"))


@query("sc26_bit_functions", "SELECT event_id, bit_count(xor(event_id, user_id)) AS gap, event_id >> 3 AS shifted FROM events")
def sc26(spark: S, d: str) -> DataFrame:
    return read(spark, d, "events").select("event_id", ids.hamming(F.col("event_id"), F.col("user_id")).cast("int").alias("gap"), F.shiftright("event_id", 3).alias("shifted"))
