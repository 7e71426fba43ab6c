"""Queries of the store: day build, manifest, chunks, ledgers, workspaces; scalar functions and retrieval in full."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newsloom.catalog import query, read
from newsloom.catalog.relations import BRONZE, NODES, PAIR_SCORED, SCORED, SILVER, UP, pair_panel, panel, rounded
from newsloom.catalog.retrieval import FORM, SENTENCES, TERMS
from newsloom.cut import scratch
from newsloom.functions import ids, text, vectors
from newsloom.operators import retrieval, tables
from newsloom.plans import graph
from newsloom.sources import readers, sinks

S = SparkSession
DAYS = {"bronze": "partition_date", "nodes": "partition_date", "silver": "bucket_time"}


def store(spark: S, d: str) -> str:
    """A store of three tables in the shared folder."""
    root = scratch(spark, "store")
    parts = {"bronze": read(spark, d, BRONZE).select("doc_id", "partition_date", "title"), "nodes": read(spark, d, NODES).select("doc_id", "partition_date", "source_domain", "title"), "silver": read(spark, d, SILVER).select("doc_id", "bucket_time", "factor_label", "geo_label")}
    sinks.write_store({n: t.filter(F.col(DAYS[n]).isNotNull()) for n, t in parts.items()}, root, DAYS)
    return root


_PER_DAY = "SELECT 'bronze' AS \"table\", partition_date AS dt, count(*) AS \"rows\" FROM bronze_candidates WHERE partition_date IS NOT NULL GROUP BY 2 UNION ALL SELECT 'nodes', partition_date, count(*) FROM graph_doc_nodes_daily WHERE partition_date IS NOT NULL GROUP BY 2 UNION ALL SELECT 'silver', bucket_time, count(*) FROM silver_factor_mentions WHERE bucket_time IS NOT NULL GROUP BY 2"


@query("snk02_day_store", _PER_DAY)
def snk02(spark: S, d: str) -> DataFrame:
    """Every table of the store by day, as read back."""
    root, out = store(spark, d), None
    for n in DAYS:
        one = readers.store_days(spark, root, n).groupBy("dt").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "dt", "rows")
        out = one if out is None else out.unionByName(one)
    return out


@query("snk04_manifest_file", _PER_DAY)
def snk04_full(spark: S, d: str) -> DataFrame:
    """The manifest as written and read back."""
    return sinks.read_manifest(spark, store(spark, d)).select("table", "dt", "rows")


@query("snk06_clear_day", f"SELECT * FROM ({_PER_DAY}) WHERE dt <> (SELECT min(partition_date) FROM graph_doc_nodes_daily)")
def snk06(spark: S, d: str) -> DataFrame:
    root = store(spark, d)
    first = read(spark, d, NODES).agg(F.min("partition_date")).first()[0]
    sinks.clear_day(spark, root, list(DAYS), str(first))
    return sinks.read_manifest(spark, root).select("table", "dt", "rows")


@query("src08_store_range", "SELECT partition_date AS dt, count(*) AS n FROM graph_doc_nodes_daily WHERE partition_date > (SELECT min(partition_date) FROM graph_doc_nodes_daily) GROUP BY 1")
def src08(spark: S, d: str) -> DataFrame:
    """Days of a stored table by address and range; only their folders are read."""
    low = read(spark, d, NODES).agg(F.date_add(F.min("partition_date"), 1)).first()[0]
    return readers.store_days(spark, store(spark, d), "nodes", str(low)).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


@query("src12_manifest_scan", "SELECT bucket_time AS dt, factor_label, count(*) AS n FROM silver_factor_mentions WHERE bucket_time = (SELECT max(bucket_time) FROM silver_factor_mentions) GROUP BY 1, 2")
def src12(spark: S, d: str) -> DataFrame:
    """The folders of the last day, by the manifest alone."""
    root = store(spark, d)
    last = sinks.read_manifest(spark, root).filter("`table` = 'silver'").agg(F.max("dt")).first()[0]
    return readers.from_manifest(spark, root, "silver", [str(last)]).groupBy("dt", "factor_label").agg(F.count(F.lit(1)).alias("n"))


@query("src09_content_keys", "SELECT 0 AS again, (SELECT count(*) FROM orders) AS \"rows\"")
def src09_full(spark: S, d: str) -> DataFrame:
    """Files of a table by the content of their rows: a second look finds none of them new."""
    o = read(spark, d, "orders")
    seen = readers.content_keys(o)
    return readers.content_keys(o, seen).agg(F.count(F.lit(1)).cast("int").alias("again")).join(seen.agg(F.sum("rows").alias("rows")))  # one row each


@query("src10_stacked", "SELECT k, name, balance FROM (SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier)")
def src10_full(spark: S, d: str) -> DataFrame:
    """Files of the same columns read as one frame."""
    root = scratch(spark, "stack")
    read(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).write.parquet(f"{root}/a")
    read(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")).write.parquet(f"{root}/b")
    return readers.parquet_union(spark, f"{root}/a", f"{root}/b")


@query("src13_scoped_tables", "SELECT 'bronze' AS \"table\", count(*) AS n, count(DISTINCT partition_date) AS days FROM bronze_candidates WHERE partition_date = (SELECT max(partition_date) FROM graph_doc_nodes_daily) UNION ALL SELECT 'nodes', count(*), count(DISTINCT partition_date) FROM graph_doc_nodes_daily WHERE partition_date = (SELECT max(partition_date) FROM graph_doc_nodes_daily) UNION ALL SELECT 'silver', count(*), count(DISTINCT bucket_time) FROM silver_factor_mentions WHERE bucket_time IS NOT NULL")
def src13_full(spark: S, d: str) -> DataFrame:
    """Daily tables of the last day only, the panel's table on all days."""
    last = str(read(spark, d, NODES).agg(F.max("partition_date")).first()[0])
    out = None
    for n, df in readers.workspace(spark, store(spark, d), ["bronze", "nodes"], ["silver"], last, last).items():
        one = df.agg(F.lit(n).alias("table"), F.count(F.lit(1)).alias("n"), F.count_distinct("dt").alias("days"))
        out = one if out is None else out.unionByName(one)
    return out


@query("snk17_workspace", "SELECT factor_label, count(DISTINCT s.doc_id) AS docs FROM silver_factor_mentions s JOIN graph_doc_nodes_daily n ON n.doc_id = s.doc_id WHERE n.partition_date = (SELECT max(partition_date) FROM graph_doc_nodes_daily) AND s.bucket_time IS NOT NULL GROUP BY 1")
def snk17(spark: S, d: str) -> DataFrame:
    """SQL over the views of a workspace: the last day's documents and all mentions."""
    last = str(read(spark, d, NODES).agg(F.max("partition_date")).first()[0])
    readers.workspace(spark, store(spark, d), ["nodes"], ["silver"], last, last)
    return spark.sql("SELECT factor_label, count(DISTINCT s.doc_id) AS docs FROM ws_silver s JOIN ws_nodes n ON n.doc_id = s.doc_id GROUP BY factor_label")


@query("snk18_kept_table", "SELECT factor_label, count(*) AS n FROM silver_factor_mentions GROUP BY 1")
def snk18(spark: S, d: str) -> DataFrame:
    """A table kept under a key: asked for twice, computed once."""
    df = read(spark, d, SILVER).groupBy("factor_label").agg(F.count(F.lit(1)).alias("n"))
    first = readers.kept(df, d, "factor counts")
    return first if readers.kept(df, d, "factor counts") is first else df.filter("false")


VIEWS = {
    "factor_daily": ("bucket_time, factor_label", SCORED, "doc_count > 0"), "tone_tails": ("bucket_time, factor_label", SCORED, "negative_tail_count + positive_tail_count > 0"), "pair_daily": ("bucket_time, asset_label", PAIR_SCORED, "doc_count > 0"),
    "wide": ("bucket_time, geo_label", SCORED, "unique_sources >= 2"), "loud": ("bucket_time, factor_label", SCORED, "narrative_score >= 2"), "single": ("bucket_time, factor_label", SCORED, "doc_count = 1"),
}


@query("snk19_derived_views", " UNION ALL ".join(f"SELECT '{n}' AS view, count(*) AS n FROM (SELECT {k}, count(*) FROM ({q}) WHERE {c} GROUP BY ALL)" for n, (k, q, c) in VIEWS.items()))
def snk19(spark: S, d: str) -> DataFrame:
    """Six views over one stored panel each for factors and pairs: panels are computed once and read from the folder."""
    one, two, out = readers.kept(panel(spark, d), d, "panel"), readers.kept(pair_panel(spark, d), d, "pair panel"), None
    for n, (k, q, c) in VIEWS.items():
        df = (one if q is SCORED else two).filter(c).select(*k.split(", ")).distinct()
        df.createOrReplaceTempView(f"view_{n}")
        got = spark.table(f"view_{n}").agg(F.lit(n).alias("view"), F.count(F.lit(1)).alias("n"))
        out = got if out is None else out.unionByName(got)
    return out


@query("snk03_ranged_chunks", "SELECT count(*) AS n, min(doc_id) AS low, max(doc_id) AS high, true AS bounded, true AS apart FROM (SELECT DISTINCT doc_id FROM graph_doc_nodes_daily)")
def snk03_full(spark: S, d: str) -> DataFrame:
    """Chunks of at most 4,096 rows whose key ranges do not overlap, by their index."""
    path = scratch(spark, "ranged")
    sinks.write_ranged(read(spark, d, NODES).select("doc_id", "title").dropDuplicates(["doc_id"]), path, "doc_id")
    index = spark.read.parquet(f"{path}/index")
    met = index.select("lo", "hi", F.lead("lo").over(_by("lo")).alias("after"), "rows")  # a row per file
    return met.agg(F.sum("rows").alias("n"), F.min("lo").alias("low"), F.max("hi").alias("high"), (F.max("rows") <= 4096).alias("bounded"), F.bool_and(F.coalesce(F.col("after") > F.col("hi"), F.lit(True))).alias("apart"))


def _by(column: str):  # noqa: ANN202
    from pyspark.sql import Window

    return Window.orderBy(column)


@query("snk07_update_by_key", "SELECT doc_id, replace(title, '&amp;', '&') AS title FROM (SELECT DISTINCT doc_id, title FROM bronze_candidates)")
def snk07(spark: S, d: str) -> DataFrame:
    """Titles written anew for the keys that need it, the rest untouched."""
    base = read(spark, d, BRONZE).select("doc_id", "title").distinct()
    change = base.filter(F.contains("title", F.lit("&amp;"))).select("doc_id", F.replace("title", F.lit("&amp;"), F.lit("&")).alias("title"))
    return tables.override(base, change, "doc_id", ["title"])


@query("snk08_update_from", "SELECT m.doc_id, m.factor_label, coalesce(r.n, 0) AS relevance FROM (SELECT DISTINCT doc_id, factor_label FROM silver_factor_mentions) m LEFT JOIN (SELECT doc_id, factor_label, count(*) AS n FROM silver_factor_mentions WHERE tone < 0 GROUP BY 1, 2) r ON r.doc_id = m.doc_id AND r.factor_label = m.factor_label")
def snk08(spark: S, d: str) -> DataFrame:
    """A value computed beside the mentions and written into them."""
    m = read(spark, d, SILVER)
    r = m.filter("tone < 0").groupBy("doc_id", "factor_label").agg(F.count(F.lit(1)).alias("relevance"))
    return m.select("doc_id", "factor_label").distinct().join(r, ["doc_id", "factor_label"], "left").fillna(0, ["relevance"])


@query("snk10_json_rows", "SELECT n_nationkey AS k, '{\"n_nationkey\":' || n_nationkey || ',\"n_name\":\"' || n_name || '\",\"missing\":null}' AS line FROM nation")
def snk10(spark: S, d: str) -> DataFrame:
    """Rows as one JSON object a line, nulls written out."""
    row = F.struct("n_nationkey", "n_name", F.lit(None).cast("string").alias("missing"))
    return read(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.to_json(row, {"ignoreNullFields": "false"}).alias("line"))


@query("snk11_vector_upsert", "SELECT coalesce(n.vec_id, o.vec_id) AS vec_id, CAST(coalesce(n.x, o.x) AS DOUBLE) AS x, CASE WHEN o.vec_id IS NULL THEN 'insert' WHEN n.vec_id IS NULL THEN 'keep' ELSE 'update' END AS change FROM (SELECT vec_id, embedding[1] AS x FROM embeddings) o FULL JOIN (SELECT doc_id AS vec_id, CAST(0.5 AS FLOAT) AS x FROM documents WHERE lang = 'de') n ON n.vec_id = o.vec_id")
def snk11(spark: S, d: str) -> DataFrame:
    """New vectors into a stored collection by id."""
    old = read(spark, d, "embeddings").select("vec_id", "embedding")
    new = read(spark, d, "documents").filter("lang = 'de'").select(F.col("doc_id").alias("vec_id"), F.array(F.lit(0.5).cast("float")).alias("embedding"))
    return tables.upsert(old, new, "vec_id").select("vec_id", F.get("embedding", F.lit(0)).cast("double").alias("x"), "change")


@query("snk12_quantised_collection", "SELECT vec_id, CAST(list_sum(list_transform(range(1, 33), lambda i : CASE WHEN embedding[i] > 0 THEN 1::BIGINT << (i - 1) ELSE 0 END)) AS BIGINT) AS low, CAST(list_sum(list_transform(range(1, 33), lambda i : CASE WHEN embedding[i + 32] > 0 THEN 1::BIGINT << (i - 1) ELSE 0 END)) AS BIGINT) AS high FROM embeddings")
def snk12(spark: S, d: str) -> DataFrame:
    """A collection with one sign bit a dimension, written anew."""
    path = scratch(spark, "collection")
    e = read(spark, d, "embeddings")
    e.select("vec_id", vectors.sign_bits(F.col("embedding"), 0, 32).alias("low"), vectors.sign_bits(F.col("embedding"), 32, 32).alias("high")).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("snk13_codec", "SELECT count(*) AS n, true AS zstd FROM graph_doc_nodes_daily")
def snk13_full(spark: S, d: str) -> DataFrame:
    """The codec is told by the names of the files as written."""
    path = scratch(spark, "zstd")
    read(spark, d, NODES).select("doc_id", "title").write.option("compression", "zstd").parquet(path)
    got = spark.read.parquet(path).select(F.input_file_name().alias("f"))
    return got.agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("f").endswith(".zstd.parquet")).alias("zstd"))


@query("snk14_staging", "SELECT partition_date, 2 * count(*) AS n FROM graph_doc_nodes_daily WHERE partition_date IS NOT NULL GROUP BY 1")
def snk14(spark: S, d: str) -> DataFrame:
    """The same day staged twice lies there twice: no file hides another."""
    path, n = scratch(spark, "staging"), read(spark, d, NODES).filter("partition_date is not null").select("partition_date", "doc_id")
    sinks.stage(n, path, "partition_date")
    sinks.stage(n, path, "partition_date")
    return spark.read.parquet(path).groupBy("partition_date").agg(F.count(F.lit(1)).alias("n"))


@query("snk15_round_trips", "SELECT 'csv' AS form, n_nationkey, n_name FROM nation UNION ALL SELECT 'json', n_nationkey, n_name FROM nation UNION ALL SELECT 'text', NULL, n_name FROM nation")
def snk15(spark: S, d: str) -> DataFrame:
    n, root = read(spark, d, "nation").select("n_nationkey", "n_name"), scratch(spark, "forms")
    sinks.write_csv(n, f"{root}/csv")
    sinks.write_json_lines(n, f"{root}/json")
    sinks.write_lines(n, F.col("n_name"), f"{root}/text")
    one = readers.csv(spark, f"{root}/csv").select(F.lit("csv").alias("form"), F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name")
    two = readers.json_lines(spark, f"{root}/json", "n_nationkey int, n_name string").select(F.lit("json").alias("form"), "n_nationkey", "n_name")
    return one.unionByName(two).unionByName(spark.read.text(f"{root}/text").select(F.lit("text").alias("form"), F.lit(None).cast("int").alias("n_nationkey"), F.col("value").alias("n_name")))


@query("snk20_ledger", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def snk20(spark: S, d: str) -> DataFrame:
    """Events in a ledger, appended type by type."""
    path, e = scratch(spark, "ledger"), read(spark, d, "events").select("event_id", "event_type", "value")
    sinks.append_ledger(e.filter("event_type = 'purchase'"), path)
    sinks.append_ledger(e.filter("event_type <> 'purchase' or event_type is null"), path)
    return readers.json_lines(spark, path, "event_id long, event_type string, value double").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("snk21_markdown", "SELECT * FROM (VALUES (0, '# Regions'), (1, ''), (2, '| r_regionkey | r_name |'), (3, '| --- | --- |')) t(line, text) UNION ALL SELECT CAST(row_number() OVER (ORDER BY r_regionkey) + 3 AS INTEGER), '| ' || r_regionkey || ' | ' || r_name || ' |' FROM region")
def snk21(spark: S, d: str) -> DataFrame:
    return sinks.markdown_lines(read(spark, d, "region").select("r_regionkey", "r_name"), "Regions", ["r_regionkey"])


_SAMPLE = "SELECT length(concat_ws('', title, summary_text, body_text)) AS bytes FROM bronze_candidates WHERE CAST('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 4 = 0"


@query("snk25_measured_projection", f"SELECT partition_date, round(count(*) * (SELECT avg(bytes) FROM ({_SAMPLE})), 4) AS bytes FROM bronze_candidates GROUP BY 1")
def snk25_full(spark: S, d: str) -> DataFrame:
    """Size of every day from a sample that is measured, a quarter of the records by hash (the estimate's sample)."""
    b = read(spark, d, BRONZE)
    size = b.filter(ids.hash_bucket(F.col("doc_id"), 4) == 0).agg(F.count(F.lit(1)).alias("k"), F.sum(F.length(F.concat_ws("", "title", "summary_text", "body_text"))).alias("s"))
    n = b.groupBy("partition_date").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(size))  # one row
    return n.select("partition_date", F.round(sinks.projected_bytes(F.col("n").cast("double"), F.col("k"), F.col("s")), 4).alias("bytes"))


_STAMP = "coalesce(try_strptime(record_datetime, '%Y%m%d%H%M%S'), try_strptime(record_datetime, '%Y%m%d'), CAST(partition_date AS TIMESTAMP))"
_GEOS = "list_sort(list_distinct(regexp_extract_all(coalesce(v2_locations,''), '#([A-Z]{2})#', 1)))"


@query("prj01_documents", f"""SELECT doc_key, event_time, source_domain, title, summary_text, tone, geos, match_size FROM (SELECT substr(sha256(document_identifier), 1, 16) AS doc_key, {_STAMP} AS event_time, record_datetime,
    coalesce(lower(nullif(trim(source_domain), '')), nullif(regexp_replace(regexp_extract(lower(trim(document_identifier)), '^[a-z][a-z0-9+.-]*://([^/?#:@]+)', 1), '^www\\.', ''), ''), 'unknown') AS source_domain,
    coalesce(nullif(trim(title), ''), nullif(trim(regexp_replace(replace(replace(replace(replace(replace(regexp_extract(coalesce(gkg_extras,''), '(?is)<PAGE_TITLE>(.*?)</PAGE_TITLE>', 1), '&quot;', '"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\\s+', ' ', 'g')), '')) AS title,
    nullif(trim(summary_text), '') AS summary_text, TRY_CAST(nullif(regexp_extract(v2_tone, '^\\s*(-?\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE) AS tone, CASE WHEN len({_GEOS}) = 0 THEN 'GLOBAL' ELSE array_to_string({_GEOS}, ',') END AS geos,
    length(concat_ws(' | ', nullif(trim(v2_themes), ''), nullif(trim(all_names), ''), nullif(trim(v2_organizations), ''), coalesce(nullif(trim(title), ''), nullif(trim(regexp_replace(replace(replace(replace(replace(replace(regexp_extract(coalesce(gkg_extras,''), '(?is)<PAGE_TITLE>(.*?)</PAGE_TITLE>', 1), '&quot;', '"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\\s+', ' ', 'g')), '')), nullif(trim(summary_text), ''))) AS match_size
    FROM bronze_candidates) QUALIFY row_number() OVER (PARTITION BY doc_key ORDER BY record_datetime NULLS FIRST, source_domain NULLS FIRST, title NULLS FIRST) = 1""")
def prj01_documents(spark: S, d: str) -> DataFrame:
    """The whole projection from candidates to documents."""
    docs = graph.documents(read(spark, d, BRONZE))
    return docs.select("doc_key", "event_time", "source_domain", "title", "summary_text", "tone", F.array_join("geo_labels", ",").alias("geos"), F.length("match_text").alias("match_size"))


_ROOT = "array_to_string(list_slice(string_split(regexp_replace(regexp_replace(trim({0}), ':\\d+$', ''), '^www\\.', ''), '.'), -2, -1), '.')"


@query("jn22_root_fallback", f"""WITH q AS (SELECT lower(source_domain) AS dom, max(source_priority) AS prio FROM graph_doc_nodes_daily WHERE source_domain IS NOT NULL GROUP BY 1), r AS (SELECT {_ROOT.format('dom')} AS root, max(prio) AS prio FROM q GROUP BY 1),
  b AS (SELECT lower(trim(source_domain)) AS dom, count(*) AS n FROM bronze_candidates WHERE source_domain IS NOT NULL GROUP BY 1) SELECT b.dom, n, coalesce(q.prio, r.prio, 0) AS prio FROM b LEFT JOIN q ON q.dom = b.dom LEFT JOIN r ON r.root = {_ROOT.format('b.dom')}""")
def jn22_root(spark: S, d: str) -> DataFrame:
    """By domain, else by root domain, else zero."""
    q = read(spark, d, NODES).filter("source_domain is not null").groupBy(F.lower("source_domain").alias("dom")).agg(F.max("source_priority").alias("prio"))
    r = q.groupBy(text.root_domain(F.col("dom")).alias("root")).agg(F.max("prio").alias("by_root"))
    b = read(spark, d, BRONZE).filter("source_domain is not null").groupBy(F.lower(F.trim("source_domain")).alias("dom")).agg(F.count(F.lit(1)).alias("n"))
    j = b.join(q, "dom", "left").withColumn("root", text.root_domain(F.col("dom"))).join(r, "root", "left")
    return j.select("dom", "n", F.coalesce("prio", "by_root", F.lit(0)).alias("prio"))


EIGHT = {"bronze_candidates": "partition_date", "silver_factor_mentions": "bucket_time", "graph_doc_nodes_daily": "partition_date", "graph_build_partitions": "partition_date", "documents": "partition_date", "factor_dictionary": None, "entity_registry": None, "subject_labels": None}


@query("ag14_store_tables", " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n, {f'min({c})' if c else 'CAST(NULL AS DATE)'} AS first_day, {f'max({c})' if c else 'CAST(NULL AS DATE)'} AS last_day FROM {n}" for n, c in EIGHT.items()))
def ag14_full(spark: S, d: str) -> DataFrame:
    """Rows and days of every table of the store."""
    out = None
    for n, c in EIGHT.items():
        day = F.col(c) if c else F.lit(None).cast("date")
        one = read(spark, d, n).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))
        out = one if out is None else out.unionByName(one)
    return out


@query("ag39_observed_stage", "SELECT 'bronze' AS stage, count(*) AS rows_in, (SELECT count(*) FROM (SELECT DISTINCT doc_id FROM bronze_candidates)) AS rows_out FROM bronze_candidates")
def ag39_full(spark: S, d: str) -> DataFrame:
    """Rows in and out of a stage, counted while it runs and not in passes of their own; the time it takes is logged beside them."""
    import time

    before, after, began = Observation("rows in"), Observation("rows out"), time.time()
    df = read(spark, d, BRONZE).observe(before, F.count(F.lit(1)).alias("n")).select("doc_id").distinct().observe(after, F.count(F.lit(1)).alias("n"))
    df.write.mode("overwrite").parquet(scratch(spark, "stage"))
    rows = (before.get["n"], after.get["n"], round(1000 * (time.time() - began)))
    return spark.createDataFrame([("bronze", *rows)], "stage string, rows_in long, rows_out long, elapsed_ms long").drop("elapsed_ms")


_ST = SENTENCES.format("concat_ws(' || ', title, summary_text, substr(body_text, 1, 2000))")


@query("st09_top_sentences", f"SELECT doc_id, array_to_string(list_transform(list_slice(list_reverse_sort(list_filter(list_transform(list_distinct(s), lambda x : struct_pack(hits := {' + '.join(f'''CAST(contains({UP.format('x')}, '{t}') AS INTEGER)''' for t in TERMS)}, size := length(x), t := x)), lambda q : q.hits > 0)), 1, 5), lambda q : q.t), ' || ') AS best FROM (SELECT doc_id, min_by(s, len(s)) AS s FROM (SELECT DISTINCT doc_id, {_ST} AS s FROM bronze_candidates) GROUP BY 1)")
def st09_full(spark: S, d: str) -> DataFrame:
    """The five sentences of title, summary and body with most market terms; by hits, length and text, all descending."""
    b = read(spark, d, BRONZE).select("doc_id", text.sentences(F.concat_ws(" || ", "title", "summary_text", F.substring("body_text", 1, 2000))).alias("s")).distinct()
    b = b.groupBy("doc_id").agg(F.min_by("s", F.size("s")).alias("s"))
    hits = F.filter(F.transform(F.array_distinct("s"), lambda x: F.struct(text.term_hits(x, TERMS).alias("h"), F.length(x).alias("n"), x.alias("t"))), lambda q: q["h"] > 0)
    return b.select("doc_id", F.array_join(F.transform(F.slice(F.sort_array(hits, asc=False), 1, 5), lambda q: q["t"]), " || ").alias("best"))


@query("sc06_regexp_and_ifnull", "SELECT doc_id, regexp_matches(coalesce(v2_themes, ''), '(COURT|CRUDE)') AS hit, ifnull(title, 'none') AS title FROM bronze_candidates")
def sc06(spark: S, d: str) -> DataFrame:
    return read(spark, d, BRONZE).select("doc_id", F.coalesce("v2_themes", F.lit("")).rlike("(COURT|CRUDE)").alias("hit"), F.ifnull("title", F.lit("none")).alias("title"))


@query("sc13_engine_hash", "SELECT count(DISTINCT title) AS texts, count(DISTINCT title) AS hashes FROM graph_doc_nodes_daily")
def sc13(spark: S, d: str) -> DataFrame:
    """64-bit hashes tell texts apart; their values are the engine's own."""
    return read(spark, d, NODES).filter("title is not null").agg(F.count_distinct("title").alias("texts"), F.count_distinct(F.xxhash64("title")).alias("hashes"))


@query("sc18_current_time", "SELECT count(*) AS n, bool_and(now() > CAST(fetched_at AS TIMESTAMP)) AS past FROM documents WHERE fetched_at IS NOT NULL")
def sc18(spark: S, d: str) -> DataFrame:
    return read(spark, d, "documents").filter("fetched_at is not null").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.current_timestamp() > F.col("fetched_at").cast("timestamp")).alias("past"))


@query("sc20_half_even", "SELECT k, round_even(k * 0.5, 0) AS even, round(k * 0.5, 0) AS up FROM (SELECT DISTINCT l_linenumber * 3 - 10 AS k FROM lineitem)")
def sc20_full(spark: S, d: str) -> DataFrame:
    """Halves to the even neighbour, and away from zero."""
    k = read(spark, d, "lineitem").select((F.col("l_linenumber") * 3 - 10).alias("k")).distinct()
    return k.select("k", F.bround(F.col("k") * F.lit(0.5), 0).alias("even"), F.round(F.col("k") * F.lit(0.5), 0).alias("up"))


@query("sc27_null_functions", "SELECT doc_id, title IS NULL AS no_title, ifnull(source_type, '-') AS kind, nullif(source_priority, 1) AS priority, CAST(doc_id AS VARCHAR) AS as_text, CAST(source_priority AS DOUBLE) AS as_double FROM graph_doc_nodes_daily")
def sc27(spark: S, d: str) -> DataFrame:
    return read(spark, d, NODES).select("doc_id", F.isnull("title").alias("no_title"), F.ifnull("source_type", F.lit("-")).alias("kind"), F.nullif("source_priority", F.lit(1)).alias("priority"), F.col("doc_id").cast("string").alias("as_text"), F.col("source_priority").cast("double").alias("as_double"))


_SLUG = "trim(array_to_string(list_slice(list_filter(string_split_regex(regexp_replace(regexp_extract(regexp_replace(regexp_replace(regexp_replace(document_identifier, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '[?#].*$', ''), '/+$', ''), '([^/]*)$', 1), '\\.[A-Za-z]{2,5}$', ''), '[-_+]+'), lambda w : w <> '' AND NOT regexp_full_match(w, '\\d+')), 1, 16), ' '))"


@query("sc11_slug_words", f"SELECT doc_id, nullif({_SLUG}, '') AS slug FROM (SELECT DISTINCT doc_id, document_identifier FROM bronze_candidates)")
def sc11_full(spark: S, d: str) -> DataFrame:
    return read(spark, d, BRONZE).select("doc_id", "document_identifier").distinct().select("doc_id", text.slug_title(F.col("document_identifier")).alias("slug"))


@query("tx17_title_with_slug", f"SELECT doc_id, substr(coalesce(nullif(trim(title), ''), nullif({_SLUG}, ''), nullif(trim(market_context_text), ''), nullif(trim(relevant_text), '')), 1, 280) AS derived FROM (SELECT DISTINCT doc_id, title, document_identifier, market_context_text, relevant_text FROM bronze_candidates)")
def tx17_full(spark: S, d: str) -> DataFrame:
    """Title, else the words of the address, else context or text."""
    b = read(spark, d, BRONZE).select("doc_id", "title", "document_identifier", "market_context_text", "relevant_text").distinct()
    full = lambda c: F.nullif(F.trim(c), F.lit(""))
    return b.select("doc_id", F.substring(F.coalesce(full("title"), text.slug_title(F.col("document_identifier")), full("market_context_text"), full("relevant_text")), 1, 280).alias("derived"))


ASKED = ["COURT", "CRUDE", "PORT"]


@query("tx22_metadata_overlap", f"SELECT doc_id, round(0.45 * len(list_filter({ASKED}, lambda q : contains(' ' || form || ' ', ' ' || q || ' '))) / 3 + 0.35 * CASE source_type WHEN 'market_wrap' THEN 1.0 WHEN 'commodity_specialist' THEN 0.7 WHEN 'general_news' THEN 0.4 ELSE 0.2 END + 0.20 * least(1.0, coalesce(source_priority, 0) / 5.0), 6) AS score FROM (SELECT DISTINCT doc_id, source_type, source_priority, {FORM.format('title')} AS form FROM graph_doc_nodes_daily)")
def tx22_full(spark: S, d: str) -> DataFrame:
    """0.45 for the tags asked for, 0.35 for the kind of source, 0.20 for its priority."""
    n = read(spark, d, NODES).select("doc_id", "source_type", "source_priority", text.match_form(F.col("title")).alias("form")).distinct()
    kind = F.when(F.col("source_type") == "market_wrap", 1.0).when(F.col("source_type") == "commodity_specialist", 0.7).when(F.col("source_type") == "general_news", 0.4).otherwise(0.2)
    tags = text.cue_hits(F.col("form"), F.array(*map(F.lit, ASKED)))
    return n.select("doc_id", F.round(0.45 * tags / 3 + 0.35 * kind + 0.20 * F.least(F.lit(1.0), F.coalesce("source_priority", F.lit(0)) / 5.0), 6).alias("score"))


@query("tx32_widening_search", "WITH x AS (SELECT DISTINCT doc_id, CASE WHEN market_context_score >= 20 THEN 1 WHEN market_context_score >= 10 THEN 2 WHEN market_context_score >= 4 THEN 3 WHEN market_context_score >= 1 THEN 4 END AS phase, market_context_score AS s FROM graph_doc_nodes_daily), p AS (SELECT phase, sum(count(*)) OVER (ORDER BY phase) - count(*) AS before FROM x WHERE phase IS NOT NULL GROUP BY 1) SELECT doc_id, x.phase FROM x JOIN p ON p.phase = x.phase WHERE p.before < 60 QUALIFY row_number() OVER (ORDER BY x.phase, s DESC, doc_id) <= 60")
def tx32_full(spark: S, d: str) -> DataFrame:
    """Thresholds are lowered until sixty records are found; later phases are not asked."""
    n = read(spark, d, NODES).select("doc_id", F.col("market_context_score").alias("s")).distinct()
    return retrieval.widening(n, "s", [20, 10, 4, 1], 60, "doc_id").select("doc_id", "phase")
