"""Queries of the training-data operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.cut import materialize
from newsloom.llm import cap, cooccur, entities, history, leaks, mixing, neardup, subjects, terms

from newsloom.operators.packed import ALL_NAMES, ORGANIZATIONS, PERSONS, THEMES, unpack_values
from newsloom.queries import values_sql


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _themes(spark: SparkSession, d: str) -> DataFrame:
    got = unpack_values(_read(spark, d, "bronze_candidates"), [THEMES])
    return got.select("field", F.transform("values", lambda v: F.upper(v)).alias("items"))


def _factors(spark: SparkSession, d: str) -> DataFrame:
    silver = _read(spark, d, "silver_factor_mentions").filter(F.col("doc_id").isNotNull() & F.col("factor_label").isNotNull())
    sets = silver.groupBy("doc_id").agg(F.collect_set("factor_label").alias("items"))
    return sets.select(F.lit("factor_label").alias("field"), "items")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = cooccur.pair_counts(_themes(spark, d).unionByName(_factors(spark, d)), min_together=5)
    met = (F.col("n_ab") >= 0.002 * F.col("n_records")) & (F.col("n_ab") * F.col("n_records") >= 3 * F.col("n_a") * F.col("n_b"))
    return pairs.filter(met).select("field", "item_a", "item_b")


def p1_significance(spark: SparkSession, d: str) -> DataFrame:
    """Every pair of themes and of factors with its counts, lift and log-likelihood ratio."""
    got = cooccur.pair_counts(_themes(spark, d).unionByName(_factors(spark, d)))
    return got.withColumns({"lift": F.round("lift", 6), "llr": F.round("llr", 4)})


def _terms(spark: SparkSession, d: str) -> DataFrame:
    got = unpack_values(_read(spark, d, "bronze_candidates"), [THEMES, ALL_NAMES])
    rows = got.select("doc_id", "field", F.transform("values", lambda v: F.upper(F.regexp_replace(v, r"\s+", " "))).alias("terms"))
    return terms.term_frequencies(rows, ident="doc_id")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _terms(spark, d).filter(F.col("mark").isNotNull()).select("field", "term", "mark")


def p2_terms(spark: SparkSession, d: str) -> DataFrame:
    """Every term with its occurrences, document frequency and mark."""
    return _terms(spark, d)


def _stories(spark: SparkSession, d: str) -> DataFrame:
    b = _read(spark, d, "bronze_candidates").filter(F.btrim("summary_text") != "")
    return b.select(F.col("doc_id").alias("id"), neardup.title_words(F.col("title"), F.col("summary_text"), F.col("document_identifier")).alias("words"))


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    """One row per article with its story group, its representative and its number of links."""
    return neardup.near_duplicates(_stories(spark, d), similarity=0.6)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    got = materialize(p3_groups(spark, d).select("class_id", "id"), "groups")
    many = got.join(got.groupBy("class_id").count().filter("count > 1").select("class_id"), "class_id")
    other = many.select("class_id", F.col("id").alias("doc_id_b"))
    return many.join(other, "class_id").filter("id < doc_id_b").select(F.col("id").alias("doc_id_a"), "doc_id_b")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    got = materialize(unpack_values(_read(spark, d, "bronze_candidates"), [PERSONS, ORGANIZATIONS, ALL_NAMES]), "values")
    values = got.select(F.col("doc_id").alias("id"), "field", F.explode(F.array_distinct("values")).alias("value"))
    registry = _read(spark, d, "entity_registry").select("entity_id", F.col("entity_kind").alias("kind"), F.col("entity_name").alias("name"))
    kinds = {"v2_persons": ["person"], "v2_organizations": ["organization"], "all_names": ["person", "organization"]}
    return entities.variants(values, registry, kinds).withColumnRenamed("id", "doc_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    b = _read(spark, d, "bronze_candidates").select("doc_id", "partition_date", "document_identifier")
    got = history.deduplicate_batches(b, "partition_date", "doc_id", history.page_key(F.col("document_identifier")))
    got = got.filter(F.col("first_batch") < F.col("partition_date"))
    return got.select(F.least("doc_id", "first_id").alias("doc_id_a"), F.greatest("doc_id", "first_id").alias("doc_id_b")).distinct()


def p6_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Corpus texts by day against the days before: full copies and the share of paragraphs already accepted."""
    docs = _read(spark, d, "documents").select("doc_id", "partition_date", "text")
    return history.deduplicate_batches(docs, "partition_date", "doc_id", history.normal_text(F.col("text")), history.paragraphs(F.col("text")))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_ranked(spark, d).filter(~F.col("kept")).select("doc_id")


def p7_ranked(spark: SparkSession, d: str) -> DataFrame:
    """Every record of a site with its rank of the day and the cap it is held against."""
    nodes = _read(spark, d, "graph_doc_nodes_daily")
    return cap.over_cap(nodes, "partition_date", cap.site(F.col("source_domain")), [F.col("market_context_score"), F.col("source_priority")], "doc_id", share=1 / 25)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    got = leaks.leaks(_read(spark, d, "documents"), _read(spark, d, "eval_items"), tile=12)
    return got.filter(F.col("longest") >= 12).select("doc_id", "item_id")


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    """Every leaked item with its number of documents and the largest share of it that one of them holds."""
    got = leaks.leaks(_read(spark, d, "documents"), _read(spark, d, "eval_items"), tile=12)
    return got.groupBy("item_id").agg(F.count(F.lit(1)).alias("docs"), F.max("coverage").alias("coverage"), F.max("longest").alias("longest"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Sources that end short of their target though every record of theirs is in the mix as often as it may."""
    _, report = mixing.mix(_read(spark, d, "documents"), _read(spark, d, "mix_targets"))
    used_up = (F.col("docs") == 0) | (F.col("least_copies") >= F.col("max_repeats"))
    return report.filter(used_up & (F.col("mix_tokens") < F.col("needed_tokens"))).select("source")


def p9_plan(spark: SparkSession, d: str) -> DataFrame:
    """Copies of every record in the mix."""
    return mixing.mix(_read(spark, d, "documents"), _read(spark, d, "mix_targets"))[0]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_subjects(spark, d).select("doc_id", "subject")


def p10_subjects(spark: SparkSession, d: str) -> DataFrame:
    """Subjects of every document with the sentences they hold."""
    return subjects.subjects(_read(spark, d, "documents"), _read(spark, d, "subject_labels"), _read(spark, d, "subject_areas"))


_SITE = "nullif(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(source_domain), '\\s+', '', 'g'), ':[0-9]*$', ''), '\\.+$', ''), '^www\\.', ''), '')"
_RANKED = f"""SELECT n.doc_id, n.partition_date, contributor, CASE WHEN contributor IS NOT NULL THEN row_number() OVER (PARTITION BY n.partition_date, contributor ORDER BY market_context_score DESC NULLS LAST, source_priority DESC NULLS LAST, n.doc_id) END AS rank, cap
  FROM (SELECT DISTINCT doc_id, partition_date, {_SITE} AS contributor, market_context_score, source_priority FROM graph_doc_nodes_daily) n JOIN (SELECT partition_date, greatest(1, count(DISTINCT doc_id) // 25) AS cap FROM graph_doc_nodes_daily GROUP BY 1) c ON c.partition_date = n.partition_date"""
_THEMES = f"SELECT 'v2_themes' AS field, doc_id, list_distinct(list_transform({values_sql('v2_themes')}, lambda t : upper(t))) AS items FROM (SELECT DISTINCT doc_id, v2_themes FROM bronze_candidates)"
_FACTORS = "SELECT 'factor_label' AS field, doc_id, list_distinct(list(factor_label)) AS items FROM silver_factor_mentions WHERE factor_label IS NOT NULL GROUP BY doc_id"


def _pairs_sql(records: str) -> str:
    return f"""WITH r AS (SELECT * FROM ({records}) WHERE len(items) > 0), i AS (SELECT field, doc_id, unnest(items) AS item FROM r), c AS (SELECT field, item, count(*) AS n FROM i GROUP BY 1, 2), t AS (SELECT field, count(*) AS n FROM r GROUP BY 1),
  p AS (SELECT a.field, a.item AS item_a, b.item AS item_b, count(*) AS n_ab FROM i a JOIN i b ON a.field = b.field AND a.doc_id = b.doc_id AND a.item < b.item GROUP BY 1, 2, 3)
  SELECT p.field, item_a, item_b, n_ab, x.n AS n_a, y.n AS n_b, t.n AS n_records FROM p JOIN c x ON x.field = p.field AND x.item = item_a JOIN c y ON y.field = p.field AND y.item = item_b JOIN t ON t.field = p.field"""


_TERMS = f"""WITH v AS (SELECT 'v2_themes' AS field, doc_id, unnest({values_sql('v2_themes')}) AS x FROM (SELECT DISTINCT doc_id, v2_themes FROM bronze_candidates) UNION ALL SELECT 'all_names', doc_id, unnest({values_sql('all_names')}) FROM (SELECT DISTINCT doc_id, all_names FROM bronze_candidates)),
  n AS (SELECT field, count(DISTINCT doc_id) AS records FROM v GROUP BY 1), f AS (SELECT field, upper(regexp_replace(x, '\\s+', ' ', 'g')) AS term, count(*) AS occurrences, count(DISTINCT doc_id) AS docs FROM v GROUP BY 1, 2)
  SELECT f.field, term, occurrences, docs, records, CASE WHEN docs <= 2 THEN 'rare' WHEN docs >= records * 0.1 THEN 'common' END AS mark FROM f JOIN n ON n.field = f.field"""
# what chooses a page, in steps: without scheme, fragment and user; host; path; parameters that count, in order
_TRACKERS = ", ".join(f"'{t}'" for t in history.TRACKING)
_PLAIN = "url_decode(regexp_replace({0}, '%(2[35Ff6]|3[DdFf])', '%25\\1', 'g'))"
_PAGES = f"""SELECT doc_id, partition_date, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), '^.*@', ''), ':(80|443)?$', ''), '\\.+$', ''), '^www\\.', '')
    || regexp_replace(regexp_replace({_PLAIN.format("regexp_extract(rest, '^[^/?]*([^?]*)', 1)")}, '/{{2,}}', '/', 'g'), '/+$', '') || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS page
  FROM (SELECT doc_id, partition_date, rest, list_sort(list_distinct(list_filter(list_transform(string_split(regexp_extract(rest, '^[^?]*\\?(.*)$', 1), '&'), lambda x : {_PLAIN.format('x')}), lambda x : x <> '' AND lower(regexp_extract(x, '^[^=]*')) NOT IN ({_TRACKERS}) AND NOT starts_with(lower(x), 'utm_')))) AS q
    FROM (SELECT DISTINCT doc_id, partition_date, regexp_replace(regexp_replace(regexp_replace(trim(document_identifier), '^[A-Za-z][A-Za-z0-9+.-]*:', ''), '^//+', ''), '#.*$', '') AS rest FROM bronze_candidates
      WHERE doc_id IS NOT NULL AND partition_date IS NOT NULL AND trim(document_identifier) <> ''))"""
_RETURNS = f"""WITH p AS ({_PAGES}), f AS (SELECT page, min(struct_pack(d := partition_date, i := doc_id)) AS f FROM p GROUP BY 1)
  SELECT DISTINCT least(doc_id, f.f.i) AS doc_id_a, greatest(doc_id, f.f.i) AS doc_id_b FROM p JOIN f ON f.page = p.page WHERE f.f.d < partition_date AND f.f.i <> doc_id"""
_NORMAL = "trim(regexp_replace(lower({0}), '[\\s\u00a0]+', ' ', 'g'))"
_COVERAGE = f"""WITH d AS (SELECT DISTINCT doc_id, partition_date, text FROM documents WHERE partition_date IS NOT NULL AND text IS NOT NULL), t AS (SELECT doc_id, partition_date, {_NORMAL.format('text')} AS k FROM d),
  q AS (SELECT DISTINCT doc_id, partition_date, k FROM (SELECT doc_id, partition_date, {_NORMAL.format("unnest(regexp_split_to_array(text, '\\n+'))")} AS k FROM d) WHERE k <> ''),
  ft AS (SELECT k, min(struct_pack(d := partition_date, i := doc_id)) AS f FROM t WHERE k <> '' GROUP BY 1), fq AS (SELECT k, min(partition_date) AS day FROM q GROUP BY 1),
  n AS (SELECT doc_id, partition_date, count(*) AS parts, count(*) FILTER (fq.day < partition_date) AS seen_parts FROM q JOIN fq ON fq.k = q.k GROUP BY 1, 2)
  SELECT t.doc_id, t.partition_date, CASE WHEN f.i <> t.doc_id THEN f.i END AS first_id, CASE WHEN f.i <> t.doc_id THEN f.d END AS first_batch, coalesce(parts, 0) AS parts, coalesce(seen_parts, 0) AS seen_parts, seen_parts / parts AS coverage
  FROM t JOIN ft ON ft.k = t.k LEFT JOIN n ON n.doc_id = t.doc_id AND n.partition_date = t.partition_date"""
# word sets of the articles; links by shared words; groups by following links
_SETS = """SELECT doc_id, list_distinct(regexp_extract_all(lower(replace(concat_ws(' ', coalesce(title, url_decode(regexp_extract(regexp_replace(regexp_replace(document_identifier, '[?#].*$', ''), '/+$', ''), '([^/]*)$', 1))), summary_text), '&amp;', '&')), '[\\p{L}\\p{N}]+')) AS w
  FROM (SELECT DISTINCT doc_id, title, summary_text, document_identifier FROM bronze_candidates WHERE trim(summary_text) <> '')"""
_STORIES = f"""WITH RECURSIVE s AS (SELECT doc_id, w, len(w) AS n FROM ({_SETS}) WHERE len(w) > 0), x AS (SELECT doc_id, n, unnest(w) AS t FROM s), c AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS m, any_value(b.n) AS n, count(*) AS k FROM x a JOIN x b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2),
  l AS (SELECT a, b FROM c WHERE 10 * k >= 6 * (m + n - k)), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l), r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)"""
_GROUPS = f"""{_STORIES}, g AS (SELECT a AS doc_id, least(a, min(b)) AS class_id FROM r GROUP BY 1), p AS (SELECT list_sort(w) AS w, min(doc_id) AS representative FROM s GROUP BY 1), y AS (SELECT doc_id, representative FROM s JOIN p ON p.w = list_sort(s.w)),
  d AS (SELECT o.doc_id, count(DISTINCT t.representative) AS links FROM y o JOIN e ON e.a = o.representative JOIN y t ON t.doc_id = e.b AND t.representative <> o.representative GROUP BY 1)
  SELECT y.doc_id AS id, coalesce(class_id, y.doc_id) AS class_id, representative, coalesce(links, 0) AS links FROM y LEFT JOIN g ON g.doc_id = y.doc_id LEFT JOIN d ON d.doc_id = y.doc_id"""
_H = "CASE WHEN ({0}) > 0 THEN ({0}) * ln({0}) ELSE 0.0 END"
# sizes in characters: the margins are wide enough for any measure
_SHORT = """WITH d AS (SELECT nullif(lower(trim(source)), '') AS source, length(coalesce(text, '')) AS n FROM documents WHERE doc_id IS NOT NULL), t AS (SELECT lower(trim(source)) AS source, sum(target_share) AS share, max(max_repeats) AS most FROM mix_targets WHERE trim(source) <> '' GROUP BY 1), o AS (SELECT source, sum(n) AS own FROM d GROUP BY 1)
  SELECT t.source FROM t LEFT JOIN o ON o.source = t.source WHERE coalesce(share, 0) * (SELECT sum(n) FROM d) > coalesce(most, 0) * coalesce(own, 0)"""


def _significance_sql() -> str:
    h = lambda x: _H.format(f"CAST({x} AS DOUBLE)" if x.isalpha() else f"CAST({x.split()[0]} AS DOUBLE){x[len(x.split()[0]):]}")
    terms = " + ".join(h(x) for x in ("ab", "a - ab", "b - ab", "t - a - b + ab")) + " - " + " - ".join(h(x) for x in ("a", "t - a", "b", "t - b")) + " + " + h("t")
    pairs = f"SELECT *, n_ab AS ab, n_a AS a, n_b AS b, n_records AS t FROM ({_pairs_sql(_THEMES + ' UNION ALL ' + _FACTORS)})"
    return f"SELECT field, item_a, item_b, n_ab, n_a, n_b, n_records, round(n_ab * n_records / (CAST(n_a AS DOUBLE) * n_b), 6) AS lift, round(greatest(0.0, 2.0 * ({terms})), 4) AS llr FROM ({pairs})"


_GRAMS = "SELECT DISTINCT {id}, unnest(list_transform(range(1, greatest(1, len(w) - 10)), lambda i : array_to_string(w[i:i + 11], ' '))) AS g FROM (SELECT {id}, regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+') AS w FROM {table})"


def oracle_sql() -> dict[str, str]:
    grams = f"SELECT DISTINCT d.doc_id, i.item_id FROM ({_GRAMS.format(id='doc_id', text='text', table='documents')}) d JOIN ({_GRAMS.format(id='item_id', text='item_text', table='eval_items')}) i ON i.g = d.g"
    return {
        "p1_found": f"SELECT field, item_a, item_b FROM ({_pairs_sql(_THEMES + ' UNION ALL ' + _FACTORS)}) WHERE n_ab >= 5 AND n_ab >= 0.002 * n_records AND n_ab * n_records >= 3 * n_a * n_b",
        "p1_significance": _significance_sql(),
        "p2_found": f"SELECT field, term, mark FROM ({_TERMS}) WHERE mark IS NOT NULL",
        "p2_terms": _TERMS,
        "p3_found": f"{_STORIES} SELECT DISTINCT a AS doc_id_a, b AS doc_id_b FROM r WHERE a < b",
        "p3_groups": _GROUPS,
        "p6_found": _RETURNS,
        "p6_coverage": _COVERAGE,
        "p7_found": f"SELECT doc_id FROM ({_RANKED}) WHERE rank > cap",
        "p7_ranked": f"SELECT *, coalesce(rank <= cap, true) AS kept FROM ({_RANKED})",
        "p8_found": grams,
        "p9_found": _SHORT,
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": p1_found, "p1_significance": p1_significance, "p2_found": p2_found, "p2_terms": p2_terms, "p3_found": p3_found, "p3_groups": p3_groups, "p5_found": p5_found, "p6_found": p6_found, "p6_coverage": p6_coverage,
        "p7_found": p7_found, "p7_ranked": p7_ranked, "p8_found": p8_found, "p8_items": p8_items, "p9_found": p9_found, "p9_plan": p9_plan, "p10_found": p10_found, "p10_subjects": p10_subjects,
    }
