"""Queries of ordered rules: source kinds and weights, weak labels, decision bands, domain scores, review queues."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.catalog import query, read
from newsloom.catalog.relations import BRONZE, NODES, UP
from newsloom.cut import scratch
from newsloom.functions import ids, text
from newsloom.operators import ranks, rules
from newsloom.plans import graph

S = SparkSession


def case(ordered: list[tuple], value: int) -> str:
    """The CASE of an ordered rule table, for one of its values."""
    lit = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return "CASE " + " ".join(f"WHEN {r[0]} THEN {lit(r[value])}" for r in ordered) + " END"


# --- rule files and source kinds -------------------------------------------------------------------------

TAXONOMY = {"version": 1, "factors": [{"id": 1, "label": "legal", "patterns": ["COURT", "RULING", "JUDGE"]}, {"id": 2, "label": "trade", "patterns": ["PORT", "TARIFF", "FREIGHT"]}, {"id": 3, "label": "energy", "patterns": ["CRUDE", "REFINERY", "GAS"]}]}


@query("src15_rule_file", f"SELECT label, count(DISTINCT doc_id) AS docs FROM bronze_candidates b JOIN (VALUES " + ", ".join(f"('{f['label']}', '{p}')" for f in TAXONOMY["factors"] for p in f["patterns"]) + f") r(label, pattern) ON contains({UP.format('coalesce(b.v2_themes, chr(32))')}, pattern) GROUP BY 1")
def src15(spark: S, d: str) -> DataFrame:
    """A JSON rule file, read back and held against the themes."""
    path = scratch(spark, "rules")
    spark.createDataFrame([(json.dumps(TAXONOMY),)], "value string").coalesce(1).write.text(path)
    pairs = [(r["label"], p) for r in rules.load(spark, path, "factors") for p in r["patterns"]]
    docs = read(spark, d, BRONZE).select("doc_id", text.ascii_upper(F.coalesce("v2_themes", F.lit(" "))).alias("match_text"))
    return graph.match_factors(docs, pairs, "doc_id").groupBy(F.col("factor_label").alias("label")).agg(F.count_distinct("doc_id").alias("docs"))


KINDS = [
    ("source_domain like 'markets.%'", "market_wrap", 5), ("title like 'Update %' or title like 'UPDATE %'", "market_wrap", 4), ("contains(lower(title), 'weighs') or contains(lower(title), 'split over')", "company", 2),
    ("contains(lower(title), 'crude') or contains(lower(title), 'ore') or contains(lower(title), 'harvest')", "commodity", 3), ("source_domain is not null", "general", 1),
]
_NODES = "(SELECT DISTINCT doc_id, source_domain, title, source_type, source_priority, market_context_text, market_context_score, tone FROM graph_doc_nodes_daily)"


def nodes(spark: S, d: str) -> DataFrame:
    return read(spark, d, NODES).select("doc_id", "source_domain", "title", "source_type", "source_priority", "market_context_text", "market_context_score", "tone").distinct()


@query("prj11_source_kind", f"SELECT doc_id, {case(KINDS, 1)} AS kind, {case(KINDS, 2)} AS priority FROM {_NODES}")
def prj11(spark: S, d: str) -> DataFrame:
    return nodes(spark, d).select("doc_id", rules.first_match(KINDS, ["kind", "priority"], ["string", "int"]).alias("k")).select("doc_id", "k.*")


KNOWN = [("thinenwire.example", 0.9), ("steisreport.example", 0.85), ("rondzialledger.example", 0.8)]
BY_TYPE = [("source_type = 'market_wrap'", 0.75), ("source_type = 'commodity_specialist'", 0.7), ("source_type = 'company_specific'", 0.5), ("true", 0.45)]


@query("prj14_source_weight", f"SELECT doc_id, round(greatest(0.1, least(1.0, coalesce(k.weight, {case(BY_TYPE, 1)}) + 0.03 * (coalesce(source_priority, 1) - 1))), 6) AS weight FROM {_NODES} n LEFT JOIN (VALUES {', '.join(f'{k!r}' for k in KNOWN)}) k(dom, weight) ON k.dom = n.source_domain")
def prj14(spark: S, d: str) -> DataFrame:
    """Weight of a known site, else of its kind, raised by priority."""
    known = spark.createDataFrame(KNOWN, "source_domain string, known double")  # a configuration: three rows
    kind = rules.first_match(BY_TYPE, ["weight"], ["double"])["weight"]
    w = F.coalesce("known", kind) + 0.03 * (F.coalesce("source_priority", F.lit(1)) - 1)
    return nodes(spark, d).join(F.broadcast(known), "source_domain", "left").select("doc_id", F.round(rules.clamp(w, 0.1, 1.0), 6).alias("weight"))


TIERS = [("source_domain in ('thinenwire.example', 'steisreport.example')", 1), ("source_type = 'market_wrap'", 2), ("source_type = 'commodity_specialist'", 3), ("true", 4)]


@query("prj15_source_tier", f"SELECT {case(TIERS, 1)} AS tier, count(*) AS n FROM {_NODES} GROUP BY 1")
def prj15(spark: S, d: str) -> DataFrame:
    return nodes(spark, d).select(rules.first_match(TIERS, ["tier"], ["int"])["tier"].alias("tier")).groupBy("tier").agg(F.count(F.lit(1)).alias("n"))


QUALITY = [("source_domain like '%.example'", "reference", 0.8, "suffix"), ("source_domain like '%.test'", "trial", 0.4, "suffix"), ("source_domain like '%-online.%'", "aggregator", 0.3, "name"), ("source_domain is not null", "plain", 0.5, "none")]


@query("prj16_quality_tier", f"SELECT source_domain, {case(QUALITY, 1)} AS label, {case(QUALITY, 2)} AS prior, {case(QUALITY, 3)} AS basis FROM (SELECT DISTINCT source_domain FROM graph_doc_nodes_daily WHERE source_domain IS NOT NULL)")
def prj16(spark: S, d: str) -> DataFrame:
    domains = read(spark, d, NODES).filter("source_domain is not null").select("source_domain").distinct()
    return domains.select("source_domain", rules.first_match(QUALITY, ["label", "prior", "basis"], ["string", "double", "string"]).alias("q")).select("source_domain", "q.*")


_TWO = "SELECT source_domain, avg(market_context_score) / 10 AS a, avg(source_priority) / 5 AS b, avg(tone) AS tone FROM graph_doc_nodes_daily WHERE source_domain IS NOT NULL GROUP BY 1"


def two_scores(spark: S, d: str) -> DataFrame:
    g = read(spark, d, NODES).filter("source_domain is not null").groupBy("source_domain")
    return g.agg((F.avg("market_context_score") / 10).alias("a"), (F.avg("source_priority") / 5).alias("b"), F.avg("tone").alias("tone"))


@query("prj17_reference_score", f"SELECT source_domain, round(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN 0.6 * a + 0.4 * b ELSE coalesce(a, b, 0.5) END, 6) AS score FROM ({_TWO})")
def prj17(spark: S, d: str) -> DataFrame:
    both = F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 0.6 * F.col("a") + 0.4 * F.col("b")).otherwise(F.coalesce("a", "b", F.lit(0.5)))
    return two_scores(spark, d).select("source_domain", F.round(both, 6).alias("score"))


@query("prj18_final_score", f"SELECT source_domain, round(greatest(0.0, least(1.1, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN 0.6 * a + 0.4 * b ELSE coalesce(a, b, 0.5) END + 0.05 * sign(coalesce(tone, 0.0)))), 6) AS score FROM ({_TWO})")
def prj18(spark: S, d: str) -> DataFrame:
    both = F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 0.6 * F.col("a") + 0.4 * F.col("b")).otherwise(F.coalesce("a", "b", F.lit(0.5)))
    return two_scores(spark, d).select("source_domain", F.round(rules.clamp(both + 0.05 * F.signum(F.coalesce("tone", F.lit(0.0))), 0.0, 1.1), 6).alias("score"))


GATE = ["BANK", "PRICES", "INDEX", "TRADERS", "FORECAST"]


@query("prj20_context_gate", f"SELECT doc_id FROM {_NODES} WHERE source_priority >= 3 AND (source_type IN ('market_wrap') OR " + " OR ".join(f"contains({UP.format('coalesce(market_context_text, chr(32))')}, '{t}')" for t in GATE) + ")")
def prj20(spark: S, d: str) -> DataFrame:
    return nodes(spark, d).filter((F.col("source_priority") >= 3) & (F.col("source_type").isin("market_wrap") | text.contains_any(F.col("market_context_text"), GATE))).select("doc_id")


@query("prj10_point_id", "SELECT doc_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', ('0x' || substr(h, 17, 1))::INT % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS point_id FROM (SELECT doc_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(sha256(concat_ws('|', CAST(doc_id AS VARCHAR), CAST(partition_date AS VARCHAR), document_identifier)))) AS h FROM (SELECT DISTINCT doc_id, partition_date, document_identifier FROM graph_doc_nodes_daily))")
def prj10(spark: S, d: str) -> DataFrame:
    n = read(spark, d, NODES).select("doc_id", "partition_date", "document_identifier").distinct()
    key = F.sha2(F.concat_ws("|", F.col("doc_id").cast("string"), F.col("partition_date").cast("string"), "document_identifier"), 256)
    return n.select("doc_id", ids.uuid5(key).alias("point_id"))


# --- weak labels -----------------------------------------------------------------------------------------

LISTS = {"markets": ["SHARES", "BOND", "DIVIDEND", "BOURSE", "INVESTOR"], "law": ["COURT", "JUDGE", "VERDICT", "PLAINTIFF", "STATUTE"], "sport": ["LEAGUE", "STRIKER", "MEDAL", "STADIUM", "COACH"], "junk": ["COOKIES", "SUBSCRIBE", "ADVERTISEMENT", "SHARE THIS STORY"]}
WEAK = [
    ("size < 40", "drop_empty", 0.99, "too short"), ("junk >= 1 and markets + law + sport = 0 and size < 400", "drop_boilerplate", 0.9, "boilerplate only"), ("markets >= 2 and markets >= law and markets >= sport", "keep_markets", 0.9, "two market terms"),
    ("law >= 2 and law >= sport", "keep_law", 0.88, "two legal terms"), ("sport >= 2", "keep_sport", 0.86, "two sport terms"), ("markets + law + sport = 1", "review", 0.5, "one term"), ("lang is null", "review", 0.4, "language unknown"),
]
_HITS = "SELECT doc_id, text, lang, source, length(coalesce(text, '')) AS size, " + ", ".join("(" + " + ".join(f"CAST(contains({UP.format('coalesce(text, chr(32))')}, '{t}') AS INTEGER)" for t in ts) + f") AS {n}" for n, ts in LISTS.items()) + " FROM documents"
_WEAK = f"SELECT *, {case(WEAK, 1)} AS label, {case(WEAK, 2)} AS confidence FROM ({_HITS})"


def features(spark: S, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select("doc_id", "text", "lang", "source", F.length(F.coalesce("text", F.lit(""))).alias("size"))
    return docs.withColumns({n: text.term_hits(F.col("text"), ts) for n, ts in LISTS.items()})


def weak(spark: S, d: str) -> DataFrame:
    return features(spark, d).withColumn("w", rules.first_match(WEAK, ["label", "confidence"], ["string", "double"])).select("*", "w.label", "w.confidence").drop("w")


@query("cl03_weak_labels", f"SELECT doc_id, label, confidence, array_to_string(list_filter([{', '.join(f'''CASE WHEN {r[0]} THEN '{r[3]}' END''' for r in WEAK)}], lambda x : x IS NOT NULL), ';') AS reasons FROM ({_WEAK})")
def cl03(spark: S, d: str) -> DataFrame:
    """Label and confidence of the first rule that holds, and the reasons of all that do."""
    return weak(spark, d).select("doc_id", "label", "confidence", F.array_join(rules.all_matches([(r[0], r[3]) for r in WEAK]), ";").alias("reasons"))


_VOTES = "SELECT doc_id, max_by(subject, struct_pack(n := n, s := subject)) AS given FROM (SELECT doc_id, subject, count(*) AS n FROM subject_labels WHERE subject IS NOT NULL GROUP BY 1, 2) GROUP BY 1"


def votes(spark: S, d: str) -> DataFrame:
    n = read(spark, d, "subject_labels").filter("subject is not null").groupBy("doc_id", "subject").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("doc_id").agg(F.max_by("subject", F.struct("n", "subject")).alias("given"))


@query("cl04_corpus_build", f"SELECT w.doc_id, coalesce('keep_' || v.given, w.label) AS label, CASE WHEN v.given IS NULL AND (w.label = 'review' OR w.confidence < 0.6) THEN 'review' WHEN CAST('0x' || substr(sha256(CAST(w.doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 10 < 1 THEN 'valid' ELSE 'train' END AS part FROM ({_WEAK}) w LEFT JOIN ({_VOTES}) v ON v.doc_id = w.doc_id WHERE coalesce(v.given, w.label) IS NOT NULL")
def cl04(spark: S, d: str) -> DataFrame:
    """Weak labels under the raters' ones, uncertain ones apart, the rest split by hash."""
    j = weak(spark, d).join(votes(spark, d), "doc_id", "left")
    unsure = F.col("given").isNull() & ((F.col("label") == "review") | (F.col("confidence") < 0.6))
    out = j.select("doc_id", F.coalesce(F.concat(F.lit("keep_"), "given"), "label").alias("label"), F.when(unsure, "review").otherwise(ids.split_name(F.col("doc_id"))).alias("part"))
    return out.filter("label is not null")


PROFILE = [("junk_rate >= 0.5", "junk_heavy"), ("topic_rate >= 0.5 and n >= 5", "trusted"), ("topic_rate >= 0.2", "mixed"), ("true", "unknown")]
_PROFILE = f"SELECT source, count(*) AS n, round(avg(CASE WHEN junk >= 1 THEN 1.0 ELSE 0.0 END), 6) AS junk_rate, round(avg(CASE WHEN markets + law + sport >= 1 THEN 1.0 ELSE 0.0 END), 6) AS topic_rate FROM ({_HITS}) GROUP BY 1"


def profiles(spark: S, d: str) -> DataFrame:
    yes = lambda c: F.round(F.avg(F.when(F.expr(c), 1.0).otherwise(0.0)), 6)
    return features(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("n"), yes("junk >= 1").alias("junk_rate"), yes("markets + law + sport >= 1").alias("topic_rate"))


@query("cl05_source_profile", f"SELECT *, {case(PROFILE, 1)} AS profile FROM ({_PROFILE})")
def cl05(spark: S, d: str) -> DataFrame:
    return profiles(spark, d).withColumn("profile", rules.first_match(PROFILE, ["profile"], ["string"])["profile"])


REFINE = [("size < 40", "drop_empty"), ("junk >= 2 and best = 0", "drop_boilerplate"), ("best = 0", "review"), ("law = best and markets = best", "keep_law"), ("markets = best", "keep_markets"), ("law = best", "keep_law"), ("true", "keep_sport")]
_SCORED = f"SELECT *, greatest(markets, law, sport) AS best, round(greatest(markets, law, sport) / (1.0 + markets + law + sport), 6) AS score FROM ({_HITS})"


def rated(spark: S, d: str) -> DataFrame:
    best = F.greatest("markets", "law", "sport")
    return features(spark, d).withColumn("best", best).withColumn("score", F.round(F.col("best") / (1.0 + F.col("markets") + F.col("law") + F.col("sport")), 6))


@query("cl07_refined_label", f"SELECT doc_id, score, {case(REFINE, 1)} AS label FROM ({_SCORED})")
def cl07(spark: S, d: str) -> DataFrame:
    return rated(spark, d).select("doc_id", "score", rules.first_match(REFINE, ["label"], ["string"])["label"].alias("label"))


VETO = [("size < 200", "short"), ("lang is null", "language"), ("junk >= 1", "boilerplate"), ("markets > 0 and law > 0 and markets = law", "conflict")]
_VETOES = f"list_filter([{', '.join(f'''CASE WHEN {c} THEN '{n}' END''' for c, n in VETO)}], lambda x : x IS NOT NULL)"


@query("cl08_band_with_vetoes", f"SELECT doc_id, CASE WHEN score >= 0.6 AND len(v) = 0 THEN 'auto' WHEN score >= 0.6 OR (score >= 0.4 AND len(v) <= 1) THEN 'band' ELSE 'review' END AS band, array_to_string(v, ';') AS vetoes FROM (SELECT *, {_VETOES} AS v FROM ({_SCORED}))")
def cl08_full(spark: S, d: str) -> DataFrame:
    """Automatic only without a veto; one veto lowers a band, more send it to review."""
    v = rated(spark, d).withColumn("v", rules.all_matches(VETO))
    band = F.when((F.col("score") >= 0.6) & (F.size("v") == 0), "auto").when((F.col("score") >= 0.6) | ((F.col("score") >= 0.4) & (F.size("v") <= 1)), "band").otherwise("review")
    return v.select("doc_id", band.alias("band"), F.array_join("v", ";").alias("vetoes"))


@query("cl02_cluster_score_full", f"SELECT doc_id, round(least(1.0, 0.12 * f + 0.08 * t), 6) AS score FROM (SELECT doc_id, max(f) AS f, max(t) AS t FROM (SELECT doc_id, " + " + ".join(f"CAST(contains({UP.format('coalesce(title, chr(32))')}, '{x}') AS INTEGER)" for x in LISTS["law"] + LISTS["markets"]) + " AS f, len(list_filter(string_split(coalesce(v2_themes, ''), ';'), lambda x : starts_with(x, 'ECON_') OR starts_with(x, 'TRD_'))) AS t FROM bronze_candidates) GROUP BY 1)")
def cl02_full(spark: S, d: str) -> DataFrame:
    """Terms of the title and themes of the list, both halves of the score."""
    themes = F.size(F.filter(F.split(F.coalesce("v2_themes", F.lit("")), ";"), lambda x: x.startswith("ECON_") | x.startswith("TRD_")))
    b = read(spark, d, BRONZE).select("doc_id", text.term_hits(F.col("title"), LISTS["law"] + LISTS["markets"]).alias("f"), themes.alias("t")).groupBy("doc_id").agg(F.max("f").alias("f"), F.max("t").alias("t"))
    return b.select("doc_id", F.round(F.least(F.lit(1.0), 0.12 * F.col("f") + 0.08 * F.col("t")), 6).alias("score"))


ARCHETYPES = [("source_domain like 'markets.%'", "market_desk", 8.0), ("source_domain like '%wire.%'", "wire", 7.0), ("source_domain like '%ledger.%' or source_domain like '%report.%'", "business", 6.0), ("source_domain like '%-online.%'", "aggregator", 2.0), ("source_domain like '%tv.%'", "broadcast", 4.0), ("source_domain like '%gazette.%' or source_domain like '%daily.%'", "general", 5.0), ("true", "other", 3.0)]
_DOMAINS = "SELECT source_domain, count(*) AS n, avg(market_context_score) AS context, avg(source_priority) AS priority FROM graph_doc_nodes_daily WHERE source_domain IS NOT NULL GROUP BY 1"


def domains(spark: S, d: str) -> DataFrame:
    return read(spark, d, NODES).filter("source_domain is not null").groupBy("source_domain").agg(F.count(F.lit(1)).alias("n"), F.avg("market_context_score").alias("context"), F.avg("source_priority").alias("priority"))


@query("cl09_domain_archetype", f"SELECT source_domain, {case(ARCHETYPES, 1)} AS archetype FROM ({_DOMAINS})")
def cl09(spark: S, d: str) -> DataFrame:
    return domains(spark, d).select("source_domain", rules.first_match(ARCHETYPES, ["archetype", "mid"], ["string", "double"])["archetype"].alias("archetype"))


@query("cl10_domain_score", f"SELECT source_domain, round(greatest(0.0, least(10.0, CASE WHEN n >= 5 THEN 0.7 * mid + 0.3 * own ELSE mid END)), 6) AS score FROM (SELECT source_domain, n, {case(ARCHETYPES, 2)} AS mid, coalesce(context, 0.0) / 3 + coalesce(priority, 1.0) AS own FROM ({_DOMAINS}))")
def cl10(spark: S, d: str) -> DataFrame:
    """Middle of the archetype's band, blended with the domain's own record where that is long enough."""
    s = domains(spark, d).withColumn("mid", rules.first_match(ARCHETYPES, ["archetype", "mid"], ["string", "double"])["mid"]).withColumn("own", F.coalesce("context", F.lit(0.0)) / 3 + F.coalesce("priority", F.lit(1.0)))
    blend = F.when(F.col("n") >= 5, 0.7 * F.col("mid") + 0.3 * F.col("own")).otherwise(F.col("mid"))
    return s.select("source_domain", F.round(rules.clamp(blend, 0.0, 10.0), 6).alias("score"))


TEACH = [("n < 5", "review", 0.3, "small"), ("junk_rate >= 0.5", "drop", 0.9, "boilerplate"), ("topic_rate >= 0.6", "keep", 0.85, "on topic"), ("topic_rate <= 0.1", "drop", 0.7, "off topic"), ("true", "review", 0.5, "mixed")]


@query("cl11_cluster_teacher", f"SELECT source, {case(TEACH, 1)} AS label, {case(TEACH, 2)} AS confidence, {case(TEACH, 3)} AS reason FROM ({_PROFILE})")
def cl11(spark: S, d: str) -> DataFrame:
    """Label of a whole cluster (here a source) by its rates."""
    return profiles(spark, d).select("source", rules.first_match(TEACH, ["label", "confidence", "reason"], ["string", "double", "string"]).alias("t")).select("source", "t.*")


@query("cl12_row_teacher", f"""WITH t AS (SELECT source, {case(TEACH, 1)} AS cluster FROM ({_PROFILE})), m AS (SELECT coalesce(source, '') AS source, quantile_cont(size, 0.95) AS far FROM ({_HITS}) GROUP BY 1)
  SELECT w.doc_id, CASE WHEN v.given IS NOT NULL THEN 'keep' WHEN w.size > m.far THEN 'review' WHEN (t.cluster = 'keep' AND w.label LIKE 'drop%') OR (t.cluster = 'drop' AND w.label LIKE 'keep%') THEN 'review' ELSE t.cluster END AS label FROM ({_WEAK}) w LEFT JOIN t ON coalesce(t.source, '') = coalesce(w.source, '') LEFT JOIN m ON m.source = coalesce(w.source, '') LEFT JOIN ({_VOTES}) v ON v.doc_id = w.doc_id""")
def cl12(spark: S, d: str) -> DataFrame:
    """A row takes its cluster's label unless a rater decided, it lies far out, or its own rules contradict."""
    key = F.coalesce("source", F.lit(""))
    w = weak(spark, d).withColumn("k", key)
    far = ranks.quantiles(w.withColumn("size", F.col("size").cast("double")), "k", "size", [0.95], ["far"])
    t = cl11(spark, d).select(key.alias("k"), F.col("label").alias("cluster"))
    j = w.join(far, "k").join(t, "k").join(votes(spark, d), "doc_id", "left")
    clash = ((F.col("cluster") == "keep") & F.col("label").startswith("drop")) | ((F.col("cluster") == "drop") & F.col("label").startswith("keep"))
    return j.select("doc_id", F.when(F.col("given").isNotNull(), "keep").when(F.col("size") > F.col("far"), "review").when(F.coalesce(clash, F.lit(False)), "review").otherwise(F.col("cluster")).alias("label"))


STRATA = [("best = 1", "single_term"), ("markets > 0 and law > 0", "two_topics"), ("junk >= 1 and best >= 1", "topic_with_boilerplate"), ("score between 0.4 and 0.55", "boundary"), ("size > 1500", "long"), ("lang is null", "unknown_language")]


@query("cl13_eval_strata", f"SELECT stratum, count(*) AS n, min(doc_id) AS first FROM (SELECT doc_id, unnest(list_filter([{', '.join(f'''CASE WHEN {c} THEN '{n}' END''' for c, n in STRATA)}], lambda x : x IS NOT NULL)) AS stratum FROM ({_SCORED})) GROUP BY 1")
def cl13(spark: S, d: str) -> DataFrame:
    """Rows near a boundary, in every stratum whose condition they meet."""
    return rated(spark, d).select("doc_id", F.explode(rules.all_matches(STRATA)).alias("stratum")).groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))


@query("cl15_override_all", "SELECT d.source, coalesce(o.label, 'default') AS label FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL) d LEFT JOIN (SELECT source, CASE WHEN max_repeats >= 3 THEN 'repeat' ELSE 'once' END AS label FROM mix_targets) o ON o.source = d.source")
def cl15_full(spark: S, d: str) -> DataFrame:
    """Overrides for every source of the corpus; those without one are filled."""
    known = read(spark, d, "mix_targets").select("source", F.when(F.col("max_repeats") >= 3, "repeat").otherwise("once").alias("label"))
    every = read(spark, d, "documents").filter("source is not null").select("source").distinct()
    return every.join(known, "source", "left").fillna("default", ["label"])


@query("cl17_packets", "SELECT packet, count(*) AS n, min(doc_id) AS first, max(doc_id) AS last FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 200 + 1 AS packet FROM documents) GROUP BY 1")
def cl17(spark: S, d: str) -> DataFrame:
    """Consecutive packets of two hundred documents."""
    p = rules.packets(read(spark, d, "documents").select("doc_id"), [F.col("doc_id").asc()], 200)
    return p.groupBy("packet").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


# --- queues ----------------------------------------------------------------------------------------------


@query("st10_review_queue", f"SELECT doc_id, score, size FROM ({_SCORED}) WHERE size >= 40 ORDER BY abs(score - 0.5), size DESC, doc_id LIMIT 100")
def st10(spark: S, d: str) -> DataFrame:
    """The hundred least certain texts first (a report)."""
    return rated(spark, d).filter("size >= 40").orderBy(F.abs(F.col("score") - 0.5), F.desc("size"), "doc_id").select("doc_id", "score", "size").limit(100)


@query("st11_hard_negatives", f"SELECT s.doc_id, s.score FROM ({_SCORED}) s JOIN ({_VOTES}) v ON v.doc_id = s.doc_id WHERE v.given NOT IN ('markets', 'law', 'sport') AND s.score > 0 ORDER BY s.score DESC, s.doc_id LIMIT 50")
def st11(spark: S, d: str) -> DataFrame:
    """Texts scored high for a topic that raters gave to another one."""
    j = rated(spark, d).join(votes(spark, d), "doc_id").filter(~F.col("given").isin("markets", "law", "sport") & (F.col("score") > 0))
    return j.orderBy(F.desc("score"), "doc_id").select("doc_id", "score").limit(50)


QUEUES = [("score >= 0.6 and junk >= 1", "confident_with_boilerplate"), ("best = 0 and size > 800", "long_without_topic"), ("lang is null and best > 0", "topic_without_language")]


@query("st12_queues", f"SELECT queue, doc_id, place FROM (SELECT queue, doc_id, row_number() OVER (PARTITION BY queue ORDER BY size DESC, doc_id) AS place FROM (SELECT doc_id, size, unnest(list_filter([{', '.join(f'''CASE WHEN {c} THEN '{n}' END''' for c, n in QUEUES)}], lambda x : x IS NOT NULL)) AS queue FROM ({_SCORED}))) WHERE place <= 40")
def st12(spark: S, d: str) -> DataFrame:
    q = rated(spark, d).select("doc_id", "size", F.explode(rules.all_matches(QUEUES)).alias("queue"))
    return graph.top_per_group(q, ["queue"], [F.desc("size"), F.asc("doc_id")], 40).select("queue", "doc_id", F.col("rank").cast("long").alias("place"))


@query("st13_enrichment_targets", "SELECT doc_id, source_priority FROM (SELECT doc_id, max(source_priority) AS source_priority, bool_or(length(trim(coalesce(body_text, ''))) < 500 AND length(trim(coalesce(summary_text, ''))) < 160) AS thin FROM bronze_candidates GROUP BY 1) WHERE thin ORDER BY source_priority DESC NULLS LAST, doc_id LIMIT 100")
def st13(spark: S, d: str) -> DataFrame:
    """Articles with too little text, the most important sources first (a report)."""
    size = lambda c: F.length(F.trim(F.coalesce(c, F.lit(""))))
    b = read(spark, d, BRONZE).groupBy("doc_id").agg(F.max("source_priority").alias("source_priority"), F.bool_or((size("body_text") < 500) & (size("summary_text") < 160)).alias("thin"))
    return b.filter("thin").orderBy(F.desc_nulls_last("source_priority"), "doc_id").select("doc_id", "source_priority").limit(100)


@query("st14_next_batch", "SELECT d.doc_id FROM documents d WHERE d.text IS NOT NULL AND NOT EXISTS (SELECT 1 FROM subject_labels l WHERE l.doc_id = d.doc_id) ORDER BY sha256(CAST(d.doc_id AS VARCHAR)), d.doc_id LIMIT 200")
def st14(spark: S, d: str) -> DataFrame:
    """The next two hundred texts nobody has rated, in an order that does not depend on the run."""
    done = read(spark, d, "subject_labels").select("doc_id")
    return read(spark, d, "documents").filter("text is not null").select("doc_id").join(done, "doc_id", "left_anti").orderBy(F.sha2(F.col("doc_id").cast("string"), 256), "doc_id").limit(200)


@query("st15_claim_shortlist", "SELECT rater, doc_id, place FROM (SELECT rater, doc_id, row_number() OVER (PARTITION BY rater ORDER BY doc_id) AS place FROM (SELECT DISTINCT rater, doc_id FROM subject_labels WHERE rater IS NOT NULL)) WHERE place <= 10")
def st15(spark: S, d: str) -> DataFrame:
    return graph.top_per_group(read(spark, d, "subject_labels").filter("rater is not null").select("rater", "doc_id").distinct(), ["rater"], [F.asc("doc_id")], 10).select("rater", "doc_id", F.col("rank").cast("long").alias("place"))


@query("st16_adjudication", "SELECT doc_id, kinds, raters FROM (SELECT doc_id, count(DISTINCT subject) AS kinds, count(DISTINCT rater) AS raters FROM subject_labels WHERE subject IS NOT NULL GROUP BY 1) ORDER BY kinds DESC, raters DESC, doc_id LIMIT 50")
def st16(spark: S, d: str) -> DataFrame:
    """Texts whose raters disagree most."""
    g = read(spark, d, "subject_labels").filter("subject is not null").groupBy("doc_id").agg(F.count_distinct("subject").alias("kinds"), F.count_distinct("rater").alias("raters"))
    return g.orderBy(F.desc("kinds"), F.desc("raters"), "doc_id").limit(50)


# --- aggregates over labels and events ---------------------------------------------------------------------


@query("ag25_cluster_profile", f"""WITH f AS (SELECT *, lower(trim(coalesce(text, ''))) AS t FROM ({_HITS})), c AS (SELECT t, count(*) AS copies FROM f GROUP BY 1)
  SELECT source, count(*) AS n, count(DISTINCT f.t) AS texts, round(avg(CASE WHEN copies > 1 THEN 1.0 ELSE 0.0 END), 6) AS copy_rate, round(avg(size), 4) AS mean_size, min(size) AS least_size, max(size) AS most_size, round(avg(CASE WHEN size < 40 THEN 1.0 ELSE 0.0 END), 6) AS empty_rate,
    round(avg(CASE WHEN lang IS NULL THEN 1.0 ELSE 0.0 END), 6) AS no_lang_rate, count(DISTINCT lang) AS langs, round(avg(markets), 6) AS markets, round(avg(law), 6) AS law, round(avg(sport), 6) AS sport, round(avg(CASE WHEN junk > 0 THEN 1.0 ELSE 0.0 END), 6) AS junk_rate,
    round(avg(CASE WHEN markets > 0 AND law > 0 THEN 1.0 ELSE 0.0 END), 6) AS mixed_rate, round(avg(CASE WHEN markets + law + sport > 0 THEN 1.0 ELSE 0.0 END), 6) AS topic_rate FROM f JOIN c ON c.t = f.t GROUP BY 1""")
def ag25_full(spark: S, d: str) -> DataFrame:
    """Sizes, copies, languages and topics of every cluster (here a source)."""
    f = features(spark, d).withColumn("t", F.xxhash64(F.lower(F.trim(F.coalesce("text", F.lit(""))))))
    f = f.join(f.groupBy("t").agg(F.count(F.lit(1)).alias("copies")), "t")
    rate = lambda c: F.round(F.avg(F.when(F.expr(c), 1.0).otherwise(0.0)), 6)
    return f.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("t").alias("texts"), rate("copies > 1").alias("copy_rate"), F.round(F.avg("size"), 4).alias("mean_size"), F.min("size").alias("least_size"), F.max("size").alias("most_size"), rate("size < 40").alias("empty_rate"), rate("lang is null").alias("no_lang_rate"),
        F.count_distinct("lang").alias("langs"), *[F.round(F.avg(c), 6).alias(c) for c in ("markets", "law", "sport")], rate("junk > 0").alias("junk_rate"), rate("markets > 0 and law > 0").alias("mixed_rate"), rate("markets + law + sport > 0").alias("topic_rate"),
    )


@query("ag31_signal_ledger", "SELECT user_id, " + ", ".join(f"count(*) FILTER (event_type = '{e}') AS {e}" for e in ("click", "view", "purchase")) + ", CAST(sum(CASE event_type WHEN 'purchase' THEN 3 WHEN 'click' THEN 1 WHEN 'view' THEN 0 ELSE -1 END) AS BIGINT) AS balance FROM events GROUP BY 1")
def ag31_full(spark: S, d: str) -> DataFrame:
    """Signals of every user in columns, and their weighted, signed sum."""
    kind = F.col("event_type")
    weight = F.when(kind == "purchase", 3).when(kind == "click", 1).when(kind == "view", 0).otherwise(-1)
    return read(spark, d, "events").groupBy("user_id").agg(*[F.count_if(kind == e).alias(e) for e in ("click", "view", "purchase")], F.sum(weight).alias("balance"))


PROBES = {"legal": ["COURT", "JUDGE"], "trade": ["PORT", "FREIGHT"], "energy": ["CRUDE", "GAS"]}
_PROBED = " UNION ALL ".join(f"SELECT '{p}' AS probe, source_domain, doc_id, " + " + ".join(f"CAST(contains({UP.format('coalesce(title, chr(32))')}, '{t}') AS INTEGER)" for t in ts) + f" AS hits FROM {_NODES} WHERE source_domain IS NOT NULL" for p, ts in PROBES.items())


@query("ag32_probe_rates", f"SELECT source_domain, count(*) AS probed, round(avg(CASE WHEN hits > 0 THEN 1.0 ELSE 0.0 END), 6) AS hit_rate, CASE WHEN avg(CASE WHEN hits > 0 THEN 1.0 ELSE 0.0 END) >= 0.5 THEN 'specialist' WHEN max(hits) > 0 THEN 'general' ELSE 'none' END AS class FROM (SELECT *, row_number() OVER (PARTITION BY probe, source_domain ORDER BY hits DESC, doc_id) AS r FROM ({_PROBED})) WHERE r <= 6 GROUP BY 1")
def ag32_full(spark: S, d: str) -> DataFrame:
    """The six best titles of every site for every probe, and what they say of the site."""
    probes = F.array(*[F.struct(F.lit(p).alias("probe"), text.term_hits(F.col("title"), ts).alias("hits")) for p, ts in PROBES.items()])
    n = nodes(spark, d).filter("source_domain is not null").select("source_domain", "doc_id", F.explode(probes).alias("p")).select("source_domain", "doc_id", "p.*")
    top = graph.top_per_group(n, ["probe", "source_domain"], [F.desc("hits"), F.asc("doc_id")], 6)
    rate = F.avg(F.when(F.col("hits") > 0, 1.0).otherwise(0.0))
    return top.groupBy("source_domain").agg(F.count(F.lit(1)).alias("probed"), F.round(rate, 6).alias("hit_rate"), F.when(rate >= 0.5, "specialist").when(F.max("hits") > 0, "general").otherwise("none").alias("class"))


@query("ag38_batch_progress", "SELECT source, count(*) AS n, count(*) FILTER (good) AS completed, count(*) FILTER (bad AND NOT good) AS invalid, count(*) FILTER (NOT coalesce(good, false) AND NOT coalesce(bad, false)) AS remaining FROM (SELECT d.doc_id, d.source, coalesce(bool_or(l.subject IN (SELECT subject FROM subject_areas)), false) AS good, coalesce(bool_or(l.doc_id IS NOT NULL AND (l.subject IS NULL OR l.subject NOT IN (SELECT subject FROM subject_areas))), false) AS bad FROM documents d LEFT JOIN subject_labels l ON l.doc_id = d.doc_id GROUP BY 1, 2) GROUP BY 1")
def ag38_full(spark: S, d: str) -> DataFrame:
    """Labelling of every batch (here a source): rated with a known label, with none, or not yet."""
    areas = F.broadcast(read(spark, d, "subject_areas").select("subject").distinct().withColumn("known", F.lit(True)))  # 12 rows, fixed
    lab = read(spark, d, "subject_labels").join(areas, "subject", "left").groupBy("doc_id").agg(F.bool_or(F.coalesce("known", F.lit(False))).alias("good"))
    j = read(spark, d, "documents").select("doc_id", "source").join(lab, "doc_id", "left")
    return j.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("completed"), F.count_if(~F.col("good")).alias("invalid"), F.count_if(F.col("good").isNull()).alias("remaining"))


@query("tx11_specific_label", f"SELECT doc_id, {case([(' AND '.join(f'contains(t, {w!r})' for w in ws), n) for n, ws in (('canal traffic', ['CANAL', 'FREIGHTER']), ('court and bank', ['COURT', 'BANK']), ('crude supply', ['CRUDE']), ('court', ['COURT']))], 1)} AS label FROM (SELECT doc_id, {UP.format('''coalesce(title, '') || ' ' || coalesce(market_context_text, '')''')} AS t FROM {_NODES})")
def tx11(spark: S, d: str) -> DataFrame:
    """The first label all of whose terms a document holds."""
    t = text.ascii_upper(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("market_context_text", F.lit(""))))
    table = [("canal traffic", ["CANAL", "FREIGHTER"]), ("court and bank", ["COURT", "BANK"]), ("crude supply", ["CRUDE"]), ("court", ["COURT"])]
    ordered = [(" and ".join(f"contains(t, '{w}')" for w in ws), name) for name, ws in table]
    return nodes(spark, d).select("doc_id", t.alias("t")).select("doc_id", rules.first_match(ordered, ["label"], ["string"])["label"].alias("label"))


@query("tx14_enrichment_relevance", f"SELECT doc_id, round(6.0 * th + 8.0 * nh + CASE WHEN source_priority >= 4 THEN 5.0 ELSE 0.0 END + CASE WHEN length(trim(coalesce(title, ''))) = 0 THEN 3.0 ELSE 0.0 END - CASE WHEN contains(lower(coalesce(url, '')), '/live/') THEN 10.0 ELSE 0.0 END, 4) AS score FROM (SELECT doc_id, max(source_priority) AS source_priority, max(title) AS title, min(document_identifier) AS url, max(" + " + ".join(f"CAST(contains({UP.format('coalesce(title, chr(32))')}, '{t}') AS INTEGER)" for t in LISTS["markets"] + LISTS["law"]) + ") AS th, max(" + " + ".join(f"CAST(contains({UP.format('coalesce(v2_themes, chr(32))')}, '{t}') AS INTEGER)" for t in ("COURT", "CRUDE", "PORT")) + ") AS nh FROM bronze_candidates GROUP BY 1)")
def tx14(spark: S, d: str) -> DataFrame:
    """How much fetching an article's page would help: its terms and themes, its source, what it lacks, and what its address gives away."""
    b = read(spark, d, BRONZE).groupBy("doc_id").agg(F.max("source_priority").alias("source_priority"), F.max("title").alias("title"), F.min("document_identifier").alias("url"), F.max(text.term_hits(F.col("title"), LISTS["markets"] + LISTS["law"])).alias("th"), F.max(text.term_hits(F.col("v2_themes"), ["COURT", "CRUDE", "PORT"])).alias("nh"))
    s = 6.0 * F.col("th") + 8.0 * F.col("nh") + F.when(F.col("source_priority") >= 4, 5.0).otherwise(0.0) + F.when(F.length(F.trim(F.coalesce("title", F.lit("")))) == 0, 3.0).otherwise(0.0)
    return b.select("doc_id", F.round(s - F.when(F.contains(F.lower(F.coalesce("url", F.lit(""))), F.lit("/live/")), 10.0).otherwise(0.0), 4).alias("score"))
