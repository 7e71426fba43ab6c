"""Queries of the evidence plan: ranking, blocks, day narratives, explanations, claims."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.catalog import query, read
from newsloom.catalog.relations import BRONZE, NARR, NODES, SILVER, narratives
from newsloom.catalog.retrieval import FORM
from newsloom.functions import text
from newsloom.plans import evidence as ev
from newsloom.plans import graph

S = SparkSession
# Rule tables of these queries: words that stand in for an asset and its market, factors too broad to count without strong evidence, assets a factor reaches, chains.
CHANNEL, MARKET = ("MARKET", "PRICES", "TRADERS", "SUPPLY"), ("BANK", "INDEX", "BOARD")
GENERIC = ("price_pressure", "street_protest")
TARGETS = {"crude_supply": ["macro", "resources", "transport"], "rate_path": ["corporate", "credit", "macro"], "port_congestion": ["resources", "transport"], "refinery_outage": ["macro", "resources", "transport"], "court_ruling": ["corporate", "policy"]}
CHAINS = {"crude_supply": "supply > prices > inflation", "rate_path": "rates > credit > growth", "refinery_outage": "outage > fuel > prices", "port_congestion": "ports > freight > prices"}

_list = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
_hits = lambda form, cues: f"len(list_filter({cues}, lambda q : contains(' ' || {form} || ' ', ' ' || q || ' ')))"
_bonus = lambda a, b: f"CASE source_type WHEN 'market_wrap' THEN {a} WHEN 'commodity_specialist' THEN {b} ELSE 0.0 END"
_has = lambda c, w: f"CASE WHEN length(coalesce({c}, '')) > 0 THEN {w} ELSE 0.0 END"

STEPS = {
    "w": "SELECT *, list_filter(string_split(phrase, ' '), lambda x : length(x) >= 4) AS mechanism FROM (SELECT factor_label AS factor, factor_group AS asset, upper(replace(factor_label, '_', ' ')) AS phrase FROM factor_dictionary)",
    "a": "SELECT asset, list_distinct(flatten(list(mechanism))) AS asset_cues FROM w GROUP BY 1",
    "m": "SELECT doc_id, factor_label AS factor, max(classification_confidence) AS confidence FROM silver_factor_mentions WHERE factor_label IS NOT NULL GROUP BY 1, 2",
    "n": "SELECT DISTINCT doc_id, partition_date AS day, document_identifier AS url, source_domain, source_type, title, market_context_text AS context, market_context_score AS context_score, event_time FROM graph_doc_nodes_daily",
    "b": "SELECT doc_id, min(summary_text) AS summary FROM bronze_candidates GROUP BY 1",
    "e": f"""SELECT *, {FORM.format('title')} AS title_form, {FORM.format("concat_ws(' ', context, summary)")} AS text_form, {FORM.format("concat_ws(' ', title, summary, context)")} AS all_form
      FROM (SELECT n.*, m.factor, m.confidence, b.summary, w.asset, w.phrase, w.mechanism, a.asset_cues, list_distinct(list_concat([w.phrase], w.mechanism)) AS factor_cues
        FROM m JOIN w ON w.factor = m.factor JOIN a ON a.asset = w.asset JOIN n ON n.doc_id = m.doc_id LEFT JOIN b ON b.doc_id = m.doc_id)""",
    "h": f"SELECT *, {_hits('title_form', 'factor_cues')} AS title_factor, {_hits('text_form', 'factor_cues')} AS text_factor, {_hits('title_form', 'asset_cues')} AS title_asset, {_hits('text_form', 'asset_cues')} AS text_asset FROM e",
    "r": f"""SELECT *, round(8.0 * title_factor + 4.0 * text_factor + 6.0 * title_asset + 3.0 * text_asset + {_bonus(3.0, 2.0)} + 2.0 * coalesce(confidence, 0.0) + {_has('title', 1.0)} + {_has('summary', 0.5)} + {_has('context', 0.5)}
      - CASE WHEN title_factor + text_factor + title_asset + text_asset = 0 THEN 5.0 ELSE 0.0 END, 3) AS relevance FROM h""",
    "once": "SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY url, asset, factor ORDER BY relevance DESC NULLS LAST, confidence DESC NULLS LAST, event_time DESC NULLS LAST, url DESC NULLS LAST, doc_id) AS k FROM r) WHERE k = 1",
    "st": f"""SELECT *, {_hits('all_form', 'asset_cues')} AS asset_hits, {_hits('all_form', '[phrase]')} AS phrase_hits, {_hits('all_form', 'mechanism')} AS mechanism_hits, {_hits('all_form', _list(CHANNEL))} AS channel_hits,
      {_hits('all_form', _list(MARKET))} AS market_hits, {_hits('title_form', '[phrase]')} AS title_phrase FROM top""",
    "s0": f"""SELECT *, round(3.0 * asset_hits + 2.0 * phrase_hits + 2.0 * mechanism_hits + 2.5 * (channel_hits + market_hits) + 2.0 * (title_asset + title_phrase) + {_bonus(4.0, 2.5)} + 0.3 * coalesce(context_score, 0.0) + relevance + coalesce(confidence, 0.0), 3) AS strength,
      CASE WHEN asset_hits > 0 AND (phrase_hits > 0 OR mechanism_hits >= 2) THEN 'direct' WHEN channel_hits > 0 AND market_hits > 0 AND (phrase_hits > 0 OR mechanism_hits >= 1 OR channel_hits >= 2) THEN 'proxy' ELSE 'weak' END AS mode FROM st""",
    "s": "SELECT *, CASE WHEN mode <> 'weak' AND strength >= 24 THEN 'strong' WHEN mode <> 'weak' AND strength >= 16 THEN 'moderate' ELSE 'weak' END AS grade FROM s0",
    "top": "SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY asset, day, factor ORDER BY relevance DESC NULLS LAST, confidence DESC NULLS LAST, event_time DESC NULLS LAST, url DESC NULLS LAST, doc_id) AS k FROM r WHERE relevance > 0 AND title_asset + text_asset > 0) WHERE k <= 6",
    "x": f"""SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY asset, day, url ORDER BY assignment DESC, factor, doc_id) AS k FROM (SELECT *, round(strength + 6.0 * mechanism_hits + 2.0 * phrase_hits - CASE WHEN factor IN {tuple(GENERIC)} THEN 12.0 ELSE 0.0 END
      + CASE mode WHEN 'direct' THEN 8.0 WHEN 'proxy' THEN 4.0 ELSE 0.0 END, 3) AS assignment FROM s WHERE length(url) > 0)) WHERE k = 1""",
    "ns": "SELECT asset, day, factor, CAST(count(DISTINCT doc_id) AS DOUBLE) AS narrative_score FROM e GROUP BY 1, 2, 3",
    "g": "SELECT *, row_number() OVER (PARTITION BY asset, day, factor ORDER BY CASE grade WHEN 'strong' THEN 2 ELSE 1 END DESC, strength DESC, confidence DESC NULLS LAST, url) AS rk FROM x WHERE grade <> 'weak'",
    "bl0": f"""SELECT asset, day, factor, max(CASE WHEN rk = 1 THEN grade END) AS best_grade, max(CASE WHEN rk = 1 THEN strength END) AS best_score, max(CASE WHEN rk = 1 THEN mode END) AS mode, count(*) AS docs,
      coalesce(list_sort(list(DISTINCT source_domain) FILTER (source_domain IS NOT NULL)), []) AS sources, list_sort(list(DISTINCT url)) AS urls, count(*) FILTER (source_type = 'market_wrap') AS wraps, count(*) FILTER (source_type = 'commodity_specialist') AS specialists,
      count(*) FILTER (mode = 'direct') AS direct, count(*) FILTER (mode = 'proxy') AS proxy, sum({_bonus(3.0, 1.5)}) AS kind_bonus, round(sum(0.25 * coalesce(context_score, 0.0)), 6) AS context_bonus FROM g WHERE rk <= 2 GROUP BY 1, 2, 3""",
    "bl1": f"""SELECT bl0.*, coalesce(ns.narrative_score, 0.0) AS narrative_score FROM bl0 LEFT JOIN ns ON ns.asset = bl0.asset AND ns.day = bl0.day AND ns.factor = bl0.factor WHERE bl0.factor NOT IN {tuple(GENERIC)} OR best_grade = 'strong'""",
    "bl2": f"""SELECT *, round(best_score + 0.02 * narrative_score + CASE mode WHEN 'direct' THEN 12.0 WHEN 'proxy' THEN 6.0 ELSE 0.0 END + kind_bonus + context_bonus - CASE WHEN factor IN {tuple(GENERIC)} THEN 18.0 ELSE 0.0 END, 3) AS block_rank,
      round(best_score + narrative_score / 100.0, 6) AS weight, {{conf}} AS confidence FROM bl1""",
    "bl": "SELECT *, row_number() OVER (PARTITION BY asset, day ORDER BY block_rank DESC, factor) AS place FROM bl2",
    "sta": f"""SELECT o.asset, o.day, coalesce(blocks, 0) AS blocks, primary_factor, coalesce(direct, 0) AS direct, coalesce(proxy, 0) AS proxy, coalesce(chains, 0) AS chains FROM (SELECT DISTINCT asset, day FROM e) o
      LEFT JOIN (SELECT asset, day, count(*) AS blocks, max(CASE WHEN place = 1 THEN factor END) AS primary_factor, count(*) FILTER (mode = 'direct') AS direct, count(*) FILTER (mode = 'proxy') AS proxy, count(*) FILTER (factor IN {tuple(CHAINS)}) AS chains FROM bl GROUP BY 1, 2) p ON p.asset = o.asset AND p.day = o.day""",
    "dn": """SELECT *, len(sources) AS source_diversity, {conf} AS confidence FROM (SELECT day, factor, round(sum(weight), 3) AS score, list_sort(list(DISTINCT asset)) AS assets, list_sort(list_distinct(flatten(list(sources)))) AS sources,
      list_slice(list_sort(list_distinct(flatten(list(urls)))), 1, 3) AS urls, sum(wraps) AS wraps, sum(specialists) AS specialists, sum(direct) AS direct, sum(proxy) AS proxy FROM bl GROUP BY 1, 2)""",
    "tg": "SELECT * FROM (VALUES " + ", ".join(f"('{k}', {_list(v)})" for k, v in TARGETS.items()) + ") t(factor, targets)",
    "obs": "SELECT day, list_sort(list(DISTINCT asset)) AS observed, coalesce(list_sort(list(DISTINCT asset) FILTER (blocks > 0)), []) AS supported FROM sta GROUP BY 1",
    "im0": "SELECT dn.*, list_sort(list_filter(list_distinct(coalesce(targets, assets)), lambda q : list_contains(observed, q))) AS explained, list_sort(list_filter(list_distinct(coalesce(targets, assets)), lambda q : list_contains(supported, q))) AS overlap FROM dn JOIN obs ON obs.day = dn.day LEFT JOIN tg ON tg.factor = dn.factor",
    "im": "SELECT *, round(10.0 * len(explained) + 5.0 * len(overlap) + 2.0 * source_diversity + score, 3) AS impact FROM im0",
    "hd": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY impact DESC, source_diversity DESC, factor) AS rk FROM im) WHERE rk <= 6",
    "cb": """SELECT day, [factor] AS fs, explained AS ex, overlap AS ov, source_diversity AS sources, 0.0 + score AS score FROM hd
      UNION ALL SELECT a.day, list_sort([a.factor, b.factor]), a.explained || b.explained, a.overlap || b.overlap, a.source_diversity + b.source_diversity, 0.0 + a.score + b.score FROM hd a JOIN hd b ON a.day = b.day AND a.rk < b.rk
      UNION ALL SELECT a.day, list_sort([a.factor, b.factor, c.factor]), a.explained || b.explained || c.explained, a.overlap || b.overlap || c.overlap, a.source_diversity + b.source_diversity + c.source_diversity, 0.0 + a.score + b.score + c.score
        FROM hd a JOIN hd b ON a.day = b.day AND a.rk < b.rk JOIN hd c ON c.day = b.day AND b.rk < c.rk""",
    "cs": "SELECT cb.day, fs, sources, score, list_sort(list_distinct(ex)) AS explained, list_sort(list_distinct(ov)) AS direct, s FROM cb JOIN (SELECT day, list(struct_pack(asset := asset, pf := primary_factor, blocks := blocks) ORDER BY asset) AS s FROM sta GROUP BY 1) z ON z.day = cb.day",
    "cm": "SELECT *, list_transform(list_filter(s, lambda q : list_contains(explained, q.asset) OR coalesce(list_contains(fs, q.pf), false)), lambda q : q.asset) AS matched FROM cs",
    "cx": "SELECT *, list_filter(list_transform(list_filter(s, lambda q : q.blocks > 0), lambda q : q.asset), lambda q : NOT list_contains(matched, q)) AS contradictions, list_filter(list_transform(s, lambda q : q.asset), lambda q : NOT list_contains(explained, q) AND NOT list_contains(matched, q)) AS unresolved FROM cm",
    "ft": "SELECT *, len(s) AS assets, round(25.0 * len(matched) + 8.0 * len(explained) + 5.0 * len(direct) + 1.5 * least(sources, 12) + score - 15.0 * len(contradictions) - 6.0 * len(unresolved) - 4.0 * (len(fs) - 1), 3) AS fit FROM cx",
    "bf": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY fit DESC, len(matched) DESC, len(contradictions), len(unresolved), len(direct) DESC, array_to_string(fs, ',')) AS rk FROM ft) WHERE rk = 1",
}
_CONF = "CASE WHEN len(sources) >= 2 AND (wraps >= 1 OR specialists >= 1 OR 2 * direct + proxy >= 2) THEN 'high' WHEN len(sources) >= 2 OR wraps >= 1 OR specialists >= 1 OR 2 * direct + proxy >= 1 THEN 'medium' ELSE 'low' END"
ORDER = list(STEPS)
ORDER.insert(ORDER.index("st"), ORDER.pop(ORDER.index("top")))


def steps(upto: str, final: str) -> str:
    """The SQL of the plan up to a step, and what is asked of it."""
    names = ORDER[: ORDER.index(upto) + 1]
    return "WITH " + ",\n ".join(f"{n} AS ({STEPS[n].replace('{conf}', _CONF)})" for n in names) + "\n" + final


def mentioned(spark: S, d: str) -> DataFrame:
    """Document x asset x factor with texts and cues, each document once."""
    cues = F.broadcast(ev.rule_cues(read(spark, d, "factor_dictionary").select(F.col("factor_label").alias("factor"), F.col("factor_group").alias("asset"))))  # the rules: 40 rows, fixed
    m = read(spark, d, SILVER).filter("factor_label is not null").groupBy("doc_id", F.col("factor_label").alias("factor")).agg(F.max("classification_confidence").alias("confidence"))
    n = read(spark, d, NODES).select("doc_id", F.col("partition_date").alias("day"), F.col("document_identifier").alias("url"), "source_domain", "source_type", "title", F.col("market_context_text").alias("context"), F.col("market_context_score").alias("context_score"), "event_time").distinct()
    b = read(spark, d, BRONZE).groupBy("doc_id").agg(F.min("summary_text").alias("summary"))
    docs = ev.forms(n.join(b, "doc_id", "left"))  # texts are prepared once a document, before they meet its factors
    return m.join(docs, "doc_id").join(cues, "factor")


def scored(spark: S, d: str) -> DataFrame:
    return ev.relevance(mentioned(spark, d))


def best(spark: S, d: str) -> DataFrame:
    """The six most relevant documents of every asset, day and factor that name the asset, with their strength."""
    some = scored(spark, d).filter((F.col("relevance") > 0) & (F.col("title_asset") + F.col("text_asset") > 0))
    top = graph.top_per_group(some, ["asset", "day", "factor"], [F.desc_nulls_last(c) for c in ev.BEST] + [F.asc("doc_id")], 6).drop("rank")
    return ev.strength(top, CHANNEL, MARKET)


def all_blocks(spark: S, d: str) -> DataFrame:
    base = read(spark, d, SILVER).filter("factor_label is not null").select("doc_id", F.col("factor_label").alias("factor")).distinct()
    dim = F.broadcast(read(spark, d, "factor_dictionary").select(F.col("factor_label").alias("factor"), F.col("factor_group").alias("asset")))
    days = read(spark, d, NODES).select("doc_id", F.col("partition_date").alias("day")).distinct()
    counts = base.join(dim, "factor").join(days, "doc_id").groupBy("asset", "day", "factor").agg(F.count_distinct("doc_id").cast("double").alias("narrative_score"))
    return ev.blocks(ev.assigned(best(spark, d), GENERIC), counts, GENERIC)


def all_states(spark: S, d: str, block: DataFrame) -> DataFrame:
    dim = F.broadcast(read(spark, d, "factor_dictionary").select("factor_label", F.col("factor_group").alias("asset")))
    days = read(spark, d, NODES).select("doc_id", F.col("partition_date").alias("day")).distinct()
    seen = read(spark, d, SILVER).select("doc_id", "factor_label").distinct().join(dim, "factor_label").join(days, "doc_id")
    return ev.states(block, seen, list(CHAINS))


def all_impacts(spark: S, d: str) -> tuple[DataFrame, DataFrame]:
    block = all_blocks(spark, d)
    state = all_states(spark, d, block)
    return ev.impacts(ev.day_narratives(block), state, spark.createDataFrame(list(TARGETS.items()), "factor string, targets array<string>")), state


joined = lambda c: F.array_join(c, ",")
_j = lambda c: f"array_to_string({c}, ',')"


@query("tx04_cue_lists", steps("a", f"SELECT w.factor, {_j('list_sort(list_distinct(list_concat([phrase], mechanism)))')} AS factor_cues, {_j('list_sort(asset_cues)')} AS asset_cues FROM w JOIN a ON a.asset = w.asset"))
def tx04(spark: S, d: str) -> DataFrame:
    c = ev.rule_cues(read(spark, d, "factor_dictionary").select(F.col("factor_label").alias("factor"), F.col("factor_group").alias("asset")))
    return c.select("factor", joined(F.array_sort("factor_cues")).alias("factor_cues"), joined(F.array_sort("asset_cues")).alias("asset_cues"))


@query("tx08_asset_factor_relevance", steps("e", f"SELECT doc_id, asset, factor, CASE WHEN x = 0 AND y = 0 THEN 0.0 ELSE 2.0 * x + y END AS relevance FROM (SELECT doc_id, asset, factor, {_hits('all_form', 'asset_cues')} AS x, {_hits('all_form', 'factor_cues')} AS y FROM e)"))
def tx08_full(spark: S, d: str) -> DataFrame:
    """Twice the asset's cues and the factor's cues, by document."""
    x, y = text.cue_hits(F.col("all_form"), F.col("asset_cues")), text.cue_hits(F.col("all_form"), F.col("factor_cues"))
    return mentioned(spark, d).select("doc_id", "asset", "factor", (2.0 * x + y).alias("relevance"))


@query("tx09_document_relevance", steps("r", "SELECT doc_id, asset, factor, title_factor, text_factor, title_asset, text_asset, relevance FROM r"))
def tx09(spark: S, d: str) -> DataFrame:
    return scored(spark, d).select("doc_id", "asset", "factor", *[F.col(c).cast("long").alias(c) for c in ("title_factor", "text_factor", "title_asset", "text_asset")], "relevance")


_RERANK = "SELECT asset, factor, doc_id, relevance, rank FROM (SELECT *, max(relevance) OVER (PARTITION BY {0}) AS most FROM (SELECT *, row_number() OVER (PARTITION BY {0} ORDER BY relevance DESC NULLS LAST, confidence DESC NULLS LAST, event_time DESC NULLS LAST, url DESC NULLS LAST, doc_id, factor) AS rank FROM once) WHERE rank <= {1}) WHERE relevance > 0 OR most <= 0"


@query("st06_evidence_rerank", steps("once", _RERANK.format("asset, factor", 5)))
def st06(spark: S, d: str) -> DataFrame:
    return ev.rerank(scored(spark, d), ["asset", "factor"], 5).select("asset", "factor", "doc_id", "relevance", F.col("rank").cast("long").alias("rank"))


@query("st07_bulk_evidence", steps("once", _RERANK.format("asset", 10)))
def st07(spark: S, d: str) -> DataFrame:
    """The ten best documents of every asset, in one pass."""
    return ev.rerank(scored(spark, d), ["asset"], 10).select("asset", "factor", "doc_id", "relevance", F.col("rank").cast("long").alias("rank"))


@query("ex01_explain_move", steps("once", f"""SELECT 'narrative' AS part, asset_label AS asset, factor_label AS item, score FROM (SELECT *, row_number() OVER (PARTITION BY asset_label ORDER BY score DESC NULLS LAST, factor_label) AS k FROM ({NARR})) WHERE k <= 5
  UNION ALL SELECT 'day', asset, CAST(day AS VARCHAR), CAST(count(DISTINCT doc_id) AS DOUBLE) FROM e GROUP BY asset, day UNION ALL SELECT 'evidence', asset, CAST(doc_id AS VARCHAR), relevance FROM ({_RERANK.format('asset', 10)})"""))
def ex01(spark: S, d: str) -> DataFrame:
    """What moved every asset: its strongest narratives, its days and its best evidence."""
    top = graph.top_per_group(narratives(spark, d), ["asset_label"], [F.desc_nulls_last("score"), F.asc("factor_label")], 5)
    one = top.select(F.lit("narrative").alias("part"), F.col("asset_label").alias("asset"), F.col("factor_label").alias("item"), "score")
    s = scored(spark, d)
    days = s.groupBy("asset", "day").agg(F.count_distinct("doc_id").cast("double").alias("score")).select(F.lit("day").alias("part"), "asset", F.col("day").cast("string").alias("item"), "score")
    docs = ev.rerank(s, ["asset"], 10).select(F.lit("evidence").alias("part"), "asset", F.col("doc_id").cast("string").alias("item"), F.col("relevance").alias("score"))
    return one.unionByName(days).unionByName(docs)


@query("tx10_evidence_strength", steps("s", "SELECT doc_id, asset, factor, day, strength, mode, grade FROM s"))
def tx10(spark: S, d: str) -> DataFrame:
    return best(spark, d).select("doc_id", "asset", "factor", "day", "strength", "mode", "grade")


@query("ex02_top_documents", steps("top", "SELECT asset, day, factor, doc_id, relevance FROM (SELECT *, row_number() OVER (PARTITION BY asset, day, factor ORDER BY relevance DESC NULLS LAST, confidence DESC NULLS LAST, event_time DESC NULLS LAST, url DESC NULLS LAST, doc_id) AS k FROM top) WHERE k <= 2"))
def ex02(spark: S, d: str) -> DataFrame:
    """The two best documents of every asset, day and factor that name the asset."""
    some = scored(spark, d).filter((F.col("relevance") > 0) & (F.col("title_asset") + F.col("text_asset") > 0))
    return graph.top_per_group(some, ["asset", "day", "factor"], [F.desc_nulls_last(c) for c in ev.BEST] + [F.asc("doc_id")], 2).select("asset", "day", "factor", "doc_id", "relevance")


@query("ex03_exclusive_assignment", steps("x", "SELECT asset, day, url, factor, assignment FROM x"))
def ex03(spark: S, d: str) -> DataFrame:
    return ev.assigned(best(spark, d), GENERIC).select("asset", "day", "url", "factor", "assignment")


@query("ex04_supported_blocks", steps("bl", f"SELECT asset, day, factor, best_grade, best_score, mode, docs, {_j('sources')} AS sources, confidence, block_rank, place FROM bl"))
def ex04(spark: S, d: str) -> DataFrame:
    return all_blocks(spark, d).select("asset", "day", "factor", "best_grade", "best_score", "mode", "docs", joined("sources").alias("sources"), "confidence", "block_rank", F.col("place").cast("long").alias("place"))


_LEVEL = "CASE WHEN {0} >= 2 THEN 'high' WHEN {0} = 1 THEN 'medium' ELSE 'low' END"


@query("ex05_asset_states", steps("sta", "SELECT asset, day, blocks, primary_factor FROM sta"))
def ex05(spark: S, d: str) -> DataFrame:
    return all_states(spark, d, all_blocks(spark, d)).select("asset", "day", "blocks", "primary_factor")


@query("ex14_confidence_levels", steps("sta", f"SELECT asset, day, {_LEVEL.format('direct')} AS direct_level, {_LEVEL.format('proxy')} AS proxy_level, {_LEVEL.format('chains')} AS chain_level, CASE WHEN direct >= 2 THEN 'high' WHEN direct >= 1 OR proxy >= 1 OR chains >= 1 THEN 'medium' ELSE 'low' END AS overall_level FROM sta"))
def ex14(spark: S, d: str) -> DataFrame:
    return all_states(spark, d, all_blocks(spark, d)).select("asset", "day", "direct_level", "proxy_level", "chain_level", "overall_level")


@query("ag33_day_narratives", steps("dn", f"SELECT day, factor, score, {_j('assets')} AS assets, source_diversity, {_j('urls')} AS urls, confidence FROM dn"))
def ag33_full(spark: S, d: str) -> DataFrame:
    n = ev.day_narratives(all_blocks(spark, d))
    return n.select("day", "factor", "score", joined("assets").alias("assets"), "source_diversity", joined("urls").alias("urls"), "confidence")


@query("ag34_market_impact", steps("im", f"SELECT day, factor, {_j('explained')} AS explained, {_j('overlap')} AS overlap, impact FROM im"))
def ag34_full(spark: S, d: str) -> DataFrame:
    return all_impacts(spark, d)[0].select("day", "factor", joined("explained").alias("explained"), joined("overlap").alias("overlap"), "impact")


@query("ag35_block_confidence", steps("bl", "SELECT factor, confidence, count(*) AS n FROM bl GROUP BY 1, 2"))
def ag35_full(spark: S, d: str) -> DataFrame:
    """Number of sources, kinds of sources and modes of evidence together."""
    return all_blocks(spark, d).groupBy("factor", "confidence").agg(F.count(F.lit(1)).alias("n"))


@query("ex06_explanation_fit", steps("ft", f"SELECT day, {_j('fs')} AS factors, {_j('explained')} AS explained, {_j('matched')} AS matched, {_j('contradictions')} AS contradictions, {_j('unresolved')} AS unresolved, fit FROM ft"))
def ex06(spark: S, d: str) -> DataFrame:
    f = ev.fits(*all_impacts(spark, d))
    return f.select("day", *[joined(c).alias(c) for c in ("factors", "explained", "matched", "contradictions", "unresolved")], "fit")


@query("ex07_transmission", steps("im", "SELECT day, im.factor, impact, chain FROM im JOIN (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in CHAINS.items()) + ") c(factor, chain) ON c.factor = im.factor"))
def ex07(spark: S, d: str) -> DataFrame:
    chains = spark.createDataFrame(list(CHAINS.items()), "factor string, chain string")
    return all_impacts(spark, d)[0].join(F.broadcast(chains), "factor").select("day", "factor", "impact", "chain")  # four rows


@query("ex08_weakest_asset", steps("bf", """SELECT sta.day, max_by(asset, struct_pack(a := CAST(direct = 0 AS INTEGER), b := CAST(direct = 0 AND proxy = 0 AND chains = 0 AS INTEGER), c := CAST(NOT list_contains(matched, asset) AS INTEGER), e := CAST(blocks = 0 AS INTEGER), f := asset)) AS weakest
  FROM (SELECT day, asset, blocks, primary_factor, direct, proxy, chains FROM sta) sta JOIN (SELECT day, matched FROM bf) bf ON bf.day = sta.day GROUP BY 1"""))
def ex08(spark: S, d: str) -> DataFrame:
    """The asset of every day that its best explanation fits least."""
    impact, state = all_impacts(spark, d)
    got = state.join(ev.best_fit(ev.fits(impact, state)).select("day", "matched"), "day")
    weak = F.struct((F.col("direct_level") == "low").cast("int"), (F.col("overall_level") == "low").cast("int"), (~F.array_contains("matched", F.col("asset"))).cast("int"), (F.col("blocks") == 0).cast("int"), "asset")
    return got.groupBy("day").agg(F.max_by("asset", weak).alias("weakest"))


@query("ex09_fit_confidence", steps("bf", f"SELECT day, {_j('fs')} AS factors, round(greatest(0.0, least(1.0, (fit + 21.0 * assets) / (38.0 * assets + 25.0 + 21.0 * assets))), 2) AS fit_confidence, round(greatest(0.0, least(1.0, 0.6 * len(contradictions) / assets + 0.25 * len(unresolved) / assets + 0.15 * greatest(0, assets - len(direct)) / assets)), 2) AS contradiction, {_j('unresolved')} AS unresolved FROM bf"))
def ex09(spark: S, d: str) -> DataFrame:
    b = ev.best_fit(ev.fits(*all_impacts(spark, d)))
    return b.select("day", joined("factors").alias("factors"), "fit_confidence", "contradiction", joined("unresolved").alias("unresolved"))


@query("ex10_day_context", steps("sta", """SELECT sta.asset, sta.day, coalesce(sta.primary_factor, t.factor) AS factor, CASE WHEN sta.primary_factor IS NOT NULL THEN 'own' WHEN t.factor IS NOT NULL THEN 'day' END AS basis FROM sta
  LEFT JOIN (SELECT day, factor FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY score DESC, factor) AS k FROM (SELECT day, factor, round(sum(weight), 3) AS score FROM bl GROUP BY 1, 2)) WHERE k = 1) t ON t.day = sta.day"""))
def ex10(spark: S, d: str) -> DataFrame:
    """An asset without support takes the day's leading narrative."""
    block = all_blocks(spark, d)
    lead = graph.top_per_group(ev.day_narratives(block), ["day"], [F.desc("score"), F.asc("factor")], 1).select("day", F.col("factor").alias("lead"))
    s = all_states(spark, d, block).join(lead, "day", "left")
    return s.select("asset", "day", F.coalesce("primary_factor", "lead").alias("factor"), F.when(F.col("primary_factor").isNotNull(), "own").when(F.col("lead").isNotNull(), "day").alias("basis"))


@query("ex11_competing_hypotheses", steps("im", "SELECT day, label, factor, impact, rank FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY impact DESC, label) AS rank FROM (SELECT day, w.asset AS label, max_by(im.factor, struct_pack(i := impact, f := im.factor)) AS factor, max(impact) AS impact FROM im JOIN w ON w.factor = im.factor GROUP BY 1, 2)) WHERE rank <= 3"))
def ex11(spark: S, d: str) -> DataFrame:
    """The three strongest explanations of a day, one per label."""
    dim = F.broadcast(read(spark, d, "factor_dictionary").select(F.col("factor_label").alias("factor"), F.col("factor_group").alias("label")))
    by = all_impacts(spark, d)[0].join(dim, "factor").groupBy("day", "label").agg(F.max_by("factor", F.struct("impact", "factor")).alias("factor"), F.max("impact").alias("impact"))
    return graph.top_per_group(by, ["day"], [F.desc("impact"), F.asc("label")], 3).select("day", "label", "factor", "impact", F.col("rank").cast("long").alias("rank"))


@query("ex15_intraday_evolution", """WITH m AS (SELECT bucket_time AS day, date_trunc('hour', event_time) AS hour, factor_label, count(*) AS n FROM silver_factor_mentions WHERE factor_label IS NOT NULL AND event_time IS NOT NULL GROUP BY 1, 2, 3),
  k AS (SELECT *, row_number() OVER (PARTITION BY day, hour ORDER BY n DESC, factor_label) AS r FROM m) SELECT day, hour, factor_label, n FROM k WHERE r <= 3 AND day IN (SELECT day FROM m GROUP BY 1 HAVING count(DISTINCT hour) >= 2)""")
def ex15_full(spark: S, d: str) -> DataFrame:
    """The three leading factors of every hour, for days with at least two hours."""
    m = read(spark, d, SILVER).filter("factor_label is not null and event_time is not null")
    h = m.groupBy(F.col("bucket_time").alias("day"), F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("hour"), "factor_label").agg(F.count(F.lit(1)).alias("n"))
    enough = h.groupBy("day").agg(F.count_distinct("hour").alias("hours")).filter("hours >= 2").select("day")
    return graph.top_per_group(h, ["day", "hour"], [F.desc("n"), F.asc("factor_label")], 3).join(enough, "day", "left_semi").select("day", "hour", "factor_label", "n")


EVENT = "Crude supply falls as a refinery outage and port congestion halt freight; court ruling expected"


@query("ex16_event_impact", f"""WITH w AS ({STEPS['w']}), ev AS (SELECT ' ' || {FORM.format(f"'{EVENT}'")} || ' ' AS form), h AS (SELECT asset, factor, CASE WHEN contains(form, ' ' || phrase || ' ') THEN 2 ELSE 0 END + len(list_filter(mechanism, lambda q : contains(form, ' ' || q || ' '))) AS hits FROM w, ev),
  p AS (SELECT factor_label AS factor, count(DISTINCT doc_id) AS docs FROM silver_factor_mentions WHERE factor_label IS NOT NULL GROUP BY 1) SELECT asset, max_by(h.factor, struct_pack(s := hits, f := h.factor)) AS factor, round(sum(hits * (1 + ln(1 + coalesce(docs, 0)))), 6) AS impact FROM h LEFT JOIN p ON p.factor = h.factor WHERE hits > 0 GROUP BY 1""")
def ex16(spark: S, d: str) -> DataFrame:
    """Assets that the text of an event touches, by the factors it names and how far the corpus speaks of them."""
    rules = ev.rule_cues(read(spark, d, "factor_dictionary").select(F.col("factor_label").alias("factor"), F.col("factor_group").alias("asset")))
    form = text.match_form(F.lit(EVENT))
    hits = 2 * text.cue_hits(form, F.array("phrase")) + text.cue_hits(form, F.col("mechanism"))
    spoken = read(spark, d, SILVER).filter("factor_label is not null").groupBy(F.col("factor_label").alias("factor")).agg(F.count_distinct("doc_id").alias("docs"))
    h = rules.select("asset", "factor", hits.alias("hits")).filter("hits > 0").join(spoken, "factor", "left")
    return h.groupBy("asset").agg(F.max_by("factor", F.struct("hits", "factor")).alias("factor"), F.round(F.sum(F.col("hits") * (1 + F.log1p(F.coalesce("docs", F.lit(0))))), 6).alias("impact"))


@query("ex17_day_bundle", steps("sta", """SELECT 'context' AS part, day, asset AS a, coalesce(primary_factor, '') AS b, blocks AS n FROM sta UNION ALL SELECT 'overlap', x.day, x.asset, y.asset, count(*) FROM bl x JOIN bl y ON x.day = y.day AND x.mode = y.mode AND x.asset < y.asset AND x.place = 1 AND y.place = 1 GROUP BY 2, 3, 4
  UNION ALL SELECT 'frequency', day, factor, '', count(*) FROM bl GROUP BY 2, 3"""))
def ex17(spark: S, d: str) -> DataFrame:
    """A day's states, the assets that share a mode of support, and how many assets a factor supports."""
    block = all_blocks(spark, d)
    one = all_states(spark, d, block).select(F.lit("context").alias("part"), "day", F.col("asset").alias("a"), F.coalesce("primary_factor", F.lit("")).alias("b"), F.col("blocks").alias("n"))
    first = block.filter("place = 1").select("day", "mode", "asset")
    two = first.select("day", "mode", F.col("asset").alias("a")).join(first.select("day", "mode", F.col("asset").alias("b")), ["day", "mode"]).filter("a < b").groupBy("day", "a", "b").agg(F.count(F.lit(1)).alias("n"))  # one row per asset and day
    three = block.groupBy("day", F.col("factor").alias("a")).agg(F.count(F.lit(1)).alias("n"))
    return one.unionByName(two.select(F.lit("overlap").alias("part"), "day", "a", "b", "n")).unionByName(three.select(F.lit("frequency").alias("part"), "day", "a", F.lit("").alias("b"), "n"))


@query("ex24_reference_numbers", steps("g", """SELECT day, url, max('S' || n) AS reference FROM (SELECT *, dense_rank() OVER (PARTITION BY day ORDER BY f) AS n FROM (SELECT *, min(p) OVER (PARTITION BY day, url) AS f FROM (SELECT day, url, row_number() OVER (PARTITION BY day ORDER BY strength DESC, asset, factor, url) AS p FROM g WHERE rk <= 2))) GROUP BY 1, 2"""))
def ex24(spark: S, d: str) -> DataFrame:
    """Numbers of the addresses a day's evidence cites, by first use."""
    good = ev.assigned(best(spark, d), GENERIC).filter("grade <> 'weak'").withColumn("__g", F.when(F.col("grade") == "strong", 2).otherwise(1))
    cited = graph.top_per_group(good, ["asset", "day", "factor"], [F.desc("__g"), F.desc("strength"), F.desc("confidence"), F.asc("url")], 2)
    return ev.numbered(cited, ["day"], "url", [F.desc("strength"), F.asc("asset"), F.asc("factor"), F.asc("url")]).groupBy("day", "url").agg(F.max("reference").alias("reference"))


# --- claims: one per factor, checked against the summaries of the documents that mention it --------------

NEGATIVE = ("opposite", "contradict", "reversed", "despite", "ignored")


@query("tx29_claim_keywords", "SELECT factor_label, array_to_string(list_filter(string_split(lower(regexp_replace(concat_ws(' ', factor_label, factor_group), '[^A-Za-z0-9]+', ' ', 'g')), ' '), lambda x : length(x) >= 4)[1:8], ',') AS keywords FROM factor_dictionary")
def tx29(spark: S, d: str) -> DataFrame:
    return read(spark, d, "factor_dictionary").select("factor_label", joined(ev.claim_keywords(F.col("factor_label"), F.col("factor_group"))).alias("keywords"))


_CLAIMS = f"""WITH k AS (SELECT factor_label, list_filter(string_split(lower(regexp_replace(concat_ws(' ', factor_label, factor_group), '[^A-Za-z0-9]+', ' ', 'g')), ' '), lambda x : length(x) >= 4)[1:8] AS keywords FROM factor_dictionary),
  r AS (SELECT DISTINCT m.doc_id, m.factor_label, keywords, lower(coalesce(b.summary, '')) AS low FROM silver_factor_mentions m JOIN k ON k.factor_label = m.factor_label JOIN (SELECT doc_id, min(summary_text) AS summary FROM bronze_candidates GROUP BY 1) b ON b.doc_id = m.doc_id),
  s AS (SELECT factor_label, len(keywords) AS k, len(list_filter(keywords, lambda w : contains(low, w))) AS hits, {' OR '.join(f"contains(low, '{w}')" for w in NEGATIVE)} AS against FROM r),
  g AS (SELECT factor_label, max(hits) AS top, count(*) FILTER (hits > 0) AS supporting, bool_or(against) AS against, max(k) AS k FROM s GROUP BY 1)"""


@query("tx30_claim_status", f"{_CLAIMS} SELECT factor_label, top, supporting, CASE WHEN supporting >= 2 AND top >= greatest(2, least(4, k)) THEN 'confirmed' WHEN supporting > 0 THEN 'refined' WHEN against THEN 'contradicted' ELSE 'unsupported' END AS status FROM g")
def tx30(spark: S, d: str) -> DataFrame:
    claims = read(spark, d, "factor_dictionary").select("factor_label", ev.claim_keywords(F.col("factor_label"), F.col("factor_group")).alias("keywords"))
    b = read(spark, d, BRONZE).groupBy("doc_id").agg(F.min("summary_text").alias("summary"))
    r = read(spark, d, SILVER).select("doc_id", "factor_label").distinct().join(F.broadcast(claims), "factor_label").join(b, "doc_id")  # the claims: 40 rows, fixed
    return ev.claim_status(r, "factor_label", "keywords", "summary", NEGATIVE).select("factor_label", F.col("top").cast("long").alias("top"), "supporting", "status")


@query("tx31_trust_gate", steps("bf", """SELECT day, CASE WHEN len(unresolved) > 6 THEN 'unresolved' WHEN round(greatest(0.0, least(1.0, (fit + 21.0 * assets) / (38.0 * assets + 25.0 + 21.0 * assets))), 2) < 0.35 THEN 'low_confidence'
  WHEN round(greatest(0.0, least(1.0, 0.6 * len(contradictions) / assets + 0.25 * len(unresolved) / assets + 0.15 * greatest(0, assets - len(direct)) / assets)), 2) >= 0.75 THEN 'high_contradiction' END AS gate FROM bf"""))
def tx31(spark: S, d: str) -> DataFrame:
    b = ev.best_fit(ev.fits(*all_impacts(spark, d)))
    return b.select("day", ev.trust_gate(F.col("fit_confidence"), F.col("contradiction"), F.size("unresolved") > 6).alias("gate"))
