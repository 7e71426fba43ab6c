"""Evidence: how well a document supports a link of an asset to a factor, and what a day's evidence explains.

The stages are DataFrames keyed by asset, factor and day: scored documents -> best documents -> blocks ->
day narratives -> impacts -> explanation fits. The rules (cues, channels, chains, generic factors) are tables or lists
handed in; nothing here knows a particular asset or factor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import text
from newsloom.plans.graph import top_per_group

NONE = "array<string>"


def words(phrase: Column, least: int = 4) -> Column:
    """The words of a cue phrase that are long enough to stand alone."""
    return F.filter(F.split(phrase, " "), lambda w: F.length(w) >= least)


def rule_cues(rules: DataFrame, asset: str = "asset", factor: str = "factor") -> DataFrame:
    """(asset, factor) -> cues of both: a factor's phrase and its longer words, an asset's words of all its factors."""
    phrase = F.upper(F.replace(F.col(factor), F.lit("_"), F.lit(" ")))
    one = rules.select(F.col(asset).alias("asset"), F.col(factor).alias("factor"), phrase.alias("phrase")).withColumn("mechanism", words(F.col("phrase")))
    whole = one.groupBy("asset").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("mechanism")))).alias("asset_cues"))  # rules only
    return one.join(whole, "asset").withColumn("factor_cues", F.array_distinct(F.concat(F.array("phrase"), F.col("mechanism"))))


def forms(df: DataFrame) -> DataFrame:
    """Adds the match forms of the title, of the evidence below it and of all together, each computed once."""
    body = F.concat_ws(" ", "context", "summary")
    return df.withColumns({"title_form": text.match_form(F.col("title")), "text_form": text.match_form(body), "all_form": text.match_form(F.concat_ws(" ", "title", "summary", "context"))})


def source_bonus(kind: Column, wrap: float, specialist: float) -> Column:
    return F.when(kind == "market_wrap", wrap).when(kind == "commodity_specialist", specialist).otherwise(0.0)


def relevance(df: DataFrame, penalty: Column | None = None) -> DataFrame:
    """Adds the hits of factor and asset cues in title and text, and ``relevance``; a document that names neither loses 5."""
    hits = {f"{part}_{side}": text.cue_hits(F.col(f"{part}_form"), F.col(f"{side}_cues")) for part in ("title", "text") for side in ("factor", "asset")}
    out = df.withColumns(hits)
    has = lambda c, w: F.when(F.length(F.coalesce(F.col(c), F.lit(""))) > 0, w).otherwise(0.0)
    score = 8.0 * F.col("title_factor") + 4.0 * F.col("text_factor") + 6.0 * F.col("title_asset") + 3.0 * F.col("text_asset") + source_bonus(F.col("source_type"), 3.0, 2.0)
    score = score + 2.0 * F.coalesce("confidence", F.lit(0.0)) + has("title", 1.0) + has("summary", 0.5) + has("context", 0.5) + (F.lit(0.0) if penalty is None else penalty)
    none = F.col("title_factor") + F.col("text_factor") + F.col("title_asset") + F.col("text_asset") == 0
    return out.withColumn("relevance", F.round(score - F.when(none, 5.0).otherwise(0.0), 3))


BEST = ("relevance", "confidence", "event_time", "url")


def rerank(df: DataFrame, group: Sequence[str], limit: int) -> DataFrame:
    """The ``limit`` most relevant documents of every group, an address once per asset and factor; where some are positive only those."""
    order = [F.desc_nulls_last(c) for c in BEST] + [F.asc("doc_id"), F.asc("factor")]
    once = top_per_group(df, ["url", "asset", "factor"], order, 1).drop("rank")
    best = top_per_group(once, group, order, limit)
    most = F.max("relevance").over(Window.partitionBy(*group))
    return best.withColumn("__most", most).filter((F.col("relevance") > 0) | (F.col("__most") <= 0)).drop("__most")


def strength(df: DataFrame, channel: Sequence[str] = (), market: Sequence[str] = (), strong: float = 24.0, moderate: float = 16.0) -> DataFrame:
    """Adds hits, ``strength``, ``mode`` (direct, proxy, weak) and ``grade`` (strong, moderate, weak) of a scored document.

    direct: the asset is named, and the factor or two of its mechanism words; proxy: words of a channel and of a market stand in for the asset.
    """
    lists = {"asset": F.col("asset_cues"), "phrase": F.array("phrase"), "mechanism": F.col("mechanism"), "channel": F.array(*map(F.lit, channel)).cast(NONE), "market": F.array(*map(F.lit, market)).cast(NONE)}
    out = df.withColumns({f"{k}_hits": text.cue_hits(F.col("all_form"), c) for k, c in lists.items()} | {"title_phrase": text.cue_hits(F.col("title_form"), F.array("phrase"))})
    a, f, m, p, k = (F.col(f"{x}_hits") for x in ("asset", "phrase", "mechanism", "channel", "market"))
    score = 3.0 * a + 2.0 * f + 2.0 * m + 2.5 * (p + k) + 2.0 * (F.col("title_asset") + F.col("title_phrase")) + source_bonus(F.col("source_type"), 4.0, 2.5)
    score = score + 0.3 * F.coalesce("context_score", F.lit(0.0)) + F.col("relevance") + F.coalesce("confidence", F.lit(0.0))
    direct = (a > 0) & ((f > 0) | (m >= 2))
    proxy = ~direct & (p > 0) & (k > 0) & ((f > 0) | (m >= 1) | (p >= 2))
    out = out.withColumn("strength", F.round(score, 3)).withColumn("mode", F.when(direct, "direct").when(proxy, "proxy").otherwise("weak"))
    return out.withColumn("grade", F.when((F.col("mode") != "weak") & (F.col("strength") >= strong), "strong").when((F.col("mode") != "weak") & (F.col("strength") >= moderate), "moderate").otherwise("weak"))


def assigned(df: DataFrame, generic: Sequence[str] = ()) -> DataFrame:
    """Every address of an asset's day under one factor only: the one it speaks for most."""
    fit = F.col("strength") + 6.0 * F.col("mechanism_hits") + 2.0 * F.col("phrase_hits") - F.when(F.col("factor").isin(*generic), 12.0).otherwise(0.0)
    fit = fit + F.when(F.col("mode") == "direct", 8.0).when(F.col("mode") == "proxy", 4.0).otherwise(0.0)
    scored = df.filter(F.length("url") > 0).withColumn("assignment", F.round(fit, 3))
    return top_per_group(scored, ["asset", "day", "url"], [F.desc("assignment"), F.asc("factor"), F.asc("doc_id")], 1).drop("rank")


def source_confidence(sources: Column, wraps: Column, specialists: Column, direct: Column, proxy: Column) -> Column:
    """high, medium or low by number of sources, kinds of sources and modes of evidence."""
    bonus, kinds = 2 * direct + proxy, (wraps >= 1) | (specialists >= 1)
    return F.when((sources >= 2) & (kinds | (bonus >= 2)), "high").when((sources >= 2) | kinds | (bonus >= 1), "medium").otherwise("low")


def blocks(df: DataFrame, narratives: DataFrame, generic: Sequence[str] = (), keep: int = 2) -> DataFrame:
    """Supported factors of an asset's day with their best documents, ranked.

    narratives: (asset, day, factor, narrative_score). A generic factor needs strong evidence.
    """
    good = df.filter(F.col("grade") != "weak").withColumn("__g", F.when(F.col("grade") == "strong", 2).otherwise(1))
    key = ["asset", "day", "factor"]
    best = top_per_group(good, key, [F.desc("__g"), F.desc("strength"), F.desc("confidence"), F.asc("url")], keep)
    one = lambda cond: F.count_if(cond)
    first = lambda c: F.max(F.when(F.col("rank") == 1, F.col(c)))
    wraps, specials = one(F.col("source_type") == "market_wrap"), one(F.col("source_type") == "commodity_specialist")
    out = best.groupBy(*key).agg(
        first("grade").alias("best_grade"), first("strength").alias("best_score"), first("mode").alias("mode"), F.count(F.lit(1)).alias("docs"), F.array_sort(F.collect_set("source_domain")).alias("sources"),
        F.array_sort(F.collect_set("url")).alias("urls"), wraps.alias("wraps"), specials.alias("specialists"), one(F.col("mode") == "direct").alias("direct"), one(F.col("mode") == "proxy").alias("proxy"),
        F.sum(source_bonus(F.col("source_type"), 3.0, 1.5)).alias("kind_bonus"), F.round(F.sum(0.25 * F.coalesce("context_score", F.lit(0.0))), 6).alias("context_bonus"),
    )
    is_generic = F.col("factor").isin(*generic)
    out = out.filter(~is_generic | (F.col("best_grade") == "strong")).join(narratives, key, "left").fillna(0.0, ["narrative_score"])
    rank = F.col("best_score") + 0.02 * F.col("narrative_score") + F.when(F.col("mode") == "direct", 12.0).when(F.col("mode") == "proxy", 6.0).otherwise(0.0)
    rank = rank + F.col("kind_bonus") + F.col("context_bonus") - F.when(is_generic, 18.0).otherwise(0.0)
    out = out.withColumn("block_rank", F.round(rank, 3)).withColumn("confidence", source_confidence(F.size("sources"), F.col("wraps"), F.col("specialists"), F.col("direct"), F.col("proxy")))
    place = F.row_number().over(Window.partitionBy("asset", "day").orderBy(F.desc("block_rank"), F.asc("factor")))
    return out.withColumn("place", place).withColumn("weight", F.round(F.col("best_score") + F.col("narrative_score") / 100.0, 6))


def level(n: Column) -> Column:
    return F.when(n >= 2, "high").when(n == 1, "medium").otherwise("low")


def states(block: DataFrame, observed: DataFrame, chained: Sequence[str] = ()) -> DataFrame:
    """(asset, day) rows, also without support: number of blocks, primary factor and the levels of confidence."""
    per = block.groupBy("asset", "day").agg(
        F.count(F.lit(1)).alias("blocks"), F.max(F.when(F.col("place") == 1, F.col("factor"))).alias("primary_factor"), F.count_if(F.col("mode") == "direct").alias("direct"),
        F.count_if(F.col("mode") == "proxy").alias("proxy"), F.count_if(F.col("factor").isin(*chained)).alias("chains"),
    )
    out = observed.select("asset", "day").distinct().join(per, ["asset", "day"], "left").fillna(0, ["blocks", "direct", "proxy", "chains"])
    overall = F.when(F.col("direct") >= 2, 2).when((F.col("direct") >= 1) | (F.col("proxy") >= 1) | (F.col("chains") >= 1), 1).otherwise(0)
    return out.withColumns({"direct_level": level(F.col("direct")), "proxy_level": level(F.col("proxy")), "chain_level": level(F.col("chains")), "overall_level": level(overall)})


def day_narratives(block: DataFrame) -> DataFrame:
    """(day, factor): summed weight of its blocks, the assets it moves, its sources and first addresses."""
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))  # noqa: E731  # a row per asset, two documents each
    out = block.groupBy("day", "factor").agg(F.round(F.sum("weight"), 3).alias("score"), F.array_sort(F.collect_set("asset")).alias("assets"), flat("sources").alias("sources"), flat("urls").alias("urls"),
                                             *[F.sum(c).alias(c) for c in ("wraps", "specialists", "direct", "proxy")])
    conf = source_confidence(F.size("sources"), F.col("wraps"), F.col("specialists"), F.col("direct"), F.col("proxy"))
    return out.withColumns({"source_diversity": F.size("sources").cast("long"), "urls": F.slice("urls", 1, 3), "confidence": conf})


def impacts(narratives: DataFrame, state: DataFrame, targets: DataFrame) -> DataFrame:
    """Day narratives with the assets they explain and those supported among them, scored 10, 5, 2 a source and the narrative's own score.

    targets: (factor, targets array): assets a factor reaches; a factor without a row reaches its own assets.
    """
    seen = state.groupBy("day").agg(F.array_sort(F.collect_set("asset")).alias("observed"), F.array_sort(F.collect_set(F.when(F.col("blocks") > 0, F.col("asset")))).alias("supported"))  # the assets of a day
    out = narratives.join(F.broadcast(targets), "factor", "left").withColumn("targets", F.coalesce("targets", "assets")).join(seen, "day")  # one row per factor
    out = out.withColumns({"explained": F.array_sort(F.array_intersect("targets", "observed")), "overlap": F.array_sort(F.array_intersect("targets", "supported"))})
    return out.withColumn("impact", F.round(10.0 * F.size("explained") + 5.0 * F.size("overlap") + 2.0 * F.col("source_diversity") + F.col("score"), 3))


def fits(impact: DataFrame, state: DataFrame, heads: int = 6) -> DataFrame:
    """Combinations of one to three of a day's strongest narratives, scored by what they explain together.

    The narratives of a day are cut to ``heads`` first (the feature), so a day has at most 41 combinations.
    """
    top = top_per_group(impact, ["day"], [F.desc("impact"), F.desc("source_diversity"), F.asc("factor")], heads)
    row = F.struct("rank", "factor", "explained", "overlap", F.col("source_diversity").alias("n"), "score")
    day = top.groupBy("day").agg(F.array_sort(F.collect_list(row)).alias("r"))
    size, at = F.size("r"), lambda k: F.get("r", k - 1)
    upto = lambda lo: F.when(size >= lo, F.sequence(lo, size)).otherwise(F.array().cast("array<int>"))
    one = F.transform(upto(F.lit(1)), lambda i: F.array(at(i)))
    two = F.flatten(F.transform(upto(F.lit(1)), lambda i: F.transform(upto(i + 1), lambda j: F.array(at(i), at(j)))))
    three = F.flatten(F.transform(upto(F.lit(1)), lambda i: F.flatten(F.transform(upto(i + 1), lambda j: F.transform(upto(j + 1), lambda k: F.array(at(i), at(j), at(k)))))))
    combos = day.select("day", F.explode(F.concat(one, two, three)).alias("c"))
    both = lambda name: F.array_sort(F.array_distinct(F.flatten(F.transform("c", lambda x: x[name]))))
    combos = combos.select("day", F.array_sort(F.transform("c", lambda x: x["factor"])).alias("factors"), both("explained").alias("explained"), both("overlap").alias("direct"), F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("sources"), F.aggregate("c", F.lit(0.0), lambda a, x: a + x["score"]).alias("score"))
    every = state.groupBy("day").agg(F.array_sort(F.collect_list(F.struct("asset", "primary_factor", "blocks"))).alias("s"))  # the assets of a day
    out = combos.join(every, "day")
    name = lambda xs: F.transform(xs, lambda x: x["asset"])
    matched = name(F.filter("s", lambda x: F.array_contains("explained", x["asset"]) | F.coalesce(F.array_contains(F.col("factors"), x["primary_factor"]), F.lit(False))))
    out = out.withColumn("matched", matched)
    out = out.withColumn("contradictions", F.array_except(name(F.filter("s", lambda x: x["blocks"] > 0)), F.col("matched"))).withColumn("unresolved", F.array_except(F.array_except(name(F.col("s")), F.col("explained")), F.col("matched")))
    fit = 25.0 * F.size("matched") + 8.0 * F.size("explained") + 5.0 * F.size("direct") + 1.5 * F.least(F.col("sources"), F.lit(12)) + F.col("score")
    fit = fit - 15.0 * F.size("contradictions") - 6.0 * F.size("unresolved") - 4.0 * (F.size("factors") - 1)
    return out.withColumn("assets", F.size("s")).drop("s").withColumn("fit", F.round(fit, 3))


def best_fit(fit: DataFrame) -> DataFrame:
    """The best combination of every day with its confidence and contradiction, both from 0 to 1."""
    order = [F.desc("fit"), F.desc(F.size("matched")), F.asc(F.size("contradictions")), F.asc(F.size("unresolved")), F.desc(F.size("direct")), F.asc(F.array_join("factors", ","))]
    one = top_per_group(fit, ["day"], order, 1).drop("rank")
    n = F.col("assets")
    conf = (F.col("fit") + 21.0 * n) / (38.0 * n + 25.0 + 21.0 * n)
    contra = 0.6 * F.size("contradictions") / n + 0.25 * F.size("unresolved") / n + 0.15 * F.greatest(F.lit(0), n - F.size("direct")) / n
    clamp = lambda c: F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)), 2)
    return one.withColumns({"fit_confidence": clamp(conf), "contradiction": clamp(contra)})


def numbered(df: DataFrame, group: Sequence[str], key: str, order: Sequence[Column]) -> DataFrame:
    """Adds ``reference``: S1, S2, .. by first use of ``key`` inside the group."""
    at = df.withColumn("__at", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    first = at.withColumn("__first", F.min("__at").over(Window.partitionBy(*group, key)))
    return first.withColumn("reference", F.concat(F.lit("S"), F.dense_rank().over(Window.partitionBy(*group).orderBy("__first")))).drop("__at", "__first")


# --- claims ------------------------------------------------------------------------------------------


def claim_keywords(*phrases: Column, least: int = 4, most: int = 8) -> Column:
    """The first ``most`` distinct words of at least ``least`` letters, in small letters."""
    flat = F.lower(F.regexp_replace(F.concat_ws(" ", *phrases), "[^A-Za-z0-9]+", " "))
    return F.slice(F.array_distinct(words(flat, least)), 1, most)


def trust_gate(fit: Column, contradiction: Column, unresolved: Column) -> Column:
    """Why a claim is not worth checking, else null."""
    return F.when(unresolved, "unresolved").when(fit < 0.35, "low_confidence").when(contradiction >= 0.75, "high_contradiction")


def claim_status(results: DataFrame, claim: str, keywords: str, body: str, negative: Sequence[str]) -> DataFrame:
    """(claim, status) from results joined with their claim: confirmed, refined, contradicted or unsupported."""
    low = F.lower(F.coalesce(F.col(body), F.lit("")))
    hits = F.size(F.filter(keywords, lambda w: F.contains(low, w)))
    against = F.lit(False)
    for w in negative:
        against = against | F.contains(low, F.lit(w))
    scored = results.select(claim, F.size(keywords).alias("k"), hits.alias("hits"), against.alias("against"))
    got = scored.groupBy(claim).agg(F.max("hits").alias("top"), F.count_if(F.col("hits") > 0).alias("supporting"), F.max("against").alias("against"), F.max("k").alias("k"))
    enough = F.col("top") >= F.greatest(F.lit(2), F.least(F.lit(4), F.col("k")))
    status = F.when((F.col("supporting") > 0) & enough & (F.col("supporting") >= 2), "confirmed").when(F.col("supporting") > 0, "refined").when(F.col("against"), "contradicted").otherwise("unsupported")
    return got.select(claim, "top", "supporting", status.alias("status"))
