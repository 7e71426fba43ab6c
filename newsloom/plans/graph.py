"""From candidate rows to the story graph: documents, factor matches, mentions, daily panels and links.

Everything is lazy and joins on labels or natural keys, never on ids that depend on a run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import ids, text
from newsloom.sources.readers import alias

# Names under which a title, a summary and a body come, in order of preference. The store's own name for a summary comes last.
TITLES = ("title", "article_title", "headline", "source_title")
SUMMARIES = ("summary", "snippet", "description", "excerpt", "lead", "lead_text", "summary_text")
BODIES = ("text", "article_text", "body_text", "content", "translated_text", "full_text")


def documents(raw: DataFrame) -> DataFrame:
    """Candidate rows -> one row per document with parsed time, tone, places and the texts that rules are held against.

    Optional columns are resolved by alias, missing ones become null; of repeated documents the first by
    stamp stays.
    """
    title = F.coalesce(alias(raw, TITLES), text.page_title(alias(raw, ("gkg_extras", "extras"))))
    out = raw.select(
        ids.sha_id(F.col("document_identifier")).alias("doc_key"), F.col("document_identifier"), alias(raw, ("record_datetime",)).alias("record_datetime"),
        text.event_time(alias(raw, ("record_datetime",)), F.col("partition_date").cast("date")).alias("event_time"), F.col("partition_date").cast("date").alias("partition_date"),
        F.coalesce(F.lower(alias(raw, ("source_common_name", "source_domain"))), text.host(F.col("document_identifier")), F.lit("unknown")).alias("source_domain"),
        title.alias("title"), alias(raw, SUMMARIES).alias("summary_text"), alias(raw, BODIES).alias("body_text"),
        *[alias(raw, (c,)).alias(c) for c in ("v2_themes", "v2_locations", "v2_persons", "v2_organizations", "all_names")], text.tone(alias(raw, ("v2_tone",))).alias("tone"),
    )
    first = Window.partitionBy("doc_key").orderBy("record_datetime", "source_domain", "title")
    out = out.withColumn("__r", F.row_number().over(first)).filter("__r = 1").drop("__r")
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("title", "summary_text", "body_text", "all_names", "v2_organizations", "v2_persons", "v2_themes", "v2_locations")]
    out = out.withColumn("relevant_text", F.concat_ws(" || ", *parts)).withColumn("geo_labels", text.geo_labels(F.col("v2_locations")))
    match = [F.col(c) for c in ("v2_themes", "all_names", "v2_organizations", "title", "summary_text")]
    return out.withColumn("match_text", text.ascii_upper(F.concat_ws(" | ", *match)))


def match_factors(docs: DataFrame, rules: Sequence[tuple[str, str]], key: str = "doc_key") -> DataFrame:
    """(label, pattern) rules -> (key, factor_label): documents whose match text holds one of a label's patterns.

    The rules are a configuration of a known size, so they travel inside the expression: no join, no
    row is multiplied before it has matched, and a document gives each label once.
    """
    by: dict[str, list[str]] = {}
    for label, pattern in rules:
        by.setdefault(label, []).append(pattern)
    if not by:
        return docs.select(key, F.lit("").alias("factor_label")).filter("false")

    def labels(t: Column) -> Column:
        found = []
        for label, patterns in sorted(by.items()):
            hit = F.lit(False)
            for p in patterns:
                hit = hit | F.contains(t, F.lit(p))
            found.append(F.when(hit, F.lit(label)))
        return F.array_compact(F.array(*found))

    return docs.select(key, F.explode(text.bound(F.coalesce("match_text", F.lit("")), labels)).alias("factor_label"))


def mentions(docs: DataFrame, matches: DataFrame, key: str = "doc_key") -> DataFrame:
    """Document x factor x place with the confidence of the match."""
    n = Window.partitionBy(key)
    conf = F.least(F.lit(0.95), F.lit(0.55) + F.lit(0.08) * F.count("factor_label").over(n))
    m = matches.withColumn("classification_confidence", conf)
    return m.join(docs.select(key, "event_time", "source_domain", "tone", F.explode("geo_labels").alias("geo_label")), key).withColumn("bucket_time", F.to_date("event_time"))


def rollup(m: DataFrame, keys: Sequence[str], doc: str = "doc_id", source: str = "source_id", extra: Sequence[Column] = ()) -> DataFrame:
    """Daily panel of mentions by ``keys`` with exact distinct counts and tails."""
    d, s = F.count_distinct(doc), F.count_distinct(source)
    tail = lambda cond: F.count_distinct(F.when(cond, F.col(doc)))
    return m.groupBy(*keys).agg(
        d.cast("int").alias("doc_count"), F.count(F.lit(1)).cast("int").alias("mention_count"), s.cast("int").alias("unique_sources"), F.avg("tone").alias("tone_mean"),
        F.avg(F.abs(F.coalesce("tone", F.lit(0.0)))).alias("avg_abs_tone"), F.avg("novelty").alias("novelty_mean"), tail(F.col("tone") <= -5).cast("int").alias("negative_tail_count"),
        tail(F.col("tone") >= 5).cast("int").alias("positive_tail_count"), F.avg("classification_confidence").alias("confidence_mean"),
        F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen"), (s / F.nullif(d, F.lit(0))).alias("source_dispersion"), *extra,
    )


def zscore(panel: DataFrame, by: Sequence[str], order: Sequence[str], value: str = "tone_mean", rows: int = 30) -> DataFrame:
    """Adds ``zscore``: the value against mean and deviation of the last ``rows`` rows of its group; null without spread."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(1 - rows, 0)
    mean, dev = F.avg(value).over(w), F.stddev_samp(value).over(w)
    return panel.withColumn("zscore", F.when(dev != 0, (F.col(value) - mean) / dev))


def factor_score() -> Column:
    return F.col("doc_count").cast("double") * (0.5 + F.coalesce("source_dispersion", F.lit(0.0))) * (1.0 + F.coalesce("avg_abs_tone", F.lit(0.0)) / 5.0)


def pair_score() -> Column:
    return factor_score() * (0.5 + F.coalesce("relevance_mean", F.lit(0.0)) / 8.0)


def links(panel: DataFrame, keys: Sequence[str], day: str = "bucket_time", score: str = "narrative_score") -> DataFrame:
    """Every group that exists on a day and on the day before, with its changes. A missing day gives no link."""
    prev = panel.select(F.date_add(day, 1).alias(day), *keys, F.col("doc_count").alias("prior_doc_count"), F.col(score).alias("prior_score"))
    out = panel.select(day, *keys, "doc_count", score).join(prev, [day, *keys])
    return out.withColumn("prior_bucket_time", F.date_sub(day, 1)).withColumn("doc_count_delta", F.col("doc_count") - F.col("prior_doc_count")).withColumn("score_delta", F.col(score) - F.col("prior_score"))


def days_to_relink(done: DataFrame, day: str = "bucket_time") -> DataFrame:
    """Days whose links change when ``done`` days are rebuilt: they and the days after them."""
    d = done.select(F.col(day).cast("date").alias(day))
    return d.union(d.select(F.date_add(day, 1))).distinct()


def similar_days(panel: DataFrame, factors: Sequence[str], base: str, day: str = "bucket_time", score: str = "narrative_score") -> DataFrame:
    """Earlier days by Euclidean distance of their factor scores to those of ``base``."""
    wide = panel.groupBy(day).pivot("factor_label", list(factors)).agg(F.sum(score)).fillna(0.0, list(factors))
    one = wide.filter(F.col(day) == F.lit(base).cast("date")).select(*[F.col(f"`{f}`").alias(f"__{k}") for k, f in enumerate(factors)])
    gap = sum(((F.col(f"`{f}`") - F.col(f"__{k}")) ** 2 for k, f in enumerate(factors)), F.lit(0.0))
    # the base day is one row
    return wide.filter(F.col(day) < F.lit(base).cast("date")).join(F.broadcast(one)).select(day, F.sqrt(gap).alias("distance"))


def hourly(events: DataFrame, time: str = "event_time") -> DataFrame:
    return events.groupBy(F.date_trunc("hour", time).cast("timestamp_ntz").alias("hour")).agg(F.count(F.lit(1)).alias("mentions"))


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of every group; order must be total. Spark limits every partition before it shuffles."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
