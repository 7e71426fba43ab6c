"""The stream over day files ends in the state of one batch."""

import os

import pytest
from pyspark.sql import functions as F

from newsloom.plans import graph
from newsloom.streaming import incremental

D = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")
SCHEMA = "bucket_time date, event_time timestamp, doc_id long, factor_label string, geo_label string, source_id int, tone double, novelty double, classification_confidence double"


def rows(df, *cols):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


def test_panel_equals_batch_out_of_order(spark, tmp_path):
    m = spark.read.parquet(f"{D}/silver_factor_mentions.parquet").select(*[c.split()[0] for c in SCHEMA.split(", ")]).withColumn("event_time", F.col("event_time").cast("timestamp"))
    days = sorted(r[0] for r in m.select("bucket_time").distinct().collect())
    src = str(tmp_path / "in")
    args = [str(tmp_path / x) for x in ("store", "panel", "links", "ck")]
    for day in reversed(days):  # the newest day first: links of the day after must be made again
        m.filter(F.col("bucket_time") == day).coalesce(1).write.mode("append").parquet(src)
        incremental.maintain_panel(incremental.read_days(spark, src, SCHEMA), *args)
    want = graph.rollup(m, ["bucket_time", "factor_label", "geo_label"]).withColumn("narrative_score", graph.factor_score())
    cols = ("bucket_time", "factor_label", "geo_label", "doc_count", "narrative_score")
    assert rows(spark.read.parquet(args[1]), *cols) == rows(want, *cols)
    cols = ("bucket_time", "factor_label", "geo_label", "prior_doc_count", "score_delta")
    assert rows(spark.read.parquet(args[2]), *cols) == rows(graph.links(want, ["factor_label", "geo_label"]), *cols)


def test_deduplicate_and_window(spark, tmp_path):
    src = str(tmp_path / "in")
    m = spark.createDataFrame([(1, "2025-01-01 10:05:00"), (1, "2025-01-01 10:05:00"), (2, "2025-01-01 11:00:00"), (3, "2025-01-30 00:00:00")], "k long, t string").withColumn("t", F.col("t").cast("timestamp"))
    m.coalesce(1).write.parquet(src)
    incremental.run_available(incremental.fresh(incremental.read_days(spark, src, "k long, t timestamp"), "k", "t"), str(tmp_path / "o"), str(tmp_path / "c"))
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [1, 2, 3]
    incremental.run_available(incremental.buckets(incremental.read_days(spark, src, "k long, t timestamp"), "t", []), str(tmp_path / "o2"), str(tmp_path / "c2"))
    spark.createDataFrame([(4, "2025-03-01 00:00:00")], "k long, t string").withColumn("t", F.col("t").cast("timestamp")).write.mode("append").parquet(src)
    incremental.run_available(incremental.buckets(incremental.read_days(spark, src, "k long, t timestamp"), "t", []), str(tmp_path / "o2"), str(tmp_path / "c2"))
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "o2")).collect())[-1] == 2
