"""Streaming front end: day files in, daily and hourly mention counts out, with the batch results as the measure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsloom.plans.graph import days_to_relink, factor_score, links, rollup


def read_days(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """Stream of the Parquet files that appear under ``path``; the checkpoint of the sink is the ledger of what was read."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def fresh(events: DataFrame, key: str, time: str, late: str = "10 days") -> DataFrame:
    """Each key once. Rows later than ``late`` are dropped, and state older than that is freed."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def buckets(events: DataFrame, time: str, keys: list[str], width: str = "1 hour", late: str = "10 days") -> DataFrame:
    """Counts per tumbling window and key; a window is final once the watermark has passed it."""
    g = events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("start"), *keys, "n")


def run_available(df: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process everything available and stop; a second run goes on where the first ended."""
    q = df.writeStream.format("parquet").outputMode(mode).option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def maintain_panel(mentions: DataFrame, store: str, panel: str, link_path: str, checkpoint: str) -> StreamingQuery:
    """Keep the stored mentions, the daily panel and the day-to-day links current.

    Every micro-batch appends its mentions by day, recomputes the panel of the days it touched and the
    links of those days and the days after them, and replaces exactly these partitions. Late and
    out-of-order days give the same state as one batch over everything; a batch that runs again after a
    failure replaces what it wrote, because appended files carry the batch number.
    """
    spark = mentions.sparkSession
    keys = ["factor_label", "geo_label"]

    def write(df: DataFrame, path: str, batch: int) -> None:
        df = df.persist()
        try:
            df.withColumn("batch", F.lit(batch)).write.partitionBy("batch", "bucket_time").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
            days = [r[0] for r in df.select("bucket_time").distinct().collect()]  # the days of one micro-batch
        finally:
            df.unpersist()
        if not days:
            return
        near = [r[0] for r in days_to_relink(spark.createDataFrame([(d,) for d in days], "bucket_time date")).collect()]
        stored = spark.read.parquet(path).filter(F.col("bucket_time").isin(days))
        scored = rollup(stored, ["bucket_time", *keys]).withColumn("narrative_score", factor_score())
        replace(scored, panel)
        every = spark.read.parquet(panel)
        # links of day d need d and d - 1
        need = every.filter(F.col("bucket_time").isin(near) | F.date_add("bucket_time", 1).isin(near))
        replace(links(need.select("bucket_time", *keys, "doc_count", "narrative_score"), keys).filter(F.col("bucket_time").isin(near)), link_path)

    def replace(df: DataFrame, path: str) -> None:
        df.write.partitionBy("bucket_time").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)

    q = mentions.writeStream.foreachBatch(lambda df, n: write(df, store, n)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
