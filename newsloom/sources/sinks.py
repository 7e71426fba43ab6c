"""Sinks: day partitions that can be written again, sorted chunks, append of unseen keys, line formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_days(df: DataFrame, path: str, day: str) -> None:
    """Write day partitions; days in ``df`` replace the stored ones, other days stay.

    Rows are brought together by day, and adaptive execution cuts a large day into as many tasks, and files, as its size needs.
    """
    writer = df.hint("rebalance", F.col(day)).write.partitionBy(day).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").option("compression", "zstd").parquet(path)


def write_chunks(df: DataFrame, path: str, key: str, rows: int = 4096) -> None:
    """Files of at most ``rows`` rows, sorted by ``key`` over all files, so that footers prune point lookups."""
    df.repartitionByRange(F.col(key)).sortWithinPartitions(key).write.option("maxRecordsPerFile", rows).mode("overwrite").parquet(path)


def append_new(spark: SparkSession, df: DataFrame, path: str, key: str) -> None:
    """Append the rows whose key is not stored yet; a repeated key in ``df`` counts once."""
    fresh = df.dropDuplicates([key])
    try:
        fresh = fresh.join(spark.read.parquet(path).select(key), key, "left_anti")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
    fresh.write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def train_line(label: Column, text: Column) -> Column:
    """``__label__X text`` on one line."""
    return F.concat(F.lit("__label__"), label, F.lit(" "), F.btrim(F.regexp_replace(text, r"\s+", " ")))


def write_lines(df: DataFrame, line: Column, path: str) -> None:
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def manifest(df: DataFrame, day: str) -> DataFrame:
    """One row per stored day with its number of rows."""
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("rows"))


def projected_bytes(rows: Column, sample_rows: Column, sample_bytes: Column) -> Column:
    """Size expected for ``rows`` rows from a measured sample; null without a sample."""
    return F.when(sample_rows > 0, rows * sample_bytes / sample_rows)


def markdown(title: str, df: DataFrame, limit: int = 50) -> str:
    """A small report as Markdown: the first ``limit`` rows (a report's feature) as a table."""
    rows = df.limit(limit).collect()
    head = "| " + " | ".join(df.columns) + " |\n|" + " --- |" * len(df.columns)
    body = "\n".join("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows)
    return f"# {title}\n\n{head}\n{body}\n"


# --- a store: one folder a table, one partition a day, and a manifest ----------------------------------


def write_store(tables: dict[str, DataFrame], root: str, days: dict[str, str]) -> None:
    """Write the tables of a store by day and record what it holds.

    days: the day column of every table. Days written again replace the stored ones, in every table; the manifest,
    one JSON line per table and day with its rows and the folder it lies in, is renewed last.
    """
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        write_days(df.withColumnRenamed(days[name], "dt"), f"{root}/{name}", "dt")
    write_manifest(spark, root, list(tables))


def write_manifest(spark: SparkSession, root: str, names: list[str]) -> None:
    rows = None
    for name in names:
        stored = spark.read.parquet(f"{root}/{name}")
        one = stored.groupBy("dt").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), F.col("dt").cast("date").alias("dt"), "rows", F.concat(F.lit(f"{name}/dt="), F.col("dt").cast("string")).alias("folder"))
        rows = one if rows is None else rows.unionByName(one)
    rows.coalesce(1).write.mode("overwrite").json(f"{root}/_manifest")  # a row per table and day


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """(table, dt, rows, folder) of a store; empty where there is none."""
    schema = "`table` string, dt date, `rows` long, folder string"
    try:
        return spark.read.schema(schema).json(f"{root}/_manifest")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def clear_day(spark: SparkSession, root: str, names: list[str], day: str) -> None:
    """Delete a day from the tables of a store, and from its manifest."""
    from newsloom.cut import _delete

    for name in names:
        _delete(spark, f"{root}/{name}/dt={day}")
    write_manifest(spark, root, names)


def write_ranged(df: DataFrame, path: str, key: str, rows: int = 4096) -> None:
    """Chunks sorted by ``key`` with an index of the smallest and largest key of every file beside them."""
    write_chunks(df, f"{path}/chunks", key, rows)
    spark = df.sparkSession
    stored = spark.read.parquet(f"{path}/chunks").select(F.input_file_name().alias("file"), F.col(key).alias("k"))
    index = stored.groupBy("file").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count(F.lit(1)).alias("rows"))
    index.write.mode("overwrite").parquet(f"{path}/index")


def append_ledger(df: DataFrame, path: str) -> None:
    """Append events to a ledger of JSON lines; what stands in it is never rewritten."""
    df.write.mode("append").option("ignoreNullFields", False).json(path)


def stage(df: DataFrame, path: str, day: str) -> None:
    """Add files to day folders beside those that are there; file names never collide."""
    df.hint("rebalance", F.col(day)).write.partitionBy(day).mode("append").parquet(path)


def markdown_lines(df: DataFrame, title: str, order: list[str]) -> DataFrame:
    """The lines of a Markdown table of a small report: (line, text)."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    rows = df.orderBy(*order).select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("t"))
    every = rows.groupBy().agg(F.collect_list("t").alias("t"))  # a report, read by people
    head = F.array(F.lit(f"# {title}"), F.lit(""), F.lit("| " + " | ".join(df.columns) + " |"), F.lit("|" + " --- |" * len(df.columns)))
    return every.select(F.posexplode(F.concat(head, "t")).alias("line", "text"))
