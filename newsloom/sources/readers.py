"""Scans: Parquet trees with drifting schemas, delimited and line formats, file catalogs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.text import blank_to_null


def parquet_union(spark: SparkSession, *paths: str, day: str | None = None, days: Sequence[str] | None = None) -> DataFrame:
    """Parquet files united by column name; ``days`` becomes a filter on ``day`` that reaches the scan."""
    df = spark.read.option("mergeSchema", "true").parquet(*paths)
    return df.filter(F.col(day).cast("date").isin(*[F.lit(d).cast("date") for d in days])) if days is not None else df


def alias(df: DataFrame, names: Sequence[str]) -> Column:
    """The first of ``names`` that the frame has, in any letter case, blank as null; a typed null if it has none."""
    have = {c.lower(): c for c in df.columns}
    found = next((have[n.lower()] for n in names if n.lower() in have), None)
    return blank_to_null(F.col(f"`{found}`")) if found else F.lit(None).cast("string")


def partition_dates(df: DataFrame, day: str) -> DataFrame:
    """Distinct days present; values that are no dates are left out."""
    return df.select(F.col(day).try_cast("date").alias(day)).filter(F.col(day).isNotNull()).distinct()


def date_in_path(c: Column) -> Column:
    """Day named in a path, as ``dt=yyyy-MM-dd`` or ``_yyyy_MM_dd``; else null."""
    iso = F.regexp_extract(c, r"dt=(\d{4}-\d{2}-\d{2})", 1)
    low = F.regexp_replace(F.regexp_extract(c, r"_(\d{4}_\d{2}_\d{2})(?:\D|$)", 1), "_", "-")
    return F.when(iso != "", iso).when(low != "", low).try_cast("date")


def new_files(spark: SparkSession, path: str, catalog: DataFrame | None = None) -> DataFrame:
    """(path, sha256, bytes) of the files not in ``catalog``, which holds the same columns: a file is loaded once per content.

    For files of any form up to 2 GB, which one task reads whole; :func:`content_keys` tells larger tables by their rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    seen = files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
    return seen if catalog is None else seen.join(catalog.select("path", "sha256"), ["path", "sha256"], "left_anti")


def content_keys(df: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """(path, rows, key) of the files of a table, whatever their size: a file is known again by the hashes of its rows, in any order.

    Rows are hashed where they are read and combined per file; files in ``catalog`` with the same key are left out.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    got = df.select(F.input_file_name().alias("path"), row.alias("h")).groupBy("path").agg(F.count(F.lit(1)).alias("rows"), F.concat_ws("-", F.hex(F.bit_xor("h")), F.hex(F.sum(F.shiftrightunsigned("h", 24)))).alias("key"))
    return got if catalog is None else got.join(catalog.select("rows", "key"), ["rows", "key"], "left_anti")


def csv(spark: SparkSession, path: str, quoted_breaks: bool = True) -> DataFrame:
    """Delimited text with a header, every column a string. quoted_breaks: line breaks inside quotes are kept, and a file is one task; without them files are split."""
    return spark.read.csv(path, header=True, multiLine=quoted_breaks, escape='"')


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; a broken line gives a row with its text in ``_corrupt`` instead of an error."""
    return spark.read.schema(f"{schema}, _corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def xml_rows(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def labelled_lines(spark: SparkSession, path: str) -> DataFrame:
    """``__label__X text`` lines -> (label, text); other lines are left out."""
    v = F.col("value")
    return spark.read.text(path).filter(v.startswith("__label__")).select(F.regexp_extract(v, r"^__label__(\S+)", 1).alias("label"), F.regexp_replace(v, r"^\S+\s?", "").alias("text"))


def answer_rows(answer: Column, schema: str) -> Column:
    """Array of records in a model's answer, bare or in a fenced block; null where there is none."""
    fenced = F.regexp_extract(answer, r"(?s)```(?:json)?\s*(\[.*?\])\s*```", 1)
    bare = F.regexp_extract(answer, r"(?s)(\[.*\])", 1)
    return F.from_json(F.when(fenced != "", fenced).when(bare != "", bare), f"array<struct<{schema}>>")


def single_day(df: DataFrame, day: str) -> DataFrame:
    """The only day of a file; none or several are an error."""
    d = F.col(day).try_cast("date")
    n = F.count_distinct(d)
    return df.agg(F.when(n == 1, F.max(d)).otherwise(F.raise_error(F.lit("file must hold exactly one day"))).alias(day))


def compatible(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Project to (name, type) columns; those the frame lacks become typed nulls."""
    have = set(df.columns)
    return df.select(*[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in columns])


def store_days(spark: SparkSession, root: str, name: str, low: str | None = None, high: str | None = None) -> DataFrame:
    """A table of a store between two days, by partition pruning; any file system Spark can name will do."""
    df = spark.read.parquet(f"{root}/{name}")
    df = df.filter(F.col("dt") >= F.lit(low).cast("date")) if low else df
    return df.filter(F.col("dt") <= F.lit(high).cast("date")) if high else df


def from_manifest(spark: SparkSession, root: str, name: str, days: Sequence[str] | None = None) -> DataFrame:
    """A table of a store by the folders its manifest names, without listing the store."""
    from newsloom.sources.sinks import read_manifest

    m = read_manifest(spark, root).filter(F.col("table") == name)
    m = m.filter(F.col("dt").isin(*[F.lit(d).cast("date") for d in days])) if days is not None else m
    folders = [f"{root}/{r[0]}" for r in m.select("folder").orderBy("folder").collect()]  # one per day
    if not folders:
        raise ValueError(f"the manifest of {root} has no such days of {name}")
    return spark.read.option("basePath", f"{root}/{name}").parquet(*folders)


def workspace(spark: SparkSession, root: str, window: Sequence[str], whole: Sequence[str], low: str, high: str, prefix: str = "ws_") -> dict[str, DataFrame]:
    """Named views on a store: tables of ``window`` between two days, tables of ``whole`` on all days. Nothing is copied."""
    out = {n: store_days(spark, root, n, low, high) for n in window} | {n: store_days(spark, root, n) for n in whole}
    for n, df in out.items():
        df.createOrReplaceTempView(prefix + n)
    return out


_kept: dict[tuple, DataFrame] = {}


def kept(df: DataFrame, *key: str) -> DataFrame:
    """A table kept in the shared folder under a key, as store, hash of its manifest and days; computed once a session."""
    from newsloom.cut import exists, materialize, retain

    at = (df.sparkSession.sparkContext.applicationId, *key)
    if at not in _kept or not exists(df.sparkSession, _kept[at]._newsloom_path):
        _kept[at] = retain(materialize(df, "kept"))
    return _kept[at]
