"""Small table operators: anti-joined appends, fallback lookups, overrides, interleaving, evaluation counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.operators.ranks import ranked


def unseen(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose keys ``old`` lacks; null keys count as unseen."""
    return new.join(old.select(*keys).distinct(), list(keys), "left_anti")


def lookup(df: DataFrame, dim: DataFrame, keys: Sequence[tuple[Column, str]], value: str, default: Column) -> DataFrame:
    """Adds ``value`` from ``dim`` by the first of several keys that is found, else ``default``."""
    found: list[Column] = []
    for k, (expr, name) in enumerate(keys):
        side = dim.select(F.col(name).alias(f"__k{k}"), F.col(value).alias(f"__v{k}")).dropDuplicates([f"__k{k}"])
        df = df.withColumn(f"__e{k}", expr).join(side, F.col(f"__e{k}") == F.col(f"__k{k}"), "left")
        found.append(F.col(f"__v{k}"))
    drop = [f"__{x}{k}" for k in range(len(keys)) for x in "kve"]
    return df.withColumn(value, F.coalesce(*found, default)).drop(*drop)


def override(base: DataFrame, over: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``columns`` of ``over`` where it has the key and a value, else those of ``base``."""
    o = over.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    out = base.join(o, key, "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(f"__{c}", c))
    return out.drop(*[f"__{c}" for c in columns])


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of both by key; new non-null values win; ``change`` says insert, update or keep."""
    cols = [c for c in old.columns if c != key]
    a, b = old.withColumn("__old", F.lit(True)), new.select(key, *[F.col(c).alias(f"__{c}") for c in cols]).withColumn("__new", F.lit(True))
    out = a.join(b, key, "full")
    change = F.when(F.col("__old").isNull(), "insert").when(F.col("__new").isNull(), "keep").otherwise("update")
    return out.select(key, *[F.coalesce(f"__{c}", c).alias(c) for c in cols], change.alias("change"))


def range_index(df: DataFrame, chunk: Column, key: str) -> DataFrame:
    """(chunk, lo, hi): smallest and largest key of every file or other chunk; chunks without keys have no row."""
    return df.filter(F.col(key).isNotNull()).groupBy(chunk.alias("chunk")).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))


def overlapping(index: DataFrame, ranges: DataFrame, bins: int = 4096) -> DataFrame:
    """Chunks of an index that a range overlaps: every column of ``ranges`` (which has lo and hi) and ``chunk``.

    Both sides are cut at the edges of equal bins of the index's ids and meet in a bin, the later start deciding in
    which, so that the join has an equal key and every pair comes once. Ends belong to a range; ids are whole numbers.
    """
    low, high = index.agg(F.min("lo"), F.max("hi")).first()
    if low is None:
        low = high = 0
    width = (high - low) // bins + 1
    at = lambda c: F.floor((c - low) / width)
    cut = lambda df: df.withColumn("__bin", F.explode(F.sequence(at(F.greatest(F.col("lo"), F.lit(low))), at(F.least(F.col("hi"), F.lit(high))))))
    one = cut(index.filter("lo <= hi").select("chunk", "lo", "hi")).select("__bin", "chunk", F.col("lo").alias("__lo"), F.col("hi").alias("__hi"))
    two = cut(ranges.filter((F.col("lo") <= F.col("hi")) & (F.col("hi") >= low) & (F.col("lo") <= high)))
    start = F.greatest("lo", "__lo")
    met = two.join(one, "__bin").filter((start <= F.least("hi", "__hi")) & (at(start) == F.col("__bin")))
    return met.select(*ranges.columns, "chunk")


def round_robin(df: DataFrame, stratum: str, order: Sequence[Column]) -> DataFrame:
    """Adds ``turn``: one row of every stratum per round, larger strata first; order must be total.

    Turns are ranks of one global sort, so a stratum that holds most rows is not gathered in a task.
    """
    size = df.groupBy(F.col(stratum).alias("__s")).agg(F.count(F.lit(1)).alias("__size"))
    out = ranked(df, [stratum], list(order)).withColumnRenamed("rank", "turn").join(size, F.col(stratum).eqNullSafe(F.col("__s")))
    return out.orderBy("turn", F.desc("__size"), stratum).drop("__size", "__s")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.filter(F.col(truth).isNotNull() & F.col(predicted).isNotNull()).groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def scores(matrix: DataFrame) -> DataFrame:
    """Confusion counts -> precision, recall, F1 and support of every label that occurs as truth or prediction."""
    by_truth = matrix.groupBy(F.col("truth").alias("label")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)).alias("hit"))
    by_pred = matrix.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("called"))
    t = by_truth.join(by_pred, "label", "full").fillna(0, ["support", "hit", "called"])
    p = F.when(F.col("called") > 0, F.col("hit") / F.col("called")).otherwise(0.0)
    r = F.when(F.col("support") > 0, F.col("hit") / F.col("support")).otherwise(0.0)
    t = t.withColumn("precision", p).withColumn("recall", r)
    f1 = F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return t.select("label", "support", "precision", "recall", f1.alias("f1"))


def averages(by_label: DataFrame) -> DataFrame:
    """Macro and support-weighted F1, and accuracy (the weighted recall)."""
    w = F.sum("support")
    return by_label.agg(F.avg("f1").alias("macro_f1"), (F.sum(F.col("f1") * F.col("support")) / w).alias("weighted_f1"), (F.sum(F.col("recall") * F.col("support")) / w).alias("accuracy"))
