"""Samples under quotas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def quota_pick(df: DataFrame, key: str, strata: Sequence[tuple[str, str, int]], order: str) -> DataFrame:
    """Pick up to a quota per stratum; a row belongs to the first stratum whose condition it meets.

    strata: (name, SQL condition, quota) in order of precedence. Only the picked rows of one stratum move
    to one task, and a quota bounds them.
    """
    taken = None
    for name, condition, quota in strata:
        some = df.filter(condition)
        some = some.join(taken.select(key), key, "left_anti") if taken is not None else some
        some = some.dropDuplicates([key]).orderBy(order, key).limit(quota).withColumn("stratum", F.lit(name))
        taken = some if taken is None else taken.unionByName(some)
    return taken


def capped_sample(df: DataFrame, label: str, domain: str, order: str, quota: int, caps: Sequence[int] = (3, 6, 12)) -> DataFrame:
    """Fill a quota per label, first with few rows per domain, then with more until it is full.

    A row's step is the first cap that its place in its domain fits, and the steps fill the quota one after the
    other; both are row numbers that Spark limits in every partition before it shuffles.
    """
    w = Window.partitionBy(label, domain).orderBy(order)
    few = df.withColumn("at", F.row_number().over(w)).filter(F.col("at") <= caps[-1])
    step = F.lit(len(caps))
    for k, cap in reversed(list(enumerate(caps))):
        step = F.when(F.col("at") <= cap, k).otherwise(step)
    few = few.withColumn("step", step)
    full = Window.partitionBy(label).orderBy("step", order)
    few = few.withColumn("pick", F.row_number().over(full)).filter(F.col("pick") <= quota)
    return few.drop("at")
