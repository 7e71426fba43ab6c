"""Exact ranks inside keys without gathering a key: one global range sort, runs and prefix sums.

Rows are sorted over all tasks by key and order. Each task numbers the rows of its runs (rows of one key that
follow one another). Only the first run of a task can have begun in an earlier one: every task reports its last
run, a prefix sum over these reports, one row per task, says how far that run had come. Rows are never joined on
their key, and a key that holds a third of them is spread over many tasks like any other rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.cut import materialize


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds to sorted rows with a ``__key``: ``__task``, ``__at`` (place in the task), ``__run`` (place in the run of the key, from 1) and ``__first`` (the task's first run)."""
    names = [f.name for f in rows.schema.fields]
    column = names.index("__key")
    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", __task int, __at long, __run long, __first boolean"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        last, length, first, at = None, 0, True, 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            key, place = b.column(column), np.arange(n)
            new = np.ones(n, bool)
            new[0] = key[0].as_py() != last
            if n > 1:
                new[1:] = pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
            number = place - np.maximum.accumulate(np.where(new, place, 0)) + 1
            runs = np.cumsum(new)
            number[runs == 0] += length
            in_first = runs == 1 if last is None else (runs == 0) & first
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(n, task, np.int32)), pa.array(at + place), pa.array(number), pa.array(in_first)], names=[*names, "__task", "__at", "__run", "__first"])
            last, length, first, at = key[n - 1].as_py(), int(number[-1]), bool(in_first[-1]), at + n

    return rows.mapInArrow(run, spec)


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], parts: int | None = None) -> DataFrame:
    """Number the rows of every key by ``order``: adds ``rank`` (from 1); without keys all rows are one.

    order must be total (end with a unique column), so that a repeated task finds the same places. Null keys are a key.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(k).asc_nulls_first() for k in keys] + list(order)
    keyed = df.withColumn("__key", F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}) if keys else F.lit(""))
    table = materialize(_numbered(keyed.repartitionByRange(n, *by).sortWithinPartitions(*by)), "sorted")
    # one row per task from here on: its first key, and its last one with the rows it has of that
    task = table.groupBy("__task").agg(F.min_by("__key", "__at").alias("head"), F.max_by(F.struct("__key", "__run"), "__at").alias("tail"))
    task = task.select("__task", "head", F.col("tail.__key").alias("tail"), F.sum("tail.__run").over(Window.partitionBy("tail.__key").orderBy("__task")).alias("so_far"))
    line = Window.orderBy("__task")
    before = task.select("__task", "head", F.lag("tail").over(line).alias("tail"), F.lag("so_far").over(line).alias("__before")).filter("head = tail").select("__task", "__before")
    out = table.join(F.broadcast(before), "__task", "left")
    return out.select(*df.columns, (F.col("__run") + F.when(F.col("__first"), F.coalesce("__before", F.lit(0))).otherwise(0)).alias("rank"))


def quantiles(df: DataFrame, group: str, value: str, shares: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Exact quantiles (linear between neighbours) of every group by ranks; nulls do not count, a group of nulls has null quantiles."""
    kept = df.select(group, value)
    r = ranked(kept.filter(F.col(value).isNotNull()), [group], [F.col(value).asc()])  # equal values may change places: their quantile is the same
    size = kept.groupBy(group).agg(F.count(value).alias("__n")).withColumnRenamed(group, "__g")
    r = r.join(size, F.col(group).eqNullSafe(F.col("__g")))
    cells = []
    for p, name in zip(shares, names):
        at = (F.col("__n") - 1) * F.lit(float(p))
        low = F.floor(at)
        weight = F.when(F.col("rank") - 1 == low, 1.0 - (at - low)).when(F.col("rank") - 1 == low + 1, at - low)
        cells.append(F.sum(F.when(weight > 0, weight * F.col(value))).alias(name))
    out = r.groupBy("__g").agg(*cells)
    return size.select(F.col("__g").alias(group)).join(out, F.col(group).eqNullSafe(F.col("__g")), "left").select(group, *names)
