"""Ordered rules over columns, and rule files.

A rule is a name, a condition and values. First match wins or all matches are listed; both are one expression,
so a rule table of any usual size costs one pass and no join.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.ranks import ranked


def first_match(rules: Sequence[tuple], names: Sequence[str], types: Sequence[str]) -> Column:
    """Struct of the values of the first rule whose condition holds; all null where none does.

    rules: (condition, value, ..), the condition a Column or SQL text. A condition that is null does not hold.
    """
    out = None
    for condition, *values in reversed(list(rules)):
        row = F.struct(*[F.lit(v).cast(t).alias(n) for v, n, t in zip(values, names, types)])
        held = F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))
        out = F.when(held, row) if out is None else F.when(held, row).otherwise(out)
    none = F.struct(*[F.lit(None).cast(t).alias(n) for n, t in zip(names, types)])
    return F.coalesce(out, none) if out is not None else none


def all_matches(rules: Sequence[tuple[Column | str, str]]) -> Column:
    """Names of all rules whose condition holds, in rule order."""
    return F.array_compact(F.array(*[F.when(F.expr(c) if isinstance(c, str) else c, F.lit(n)) for c, n in rules]))


def load(spark: SparkSession, path: str, key: str) -> list[dict]:
    """The records under ``key`` of a JSON rule file; rules are configuration, so they are read on the driver.

    A file without the key, or with a record that is no object, is an error.
    """
    text = "\n".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect())
    doc = json.loads(text)
    if key not in doc or not all(isinstance(r, dict) for r in doc[key]):
        raise ValueError(f"rule file {path} has no list of records under {key!r}")
    return doc[key]


def table(spark: SparkSession, records: Sequence[dict], schema: str) -> DataFrame:
    """Rule records as a table; fields a record lacks are null."""
    names = [f.name for f in spark.createDataFrame([], schema).schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema)


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def packets(df: DataFrame, order: Sequence[Column], size: int) -> DataFrame:
    """Adds ``packet`` (from 1) and ``place``: consecutive packets of ``size`` rows.

    Rows are numbered over one global range sort, so no task holds all rows. order must be total.
    """
    got = ranked(df, [], order)
    return got.select(*df.columns, (F.floor((F.col("rank") - 1) / size) + 1).cast("long").alias("packet"), ((F.col("rank") - 1) % size + 1).cast("long").alias("place"))
