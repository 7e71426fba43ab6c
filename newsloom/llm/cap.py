"""Capping records per dominant contributor.

One global range sort by (group, contributor, quality) gives every record its place; no contributor is
ever gathered in one task, however many records it holds. Prefix sums over the tasks give exact positions, and
the position below the contributor's start is the rank that is held against the cap (see
:mod:`newsloom.operators.ranks`). Records are never joined on their contributor or group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.cut import materialize
from newsloom.operators.ranks import ranked

#: Rows of a table that may be sent to every task: well below a hundred megabytes.
SENT_ROWS = 200_000


def site(domain: Column) -> Column:
    """A web site however its domain is written: case, spaces, port, trailing dot and ``www.`` do not count; blank is null."""
    d = F.regexp_replace(F.lower(domain), r"\s+", "")
    d = F.regexp_replace(d, r":\d*$", "")
    d = F.regexp_replace(d, r"\.+$", "")
    d = F.regexp_replace(d, r"^www\.", "")
    return F.when(d != "", d)


def over_cap(df: DataFrame, group: str, contributor: Column, order: list[Column], ident: str, share: float | None = None, most: int | None = None, least: int = 1) -> DataFrame:
    """Rank the records of every contributor inside ``group`` and mark those beyond the cap.

    df: records; rows that repeat ``ident`` count once, rows without it are left out. contributor: the
    expression that names it; records whose contributor is null are never limited and come out with a
    null rank. order: best first, completed by ``ident``. The cap of a group with n records is
    ``max(least, floor(n * share))``, at most ``most``. Returns (ident, group, contributor, rank, cap,
    kept). An empty table gives an empty result; ties are broken by ``ident`` ascending.
    """
    sort_cols = [f"__o{k}" for k in range(len(order))]
    src = df.filter(F.col(ident).isNotNull()).dropDuplicates([ident])
    src = src.select(F.col(ident), F.col(group), contributor.alias("contributor"), *order)
    src = materialize(src.toDF(ident, group, "contributor", *sort_cols), "records")
    limit = F.floor(F.count(F.lit(1)) * F.lit(share)) if share is not None else F.lit(1 << 62)
    caps = src.groupBy(F.col(group).alias("__g")).agg(F.least(F.greatest(F.lit(least), limit.cast("long")), F.lit(most if most is not None else 1 << 62)).alias("cap"))
    caps = materialize(caps, "caps")
    placed = ranked(src.filter(F.col("contributor").isNotNull()), [group, "contributor"], [F.col(c).desc_nulls_last() for c in sort_cols] + [F.col(ident).asc()])
    free = src.filter(F.col("contributor").isNull()).select(ident, group, "contributor", F.lit(None).cast("long").alias("rank"))
    every = placed.select(ident, group, "contributor", "rank").unionByName(free)
    # the groups (days) are counted first; beyond the bound both sides are shuffled and adaptive execution splits a group that is large
    few = F.broadcast(caps) if caps.limit(SENT_ROWS + 1).count() <= SENT_ROWS else caps
    out = every.join(few, F.col(group).eqNullSafe(F.col("__g")), "inner")
    return out.select(ident, group, "contributor", "rank", "cap", F.coalesce(F.col("rank") <= F.col("cap"), F.lit(True)).alias("kept"))
