"""Items that appear together: stripes of co-occurrence counts with log-likelihood ratios.

Each task keeps, per item, an associative array (stripe) of the items that follow it in the same record
and adds records to it in memory, so a hot item leaves a task as one stripe and not as one row per
record. Stripes are then merged by key: their entries are summed over (item, neighbour), which spreads
even the stripe of an item that sits in a third of all records over many tasks. An item's own entry is
its record count and the entry without an item counts the records, so one pass gives every margin.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.cut import materialize

STRIPE = "field string, item_a string, neighbours array<string>, counts array<long>"


def stripes(records: DataFrame, hold: int = 1_000_000) -> DataFrame:
    """(field, items) -> partial stripes (field, item_a, neighbours, counts).

    items: array of strings; nulls and repeats inside a record count once or not at all.
    hold: entries a task keeps before it hands its partial stripes on; no entry is ever dropped.
    """
    schema = pa.schema([("field", pa.string()), ("item_a", pa.string()), ("neighbours", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])

    def flush(acc: dict, total: Counter) -> Iterator[pa.RecordBatch]:
        rows = [(f, a, list(c), list(c.values())) for (f, a), c in acc.items()] + [(f, None, [None], [n]) for f, n in total.items()]
        for k in range(0, len(rows), 2000):
            cols = list(zip(*rows[k : k + 2000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)
        acc.clear()
        total.clear()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[tuple[str, str], Counter] = {}
        total: Counter = Counter()
        size = 0
        for b in batches:
            for f, items in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[f] += 1
                for k, a in enumerate(items):
                    c = acc.get((f, a))
                    if c is None:
                        c = acc[f, a] = Counter()
                    had = len(c)
                    c.update(items[k:])
                    size += len(c) - had
                    if size > hold:  # also inside a record: one with very many items fills the memory alone
                        yield from flush(acc, total)
                        size = 0
        yield from flush(acc, total)

    clean = F.array_sort(F.array_distinct(F.filter("items", lambda x: x.isNotNull())))
    return records.select("field", clean.alias("items")).filter(F.size("items") > 0).mapInArrow(run, STRIPE)


def merge_stripes(parts: DataFrame) -> DataFrame:
    """Sum stripes entry by entry: (field, item_a, item_b, n). item_a = item_b: records of the item; both null: all records."""
    cells = parts.select("field", "item_a", F.explode(F.arrays_zip("neighbours", "counts")).alias("c"))
    return cells.groupBy("field", "item_a", F.col("c.neighbours").alias("item_b")).agg(F.sum("c.counts").alias("n"))


def log_likelihood_ratio(n_ab: Column, n_a: Column, n_b: Column, n: Column) -> Column:
    """Dunning's G2 of the two-by-two table of records with and without each item."""
    h = lambda x: F.when(x > 0, x * F.log(x)).otherwise(F.lit(0.0))
    ab, a, b, t = (x.cast("double") for x in (n_ab, n_a, n_b, n))
    cells = h(ab) + h(a - ab) + h(b - ab) + h(t - a - b + ab)
    return F.greatest(F.lit(0.0), 2.0 * (cells - h(a) - h(t - a) - h(b) - h(t - b) + h(t)))


def pair_counts(records: DataFrame, min_together: int = 1, hold: int = 1_000_000) -> DataFrame:
    """Pairs of items with counts, lift and log-likelihood ratio.

    records: (field string, items array<string>), one row per record; other columns are not read.
    min_together: a pair must meet in so many records (a threshold of the report, applied to exact counts).
    Returns (field, item_a, item_b, n_ab, n_a, n_b, n_records, lift, llr) with item_a < item_b. Records
    without items count nowhere; an empty table gives an empty result.
    """
    merged = materialize(merge_stripes(stripes(records, hold)), "stripes")
    own = merged.filter(F.col("item_a") == F.col("item_b"))
    pairs = merged.filter((F.col("item_a") != F.col("item_b")) & (F.col("n") >= min_together))
    pairs = pairs.withColumnRenamed("n", "n_ab")
    pairs = pairs.join(own.select("field", "item_a", F.col("n").alias("n_a")), ["field", "item_a"]).join(own.select("field", "item_b", F.col("n").alias("n_b")), ["field", "item_b"])
    # one row per field
    total = F.broadcast(merged.filter(F.col("item_a").isNull()).select("field", F.col("n").alias("n_records")))
    out = pairs.join(total, "field")
    lift = F.col("n_ab") * F.col("n_records") / (F.col("n_a").cast("double") * F.col("n_b"))
    return out.select("field", "item_a", "item_b", "n_ab", "n_a", "n_b", "n_records", lift.alias("lift"), log_likelihood_ratio(F.col("n_ab"), F.col("n_a"), F.col("n_b"), F.col("n_records")).alias("llr"))
