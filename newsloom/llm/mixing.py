"""Mixing sources to target weights by pivotal dependent rounding.

Every record of a source gets the same expected number of copies. Its whole part is certain; the
fractions are rounded by the pivotal method: two fractional records meet, mass moves at random from one
to the other until one of them is 0 or 1, and the other goes on. Expectations are kept exactly and the
number of copies of a source is its target rounded up or down. A task ends with at most one fractional
record per source; these residuals meet in a reduction tree with a fixed fan-in, never in one place.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.cut import materialize

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
MASK = (1 << 64) - 1


def token_counts(df: DataFrame, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """Adds ``tokens`` (long), the size of ``text`` under the tokenizer file; null and empty texts have 0. Whole texts are counted.

    The file is read on the driver and sent with the job, so executors need no copy of it.
    """
    cols = df.columns
    with open(tokenizer, encoding="utf-8") as f:
        sent = df.sparkSession.sparkContext.broadcast(f.read())
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema.fields if f.name != text)}{', ' if len(cols) > 1 else ''}tokens long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(sent.value)
        t.encode_special_tokens = True
        for b in batches:
            at = b.schema.get_field_index(text)
            sizes: list[int] = []
            texts = [x or "" for x in b.column(at).to_pylist()]
            for k in range(0, len(texts), 64):
                sizes += [len(e) for e in t.encode_batch_fast(texts[k : k + 64], add_special_tokens=False)]
            rest = [i for i in range(b.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in rest), pa.array(sizes, pa.int64())], names=[*(b.schema.names[i] for i in rest), "tokens"])

    return df.mapInArrow(run, schema)


def source_key(c: Column) -> Column:
    """Source names compare without letter case and surrounding spaces; blank is null."""
    s = F.lower(F.btrim(c))
    return F.when(s != "", s)


def _uniform(a: int, b: int, seed: int) -> float:
    """A number in [0, 1) that depends on the two records and the seed only (splitmix64)."""
    x = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + seed * 0x165667B19E3779F9) & MASK
    for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ (x >> shift)) * mult) & MASK
    return ((x ^ (x >> 31)) >> 11) / (1 << 53)


def duel(a: tuple[int, float], b: tuple[int, float], seed: int) -> tuple[list[tuple[int, int]], tuple[int, float] | None]:
    """One pivotal step: the records that became integral as (id, 0 or 1) and the one that stays fractional."""
    (i, p), (j, q) = a, b
    u, s = _uniform(i, j, seed), p + q
    if s < 1 - 1e-12:
        return ([(j, 0)], (i, s)) if u < p / s else ([(i, 0)], (j, s))
    if s <= 1 + 1e-12:
        return ([(i, 1), (j, 0)], None) if u < p / s else ([(i, 0), (j, 1)], None)
    keep = s - 1
    return ([(i, 1)], (j, keep)) if u < (1 - q) / (2 - s) else ([(j, 1)], (i, keep))


def pivotal(units: Iterable[tuple[int, float]], seed: int) -> tuple[list[tuple[int, int]], tuple[int, float] | None]:
    """Round (id, fraction) units in order; returns the rounded ones and at most one residual."""
    done: list[tuple[int, int]] = []
    held: tuple[int, float] | None = None
    for i, p in units:
        if p <= 1e-12 or p >= 1 - 1e-12:
            done.append((i, int(p > 0.5)))
        elif held is None:
            held = (i, p)
        else:
            out, held = duel(held, (i, p), seed)
            done += out
    return done, held


def mix(documents: DataFrame, targets: DataFrame, size: int | None = None, seed: int = 7, fan_in: int = 16, tokenizer: str = TOKENIZER, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """Copies of every record and the shares reached.

    targets: (source, target_share, max_repeats); names that fall together add their shares and take the
    largest cap, null shares and caps count as 0. size: tokens of the mix, by default those of all
    documents, records without a source included. A source needs ``target_share * size`` tokens; its
    records are repeated ``needed / own`` times on average, never more than ``max_repeats`` times.
    Records without id count in the total only; sources without a target are left out of the mix.

    Returns (plan, report): plan (doc_id, source, tokens, copies) for every record of a targeted source;
    report (source, target_share, max_repeats, docs, own_tokens, needed_tokens, reachable, mix_tokens,
    least_copies, actual_share) for every targeted source. Rounding keeps the number of copies of a source within one of
    its target, so its tokens miss the target by the spread of its records' sizes.
    """
    sized = token_counts(documents.select(F.col(doc_id).cast("long").alias("doc_id"), source_key(F.col(source)).alias("source"), F.col(text).alias("__text")), "__text", tokenizer)
    sized = materialize(sized, "sizes")
    goals = targets.select(source_key(F.col("source")).alias("source"), F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce("max_repeats", F.lit(0)).alias("max_repeats"))
    goals = goals.filter(F.col("source").isNotNull()).groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    total = size if size is not None else (sized.agg(F.sum("tokens")).first()[0] or 0)
    own = sized.filter(F.col("source").isNotNull()).groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("tokens").alias("own_tokens"))
    needed = F.col("target_share") * F.lit(float(total))
    wanted = goals.join(own, "source", "left").fillna(0, ["docs", "own_tokens"]).withColumn("needed_tokens", needed)
    wanted = wanted.withColumn("reachable", F.col("needed_tokens") <= F.col("max_repeats") * F.col("own_tokens"))
    wanted = wanted.withColumn("rate", F.when(F.col("own_tokens") > 0, F.least(F.col("needed_tokens") / F.col("own_tokens"), F.col("max_repeats").cast("double"))).otherwise(F.lit(0.0)))
    wanted = materialize(wanted, "targets")
    fields = [("source", pa.string()), ("doc_id", pa.int64()), ("tokens", pa.int64()), ("copies", pa.int64()), ("left", pa.float64()), ("slot", pa.int64())]
    schema = pa.schema(fields)
    spec = "source string, doc_id long, tokens long, copies long, left double, slot long"

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = TaskContext.get().partitionId()
        held: dict[str, tuple[int, float]] = {}
        kept: dict[int, tuple[str, int, int]] = {}
        for b in batches:
            rows = []
            for s, i, n, rate in zip(*(b.column(k).to_pylist() for k in range(4))):
                whole = int(rate)
                p = rate - whole
                if p <= 1e-12 or p >= 1 - 1e-12:
                    rows.append((s, i, n, whole + int(p > 0.5), None, slot))
                    continue
                kept[i] = (s, n, whole)
                if s not in held:
                    held[s] = (i, p)
                    continue
                out, rest = duel(held.pop(s), (i, p), seed)
                if rest:
                    held[s] = rest
                for j, one in out:
                    t, m, w = kept.pop(j)
                    rows.append((t, j, m, w + one, None, slot))
            yield batch(rows)
        yield batch([(s, i, kept[i][1], kept[i][2], p, slot) for s, (i, p) in held.items()])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [[] for _ in fields]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)], schema=schema)

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["slot", "doc_id"])
        done, rest = pivotal(zip(pdf["doc_id"].tolist(), pdf["left"].tolist()), seed)
        ones = dict(done)
        out = pdf.copy()
        out["copies"] = [int(c) + ones.get(i, 0) for i, c in zip(pdf["doc_id"], pdf["copies"])]
        out["left"] = [rest[1] if rest and rest[0] == i else None for i in pdf["doc_id"]]
        out["left"] = out["left"].astype("float64")
        return out

    # one row per targeted source on the right; the source of a third of all records only makes the left side long
    goal = wanted.select(F.col("source").alias("s"), "rate")
    rated = sized.filter(F.col("doc_id").isNotNull()).join(goal, F.col("source") == F.col("s")).select("source", "doc_id", "tokens", "rate")
    stage = materialize(rated.mapInArrow(first, spec), "rounded")
    done = stage.filter(F.col("left").isNull())
    left = stage.filter(F.col("left").isNotNull())
    slots = (left.agg(F.max("slot")).first()[0] or 0) + 1
    while slots > 1:  # the depth of the tree: log of the number of tasks
        left = left.withColumn("slot", F.floor(F.col("slot") / fan_in).cast("long"))
        met = materialize(left.groupBy("source", "slot").applyInPandas(lambda pdf: meet(pdf)[["source", "doc_id", "tokens", "copies", "left", "slot"]], spec), "met")
        done = done.unionByName(met.filter(F.col("left").isNull()))
        left = met.filter(F.col("left").isNotNull())
        slots = -(-slots // fan_in)
    coin = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)) < F.col("left")
    plan = done.unionByName(left.withColumn("copies", F.col("copies") + coin.cast("long"))).select("doc_id", "source", "tokens", "copies")
    got = plan.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mix_tokens"), F.min("copies").alias("least_copies"))
    report = wanted.join(got, "source", "left").fillna(0, ["mix_tokens"])
    whole = report.select(F.sum("mix_tokens").alias("t"))
    report = report.withColumn("actual_share", F.col("mix_tokens") / F.nullif(whole.scalar(), F.lit(0)))
    return plan, report.select("source", "target_share", "max_repeats", "docs", "own_tokens", "needed_tokens", "reachable", "mix_tokens", "least_copies", "actual_share")
