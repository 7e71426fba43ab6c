"""Frequency of every distinct term: vertical layout with compressed record bitmaps.

Records are numbered densely in the order of their ids, by one range sort with prefix sums, so a record has
the same number in every task and every run over the same records. A task builds, per term, the set of its
record numbers as a compressed bitmap beside an occurrence counter. As in roaring bitmaps a set is cut into
containers of 65,536 records, each stored as a sorted list of 16-bit numbers while it is sparse and as a plain
bitmap once it is dense. Containers of one term merge by union wherever their parts were built; the document
frequency is the cardinality, and the bitmaps of two terms of a field can be intersected.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.cut import materialize
from newsloom.operators.ranks import ranked

SPARSE = 4096
CONTAINER = 1 << 16


def pack(low: np.ndarray) -> bytes:
    """Sorted distinct 16-bit record numbers -> compressed container."""
    if len(low) <= SPARSE:
        return b"a" + low.astype("<u2").tobytes()
    bits = np.zeros(CONTAINER, np.uint8)
    bits[low] = 1
    return b"b" + np.packbits(bits, bitorder="little").tobytes()


def unpack(payload: bytes) -> np.ndarray:
    """Compressed container -> sorted record numbers."""
    if payload[:1] == b"a":
        return np.frombuffer(payload, "<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(payload, np.uint8, offset=1), bitorder="little"))


def union(payloads: list[bytes]) -> bytes:
    """Union of containers that cover the same records."""
    if len(payloads) == 1:
        return payloads[0]
    return pack(np.unique(np.concatenate([unpack(p) for p in payloads])))


def intersection(a: bytes, b: bytes) -> bytes:
    """Records of two containers of the same range that are in both."""
    return pack(np.intersect1d(unpack(a), unpack(b), assume_unique=True))


def cardinality(payload: bytes) -> int:
    """Records in a container."""
    if payload[:1] == b"a":
        return (len(payload) - 1) // 2
    return int.from_bytes(payload[1:], "little").bit_count()


def term_bitmaps(records: DataFrame, hold: int = 400_000) -> DataFrame:
    """(field, terms array[, number]) -> (field, term, container, bitmap, occurrences), partial per task.

    A null term stands for "the record has a value of the field". number: the record's place among all; without the column a record is
    numbered inside its task. hold: entries kept in memory before they are handed on.
    """
    schema = pa.schema([("field", pa.string()), ("term", pa.string()), ("container", pa.int64()), ("bitmap", pa.binary()), ("occurrences", pa.int64())])

    def flush(acc: dict[tuple[str, str | None], list], container: int) -> Iterator[pa.RecordBatch]:
        rows = [(f, t, container, pack(np.array(v[1], np.int64)), v[0]) for (f, t), v in acc.items()]
        for k in range(0, len(rows), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 20_000]), schema.types)], schema=schema)
        acc.clear()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        following = TaskContext.get().partitionId() << 32
        acc: dict[tuple[str, str | None], list] = {}
        size, container = 0, None
        for b in batches:
            numbers = b.column(2).to_pylist()
            for f, terms, number in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), numbers):
                if number is None:
                    number, following = following, following + 1
                if acc and (size > hold or number >> 16 != container):
                    yield from flush(acc, container)
                    size = 0
                container, low = number >> 16, number & (CONTAINER - 1)
                for t in [None, *terms]:
                    v = acc.get((f, t))
                    if v is None:
                        acc[f, t] = [1, [low]]
                    else:
                        v[0] += 1
                        if v[1][-1] != low:
                            v[1].append(low)
                size += len(terms) + 1
        if acc:
            yield from flush(acc, container)

    number = F.col("number") if "number" in records.columns else F.lit(None).cast("long").alias("number")
    clean = records.select("field", F.filter("terms", lambda x: x.isNotNull()).alias("terms"), number).filter(F.size("terms") > 0)
    return clean.mapInArrow(run, "field string, term string, container long, bitmap binary, occurrences long")


def merge_bitmaps(parts: DataFrame) -> DataFrame:
    """Union per container, then the document frequency per term: (field, term, occurrences, docs)."""
    schema = pa.schema([("field", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("occurrences", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs = [cardinality(union(p)) for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(docs, pa.int64()), b.column(3)], schema=schema)

    # a container has at most 8 KB per part, however many records hold the term
    whole = parts.groupBy("field", "term", "container").agg(F.collect_list("bitmap").alias("parts"), F.sum("occurrences").alias("occurrences"))
    counted = whole.select("field", "term", "parts", "occurrences").mapInArrow(count, "field string, term string, docs long, occurrences long")
    return counted.groupBy("field", "term").agg(F.sum("occurrences").alias("occurrences"), F.sum("docs").alias("docs"))


def term_frequencies(records: DataFrame, rare_docs: int = 2, common_share: float = 0.1, hold: int = 400_000, ident: str | None = None) -> DataFrame:
    """Occurrences and document frequency of every term, with a mark for the useless ones.

    records: (field string, terms array<string>), one row per record and field; other columns are not read.
    rare_docs: a term of at most so many records is ``rare``. common_share: a term of at least this share
    of the records that have a value in the field is ``common``; ``rare`` wins. Other terms have a null
    mark. ident: column of ``records`` that names the record, unique with the field; records are then numbered in its order.
    Returns (field, term, occurrences, docs, records, mark); null terms and records without terms
    count nowhere; an empty table gives an empty result.
    """
    if ident:
        records = materialize(records.select(ident, "field", "terms"), "records")  # a range sort reads its input twice
        records = ranked(records, [], [F.col(ident).asc(), F.col("field").asc()]).withColumn("number", F.col("rank") - 1)
    merged = materialize(merge_bitmaps(term_bitmaps(records, hold)), "terms")
    # one row per field
    total = F.broadcast(merged.filter(F.col("term").isNull()).select("field", F.col("docs").alias("records")))
    mark = F.when(F.col("docs") <= rare_docs, "rare").when(F.col("docs") >= F.col("records") * common_share, "common")
    return merged.filter(F.col("term").isNotNull()).join(total, "field").select("field", "term", "occurrences", "docs", "records", mark.alias("mark"))
