"""Deduplicating new batches against all history.

Everything accepted so far is kept as hashes in a folder of Parquet files bucketed by hash: one row per
distinct content and per distinct paragraph with the record that brought it. The batches of a call are
reduced together to one row per distinct hash, bucketed the same way, and held against the history bucket
by bucket: the history is read where it lies and never shuffled, and the plan is the same for one batch and
for a thousand. Hashes not met are appended. History keys are unique, so no page, however often it returns,
makes a hot bucket.

A history lives in its folder and outlasts the application: whether it exists, and how many buckets it has,
is read from the folder, never from the session's catalog. (The catalog only lends a name, under which an
application reads the bucketed files.)
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.cut import exists, forget_at_end, materialize, scratch, shared_dir

#: Address parameters that follow a visit and do not choose the page (fixed values).
TRACKING = (
    "_ga", "_gl", "cmp", "cmpid", "dclid", "fbclid", "gclid", "icid", "igshid", "mc_cid", "mc_eid", "mkt_tok", "msclkid", "ncid", "ocid",
    "ref", "ref_src", "referrer", "smid", "spm", "taid", "tblci", "twclid", "wt_mc", "xtor", "yclid",
)


def page_key(address: Column) -> Column:
    """The page an address leads to, as text.

    Scheme, letter case of the host, ``www.``, default ports, user info, fragments, repeated and trailing
    slashes, percent-encoding of plain characters, the order of parameters and tracking parameters do not
    choose the page. Blank addresses give null.
    """
    a = F.btrim(address)
    rest = F.regexp_replace(F.regexp_replace(a, r"^[A-Za-z][A-Za-z0-9+.-]*:", ""), r"^//+", "")
    rest = F.regexp_replace(rest, r"#.*$", "")
    host = F.lower(F.regexp_extract(rest, r"^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)?$", "")
    host = F.regexp_replace(F.regexp_replace(host, r"\.+$", ""), r"^www\.", "")
    plain = lambda c: F.coalesce(F.try_url_decode(F.regexp_replace(F.regexp_replace(c, r"%(?![0-9A-Fa-f]{2})|%(?=2[35Ff6]|3[DdFf])", "%25"), r"\+", "%2B")), c)
    path = F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1)
    path = F.regexp_replace(F.regexp_replace(plain(path), r"/{2,}", "/"), r"/+$", "")
    query = F.split(F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1), "&")
    name = lambda p: F.lower(F.regexp_extract(p, r"^[^=]*", 0))
    kept = F.array_sort(F.array_distinct(F.filter(F.transform(query, plain), lambda p: (p != "") & ~name(p).isin(*TRACKING) & ~name(p).startswith("utm_"))))
    return F.when(a != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def normal_text(text: Column) -> Column:
    """Text for exact comparison: lower case, one space between words, nothing at the ends; blank is null."""
    t = F.btrim(F.regexp_replace(F.lower(text), r"[\s ]+", " "))
    return F.when(t != "", t)


def paragraphs(text: Column) -> Column:
    """Normalised paragraphs of a text: parts between line breaks, blank ones left out."""
    return F.filter(F.transform(F.split(text, r"\n+"), normal_text), lambda p: p.isNotNull())


def _key(kind: str, text: Column) -> Column:
    """128 bits of a text's MD5 behind one byte for the kind; null stays null."""
    return F.concat(F.lit(kind[:1]).cast("binary"), F.unhex(F.md5(text)))


class History:
    """Hashes of everything accepted, in one folder of bucketed files.

    name: folder below ``root``; a history without a name is deleted when the application ends. root: by default
    ``newsloom-history`` in the folder of ``spark.checkpoint.dir``. buckets: of a new history; choose them for the
    size it will have (a bucket is one task). An existing history keeps its own. One application may append at a time.
    """

    def __init__(self, spark: SparkSession, name: str | None = None, buckets: int | None = None, root: str | None = None):
        self.spark, self.name = spark, name or f"history_{uuid.uuid4().hex}"
        self.path = f"{root or shared_dir(spark) + '/newsloom-history'}/{self.name}"
        if not name:
            forget_at_end(spark, self.path)
        self.buckets = self._stored() or buckets or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def _stored(self) -> int | None:
        """Number of buckets of the history in the folder; null where there is none."""
        if not exists(self.spark, f"{self.path}/about"):
            return None
        return json.loads(self.spark.read.text(f"{self.path}/about").first()[0])["buckets"]

    def exists(self) -> bool:
        return self._stored() is not None

    def _named(self, path: str, like: DataFrame) -> str:
        """A name under which the session reads and adds to the bucketed files of ``path``."""
        name = f"newsloom_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields)
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (key) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return name

    def _unname(self, name: str) -> None:
        """Take a name back; the files belong to the folder and stay."""
        self.spark.sql(f"DROP TABLE {name}")

    def read(self, path: str, like: DataFrame) -> DataFrame:
        """Files of ``path`` as a table bucketed by key."""
        name = self._named(path, like)
        out = self.spark.table(name)
        self._unname(name)
        return out

    def write(self, df: DataFrame, path: str) -> None:
        """Write ``df``, whose tasks hold whole buckets, as a new set of bucketed files."""
        name = f"newsloom_{uuid.uuid4().hex}"
        df.write.mode("overwrite").format("parquet").option("path", path).option("compression", "zstd").bucketBy(self.buckets, "key").saveAsTable(name)
        self._unname(name)

    def accept(self, keys: DataFrame) -> DataFrame:
        """Hold distinct hashes (key, first_id, first_batch) against the history and append the new ones.

        Returns all of them: (key, first_id, first_batch, old), with the record of the history where it has the hash.
        """
        spark, stored, folder = self.spark, f"{self.path}/hashes", scratch(self.spark, "known")
        there = self.exists()
        known = keys.repartition(self.buckets, "key").withColumn("old", F.lit(False))
        if there:
            known = self.held(keys)
        self.write(known, folder)
        fresh = self.read(folder, known).filter(~F.col("old")).select("key", "first_id", "first_batch")
        if there:
            name = self._named(stored, fresh)
            fresh.write.insertInto(name)
            self._unname(name)
        else:
            self.write(fresh, stored)
            spark.createDataFrame([(json.dumps({"buckets": self.buckets}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/about")
        return spark.read.schema(known.schema).parquet(folder)

    def held(self, keys: DataFrame) -> DataFrame:
        """The bucket-local join of new hashes with the history: only the new ones move."""
        past = self.read(f"{self.path}/hashes", keys.select("key", "first_id", "first_batch"))
        past = past.select("key", F.col("first_id").alias("past_id"), F.col("first_batch").alias("past_batch"), F.lit(True).alias("past"))
        met = keys.repartition(self.buckets, "key").join(past.hint("merge"), "key", "left")
        best = lambda name, own: F.when(F.col("past"), F.col(name)).otherwise(F.col(own)).alias(own)
        return met.select("key", best("past_id", "first_id"), best("past_batch", "first_batch"), F.coalesce("past", F.lit(False)).alias("old"))


def deduplicate_batches(df: DataFrame, batch: str, ident: str, content: Column, parts: Column | None = None, history: History | None = None) -> DataFrame:
    """Hold the batches of ``df`` against a history and against one another, in order, and report what each record repeats.

    content: text whose normalised form makes two records full copies; records where it is null have none.
    parts: optional array of paragraph texts. Rows that repeat ``ident`` inside a batch count once; rows
    without ``ident`` or ``batch`` are left out. Returns (ident, batch, first_id, first_batch, parts,
    seen_parts, coverage): the accepted record it copies in full (null: none; a second copy inside the
    same batch points to the batch's smallest ``ident``), its number of distinct paragraphs, how many of
    them were accepted before its batch, and their share (null without paragraphs). A call reads its own texts and the
    hashes of the history, never earlier texts. A batch given again after it was accepted finds itself and reports no copies of itself.
    """
    history = history or History(df.sparkSession)
    src = df.filter(F.col(ident).isNotNull() & F.col(batch).isNotNull())
    full, none = _key("full", content), F.array().cast("array<binary>")
    cells = F.array(full) if parts is None else F.concat(F.array(full), F.transform(F.array_distinct(F.coalesce(parts, F.array().cast("array<string>"))), lambda p: _key("para", p)))
    rows = src.select(F.col(ident).alias("id"), F.col(batch).alias("batch"), F.explode(F.coalesce(cells, none)).alias("key")).filter(F.col("key").isNotNull())
    rows = materialize(rows if parts is None else rows.distinct(), "hashes")
    # of a hash that comes back the first batch and in it the smallest id; reduced inside the tasks before it moves
    first = F.min(F.struct(F.col("batch").alias("first_batch"), F.col("id").alias("first_id")))
    keys = rows.groupBy("key").agg(first.alias("f")).select("key", "f.first_id", "f.first_batch")
    known = history.accept(keys)
    # hashes are unique on the right, so a hot page only makes the left side long; adaptive execution splits it
    met = rows.join(known, "key", "left")
    before = F.col("old") | (F.col("first_batch") < F.col("batch"))
    other = F.col("first_id") != F.col("id")
    is_full = F.substring("key", 1, 1) == F.lit(bytearray(b"f"))
    whole = met.filter(is_full).select("id", "batch", F.when(other, F.col("first_id")).alias("first_id"), F.when(other, F.col("first_batch")).alias("first_batch"))
    if parts is None:
        whole = whole.distinct()
        return whole.select(F.col("id").alias(ident), F.col("batch").alias(batch), "first_id", "first_batch", F.lit(0).cast("long").alias("parts"), F.lit(0).cast("long").alias("seen_parts"), F.lit(None).cast("double").alias("coverage"))
    para = met.filter(~is_full).groupBy("id", "batch").agg(F.count(F.lit(1)).alias("parts"), F.count_if(before).alias("seen_parts"))
    out = whole.join(para, ["id", "batch"], "full")
    n = F.coalesce("parts", F.lit(0))
    return out.select(F.col("id").alias(ident), F.col("batch").alias(batch), "first_id", "first_batch", n.alias("parts"), F.coalesce("seen_parts", F.lit(0)).alias("seen_parts"), F.when(n > 0, F.col("seen_parts") / n).alias("coverage"))
