"""Stable identifiers and deterministic splits."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

#: Runs of letters and digits.
WORD = re.compile(r"[^\W_]+")


def sha_id(c: Column) -> Column:
    """First eight bytes of the SHA-256 of a text as 16 hexadecimal digits: an unsigned 64-bit id kept exact."""
    return F.substring(F.sha2(c, 256), 1, 16)


def hash_bucket(c: Column, buckets: int) -> Column:
    """A bucket from the first eight hexadecimal digits of the SHA-256; the same in every run and engine."""
    return (F.conv(F.substring(F.sha2(c.cast("string"), 256), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def split_name(c: Column, valid: int = 1, of: int = 10) -> Column:
    """``valid`` for ``valid`` of ``of`` hash buckets, else ``train``."""
    return F.when(hash_bucket(c, of) < valid, "valid").otherwise("train")


@F.pandas_udf(LongType())
def _majority(hashes: pd.Series) -> pd.Series:
    size = hashes.map(len).to_numpy()
    out = np.full(len(hashes), -1, np.int64)
    some = np.flatnonzero(size)
    if len(some):
        flat = np.concatenate([np.asarray(hashes.iloc[k], np.int64) for k in some])
        bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1
        votes = np.add.reduceat(bits, np.r_[0, np.cumsum(size[some])[:-1]], axis=0) >= 0
        out[some] = np.packbits(votes, axis=1, bitorder="little").view(np.int64).ravel()
    return pd.Series(out)


def simhash(tokens: Column) -> Column:
    """64-bit SimHash of an array of tokens: every bit is the majority of the tokens' hash bits, ties are set; null gives null."""
    empty = F.array().cast("array<bigint>")
    return F.when(tokens.isNotNull(), _majority(F.coalesce(F.transform(tokens, lambda t: F.xxhash64(t)), empty)))


@F.pandas_udf(LongType())
def _text_simhash(texts: pd.Series) -> pd.Series:
    from hashlib import blake2b

    out, known = np.zeros(len(texts), np.int64), {}
    none = np.ones(len(texts), bool)
    for k, t in enumerate(texts):
        words = set(WORD.findall(t.lower())) if t else ()
        if words:
            for w in words:
                if w not in known:
                    known[w] = np.frombuffer(blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), np.uint8)
            bits = np.unpackbits(np.stack([known[w] for w in words]), axis=1, bitorder="little")
            votes = 2 * bits.sum(axis=0, dtype=np.int64) >= len(words)
            out[k], none[k] = np.packbits(votes, bitorder="little").view(np.int64)[0], False
    return pd.Series(out).astype("Int64").mask(none)


def text_simhash(text: Column) -> Column:
    """64-bit SimHash of the distinct words of a text, cut and hashed in one pass; null without words."""
    return _text_simhash(text)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


#: The name space of addresses of RFC 4122 (fixed value).
URL_SPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(name: Column, space: str = URL_SPACE) -> Column:
    """UUID of version 5 of a name: the SHA-1 of name space and name with version and variant set."""
    h = F.sha1(F.concat(F.unhex(F.lit(space)), F.encode(name, "utf-8")))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))
