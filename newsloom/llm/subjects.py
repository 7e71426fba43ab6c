"""Subject area of each document by label propagation.

The graph has sentences on one side and their telling terms on the other; two texts are similar through
the terms they share, so no list of document pairs is ever built. An edge is kept only if it is verified:
the term must be tied to a subject beyond chance (lift and log-likelihood ratio, both against the
subjects of its own language) in the labelled documents or, later, in the other sentences of the
documents it occurs in; a sentence never vouches for its own terms, so what stands in every text gains
nothing. Labels then travel along the edges by joins: from labelled documents to terms, from terms to
sentences, from sentences back to terms. The labels that raters agree on are clamped: in every round their
document has them with the same mass again, whatever its sentences were given. A sentence takes the subject
with the strongest evidence or none; a document keeps every subject that holds enough of its sentences.

A document is one row with the numbers of its terms, sentence after sentence, and is cut into words once.
A round joins the weights of the tied terms, in blocks of bounded size that are sent to the tasks, with the
documents where they lie; only sums per term, combined in the task, are shuffled. Texts are not.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.cut import materialize, release

#: Last bits of a term's number: the language of the text it stands in.
LANG_BITS = 6
PACKED = "doc long, sizes array<int>, terms array<long>, term long, word string"


TAG, ENTITY = re.compile(r"<[^<>]{0,200}>"), re.compile(r"&(?:nbsp|#160);")
#: Where a sentence ends: white space after a closing mark, or a line break.
END = re.compile(r"[.!?][ \t\n\x0b\f\r\u00a0]+|[\r\n]+")
WORD = regex.compile(r"[\p{L}\p{M}][\p{L}\p{M}-]*")


def words_of(text: str) -> list[list[str]]:
    """Distinct words of every sentence of a text.

    Markup is taken out; sentences end after a closing mark and at line breaks and hold a letter. Words are runs of
    letters as written, since letter case tells names from words; a sentence all in capitals is read in small letters.
    """
    if "<" in text:
        text = TAG.sub("\n", text)
    if "&" in text:
        text = ENTITY.sub(" ", text)
    found = (WORD.findall(s.lower() if s.isupper() else s) for s in END.split(text))
    return [list(dict.fromkeys(w)) for w in found if w]


# Accented letters and their plain forms, for comparing terms across languages.
ACCENTED, PLAIN = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿœ", "aaaaaaceeeeiiiinoooooouuuuyyo"


def stem(term: Column) -> Column:
    """First five letters without accents, for terms long enough to have them; else null."""
    return F.when(F.length(term) >= 5, F.substring(F.translate(F.lower(term), ACCENTED, PLAIN), 1, 5))


# --- languages ---------------------------------------------------------------------------------------


class Languages:
    """A model of the languages named in a column: how many documents of each hold a frequent word."""

    def __init__(self, names: list[str], docs: list[int], words: dict[str, list[int]]):
        self.names = names
        self.place = {w: k for k, w in enumerate(words)}
        counts = np.array(list(words.values()), np.float64).reshape(len(words), max(1, len(names)))
        self.logs = np.log((counts + 0.5) / (np.array(docs or [0], np.float64) + 1))
        self.met: dict[str, int] = {}

    def code(self, words: Iterable[str]) -> int:
        """Number of the likeliest language of a text; the most frequent one where no known word is met."""
        found = set()
        for w in words:
            k = self.met.get(w)
            if k is None:
                if len(self.met) > 1_000_000:
                    self.met.clear()
                k = self.met[w] = self.place.get(w.lower(), -1)
            if k >= 0:
                found.add(k)
        return int(self.logs[list(found)].sum(axis=0).argmax()) if found else 0

    def merge(self, like: float = 0.8) -> Languages:
        """Leave out names whose frequent words are those of a more frequent name, as a code for "unknown" or another spelling has."""
        share = np.exp(self.logs)
        norm = np.maximum(np.linalg.norm(share, axis=0), 1e-300)
        kept: list[int] = []
        for k in range(len(self.names)):
            if all(share[:, k] @ share[:, j] / norm[k] / norm[j] <= like for j in kept):
                kept.append(k)
        if kept:
            self.names, self.logs = [self.names[k] for k in kept], self.logs[:, kept]
        return self


def learn_languages(docs: DataFrame, sample: int = 20_000, share: float = 0.02, least: int = 5) -> Languages:
    """Learn to tell languages from (doc, text, lang), of which some labels are wrong or missing.

    sample: about so many labelled documents are read, chosen by a hash of their id (the bound of the fit; every document is then
    classified). A word counts if it stands in at least ``share`` of the documents of a language, so the words are few
    hundreds a language whatever the corpus. least: documents a language must have in the sample.
    """
    named = docs.filter("lang is not null and trim(lang) <> '' and text is not null").select("doc", "text", F.lower(F.trim("lang")).alias("lang"))
    n = named.count()
    if n > sample:
        named = named.filter(F.pmod(F.xxhash64("doc", F.lit(3)), F.lit(1 << 20)) < max(1, round((1 << 20) * sample / n)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[tuple[str, str], int] = {}
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for w in {"", *(w.lower() for s in words_of(text) for w in s)}:
                    count[lang, w] = count.get((lang, w), 0) + 1
        if count:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in count]), pa.array([k[1] for k in count]), pa.array(list(count.values()), pa.int64())], names=["lang", "word", "n"])

    counts = materialize(named.select("text", "lang").mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "languages")
    known = counts.filter((F.col("word") == "") & (F.col("n") >= least)).orderBy(F.desc("n"), "lang").limit((1 << LANG_BITS) - 1)
    names = [(r["lang"], r["n"]) for r in known.collect()]
    place = {lang: k for k, (lang, _) in enumerate(names)}
    frequent = counts.join(F.broadcast(known.select("lang", F.col("n").alias("of"))), "lang").filter((F.col("word") != "") & (F.col("n") >= share * F.col("of"))).select("word").distinct()
    words: dict[str, list[int]] = {}
    for r in counts.join(frequent, "word").filter(F.col("lang").isin(list(place))).collect() if names else ():
        words.setdefault(r["word"], [0] * len(names))[place[r["lang"]]] = r["n"]
    release(counts)
    return Languages([x for x, _ in names], [c for _, c in names], words).merge()


# --- documents as rows of term numbers ---------------------------------------------------------------


def _packed(docs: DataFrame, languages: Languages) -> DataFrame:
    """(doc, text) -> a row (doc, sizes, terms) per document with words, and rows (term, word), repeated at most once a task."""
    sent = docs.sparkSession.sparkContext.broadcast(languages)
    schema = pa.schema([("doc", pa.int64()), ("sizes", pa.list_(pa.int32())), ("terms", pa.list_(pa.int64())), ("term", pa.int64()), ("word", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[int, dict[str, int]] = {}
        known = 0
        for b in batches:
            docs, sizes, flat, size_at, term_at, new = [], [], [], [0], [0], []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                parts = words_of(text)
                if not parts:
                    continue
                code = sent.value.code(w for s in parts for w in s)
                of = number.setdefault(code, {})
                for s in parts:
                    for w in s:
                        i = of.get(w)
                        if i is None:
                            i = of[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) >> LANG_BITS << LANG_BITS | code
                            new.append((i, w))
                            known += 1
                        flat.append(i)
                docs.append(doc)
                sizes.extend(map(len, parts))
                size_at.append(len(sizes))
                term_at.append(len(flat))
            n = len(docs)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.ListArray.from_arrays(pa.array(size_at, pa.int32()), pa.array(sizes, pa.int32())), pa.ListArray.from_arrays(pa.array(term_at, pa.int32()), pa.array(flat, pa.int64())), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())], schema=schema)
            n = len(new)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, schema.types[1]), pa.nulls(n, schema.types[2]), pa.array([i for i, _ in new], pa.int64()), pa.array([w for _, w in new], pa.string())], schema=schema)
            if known > 1_000_000:
                number.clear()
                known = 0

    return docs.filter("text is not null").select("doc", "text").mapInArrow(run, PACKED)


class _Weights:
    """A block of tied terms, sorted, with their weights by subject."""

    def __init__(self, tied: DataFrame, place: dict[str, int]):
        rows = tied.select("term", "subject", "weight").toArrow()
        term = rows.column("term").to_numpy()
        at = np.array([place[s] for s in rows.column("subject").to_pylist()], np.int64)
        self.terms, inverse = np.unique(term, return_inverse=True)
        self.weight = np.zeros((len(self.terms), len(place)))
        self.weight[inverse, at] = rows.column("weight").to_numpy()

    def add(self, score: np.ndarray, some: np.ndarray, inverse: np.ndarray, sentence: np.ndarray) -> None:
        """Add the weights of the terms ``some[inverse]`` to the scores of their sentences."""
        if not len(self.terms):
            return
        where = np.minimum(np.searchsorted(self.terms, some), len(self.terms) - 1)
        tied = self.terms[where] == some
        hit = np.flatnonzero(tied[inverse])
        row, at = where[inverse[hit]], sentence[hit]
        for k in range(score.shape[1]):
            score[:, k] += np.bincount(at, self.weight[row, k], len(score))


class _Sums:
    """Sums per term, combined in the task before they move."""

    def __init__(self, width: int, names: list[str], hold: int = 1_000_000):
        self.terms, self.values, self.rows = [], [], 0
        self.width, self.names, self.hold = width, names, hold

    def add(self, some: np.ndarray, inverse: np.ndarray, size: np.ndarray, value: np.ndarray) -> None:
        """Every occurrence of a term ``some[inverse]`` adds the values of its sentence; sentences follow one another and have ``size`` terms."""
        row, col = np.nonzero(value)
        count = size[row]
        start = np.r_[0, np.cumsum(size)[:-1]][row] if len(size) else row
        at = np.repeat(start - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum()) if len(row) else row
        total = np.bincount(inverse[at] * self.width + np.repeat(col, count), np.repeat(value[row, col], count), len(some) * self.width)
        self.terms.append(some)
        self.values.append(total.reshape(-1, self.width))
        self.rows += len(some)

    def full(self) -> bool:
        if self.rows > self.hold:
            self._merge()
        return self.rows > self.hold

    def _merge(self) -> None:
        if len(self.terms) > 1:
            values = np.concatenate(self.values)
            some, inverse = np.unique(np.concatenate(self.terms), return_inverse=True)
            self.terms, self.values = [some], [np.stack([np.bincount(inverse, values[:, k], len(some)) for k in range(self.width)], axis=1)]
            self.rows = len(some)

    def flush(self) -> Iterator[pa.RecordBatch]:
        self._merge()
        for t, v in zip(self.terms, self.values):
            for lo in range(0, len(t), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(t[lo : lo + 50_000]), *(pa.array(v[lo : lo + 50_000, k]) for k in range(self.width))], names=self.names)
        self.terms, self.values, self.rows = [], [], 0


def told(score: np.ndarray, hold: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Subject of every sentence, -1 for none: the strongest, a clamped subject of its document being ahead by its mass; of equal ones the last."""
    lead = np.where(score > 0, score + hold[doc], 0.0)
    best = score.shape[1] - 1 - lead[:, ::-1].argmax(axis=1)
    return np.where(lead.max(axis=1, initial=0.0) > 0, best, -1)


def vouched(own: np.ndarray, hold: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every sentence the shares of the subjects among the other sentences of its document and the clamped labels, and for every document its sentences by subject."""
    has = own >= 0
    count = np.zeros_like(hold)
    np.add.at(count, (doc[has], own[has]), 1.0)
    mass = count + hold
    value = mass[doc]
    value[np.flatnonzero(has), own[has]] -= 1.0
    others = mass.sum(axis=1)[doc] - has
    value = np.where(others[:, None] > 0, np.maximum(value, 0.0) / np.where(others > 0, others, 1.0)[:, None], 0.0)
    return value, count


def _blocks(tied: DataFrame, size: int) -> list[DataFrame]:
    """Tied terms in blocks of about ``size`` rows; a term lies in one block."""
    cuts = max(1, -(-tied.count() // size))
    return [tied] if cuts == 1 else [tied.filter(F.pmod(F.xxhash64("term"), F.lit(cuts)) == k) for k in range(cuts)]


def _round(docs: DataFrame, tied: DataFrame, subjects: list[str], share: float | None, block: int) -> DataFrame:
    """One round over (doc, sizes, terms, hold): terms -> sentences -> terms.

    With ``share`` the documents' subjects come out instead: (doc, subject, sentences, of). Else a row
    (term, n, has, n_0, n_1, ..) for every term: its occurrences, those in sentences with a subject, and the sums of what vouches for it.
    """
    spark, place, width = docs.sparkSession, {s: k for k, s in enumerate(subjects)}, len(subjects)
    names = ["term", "n", "has", *(f"n_{k}" for k in range(width))]
    every = _blocks(tied, block)
    for b, part in enumerate(every):
        sent, last = spark.sparkContext.broadcast(_Weights(part, place)), b == len(every) - 1

        def run(batches: Iterable[pa.RecordBatch], sent=sent, first: bool = b == 0, last: bool = last) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            sums = _Sums(width + 2, names)
            for whole in batches:
                for lo in range(0, whole.num_rows, 5000):
                    x = whole.slice(lo, 5000)
                    sizes, terms, hold = x.column(1), x.column(2).flatten().to_numpy(), x.column(3)
                    size = sizes.flatten().to_numpy()
                    doc = np.repeat(np.arange(x.num_rows), np.diff(sizes.offsets.to_numpy()))
                    sentence = np.repeat(np.arange(len(size)), size)
                    score = np.zeros((len(size), width)) if first else x.column(4).flatten().to_numpy().astype(np.float64).reshape(-1, width)
                    some, inverse = np.unique(terms, return_inverse=True)
                    sent.value.add(score, some, inverse, sentence)
                    if not last:
                        at = np.r_[0, np.cumsum(np.bincount(doc, minlength=x.num_rows))] * width
                        yield pa.RecordBatch.from_arrays([*x.columns[:4], pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(score.ravel()))], names=["doc", "sizes", "terms", "hold", "score"])
                        continue
                    mass = np.zeros((x.num_rows, width))
                    clamped = np.flatnonzero(hold.is_valid().to_numpy(zero_copy_only=False))
                    if len(clamped):
                        mass[clamped] = hold.drop_null().flatten().to_numpy().reshape(-1, width)
                    own = told(score, mass, doc)
                    value, count = vouched(own, mass, doc)
                    if share is None:
                        sums.add(some, inverse, size, np.c_[np.ones(len(size)), own >= 0, value])
                        continue
                    of = count.sum(axis=1)
                    r, c = np.nonzero((mass > 0) | ((count > 0) & (count >= share * of[:, None])))
                    yield pa.RecordBatch.from_arrays([x.column(0).take(pa.array(r)), pa.array([subjects[k] for k in c], pa.string()), pa.array(count[r, c].astype(np.int64)), pa.array(of[r].astype(np.int64))], names=["doc", "subject", "sentences", "of"])
                if sums.full():
                    yield from sums.flush()
            yield from sums.flush()

        if not last:
            spec = "doc long, sizes array<int>, terms array<long>, hold array<double>, score array<double>"
        elif share is None:
            spec = ", ".join(f"{n} {'long' if n == 'term' else 'double'}" for n in names)
        else:
            spec = "doc long, subject string, sentences long, of long"
        docs = docs.mapInArrow(run, spec)
        if not last:
            docs = materialize(docs, "scores")
    return docs


# --- terms tied to subjects --------------------------------------------------------------------------


def _tied(sums: DataFrame, subjects: list[str], least: int, lift: float, ratio: float) -> DataFrame:
    """(term, n_0, n_1, ..) -> (term, subject, weight) for terms tied to a subject beyond chance.

    weight is the log of how much likelier the subject is with the term than without knowledge of it, against all terms of its language.
    """
    cols, mask = [f"n_{k}" for k in range(len(subjects))], (1 << LANG_BITS) - 1
    # one row per language
    total = {r[0]: np.array([x or 0.0 for x in r[1:]]) for r in sums.groupBy(F.col("term").bitwiseAND(F.lit(mask)).alias("lang")).agg(*[F.sum(c).alias(c) for c in cols]).collect()}
    prior = np.zeros((mask + 1, len(cols)))
    for code, x in total.items():
        prior[code] = x / x.sum() if x.sum() > 0 else 0.0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            term = b.column(0).to_numpy()
            n = np.stack([c.to_numpy() for c in b.columns[1:]], axis=1)
            of = n.sum(axis=1)
            keep = of >= least
            term, n, of, base = term[keep], n[keep], of[keep], prior[term[keep] & mask]
            p = n / of[:, None]
            ok = (n > 0) & (base > 0)
            up = np.where(ok, p / np.where(base > 0, base, 1.0), 0.0)
            log = np.log(np.where(up > 0, up, 1.0))
            best, most, top = up.max(axis=1, initial=0), np.where(ok, p, 0).max(axis=1, initial=0), (2 * n * log).max(axis=1, initial=0)
            # where subjects are few no lift is large: then a clear majority does
            good = (top >= ratio) & ((best >= lift) | ((best >= lift / 2) & (most >= 0.6)))
            r, c = np.nonzero(good[:, None] & (up > 1))
            yield pa.RecordBatch.from_arrays([pa.array(term[r]), pa.array([subjects[k] for k in c], pa.string()), pa.array(log[r, c])], names=["term", "subject", "weight"])

    return sums.select("term", *[F.col(c).cast("double") for c in cols]).mapInArrow(run, "term long, subject string, weight double")


def _described(vocabulary: DataFrame, areas: DataFrame) -> DataFrame:
    """Corpus terms that the descriptions of the subjects name, as weak first evidence."""
    key = lambda c: F.coalesce(stem(c), F.lower(c))
    said = areas.filter("subject is not null").select("subject", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("description"), F.lit(r"\p{L}{3,}"), F.lit(0)))).alias("w"))
    only = said.select("subject", key(F.col("w")).alias("key")).distinct()
    only = only.join(only.groupBy("key").count().filter("count = 1").select("key"), "key")  # a word of two descriptions says nothing
    own = vocabulary.select("term", key(F.col("word")).alias("key"))
    return own.join(F.broadcast(only), "key").select("term", "subject", F.lit(1.0).alias("weight"))  # the words of some descriptions


def _borrowed(sums: DataFrame, tied: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Weights for terms of texts that no label reached, taken from their cognates.

    Only a term that occurs almost nowhere in a sentence with a subject borrows: a word in a language
    without labels does, a word that names companies in every subject does not. A stem lends if one
    subject holds most of its weight.
    """
    stems = vocabulary.select("term", stem(F.col("word")).alias("stem")).filter("stem is not null")
    orphan = sums.filter(F.col("has") <= 0.2 * F.col("n")).select("term").join(stems, "term")
    lent = tied.join(stems, "term").groupBy("stem", "subject").agg(F.max("weight").alias("weight"), F.sum("weight").alias("w"))
    lent = lent.withColumn("all", F.sum("w").over(Window.partitionBy("stem"))).filter(F.col("w") >= 0.7 * F.col("all"))
    return orphan.join(lent, "stem").select("term", "subject", (0.5 * F.col("weight")).alias("weight"))


def subjects(documents: DataFrame, labels: DataFrame, areas: DataFrame | None = None, share: float = 0.25, rounds: int = 5, least: int = 3, lift: float = 3.0, ratio: float = 10.0, clamp: float = 1.0, doc_id: str = "doc_id", text: str = "text", lang: str | None = "lang", block: int = 1_000_000) -> DataFrame:
    """Subjects of every document.

    labels: (doc_id, subject), one row per rater; nulls are left out, labels of unknown documents are not
    used. areas: (subject, description), whose words give first evidence where labels are few. share: a subject is kept if it holds at least this share of the sentences that have a subject.
    rounds: propagation rounds. least, lift, ratio: what verifies a term. clamp: sentences that a
    subject raters agree on counts for in its document, again in every round, and its advantage in the document's sentences;
    such a subject is always in the result. lang: column from which languages are learned, where the table has it
    (see :func:`learn_languages`); without it all texts count as one language. block: weights sent to a task at a time.
    Rows without id and null or blank texts have no subject; repeated ids count once. Returns (doc_id, subject,
    sentences, of): sentences about the subject (none, if only the agreed label says so) and sentences with any subject.
    """
    named = F.col(lang).cast("string") if lang and lang in documents.columns else F.lit(None).cast("string")
    spark = documents.sparkSession
    docs = documents.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"), named.alias("lang"))
    given = labels.filter("doc_id is not null and subject is not null").select(F.col("doc_id").cast("long").alias("doc"), "subject")
    votes = given.groupBy("doc", "subject").agg(F.count(F.lit(1)).alias("votes"))
    seeds = materialize(votes.withColumn("n", F.col("votes") / F.sum("votes").over(Window.partitionBy("doc"))), "seeds")
    # the list of subjects: labels and areas name few
    known = seeds.select("subject").union(areas.select("subject")) if areas is not None else seeds.select("subject")
    kinds = sorted(r[0] for r in known.filter("subject is not null").distinct().collect())
    if not kinds:
        return spark.createDataFrame([], "doc_id long, subject string, sentences long, of long")
    if not docs.groupBy("doc").count().filter("count > 1").isEmpty():  # ids alone are looked at; texts move only if some repeat
        docs = docs.dropDuplicates(["doc"])
    both = materialize(_packed(docs, learn_languages(docs)), "packed")
    vocabulary = materialize(both.filter("term is not null").select("term", "word").dropDuplicates(["term"]), "vocabulary")
    packed = both.filter("doc is not null").select("doc", "sizes", "terms")
    agreed = seeds.filter("votes > 1").groupBy("doc").agg(F.collect_set("subject").alias("agreed"))
    hold = F.array(*[F.when(F.array_contains("agreed", s), float(clamp)).otherwise(0.0) for s in kinds])
    packed = packed.join(agreed.select("doc", hold.alias("hold")), "doc", "left")
    # labelled documents -> terms
    first = packed.select("doc", F.array_distinct("terms").alias("terms")).join(seeds.select("doc", "subject", "n"), "doc").select(F.explode("terms").alias("term"), "subject", "n")
    first = first.groupBy("term").agg(F.lit(1.0).alias("n"), *[F.sum(F.when(F.col("subject") == s, F.col("n")).otherwise(0.0)).alias(f"n_{k}") for k, s in enumerate(kinds)])
    tied = materialize(_tied(materialize(first, "labelled"), kinds, least, lift, ratio), "tied")
    if areas is not None:
        tied = materialize(tied.unionByName(_described(vocabulary, areas).join(tied.select("term").distinct(), "term", "left_anti")), "tied")
    for _ in range(rounds - 1):
        sums = _round(packed, tied, kinds, None, block)
        sums = sums.groupBy("term").agg(*[F.sum(c).alias(c) for c in sums.columns[1:]]).filter(F.col("n") >= 3 * least)
        sums = materialize(sums, "sums")
        grown = materialize(_tied(sums, kinds, 3 * least, lift, ratio), "grown")
        borrowed = _borrowed(sums, grown, vocabulary).join(grown.select("term").distinct(), "term", "left_anti")
        before, tied = tied, materialize(grown.unionByName(borrowed), "tied")
        release(before, sums, grown)
    return _round(packed, tied, kinds, share, block).withColumnRenamed("doc", "doc_id")
