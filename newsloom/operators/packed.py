"""Several values packed in one field: one row per value with its place.

The hard delimiters ``;``, ``|``, tab and line break always separate entries, except inside a quoted
span, which stays whole. What they leave open is the comma: it separates theme tokens, it introduces
a character offset, and it also stands inside names ("Doe, J.", "Acme, Timber and Partners"). For
fields whose values may hold a comma the choice is made by a segmentation model:

* every entry is a lattice over its comma-separated atoms, a path is one way to cut it;
* expectation-maximisation learns the frequency of each candidate value from the whole column, and for
  each field how often an inner comma is a cut, separately for entries with and without an offset;
* a Viterbi pass picks the likeliest path.

The model is learned on the distinct entries with their multiplicities, so its size follows the
vocabulary, and it is joined back on the entry text; nothing of it is collected or broadcast by hand.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.cut import materialize

#: An entry: a quoted span with what follows it up to a delimiter, or a run without delimiters.
ENTRY = r'\s*"(?:[^"]++|"")*+"[^;|\n\t]*+|[^;|\n\t]++'
#: A part of a comma-separated entry.
ATOM = r'"(?:[^"]++|"")*+"|[^,]++'
BLANK = " \t\r\n\x0b\f\u00a0\u2009\u200b\u3000"


@dataclass(frozen=True)
class Packed:
    """How one field packs its values.

    name: the column. inner_comma: values may hold a comma; otherwise every comma outside quotes cuts.
    part: for ``#``-structured entries the index of the part that is the value.
    """

    name: str
    inner_comma: bool = True
    part: int | None = None


def _entry(e: Column, spec: Packed) -> Column:
    """One entry -> array of (value, ambiguous, has offset)."""
    t = F.btrim(e, F.lit(BLANK))
    item = lambda v, amb, off: F.struct(v.alias("value"), amb.alias("amb"), off.alias("off"))
    no = F.lit(False)
    bare = F.btrim(F.regexp_replace(t, r",\s*\d+\s*$", ""), F.lit(BLANK))
    has_off = t.rlike(r",\s*\d+\s*$")
    quoted = bare.rlike(r'^"(?:[^"]++|"")*+"$')
    inner = F.btrim(F.replace(F.substring(bare, F.lit(2), F.length(bare) - 2), F.lit('""'), F.lit('"')), F.lit(BLANK))
    if spec.part is not None:
        whole = F.when(t.rlike(r'^"(?:[^"]++|"")*+"'), F.replace(F.regexp_extract(t, r'^"((?:[^"]++|"")*+)"', 1), F.lit('""'), F.lit('"'))).otherwise(t)
        cut = F.split(whole, "#")
        return F.array(item(F.btrim(F.when(F.size(cut) > spec.part, F.get(cut, F.lit(spec.part))).otherwise(whole), F.lit(BLANK)), no, no))
    if not spec.inner_comma:
        atoms = F.regexp_extract_all(t, F.lit(ATOM), F.lit(0))
        kept = F.filter(atoms, lambda a, i: (i == 0) | ~a.rlike(r"^\s*\d+\s*$"))

        def plain(a: Column) -> Column:
            b = F.btrim(a, F.lit(BLANK))
            q = b.rlike(r'^"(?:[^"]++|"")*+"$')
            return item(F.when(q, F.btrim(F.replace(F.substring(b, F.lit(2), F.length(b) - 2), F.lit('""'), F.lit('"')), F.lit(BLANK))).otherwise(b), no, no)

        return F.when(F.locate(",", t) == 0, F.array(plain(t))).otherwise(F.transform(kept, plain))
    return F.array(F.when(quoted, item(inner, no, has_off)).otherwise(item(bare, F.locate(",", bare) > 0, has_off)))


def entries(col: Column, spec: Packed) -> Column:
    """Array of (value, amb, off) of one packed string; null and blank strings give an empty array."""
    found = F.flatten(F.transform(F.regexp_extract_all(col, F.lit(ENTRY), F.lit(0)), lambda e: _entry(e, spec)))
    return F.coalesce(F.filter(found, lambda x: F.length(x["value"]) > 0), F.expr("array()").cast("array<struct<value:string,amb:boolean,off:boolean>>"))


# --- the segmentation model -------------------------------------------------------------------------


def _atoms(text: str) -> list[tuple[str, bool]]:
    """Comma-separated atoms of an entry with quoted spans whole; the flag says that an offset follows."""
    out: list[tuple[str, bool]] = []
    start = i = 0
    parts: list[str] = []
    while i < len(text):
        if text[i] == '"' and not text[start:i].strip():
            close = i + 1
            while close < len(text):
                if text[close] == '"':
                    if text[close + 1 : close + 2] == '"':
                        close += 2
                        continue
                    break
                close += 1
            if close < len(text):
                i = close + 1
                continue
        if text[i] == ",":
            parts.append(text[start:i])
            start = i + 1
        i += 1
    parts.append(text[start:])
    for p in parts:
        if out and p.strip().isdigit():
            out[-1] = (out[-1][0], True)
        elif p.strip():
            out.append((p, False))
    return out


def _unquote(v: str) -> str:
    v = v.strip()
    return v[1:-1].replace('""', '"').strip() if len(v) > 1 and v[0] == v[-1] == '"' else v


def _spans(text: str, longest: int) -> tuple[int, list[tuple[int, int, str]]]:
    """Number of atoms and the candidate values (first atom, end, text) of one entry."""
    atoms = _atoms(text)
    out = []
    for i in range(len(atoms)):
        for j in range(i + 1, min(len(atoms), i + longest) + 1):
            out.append((i, j, _unquote(",".join(a for a, _ in atoms[i:j]))))
            if atoms[j - 1][1]:  # an offset ends the value before it
                break
    return len(atoms), out


def _score(rows: list[tuple[int, int, str, float]], n: int, total: float, cut: float, strength: float) -> dict[int, list[tuple[int, str, float]]]:
    """Log weights of the candidate values by their first atom."""
    by: dict[int, list[tuple[int, str, float]]] = {}
    for i, j, seg, c in rows:
        new = math.exp(-0.15 * min(len(seg), 200)) + 1e-12  # base measure of unseen values: short ones likelier
        w = math.log((c + strength * new) / (total + strength)) + (j - i - 1) * math.log1p(-cut) + (math.log(cut) if j < n else 0.0)
        by.setdefault(i, []).append((j, seg, w))
    return by


def _logadd(a: float, b: float) -> float:
    if a == -math.inf:
        return b
    m = max(a, b)
    return m + math.log(math.exp(a - m) + math.exp(b - m))


def _posterior(by: dict[int, list[tuple[int, str, float]]], n: int) -> list[tuple[str, int, float]]:
    """Forward-backward: probability of each candidate value, with the number of commas it keeps inside."""
    fwd, bwd = [-math.inf] * (n + 1), [-math.inf] * (n + 1)
    fwd[0] = bwd[n] = 0.0
    for i in range(n):
        for j, _, w in by.get(i, ()):
            fwd[j] = _logadd(fwd[j], fwd[i] + w)
    for i in range(n - 1, -1, -1):
        for j, _, w in by.get(i, ()):
            bwd[i] = _logadd(bwd[i], w + bwd[j])
    return [(seg, j - i - 1, math.exp(min(0.0, fwd[i] + w + bwd[j] - fwd[n]))) for i, out in by.items() for j, seg, w in out]


def _viterbi(by: dict[int, list[tuple[int, str, float]]], n: int) -> list[str]:
    """Likeliest path; ties keep the longer first value."""
    best: list[tuple[float, int, str]] = [(-math.inf, 0, "")] * n + [(0.0, n, "")]
    for i in range(n - 1, -1, -1):
        for j, seg, w in sorted(by.get(i, ()), key=lambda x: x[0]):
            if w + best[j][0] >= best[i][0]:
                best[i] = (w + best[j][0], j, seg)
    out, i = [], 0
    while i < n:
        out.append(best[i][2])
        i = best[i][1]
    return [v for v in out if v]


def segmentation(rows: DataFrame, rounds: int = 3, longest: int = 64, strength: float = 1.0) -> DataFrame:
    """Learn the cuts of ambiguous entries.

    rows: (field, value, amb, off, n), the distinct entries of the columns with their counts.
    rounds: EM rounds. longest: most atoms in one unquoted value; it bounds the lattice of an entry that is one long list of
    commas, and no name has so many. strength: weight of the base measure.
    Returns (field, text, off, values) for every ambiguous entry.
    """
    spark = rows.sparkSession
    sure = rows.filter(~F.col("amb")).groupBy("field", F.col("value").alias("seg")).agg(F.sum("n").cast("double").alias("c"))
    amb = rows.filter(F.col("amb")).select("field", F.col("value").alias("text"), "off", "n")

    def lattice(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = b.to_pydict()
            out: dict[str, list] = {k: [] for k in ("field", "text", "off", "n", "atoms", "i", "j", "seg")}
            for f, t, o, n in zip(d["field"], d["text"], d["off"], d["n"]):
                k, spans = _spans(t, longest)
                for i, j, seg in spans:
                    for key, v in zip(out, (f, t, o, n, k, i, j, seg)):
                        out[key].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema([("field", pa.string()), ("text", pa.string()), ("off", pa.bool_()), ("n", pa.int64()), ("atoms", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("seg", pa.string())])
    cand = materialize(amb.mapInArrow(lattice, "field string, text string, off boolean, n long, atoms int, i int, j int, seg string"), "lattice")
    # one row per field: bounded by the number of packed fields
    total = {r["field"]: r["c"] for r in sure.groupBy("field").agg(F.sum("c").alias("c")).collect()}
    cut = {(f, o): (0.05 if o else 0.5) for f in {r["field"] for r in cand.select("field").distinct().collect()} for o in (True, False)}
    learned = sure
    for step in range(rounds + 1):
        last = step == rounds
        entry = cand.join(learned, ["field", "seg"], "left").groupBy("field", "text", "off", "n", "atoms").agg(F.collect_list(F.struct("i", "j", "seg", F.coalesce("c", F.lit(0.0)).alias("c"))).alias("spans"))
        totals, cuts = dict(total), dict(cut)

        def judge(batches: Iterable[pa.RecordBatch], last: bool = last, totals: dict = totals, cuts: dict = cuts) -> Iterator[pa.RecordBatch]:
            for b in batches:
                out: dict[str, list] = {k: [] for k in ("field", "text", "off", "values", "seg", "w", "inside", "n")}
                for r in b.to_pylist():
                    f, o, n = r["field"], r["off"], r["atoms"]
                    if not n:
                        continue
                    by = _score([(s["i"], s["j"], s["seg"], s["c"]) for s in r["spans"]], n, totals.get(f, 0.0) + 1.0, cuts[f, o], strength)
                    if last:
                        got = [(f, r["text"], o, _viterbi(by, n), None, None, None, r["n"])]
                    else:
                        got = [(f, None, o, None, seg, p * r["n"], p * r["n"] * inside, r["n"]) for seg, inside, p in _posterior(by, n) if p > 1e-9]
                    for row in got:
                        for key, v in zip(out, row):
                            out[key].append(v)
                yield pa.RecordBatch.from_pydict(out, schema=judged)

        judged = pa.schema([("field", pa.string()), ("text", pa.string()), ("off", pa.bool_()), ("values", pa.list_(pa.string())), ("seg", pa.string()), ("w", pa.float64()), ("inside", pa.float64()), ("n", pa.int64())])
        table = materialize(entry.mapInArrow(judge, "field string, text string, off boolean, values array<string>, seg string, w double, inside double, n long"), "segmented")
        if last:
            return table.select("field", "text", "off", "values")
        whole = cand.filter(F.col("i") == 0).groupBy("field", "text", "off", "n").agg(F.max("atoms").alias("atoms")).groupBy("field", "off").agg(F.sum(F.col("n") * (F.col("atoms") - 1)).alias("commas"))
        for r in table.groupBy("field", "off").agg(F.sum("inside").alias("inside")).join(whole, ["field", "off"]).collect():
            commas = float(r["commas"] or 0)
            cut[r["field"], r["off"]] = min(1 - 1e-6, max(1e-6, (commas - r["inside"] + 0.5) / (commas + 1.0)))
        soft = table.groupBy("field", "seg").agg(F.sum("w").alias("c"))
        learned = sure.unionByName(soft).groupBy("field", "seg").agg(F.sum("c").alias("c"))
        for r in soft.groupBy("field").agg(F.sum("c").alias("c")).collect():
            total[r["field"]] = total.get(r["field"], 0.0) + (r["c"] if step == 0 else 0.0)
    return spark.createDataFrame([], "field string, text string, off boolean, values array<string>")


def _stacked(df: DataFrame, ident: str, specs: list[Packed]) -> DataFrame:
    cells = [F.struct(F.lit(s.name).alias("field"), entries(F.col(s.name).cast("string"), s).alias("items")) for s in specs]
    return df.select(F.col(ident).alias("__id"), F.explode(F.array(*cells)).alias("__c")).select("__id", "__c.field", "__c.items")


def unpack_values(df: DataFrame, specs: list[Packed], ident: str = "doc_id", unique: bool = True) -> DataFrame:
    """Split packed fields: one row (ident, field, values) per record and field with at least one value.

    unique: rows that repeat an ``ident`` count once; rows without ``ident`` are left out. The other
    columns of ``df`` are not read, so extra columns and clashing names do no harm. Null and blank
    strings, empty entries and entries that hold nothing but an offset give no values.
    """
    names = [s.name for s in specs]
    src = df.select(ident, *names).filter(F.col(ident).isNotNull())
    open_specs = [s for s in specs if s.inner_comma and s.part is None]
    base = _stacked(src.dropDuplicates([ident]) if unique else src, ident, specs)
    if not open_specs:
        out = base.select("__id", "field", F.transform("items", lambda x: x["value"]).alias("values"))
    else:
        seen = _stacked(src, ident, open_specs).select("field", F.explode("items").alias("x")).groupBy("field", "x.value", "x.amb", "x.off").agg(F.count(F.lit(1)).alias("n"))
        model = segmentation(materialize(seen, "entries"))
        hard = F.exists("items", lambda x: x["amb"])
        plain = base.filter(~hard).select("__id", "field", F.transform("items", lambda x: x["value"]).alias("values"))
        one = base.filter(hard).select("__id", "field", F.posexplode("items").alias("at", "x")).select("__id", "field", "at", "x.*")
        solved = one.join(model.withColumnRenamed("text", "value").withColumn("amb", F.lit(True)), ["field", "value", "off", "amb"], "left")
        solved = solved.groupBy("__id", "field").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("values", F.array("value")).alias("values")))).alias("v"))
        out = plain.unionByName(solved.select("__id", "field", F.flatten(F.transform("v", lambda x: x["values"])).alias("values")))
    return out.filter(F.size("values") > 0).withColumnRenamed("__id", ident)


def explode_values(df: DataFrame, specs: list[Packed], ident: str = "doc_id", unique: bool = True) -> DataFrame:
    """One row (ident, field, pos, value) per packed value; pos counts from 1 over the values of the field."""
    got = unpack_values(df, specs, ident, unique)
    return got.select(ident, "field", F.posexplode("values").alias("p", "value")).select(ident, "field", (F.col("p") + 1).cast("int").alias("pos"), "value")


#: The packed fields of a news candidate.
THEMES = Packed("v2_themes", inner_comma=False)
LOCATIONS = Packed("v2_locations", part=1)
PERSONS = Packed("v2_persons")
ORGANIZATIONS = Packed("v2_organizations")
ALL_NAMES = Packed("all_names")
