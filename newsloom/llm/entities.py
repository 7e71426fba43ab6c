"""Variant spellings of names: linking written names to a registry by metric-space partitioning.

A written name is brought into plain form (accents, titles, legal forms, name order, middle initials and
nicknames), which gives one or more keys. Registry names give keys the same way. Keys are points of a
metric space under the Levenshtein distance: a few pivots cut it into cells, a written key belongs to
the cell of its nearest pivot, a registry key is replicated to every cell where the triangle inequality
cannot rule a partner out, and inside a cell an exact radius join runs, with the distances to all pivots
as a filter before the true distance is computed. A pair links if at most ``edits`` edits (an inserted, dropped,
replaced or swapped letter each, one by default) separate the keys. Initials and acronyms are too short for an edit and must
be equal, and they link only where a single entity has them.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.cut import materialize

# Letters without a decomposition, titles, common English nicknames, legal forms of companies and their short forms.
LETTERS = str.maketrans({"ø": "o", "ß": "ss", "æ": "ae", "œ": "oe", "đ": "d", "ł": "l", "ı": "i", "ð": "d", "þ": "th"})
TITLES = frozenset(
    """mr mrs ms miss mx dr prof professor rev reverend fr father sister brother rabbi imam bishop archbishop cardinal pope chairman chairwoman chairperson chair governor gov minister senator sen president sir dame judge justice
    captain capt general gen major maj mayor lord lady rep representative secretary chancellor king queen prince princess duke duchess count countess baron baroness col colonel hon ambassador commissioner sgt sergeant cpl lt
    lieutenant admiral adm commander director deputy attorney premier speaker sheikh sheriff inspector officer""".split()
)
NICKNAMES = {
    "abigail": "abby gail", "abraham": "abe bram", "adelaide": "addie", "agnes": "aggie", "albert": "al bert bertie", "alexander": "alex sasha al sandy lex xander alec", "alexandra": "alex sandra lexi sasha", "alfred": "alf alfie fred",
    "amanda": "mandy", "anastasia": "nastya stacy", "andrew": "andy drew", "angela": "angie", "anthony": "tony ant", "antonio": "tonio toni", "archibald": "archie", "arnold": "arnie", "arthur": "art artie", "augustus": "gus",
    "barbara": "barb babs barbie", "bartholomew": "bart", "beatrice": "bea trixie", "benjamin": "ben benny benji", "bernard": "bernie", "bradley": "brad", "calvin": "cal", "cameron": "cam", "caroline": "carrie caro", "catherine": "cathy kate cat katie",
    "charles": "charlie chuck chas", "charlotte": "lottie charlie", "christina": "chrissy tina chris", "christine": "chris chrissy", "christopher": "chris kit topher", "clifford": "cliff", "cynthia": "cindy", "daniel": "dan danny", "david": "dave davey",
    "deborah": "deb debbie debby", "dennis": "denny", "dmitri": "dima mitya", "dominic": "dom nick", "donald": "don donnie", "dorothy": "dot dottie dolly", "douglas": "doug", "edgar": "ed eddie", "edmund": "ed ned", "edward": "ed ted eddie ned teddy",
    "edwin": "ed eddie", "eleanor": "ellie nell nora", "elizabeth": "liz beth lizzie betty eliza betsy bess", "emily": "em emmy", "eugene": "gene", "ferdinand": "ferdie", "florence": "flo florrie", "frances": "fran fanny", "francis": "frank",
    "francisco": "paco pancho", "franklin": "frank", "frederick": "fred freddie freddy", "gabriel": "gabe", "geoffrey": "geoff jeff", "george": "georgie", "gerald": "gerry jerry", "gilbert": "gil", "gregory": "greg gregg", "gwendolyn": "gwen",
    "harold": "harry hal", "harriet": "hattie", "helen": "nell", "henry": "harry hank hal", "herbert": "herb bert", "howard": "howie", "hubert": "hugh bert", "ignatius": "iggy", "isaac": "ike", "isabella": "bella izzy", "isabel": "izzy bel",
    "jacob": "jake", "jacqueline": "jackie", "james": "jim jimmy jamie", "janet": "jan", "jeffrey": "jeff", "jennifer": "jen jenny jenn", "jeremiah": "jerry", "jeremy": "jem", "jerome": "jerry", "jessica": "jess jessie", "joan": "joanie",
    "john": "jack johnny jon", "jonathan": "jon jonny", "joseph": "joe joey jo", "josephine": "jo josie", "joshua": "josh", "judith": "judy", "julia": "jules", "katherine": "kate kathy katie kat kitty", "kathleen": "kathy kath", "kenneth": "ken kenny",
    "kimberly": "kim", "lawrence": "larry lawrie", "leonard": "len lenny leo", "leopold": "leo", "lewis": "lew", "lillian": "lily lil", "louis": "lou louie", "louise": "lou", "madeline": "maddie", "margaret": "maggie peggy meg marge madge",
    "maria": "mary masha", "martha": "marty patty", "martin": "marty", "matthew": "matt matty", "maurice": "mo", "maximilian": "max", "melissa": "mel missy", "michael": "mike mick mikey micky", "mikhail": "misha", "mildred": "millie", "mitchell": "mitch",
    "nathaniel": "nat nate", "nicholas": "nick nicky nico", "nicole": "nicky", "nikolai": "kolya", "oksana": "ksenia", "oliver": "ollie", "pamela": "pam", "patricia": "pat trish patty tricia", "patrick": "pat paddy", "pavel": "pasha", "penelope": "penny",
    "percival": "percy", "peter": "pete", "philip": "phil pip", "piotr": "petya", "quentin": "quent", "rachel": "rach", "ravindra": "ravi", "raymond": "ray", "rebecca": "becky becca", "reginald": "reg reggie", "richard": "rick dick rich ricky richie",
    "robert": "bob rob bobby robbie bert", "roderick": "rod", "rodney": "rod", "roger": "rodge", "ronald": "ron ronnie", "rosemary": "rosie", "rudolph": "rudy", "rupert": "rupe", "russell": "russ", "samantha": "sam", "samuel": "sam sammy",
    "sarah": "sally sadie", "sebastian": "seb bastian", "sergei": "seryozha", "sidney": "sid", "solomon": "sol", "stanley": "stan", "stephanie": "steph", "stephen": "steve stevie", "steven": "steve", "stuart": "stu", "susan": "sue susie suzy",
    "sylvester": "sly", "terence": "terry", "teresa": "terry tess", "theodore": "ted teddy theo", "thomas": "tom tommy", "timothy": "tim timmy", "tobias": "toby", "valentina": "valya", "veronica": "ronnie", "victor": "vic", "victoria": "vicky vicki tori",
    "vincent": "vince", "virginia": "ginny", "vladimir": "vova", "walter": "walt wally", "wilhelmina": "mina", "william": "will bill billy willy liam", "winifred": "winnie", "winston": "win", "yevgeny": "zhenya", "zachary": "zach zack", "zofia": "zosia",
}
FULL_NAMES: dict[str, list[str]] = {}
for _full, _short in NICKNAMES.items():
    for _s in _short.split():
        FULL_NAMES.setdefault(_s, []).append(_full)
LEGAL = frozenset("ltd inc plc corporation company group holdings manufacturing llc llp lp gmbh ag kg se sa sas sarl spa srl nv bv ab asa oy oyj kk pty pte sro doo bhd".split())
SHORT_FORMS = {
    "corp": "corporation", "incorporated": "inc", "limited": "ltd", "co": "company", "mfg": "manufacturing", "hldgs": "holdings", "hldg": "holdings", "grp": "group", "plc": "plc",
    "int": "international", "intl": "international", "and": "&", "+": "&", "und": "&",
}
SMALL = frozenset("of and the &".split())

PERSON, ORG = "person", "organization"


def fold(name: str) -> str:
    """Lower case without accents, spaces single."""
    plain = unicodedata.normalize("NFKD", name.lower().translate(LETTERS))
    return " ".join("".join(c for c in plain if not unicodedata.combining(c)).split())


def person_keys(name: str) -> list[tuple[str, str]]:
    """Keys of a written person name: ("n", given surname) or ("i", initial surname)."""
    f = fold(name).replace(".", " ").replace("-", " ")
    if f.count(",") == 1:
        last, first = f.split(",")
        f = f"{first} {last}"
    t = f.replace(",", " ").split()
    while len(t) > 2 and t[0] in TITLES:
        t = t[1:]
    if len(t) > 2:
        t = [w for k, w in enumerate(t) if k in (0, len(t) - 1) or len(w) > 1]
    if len(t) < 2:
        return []
    out = []
    for order in (t, [t[-1], *t[:-1]]):
        first, rest = order[0], " ".join(order[1:])
        if len(rest) < 3:
            continue
        out.append(("i" if len(first) == 1 else "n", f"{first} {rest}"))
        out += [("n", f"{full} {rest}") for full in FULL_NAMES.get(first, ())]
    return list(dict.fromkeys(out))


def org_form(name: str) -> str:
    """Plain form of an organisation name: no leading article, short forms written out."""
    t = [SHORT_FORMS.get(w, w) for w in re.sub(r"[.']", "", fold(name)).split()]
    return " ".join(t[1:] if len(t) > 2 and t[0] == "the" else t)


def org_core(form: str) -> str:
    """The form without its legal endings; at least two words stay."""
    t = form.split()
    while len(t) > 2 and t[-1] in LEGAL:
        t = t[:-1]
    return " ".join(t)


def acronym(name: str) -> str:
    return "".join(w[0] for w in re.findall(r"[^\W_]+", fold(name)) if w not in SMALL)


def org_keys(name: str) -> list[tuple[str, str]]:
    """Keys of a written organisation name: ("n", form) or ("a", acronym)."""
    form = org_form(name)
    if not form:
        return []
    letters = re.sub(r"[.\s]", "", name)
    if 3 <= len(letters) <= 7 and letters.isalpha() and letters.isupper():
        return [("a", fold(letters))]
    t = form.split()
    out = [("n", form)]
    if len(t) > 2 and t[-1] == "plc" and t[-2] in LEGAL:
        out.append(("n", " ".join(t[:-1])))
    if len(t) == 2 and t[1] == "bank":
        out.append(("n", f"bank of {t[0]}"))
    return out


def registry_keys(kind: str, name: str) -> list[tuple[str, str]]:
    if kind == PERSON:
        f = fold(name).replace(".", " ").replace("-", " ").split()
        return [("n", " ".join(f)), ("i", f"{f[0][0]} {' '.join(f[1:])}")] if len(f) > 1 else [("n", " ".join(f))] if f else []
    form = org_form(name)
    if not form:
        return []
    return list(dict.fromkeys([("n", form), ("n", org_core(form)), ("a", acronym(name))]))


# --- the metric --------------------------------------------------------------------------------------


def codes(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Names as a padded array of code points with their lengths."""
    size = np.array([len(n) for n in names], np.int64)
    out = np.zeros((len(names), int(size.max(initial=0))), np.int32)
    for k, n in enumerate(names):
        out[k, : len(n)] = np.frombuffer(n.encode("utf-32-le"), np.int32)
    return out, size


def distances(chars: np.ndarray, size: np.ndarray, pivot: str) -> np.ndarray:
    """Levenshtein distance of every name to ``pivot``."""
    b = np.frombuffer(pivot.encode("utf-32-le"), np.int32)
    step = np.arange(len(b) + 1, dtype=np.int16)
    row = np.broadcast_to(step, (len(chars), len(b) + 1)).copy()
    out = np.where(size == 0, len(b), 0).astype(np.int16)
    for i in range(chars.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        np.minimum(row[:, :-1] + (chars[:, i, None] != b), row[:, 1:] + 1, out=new[:, 1:])
        row = np.minimum.accumulate(new - step, axis=1) + step
        out[size == i + 1] = row[size == i + 1, -1]
    return out


def levenshtein(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def one_edit(a: str, b: str) -> int | None:
    """0 if equal, 1 if one inserted, dropped, replaced or swapped letter apart, else None."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > 1:
        return None
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    if len(a) == len(b):
        swapped = k + 1 < len(a) and a[k] == b[k + 1] and a[k + 1] == b[k] and a[k + 2 :] == b[k + 2 :]
        return 1 if swapped or a[k + 1 :] == b[k + 1 :] else None
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return 1 if long[k + 1 :] == short[k:] else None


def edits_apart(a: str, b: str, most: int) -> int | None:
    """Fewest inserted, dropped, replaced or swapped letters between two names, None if more than ``most``; a letter is edited once."""
    if most == 1 or a == b:
        return one_edit(a, b)
    if abs(len(a) - len(b)) > most:
        return None
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i] + [most + 1] * len(b)
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            y = b[j - 1]
            d = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new[j] = d
        if min(new) > most:
            return None
        before, row = row, new
    return row[-1] if row[-1] <= most else None


def choose_pivots(names: list[str], count: int) -> list[str]:
    """Farthest-first pivots of a bounded sample."""
    if not names:
        return []
    chars, size = codes(names)
    picked = [min(names)]
    nearest = distances(chars, size, picked[0])
    while len(picked) < count and nearest.max(initial=0) > 0:
        picked.append(names[int(nearest.argmax())])
        nearest = np.minimum(nearest, distances(chars, size, picked[-1]))
    return picked


def radius_join(left: DataFrame, right: DataFrame, pivots: int | None = None, sample: int = 2000, group: int = 20_000, edits: int = 1) -> DataFrame:
    """Exact join of (id, space, key) with (ref, space, key): pairs (id, ref, key, ref_key, d) at most ``edits`` edits apart.

    pivots: per space, by default a third of the root of the number of registry keys, between 20 and 400, so that more
    cells share a larger registry. sample: registry keys from which pivots are chosen; the result depends on neither. group: keys of
    either side of a cell that one task takes; a fuller cell is dealt into blocks on both sides, and every two blocks meet.
    """
    reach_of = 2 * edits  # an edit of any kind, a swap included, is at most two Levenshtein steps
    if pivots is None:
        pivots = int(min(400, max(20, right.count() ** 0.5 / 3)))
    spaces = [r[0] for r in right.select("space").distinct().collect()]  # the kinds of names: two
    chosen: dict[str, list[str]] = {}
    for s in spaces:
        names = [r[0] for r in right.filter(F.col("space") == s).select("key").distinct().orderBy(F.xxhash64("key"), "key").limit(sample).collect()]
        chosen[s] = choose_pivots(sorted(names), pivots)
    longest = right.agg(F.max(F.length("key"))).first()[0] or 0
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def measured(reach: int, ident: str):  # noqa: ANN202
        schema = pa.schema([(ident, pa.int64()), ("space", pa.string()), ("key", pa.string()), ("cell", pa.int32()), ("far", pa.list_(pa.int16()))])

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids, space, key = (b.column(k).to_pylist() for k in range(3))
                for s in set(space):
                    at = [k for k, x in enumerate(space) if x == s]
                    for lo in range(0, len(at), 4000):
                        some = at[lo : lo + 4000]
                        chars, size = codes([key[k] for k in some])
                        d = np.stack([distances(chars, size, p) for p in chosen[s]], axis=1) if chosen.get(s) else np.zeros((len(some), 0), np.int16)
                        if not d.shape[1]:
                            continue
                        if reach:  # replicate where the triangle inequality leaves room
                            row, cell = np.nonzero(d <= d.min(axis=1)[:, None] + 2 * reach)
                        else:
                            row, cell = np.arange(len(some)), d.argmin(axis=1)
                        yield pa.RecordBatch.from_arrays([pa.array([ids[some[k]] for k in row], pa.int64()), pa.array([s] * len(row)), pa.array([key[some[k]] for k in row]), pa.array(cell, pa.int32()), pa.array([d[k] for k in row], pa.list_(pa.int16()))], schema=schema)

        return run, f"{ident} long, space string, key string, cell int, far array<short>"

    near, spec = measured(0, "id")
    a = materialize(left.filter(F.length("key") <= longest + reach_of).repartition(parts).select("id", "space", "key").mapInArrow(near, spec), "cells")
    near, spec = measured(reach_of, "ref")
    b = materialize(right.select("ref", "space", "key").mapInArrow(near, spec), "cells")
    # one row per cell: as many as pivots
    size = lambda df, name: df.groupBy("space", "cell").agg(F.ceil(F.count(F.lit(1)) / group).cast("int").alias(name))
    cuts = F.broadcast(size(a, "cuts").join(size(b, "parts"), ["space", "cell"]))
    deal = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = a.join(cuts, ["space", "cell"]).withColumn("cut", deal("cuts")).withColumn("part", every("parts")).select("space", "cell", "cut", "part", "id", "key", "far")
    b = b.join(cuts, ["space", "cell"]).withColumn("part", deal("parts")).withColumn("cut", every("cuts")).select("space", "cell", "cut", "part", "ref", "key", "far")
    cols = ["space", "cell", "cut", "part"]

    def match(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(x) and len(y):
            dy = np.stack(y["far"].to_numpy())
            yk, yr = y["key"].tolist(), y["ref"].tolist()
            for lo in range(0, len(x), 500):
                part = x.iloc[lo : lo + 500]
                dx = np.stack(part["far"].to_numpy())
                i, j = np.nonzero(np.abs(dx[:, None, 0] - dy[None, :, 0]) <= reach_of)
                for k in range(1, dx.shape[1]):
                    if not len(i):
                        break
                    ok = np.abs(dx[i, k] - dy[j, k]) <= reach_of
                    i, j = i[ok], j[ok]
                keys, ids = part["key"].tolist(), part["id"].tolist()
                for p, q in zip(i.tolist(), j.tolist()):
                    d = edits_apart(keys[p], yk[q], edits)
                    if d is not None:
                        out.append((ids[p], yr[q], keys[p], yk[q], d))
        return pd.DataFrame(out, columns=["id", "ref", "key", "ref_key", "d"])

    return a.groupBy(*cols).cogroup(b.groupBy(*cols)).applyInPandas(match, "id long, ref long, key string, ref_key string, d int")


# --- linking -----------------------------------------------------------------------------------------


def _plain(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, r"\s+", ""))


def _keys(df: DataFrame, ident: str, of) -> DataFrame:  # noqa: ANN001
    """(ident, kind, name) -> (ident, kind, type, key, given, raw_given)."""
    schema = pa.schema([(ident, pa.int64()), ("kind", pa.string()), ("type", pa.string()), ("key", pa.string()), ("raw_given", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, kind, name in zip(*(b.column(k).to_pylist() for k in range(3))):
                raw = set(name.lower().replace(",", " ").split())
                for t, key in of(kind, name):
                    given = key.split(" ", 1)[0]
                    # the given name as written, accents kept
                    rows.append((i, kind, t, key, next((w for w in raw if fold(w) == given), given)))
            cols = list(zip(*rows)) if rows else [[] for _ in schema.types]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

    return df.select(ident, "kind", "name").mapInArrow(run, f"{ident} long, kind string, type string, key string, raw_given string")


def link_names(names: DataFrame, registry: DataFrame, pivots: int | None = None, sample: int = 2000, group: int = 20_000, edits: int = 1) -> DataFrame:
    """Link written names to registry entities.

    names: (kind, name), kind ``person`` or ``organization``; repeats count once, null and blank names are
    left out. registry: (entity_id, kind, name); rows with nulls are left out, repeated ones count once.
    A name equal to a registry name but for letter case and spaces is no variant. The closest entity
    wins; names as close to several entities are not linked, and a given name that is itself a known
    given name is not taken for a misspelling of another. edits: letters that may be wrong; with two, names of different
    people come within reach of one another. Returns (kind, name, entity_id, d).
    """
    refs = registry.filter("entity_id is not null and kind is not null and name is not null").select(F.col("entity_id").cast("long").alias("ref"), "kind", "name").dropDuplicates(["ref"])
    known = materialize(_keys(refs, "ref", registry_keys), "registry_keys")
    alone = known.groupBy("kind", "type", "key").agg(F.countDistinct("ref").alias("n"), F.min("ref").alias("ref")).filter("n = 1")
    written = names.filter("name is not null and trim(name) <> ''").select("kind", "name").distinct()
    written = written.withColumn("plain", _plain(F.col("name"))).join(refs.select("kind", _plain(F.col("name")).alias("plain")).distinct(), ["kind", "plain"], "left_anti")
    written = materialize(written.select(F.xxhash64("kind", "name").alias("id"), "kind", "name"), "names")
    keys = materialize(_keys(written, "id", lambda kind, name: person_keys(name) if kind == PERSON else org_keys(name)), "name_keys")
    short = keys.filter("type <> 'n'").join(alone.drop("n"), ["kind", "type", "key"]).select("id", "ref", F.lit(0).alias("d"))
    left = keys.filter("type = 'n'").select("id", F.col("kind").alias("space"), "key").distinct()
    right = known.filter("type = 'n'").select("ref", F.col("kind").alias("space"), "key")
    near = radius_join(left, right, pivots, sample, group, edits)
    # a known given name is no misspelling of another one
    given = refs.filter(F.col("kind") == PERSON).select(F.lower(F.regexp_extract("name", r"^\s*(\S+)", 1)).alias("raw_given")).distinct().withColumn("is_given", F.lit(True))
    meant = keys.filter("type = 'n'").select("id", "key", "kind", "raw_given").distinct().join(given, "raw_given", "left")
    near = near.join(meant, ["id", "key"])
    other = (F.col("kind") == PERSON) & F.col("is_given") & (F.substring_index("key", " ", 1) != F.substring_index("ref_key", " ", 1))
    near = near.filter(~F.coalesce(other, F.lit(False))).select("id", "ref", "d")
    best = near.unionByName(short).groupBy("id", "ref").agg(F.min("d").alias("d"))
    w = Window.partitionBy("id").orderBy("d")
    best = best.withColumn("r", F.rank().over(w)).filter("r = 1").groupBy("id", "d").agg(F.count(F.lit(1)).alias("n"), F.min("ref").alias("entity_id")).filter("n = 1")
    return best.join(written, "id").select("kind", "name", "entity_id", "d")


def variants(values: DataFrame, registry: DataFrame, kinds: dict[str, list[str]], **options: int) -> DataFrame:
    """Variants met in records: (id, field, value) rows -> distinct (id, field, variant, entity_id).

    kinds: for every field the kinds of entities it may name. Only distinct names are compared, however
    many records hold them. A name that links to entities of two kinds is linked to none.
    """
    fields = F.create_map(*[x for f, k in kinds.items() for x in (F.lit(f), F.array(*map(F.lit, k)))])
    distinct = values.select("field", "value").distinct().select(F.explode(F.try_element_at(fields, F.col("field"))).alias("kind"), F.col("value").alias("name")).distinct()
    linked = materialize(link_names(distinct, registry, **options), "linked")
    allowed = linked.select("*", F.explode(F.array(*map(F.lit, kinds))).alias("field")).filter(F.array_contains(F.try_element_at(fields, F.col("field")), F.col("kind")))
    one = allowed.groupBy("field", F.col("name").alias("value")).agg(F.min_by("entity_id", F.struct("d", "entity_id")).alias("entity_id"), F.countDistinct("entity_id").alias("n"), F.countDistinct("d").alias("nd")).filter("n = 1 or nd > 1")
    return values.join(one.select("field", "value", "entity_id"), ["field", "value"]).select("id", "field", F.col("value").alias("variant"), "entity_id").distinct()
