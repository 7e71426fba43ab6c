"""Names that no table knows, wider radii, and cells that are dealt into blocks."""

import itertools
import random

import pytest

from newsloom.llm import entities


def osa(a, b):
    d = [[max(i, j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_edits_apart():
    rng = random.Random(1)
    for _ in range(3000):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(0, 8))) for _ in range(2))
        for most in (1, 2, 3):
            want = osa(a, b)
            assert entities.edits_apart(a, b, most) == (want if want <= most else None)


@pytest.mark.parametrize("edits", [1, 2])
def test_radius_join_in_blocks(spark, edits):
    rng = random.Random(2)
    ref = list({"".join(rng.choice("abcdef") for _ in range(rng.randrange(5, 9))) for _ in range(120)})

    def noise(s):
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(s) - 1)
            s = rng.choice([s[:k] + rng.choice("abcdef") + s[k:], s[:k] + s[k + 1 :], s[:k] + s[k + 1] + s[k] + s[k + 2 :]])
        return s

    left = [(k, "s", noise(rng.choice(ref))) for k in range(400)]
    want = {(i, j, osa(a, b)) for i, _, a in left for j, b in enumerate(ref) if osa(a, b) <= edits}
    got = entities.radius_join(spark.createDataFrame(left, "id long, space string, key string"), spark.createDataFrame([(k, "s", r) for k, r in enumerate(ref)], "ref long, space string, key string"), pivots=5, group=30, edits=edits)
    assert {(r.id, r.ref, r.d) for r in got.collect()} == want and len(want) > 100


def test_names_no_table_knows(spark):
    """Invented given names and forms: order, initials, accents, titles and slips of the pen need no list of names."""
    rng = random.Random(3)
    part = lambda n: "".join(rng.choice(["ka", "lo", "mi", "rus", "ten", "vor", "bel", "dag", "zin", "phe"]) for _ in range(n)).capitalize()
    people = sorted({f"{part(2)} {part(3)}" for _ in range(60)})
    surnames = [p.split()[1] for p in people]
    people = [p for p in people if surnames.count(p.split()[1]) == 1]
    kinds = {
        "order": lambda g, s: f"{s}, {g}", "initial": lambda g, s: f"{g[0]}. {s}", "title": lambda g, s: f"Dr {g} {s}", "middle": lambda g, s: f"{g} Q. {s}", "drop": lambda g, s: f"{g} {s[:2]}{s[3:]}", "swap": lambda g, s: f"{g} {s[:2]}{s[3]}{s[2]}{s[4:]}",
        "accent": lambda g, s: f"{g} {s.replace('o', 'ó', 1)}",
    }
    names, truth = [], {}
    for k, p in enumerate(people):
        for kind, f in kinds.items():
            v = f(*p.split())
            if v != p:
                names.append(("person", v))
                truth.setdefault(v, set()).add((k, kind))
    reg = spark.createDataFrame([(k, "person", p) for k, p in enumerate(people)], "entity_id long, kind string, name string")
    got = {r.name: r.entity_id for r in entities.link_names(spark.createDataFrame(names, "kind string, name string"), reg).collect()}
    right = {kind: [0, 0] for kind in kinds}
    for v, cases in truth.items():
        for k, kind in cases:
            right[kind][1] += 1
            right[kind][0] += got.get(v) == k
    print({k: f"{a}/{b}" for k, (a, b) in right.items()})
    assert all(v not in got or got[v] in {k for k, _ in cases} for v, cases in truth.items())
    assert all(a >= 0.8 * b for a, b in right.values())
