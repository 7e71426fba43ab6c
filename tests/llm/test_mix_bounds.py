"""Copies and shares of a mix against what the targets allow, over a whole table."""

import math
import os
from collections import defaultdict

import pytest

from newsloom.llm import mixing

D = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")
def test_copies_and_shares_stay_in_their_bounds(spark):
    plan, report = mixing.mix(spark.read.parquet(f"{D}/documents.parquet").repartition(7), spark.read.parquet(f"{D}/mix_targets.parquet"))
    rows, goals = defaultdict(list), {r.source: r for r in report.collect()}
    for r in plan.collect():
        rows[r.source].append(r)
    assert abs(sum(g.actual_share for g in goals.values()) - 1) < 1e-9 and any(g.reachable for g in goals.values())
    for s, g in goals.items():
        rate = min(g.needed_tokens / g.own_tokens, g.max_repeats) if g.own_tokens else 0.0
        copies = [r.copies for r in rows[s]]
        assert len(copies) == g.docs and all(math.floor(rate - 1e-9) <= c <= math.ceil(rate + 1e-9) for c in copies)
        assert abs(sum(copies) - rate * g.docs) < 1 + 1e-6  # pivotal rounding: the number of copies is kept
        got = sum(r.copies * r.tokens for r in rows[s])
        assert got == g.mix_tokens
        sizes = [r.tokens for r in rows[s]] or [0]
        fraction = rate - math.floor(rate + 1e-12)
        spread = math.sqrt(fraction * (1 - fraction) * sum((x - sum(sizes) / len(sizes)) ** 2 for x in sizes))
        assert abs(got - rate * g.own_tokens) <= 5 * spread + max(sizes)  # and its tokens miss by their spread
        assert g.reachable or got == g.max_repeats * g.own_tokens
