"""Mixing and packing against plain Python."""

import hashlib
from collections import defaultdict
from fractions import Fraction
from itertools import combinations

import numpy as np

from aerolens.llm.common import NULL_ID, WORD
from aerolens.llm.mixing import budgets, mix
from aerolens.llm.packing import bounds, pack

LEVELS = {"domain": "substring(source, 1, 4)", "lang": "lang", "source": "source"}


def shares(capacity, weights, given):
    """Fair shares of a budget by weight, none above its capacity."""
    open_, out, rest = set(capacity), {}, Fraction(given)
    while open_:
        level = rest / sum(weights[c] for c in open_)
        full = {c for c in open_ if capacity[c] <= level * weights[c]}
        if not full:
            return out | {c: level * weights[c] for c in open_}
        for c in full:
            out[c] = Fraction(capacity[c])
            rest -= capacity[c]
        open_ -= full
    return out


def test_budgets_are_fair_shares(spark):
    rng = np.random.default_rng(3)
    rows = [(f"d{d}", f"s{d}{s}", int(rng.integers(0, 900))) for d in range(4) for s in range(5)]
    leaves = spark.createDataFrame(rows, "domain string, source string, supply bigint")
    weights = {"domain": {"d0": 5, "d3": 2}, "source": {"s00": 7, "s11": 3}}
    total = sum(r[2] for r in rows)
    for budget in (0, 1, 500, total // 2, total, 2 * total, 5 * total):
        got = {r["source"]: r["budget"] for r in budgets(leaves, ["domain", "source"], weights, budget, 2).collect()}
        assert sum(got.values()) == min(budget, 2 * total)
        tops = {f"d{d}": 2 * sum(r[2] for r in rows if r[0] == f"d{d}") for d in range(4)}
        upper = shares(tops, {d: weights["domain"].get(d, 1) for d in tops}, min(budget, 2 * total))
        for domain, given in upper.items():
            inside = {r[1]: 2 * r[2] for r in rows if r[0] == domain}
            for source, share in shares(inside, {s: weights["source"].get(s, 1) for s in inside}, given).items():
                assert abs(got[source] - share) < 3 and got[source] <= inside[source]


def test_mix_takes_prefixes_of_the_drawn_order(edges, nothing):
    for percent in (0, 30, 90, 170):
        rows = mix(edges, levels=LEVELS, weights={"lang": {"en": 2}}, percent=percent, epochs=2).collect()
        assert len(rows) == edges.count()
        leaves = defaultdict(list)
        for r in rows:
            leaves[r["domain"], r["lang"], r["source"]].append(r)
        for members in leaves.values():
            supply, budget = sum(r["n_tokens"] for r in members), members[0]["budget"]
            full = budget // supply if supply else 0
            assert sum(r["n_tokens"] * r["copies"] for r in members) <= budget <= 2 * supply
            left, total = budget - full * supply, 0

            def draw(r):
                key = NULL_ID if r["doc_id"] is None else r["doc_id"]
                return hashlib.md5(f"1:{full}:{key}".encode()).hexdigest(), r["n_tokens"], r["row"]

            expected = []
            for r in sorted(members, key=draw):
                total += r["n_tokens"]
                expected.append(full + (total <= left))
            assert sorted(expected) == sorted(r["copies"] for r in members)
    assert mix(nothing, levels=LEVELS).count() == 0


def test_bounds_waste_least():
    rng = np.random.default_rng(5)
    for _ in range(30):
        size = int(rng.integers(1, 9))
        lengths = np.sort(rng.choice(np.arange(1, 60), size, replace=False))
        counts = rng.integers(1, 9, size)
        best = min(
            sum(
                sum((upper - n) * c for n, c in zip(lengths, counts) if low < n <= upper)
                for low, upper in zip((0, *cut, ), (*cut, lengths[-1]))
            )
            for k in range(min(3, size))
            for cut in combinations(lengths[:-1], k)
        )
        got = bounds(lengths, counts, lengths * counts, 3)
        wasted = sum((min(b for b in got if b >= n) - n) * c for n, c in zip(lengths, counts))
        assert wasted == best and len(got) <= 3


def test_pack_fills_batches(edges, nothing):
    rows = pack(edges, buckets=3, budget=2000).collect()
    assert sorted(r["n_tokens"] for r in rows) == sorted(
        len(WORD.findall(r["text"] or "")) for r in edges.select("text").collect()
    )
    batches = defaultdict(list)
    for r in rows:
        batches[r["bucket"], r["batch"]].append(r)
    for (bucket, batch), members in batches.items():
        size = max(1, 2000 // max(1, members[0]["bucket_tokens"]))
        assert sorted(r["slot"] for r in members) == list(range(len(members))) and len(members) <= size
        assert len(members) == size or (bucket, batch + 1) not in batches
        assert all(r["n_tokens"] <= r["bucket_tokens"] for r in members)
    assert pack(nothing).count() == 0
