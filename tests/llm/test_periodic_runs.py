"""Periodic runs against all lags and all stretches."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from aerolens.llm.common import WORD
from aerolens.llm.periodic_runs import collapse, find_runs, gram_size, periodic_runs
from aerolens.llm.queries import op12_periodic_runs, planted_period
from tests.llm.conftest import SF, frame, pairs


def runs_by_hand(words, least_words=24, least_periods=3):
    found = {}
    for q in range(1, len(words) // least_periods + 1):
        i = q
        while i < len(words):
            if words[i] != words[i - q]:
                i += 1
                continue
            begin = i
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            start, length = begin - q, i - begin + q
            if length >= max(least_words, least_periods * q):
                found.setdefault((start, length), q)  # the smallest period comes first
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def test_every_run_matches_itself_over_the_passages():
    for least, times in ((24, 3), (10, 2), (7, 4), (30, 3)):
        size = gram_size(least, times)
        for q in range(1, 100):
            assert max(least, times * q) - q >= size


@pytest.mark.parametrize("seed", range(12))
def test_runs_of_random_texts(seed):
    rng = random.Random(seed)
    for _ in range(60):
        words = []
        while len(words) < rng.choice([10, 60, 200]):
            kind = rng.random()
            if kind < 0.4:
                root = rng.choices("abcd"[: rng.randint(1, 4)], k=rng.randint(1, 12))
                words += (root * 40)[: rng.randint(1, 80)]
            elif kind < 0.6 and words:
                begin = rng.randrange(len(words))
                words += (words[begin:][:40] * 4)[: rng.randint(1, 120)]
            else:
                words += rng.choices("abcdef", k=rng.randint(1, 20))
        assert find_runs(words) == runs_by_hand(words)
        assert find_runs(words, 10, 2) == runs_by_hand(words, 10, 2)


def test_two_letter_texts():
    rng = random.Random(5)
    for _ in range(400):
        words = rng.choices("ab", [9, 1], k=rng.randint(24, 150))
        assert find_runs(words) == runs_by_hand(words)


def test_runs_inside_runs():
    words = (["a"] * 30 + ["b"]) * 5
    assert find_runs(words) == runs_by_hand(words)
    assert (0, 155, 31) in find_runs(words)
    assert collapse(words, find_runs(words))[:1] == ["a"]


def test_long_run_in_proportion():
    assert find_runs(["a"] * 300_000) == [(0, 300_000, 1)]
    root = [f"w{i % 90}" for i in range(100)]
    assert find_runs(root * 2000) == [(0, 200_000, 100)]


def test_operator_on_edges(edges, nothing):
    got = periodic_runs(edges).collect()
    expected = []
    for key, text in pairs(edges):
        words = WORD.findall(text or "")
        runs = runs_by_hand(words) if len(words) < 10_000 else []
        expected.append((key, len(words), runs, " ".join(collapse(words, runs))))
    assert sorted(((r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in got), key=repr) == sorted(expected, key=repr)
    assert periodic_runs(nothing).count() == 0


def test_text_ids_are_handed_on(spark):
    docs = spark.createDataFrame([("x7", "a " * 30)], "doc_id string, text string")
    assert [(r.doc_id, len(r.runs)) for r in periodic_runs(docs).collect()] == [("x7", 1)]


def test_query(spark):
    got = {r["doc_id"]: r for r in op12_periodic_runs(spark, SF).collect()}
    given = pairs(spark.read.parquet(f"{SF}/documents.parquet"))
    assert len(got) == len(given)
    planted = 0
    for key, text in given:
        words = WORD.findall(text or "")
        h = zlib.crc32(str(key).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
            assert planted_period(key, WORD.findall(text)) == words
        runs = runs_by_hand(words)
        row = got[key]
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    assert planted > 10
