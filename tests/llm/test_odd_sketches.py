"""MinHash bands and odd sketches against all pairs."""

import random

import numpy as np
import pytest

from aerolens.llm import components
from aerolens.llm.common import NULL_ID
from aerolens.llm.odd_sketches import (
    BITS, SAMPLES, band_keys, most_odd_bits, odd_sketch, odd_sketch_components, samples, similarity,
)
from aerolens.llm.queries import op11_odd_sketches
from tests.llm.conftest import EDGES, SF, frame, pairs
from tests.llm.test_similarity import components_by_hand, near_copies


def found_of(df):
    rows = df.collect()
    for r in rows:
        assert r["kept"] == ((NULL_ID if r["doc_id"] is None else r["doc_id"]) == r["component_id"])
    got = {NULL_ID if r["doc_id"] is None else r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert len(got) == len(rows)
    return got


def two_sets(rng, size, similarity_of):
    """Two sets of ``size`` elements with about the given Jaccard similarity."""
    same = round(2 * size * similarity_of / (1 + similarity_of))
    pool = rng.choice(2**62, 2 * size - same, replace=False).astype(np.uint64) * np.uint64(3)
    return pool[:size], np.concatenate([pool[:same], pool[size:]])


def odd_bits(x, y):
    return int(np.bitwise_count(odd_sketch(samples(x)) ^ odd_sketch(samples(y))).sum())


def test_sketches_tell_high_similarities():
    rng = np.random.default_rng(3)
    for share in (0.95, 0.9, 0.8):
        found = [similarity(odd_bits(*two_sets(rng, 300, share))) for _ in range(200)]
        assert abs(np.mean(found) - share) < 0.01 and np.std(found) < 0.06


def test_similar_sets_are_never_let_go():
    rng = np.random.default_rng(4)
    limit = most_odd_bits(80)
    assert limit < BITS / 2 * (1 - np.exp(-4 * 0.6 * SAMPLES / BITS))  # sets of 0.4 mostly are
    missed = 0
    for size in (5, 9, 40, 500):
        for _ in range(300):
            x, y = two_sets(rng, size, 0.8)
            both = len(np.intersect1d(x, y))
            if 100 * both < 80 * (2 * size - both):
                continue
            assert odd_bits(x, y) <= limit
            missed += not (band_keys(samples(x)) == band_keys(samples(y))).any()
    assert missed == 0


def test_sketch_of_equal_and_cancelling_samples():
    found = np.arange(SAMPLES, dtype=np.uint32)
    other = found.copy()
    other[7] += 1
    assert int(np.bitwise_count(odd_sketch(found) ^ odd_sketch(other)).sum()) in (0, 2)
    assert int(np.bitwise_count(odd_sketch(found)).sum()) % 2 == SAMPLES % 2


def hard_groups(seed):
    """Chains and groups of sets about as similar as the limit, in which a centre is linked with few."""
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(600)]
    rows = near_copies(seed)
    key = 500
    for size, steps in ((60, 5), (30, 2), (25, 9)):
        base = rng.choices(words, k=60)
        for _ in range(size):
            copy = list(base)
            for _ in range(steps):
                copy[rng.randrange(60)] = rng.choice(words)
            if rng.random() < 0.5:
                base = copy
            rows.append((key, " ".join(copy)))
            key += 1
    return rows


@pytest.mark.parametrize("block", [components.BLOCK_SETS, 7])
@pytest.mark.parametrize("words, percent", [(2, 80), (5, 80)])
def test_components_equal_all_pairs(spark, monkeypatch, words, percent, block):
    monkeypatch.setattr(components, "BLOCK_SETS", block)
    rows = hard_groups(words) + [(k, t) for k, t, *_ in EDGES]
    docs = frame(spark, [(k if k is None else k + 1000 * (k < 12), t, "en", "s") for k, t in rows])
    assert found_of(odd_sketch_components(docs, words=words, percent=percent)) == components_by_hand(pairs(docs), words, percent)


def test_repeated_and_unlike_rows_of_one_id(spark):
    first, second = "a b c d e f g h", "q r s t u v w x y z"
    rows = [(7, first)] * 50 + [(7, second)] * 3 + [(3, second), (9, first), (None, first), (None, "k l m n o"), (4, "k l m n o")]
    rows += [(11, None), (11, ""), (12, " \t\n")]
    docs = frame(spark, [(k, t, "en", "s") for k, t in rows])
    got = found_of(odd_sketch_components(docs, words=2, percent=80))
    assert got == components_by_hand(pairs(docs), 2, 80)
    assert got[9] == (7, 3) and got[4] == (4, 3) and got[11] == (0, 11)


def test_nothing(nothing):
    found = odd_sketch_components(nothing)
    assert found.count() == 0 and found.columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found_of(op11_odd_sketches(spark, SF)) == components_by_hand(pairs(docs), 2, 80)
