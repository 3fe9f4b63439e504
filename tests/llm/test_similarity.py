"""Jaccard join, fingerprints and suffix dedup against plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aerolens.llm import shingles as shingles_module
from aerolens.llm import suffix_dedup as suffix
from aerolens.llm.common import NULL_ID, WORD, fold_ascii
from aerolens.llm.components import components
from aerolens.llm.fingerprints import edited, fingerprints, likeness, near_duplicates, signature
from aerolens.llm.ngram_jaccard import missing, ngram_jaccard, pairs_needed, prefix
from aerolens.llm.shingles import column_shingles, shingles
from tests.llm.conftest import EDGES, frame, pairs


def shingle_sets(rows, words):
    """All n-grams of the rows of each id."""
    found = []
    for key, text in rows:
        folded = WORD.findall(fold_ascii(text or ""))
        size = min(words, len(folded))
        grams = {tuple(folded[i : i + size]) for i in range(len(folded) - size + 1)} if folded else set()
        found.append((NULL_ID if key is None else key, grams))
    return found


def test_column_shingles(monkeypatch):
    """The same runs as in words split one by one, wherever texts are cut; equal runs have equal hashes."""
    rng = random.Random(3)
    alphabet = [" ", "\n", "\x0b", "\x1c", "\x85", "\u2003", "A", "a", "b", "É", "é", "\U0001F600"]
    for _ in range(200):
        texts = [rng.choice([None, "".join(rng.choices(alphabet, k=rng.choice([0, 1, 3, 20, 200])))]) for _ in range(9)]
        size = rng.choice([1, 2, 4])
        monkeypatch.setattr(shingles_module, "BLOCK", 1 << 16)
        whole = list(column_shingles(pa.array(texts, pa.string()), size))
        monkeypatch.setattr(shingles_module, "BLOCK", rng.choice([4, 16, 64]))
        cut = list(column_shingles(pa.array(texts, pa.string()), size))
        sets = [grams for _, grams in shingle_sets(list(enumerate(texts)), size)]
        assert [x.tolist() for x in cut] == [x.tolist() for x in whole] and len(whole) == len(texts)
        assert [len(x) for x in whole] == [len(x) for x in sets]
        assert len(set().union(*sets)) == len(set().union(*(x.tolist() for x in whole)))
        assert len({frozenset(x) for x in sets}) == len({x.tobytes() for x in whole})


def test_column_shingles_of_a_long_word():
    word = "x" * 500_000
    one, two, other = column_shingles(pa.array([f"a {word} b", f"A  {word}\nB", f"a {word}y b"]), 2)
    assert one.tolist() == two.tolist() and len(one) == 2 and not set(one.tolist()) & set(other.tolist())


def components_by_hand(rows, words, percent):
    sets = shingle_sets(rows, words)
    parent = {key: key for key, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, (key, grams) in enumerate(sets):
        shared = Counter(j for gram in grams for j in holders[gram])
        for j, both in shared.items():
            if 100 * both >= percent * (len(grams) + len(sets[j][1]) - both):
                x, y = root(key), root(sets[j][0])
                parent[max(x, y)] = min(x, y)
        for gram in grams:
            holders[gram].append(i)
    sizes = defaultdict(int)
    for key, grams in sets:
        sizes[key] = max(sizes[key], len(grams))
    return {key: (sizes[key], root(key)) for key in sizes}


def near_copies(seed=7):
    """Groups of near copies of different closeness, with passages that many share."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(words, k=70))
    rows, key = [], 0
    for size in (40, 12, 5, 2, 1, 1, 1):
        base = rng.choices(words, k=rng.choice([30, 120]))
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 8])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            text = " ".join(copy)
            rows.append((key, text if rng.random() < 0.7 else f"{text}\n{passage}"))
            key += 1
    return rows


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80), (1, 60)])
def test_components_equal_all_pairs(spark, words, percent):
    rows = near_copies() + [(k, t) for k, t, *_ in EDGES]
    docs = frame(spark, [(k if k is None else k + 1000 * (k < 12), t, "en", "s") for k, t in rows])
    given = pairs(docs)
    got = {
        NULL_ID if r["doc_id"] is None else r["doc_id"]: (r["n_shingles"], r["component_id"])
        for r in ngram_jaccard(docs, words=words, percent=percent).collect()
    }
    assert got == components_by_hand(given, words, percent)


def test_components_of_documents(small_docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_jaccard(small_docs, words=4, percent=85).collect()}
    assert got == components_by_hand(pairs(small_docs), 4, 85)


def test_frequent_tokens_change_no_link():
    """Whatever tokens count as frequent, linked sets share an index entry."""
    rng = np.random.default_rng(11)
    for _ in range(400):
        size, percent = int(rng.integers(6, 60)), int(rng.choice([60, 80, 85]))
        pool = rng.permutation(np.arange(1, 200, dtype=np.uint64))
        left = np.sort(pool[:size])
        drop = int(rng.integers(0, size // 3 + 1))
        right = np.sort(np.concatenate([left[drop:], pool[size : size + int(rng.integers(0, size // 3 + 1))]]))
        both = len(np.intersect1d(left, right))
        if 100 * both < percent * (len(left) + len(right) - both) or both == len(left) == len(right):
            continue
        frequent = np.sort(rng.choice(pool, int(rng.integers(0, 200)), replace=False))
        (a, pa, _), (b, pb, _) = (prefix(t, frequent, percent) for t in (left, right))
        assert set(a.tolist()) & set(b.tolist()) or set(pa.tolist()) & set(pb.tolist())


@pytest.mark.parametrize("percent", [40, 50, 51, 60, 66, 70, 80, 85])
def test_small_sets_lose_no_link(percent):
    """All pairs of sets of up to eight tokens, all or some of them frequent."""
    pool = np.arange(1, 9, dtype=np.uint64)
    sets = [pool[[bool(m >> i & 1) for i in range(8)]] for m in range(1, 256)]
    for frequent in (pool, pool[::2], pool[3:]):
        made = []
        for tokens in sets:
            single, pairs, _ = prefix(tokens, frequent, percent)
            made.append({("s", t) for t in single.tolist()} | {("p", t) for t in pairs.tolist()})
        for i, left in enumerate(sets):
            for j in range(i):
                both = len(np.intersect1d(left, sets[j]))
                if 100 * both >= percent * (len(left) + len(sets[j]) - both):
                    assert made[i] & made[j], (left, sets[j])


def test_components_of_few_frequent_words(spark):
    docs = frame(spark, [(i, t, "en", "s") for i, t in enumerate(["a b c", "a b", "a c", "b c"] * 9)])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_jaccard(docs, words=1, percent=60).collect()}
    assert got == components_by_hand(pairs(docs), 1, 60)


def test_bounds_of_sizes():
    for size in range(6, 40):
        for other in range(6, 40):
            least = next((i for i in range(min(size, other) + 1) if 100 * i >= 85 * (size + other - i)), None)
            if least is not None:
                assert missing(size, other, 85) == size - least
        assert pairs_needed(size, 0, 85) <= size - 1


def test_long_paths_are_one_component(spark):
    links = spark.range(300).selectExpr("id as a", "id + 1 as b").where("a <> 150")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {i: 0 if i <= 150 else 151 for i in range(301)}
    assert components(links.where("false")).count() == 0


def test_jaccard_of_nothing(nothing):
    assert ngram_jaccard(nothing).count() == 0 and near_duplicates(nothing).count() == 0


def test_near_duplicates(spark):
    rows = near_copies(3)
    docs = frame(spark, [(k, t, "en", "s") for k, t in rows] + [(900, None, "en", "s"), (901, "", "en", "s")])
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    expected = {k: c for k, (_, c) in components_by_hand(pairs(docs), 5, 80).items()}
    assert got == expected


def test_fingerprints(edges, small_docs, nothing):
    for docs in (edges, small_docs):
        hashes = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
        rows = sorted(
            ((-(2**63) if r["doc_id"] is None else r["doc_id"], r["h"], r["text"] or "") for r in hashes), reverse=True
        )
        expected = []
        for i, (key, _, text) in enumerate(rows):
            following = rows[(i + 1) % len(rows)][2]
            changed = edited(text, following)
            own, other, after = signature(text), signature(changed), signature(following)
            expected.append((
                None if key == -(2**63) else key, len(text), hashlib.sha256(changed.encode()).hexdigest(),
                own.tobytes().hex(), other.tobytes().hex(), likeness(own, other), likeness(own, after),
            ))
        assert sorted(map(tuple, fingerprints(docs).collect()), key=repr) == sorted(expected, key=repr)
    assert fingerprints(nothing).count() == 0


def test_an_only_document_follows_itself(spark):
    row = fingerprints(frame(spark, [(5, "one two three four five six seven", "en", "s")])).first()
    assert row["near_next"] == 1.0


def test_likeness_follows_the_similarity():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(5000)]
    for changed in (0, 5, 40):
        base = rng.choices(words, k=600)
        other = list(base)
        for i in rng.sample(range(600), changed):
            other[i] = "new"
        x, y = (set(shingles(t, 5).tolist()) for t in (base, other))
        estimate = likeness(signature(" ".join(base)), signature(" ".join(other)))
        assert abs(estimate - len(x & y) / len(x | y)) < 0.15
    assert likeness(signature(""), signature("a")) == 0.0 and likeness(signature(""), signature(None)) == 1.0


def test_transform_finds_all_repeats():
    rng = random.Random(1)
    for length in (1, 3, 7, 20):
        for _ in range(120):
            texts = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(0, 50))) for _ in range(rng.randint(1, 6))]
            windows = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
            for text, flags in zip(texts, suffix.repeated_windows(texts, length)):
                assert list(flags) == [windows[text[i : i + length]] > 1 for i in range(len(text) - length + 1)]


def removed_by_hand(rows, length):
    texts = [(key, (text or "").encode()) for key, text in rows]
    windows = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for key, text in texts:
        gone = np.zeros(len(text), dtype=bool)
        for i in range(len(text) - length + 1):
            if windows[text[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((key, bytes(np.frombuffer(text, np.uint8)[~gone]), len(text), int(gone.sum()), spans))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot, block", [(suffix.HOT, suffix.BLOCK), (1, 997)])
def test_suffix_dedup(spark, small_docs, monkeypatch, hot, block):
    monkeypatch.setattr(suffix, "HOT", hot)
    monkeypatch.setattr(suffix, "BLOCK", block)
    edges = [(k, (t or "")[:4000] if t is not None else None, "en", "s") for k, t, *_ in EDGES]
    short = [(r["doc_id"] + 100, r["text"][:6000], "en", "s") for r in small_docs.limit(60).collect()]
    docs = frame(spark, [*edges, *short])
    got = suffix.suffix_dedup(docs, length=60, gram=20).collect()
    assert sorted(((r[0], bytes(r[1]), *r[2:]) for r in got), key=repr) == removed_by_hand(pairs(docs), 60)


def test_suffix_dedup_of_nothing(nothing):
    assert suffix.suffix_dedup(nothing).count() == 0


def test_suffix_dedup_of_repeated_rows(spark):
    """Many equal rows, without an id too: each is a copy of the others, and work grows with the rows."""
    rng = random.Random(5)
    text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(500))
    rows = [(None, text, None, None)] * 1600 + [(7, text, None, None), (8, "clean " + text[:100], None, None)]
    found = suffix.suffix_dedup(frame(spark, rows)).groupBy("doc_id", "n_bytes", "n_removed", "n_spans").count()
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(None, len(text), len(text), 1, 1600), (7, len(text), len(text), 1, 1), (8, 106, 0, 0, 1)], key=str)
