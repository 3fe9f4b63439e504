"""Language ID, quality rules, chat windows and the pipeline."""

import hashlib
import zlib

import numpy as np
import pytest

import corpus_pipeline
from aerolens.llm import language_id as langs
from aerolens.llm.chat_format import chat_windows, escape, read_back, render, spans, unescape, words
from aerolens.llm.common import ASCII_SPACE, WORD
from aerolens.llm.ngram_jaccard import ngram_jaccard
from aerolens.llm.quality_rules import SYMBOLS, distance, quality_rules
from tests.conftest import DATA
from tests.llm.conftest import EDGES, SF, frame, pairs
from tests.llm.test_lines_tokens import lines_by_hand
from tests.llm.test_similarity import components_by_hand


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(str(DATA / "sf0.01" / "documents.parquet"))
    got = langs.language_id(docs, carry=("lang", "text")).collect()
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(held) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got) and {r["lang_pred"] for r in got} <= {"en", "de", "fr", "es"}


def test_labels_of_held_out_documents_teach_nothing(spark):
    rows = [(i, "the cat sat here" if i % 2 else "die katze war da", "en" if i % 2 else "de", "s") for i in range(60)]
    lies = [(k, t, "xx" if zlib.crc32(str(k).encode()) % 4 == 2 else lang, s) for k, t, lang, s in rows]
    got = langs.language_id(frame(spark, [*lies, (None, "the cat", "yy", "s"), (99, None, "zz", "s")])).collect()
    assert {r["lang_pred"] for r in got} == {"en", "de", "und"}
    assert [r["score"] for r in got if r["lang_pred"] == "und"] == [0.0]


def test_filters_return_the_languages_of_an_ngram():
    rng = np.random.default_rng(4)
    many = [np.unique(rng.integers(0, 1 << 63, 500, dtype=np.uint64)) for _ in range(70)]
    model = langs.build([f"l{i}" for i in range(70)], list(enumerate(many)))
    for i in (0, 7, 63, 64, 69):
        found = None
        for at in langs._positions(many[i], len(model.masks)):
            found = model.masks[at] if found is None else found & model.masks[at]
        assert ((found[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).all()
    strange = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    found = None
    for at in langs._positions(strange, len(model.masks)):
        found = model.masks[at] if found is None else found & model.masks[at]
    wrong = np.mean((found[:, 0] & np.uint64(1)) > 0)
    assert abs(wrong - model.filled[0] ** langs.HASHES) < 0.005


def test_blocks_of_a_long_text_have_the_ngrams_of_the_whole(monkeypatch):
    text = "".join(np.random.default_rng(1).choice(list("abcé  1."), 5000))
    whole = np.sort(np.concatenate(list(langs.grams(text))))
    monkeypatch.setattr(langs, "BLOCK", 700)
    assert (np.sort(np.concatenate(list(langs.grams(text)))) == whole).all()


def test_language_id_on_edges(edges, nothing):
    got = langs.language_id(edges).collect()
    assert len(got) == len(EDGES)
    for r, text in zip(sorted(got, key=lambda r: repr(r["doc_id"])), sorted(EDGES, key=lambda e: repr(e[0]))):
        if not any(c.isalpha() for c in text[1] or ""):
            assert any(g["lang_pred"] == "und" for g in got if g["doc_id"] == text[0])
    assert langs.language_id(nothing).count() == 0


def base_by_hand(text):
    text = text or ""
    found = WORD.findall(text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if line.strip(ASCII_SPACE):
            repeated += line in seen
            seen.add(line)
    places = {}
    for i in range(len(found) - 2):
        places.setdefault(tuple(found[i : i + 3]), []).append(i)
    inside = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(3)}
    failed = len(found) < 50 or 100 * len(inside) > 50 * len(found)
    return len(found), sum(map(len, found)), sum(text.count(c) for c in SYMBOLS), repeated, len(inside), failed


def test_base_rules(edges, small_docs, nothing):
    for docs in (edges, small_docs):
        got = quality_rules(docs).collect()
        assert sorted((repr(r["doc_id"]), *r[1:7]) for r in got) == sorted(
            (repr(k), *base_by_hand(t)) for k, t in pairs(docs)
        )
        assert not any(r["kept"] and r["base_failed"] for r in got)
    assert quality_rules(nothing).count() == 0


def test_verdicts_follow_the_labels(spark):
    folder = DATA / "sf0.01"
    docs, labels = (spark.read.parquet(str(folder / f"{t}.parquet")) for t in ("documents", "labels"))
    got = quality_rules(docs).join(labels, "doc_id").where("not base_failed").collect()
    good = [r["kept"] for r in got if r["quality"] == 1]
    bad = [r["kept"] for r in got if r["quality"] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.45


def test_distance():
    assert distance(np.array([3, 1]), np.array([6, 2])) == pytest.approx(0)
    assert distance(np.array([1, 0]), np.array([0, 5])) == pytest.approx(1)
    assert distance(np.array([0, 0]), np.array([0, 5])) == 1
    # From the definition: p = (1/2, 1/2), q = (1, 0).
    expected = np.sqrt((0.5 * np.log2(0.5 / 0.75) + 0.5 * np.log2(0.5 / 0.25) + np.log2(1 / 0.75)) / 2)
    assert distance(np.array([1, 1]), np.array([2, 0])) == pytest.approx(expected)


TURNS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "a " * 300), (1, 2, "assistant", "b " * 200), (1, 3, "user", "c"),
    (1, 4, "assistant", "### User: </turn>\n\\h"), (2, 0, "user", None), (2, 1, "assistant", ""), (2, None, None, "null turn"),
    (2, 1, "assistant", ""), (None, 3, "assistant", "x" * 9000), (None, 2, "user", "tie"), (None, 2, "assistant", "tie"),
    (3, 5, "assistant", "only"),
] + [(4, i, ("system", "user", "assistant")[0 if i == 0 else 1 + i % 2], f"turn {i} " + "w " * (i % 90)) for i in range(700)]


def digests(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in by.items():
        turns.sort()
        whole = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        learned = "".join(text for *_, role, text in turns if role == "assistant")
        out.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_windows_hold_every_turn_and_target_once(spark):
    frame_ = spark.createDataFrame([(*t, "clash") for t in TURNS], "conv_id bigint, turn bigint, role string, text string, block string")
    formatted = chat_windows(frame_, budget=512, history=2, history_budget=128)
    assert sorted((tuple(r)[:5] for r in read_back(formatted).collect()), key=repr) == digests(TURNS)
    tokens = {}
    for r in formatted.collect():
        parts = r["text"].split("</turn>\n")[:-1]
        assert "".join(p + "</turn>\n" for p in parts) == r["text"]
        cost = sum(words(p.split(": ", 1)[1]) + 3 for p in parts)
        tokens[r["conv_id"], r["block"], r["window"]] = cost
        new = len(r["text"][r["new_from"] :].split("</turn>\n")) - 1
        assert cost <= 512 or new == 1
        # The system turn opens every window of its conversation, of later blocks too.
        if r["conv_id"] in (1, 4):
            assert r["text"].startswith("### system: ")
        for start, end in zip(r["starts"], r["ends"]):
            assert start >= r["new_from"] and r["text"][:start].endswith("### assistant: ") and r["text"][end:].startswith("</turn>\n")
    assert len([k for k in tokens if k[0] == 4 and k[1] == 2]) > 1
    empty = frame_.where("false")
    assert chat_windows(empty).count() == 0 and read_back(chat_windows(empty)).count() == 0


def test_spans():
    assert spans(np.array([5, 5, 5, 5]), 0, 10, 0, 0) == [(0, 0, 2), (2, 2, 4)]
    assert spans(np.array([5, 5, 5, 5]), 0, 10, 1, 5) == [(0, 0, 2), (1, 2, 3), (2, 3, 4)]
    assert spans(np.array([50, 1]), 3, 10, 1, 5) == [(0, 0, 1), (1, 1, 2)]


def test_escapes_are_reversible():
    for text in ("\\", "\\h", "#", "<", ":", "\\\\h#</turn>\n### a: ", "", "\\c:", "日本 "):
        body, begin, end = render(text, text)
        assert unescape(escape(text)) == text and unescape(body[begin:end]) == text
        assert "#" not in escape(text) and "<" not in escape(text)


def test_stages_against_plain_python(spark):
    """Each stage on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "ngram_jaccard", "mixing", "packing"]
    given = pairs(docs)
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF)
        kept = spark.createDataFrame(kept.collect(), kept.schema)
        if name != "packing":
            assert kept.dtypes == docs.dtypes
            after = pairs(kept)
        if name == "language_id":
            assert {k for k, _ in given} - {k for k, _ in after} <= {k for k, t in given if not any(c.isalpha() for c in t or "")}
            assert set(after) <= set(given)
        elif name == "line_dedup":
            assert sorted(after) == sorted((k, t) for k, t, *_ in lines_by_hand(given))
            assert all(r["n_chars"] == len(r["text"]) for r in kept.collect())
        elif name == "ngram_jaccard":
            first = {k for k, (_, c) in components_by_hand(given, 5, 80).items() if k == c}
            assert sorted(after) == sorted((k, t) for k, t in given if k in first)
        elif name == "mixing":
            total = sum(len(WORD.findall(t)) for _, t in given)
            taken = sum(len(WORD.findall(t)) for _, t in after)
            longest = max(len(WORD.findall(t)) for _, t in given)
            leaves = docs.select("lang", "source").distinct().count()
            assert total * 75 // 100 - longest * leaves <= taken <= total * 75 // 100 and set(after) <= set(given)
        else:
            assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, _ in given)
            assert {r["bucket"] for r in kept.collect()} <= set(range(1, 9))
        docs, given = kept, after


def test_pipeline_on_edges_and_nothing(spark, edges, nothing):
    for docs in (edges, nothing):
        rows = docs
        for name, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, SF)
            if name != "packing":
                assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars"]
                rows = spark.createDataFrame(rows.collect(), rows.schema)
        assert rows.count() >= 0
    assert ngram_jaccard(edges, words=5, percent=80).count() == len({e[0] for e in EDGES})
