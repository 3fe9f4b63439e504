"""Stages of the pipeline on planted documents."""

import numpy as np
import pytest

import corpus_pipeline
from aerolens.llm.chat_format import MARKS, chat_windows, render, spans, words
from aerolens.llm.mixing import mix
from aerolens.llm.packing import pack
from aerolens.llm.token_counts import token_count, token_prefixes
from tests.conftest import DATA
from tests.llm.conftest import SF
from tests.llm.test_lines_tokens import encode

COLUMNS = corpus_pipeline.COLUMNS


@pytest.mark.parametrize("foreign", ["es", "de"])
def test_documents_in_an_unlearned_language_go(spark, foreign):
    docs = spark.read.parquet(str(DATA / "sf0.01" / "documents.parquet")).select(*COLUMNS)
    own = docs.where(f"lang <> '{foreign}'")
    planted = docs.where(f"lang = '{foreign}' and n_chars >= 400").selectExpr("doc_id", "text", "null as lang", "source", "n_chars")
    kept = {r["doc_id"] for r in corpus_pipeline.keep_languages(spark, own.unionByName(planted), SF).select("doc_id").collect()}
    strange = {r["doc_id"] for r in planted.select("doc_id").collect()}
    clean = {r["doc_id"] for r in own.where("text rlike '[a-z]'").select("doc_id").collect()}
    assert len(strange) > 50 and len(strange & kept) <= 0.02 * len(strange)
    assert len(clean - kept) <= 0.002 * len(clean)


def test_budgets_are_in_tokens(spark, edges):
    counted = sorted(r["n_tokens"] for r in token_prefixes(edges, keep_prefixes=False).collect())
    assert counted == sorted(r[0] for r in edges.select(token_count(edges["text"])).collect())
    packed = pack(edges, tokens=token_count).collect()
    mixed = mix(edges, levels={"lang": "lang"}, tokens=token_count).collect()
    assert sorted(r["n_tokens"] for r in packed) == sorted(r["n_tokens"] for r in mixed) == counted
    # Texts without blanks are as long as they are.
    docs = spark.createDataFrame([(i, f"{i}ab9" * 3000, "en", "src0", 0) for i in range(9)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    sizes = {f: encode(f"{f}ab9" * 3000) for f in range(9)}
    batches = {}
    for r in corpus_pipeline.pack_batches(spark, docs, SF).collect():
        batches.setdefault((r["bucket"], r["batch"]), []).append(sizes[r["doc_id"]])
    assert all(len(b) == 1 or len(b) * max(b) <= corpus_pipeline.BATCH_TOKENS for b in batches.values())
    taken = [sizes[r["doc_id"]] for r in corpus_pipeline.mix_sources(spark, docs, SF).collect()]
    assert sum(sizes.values()) * 75 // 100 - max(sizes.values()) <= sum(taken) <= sum(sizes.values()) * 75 // 100


def test_every_text_is_a_node_of_its_own(spark):
    def text(n, last="end"):
        return " ".join(f"w{n}x{i}" for i in range(60)) + " " + last

    rows = [
        (1, text(1)), (None, text(1, "near")), (None, text(2)), (None, text(3)), (2, text(2, "near")), (3, text(3, "near")),
        (None, text(4)), (None, text(4)), (5, text(5)), (5, text(5)), (5, text(6)), (None, text(7)), (6, ""),
    ]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, SF)
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted([
        (1, text(1)), (2, text(2, "near")), (3, text(3, "near")), (None, text(4)), (5, text(5)), (5, text(6)), (None, text(7)), (6, ""),
    ], key=repr)
    assert kept.columns == COLUMNS


@pytest.mark.parametrize("step, opened", [(1, False), (1, True), (1000, True)])
def test_windows_reach_over_blocks(spark, step, opened):
    turns = [("system" if opened and i == 0 else ("user", "assistant")[i % 2], f"turn {i} " + "w " * (i * 7 % 60)) for i in range(800)]
    rows = [(1, step * i, *turn) for i, turn in enumerate(turns)] + [(2, 0, "user", "a"), (None, 5, "assistant", "b")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    tokens = np.array([words(text) + MARKS for _, text in turns])
    expected = []
    for back, begin, end in spans(tokens, int(tokens[0]) if opened else 0, 512, 2, 128):
        repeated = ([turns[0]] if opened and begin else []) + turns[max(back, int(opened)) : begin]
        before = "".join(render(*turn)[0] for turn in repeated)
        expected.append((before + "".join(render(*turn)[0] for turn in turns[begin:end]), len(before)))
    got = sorted(chat_windows(frame).where("conv_id = 1").collect(), key=lambda r: (r["block"], r["window"]))
    assert [(r["text"], r["new_from"]) for r in got] == expected
