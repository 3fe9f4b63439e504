"""Line dedup and token counts against plain Python."""

from collections import defaultdict

from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from aerolens.llm.common import ASCII_SPACE, NULL_ID, WORD, fold_ascii
from aerolens.llm.line_dedup import line_dedup
from aerolens.llm.token_counts import counter, longest_prefix, public_path, token_prefixes, tokens_of_prefix
from tests.llm.conftest import EDGES, pairs


def lines_by_hand(rows, min_docs=2):
    holders = defaultdict(set)
    for key, text in rows:
        for line in (text or "").split("\n"):
            holders[fold_ascii(line.strip(ASCII_SPACE))].add(NULL_ID if key is None else key)
    out = []
    for key, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            folded = fold_ascii(line.strip(ASCII_SPACE))
            lost = len(folded) >= 10 and len(holders[folded]) >= min_docs
            if not lost or min(holders[folded]) == (NULL_ID if key is None else key):
                kept.append(line)
        out.append((key, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_line_dedup_on_edges(edges):
    for min_docs in (2, 3):
        got = line_dedup(edges, min_docs=min_docs, carry=("lang", "_id")).collect()
        assert sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got), key=repr) == lines_by_hand(
            [(e[0], e[1]) for e in EDGES], min_docs
        )
        assert {r["_id"] for r in got} == {"clash"}


def test_line_dedup_of_nothing(nothing):
    assert line_dedup(nothing).count() == 0


def encode(text):
    return len(Tokenizer.from_file(public_path()).encode(text, add_special_tokens=False).ids)


def test_tokens_equal_the_tokenizer(edges, small_docs):
    tokenizer = Tokenizer.from_file(public_path())
    for docs in (edges, small_docs):
        texts = [text or "" for _, text in pairs(docs)]
        expected = sorted(
            (len(t.encode()), len(e.ids)) for t, e in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False))
        )
        got = token_prefixes(docs, keep_prefixes=False).collect()
        assert sorted((r["n_bytes"], r["n_tokens"]) for r in got) == expected


def test_every_prefix_is_exact(spark, nothing):
    texts = [
        "don't you've we'll 'tis ''s !'s a'save", "hi<|endoftext|>wor<|endoftex ld<|startoftext|>!!",
        "Éte é ﬁ ÅÅ İstanbul ß 日本語 12345 \U0001F600x", "supercalifragilistic" * 5, "", None, " \n ",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = token_prefixes(docs).withColumns({"at_5": tokens_of_prefix(5), "fits_7": longest_prefix(7)}).collect()
    for row in got:
        table = row["prefix_tokens"]
        assert len(table) == len(row["normal_text"]) + 1 and table[-1] == row["n_tokens"]
        assert table == [encode(row["normal_text"][:i]) for i in range(len(table))]
        assert row["at_5"] == table[min(5, len(table) - 1)]
        assert row["fits_7"] == max(i for i, n in enumerate(table) if n <= 7)
    assert token_prefixes(nothing).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("abeinrstxyzABÉé'!?.-0123 ́ 日<|>"), max_size=40))
def test_any_text_counts_as_the_tokenizer_does(text):
    blocks = list(counter(public_path()).prefixes(text))
    assert (int(blocks[-1][-1]) if blocks else 0) == encode(text)
    assert WORD.findall(text) or not blocks
