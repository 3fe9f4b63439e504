"""The place where a text reaches a budget of tokens, read from its table of prefixes."""

from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from aerolens.llm.queries import TOKEN_LIMIT, op2_token_counts
from aerolens.llm.token_counts import PrefixCounter, counter, longest_prefix, public_path, token_prefixes
from tests.llm.conftest import SF
from tests.llm.test_lines_tokens import encode


def test_budget_without_kept_prefixes(spark):
    texts = ["don't you've we'll 'tis", "hi<|endoftext|>wor<|endoftex ld", "supercalifragilistic" * 5, "a b", "", None, " \n ", "x" * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for budget in (0, 1, 7, 1000):
        kept = token_prefixes(docs).select("doc_id", "n_tokens", longest_prefix(budget).cast("bigint").alias("budget_chars"))
        got = token_prefixes(docs, keep_prefixes=False, budget=budget).select("doc_id", "n_tokens", "budget_chars")
        assert sorted(got.collect()) == sorted(kept.collect())


def test_query_tells_where_the_limit_is(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op2_token_counts(spark, str(SF)).collect()
    assert any(r["over_limit"] for r in rows) and not all(r["over_limit"] for r in rows)
    for row in rows:
        normal = " ".join(texts[row["doc_id"]].split())
        assert row["over_limit"] == (row["n_tokens"] > TOKEN_LIMIT)
        if row["over_limit"]:
            assert 0 < row["budget_chars"] < len(texts[row["doc_id"]])
        elif normal.isascii():
            assert row["budget_chars"] == len(normal)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aeinrstthlyoAé'.1", min_size=1, max_size=14), max_size=8))
def test_words_sharing_prefixes(words):
    # A counter that remembers other words counts as a new one.
    assert [counter(public_path()).word(w) for w in words] == [FRESH.word(w) for w in reversed(words)][::-1]
    assert sum(list(FRESH.prefixes(" ".join(words)))[0][-1:]) == encode(" ".join(words)) if words else True


FRESH = PrefixCounter(public_path())


LATIN = [chr(c) for c in [*range(0x21, 0x7F), *range(0xC0, 0x100)] if chr(c) not in "×÷"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from([*LATIN, *"aeénßÀ'1,."]), min_size=1, max_size=12), max_size=6))
def test_latin_words_count_as_the_tokenizer_does(words):
    def tokens(text):
        return len(TOKENIZER.encode(text, add_special_tokens=False).ids)

    text = "\t".join(words)
    assert [int(block[-1]) for block in SHORT.prefixes(text)] == ([tokens(text)] if words else [])
    for word in words:
        table = list(SHORT.prefixes(word))[0]
        assert [int(n) for n in table[:-1]] == [tokens(word[:i]) for i in range(1, len(word) + 1)]


TOKENIZER = Tokenizer.from_file(public_path())


class _Unused:
    def __getattr__(self, name):
        raise AssertionError("words of Latin-1 letters need no calls of the tokenizer")


#: Counts words of Latin-1 letters without the library's normalizer and splitter.
SHORT = PrefixCounter(public_path())
SHORT.normalizer = SHORT.split = _Unused()
