"""Token counts at every prefix of a text, by dynamic programming over BPE merges."""

from __future__ import annotations

import gc
import json
import re
from array import array
from contextlib import contextmanager
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from tokenizers import Regex, Tokenizer, pre_tokenizers

from aerolens.llm.common import WORD, prepared

#: Words whose prefix counts one Python worker remembers, twice; then the older half is let go.
REMEMBERED_WORDS = 350_000
REMEMBERED_PREFIXES = 800_000
REMEMBERED_PAIRS = 1_000_000
NEVER = 1 << 60
#: Before a word: no token and no counts, and no suffix that begins a token.
START = ([0], [0], [0], 0)
NO_TOKENS = ([], [])
#: Longer words are counted without remembering them or their prefixes.
REMEMBERED_LENGTH = 40
#: Words of a text that are put together at once.
WORDS_AT_ONCE = 1 << 16
#: The tokenizer's pattern of pre-tokens, and what it means for lower-case ASCII text (fixed values).
CLIP_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x20\x09-\x0Da-z0-9]+")
#: The same for words of ASCII and the accented letters of Latin-1, which are composed and whose small letters are here too.
LATIN_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-`{-~]+")
LATIN_WORD = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")


def public_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PrefixCounter:
    """Counts tokens of word prefixes for a BPE with byte-level symbols and an end-of-word suffix.

    Two tokens are neighbours in some encoding exactly if encoding their joined symbols gives the two
    again. So the last token of a prefix is the one token that ends there and may follow the last token
    of what is before it, and its count is one more than the count there. A prefix that ends its word takes
    a token with the end-of-word suffix instead; both tables come from one pass over the word.
    """

    def __init__(self, path: str):
        spec = json.loads(open(path, encoding="utf-8").read())
        model, splitter = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        self.end = model["end_of_word_suffix"]
        self.rank = {tuple(pair): i for i, pair in enumerate(model["merges"])}
        self.vocabulary = model["vocab"]
        self.ending = {token[: -len(self.end)] for token in self.vocabulary if token.endswith(self.end)}
        self.inside = {token for token in self.vocabulary if not token.endswith(self.end)}
        self.normalizer = Tokenizer.from_file(path).normalizer
        self.pattern = splitter["pattern"]["Regex"]
        self.split = pre_tokenizers.Split(Regex(self.pattern), "removed", invert=True)
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.special = [token["content"] for token in spec["added_tokens"]]
        self.symbols: dict[str, str] = {}
        # A prefix of tokens, and the tokens that are its suffixes, longest first; filled when first met.
        bodies = (*self.inside, *self.ending)
        self.chains: dict[str, tuple[list, list] | None] = {b[:i]: None for b in bodies for i in range(1, len(b) + 1)}
        self.tokens = ["", *self.vocabulary]
        self.number = {token: i for i, token in enumerate(self.tokens)}
        # By token, the tokens before it that were met and whether it may follow them.
        self.neighbours: dict[int, dict[int, bool]] = {}
        self.pairs = 0
        self.spines: dict[str, tuple[list, list] | None] = {}
        # A prefix has the lists of the word it was first met in, and the length of its longest suffix that begins a token.
        self.states: dict[str, tuple[list[int], list[int], list[int], int]] = {}
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _tree(self, token: str):
        """How BPE builds a token: nested ``(text, rank, left, right)``; ``None`` if it would not build it."""
        if token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            nodes = [(c, -1, None, None) for c in (*body[:-1], body[-1] + self.end)]
        else:
            nodes = [(c, -1, None, None) for c in token]
        while len(nodes) > 1:
            ranks = [self.rank.get((x[0], y[0]), NEVER) for x, y in zip(nodes, nodes[1:])]
            rank = min(ranks)
            if rank == NEVER:
                return None
            at = ranks.index(rank)
            left, right = nodes[at : at + 2]
            nodes[at : at + 2] = [(left[0] + right[0], rank, left, right)]
        return nodes[0]

    def _edges(self, token: str) -> tuple[list, list] | None:
        """The token's first and last symbol over time: ``(text, rank that makes it, rank that ends it)``."""
        if token not in self.spines:
            tree = self._tree(token)
            sides = []
            for side in (2, 3) if tree else ():
                node, ends, spine = tree, NEVER, []
                while node:
                    spine.append((node[0], node[1], ends))
                    node, ends = node[side], node[1]
                sides.append(spine)
            self.spines[token] = tuple(sides) if tree else None
        return self.spines[token]

    def _follows(self, previous: int, number: int) -> bool:
        """Whether a token may follow another, by their numbers; number 0 is the start of the word.

        It may not if some merge joins a last symbol of ``before`` with a first symbol of ``token`` while
        both are there. Of equal merges the left one comes first.
        """
        before, token = self.tokens[previous], self.tokens[number]
        known, follower = True, self._edges(token)
        if follower is None:
            known = False
        elif before:
            rank = self.rank.get
            for x, made_x, ends_x in self._edges(before)[1]:
                for y, made_y, ends_y in follower[0]:
                    r = rank((x, y))
                    if r is not None:
                        r = max(r, made_x, made_y)
                        if r < ends_x and r <= ends_y:
                            known = False
        if self.pairs >= REMEMBERED_PAIRS:
            # The chains go on using the same tables.
            for met in self.neighbours.values():
                met.clear()
            self.pairs = 0
        self.neighbours[number][previous] = known
        self.pairs += 1
        return known

    def _chain(self, node: str) -> tuple[list, list]:
        """Lengths, numbers and neighbours of the tokens that end ``node`` and go on, and of those that end a word with it."""
        suffixes = [node[i:] for i in range(len(node))]

        def entry(body: str, token: str) -> tuple[int, int, dict[int, bool]]:
            number = self.number[token]
            return len(body), number, self.neighbours.setdefault(number, {})

        found = self.chains[node] = (
            [entry(t, t) for t in suffixes if t in self.inside],
            [entry(t, t + self.end) for t in suffixes if t in self.ending],
        )
        return found

    def piece(self, text: str) -> list[int]:
        """Token counts of all prefixes of one pre-token, each taken as a whole word."""
        if text.isascii() and text.isprintable():
            return self._counts(text, None)[1:]
        mapped = [self._symbol(character) for character in text]
        ends = list(accumulate(map(len, mapped)))
        counts = self._counts("".join(mapped), set(ends))
        return [counts[i] for i in ends]

    def _counts(self, symbols: str, ends: set[int] | None) -> list[int]:
        """Counts after each number of symbols where a word can end, at ``ends`` or everywhere; what is between has none.

        Step by step: the last token and the count where the word goes on, and the count where it ends. The longest
        suffix that begins a token is at most one symbol longer than the one before.
        """
        states, chains, size = self.states, self.chains, len(symbols)
        short = size <= REMEMBERED_LENGTH
        known, found = 0, None
        if short:
            if len(states) >= REMEMBERED_PREFIXES:
                states.clear()
            # With a prefix all shorter ones are remembered.
            known, found = size, states.get(symbols)
            while known and found is None:
                known -= 1
                found = states.get(symbols[:known])
        last, inner, outer, width = found or START
        if known == size:
            return outer[: size + 1]
        last, inner, outer = last[: known + 1], inner[: known + 1], outer[: known + 1]
        for stop in range(known + 1, size + 1):
            width += 1
            node = symbols[stop - width : stop]
            chain = chains.get(node, NO_TOKENS)
            while chain is NO_TOKENS and width > 1:
                width -= 1
                node = node[1:]
                chain = chains.get(node, NO_TOKENS)
            inside, ending = chain or self._chain(node)
            for length, token, met in inside:
                before = last[stop - length]
                follows = met.get(before)
                if follows or follows is None and self._follows(before, token):
                    last.append(token)
                    inner.append(inner[stop - length] + 1)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
            if ends is None or stop in ends:
                for length, token, met in ending:
                    before = last[stop - length]
                    follows = met.get(before)
                    if follows or follows is None and self._follows(before, token):
                        outer.append(inner[stop - length] + 1)
                        break
                else:
                    raise ValueError("the vocabulary lacks a byte")
            else:
                outer.append(0)
            if short:
                states[symbols[:stop]] = last, inner, outer, width
        return outer

    def _symbol(self, character: str) -> str:
        symbol = self.symbols.get(character)
        if symbol is None:
            symbol = self.symbols[character] = self.bytes.pre_tokenize_str(character)[0][0]
        return symbol

    def plain(self, text: str) -> list[int]:
        """Counts of all prefixes of normalised text without special strings."""
        if text.isascii() and text.isalpha():
            return self.piece(text)
        found: list[int] = []
        total = 0
        known = self._pattern_of(text)
        if known and " " not in text:
            # The pieces are the whole text.
            pieces = [(piece, 0) for piece in known.findall(text)]
        elif known:
            pieces = [(m.group(), m.start()) for m in known.finditer(text)]
        else:
            pieces = [(piece, start) for piece, (start, _) in self.split.pre_tokenize_str(text)]
        for piece, start in pieces:
            if start > len(found):
                found += [total] * (start - len(found))  # white space
            counts = self.piece(piece)
            if piece[0] == "'" and piece[1:].isalpha():
                # A contraction cut short is an apostrophe and letters.
                inner = self.piece(piece[1:])
                counts = [counts[0], *(counts[0] + n for n in inner[:-1]), counts[-1]]
                if len(piece) > 2:
                    counts[1] = counts[0] + inner[0]
            found += [total + n for n in counts] if total else counts
            total = found[-1]
        return found + [total] * (len(text) - len(found))

    def _pattern_of(self, text: str) -> re.Pattern | None:
        """A pattern that means the same to Python for this normalised text; it is faster."""
        if self.pattern != CLIP_PATTERN:
            return None
        return ASCII_PIECE if text.isascii() else LATIN_PIECE if LATIN_WORD.fullmatch(text) else None

    def normal(self, word: str) -> str:
        """A word as the tokenizer sees it; special strings stay as they are."""
        return "".join(part if special else self.normalizer.normalize_str(part) for part, special in self._cut(word))

    def _cut(self, word: str):
        """The word in parts, special strings apart."""
        begin = 0
        while begin < len(word):
            hits = [(word.find(s, begin), s) for s in self.special]
            hits = [hit for hit in hits if hit[0] >= 0]
            if not hits:
                break
            at, special = min(hits)
            if at > begin:
                yield word[begin:at], False
            yield special, True
            begin = at + len(special)
        if begin < len(word):
            yield word[begin:], False

    def word(self, word: str) -> bytes:
        """32-bit counts of all prefixes of a normalised word, then once more that of the whole."""
        return self._of_bytes(word.encode())

    def _of_bytes(self, word: bytes) -> bytes:
        known = self.words.get(word)
        if known is not None:
            return known
        known = self.older.get(word) or self._word(word.decode())
        if len(word) <= REMEMBERED_LENGTH:
            if len(self.words) >= REMEMBERED_WORDS:
                self.older, self.words = self.words, {}
            self.words[word] = known
        return known

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            counts = self._counts(word.lower(), None)[1:]
            return array("i", [*counts, counts[-1]]).tobytes()
        counts: list[int] = []
        total, tail = 0, ""
        for part, special in self._cut(word):
            if special:
                # Until its last character a special string is ordinary text after what is before it.
                counts += [total + n for n in self.plain(tail + part)[len(tail) : -1]]
                counts.append(total + (self.plain(tail)[-1] if tail else 0) + 1)
                total, tail = counts[-1], ""
            else:
                plain = part.isascii() or LATIN_WORD.fullmatch(part)
                tail = part.lower() if plain else self.normalizer.normalize_str(part)
                counts += [total + n for n in self.plain(tail)]
        counts.append(counts[-1] if counts else total)
        return array("i", counts).tobytes()

    def prefixes(self, text: str):
        """Blocks of the counts of all prefixes of the normalised text, words apart by one blank."""
        total, count = 0, self._of_bytes
        whole = text.encode().split()  # bytes are split at ASCII white space only
        for begin in range(0, len(whole), WORDS_AT_ONCE):
            words = whole[begin : begin + WORDS_AT_ONCE]
            known = self.words.get
            parts = [known(word) or count(word) for word in words]
            inside = np.frombuffer(b"".join(parts), dtype=np.int32)
            lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
            each = inside[np.cumsum(lengths) - 1].astype(np.int64)
            before = total + np.cumsum(each) - each
            block = inside + np.repeat(before, lengths)
            total = int(block[-1])
            yield block


@contextmanager
def without_collector():
    """What is remembered has no cycles, but the collector would go through all of it again and again."""
    enabled = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if enabled:
            gc.enable()


@cache
def counter(path: str) -> PrefixCounter:
    """One per Python worker."""
    return PrefixCounter(path)


def token_prefixes(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer_path: str | None = None,
    keep_prefixes: bool = True,
    budget: int | None = None,
) -> DataFrame:
    """Token counts of all prefixes of every text; one row per input row.

    A prefix is one of the normalised text: the words between ASCII white space, each normalised as the
    tokenizer does, joined by single blanks. ``prefix_tokens[i]`` is the exact number of tokens of its first
    ``i`` code points. Returns the id, ``n_bytes`` of the text, ``n_tokens`` (the last entry), with a ``budget``
    ``budget_chars`` (code points of the longest prefix of at most so many tokens) and, with ``keep_prefixes``,
    ``normal_text`` and ``prefix_tokens``. Without it the tables, which are larger than the texts, are read where
    they are made and not returned. Special strings inside texts are one token each.

    Null and empty texts have no token. Ids are only handed through, so null, repeated and tied ones
    make no difference. No row is shuffled.
    """
    prepared(docs.sparkSession)
    path = tokenizer_path or public_path()
    extra = {"budget_chars": "bigint"} if budget is not None else {}
    if keep_prefixes:
        extra |= {"normal_text": "string", "prefix_tokens": "array<int>"}
    kinds = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    columns = {"n_bytes": "bigint", "n_tokens": "bigint", **extra}

    def count(arrived):
        state = counter(path)
        for batch in arrived:
            ids, out = batch.column(0), {name: [] for name in columns}
            with without_collector():
                for value in batch.column(1):
                    text = value.as_py() or ""
                    out["n_bytes"].append(len(text.encode("utf-8")))
                    blocks, last, chars, fitting = [], 0, 0, 0
                    for block in state.prefixes(text):
                        if budget is not None:
                            # Counts may fall as a prefix grows, so the last one that fits counts.
                            fits = np.flatnonzero(block <= budget)
                            fitting = chars + int(fits[-1]) + 1 if len(fits) else fitting
                        last, chars = int(block[-1]), chars + len(block)
                        if keep_prefixes:
                            blocks.append(block)
                    out["n_tokens"].append(last)
                    if budget is not None:
                        out["budget_chars"].append(min(fitting, max(chars - 1, 0)))  # no blank at the end
                    if keep_prefixes:
                        table = np.concatenate([np.zeros(1, dtype=np.int64), *blocks]).astype(np.int32)
                        out["normal_text"].append(" ".join(map(state.normal, WORD.findall(text))))
                        out["prefix_tokens"].append(table[: len(table) - (len(table) > 1)])
            arrays = [ids, *(pa.array(out[name], kinds[kind]) for name, kind in columns.items())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", *columns])

    given = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    schema = ", ".join(f"{name} {kind}" for name, kind in {"id": "bigint", **columns}.items())
    return given.mapInArrow(count, schema).withColumnRenamed("id", id_column)


class WordCounter:
    """Counts tokens of whole texts: a text's count is the sum of its words', as in ``PrefixCounter``."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, int] = {}

    def _word(self, word: str) -> int:
        count = len(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(word) <= REMEMBERED_LENGTH:
            if len(self.known) >= REMEMBERED_WORDS:
                self.known.clear()
            self.known[word] = count
        return count

    def text(self, text: str) -> int:
        known, total = self.known.get, 0
        for match in WORD.finditer(text):
            word = match.group()
            count = known(word)
            total += self._word(word) if count is None else count
        return total


@cache
def word_counter(path: str) -> WordCounter:
    """One per Python worker."""
    return WordCounter(path)


def token_count(text: Column, tokenizer_path: str | None = None) -> Column:
    """``n_tokens`` of ``token_prefixes`` as a column, without the tables of prefixes."""
    path = tokenizer_path or public_path()

    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        counter = word_counter(path)
        return pa.array([counter.text(value.as_py() or "") for value in texts], pa.int64())

    return count(text)


def tokens_of_prefix(n_chars: Column | int) -> Column:
    """Tokens of the first ``n_chars`` code points; all of them if the text is shorter."""
    last = F.size("prefix_tokens") - 1
    return F.get("prefix_tokens", F.least(F.lit(n_chars) if isinstance(n_chars, int) else n_chars, last))


def longest_prefix(budget: int) -> Column:
    """Code points of the longest prefix of at most ``budget`` tokens. Counts may fall as a prefix grows."""
    fits = F.transform("prefix_tokens", lambda tokens, i: F.when(tokens <= budget, i))
    return F.array_max(fits)
