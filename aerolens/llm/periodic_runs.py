"""Periodic runs of words, found by an online sparse dynamic program over lags.

Each word's earlier occurrences name the lags at which the text repeats there. The length of the match at a lag is one
more than it was at the word before, and lags that do not match have no entry. When a lag drops out, its match is
complete, and a run is handed on at once if it is long enough. What counts as a word here is the 16 words that begin at
a place: a run of 24 words and three periods matches itself over 16 words at least, and such passages seldom recur by
chance. A lag is taken up where its match begins, and only if the passages also match as far on as a run needs. Inside a
run already found, lags of more than its period are not looked at before its last period.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from aerolens.llm.common import WORD, prepared

#: A run has so many words, and so many periods, at least.
LEAST_WORDS, LEAST_PERIODS = 24, 3
Change = Callable[[object, list[str]], list[str]]


def gram_size(least_words: int, least_periods: int) -> int:
    """Words over which every run matches itself: the least of ``length - period`` over all periods."""
    return min(max(least_words - q, (least_periods - 1) * q) for q in range(1, least_words + 1))


def passages(words: np.ndarray, size: int) -> np.ndarray:
    """A number for each passage of ``size`` words, equal for equal passages, by doubling."""
    ranks, span = words, 1
    while span < size:
        step = min(span, size - span)
        pairs = ranks[:-step].astype(np.int64) * (int(ranks.max()) + 1) + ranks[step:]
        ranks, span = np.unique(pairs, return_inverse=True)[1], span + step
    return ranks


def _is_power(root: np.ndarray) -> bool:
    """Whether a sequence is a shorter one several times over."""
    size = len(root)
    return any(size % p == 0 and np.array_equal(root[p:], root[:-p]) for p in range(1, size // 2 + 1))


def _reach(ranks: np.ndarray, place: int, lag: int) -> int:
    """The last place up to which passages match those ``lag`` before them, from a matching ``place`` on."""
    begin, step = place + 1, 64
    while begin < len(ranks):
        end = min(begin + step, len(ranks))
        other = np.flatnonzero(ranks[begin:end] != ranks[begin - lag : end - lag])
        if len(other):
            return begin + int(other[0]) - 1
        begin, step = end, step * 2
    return len(ranks) - 1


class _Earlier:
    """Earlier places of the passage at a place, but for those that the same passage comes before.

    A match at a lag begins where the passages before it differ; where they do not, it began before.
    """

    def __init__(self, grams: np.ndarray):
        previous = np.concatenate([[-1], grams[:-1]])
        self.order = np.lexsort((previous, grams))  # places rise within equals
        kinds = grams * (len(grams) + 1) + previous + 1
        in_order, kinds_in_order = grams[self.order], kinds[self.order]
        self.low, self.high = (np.searchsorted(in_order, grams, side).tolist() for side in ("left", "right"))
        self.same, self.end = (np.searchsorted(kinds_in_order, kinds, side).tolist() for side in ("left", "right"))

    def any(self, place: int) -> bool:
        return self.end[place] - self.same[place] < self.high[place] - self.low[place]

    def of(self, place: int) -> np.ndarray:
        order = self.order
        found = np.concatenate([order[self.low[place] : self.same[place]], order[self.end[place] : self.high[place]]])
        return found[found < place]


def find_runs(words: list[str], least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """``start, length, period`` of all runs, by start and period.

    A run is a stretch with smallest period ``period`` that no neighbouring word extends, of ``least_words`` words and
    ``least_periods`` (two or more) periods at least.
    """
    size = gram_size(least_words, least_periods)
    if len(words) < least_words:
        return []
    known: dict[str, int] = {}
    text = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    ranks = passages(text, size)
    times = np.bincount(ranks)
    if times.max() < 2:
        return []
    earlier, grams, runs = _Earlier(ranks), ranks.tolist(), []

    def end(lag: int, begin: int, last: int) -> None:
        """Hand on the run of a match of passages from ``begin`` to ``last`` at ``lag``."""
        start, length = begin - lag, last - begin + size + lag
        if length >= max(least_words, least_periods * lag) and not _is_power(text[start : start + lag]):
            runs.append((start, length, lag))

    active: dict[int, int] = {}  # lag: first place of its match
    inside = quiet = 0  # the least period of the runs that the last place is in, and up to where its lag is enough
    before = -1
    for place in np.flatnonzero((times > 1)[ranks]).tolist():
        if place != before + 1:
            for lag, begin in active.items():
                end(lag, begin, before)
            active, inside = {}, 0
        before, gram, now = place, grams[place], {}
        for lag, begin in active.items():
            if grams[place - lag] == gram:
                now[lag] = begin
            else:
                end(lag, begin, place - 1)
        if inside not in now:
            inside = 0
        if earlier.any(place):
            found = earlier.of(place)
            if inside and place <= quiet:
                # A run of another period that begins in this one shares less than both periods with it.
                found = found[(found < now[inside] - inside) | (found > place - inside)]
            lags = place - found
            # Where the match would have to reach.
            far = place + np.maximum(least_words - lags, (least_periods - 1) * lags) - size
            lags, far = lags[far < len(ranks)], far[far < len(ranks)]
            for lag in lags[ranks[far] == ranks[far - lags]].tolist():
                now.setdefault(lag, place)
        active = now
        if not inside and active:
            inside = min(
                (lag for lag, begin in active.items() if place - begin + size + lag >= max(least_words, least_periods * lag)),
                default=0,
            )
            quiet = _reach(ranks, place, inside) + size - inside if inside else 0
    for lag, begin in active.items():
        end(lag, begin, before)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words that no run holds beyond its first period."""
    kept = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def periodic_runs(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", least_words: int = LEAST_WORDS,
    least_periods: int = LEAST_PERIODS, change: Change | None = None,
) -> DataFrame:
    """Periodic runs of each text, and the text without what they repeat.

    Returns per row the id, ``n_words``, ``runs`` (``start, length, period`` in words from 0, by start and period) and
    ``collapsed``: the words that no run holds after its first period, with one blank between them. Words are runs of
    what is not ASCII white space. ``change`` may replace the words of a row first, given its id and words.

    Map only: rows are independent, so repeated rows and ids give equal rows each, and no key can be hot. A task holds
    one batch of texts and works on one text at a time, with a few whole numbers for each of its words.

    A null or empty text has no words and no runs. A null id is handed on. An empty table gives an empty result.
    """
    prepared(docs.sparkSession)
    kind = dict(docs.dtypes)[id_column]
    names = [id_column, "n_words", "runs", "collapsed"]
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    fields = ("start", "length", "period")

    def work(arrived):
        for batch in arrived:
            counts, found, texts = [], [], []
            for key, value in zip(batch.column(0), batch.column(1)):
                words = WORD.findall(value.as_py() or "")
                if change is not None:
                    words = change(key.as_py(), words)
                runs = find_runs(words, least_words, least_periods)
                counts.append(len(words))
                found.append([dict(zip(fields, r)) for r in runs])
                texts.append(" ".join(collapse(words, runs)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(found, pa.list_(run)), pa.array(texts, pa.string())], names
            )

    return docs.select(id_column, text_column).mapInArrow(
        work, f"`{id_column}` {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    )
