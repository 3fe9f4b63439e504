"""Chat formatting: windows of whole turns within a token budget, with a mask of what is to be learned."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from aerolens.llm.common import WORD, id_key, prepared
from aerolens.session import materialized

#: Turns whose windows are written together; windows and history reach over their ends.
BLOCK_TURNS = 256
#: Code points of a text by which turns of equal number and role are dealt out.
HEAD_CHARS = 64
#: Tokens of a turn's marks.
MARKS = 3
TURN = re.compile(r"### ([^:]*): ([^<]*)</turn>\n")
WINDOWS = (
    "conv_id bigint, block bigint, window bigint, text string, new_from bigint, starts array<bigint>, ends array<bigint>"
)


def escape(text: str) -> str:
    """A text without the characters that make up the template's marks; ``unescape`` gives it back."""
    return text.replace("\\", "\\\\").replace("#", "\\h").replace("<", "\\l").replace(":", "\\c")


def unescape(text: str) -> str:
    back = {"\\": "\\", "h": "#", "l": "<", "c": ":"}
    return re.sub(r"\\(.)", lambda m: back[m.group(1)], text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """One turn, and where its text begins and ends in it."""
    head, body = f"### {escape(role)}: ", escape(text)
    return f"{head}{body}</turn>\n", len(head), len(head) + len(body)


def words(text: str) -> int:
    return len(WORD.findall(text))


def spans(
    tokens: np.ndarray, fixed: int, budget: int, history: int, history_budget: int, begin: int = 0, whole: bool = True
) -> list[tuple[int, int, int]]:
    """``(first repeated, first new, end)`` of each window, from prefix sums of the turns' tokens.

    A window repeats up to ``history`` turns of at most ``history_budget`` tokens and goes on with as many new turns
    as fit beside them and ``fixed`` tokens; one new turn at least, so that a longer turn has a window alone.
    The first new turn is ``begin``. If more turns are to come, not ``whole``, a window that they may go on is left out.
    """
    total = np.concatenate([[0], np.cumsum(tokens)])
    found = []
    while begin < len(tokens):
        back = max(begin - history, int(np.searchsorted(total, total[begin] - history_budget)))
        room = budget - fixed - (total[begin] - total[back])
        end = int(np.searchsorted(total, total[begin] + room, side="right")) - 1
        if end <= begin:  # without history there may be room
            back = begin
            end = max(begin + 1, int(np.searchsorted(total, total[begin] + budget - fixed, side="right")) - 1)
        if end == len(tokens) and not whole:
            break
        found.append((back, begin, end))
        begin = end
    return found


def window(repeated: list[tuple[str, str]], new: list[tuple[str, str]]) -> tuple:
    """``text, new_from, starts, ends`` of one window."""
    parts, starts, ends = [render(role, text)[0] for role, text in repeated], [], []
    size = new_from = sum(map(len, parts))
    for role, text in new:
        turn, start, stop = render(role, text)
        if role == "assistant":
            starts.append(size + start)
            ends.append(size + stop)
        parts.append(turn)
        size += len(turn)
    return "".join(parts), new_from, starts, ends


def numbered(rows: DataFrame, count: Callable[[str], int]) -> DataFrame:
    """``conv, block, place, role, text, tokens``: the turns of each conversation numbered from 0, in blocks.

    Turns are dealt out by ranges of their order, so a long conversation is spread over tasks whatever its turn numbers
    are. Each range counts its own; only the first conversation of a range goes on from earlier ones.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def work(arrived):
        part, current, place = TaskContext.get().partitionId(), None, 0
        for batch in arrived:
            places, sizes = [], []
            for conv, text in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                place = place + 1 if conv == current else 0
                current = conv
                places.append(place)
                sizes.append(count(text) + MARKS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * len(places), pa.int64()), pa.array(places, pa.int64()),
                 batch.column(2), batch.column(3), pa.array(sizes, pa.int64())],
                ["conv", "part", "local", "role", "text", "tokens"],
            )

    order = ["conv", F.asc_nulls_first("turn"), "role"]
    dealt = rows.repartitionByRange(parts, *order, F.substring("text", 1, HEAD_CHARS)).sortWithinPartitions(*order, "text")
    turns = materialized(
        dealt.mapInArrow(work, "conv bigint, part bigint, local bigint, role string, text string, tokens bigint"), "turns"
    )
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = turns.groupBy("conv", "part").agg(F.count("*").alias("n"))
    later = sizes.select(F.col("conv").alias("_conv"), F.col("part").alias("_part"), F.sum("n").over(earlier).alias("before"))
    later = materialized(later.where("before > 0"), "later")
    # At most one row for each range.
    joined = turns.join(F.broadcast(later), (F.col("conv") == F.col("_conv")) & (F.col("part") == F.col("_part")), "left")
    place = F.col("local") + F.coalesce("before", F.lit(0))
    return joined.select(
        "conv", F.floor(place / BLOCK_TURNS).cast("bigint").alias("block"), place.alias("place"), "role", "text", "tokens"
    )


def planned(turns: DataFrame, budget: int, history: int, history_budget: int) -> DataFrame:
    """What each block's windows need: ``conv, source, to, low, high, plan``.

    The turns from ``low`` to before ``high`` of block ``source`` go to block ``to``, in which the windows begin. ``plan`` is
    1 if a system turn opens the conversation, else 0, then three places of each window; once for each block.
    Where a window begins follows from all before it, so a conversation's token counts pass through one task,
    ``BLOCK_TURNS`` numbers a row, of which it holds those of the open window; no text does.
    """
    lengths = turns.groupBy("conv", "block").agg(
        F.sort_array(F.collect_list(F.struct("place", "tokens"))).alias("counts"),
        F.max((F.col("place") == 0) & (F.col("role") == "system")).alias("opens"),
    ).select("conv", "block", F.transform("counts", lambda c: c["tokens"]).alias("tokens"), "opens")
    schema = "conv bigint, source bigint, to bigint, low bigint, high bigint, plan array<bigint>"
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())]

    def work(arrived):
        out: list[tuple] = []
        current, opens, fixed, base, begin, held, ready = None, 0, 0, 0, 0, np.zeros(0, np.int64), []

        def flush():
            if ready:
                block, low, high = ready[0][1] // BLOCK_TURNS, min(w[0] for w in ready), ready[-1][2]
                for source in range(low // BLOCK_TURNS, (high - 1) // BLOCK_TURNS + 1):
                    plan = [opens, *(place for w in ready for place in w)] if source == block else None
                    out.append((current, source, block, low, high, plan))
                if opens and low > 0:
                    out.append((current, 0, block, 0, 1, None))
                ready.clear()

        def advance(whole):
            nonlocal base, begin, held
            for places in spans(held, fixed, budget, history, history_budget, begin - base, whole):
                back, begin, end = (base + place for place in places)
                if ready and ready[0][1] // BLOCK_TURNS != begin // BLOCK_TURNS:
                    flush()
                ready.append((back, begin, end))
                begin = end
            keep = max(base, begin - history)
            held, base = held[keep - base :], keep

        def close():
            if current is not None:
                advance(True)
                flush()

        for batch in arrived:
            for conv, _, tokens, first in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != current:
                    close()
                    current, opens, fixed, base, begin, held = conv, int(first), tokens[0] if first else 0, 0, 0, held[:0]
                held = np.concatenate([held, np.array(tokens, np.int64)])
                advance(False)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 6, kinds)], names)
            out.clear()
        close()
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 6, kinds)], names)

    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lengths.repartition(parts, "conv").sortWithinPartitions("conv", "block").mapInArrow(work, schema)


def chat_windows(
    conversations: DataFrame,
    *,
    budget: int = 512,
    history: int = 2,
    history_budget: int = 128,
    count: Callable[[str], int] = words,
) -> DataFrame:
    """Format conversations as windows of whole turns of at most ``budget`` tokens.

    Turns are ordered by ``turn``, then role and text; a null turn comes first, null roles and texts are empty,
    rows given twice are two turns, and a null ``conv_id`` is one conversation. The first turn, if it is a
    ``system`` turn, is repeated in every window, and up to ``history`` turns before a window's new ones. Returns
    ``conv_id, block, window, text``, ``new_from`` (code points that only repeat) and ``starts, ends``: the code
    points to be learned, which are the texts of new ``assistant`` turns. So each turn is new, and each target is
    learned, in exactly one window. A longer turn than the budget has a window alone with the system turn.

    Only the order of turn numbers counts, not their gaps. A window belongs to the ``block`` of ``BLOCK_TURNS`` turns in which
    it begins, and is numbered there; it may end in a later block and repeat turns of an earlier one, which are
    handed to its block. So a very long conversation is spread over tasks, and a task holds the turns of one
    block's windows at a time.
    """
    spark = prepared(conversations.sparkSession)
    rows = conversations.select(
        id_key("conv_id").alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = numbered(rows, count)
    needs = materialized(planned(turns, budget, history, history_budget), "needs")
    wanted = needs.select(F.col("conv").alias("_conv"), "source", "to", "low", "high")
    given = turns.join(wanted, (F.col("conv") == F.col("_conv")) & (F.col("block") == F.col("source"))).where(
        "place >= low and place < high"
    ).select("conv", "to", "place", "role", "text", F.lit(None).cast("array<bigint>").alias("plan"))
    plans = needs.where("plan is not null").select("conv", "to", F.lit(-1).cast("bigint"), F.lit(""), F.lit(""), "plan")
    names = [part.split()[0] for part in WINDOWS.split(", ")]
    kinds = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def work(arrived):
        opens, todo, number, held = 0, [], 0, {}
        for batch in arrived:
            out: list[tuple] = []
            for conv, block, place, role, text, plan in zip(*(c.to_pylist() for c in batch.columns)):
                if plan is not None:
                    opens, number, held = plan[0], 0, {}
                    todo = list(zip(plan[1::3], plan[2::3], plan[3::3]))
                    continue
                held[place] = (role, text)
                if place == todo[number][2] - 1:
                    back, begin, end = todo[number]
                    repeated = [held[0]] if opens and begin else []
                    repeated += [held[i] for i in range(max(back, opens), begin)]
                    made = window(repeated, [held[i] for i in range(begin, end)])
                    out.append((None if conv == 2**63 - 1 else conv, block, number, *made))
                    number += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 7, kinds)], names)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = given.union(plans).repartition(parts, "conv", "to").sortWithinPartitions("conv", "to", "place")
    return dealt.mapInArrow(work, WINDOWS)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the windows say: per conversation the digest of its turns and of all that is to be learned.

    ``turns_sha256`` is over role, line feed, text, line feed of each new turn, ``loss_sha256`` over the unescaped texts
    under the mask; both are read from the formatted text alone. ``formatted_chars`` counts all windows.
    A digest needs a conversation's windows in order, so they pass through one task, one at a time.
    """
    spark = prepared(formatted.sparkSession)
    schema = (
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def work(arrived):
        current, state, out = object(), None, []

        def close():
            if state is not None:
                out.append((current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def emit():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 6, kinds)], names)

        for batch in arrived:
            for conv, _, _, text, new_from, starts, ends in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or conv != current:
                    close()
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in TURN.findall(text, new_from):
                    state[0] += 1
                    state[1].update(f"{unescape(role)}\n{unescape(body)}\n".encode("utf-8", "surrogatepass"))
                for start, end in zip(starts, ends):
                    learned = unescape(text[start:end])
                    state[2] += len(learned)
                    state[3].update(learned.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
            yield emit()
            out.clear()
        close()
        yield emit()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = formatted.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "block", "window")
    return dealt.mapInArrow(work, schema)
