"""Repair of a conversation's structure by the cheapest edits, found by a Viterbi search that forgets as it goes.

A repaired conversation is empty, or an optional system turn and then pairs of a user's and an assistant's turn. After
each row the search has at most four survivors, the cheapest edits up to each state of that grammar. Their edits hang
in a tree with references counted: what no survivor needs is let go, what has one child is joined with it, and once all
survivors come from one node, the edits up to there are final and leave the tree. So a conversation of any
length passes through a task row by row, and only edits still open are held.

Survivors of equal cost are told apart by their edits as text. Of two with the same rows and cost neither text begins
with the other, as more inserts would cost more, so what is less now stays less whatever follows; only the parts behind
their last common node are compared.
"""

from __future__ import annotations

import hashlib
from itertools import chain
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from aerolens.llm.common import prepared

#: What edits cost. An undeleted row whose text is cut off costs ``TRUNCATED`` more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: nothing yet, a system turn, a user's turn, an assistant's turn. The first and the last may end a conversation.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
SPACE = r"\x20\x09-\x0D"
NEVER = 1 << 62


class Edit(NamedTuple):
    """One edit: its letter, the row's turn, role and fault, and the repaired role and text."""

    letter: str
    turn: int | None
    given: str | None
    fault: str | None
    role: str | None
    text: str | None


USER_INSERTED = Edit("I", None, None, None, "user", "")
ASSISTANT_INSERTED = Edit("I", None, None, None, "assistant", "")


class _Node:
    """Edits that follow those of ``parent``; ``children`` counts the nodes and survivors that need it."""

    __slots__ = ("parent", "edits", "children")

    def __init__(self, parent: _Node | None, edits: list[Edit]):
        self.parent, self.edits, self.children = parent, edits, 1


def _path(node: _Node) -> list[_Node]:
    """The nodes from the root to this one."""
    found = []
    while node is not None:
        found.append(node)
        node = node.parent
    return found[::-1]


def _less(left: tuple[_Node, list[Edit]], right: tuple[_Node, list[Edit]]) -> bool:
    """Whether the edits of one survivor and what is added come before those of another as text."""
    xs, ys = _path(left[0]), _path(right[0])
    same = 0
    while same < min(len(xs), len(ys)) and xs[same] is ys[same]:
        same += 1
    x = chain(*(n.edits for n in xs[same:]), left[1])
    y = chain(*(n.edits for n in ys[same:]), right[1])
    for a, b in zip(x, y):
        if a.letter != b.letter:
            return a.letter < b.letter
    return False


class Repair:
    """The search over one conversation: ``add`` its rows, then ``close``; both return the edits that became final."""

    def __init__(self):
        self.root = _Node(None, [])
        #: Cost and tip of the survivor of each state.
        self.cost = [0, NEVER, NEVER, NEVER]
        self.tip: list[_Node | None] = [self.root, None, None, None]
        self._move([(0, NOTHING, []), None, None, None])

    def _better(self, new: tuple | None, old: tuple | None) -> tuple | None:
        if new is None or old is None:
            return new or old
        if new[0] != old[0]:
            return new if new[0] < old[0] else old
        return new if _less((self.tip[new[1]], new[2]), (self.tip[old[1]], old[2])) else old

    def _then(self, found: tuple | None, edit: Edit, cost: int) -> tuple | None:
        return found and (found[0] + cost, found[1], [*found[2], edit])

    def _move(self, found: list[tuple | None]) -> None:
        """Go on to the survivors ``cost, state before, edits`` of each state, with turns inserted where that is cheaper."""
        better, then = self._better, self._then
        for state in (NOTHING, SYSTEM, ASSISTANT):
            found[USER] = better(then(found[state], USER_INSERTED, INSERT), found[USER])
        found[ASSISTANT] = better(then(found[USER], ASSISTANT_INSERTED, INSERT), found[ASSISTANT])
        last = found[ASSISTANT]
        # Whatever may follow a system turn may follow an assistant's; before any turn, a system turn is kept at best.
        if found[SYSTEM] is not None and better(last, found[SYSTEM]) is last:
            found[SYSTEM] = None
        if found[NOTHING] is not None and found[NOTHING][0] > last[0] + DELETE:
            found[NOTHING] = None

        uses = [0] * 4
        for survivor in found:
            if survivor is not None:
                uses[survivor[1]] += 1
        for state, tip in enumerate(self.tip):
            if tip is not None and uses[state] != 1:
                tip.children = uses[state]
                while not tip.children and tip.parent is not None:
                    tip = tip.parent
                    tip.children -= 1
        tips: list[_Node | None] = [None] * 4
        for state, survivor in enumerate(found):
            if survivor is not None:
                tip = self.tip[survivor[1]]
                if uses[survivor[1]] == 1:
                    tip.edits.extend(survivor[2])
                else:
                    tip = _Node(tip, survivor[2])
                tips[state] = tip
        self.cost, self.tip = [NEVER if s is None else s[0] for s in found], tips
        for tip in tips:
            if tip is not None:
                self._join(tip)

    def _join(self, node: _Node) -> None:
        """Join the nodes above that have one child with that child."""
        while (above := node.parent) is not None:
            if above.children == 1 and above is not self.root:
                above.edits.extend(node.edits)
                node.edits, node.parent = above.edits, above.parent
            else:
                node = above

    def _final(self) -> list[Edit]:
        root, found = self.root, self.root.edits
        root.edits = []
        if root.children == 1:
            node = next(t for t in self.tip if t is not None)
            if node is not root:
                while node.parent is not root:
                    node = node.parent
                found = found + node.edits
                node.edits, node.parent, self.root = [], None, node
        return found

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> list[Edit]:
        cost = self.cost
        gone = Edit("D", turn, role, fault, None, None)
        found: list[tuple | None] = [
            (cost[state] + DELETE, state, [gone]) if cost[state] < NEVER else None for state in range(4)
        ]
        if fault is None or fault == "truncated":
            initial, more = role[:1], TRUNCATED if fault else 0
            as_user = [Edit("K", turn, role, fault, role, text) if initial == "u" else Edit("R", turn, role, fault, "user", text)]
            as_assistant = [
                Edit("K", turn, role, fault, role, text) if initial == "a" else Edit("R", turn, role, fault, "assistant", text)
            ]
            if initial == "s" and cost[NOTHING] < NEVER:
                kept = (cost[NOTHING] + more, NOTHING, [Edit("K", turn, role, fault, role, text)])
                found[SYSTEM] = self._better(kept, found[SYSTEM])
            for state in (NOTHING, SYSTEM, ASSISTANT):
                if cost[state] < NEVER:
                    new = (cost[state] + more + (0 if initial == "u" else REROLE), state, as_user)
                    found[USER] = self._better(new, found[USER])
            if cost[USER] < NEVER:
                new = (cost[USER] + more + (0 if initial == "a" else REROLE), USER, as_assistant)
                found[ASSISTANT] = self._better(new, found[ASSISTANT])
        self._move(found)
        return self._final()

    def open_edits(self) -> int:
        """Edits held in the tree."""
        nodes = {id(n): n for tip in self.tip if tip is not None for n in _path(tip)}
        return sum(len(n.edits) for n in nodes.values())

    def close(self) -> tuple[int, list[Edit]]:
        """The cost of all edits, and those not handed on yet."""
        ends = [(self.cost[s], s, []) if self.tip[s] is not None else None for s in (NOTHING, ASSISTANT)]
        best = self._better(*ends)
        return best[0], list(chain(*(n.edits for n in _path(self.tip[best[1]]))))


EDITS = (
    "place bigint, edit string, turn bigint, given_role string, fault string, role string, text string, cost bigint"
)


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """The cheapest edits that give each conversation the roles of ``(s?(ua)+)?``, by their initials.

    Rows ``conv_id, turn, role, text`` are taken by turn, nulls first, then by role and text. A row's first fault counts:
    ``blank`` (no character but ASCII white space), ``duplicate`` (role and text were seen earlier in the conversation) or
    ``truncated`` (the last such character is none of ``.!?``). Blank and duplicate rows are deleted.

    Returns one row per edit: ``conv_id``, ``place`` in the conversation, ``edit`` (``K`` keep, ``R`` rerole, ``D`` delete,
    ``I`` insert an empty turn), the row's ``turn``, ``given_role`` and ``fault`` (null for inserted turns), the repaired ``role``
    and ``text`` (null for deleted rows) and ``cost``. Of edits of equal cost the least letters in order win.

    One shuffle brings a conversation together and sorts it; rows then pass one by one, and what is held is the edits
    still open and the strings they keep. Rows of a conversation are in order in the result's partitions.

    A null role or text is one blank, a null ``conv_id`` one conversation. Rows given several times are duplicates.
    An empty table gives an empty result; other columns are left out.
    """
    spark = prepared(conversations.sparkSession)
    rows = conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text"))
    )
    text = F.col("text")
    seen = Window.partitionBy("conv_id", "role", F.xxhash64("text"), F.xxhash64(F.lit(1), "text")).orderBy("turn")
    fault = (
        F.when(~text.rlike(f"[^{SPACE}]"), "blank").when(F.row_number().over(seen) > 1, "duplicate")
        .when(~text.rlike(rf"[.!?][{SPACE}]*\z"), "truncated")
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = conversations.schema["conv_id"].dataType.simpleString()
    # The window's groups lie inside those of the shuffle, so it takes none of its own.
    dealt = rows.repartition(parts, "conv_id").withColumn("fault", fault).sortWithinPartitions("conv_id", "turn", "role", "text")
    names = ["conv_id", *(part.split()[0] for part in EDITS.split(", "))]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]
    prices = {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}

    def work(arrived):
        current, search, place, out = None, None, 0, []

        def hand_on(edits):
            nonlocal place
            for edit in edits:
                price = prices[edit.letter] + (TRUNCATED if edit.fault == "truncated" and edit.letter != "D" else 0)
                out.append((current, place, *edit, price))
                place += 1

        def batch_of(key_type):
            columns = list(zip(*out)) or [[]] * len(names)
            made = [pa.array(c, k) for c, k in zip(columns, [key_type, *kinds])]
            out.clear()
            return pa.RecordBatch.from_arrays(made, names)

        key_type = None
        for batch in arrived:
            key_type = batch.column(0).type
            for conv, turn, role, value, found in zip(*(c.to_pylist() for c in batch.columns)):
                if search is None or conv != current:
                    if search is not None:
                        hand_on(search.close()[1])
                    current, search, place = conv, Repair(), 0
                hand_on(search.add(turn, role, value, found))
            yield batch_of(key_type)
        if search is not None:
            hand_on(search.close()[1])
            yield batch_of(key_type)

    return dealt.mapInArrow(work, f"conv_id {kind}, {EDITS}")


SUMMARY = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
)


def repair_report(conversations: DataFrame) -> DataFrame:
    """One row per conversation: what was wrong with it, the edits' letters, and a digest of what it is now.

    ``gaps`` are turn numbers left out between the least and the greatest, ``blank``, ``duplicate`` and ``truncated`` count
    rows by fault, ``illegal`` the neighbours whose roles' initials are not ``su``, ``ua`` or ``au``, ``cost`` is that of all edits,
    ``audit`` their letters, ``repaired_sha256`` is over the repaired ``role:text`` with line feeds between.

    A digest needs a conversation's text in order, so the edits are read in the tasks that made them, as they come.
    """
    names = ["conv_id", *(part.split()[0] for part in SUMMARY.split(", "))]
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    legal = {"su", "ua", "au"}
    kind = conversations.schema["conv_id"].dataType.simpleString()

    def work(arrived):
        out, state, current, key_type = [], None, None, None

        class Summary:
            def __init__(self):
                self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
                self.least = self.turn = None
                self.turns = self.illegal = self.cost = 0
                self.before = self.digest = None
                self.letters: list[str] = []

            def row(self):
                gaps = self.turn - self.least + 1 - self.turns if self.turns else 0
                digest = (self.digest or hashlib.sha256()).hexdigest()
                return gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.letters), digest

            def add(self, letter, turn, given, fault, role, text, cost):
                self.letters.append(letter)
                self.cost += cost
                if letter != "I":
                    if turn is not None and turn != self.turn:
                        self.least = turn if self.least is None else self.least
                        self.turn = turn
                        self.turns += 1
                    if fault:
                        self.faults[fault] += 1
                    initial = given[:1]
                    if self.before is not None:
                        self.illegal += self.before + initial not in legal
                    self.before = initial
                if letter != "D":
                    line = f"{role}:{text}"
                    if self.digest is None:
                        self.digest = hashlib.sha256()
                    else:
                        line = "\n" + line
                    self.digest.update(line.encode("utf-8", "surrogatepass"))

        def batch_of():
            columns = list(zip(*out)) or [[]] * len(names)
            made = [pa.array(c, k) for c, k in zip(columns, [key_type, *kinds])]
            out.clear()
            return pa.RecordBatch.from_arrays(made, names)

        for batch in arrived:
            key_type = batch.column(0).type
            for conv, _, *edit in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or conv != current:
                    if state is not None:
                        out.append((current, *state.row()))
                    current, state = conv, Summary()
                state.add(*edit)
            yield batch_of()
        if state is not None:
            out.append((current, *state.row()))
            yield batch_of()

    return repair_conversations(conversations).mapInArrow(work, f"conv_id {kind}, {SUMMARY}")
