"""Repairs against a search that keeps every path's whole edits, and against all edits of short conversations."""

import hashlib
import itertools
import random
import zlib

import pytest

from aerolens.llm.conversation_repair import Repair, repair_conversations, repair_report
from aerolens.llm.queries import op13_conversation_repair
from tests.llm.conftest import SF

SPACES = "\t\n\x0b\x0c\r "
STEPS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
NAMES = {"u": "user", "a": "assistant"}


def faults_of(rows):
    """``turn, role, text, fault`` of rows in order."""
    found, seen = [], set()
    for turn, role, text in rows:
        kept = text.strip(SPACES)
        fault = "blank" if not kept else "duplicate" if (role, text) in seen else None if kept[-1] in ".!?" else "truncated"
        seen.add((role, text))
        found.append((turn, role, text, fault))
    return found


def best_by_hand(rows):
    """Cost, letters and lines of the best repair: for each state the least (cost, letters) with all its lines."""
    best = {"": (0, "", ())}

    def with_inserts(best):
        for _ in range(3):
            for state, (cost, letters, lines) in list(best.items()):
                for (before, to), after in STEPS.items():
                    if before == state and to in NAMES:
                        new = (cost + 3, letters + "I", (*lines, f"{NAMES[to]}:"))
                        best[after] = min(best.get(after, new), new)
        return best

    best = with_inserts(best)
    for _, role, text, fault in rows:
        step = {}
        for state, (cost, letters, lines) in best.items():
            options = [(state, cost + 4, "D", lines)]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                for (before, to), after in STEPS.items():
                    if before == state and role[:1] == to:
                        options.append((after, cost + more, "K", (*lines, f"{role}:{text}")))
                    if before == state and to in NAMES:
                        options.append((after, cost + 3 + more, "R", (*lines, f"{NAMES[to]}:{text}")))
            for after, price, letter, kept in options:
                new = (price, letters + letter, kept)
                step[after] = min(step.get(after, new), new)
        best = with_inserts(step)
    return min(best[s] for s in ("", "a") if s in best)


def lines_of(edits):
    return tuple(f"{e.role}:{e.text}" for e in edits if e.letter != "D")


def searched(rows):
    search, edits, most = Repair(), [], 0
    for row in rows:
        edits += search.add(*row)
        most = max(most, search.open_edits())
    cost, rest = search.close()
    edits += rest
    return (cost, "".join(e.letter for e in edits), lines_of(edits)), most


def all_edits(rows, inserts):
    """Every legal repair of a short conversation with at most ``inserts`` inserted turns in a place."""
    found = []
    for letters in itertools.product("DKR", repeat=len(rows)):
        for gaps in itertools.product(range(inserts + 1), repeat=len(rows) + 1):
            cost, audit, state, fine = 3 * sum(gaps), "", "", True
            for k in range(len(rows) + 1):
                for _ in range(gaps[k]):
                    state = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
                    audit += "I"
                if k == len(rows):
                    break
                _, role, _, fault = rows[k]
                audit += letters[k]
                if letters[k] == "D":
                    cost += 4
                    continue
                if fault in ("blank", "duplicate"):
                    fine = False
                    break
                cost += 3 if fault else 0
                if letters[k] == "K":
                    if (state, role[:1]) not in STEPS:
                        fine = False
                        break
                    state = role[:1]
                else:
                    cost += 3
                    state = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
            if fine and state in ("", "a"):
                found.append((cost, audit))
    return min(found)


TEXTS = ["", " \t", "yes.", "no!", "cut off", "what? ", "and"]


def conversation(rng, size, roles=("user", "assistant", "system", "tool", "")):
    return faults_of([(i, rng.choice(roles), rng.choice(TEXTS) + str(rng.choice(["", i]))) for i in range(size)])


@pytest.mark.parametrize("seed", range(6))
def test_search_equals_whole_paths(seed):
    rng = random.Random(seed)
    for _ in range(1500):
        rows = conversation(rng, rng.randint(0, 14), rng.choice([("user", "assistant"), ("user",), ("user", "assistant", "system", "tool", "")]))
        assert searched(rows)[0] == best_by_hand(rows)


def test_whole_paths_equal_all_edits():
    rng = random.Random(9)
    for _ in range(150):
        rows = conversation(rng, rng.randint(0, 4))
        assert best_by_hand(rows)[:2] == all_edits(rows, 2)


def test_memory_stays_bounded():
    rng = random.Random(2)
    rows = faults_of([(i, rng.choice(["user", "assistant"]), f"{i}{rng.choice(['.', '.', ''])}") for i in range(20_000)])
    (cost, _, _), most = searched(rows)
    assert cost > 0 and most < 60


def test_an_open_question_is_kept_without_texts():
    rows = faults_of([(0, "system", "Be kind."), *((i, "user", " ") for i in range(1, 3000)), (3000, "user", "Hi."), (3001, "assistant", "Hi!")])
    got, _ = searched(rows)
    assert got == best_by_hand(rows) and got[1][0] == "K"
    rows = rows[:-2]
    assert searched(rows)[0] == best_by_hand(rows) and set(searched(rows)[0][1]) == {"D"}


SCHEMA = "conv_id bigint, turn bigint, role string, text string, fault string, place string, edit int"


def report_by_hand(rows):
    """The report of one conversation's rows ``turn, role, text``."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode()))
    judged = faults_of(rows)
    cost, audit, lines = best_by_hand(judged)
    turns = {r[0] for r in rows} - {None}
    initials = [r[1][:1] for r in rows]
    counts = [sum(r[3] == f for r in judged) for f in ("blank", "duplicate", "truncated")]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, *counts, illegal, cost, audit, digest


NAMES_OF_REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_report_on_edges(spark):
    rng = random.Random(4)
    given = []
    for conv in [None, *range(40)]:
        for i in range(rng.randint(1, 12)):
            turn = rng.choice([None, i, i, i, 3 * i])
            text = rng.choice([None, *TEXTS, f"{i}.", "long " * 20_000])
            given += [(conv, turn, rng.choice([None, "user", "assistant", "system"]), text)] * rng.choice([1, 1, 1, 2])
    docs = spark.createDataFrame([(*r, "x", "y", 1) for r in given], SCHEMA)
    got = {r["conv_id"]: tuple(r[n] for n in NAMES_OF_REPORT) for r in repair_report(docs).collect()}
    groups = {}
    for conv, turn, role, text in given:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    assert got == {conv: report_by_hand(rows) for conv, rows in groups.items()}


def test_edits_of_one_conversation(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Are you there"), (1, 2, "user", "Hi."), (1, 3, "assistant", "Yes.")]
    docs = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    found = sorted(repair_conversations(docs).collect(), key=lambda r: r["place"])
    assert [(r["edit"], r["turn"], r["fault"], r["role"], r["text"], r["cost"]) for r in found] == [
        ("K", 0, None, "user", "Hi.", 0), ("D", 1, "truncated", None, None, 4), ("D", 2, "duplicate", None, None, 4),
        ("K", 3, None, "assistant", "Yes.", 0),
    ]


def test_nothing(spark):
    assert repair_report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_shuffle(spark):
    docs = spark.createDataFrame([(1, 0, "user", "Hi.", "x", "y", 1)], SCHEMA)
    plan = repair_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


def test_long_conversation(spark):
    """One conversation with most rows passes in bounded pieces."""
    texts = "concat(id, case when id % 7 = 0 then '' else '.' end)"
    docs = spark.range(60_000).selectExpr(
        "id % 2 * (id % 6 div 4) as conv_id", "id as turn", "case when id % 3 = 0 then 'user' else 'assistant' end as role", f"{texts} as text"
    )
    rows = {}
    for r in docs.collect():
        rows.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"]))
    got = {r["conv_id"]: tuple(r[n] for n in NAMES_OF_REPORT) for r in repair_report(docs).collect()}
    for conv, given in rows.items():
        (cost, audit, lines), most = searched(faults_of(given))
        assert most < 100 and got[conv][5:7] == (cost, audit)
        assert got[conv][7] == hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_query(spark):
    given = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    groups = {r["conv_id"]: [] for r in given}
    for r in given:
        kind = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        role, text = "user" if kind == 4 else r["role"], r["text"]
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        groups[r["conv_id"]] += [(r["turn"], role, text)] * {0: 0, 3: 2}.get(kind, 1)
    got = {r["conv_id"]: tuple(r[n] for n in NAMES_OF_REPORT) for r in op13_conversation_repair(spark, SF).collect()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {conv: report_by_hand(rows) if rows else nothing for conv, rows in groups.items()}
