import hashlib
import itertools
import random
import re
import zlib

import pytest

from cartcast.llm import dialogue
from cartcast.llm.common import table

COST = {"K": 0, "R": 1, "D": 2, "I": 5}
WHOLE = re.compile(r"(s?(ua)+)?")
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def plain_damage(rows):
    """The contract's damage, row by row."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def in_order(rows):
    def key(r):
        _, turn, role, text = r
        return turn is not None, turn or 0, role[:1].encode(), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
    return sorted(rows, key=key)


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen
                   else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def by_table(rows, marks):
    """Cheapest (cost, audit) and repaired rows by plain relaxation: for every
    row and automaton state the least of all edits, inserts repeated until
    nothing changes. Independent of the agenda."""
    step = {"": "s u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def offer(to, state, value):
        if state not in to or value[:2] < to[state][:2]:
            to[state] = value
            return True
        return False

    def inserts(at):
        changed = True
        while changed:
            changed = False
            for state, (c, w, r) in list(at.items()):
                for new in step[state].split():
                    if new in "ua":
                        full = {"u": "user", "a": "assistant"}[new]
                        changed |= offer(at, new, (c + 5, w + "I", r + ((full, ""),)))
    inserts(best)
    for (_, _, role, text), mark in zip(rows, marks):
        to = {}
        for state, (c, w, r) in best.items():
            offer(to, state, (c + 2, w + "D", r))
            if mark in ("blank", "duplicate"):
                continue
            extra = 5 if mark == "truncated" else 0
            for new in step[state].split():
                if new == role[:1]:
                    offer(to, new, (c + extra, w + "K", r + ((role, text),)))
                if new in "ua":
                    full = {"u": "user", "a": "assistant"}[new]
                    offer(to, new, (c + 1 + extra, w + "R", r + ((full, text),)))
        inserts(to)
        best = to
    return min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])


def expected(conv, rows):
    rows = in_order(rows)
    marks = faults(rows)
    cost, audit, repaired = by_table(rows, marks)
    numbered = [r[1] for r in rows if r[1] is not None]
    gaps = max(numbered) - min(numbered) + 1 - len(set(numbered)) if numbered else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    text = "\n".join(f"{r}:{t}" for r, t in repaired)
    return (conv, gaps, *[marks.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def all_expected(rows, damage=True):
    ids = {r[0] for r in rows}
    after = plain_damage(rows) if damage else rows
    return sorted((expected(c, [r for r in after if r[0] == c]) for c in ids), key=str)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "conv_id long, turn long, role string, text string, audit string, part int")


def every_audit(rows, most_inserts):
    """All edit sequences of a few rows, by enumeration."""
    choices = ["D" if r == "x" else "KRD" for r in rows]
    found = []
    for inserts in itertools.product(range(most_inserts + 1), repeat=len(rows) + 1):
        for edits in itertools.product(*choices):
            audit = "I" * inserts[0] + "".join(e + "I" * k for e, k in zip(edits, inserts[1:]))
            slots = []
            i = 0
            cost = 0
            for e in audit:
                cost += COST[e]
                if e == "I":
                    slots.append("ua")
                else:
                    row = rows[i]
                    i += 1
                    if e != "D":
                        cost += 5 if row.isupper() or row == "+" else 0
                        slots.append(row.lower() if e == "K" else "ua")
            if any(WHOLE.fullmatch("".join(x)) for x in itertools.product(*slots)):
                found.append((cost, audit))
    return min(found)


def test_agenda_equals_enumeration():
    rng = random.Random(4)
    for n in (0, 1, 2, 3, 4):
        for rows in {"".join(rng.choice("suaUAx-+S") for _ in range(n)) for _ in range(25)}:
            assert dialogue.lightest([dialogue.derive(rows)]) == every_audit(rows, 2 if n < 4 else 1), rows


def test_segments_combine_to_the_whole():
    rng = random.Random(9)
    for _ in range(150):
        rows = "".join(rng.choice("suauauaUAx-") for _ in range(rng.randrange(1, 30)))
        cuts = sorted(rng.sample(range(len(rows) + 1), min(3, len(rows))))
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        assert dialogue.lightest([dialogue.derive(p) for p in parts]) == dialogue.lightest([dialogue.derive(rows)])


def test_query_equals_plain_version(llm):
    rows = [tuple(r) for r in table(llm, "/root/testdata/sf0.01", "conversations")
            .select("conv_id", "turn", "role", "text").collect()]
    assert got(dialogue.op11_conversation_repair(llm, "/root/testdata/sf0.01")) == all_expected(rows)


@pytest.mark.parametrize("segment", [3, 4096])
def test_odd_rows(llm, monkeypatch, segment):
    monkeypatch.setattr(dialogue, "SEGMENT", segment)
    rng = random.Random(segment)
    roles, texts = ["user", "assistant", "system", "tool", "", None, " ", "usher"], \
        ["Hi.", "Yes", "", " \n", None, "What?", "No!\t", "...", "a. b", "x "]
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([None, 0, 1, 1, 2, 3, 7]), rng.choice(roles), rng.choice(texts))
            for _ in range(120)]
    rows += [(4, None, "user", "Hello."), (4, None, None, None), (5, 0, "user", "Q?")] + [(6, 1, "user", "Same.")] * 9
    rows += [(7, i, ["user", "assistant"][i % 2], f"Text {i}.") for i in range(60)]
    rows += [(8, 0, "user", "word " * 100_000 + "."), (8, 1, "assistant", "end.")]
    data = frame(llm, rows)
    ids = data.select("conv_id").distinct()
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert got(dialogue.repair_conversations(ids, dialogue.turns(data))) == all_expected(plain, damage=False)
    assert got(dialogue.repair_conversations(ids, dialogue.damaged(data))) == all_expected(rows)


def test_a_conversation_with_a_third_of_all_rows_is_cut(llm):
    n = 12_000
    rows = [(0, i, ["user", "assistant"][i % 2], f"Row {i // 2}.") for i in range(n)] \
        + [(1 + i % 4000, i // 4000, "user", "One.") for i in range(2 * n)]
    data = dialogue.turns(frame(llm, rows))
    cut = dialogue.segments(dialogue.marked(data)).groupBy("conv_id").count().where("conv_id = 0").collect()
    assert cut[0]["count"] >= n // dialogue.SEGMENT
    hot = {r["conv_id"]: r for r in dialogue.repair_conversations(data.select("conv_id").distinct(), data).collect()}
    assert (hot[0]["cost"], hot[0]["audit"], hot[0]["illegal"]) == (0, "K" * n, 0)
    assert (hot[1]["audit"], hot[1]["cost"], hot[1]["duplicate"]) == ("DDDDDD", 12, 5)


def test_repaired_turns_are_whole(llm):
    rows = [(1, 0, "assistant", "A."), (1, 1, "assistant", "B."), (2, 0, "user", " "), (3, 5, "user", "Q?"), (3, 6, "tool", "R.")]
    data = dialogue.turns(frame(llm, rows))
    ids = data.select("conv_id").distinct()
    out = dialogue.repaired_turns(ids, data).orderBy("conv_id", "position").collect()
    assert [(r["conv_id"], r["role"], r["text"]) for r in out] == \
        [(1, "user", "A."), (1, "assistant", "B."), (3, "user", "Q?"), (3, "assistant", "R.")]


def test_empty_table(llm):
    data = frame(llm, [(1, 0, "user", "x")]).limit(0)
    assert dialogue.repair_conversations(data.select("conv_id"), dialogue.damaged(data)).count() == 0
