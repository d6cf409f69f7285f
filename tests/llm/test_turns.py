"""Repairs against every sequence of edits, and the whole query against plain Python."""

import itertools
import zlib
from hashlib import sha256

import pytest

from censusloom.llm import turns
from censusloom.llm.queries import op13_conversation_repair
from censusloom.llm.turns import Repair, damage, repair, repaired

COSTS = {"K": 0, "R": 1, "D": 2, "I": 5}


def legal(roles):
    initials = "".join(r[:1] or "?" for r in roles)
    rest = initials[1:] if initials.startswith("s") else initials
    return initials == "" or (rest != "" and len(rest) % 2 == 0 and rest == "ua" * (len(rest) // 2))


def every_repair(rows, most=2):
    """(cost, audit, lines) of all edits with so many inserts at most; rows: (role, text, must go, truncated)."""
    for inserts in range(most + 1):
        for letters in itertools.product("DKR", repeat=len(rows)):
            for spots in itertools.combinations_with_replacement(range(len(rows) + 1), inserts):
                audit = ""
                for k in range(len(rows) + 1):
                    audit += "I" * spots.count(k) + (letters[k] if k < len(rows) else "")
                free = sum(c in "RI" for c in audit)
                for picks in itertools.product(("user", "assistant"), repeat=free):
                    pick, rest, cost, lines, fine = iter(picks), iter(rows), 0, [], True
                    for c in audit:
                        cost += COSTS[c]
                        if c == "I":
                            lines.append((next(pick), ""))
                            continue
                        role, text, must, cut = next(rest)
                        if c == "D":
                            continue
                        fine, cost = fine and not must, cost + 5 * cut
                        lines.append((next(pick) if c == "R" else role, text))
                    if fine and legal([r for r, _ in lines]):
                        yield cost, audit, lines


def best(rows, most=2):
    cost, audit, lines = min(every_repair(rows, most), key=lambda x: x[:2])
    return cost, audit, "\n".join(f"{r}:{t}" for r, t in lines)


def fast(rows):
    r = Repair()
    for role, text, must, cut in rows:
        r.add(role, None if must else text, cut)
    cost, audit, digest = r.end()
    return cost, audit, digest


@pytest.mark.parametrize("block", [1, 2, 64])
def test_against_every_sequence_of_edits(monkeypatch, block):
    monkeypatch.setattr(turns, "BLOCK", block)
    kinds = [("user", "p.", False, False), ("assistant", "q.", False, False), ("system", "s.", False, False), ("tool", "t.", False, False)]
    kinds += [("user", "cut", False, True), ("assistant", "", True, False)]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            cost, audit, text = best(rows)
            assert fast(rows) == (cost, audit, sha256(text.encode()).hexdigest()), rows


def test_no_insert_is_cheap_enough_but_the_graph_has_them():
    graph = Repair()._inserted()
    assert set(graph) == {turns.START, turns.USER, turns.ASSISTANT}
    assert best([("user", "a.", False, False)], 3)[:2] == (2, "D")


def test_longer_rows_against_a_table_of_strings(monkeypatch):
    """The integers against (cost, letters) pairs compared as they are, on longer rows."""
    import random

    rng = random.Random(4)
    for block in (3, 64):
        monkeypatch.setattr(turns, "BLOCK", block)
        for _ in range(150):
            rows = [(rng.choice(["user", "assistant", "system", "", "tool"]), f"{k}.", rng.random() < 0.2, rng.random() < 0.3) for k in range(rng.randrange(12, 40))]
            assert fast(rows)[:2] == strings(rows)


def strings(rows):
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    now = {"": (0, "")}

    def widen(ways):
        for _ in range(2):
            for q, (c, s) in list(ways.items()):
                ways[after[q]] = min(ways.get(after[q], (9**9, "")), (c + 5, s + "I"))
        return ways

    for role, _, must, cut in rows:
        new = {}
        for q, (c, s) in widen(dict(now)).items():
            offers = [(q, c + 2, "D")]
            if not must:
                offers.append((after[q], c + 1 + 5 * cut, "R"))
                if role[:1] == after[q]:
                    offers.append((after[q], c + 5 * cut, "K"))
                if role[:1] == "s" and q == "":
                    offers.append(("s", c + 5 * cut, "K"))
            for to, cost, letter in offers:
                new[to] = min(new.get(to, (9**9, "")), (cost, s + letter))
        now = new
    return min(w for q, w in widen(dict(now)).items() if q in ("", "a"))


WHITE = " \t\n\x0b\x0c\r"


def plain(rows):
    """The contract in plain Python; rows (conv_id, turn, role, text)."""
    shown = lambda x: " " if x is None else x
    convs = {}
    for conv, turn, role, text in rows:
        own = convs.setdefault(conv, [])
        hit = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = "user" if hit == 4 else shown(role), "" if hit == 1 else shown(text)
        if hit == 2:
            text = "".join(c for c in text if c not in ".!?")
        own.extend([(turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1))
    out = []
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, counts, judged = set(), [0, 0, 0], []
        for _, role, text in own:
            blank, again, cut = text.strip(WHITE) == "", (role, text) in seen, text.rstrip(WHITE)[-1:] not in (".", "!", "?")
            seen.add((role, text))
            if blank or again or cut:
                counts[0 if blank else 1 if again else 2] += 1
            judged.append((role, text, blank or again, cut and not blank and not again))
        near = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:], strict=False)]
        known = [r[0] for r in own if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        cost, audit = strings(judged)
        lines, state, at = [], "", 0
        for c in audit:
            role, text = ("", "") if c == "I" else judged[at][:2]
            at += c != "I"
            if c != "D":
                role = {"u": "user", "a": "assistant"}[{"u": "a"}.get(state, "u")] if c in "RI" else role
                state = role[:1]
                lines.append(f"{role}:{text}")
        out.append((conv, gaps, *counts, sum(x not in ("su", "ua", "au") for x in near), cost, audit, sha256("\n".join(lines).encode()).hexdigest(), lines))
    return sorted(out, key=str)


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", True, 0) for r in rows], "conv_id long, turn long, role string, text string, audit string, seen boolean, copies int")
    want = plain(rows)
    reports = repair(damage(df))
    assert sorted((tuple(r) for r in reports.collect()), key=str) == [w[:-1] for w in want]
    lines = {}
    for r in sorted(repaired(damage(df), reports).collect(), key=lambda r: r.place):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert lines == {w[0]: w[-1] for w in want if w[-1]}


def test_hand_made_conversations(spark):
    rows = [(1, t, r, x) for t, (r, x) in enumerate([("system", "Be kind."), ("user", "Hi."), ("assistant", "Yes?"), ("user", "no end"), ("assistant", "Fine!\n ")])]
    rows += [(2, None, "user", "a."), (2, None, None, None), (2, 5, "assistant", "b."), (2, 9, "", "c."), (None, None, None, None), (None, 3, "user", " \t")]
    rows += [(3, 7, "user", "same."), (3, 7, "user", "same."), (3, 7, "user", "same."), (3, -2, "user", "same."), (4, 1, "user", "ends "), (4, 2, "Assistant", "x" * 200_000 + ".")]
    check(spark, rows)
    check(spark, [])


def test_hot_conversation(spark):
    roles, texts = ["user", "assistant", "system", "tool"], ["One.", "Two", "", "Three!", "Four?"]
    rows = [(11, k // 2, roles[k * 7 % 4], f"{texts[k % 5]} {k % 50}{'.' if k % 3 else ''}") for k in range(900)] + [(k, k, "user", "One.") for k in range(50)]
    check(spark, rows)


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in op13_conversation_repair(spark, sf_dir).collect()), key=str)
    assert got == [w[:-1] for w in plain(rows)]


def test_a_long_conversation_takes_time_in_proportion():
    import time

    spent = []
    for n in (3000, 12000):
        start, r = time.perf_counter(), Repair()
        for k in range(n):
            r.add(("user", "tool", "assistant")[k % 3], "text.", k % 7 == 0)
        r.end()
        spent.append(time.perf_counter() - start)
    assert spent[1] < 9 * spent[0]
