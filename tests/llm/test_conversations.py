"""Repair of conversations: the automaton against all edits, the damage and digests against plain Python."""

import hashlib
import random
import zlib
from itertools import product

import pytest

from touchline.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string"
CLASH = ("gone", "digest", "plan", "kind", "signature", "audit")


def cheapest(signature):
    """Cost and least audit, of all ways to keep, rerole or delete every turn with up to two insertions at every place."""
    best = None
    for edits in product("KRD", repeat=len(signature)):
        for gaps in product(range(3), repeat=len(signature) + 1):
            audit = "I" * gaps[0] + "".join(e + "I" * g for e, g in zip(edits, gaps[1:]))
            left = len(audit) - audit.count("D")
            roles = "s" * (left % 2) + "ua" * (left // 2)
            if roles == "s":
                continue
            cost, place, row = 0, 0, 0
            for e in audit:
                symbol = signature[row] if e != "I" and row < len(signature) else ""
                row += e != "I"
                cost += {"K": 0, "R": 1, "D": 2, "I": 5}[e] + (5 if e in "KR" and symbol.isupper() else 0)
                if (e in "KR" and symbol == "d") or (e == "K" and symbol.lower() != roles[place]) or (e in "RI" and roles[place] == "s"):
                    break
                place += e != "D"
            else:
                best = min(best, (cost, audit)) if best else (cost, audit)
    return best


def test_automaton_against_all_edits():
    rng = random.Random(5)
    asked = {"", *("".join(rng.choice("suaoSUAOd") for _ in range(n)) for n in (1, 2, 3, 3, 4) for _ in range(12)), "ua", "sua", "uu", "aaa"}
    automaton = conversations.Automaton()
    for signature in sorted(asked, key=lambda s: s[::-1]):
        assert automaton.read(signature) == cheapest(signature)
    assert automaton.made < sum(map(len, asked))  # common endings are worked out once


def test_any_order_gives_the_same():
    rng = random.Random(6)
    asked = ["".join(rng.choice("suaUd") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    alone = {s: conversations.Automaton().read(s) for s in asked}
    together = conversations.Automaton()
    assert all(together.read(s) == alone[s] for s in asked)


WHITE = " \t\n\v\f\r"


def digest(rows):
    """The query's rows, in plain Python, costs and audits by the automaton that was held against all edits."""
    out, kept = [], {}
    for conv_id, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) if kind == 2 else text
        of = kept.setdefault(conv_id, [])
        of += [] if kind == 0 else [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv_id, found in kept.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        counts, seen, signature, illegal = {"b": 0, "d": 0, "t": 0}, set(), "", 0
        for n, (turn, role, text) in enumerate(found):
            bare = text.rstrip(WHITE)
            fault = "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] = counts.get(fault, 0) + 1
            symbol = role[0] if role[:1] in ("s", "u", "a") else "o"
            signature += "d" if fault and fault in "bd" else symbol.upper() if fault else symbol
            illegal += n > 0 and found[n - 1][1][:1] + role[:1] not in ("su", "ua", "au")
        turns = sorted({t for t, _, _ in found if t is not None})
        cost, audit = conversations.Automaton().read(signature)
        left = len(audit) - audit.count("D")
        lines, row = [], 0
        for e in audit:
            role, text = (None, "") if e == "I" else found[row][1:]
            row += e != "I"
            if e != "D":
                wanted = ["user", "assistant"][(len(lines) - left % 2) % 2]
                lines.append((role if e == "K" else wanted) + ":" + text)
        gaps = turns[-1] - turns[0] + 1 - len(turns) if turns else 0
        out.append((conv_id, gaps, counts["b"], counts["d"], counts["t"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def example():
    rng = random.Random(8)
    said = ["Yes.", "No!", "cut off", "", " \n", None, "Why? ", "Ünd ∑ so…", "tab.\t\v", "Yes."]
    rows = [
        (rng.choice([None, *range(30)]), rng.choice([None, *range(12)]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "Ärger"]), rng.choice(said))
        for _ in range(500)
    ]
    rows += [(100, t, ["user", "assistant"][t % 2], f"turn {t}.") for t in range(3000)]  # a long one
    rows += [(101, 1, "user", "same.")] * 40  # repeated rows
    rows += [(102, 0, "user", "w " * 200_000 + ".")]  # a long text
    rows += [(c, 7, "user", "x") for c in range(200, 400)]  # some of these lose all their turns
    return rows


def test_digest_agrees_with_plain_python(make):
    rows = example()
    assert any(zlib.crc32(f"{c}:7".encode()) % 20 == 0 for c in range(200, 400))
    found = conversations.repair_digest(conversations.damaged(make(rows, SCHEMA, CLASH)))
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == digest(rows)


def test_repaired_turns(make):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hello."), (1, 2, "assistant", ""), (2, None, "assistant", "A."), (3, 5, "system", "S."), (None, 0, None, None)]
    found = sorted(map(tuple, conversations.repair(make(rows, SCHEMA, CLASH[1:])).collect()), key=repr)
    assert found == [(1, 0, "K", 0, "user", "Hi."), (1, 1, "R", 1, "assistant", "Hello.")]


def test_every_repair_is_legal(make):
    import re

    found = conversations.repair(make(example(), SCHEMA, CLASH[1:])).collect()
    of = {}
    for r in sorted(found, key=lambda r: r.place):
        assert r.place == len(of.setdefault(r.conv_id, []))
        of[r.conv_id].append(r.role[:1])
    assert of and all(re.fullmatch("(s?(ua)+)?", "".join(i)) for i in of.values())


@pytest.mark.parametrize("run", [conversations.repair, conversations.repair_digest])
def test_empty_table(make, run):
    assert run(make([], SCHEMA)).count() == 0
