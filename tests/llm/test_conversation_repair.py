"""Operator 13: against all edits of short conversations, and the query against a plain program."""

import hashlib
import itertools
import random
import zlib

import pytest

from kpilens.llm import conversation_repair as cr

WORD = " \t\n\v\f\r"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(WORD)
        out.append("b" if not body else "d" if (role, text) in seen else "k" if body[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def legal(s):
    s = s[1:] if s.startswith("s") and len(s) > 1 else s
    return len(s) % 2 == 0 and s == "ua" * (len(s) // 2)


def brute(rows):
    """(cost, audit, repaired) by a table over (turns read, output so far's state), audits as plain strings."""
    best = {0: (0, "", ())}
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}

    def put(d, state, item):
        if state not in d or item[:2] < d[state][:2]:
            d[state] = item

    def insert(d):
        for _ in range(4):
            for s, (c, a, out) in list(d.items()):
                for x, name in (("u", "user"), ("a", "assistant")):
                    if (s, x) in step:
                        put(d, step[s, x], (c + 5, a + "I", out + ((name, ""),)))
        return d

    for (role, text), fault in zip(rows, faults(rows)):
        insert(best)
        new = {}
        for s, (c, a, out) in best.items():
            put(new, s, (c + 2, a + "D", out))
            if fault in "kt":
                more = 5 * (fault == "t")
                for x, name, cost, edit in ((role[:1], role, 0, "K"), ("u", "user", 1, "R"), ("a", "assistant", 1, "R")):
                    if (s, x) in step:
                        put(new, step[s, x], (c + cost + more, a + edit, out + ((name, text),)))
        best = new
    insert(best)
    return min(best[s] for s in (0, 3) if s in best)


def every_edit(rows):
    """The same by trying all edit strings with up to three inserts (independent of any state table)."""
    fault, best = faults(rows), None
    slots = len(rows) + 1
    for ins in itertools.product(range(3), repeat=slots):
        if sum(ins) > 3:
            continue
        for edits in itertools.product("KRDS", repeat=len(rows)):        # S: rerole to assistant, shown as R
            cost, audit, roles = 5 * sum(ins), "", []
            ok = True
            for k in range(slots):
                audit += "I" * ins[k]
                roles += ["?"] * ins[k]
                if k == len(rows):
                    break
                e = edits[k]
                audit += "R" if e == "S" else e
                if e != "D":
                    ok &= fault[k] in "kt"
                    cost += 5 * (fault[k] == "t") + (e != "K")
                    roles.append({"K": rows[k][0][:1], "R": "u", "S": "a"}[e])
                else:
                    cost += 2
            if not ok or (best and (cost, audit) >= best):
                continue
            fill = [r if r != "?" else None for r in roles]
            starts = ["", "s"] if fill and fill[0] == "s" else [""]
            for lead in starts:
                want = [lead] * bool(lead) + ["ua"[i % 2] for i in range(len(fill) - bool(lead))]
                if all(f is None or f == w for f, w in zip(fill, want)) and legal("".join(want)):
                    best = (cost, audit)
    return best


def symbols(rows):
    kind = {"s": 0, "u": 1, "a": 2}
    return "".join(chr(cr.TERMINAL + 4 * kind.get(r[:1], 3) + cr.FAULTS.index(f)) for (r, _), f in zip(rows, faults(rows)))


def some_rows(rng, n):
    return [(rng.choice(["system", "user", "user", "assistant", "assistant", "tool"]), rng.choice(["a.", "b!", "c", "", "d?", "e.", "f."])) for _ in range(n)]


def test_matrices_against_all_edits():
    rng = random.Random(3)
    g = cr.Grammar([])
    for n in (0, 1, 2, 3, 3, 3, 3, 3):
        rows = some_rows(rng, n)
        assert brute(rows)[:2] == every_edit(rows)
        seq = symbols(rows)
        assert g.cheapest(iter([seq] if seq else [])) == every_edit(rows)


def test_pieces_and_rules_never_change_the_result():
    rng = random.Random(5)
    for n in (1, 5, 9, 40, 300):
        rows = some_rows(rng, n)
        want, seq = brute(rows)[:2], symbols(rows)
        for size in (1, 3, 64, 1000):
            pieces = [seq[k:k + size] for k in range(0, n, size)]
            pairs = [seq[:2], chr(cr.RULE) + seq[2:3], seq[3:5]] if n >= 5 else []
            assert cr.Grammar(pairs).cheapest(iter(pieces)) == want


def test_ropes_compare_as_strings():
    rng = random.Random(7)
    for _ in range(200):
        texts, ropes = [], []
        for _ in range(2):
            parts = [rng.choice("KRDI") * rng.randint(1, 3) for _ in range(rng.randint(1, 6))]
            rope = cr.EMPTY
            for p in parts:
                for c in p:
                    rope = cr.join(rope, cr.LEAF[c]) if rng.random() < .5 else cr.join(cr.join(rope, cr.EMPTY), cr.LEAF[c])
            texts.append("".join(parts))
            ropes.append(rope)
        assert str(ropes[0]) == texts[0]
        assert cr.before(*ropes) == (texts[0] < texts[1])


def expected(table):
    convs = {}
    for conv, turn, role, text in table:
        kept = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        c = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if c == 0:
            continue
        text = "" if c == 1 else "".join(x for x in text if x not in ".!?") if c == 2 else text
        role = "user" if c == 4 else role
        kept += [(turn, role, text)] * (2 if c == 3 else 1)
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        body = [r[1:] for r in rows]
        turns = {r[0] for r in rows if r[0] is not None}
        f = faults(body)
        cost, audit, fixed = brute(body)
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(body, body[1:])]
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, f.count("b"), f.count("d"), f.count("t"),
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()))
    return sorted(out, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string, key string, at int, audit string, seq string"


def got(spark, table):
    df = spark.createDataFrame([r + ("x", 1, "y", "z") for r in table], SCHEMA)      # columns of the names used inside
    out = cr.repair_summary(df, cr.damaged(df))
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(map(tuple, out.collect()), key=repr)


def test_query_against_a_plain_program(spark, monkeypatch):
    monkeypatch.setattr(cr, "PIECE", 16)
    rng = random.Random(11)
    table = []
    for conv in [None, *range(60)]:
        for k in range(rng.choice([1, 2, 4, 8, 12])):
            turn = rng.choice([k, k, k, k + 3, None])
            role = rng.choice(["system", "user", "assistant", "assistant", None, "tool", ""])
            table.append((conv, turn, role, rng.choice(["Yes.", "Why?", "und so", "", " \t\n", None, "É…", "ok!", "x" * 3000 + ".", "a.\n "])))
    table += table[:40]                                                   # repeated rows
    table += [(7, k, ("user", "assistant")[k % 2], f"turn {k}.") for k in range(700)]   # a hot conversation, many pieces
    assert got(spark, table) == expected(table)


def test_empty_and_wholly_dropped(spark):
    assert got(spark, []) == []
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert got(spark, [(gone, 0, "user", "Hi.")]) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_turns(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "tool", "Yes."), (2, 0, "assistant", "So.")],
                               "conv_id long, turn long, role string, text string")
    rows = {tuple(r) for r in cr.Repair(df).turns().collect()}
    assert rows == {("c1", 1, "K", "user", "Hi."), ("c1", 2, "R", "assistant", "Yes.")}


@pytest.mark.parametrize("n", [1200])
def test_long_conversation_of_equal_turns(spark, n):
    df = spark.createDataFrame([(1, k, "user", "Again.") for k in range(n)], "conv_id long, turn long, role string, text string")
    v = cr.Repair(df).verdicts.first()
    assert (v["duplicate"], v["cost"], v["audit"]) == (n - 1, 2 * n, "D" * n)
