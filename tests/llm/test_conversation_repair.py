"""Conversation repair against a search over states row by row, from the front."""

import hashlib
import random
import re
import zlib

import pytest

from skewscope.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string, cost long, conv string"  # clashing names
LEGAL = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
BOTH = (("u", "user"), ("a", "assistant"))


def order(row):
    turn, role, text = row
    return turn is not None, turn or 0, role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, hash, edits of (turn, role, text) rows; nulls already spaces."""
    rows = sorted(rows, key=order)
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    blank = duplicate = truncated = 0
    seen, states = set(), {0: (0, "", ())}

    def put(states, q, new):
        if q not in states or new[:2] < states[q][:2]:
            states[q] = new
            for r, role in BOTH:
                if r in LEGAL[q]:
                    put(states, LEGAL[q][r], (new[0] + 3, new[1] + "I", new[2] + ((role, "", "I"),)))

    put(states, 0, states.pop(0))
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        gone, cut = not body or (role, text) in seen, bool(body) and body[-1] not in ".!?"
        blank, duplicate = blank + (not body), duplicate + (bool(body) and gone)
        truncated += cut and not gone
        seen.add((role, text))
        new = {}
        for q, (cost, audit, out) in states.items():
            put(new, q, (cost + 4, audit + "D", out))
            if not gone:
                if role[:1] in LEGAL[q]:
                    put(new, LEGAL[q][role[:1]], (cost + 3 * cut, audit + "K", out + ((role, text, "K"),)))
                for r, full in BOTH:
                    if r in LEGAL[q]:
                        put(new, LEGAL[q][r], (cost + 3 + 3 * cut, audit + "R", out + ((full, text, "R"),)))
        states = new
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, out = min(states[q] for q in (0, 3) if q in states)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t, _ in out).encode()).hexdigest()
    return (gaps, blank, duplicate, truncated, illegal, cost, audit, digest), out


def some_rows(rnd, n):
    turn, out = 0, []
    while len(out) < n:
        turn += rnd.choice([0, 1, 1, 1, 3])
        out.append((None if rnd.random() < 0.02 else turn, rnd.choice(["user", "assistant"] * 3 + ["system", "tool", "u", "", " "]),
                    rnd.choice(["ok.", "hi!", "no", "", " ", "x?\n", "long text", "b. ", f"c!{rnd.randrange(99)}"])))
    return out


def table(spark, convs):
    rows = [(c, *r, 0, "x") for c, some in convs.items() for r in some]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("size,fan", [(C.SEGMENT, C.FAN), (7, 3)])
def test_against_search_by_state(spark, size, fan):
    """Long conversations are several segments and levels in the second case; a conversation with null id among them."""
    rnd = random.Random(size)
    convs = {c if c != 3 else None: some_rows(rnd, n) for c, n in enumerate([1, 2, 3, 5, 8, 20, 60] * 8 + [500])}
    got = {r.conv_id: tuple(r)[1:] for r in C.repair(table(spark, convs), size=size, fan=fan).collect()}
    assert got == {c: brute(rows)[0] for c, rows in convs.items()}


def test_repaired_turns(spark):
    rnd = random.Random(4)
    convs = {c: some_rows(rnd, n) for c, n in enumerate([1, 4, 9, 30])}
    got = sorted(tuple(r) for r in C.repaired_turns(table(spark, convs)).collect())
    assert got == sorted((c, i, *row) for c, rows in convs.items() for i, row in enumerate(brute(rows)[1]))
    for c in convs:
        initials = "".join(r[2][0] for r in got if r[0] == c)
        assert re.fullmatch("(s?(ua)+)?", initials)


def test_suffix_is_walked_once(monkeypatch):
    """One step per node of the automaton, not per row: equal ends are worked out once."""
    calls = []
    real = C.step
    monkeypatch.setattr(C, "step", lambda symbol, after: calls.append(symbol) or real(symbol, after))
    keys = sorted("F" + "".join(reversed(k)) for k in ["uaua", "uaua", "suaua", "uuaua", "Dua", "ua"] * 50)
    out = list(C.walk((str(i), 0, k) for i, k in enumerate(keys)))
    assert len(out) == len(keys)
    assert len(calls) == len({k[:i] for k in keys for i in range(2, len(k) + 1)})


def test_edges(spark):
    assert C.repair(table(spark, {1: [(0, "user", "a.")]}).limit(0)).collect() == []
    rows = spark.createDataFrame([(1, 0, None, None), (1, None, "user", "long " * 40_000 + "."), (2, 5, "assistant", "b.")] + [(4, 1, "user", "same.")] * 900,
                                 "conv_id long, turn long, role string, text string")
    ids = spark.createDataFrame([(1,), (1,), (2,), (3,), (4,), (None,)], "conv_id long")
    got = {r.conv_id: tuple(r)[1:] for r in C.repair(rows, ids, size=100).collect()}
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {1: brute([(0, " ", " "), (None, "user", "long " * 40_000 + ".")])[0], 2: brute([(5, "assistant", "b.")])[0],
                   3: none, 4: brute([(1, "user", "same.")] * 900)[0], None: none}


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    convs: dict = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        some = convs.setdefault(r.conv_id, [])
        kind = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        role, text = " " if r.role is None else r.role, " " if r.text is None else r.text
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        some += [(r.turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    got = {r.conv_id: tuple(r)[1:] for r in C.op11_suffix_automaton(spark, sf).collect()}
    assert got == {c: brute(rows)[0] for c, rows in convs.items()}
