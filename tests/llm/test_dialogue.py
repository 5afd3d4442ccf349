import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from versus.llm import dialogue
from versus.llm.dialogue import GONE, Repair, audit_of, closing, end_costs, trace

SPACES = " \t\n\x0b\x0c\r"


def brute(rows):
    """All states after each row with every least (cost, audit, result); rows: (role, text, bad, cut)."""
    def accepts(states):
        out = dict(states)
        for _ in range(4):
            for q, (c, a, t) in list(out.items()):
                role = "assistant" if q == "u" else "user"
                new = (c + 5, a + "I", (*t, f"{role}:"))
                to = role[0]
                if to not in out or new < out[to]:
                    out[to] = new
        return out

    states = {"": (0, "", ())}
    for role, text, bad, cut in rows:
        new = {}

        def put(q, v, new=new):
            if q not in new or v < new[q]:
                new[q] = v
        for q, (c, a, t) in accepts(states).items():
            put(q, (c + 2, a + "D", t))
            if bad:
                continue
            extra = 5 if cut else 0
            r = role[:1]
            if r == "s" and q == "" or r == "u" and q != "u" or r == "a" and q == "u":
                put(r, (c + extra, a + "K", (*t, f"{role}:{text}")))
            to = "assistant" if q == "u" else "user"
            put(to[0], (c + extra + 1, a + "R", (*t, f"{to}:{text}")))
        states = new
    final = accepts(states)
    return min(v for q, v in final.items() if q in ("", "a"))


def plain(rows):
    """The whole contract for one conversation; rows (turn, role, text) as they are ordered."""
    seen, marked = set(), []
    n = {"blank": 0, "duplicate": 0, "truncated": 0}
    for turn, role, text in rows:
        body = text.strip(SPACES)
        blank, again = not body, bool(body) and (role, text) in seen
        seen.add((role, text))
        cut = not blank and not again and body[-1] not in ".!?"
        for k, v in (("blank", blank), ("duplicate", again), ("truncated", cut)):
            n[k] += v
        marked.append((role, text, blank or again, cut))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, out = brute(marked)
    return gaps, *n.values(), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest(), out


def talk(rng, n):
    words = ["a.", "b", "c!", " ", "", "d?\n", "é", "x.\t", " ", "long" * 3]
    return [(rng.choice([None, *range(n)]), rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", "agent"]), rng.choice(words)) for _ in range(n)]


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def test_tables_equal_all_edits():
    rng = random.Random(5)
    for n in list(range(12)) * 25:
        symbols = [rng.choice([0, 1, 2, 3, 4, 5, 6, 7, GONE]) for _ in range(n)]
        rows = [("suax"[s % 4], "t", s == GONE, s in (4, 5, 6, 7)) for s in symbols]
        (codes, state), = trace(np.array(symbols, dtype=np.int64), end_costs())
        codes += closing(state)
        cost, audit, out = brute(rows)
        assert audit_of(codes) == audit
        made = [f"{r}:{t}" for c, row in zip(dialogue.row_codes(codes), rows) for _, r, t in dialogue.repaired(c, row[0], row[1])]
        assert [x[0] for x in made] == [x[0] for x in out] and re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in made))


def test_pieces_chain_to_the_whole():
    rng = random.Random(6)
    for _ in range(60):
        symbols = np.array([rng.randrange(9) for _ in range(40)], dtype=np.int64)
        after, pieces = end_costs(), []
        for cut in range(40, 0, -8):
            part = symbols[cut - 8:cut]
            pieces.append((part, after))
            after = dialogue.through(dialogue.matrix(part), after)
        state, codes = 0, ""
        for part, after_part in reversed(pieces):
            code, state = trace(part, after_part, (0, 1, 2, 3))[state]
            codes += code
        assert (codes, state) == trace(symbols, end_costs())[0]


@pytest.mark.parametrize("bins", [1, 40])
def test_conversations_equal_brute_force(spark, bins):
    rng = random.Random(7)
    talks = {c: talk(rng, rng.randint(1, 9)) for c in [None, *range(30)]}
    talks[100] = talk(rng, 400)  # a third of all rows and more
    talks[101] = [(5, "user", "same.")] * 60
    talks[102] = [(None, "user", f"t{i}.") for i in range(20)]
    talks[103] = [(0, "user", "word " * 200_000 + "."), (1, "assistant", "y")]
    rows = [(c, t, r, x, True, 1, "k") for c, v in talks.items() for t, r, x in v] + [(c, 3, "user", "gone", False, 2, "k") for c in (1, 2, 2, 500, 501)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, here boolean, pos int, codes string").repartition(5)
    fix = Repair(df, present="here", bins=bins)
    got = {r.conv_id: tuple(r)[1:] for r in fix.conversations.collect()}
    want = {c: plain(ordered(v)) for c, v in talks.items()}
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {**{c: w[:-1] for c, w in want.items()}, 500: empty, 501: empty}
    lines = {}
    for r in fix.rows.orderBy("pos", "part").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert lines == {c: list(w[-1]) for c, w in want.items() if w[-1]}


def test_nulls_and_no_rows(spark):
    schema = "conv_id string, turn long, role string, text string"
    df = spark.createDataFrame([("c", None, None, None), ("c", 1, "user", None), ("c", 2, None, "x."), (None, None, "user", "a.")], schema)
    got = {r.conv_id: tuple(r)[1:] for r in Repair(df).conversations.collect()}
    assert got["c"] == plain([(None, " ", " "), (1, "user", " "), (2, " ", "x.")])[:-1]
    assert got[None] == plain([(None, "user", "a.")])[:-1]
    assert Repair(spark.createDataFrame([], schema)).conversations.collect() == []
    assert Repair(spark.createDataFrame([], schema)).rows.collect() == []


def test_damage(spark):
    import zlib
    rows = [(i, t, r, "One. Two! Three? é") for i in range(40) for t, r in ((0, "user"), (1, "assistant"), (None, None))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(map(repr, (tuple(r) for r in dialogue.damage(df).collect())))
    want = []
    for i, t, r, x in rows:
        kind = zlib.crc32(f"{i}:{' ' if t is None else t}".encode()) % 20
        x = {1: "", 2: "One Two Three é"}.get(kind, x)
        want += [(i, t, "user" if kind == 4 else r or " ", x, kind != 0)] * (2 if kind == 3 else 1)
    assert got == sorted(map(repr, want)) and len({w[3] for w in want}) == 3
    assert dialogue.damage(df.select(*[F.lit(None).cast(t).alias(c) for c, t in df.dtypes])).select("role", "text").distinct().count() <= 2
