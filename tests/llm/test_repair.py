"""Conversation repair against a search over all edits and a plain automaton; blocks against whole conversations."""

import hashlib
import itertools
import random
import re
from binascii import crc32

import pytest

from strandline.llm import queries, repair

WHITE = " \t\n\x0b\x0c\r"
SHAPE = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """(initial, role, text, fault) of each row, in order."""
    seen, out = set(), []
    for role, text in rows:
        end = text.rstrip(WHITE)
        kind = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role[:1], role, text, kind))
    return out


def searched(rows, inserts=1):
    """The least edits by trying them all, with up to ``inserts`` insertions."""
    best = None
    for m in range(inserts + 1):
        for places in itertools.combinations_with_replacement(range(len(rows) + 1), m):
            for put in itertools.product("ua", repeat=m):
                for edits in itertools.product(*[["D"] if k in ("blank", "duplicate") else ["K", "Ru", "Ra", "D"] for _, _, _, k in rows]):
                    cost, audit, initials, lines = 5 * m, "", "", []
                    for i in range(len(rows) + 1):
                        for at, x in zip(places, put, strict=True):
                            if at == i:
                                audit, initials = audit + "I", initials + x
                                lines.append(f"{repair.ROLES[x]}:")
                        if i < len(rows):
                            e, (first, role, text, kind) = edits[i], rows[i]
                            audit += e[0]
                            cost += {"K": 0, "R": 1, "D": 2}[e[0]] + (5 if kind == "truncated" and e != "D" else 0)
                            if e != "D":
                                initials += first if e == "K" else e[1]
                                lines.append(f"{role if e == 'K' else repair.ROLES[e[1]]}:{text}")
                    if SHAPE.fullmatch(initials) and (best is None or (cost, audit) < best[:2]):
                        best = cost, audit, "\n".join(lines)
    return best


#: The automaton of (s?(ua)+)?, written out.
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def walked(rows):
    """The least edits by a table over the automaton's states, written apart from the parser."""
    def wide(t):
        for _ in range(4):
            for (s, x), z in MOVES.items():
                if s in t and x in "ua":
                    c, a, ls = t[s]
                    new = (c + 5, a + "I", [*ls, f"{repair.ROLES[x]}:"])
                    if z not in t or new[:2] < t[z][:2]:
                        t[z] = new
        return t

    t = wide({0: (0, "", [])})
    for first, role, text, kind in rows:
        n: dict = {}

        def put(z, new, n=n):
            if z not in n or new[:2] < n[z][:2]:
                n[z] = new

        for s, (c, a, ls) in t.items():
            put(s, (c + 2, a + "D", ls))
            if kind in ("blank", "duplicate"):
                continue
            more = 5 if kind == "truncated" else 0
            if (s, first) in MOVES:
                put(MOVES[s, first], (c + more, a + "K", [*ls, f"{role}:{text}"]))
            for x in "ua":
                if (s, x) in MOVES:
                    put(MOVES[s, x], (c + 1 + more, a + "R", [*ls, f"{repair.ROLES[x]}:{text}"]))
        t = wide(n)
    c, a, ls = min(t[s] for s in (0, 3) if s in t)
    return c, a, "\n".join(ls)


def plain(conversations):
    """conv -> result of the plain way; rows as (conv, turn, role, text, copies)."""
    groups: dict = {}
    for conv, turn, role, text, n in conversations:
        groups.setdefault(conv, []).extend([(turn, " " if role is None else role, " " if text is None else text)] * n)
    out = {}
    for conv, rows in groups.items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {r[0] for r in rows} - {None}
        marked = faults([r[1:] for r in rows])
        cost, audit, text = walked(marked)
        count = lambda k: sum(m[3] == k for m in marked)  # noqa: B023, E731
        illegal = sum(x[0] + y[0] not in ("su", "ua", "au") for x, y in itertools.pairwise(marked))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def damage(rows):
    for conv, turn, role, text in rows:
        what = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        yield conv, turn, "user" if what == 4 else role, text, {0: 0, 3: 2}.get(what, 1)


def test_the_parser_finds_the_least_edits():
    rng, parser = random.Random(3), repair.Parser()
    for _ in range(120):
        rows = faults([(rng.choice(["user", "assistant", "system", "tool", "a"]), rng.choice(["Yes.", "no", "What?", " ", "b!"])) for _ in range(rng.randrange(5))])
        tops = parser.inserted({0: (0, "", "")})
        for first, _, _, kind in rows:
            tops = parser.row(tops, first, 1, kind not in ("blank", "duplicate"), kind == "truncated")
        (cost, audit, symbols), _ = parser.best(tops)
        lines = repair.lines_of(audit, symbols, [r[1] for r in rows], [r[2] for r in rows], [1] * len(rows))
        assert (cost, audit, "\n".join(lines)) == searched(rows) == walked(rows)


def test_insertions_where_they_are_cheap():
    parser = repair.Parser(costs=repair.Costs(delete=9, rerole=9, insert=1))
    tops = parser.inserted({0: (0, "", "")})
    for x in "suu":
        tops = parser.row(tops, x, 1, True, False)
    assert parser.best(tops)[0] == (2, "KKIKI", "suaua")
    with pytest.raises(ValueError):
        repair.Parser(costs=repair.Costs(insert=0))


def made(seed=5, n=60):
    rng, out = random.Random(seed), []
    for conv in range(n):
        size = rng.choice([0, 1, 2, 5, 9, 30])
        for turn in range(size):
            role = ["user", "assistant"][turn % 2] if rng.random() < 0.8 else rng.choice(["system", "tool", "", None, "assistant", "Ünknown", "user"])
            text = rng.choice(["Fine.", "And then?", "Well\n", "no end", None, "", "\t\x0b", f"Text {rng.random()}.", "x" * 3000 + "!"])
            out += [(conv if conv else None, rng.choice([turn, turn, turn, turn + 3, None]), role, text)] * rng.choice([1, 1, 1, 2])
    return out


@pytest.mark.parametrize("rows,chars", [(1024, 1 << 20), (3, 1 << 20), (4, 900)])
def test_results_are_those_of_the_plain_way(spark, monkeypatch, rows, chars):
    monkeypatch.setattr(repair, "BLOCK_ROWS", rows)
    monkeypatch.setattr(repair, "BLOCK_CHARS", chars)
    data = made()
    long = [(999, i, "user" if i % 2 == 0 or i % 13 == 0 else "assistant", f"{i}." if i % 7 else "again and again.") for i in range(400)]
    data += long + [(1000, 4, "user", "the same.")] * 50
    want = plain(list(damage(data)))
    table = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = repair.repaired(queries.damaged(table.repartition(5)), queries.F.col("copies")).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def test_no_rows_after_damage_and_empty_tables(spark):
    table = spark.createDataFrame([(7, 1, "user", "x", 0), (8, None, None, None, 1)], "conv_id long, turn long, role string, text string, copies int")
    got = {r.conv_id: tuple(r)[1:] for r in repair.repaired(table, queries.F.col("copies")).collect()}
    none = hashlib.sha256(b"").hexdigest()
    assert got == {7: (0, 0, 0, 0, 0, 0, "", none), 8: (0, 1, 0, 0, 0, 2, "D", none)}
    assert repair.repaired(table.drop("copies").limit(0)).count() == 0
    clash = spark.createDataFrame([("c", 1, "user", "Hi.", 5, 1, "z")], "conv_id string, turn int, role string, text string, n int, `_h` int, `a.b` string")
    assert [tuple(r)[:2] + (r.audit,) for r in repair.repaired(clash).collect()] == [("c", 0, "D")]


def test_query(spark):
    data = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in queries.op13_glr_repair(spark, "/root/testdata/sf0.001").collect()}
    assert got == plain(list(damage(data)))
