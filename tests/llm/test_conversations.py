import hashlib
import random
import re
from itertools import product

import pytest
from pyspark.sql import functions as F

from bazaarlake.llm import conversations as conv
from bazaarlake.llm.conversations import Costs, Repair, Row

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")


def plain(rows, costs=Costs()):
    """All edits with up to two inserts in each gap, by trying them out."""
    best = None

    def go(i, cost, audit, out):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        for inserts in product("ua", repeat=2):
            for n in range(3):
                tail = "".join(inserts[:n])
                now, letters, paid = out + tail, audit + "I" * n, cost + costs.insert * n
                if not re.match(r"^s?(ua)*u?$", now):
                    continue
                if i == len(rows):
                    if LEGAL.fullmatch(now) and (best is None or (paid, letters) < best[:2]):
                        best = (paid, letters, now)
                    continue
                row = rows[i]
                go(i + 1, paid + costs.delete, letters + "D", now)
                if not (row.blank or row.duplicate):
                    extra = costs.truncated * row.truncated
                    for role in "ua":
                        go(i + 1, paid + costs.rerole + extra, letters + "R", now + role)
                    if row.initial:
                        go(i + 1, paid + extra, letters + "K", now + row.initial)

    go(0, 0, "", "")
    return best[:2]


def by_strings(rows, costs=Costs()):
    """Least (cost, letters) from the last row to the first, with whole strings."""
    many = (10**9, "")

    def gap(e, s, u, a):
        u, a = min(u, (a[0] + costs.insert, "I" + a[1])), min(a, (u[0] + costs.insert, "I" + u[1]))
        new = (u[0] + costs.insert, "I" + u[1])
        return min(e, new), min(s, new), u, a

    state = gap((0, ""), many, many, (0, ""))
    for row in reversed(rows):
        found = []
        for name, own in zip("esua", state, strict=True):
            edges = [(own[0] + costs.delete, "D" + own[1])]
            to, role = (state[3], "a") if name == "u" else (state[2], "u")
            if not (row.blank or row.duplicate):
                extra = costs.truncated * row.truncated
                edges.append((to[0] + costs.rerole + extra, "R" + to[1]))
                if row.initial == role:
                    edges.append((to[0] + extra, "K" + to[1]))
                if name == "e" and row.initial == "s":
                    edges.append((state[1][0] + extra, "K" + state[1][1]))
            found.append(min(edges))
        state = gap(*found)
    return state[0]


def repaired(rows, costs=Costs()):
    repair = Repair(costs)
    for row in reversed(rows):
        repair.add(row)
    return repair.result()


def drawn(rng, n):
    return [Row(rng.choice("suuaax"), rng.random() < 0.1, rng.random() < 0.1, rng.random() < 0.2) for _ in range(n)]


@pytest.mark.parametrize("costs", [Costs(), Costs(1, 1, 1, 1), Costs(3, 2, 1, 0), Costs(2, 2, 2, 2)])
def test_cheapest_edits_of_short_conversations(costs):
    rng = random.Random(1)
    for _ in range(120):
        rows = drawn(rng, rng.randint(0, 4))
        assert repaired(rows, costs) == plain(rows, costs), rows


def test_blocks_join_without_a_seam():
    rng = random.Random(2)
    for n in (63, 64, 65, 128, 300):
        for costs in (Costs(), Costs(1, 1, 1, 1)):
            rows = drawn(rng, n)
            assert repaired(rows, costs) == by_strings(rows, costs)
    assert repaired([Row("u", False, True, False)] * 5000) == (15000, "D" * 5000)


def test_an_insert_must_cost():
    with pytest.raises(ValueError):
        conv.audits(None, Costs(insert=0))


ROWS = [
    *((c, t, ["user", "assistant"][t % 2], f"{c} says {t}.") for c in range(40) for t in range(c % 7)),
    (100, 0, "system", "Be kind."),
    (100, 1, "user", "Hello?"),
    (100, 1, "user", "Hello?"),
    (100, 2, "assistant", "   \t\n"),
    (100, 3, "assistant", "cut of"),
    (100, 9, "system", "late!"),
    (101, None, "user", "no turn."),
    (101, None, None, None),
    (101, 4, "", "empty role."),
    (101, 4, "tool", "x" * 200_000),
    (102, 0, "assistant", "ünïcode \U0001f600!"),
    (102, 0, "assistant", "ünïcode \U0001f600!"),
    *((None, t, "user", "the same text.") for t in range(400)),
    *((None, None, "assistant", "another.") for _ in range(100)),
    (103, -5, "user", "Early."),
    (103, 5, "assistant", "Late."),
]
COLUMNS = ["conv_id", *conv.SUMMARY, "audit", "repaired_sha256"]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({"audit": F.lit("clash"), "i": F.lit(1)})


def test_damaged_conversations_equal_sql(rows, sql):
    names, want = sql(conv.SQL, conversations=rows)
    got = conv.repair_damaged(rows)
    assert got.columns == COLUMNS and sorted(names) == sorted(COLUMNS)
    at = [names.index(c) for c in COLUMNS]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got.collect()), key=key) == sorted((tuple(r[i] for i in at) for r in want), key=key)


def test_counts_cost_and_hash_of_one_conversation(spark):
    given = [(7, 1, "system", "A."), (7, 2, "user", "B"), (7, 2, "user", "B"), (7, 5, "user", " "), (7, 6, "user", "C!")]
    row = conv.repair(spark.createDataFrame(given, SCHEMA)).first()
    assert row[:7] == (7, 2, 1, 1, 1, 3, 9)
    # The truncated row costs 1, blank and duplicate rows are deleted, the last one becomes the answer.
    assert row.audit == "KKDDR"
    assert row.repaired_sha256 == hashlib.sha256(b"system:A.\nuser:B\nassistant:C!").hexdigest()


def test_repaired_rows_are_legal_and_hash_alike(rows):
    hashes = {r.conv_id: r.repaired_sha256 for r in conv.repair(rows).collect()}
    found = {}
    for r in conv.repaired_rows(rows).orderBy("conv_id", "position").collect():
        found.setdefault(r.conv_id, []).append(r)
    for conv_id, digest in hashes.items():
        own = found.get(conv_id, [])
        assert [r.position for r in own] == list(range(len(own)))
        assert LEGAL.fullmatch("".join(r.role[:1] for r in own))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in own).encode()).hexdigest() == digest


def test_damage_drops_empties_trims_repeats_and_renames(spark):
    import zlib

    given = [(c, t, "assistant", "One. Two! Three?") for c in range(10) for t in range(10)]
    out = {}
    for r in conv.damage(spark.createDataFrame(given, SCHEMA)).collect():
        out.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    same = ("assistant", "One. Two! Three?")
    kinds = {0: None, 1: [("assistant", "")], 2: [("assistant", "One Two Three")], 3: [same, same], 4: [("user", same[1])]}
    for c, t, *_ in given:
        assert out.get((c, t)) == kinds.get(zlib.crc32(f"{c}:{t}".encode()) % 20, [same])


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conv.repair_damaged(empty).collect() == [] and conv.repaired_rows(empty).collect() == []
