import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from surveywave.llm import queries
from surveywave.llm.common import Scratch
from surveywave.llm.repair import DONE, checkpoints, edits, letter, repair_report, repaired_turns, step, transfer, _placed

SHAPE = "conv_id long, turn long, role string, text string"
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
GOOD = re.compile(r"(s?(ua)+)?")
COLS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def fault_list(rows):
    out, seen = [], set()
    for role, text in rows:
        last = text.rstrip(SPACE)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "ok")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """All edit sequences, cheapest first, then ASCII-least: the first that is well formed.
    Searched by cost over whole prefixes, without states or backward costs."""
    best = None
    for inserts in range(0, 4):
        for kinds in itertools.product("DKR", repeat=len(rows)):
            if any(f in ("blank", "duplicate") and k != "D" for f, k in zip(faults, kinds)):
                continue
            for gaps in itertools.combinations_with_replacement(range(len(rows) + 1), inserts):
                plan = []
                for i in range(len(rows) + 1):
                    plan += ["I"] * gaps.count(i)
                    if i < len(rows):
                        plan.append((kinds[i], i))
                audit = "".join(p if p == "I" else p[0] for p in plan)
                cost = 5 * audit.count("I") + sum((0 if k == "K" else 1 if k == "R" else 2) + 5 * (f == "truncated" and k != "D") for k, f in zip(kinds, faults))
                if best is not None and (cost, audit) >= best[:2]:
                    continue
                free = [p == "I" or p[0] == "R" for p in plan if p == "I" or p[0] != "D"]
                fixed = [rows[p[1]] if p != "I" else ("", "") for p in plan if p == "I" or p[0] != "D"]
                # roles of inserted and renamed turns: whichever fit
                for roles in itertools.product(("user", "assistant"), repeat=sum(free)):
                    it = iter(roles)
                    said = [(next(it) if f else role, text) for f, (role, text) in zip(free, fixed)]
                    if GOOD.fullmatch("".join(r[:1] or "-" for r, _ in said)):
                        best = (cost, audit, said)
                        break
    return best


def report(conv, rows):
    """rows: (turn, role, text) in order."""
    if not rows:
        return (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    said = [(r, t) for _, r, t in rows]
    faults = fault_list(said)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
    cost, audit, out = cheapest(said, faults)
    text = "\n".join(f"{r}:{t}" for r, t in out)
    return (conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.sha256(r[2].encode()).hexdigest()))


def random_turns(rng, convs, longest):
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(1, longest + 1)):
            rows.append((c, rng.choice([t, t, t, None, t // 2]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "ugly"]),
                         rng.choice(["Hi.", "So?\n", "cut off", "a!", "", " \n", "b. ", "Hi"]) + rng.choice(["", "", f" {t}."])))
    return rows


def test_report_against_all_edit_sequences(spark):
    rows = random_turns(random.Random(3), 70, 4)
    got = sorted(tuple(r) for r in repair_report(spark.createDataFrame(rows, SHAPE).repartition(3), Scratch(spark, "t-repair")).select(*COLS).collect())
    want = sorted(report(c, ordered([r[1:] for r in rows if r[0] == c])) for c in {r[0] for r in rows})
    assert got == want


def by_whole_vectors(codes):
    """The audit from backward vectors of all rows, kept in memory."""
    vectors = [DONE]
    for code in reversed(codes):
        vectors.append(step(code, vectors[-1]))
    vectors.reverse()
    state, audit = 0, []
    for i, code in enumerate(codes):
        for initial, state, _ in edits(code, state, vectors[i], vectors[i + 1]):
            audit.append(initial)
    while state in (1, 2):
        audit.append("I")
        state = {1: 2, 2: 3}[state]
    return vectors, "".join(audit)


def test_long_conversation_equals_the_dp_without_checkpoints(spark):
    rng = random.Random(9)
    rows = [(5, t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool"]), rng.choice(["yes.", "", "cut"]) + (f"{t}." if t % 3 else ""))
            for t in range(20_000)]
    df = spark.createDataFrame(rows, SHAPE)
    said = [(r, t) for _, _, r, t in rows]
    index = {"ok": 0, "blank": 1, "duplicate": 2, "truncated": 3}
    codes = [letter("sua".find(role[:1]) if role[:1] in ("s", "u", "a") else 3, index[f]) for (role, _), f in zip(said, fault_list(said))]
    vectors, audit = by_whole_vectors(codes)
    got = repair_report(df, Scratch(spark, "t-repair")).first()
    assert got.audit == audit and got.cost == vectors[0][0]
    # only about a root of the rows has a stored vector, and it is the right one
    placed = _placed(df, Scratch(spark, "t-repair"))
    stored = {r._block: r for r in checkpoints(placed, Scratch(spark, "t-repair")).collect()}
    assert len(stored) == 141 and max(len(r.codes) for r in stored.values()) == 142
    assert all(tuple(r.costs) == vectors[min(142 * (b + 1), 20_000)] for b, r in stored.items())
    out = repaired_turns(df, Scratch(spark, "t-repair")).orderBy("place").collect()
    assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in out).encode()).hexdigest() == got.repaired_sha256
    assert GOOD.fullmatch("".join(r.role[:1] for r in out))


def test_matrices_compose():
    rng = random.Random(2)
    codes = "".join(chr(ord("a") + rng.randrange(16)) for _ in range(40))
    v = DONE
    for code in reversed(codes):
        v = step(code, v)
    w = DONE
    for at in (33, 20, 19, 7, 0):
        end = {33: 40, 20: 33, 19: 20, 7: 19, 0: 7}[at]
        m = transfer(codes[at:end])
        w = tuple(min(m[4 * q + k] + w[k] for k in range(4)) for q in range(4))
    assert v == w


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if role is None else role), (" " if text is None else text)
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        k = zlib.crc32(key.encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def test_query_with_planted_damage_nulls_and_lost_conversations(spark, tmp_path):
    rows = random_turns(random.Random(8), 60, 3)
    rows += [(None, 1, "user", "a."), (None, None, None, None), (77, None, "user", None), (78, 3, None, "x.")]
    lost = next(c for c in range(1000, 9000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((lost, 0, "user", "gone."))
    df = spark.createDataFrame(rows, SHAPE).withColumns({"codes": F.lit("clash"), "_rank": F.lit(1)})
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted((tuple(r) for r in queries.op13_structure_repair(spark, str(tmp_path)).select(*COLS).collect()), key=str)
    after = hurt(rows)
    want = [report(c, ordered([r[1:] for r in after if r[0] == c])) for c in {r[0] for r in rows}]
    assert got == sorted(want, key=str)
    assert [r[1:8] for r in got if r[0] == lost] == [(0, 0, 0, 0, 0, 0, "")]


def test_many_equal_rows_and_a_long_text(spark):
    rows = [(1, 0, "user", "same.")] * 300 + [(1, 1, "assistant", "long. " * 100_000)]
    got = repair_report(spark.createDataFrame(rows, SHAPE), Scratch(spark, "t-repair")).first()
    assert got.audit == "K" + "D" * 299 + "K" and got.duplicate == 299 and got.cost == 598


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SHAPE).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op13_structure_repair(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("roles,audit", [("sua", "KKK"), ("s", "D"), ("a", "D"), ("uua", "DKK"), ("ua", "KK"), ("", "")])
def test_small_cases(spark, roles, audit):
    names = {"s": "system", "u": "user", "a": "assistant"}
    rows = [(1, i, names[r], f"{i}.") for i, r in enumerate(roles)]
    got = repair_report(spark.createDataFrame(rows, SHAPE), Scratch(spark, "t-repair")).collect()
    assert [r.audit for r in got] == ([audit] if rows else [])
