import hashlib
import itertools
import random
import zlib

import pytest
from conftest_llm import rows_of
from pyspark.sql import functions as F

from siftline.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def legal(initials):
    body = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (len(body) > 0 and body == "ua" * (len(body) // 2))


def every_edit(rows, extra=3):
    """Least (cost, audit, repaired) by trying all sequences of edits. rows: (role, text, kind)."""
    best = None

    def go(at, inserts, cost, audit, roles):
        nonlocal best
        if at == len(rows) and legal("".join(r[:1] for r, _ in roles)):
            found = (cost, audit, roles)
            best = found if best is None or found[:2] < best[:2] else best
        if best is not None and cost > best[0]:
            return
        if inserts < extra:
            for role in ("user", "assistant"):
                go(at, inserts + 1, cost + 3, audit + "I", [*roles, (role, "")])
        if at < len(rows):
            role, text, kind = rows[at]
            go(at + 1, inserts, cost + 4, audit + "D", roles)
            if kind != repair.UNUSABLE:
                more = 3 if kind == repair.TRUNCATED else 0
                go(at + 1, inserts, cost + more, audit + "K", [*roles, (role, text)])
                for new in ("user", "assistant"):
                    go(at + 1, inserts, cost + more + 3, audit + "R", [*roles, (new, text)])

    go(0, 0, 0, "", [])
    return best


def by_rows(rows):
    """Least (cost, audit) at each state after each row, without a heap. rows: (initial, kind)."""
    def closed(labels):
        for _ in range(4):
            for q, (cost, audit) in list(labels.items()):
                put(labels, repair.NEXT[q], cost + 3, audit + "I")
        return labels

    def put(labels, q, cost, audit):
        if q not in labels or (cost, audit) < labels[q]:
            labels[q] = cost, audit

    labels = closed({0: (0, "")})
    for initial, kind in rows:
        new = {}
        for q, (cost, audit) in labels.items():
            put(new, q, cost + 4, audit + "D")
            if kind != repair.UNUSABLE:
                more = 3 if kind == repair.TRUNCATED else 0
                put(new, repair.NEXT[q], cost + more + 3, audit + "R")
                if (initial, q) in repair.KEPT:
                    put(new, repair.KEPT[initial, q], cost + more, audit + "K")
        labels = closed(new)
    return min(labels[q] for q in (0, 3) if q in labels)


def test_search_against_every_edit():
    names = {"s": "system", "u": "user", "a": "assistant", "x": "xylo"}
    cases = [c for n in range(4) for c in itertools.product(itertools.product("suax", range(3)), repeat=n)]
    rng = random.Random(1)
    cases = rng.sample(cases, 250) + [tuple((rng.choice("suax"), rng.choice([0, 0, 0, 1, 2])) for _ in range(4)) for _ in range(40)]
    for case in cases:
        rows = [(names[i], f"t{k}", kind) for k, (i, kind) in enumerate(case)]
        cost, audit, roles = every_edit(rows)
        assert repair.cheapest(list(case), repair.START, repair.GOALS) == (cost, audit), case
        assert [x[:2] for x in repair.applied([r[:2] for r in rows], audit, repair.START)] == roles


def test_search_against_rows_one_by_one():
    rng = random.Random(2)
    for n in (*range(30), 90):
        for _ in range(12):
            case = [(rng.choice("suuaax"), rng.choice([0, 0, 0, 1, 2])) for _ in range(n)]
            assert repair.cheapest(case, repair.START, repair.GOALS) == by_rows(case), case


def test_walk_over_segments():
    rng = random.Random(3)
    for n, size in ((7, 1), (40, 3), (300, 2), (400, 5)):
        case = [(rng.choice("suuaax"), rng.choice([0, 0, 0, 1, 2])) for _ in range(n)]
        walk, decided = repair.Walk(), []
        for k in range(0, n, size):
            part = case[k:k + size]
            table = [{"before": b, "after": a, "cost": f[0], "edits": f[1]} for b in repair.STATES for a in repair.STATES
                     if (f := repair.cheapest(part, b, (a,)))]
            decided += walk.add(k // size, table)
        early = len(decided)
        cost, rest = walk.end()
        decided += rest
        assert [d[0] for d in decided] == list(range(len(decided)))
        assert (cost, "".join(d[2] for d in decided)) == by_rows(case)
        assert early or n < 100


def expected(rows):
    """The query's rows from plain Python."""
    out = []
    for conv in {r[0] for r in rows}:
        left, turns = [], []
        for c, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = (" " if x is None else x for x in (role, text))
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
            row = (turn is not None, turn or 0, "user" if kind == 4 else role, text)
            left += [row] * (2 if kind == 3 else 1)
        left.sort()
        turns = [r[1] for r in left if r[0]]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        n, kinds, seen = [0, 0, 0], [], set()
        for _, _, role, text in left:
            bare = text.strip(" \t\n\v\f\r")
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            kinds.append({0: repair.UNUSABLE, 1: repair.UNUSABLE, 2: repair.TRUNCATED, None: repair.SOUND}[fault])
            if fault is not None:
                n[fault] += 1
        initials = [r[2][:1] for r in left]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = by_rows(list(zip(initials, kinds)))
        lines = repair.applied([r[2:] for r in left], audit, repair.START)
        joined = "\n".join(f"{r}:{t}" for r, t, _ in lines)
        out.append((conv, gaps, *n, illegal, cost, audit, hashlib.sha256(joined.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def given():
    rng = random.Random(7)
    texts = ["Yes.", "No!", "so?", "half", "", " \t", None, "é…", "a:b\nuser:c.", "x. \x0b", "long " * 3000 + "end."]
    rows = []
    for conv in [*range(150), None, 2**45, -3]:
        for turn in range(rng.choice([1, 2, 5, 8])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool"])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 1, None]), role, rng.choice(texts)))
    # a third of all rows in one conversation, and one row repeated in it many times
    rows += [(500, k, "user" if k % 2 else "assistant", rng.choice(texts)) for k in range(260)]
    rows += [(500, 77, "user", "again.")] * 60
    rows += [(7000 + k, 1, "user", "Hi.") for k in range(60)]  # some lose their only row
    return rows


@pytest.mark.parametrize("segment", [repair.SEGMENT, 3])
def test_query_against_plain_python(spark, given, segment):
    df = spark.createDataFrame(given, SCHEMA).withColumn("cost", F.lit("x")).withColumn("segment", F.lit(1)).repartition(5)
    got = repair.repaired_after_damage(df, segment)
    assert rows_of(got, *COLUMNS) == expected(given)


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Still there?"), (1, 2, "assistant", "Yes."), (2, 0, "system", "Be kind.")]
    report, lines = repair.repaired(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(report, "conv_id", "illegal", "cost", "audit") == [(1, 1, 3, "KIKK"), (2, 0, 4, "D")]
    got = {r.conv_id: [tuple(x) for x in r.lines] for r in lines.collect()}
    assert got == {1: [("user", "Hi.", "K"), ("assistant", "", "I"), ("user", "Still there?", "K"), ("assistant", "Yes.", "K")], 2: []}


def test_empty_table_and_far_turns(spark):
    assert repair.repaired_after_damage(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, -2**63, "user", "a."), (1, 2**63 - 1, "assistant", "b."), (2, 2**63 - 1, "user", "a.")]
    got = {r.conv_id: r.gaps for r in repair.repaired_after_damage(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == {1, 2} and got[2] == 0
