import hashlib
import random
import re
import zlib

import duckdb
import pandas as pd

from courtside.llm import turn_repair as R

WHITE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """Least (cost, audit) by trying every edit of every row in turn, per state of the pattern."""
    accept, here = re.compile(r"(s?(ua)+)?\Z"), {"": (0, "")}

    def short(out):  # what decides how the initials may go on
        return out if len(out) < 2 else ("ua" if out[-1] == "a" else "u")

    def put(to, key, value):
        if not re.fullmatch(r"s?(ua)*u?", key):
            return
        key = short(key)
        if key not in to or value < to[key]:
            to[key] = value

    def inserted(here):
        for _ in range(3):
            more = dict(here)
            for key, (c, a) in here.items():
                for x in "ua":
                    put(more, key + x, (c + 5, a + "I"))
            here = more
        return here

    for initial, must_go, truncated in rows:
        here, after = inserted(here), {}
        for key, (c, a) in here.items():
            put(after, key, (c + 2, a + "D"))
            if not must_go:
                if initial:
                    put(after, key + initial, (c + 5 * truncated, a + "K"))
                for x in "ua":
                    put(after, key + x, (c + 1 + 5 * truncated, a + "R"))
        here = after
    return min(v for k, v in inserted(here).items() if accept.match(k))


def brute(rows):
    """The contract in plain Python."""
    out, convs = [], {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text, kind = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        mine = convs.setdefault(conv, [])
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, mine in convs.items():
        mine.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.md5(f"{len(x[1])}:{x[1]}:{x[2]}".encode()).hexdigest()))
        faults = []
        for i, (turn, role, text) in enumerate(mine):
            body = text.strip(WHITE)
            faults.append("b" if not body else "d" if (role, text) in [m[1:] for m in mine[:i]] else "t" if body[-1] not in ".!?" else "")
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit = cheapest([(m[1][:1], f in ("b", "d"), f == "t") for m, f in zip(mine, faults)])
        left, lines = iter(mine), []
        for e in audit:
            due = "assistant" if lines and lines[-1][0] == "u" else "user"
            if e == "I":
                lines.append(f"{due}:")
            else:
                _, role, text = next(left)
                if e != "D":
                    lines.append(f"{role if e == 'K' else due}:{text}")
        out.append((conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def random_rows(seed, n):
    rnd, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rnd.randrange(1, 12)):
            role = rnd.choice(["user", "assistant", "system", "tool", ""]) if rnd.random() < 0.3 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn, role, rnd.choice(["Yes.", "No!", "Why?", "cut off", "", " \t", "Well. \n", "é…", f"text {rnd.random()}."])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def found(spark, rows):
    return sorted((tuple(r) for r in R.audits(R.damage(frame(spark, rows)), present_col="present").collect()), key=str)


def test_audits_match_brute_force_and_sql(spark):
    rows = random_rows(3, 150)
    want = brute(rows)
    assert found(spark, rows) == want and {"D", "K", "R"} == set("".join(w[7] for w in want))
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]))
    assert sorted((tuple(r) for r in con.execute(R.oracle()).fetchall()), key=str) == want


def test_odd_rows(spark):
    rows = random_rows(4, 20) + [(None, 1, "user", "Hi."), (None, None, None, None), (None, 2, "assistant", "Ho."), (500, None, "user", "A."), (500, None, "assistant", "B."),
            (501, 3, "user", "same."), (501, 3, "user", "same."), (501, 3, "assistant", "other."), (502, -4, "user", "x." * 200_000), (502, 9, None, None), (503, 1, "user", None)]
    dropped = next(c for c in range(600, 900) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "gone."))
    got = found(spark, rows)
    assert got == brute(rows)
    assert (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got
    clash = frame(spark, rows).selectExpr("*", "1 AS kind", "2 AS present", "3 AS digest", "4 AS audit", "5 AS _times", "6 AS conv")
    assert sorted((tuple(r) for r in R.audits(R.damage(clash), present_col="present").collect()), key=str) == got
    assert R.audits(R.damage(frame(spark, []))).collect() == [] and R.repair(frame(spark, [])).collect() == []


def test_repaired_rows_agree_with_the_hash(spark):
    rows = R.damage(frame(spark, random_rows(5, 60)))
    lines = {}
    for r in sorted(R.repair(rows, present_col="present").collect(), key=lambda r: (r.conv_id, r.place)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        assert (r.turn is None) == (r.edit == "I")
    for r in R.audits(rows, present_col="present").collect():
        assert hashlib.sha256("\n".join(lines.get(r.conv_id, [])).encode()).hexdigest() == r.repaired_sha256
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines.get(r.conv_id, [])))


def test_search_is_cheapest_and_first():
    rnd = random.Random(6)
    for n in [*range(12)] * 40 + [300, 300]:
        rows = [(rnd.choice("suax") if rnd.random() < 0.5 else "ua"[k % 2], rnd.random() < 0.2, rnd.random() < 0.2) for k in range(n)]
        for segment in (2, 256):
            s = R.Search(rows, segment)
            assert (s.cost, s.audit) == cheapest(rows)


def test_inserted_rows_take_the_role_that_is_due():
    """An insertion costs more than the deletion that does the same, so no cheapest path has one; the edit still works."""
    out = list(R.repaired("KIKID", iter([(1, "system", "S."), (2, "assistant", "A."), (3, "user", "")])))
    assert out == [(1, "K", "system", "S."), (None, "I", "user", ""), (2, "K", "assistant", "A."), (None, "I", "user", "")]


def test_long_conversation():
    rnd = random.Random(7)
    rows = [("ua"[k % 2] if rnd.random() < 0.9 else "u", rnd.random() < 0.1, rnd.random() < 0.05) for k in range(10_000)]
    s = R.Search(rows)
    assert (s.cost, s.audit) == cheapest(rows)
