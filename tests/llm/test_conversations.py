"""Conversation repair: alignments against all edit scripts and against a plain walk through the grammar's states."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from tillwatch.llm import conversations as cv

LEGAL = re.compile("(s?(ua)+)?")
SPACE = re.compile(r"[^\x20\x09-\x0D]")


def all_scripts(turns, extra=3):
    """Least (cost, audit) by trying every script with up to `extra` insertions in a place."""
    found = []
    for letters in itertools.product("DKR", repeat=len(turns)):
        if any(c == "-" and e != "D" for c, e in zip(turns, letters)):
            continue
        for gaps in itertools.product(range(extra + 1), repeat=len(turns) + 1):
            kept = [None] * gaps[0]
            for c, e, g in zip(turns, letters, gaps[1:]):
                kept += [] if e == "D" else [c.lower()] if e == "K" else [None]
                kept += [None] * g
            cost = 4 * letters.count("D") + 3 * letters.count("R") + 3 * sum(gaps) + sum(3 for c, e in zip(turns, letters) if e != "D" and c.isupper())
            for front in ("", "s"):
                rest = len(kept) - len(front)
                target = front + "ua" * (rest // 2)
                if rest >= 0 and len(target) == len(kept) and LEGAL.fullmatch(target) and all(k == t if k else t in "ua" for k, t in zip(kept, target)):
                    audit = "I" * gaps[0] + "".join(e + "I" * g for e, g in zip(letters, gaps[1:]))
                    found.append((cost, audit))
    return min(found)


def walk(turns):
    """Least (cost, audit), turn by turn over the grammar's states: start, s, u, a."""
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                for c in "ua":
                    if (to := after.get((state, c))) is not None:
                        best[to] = min(best.get(to, (10**9, "")), (cost + 3, audit + "I"))
        return best

    best = inserted({0: (0, "")})
    for c in turns:
        new = {}
        for state, (cost, audit) in best.items():
            steps = [(4, "D", state)]
            if c != "-":
                cut = 3 * c.isupper()
                for x in "sua":
                    if (to := after.get((state, x))) is not None and (x == c.lower() or x != "s"):
                        steps.append((cut + 3 * (x != c.lower()), "K" if x == c.lower() else "R", to))
            for more, letter, to in steps:
                new[to] = min(new.get(to, (10**9, "")), (cost + more, audit + letter))
        best = inserted(new)
    return min(best[s] for s in (0, 3) if s in best)


def test_small_conversations_against_all_scripts():
    for n in range(4):
        for turns in itertools.product("suax-SUX" if n < 3 else "suA-", repeat=n):
            want = all_scripts(turns, 2)
            assert cv.repair("".join(turns)) == want == walk(turns), turns


@pytest.mark.parametrize("chunk", [1, 2, 5, 32])
def test_chunks_equal_the_walk(chunk):
    rnd = random.Random(chunk)
    for _ in range(400):
        pool = rnd.choice(["ua", "uuA-", "suaxSUAX-", "s", "-", "aaau", "UA"])
        turns = "".join(rnd.choice(pool) for _ in range(rnd.randrange(40)))
        assert cv.repair(turns, chunk) == walk(turns), turns
    long = "".join(rnd.choice("ua" * 6 + "sUAx-") for _ in range(1_500))
    assert cv.repair(long, max(chunk, 5)) == walk(long)


def plain(rows):
    """conv_id -> gaps, blank, duplicate, truncated, illegal, cost, audit, repaired digest; rows are (conv, turn, role, text)."""
    kept = defaultdict(list)
    for conv, turn, role, text in rows:
        kept[conv] += []
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        roll = zlib.crc32(key.encode()) % 20
        if roll:
            text = "" if roll == 1 else re.sub("[.!?]", "", text) if roll == 2 else text
            kept[conv] += [(turn, "user" if roll == 4 else role, text)] * (2 if roll == 3 else 1)
    out = {}
    for conv, turns in kept.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.sha256(t[2].encode()).digest()))
        seen, codes, counts = set(), "", dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in turns:
            code = role[0] if role and role[0] in "sua" else "x"
            if not SPACE.search(text):
                counts["blank"] += 1
                code = "-"
            elif (role, text) in seen:
                counts["duplicate"] += 1
                code = "-"
            elif SPACE.findall(text)[-1] not in ".!?":
                counts["truncated"] += 1
                code = code.upper()
            seen.add((role, text))
            codes += code
        cost, audit = walk(codes)
        state, repaired, at = "", [], iter(turns)
        for e in audit:
            turn = None if e == "I" else next(at)
            if e == "D":
                continue
            role = turn[1] if e == "K" else "assistant" if state == "u" else "user"
            state = role[0]
            repaired.append(f"{role}:{turn[2] if turn else ''}")
        initials = [r[:1] for _, r, _ in turns]
        numbers = {t for t, _, _ in turns if t is not None}
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, *counts.values(),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def frame(spark, rows):
    found = spark.createDataFrame([(*r, "x", 9) for r in rows], "conv_id long, turn long, role string, text string, digest string, kind int")
    return found


def repaired(df, chunk=cv.CHUNK):
    found = cv.repair_conversations(cv.damaged(df), df, digests=True, chunk=chunk)
    assert found.columns == COLUMNS
    rows = found.collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


def conversations():
    rnd = random.Random(5)
    texts = ["yes.", "no", "Why?", "", " \t", "same.", "ends here!  \n", "no end ", ".", "日本。", "é.", None, "a\x0b", "x.\x0c"]
    rows = []
    for conv in [*range(150), None, -3]:
        for turn in range(rnd.randrange(9)):
            role = rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]) if rnd.random() < 0.3 else ["user", "assistant"][turn % 2]
            rows.append((conv, rnd.choice([turn, turn, turn, None, turn * 3]), role, rnd.choice(texts) if rnd.random() < 0.5 else f"turn {turn} of {conv}."))
    rows += [(7, 1, "user", "same."), (7, 1, "user", "same."), (8, 0, "assistant", "same."), (8, 0, "user", "same."), (9, 2**62, "user", "far."), (9, -(2**62) + 5, "user", "far")]
    rows += [(1_000, k, ["user", "assistant"][(k + k // 97) % 2], f"long {k % 300}." + "x" * (k % 7)) for k in range(3_000)]
    rows += [(1_001, 0, "user", "very long " * 200_000 + "."), (1_001, 1, "assistant", "ok.")]
    return rows


def test_query_equals_the_plain_version(spark):
    rows = conversations()
    want = plain(rows)
    assert sum(r[2] for r in want.values()) and sum(r[3] for r in want.values()) and any("I" in r[6] for r in want.values())
    assert repaired(frame(spark, rows).repartition(7)) == want
    # many small ranges: the long conversation lies in several tasks
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert repaired(frame(spark, rows).repartition(3), chunk=7) == want
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_repaired_turns_follow_the_grammar(spark):
    rows = conversations()
    df = frame(spark, rows)
    found = defaultdict(list)
    for r in cv.repair_conversations(cv.damaged(df)).orderBy("place").collect():
        found[r["conv_id"]].append(r)
    want = plain(rows)
    for conv, (*_, audit, digest) in want.items():
        turns = found[conv]
        assert LEGAL.fullmatch("".join(r["role"][0] for r in turns))
        assert [r["place"] for r in turns] == list(range(len(turns))) and "".join(r["edit"] for r in turns) == audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in turns).encode()).hexdigest() == digest


def test_empty_and_dropped(spark):
    assert repaired(frame(spark, [])) == {}
    gone = next(k for k in range(1_000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert repaired(frame(spark, [(gone, 0, "user", "a.")])) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_sql_on_hard_rows(spark, tmp_path):
    import duckdb

    from tillwatch.llm import queries

    rows = [r for r in conversations() if r[0] not in (1_000, 9)]
    con = duckdb.connect()
    frame(spark, rows).coalesce(1).write.parquet(str(tmp_path / "c"))
    con.execute(f"create view conversations as select * from '{tmp_path}/c/*.parquet'")
    found = con.execute(queries.ORACLES["op12_conversation_repair"]).fetchall()
    assert {r[0]: tuple(r[1:]) for r in found} == plain(rows)
