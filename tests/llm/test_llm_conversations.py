"""Conversation repair against a plain search over whole edit texts."""

import hashlib
import random
import re
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from beaconry.llm import conversations as conv

SCHEMA = "extra int, conv_id long, turn long, role string, text string, part string, block string"
LEGAL_PATH = re.compile(r"(s?(ua)+)?")


def plain(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, lines) of the rows of one conversation, in their order."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    # The path of role initials so far -> the least (cost, audit, lines); paths differ only by what may follow them.
    after = lambda path: path[-1:]
    best = {"": (0, "", ())}

    def adding(found):
        out = dict(found)
        for _ in range(2):
            for at, (cost, audit, lines) in list(out.items()):
                role = "assistant" if at == "u" else "user"
                new = (cost + 5, audit + "I", (*lines, f"{role}:"))
                out[role[0]] = min(out.get(role[0], new), new)
        return out

    for (_, role, text), fault in zip(rows, faults):
        found = {}
        for at, (cost, audit, lines) in adding(best).items():
            ways = [(at, cost + 2, "D", ())]
            if fault not in ("b", "d"):
                more = 5 * (fault == "t")
                for name, price, edit in ((role, 0, "K"), ("user", 1, "R"), ("assistant", 1, "R")):
                    legal = name and at + name[:1] in ("su", "ua", "au", "s", "u")
                    if legal:
                        ways.append((after(name[:1]), cost + price + more, edit, (f"{name}:{text}",)))
            for end, total, edit, line in ways:
                new = (total, audit + edit, lines + line)
                found[end] = min(found.get(end, new), new)
        best = found
    cost, audit, lines = min(v for k, v in adding(best).items() if k in ("", "a"))
    assert LEGAL_PATH.fullmatch("".join(x[0] for x in lines))
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def made(seed, convs, most):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No?", "é!", "and then", " ", "", None, f"Number {turn}.", f"half {rng.randint(0, 5)}", "x. \n"])
            at = None if rng.random() < 0.1 else turn + rng.choice([0, 0, 0, 1, 3])
            rows += [(1, c, at, role, text, "p", "b")] * rng.choice([1, 1, 1, 1, 2])
    rng.shuffle(rows)
    return rows


def expected(rows):
    by = {}
    for _, c, t, r, x, *_ in rows:
        by.setdefault(c, []).append((t, r, x))
    return {c: plain(v) for c, v in by.items()}


def told(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize(("block_rows", "block_bytes"), [(4096, 1 << 20), (3, 1 << 20), (50, 40)])
def test_equals_plain_search(spark, block_rows, block_bytes):
    rows = made(block_rows, [None, *range(40)], 9) + made(7, [100, 101], 120)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = told(conv.report(conv.plan_repair(df, block_rows, block_bytes)))
    want = expected(rows)
    assert got.keys() == want.keys()
    assert {c: got[c] for c in want if got[c] != want[c]} == {}


def test_one_long_conversation_of_equal_rows(spark):
    """A conversation over all partitions, the same row again and again."""
    df = spark.range(5000).select(
        F.lit(5).cast("long").alias("conv_id"), F.lit(None).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("Hello.").alias("text")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = conv.plan_repair(df, 100)
        assert blocks.select("part").distinct().count() > 1
        row = conv.report(blocks).collect()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    # To keep one row and answer it costs 5 more than the 2 of its deletion.
    assert (row.duplicate, row.gaps, row.illegal, row.cost, row.audit) == (4999, 0, 4999, 10_000, "D" * 5000)


def test_messages_follow_the_audit(spark):
    rows = [(1, 1, 0, "assistant", "Hi.", "", ""), (1, 1, 1, "assistant", "So.", "", ""), (1, 1, 2, "system", "Late.", "", "")]
    repaired = conv.repair(conv.plan_repair(spark.createDataFrame(rows, SCHEMA)))
    out = conv.messages(repaired).orderBy("part", "block", "pos").collect()
    audit = "".join(r.audit for r in repaired.orderBy("part", "block").collect())
    assert audit == plain([(0, "assistant", "Hi."), (1, "assistant", "So."), (2, "system", "Late.")])[6]
    assert LEGAL_PATH.fullmatch("".join(r.role[0] for r in out)) and out


def test_damage_and_conversations_without_rows(spark):
    rows = [(1, c, t, "user" if t % 2 == 0 else "assistant", f"Text {c} {t}. Ok!", "", "") for c in range(60) for t in range(3)]
    rows += [(1, None, None, None, None, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    harmed = []
    for _, c, t, r, x, *_ in rows:
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        fault = zlib.crc32(key.encode()) % 20
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", x or " ") if fault == 2 else x or " "
            harmed += [(1, c, t, "user" if fault == 4 else r or " ", text, "", "")] * (2 if fault == 3 else 1)
    got, want = told(conv.damaged_and_repaired(df)), expected(harmed)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {c: want.get(c, empty) for c in [None, *range(60)]}
    single = spark.createDataFrame([(1, c, 0, "user", "A.", "", "") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0], SCHEMA)
    assert single.count() and set(told(conv.damaged_and_repaired(single)).values()) == {empty}


def test_no_rows(spark):
    assert conv.damaged_and_repaired(spark.createDataFrame([], SCHEMA)).collect() == []


def test_units_combine_like_rows():
    rng = random.Random(3)
    for _ in range(200):
        codes = [rng.choice("suaxSUA-_") for _ in range(rng.randint(1, 12))]
        units = [conv.row_unit(c) for c in codes]
        cut = rng.randint(0, len(units))
        parts = [conv.combined(p) for p in (units[:cut], units[cut:]) if p]
        assert conv.forward(units, 0)[2] == conv.forward(parts, 0)[2]
        assert conv.last_state(units) == conv.last_state(parts)
        states = conv.states_after(units, 0, conv.last_state(units))
        assert [k for k, _ in groupby(states)] and len(states) == len(units)
