"""Conversation repair against a search over all edits, whole and in blocks."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from starmart.llm import repair as R

TURNS = "conv_id long, turn long, role string, text string"
READ = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLE = {0: "user", 1: "user", 2: "assistant", 3: "user"}


def search(codes):
    """Least (cost, audit) by keeping the best audit of every state after every row."""
    best = {0: (0, "")}
    for c in codes:
        after = {}
        for state, (cost, audit) in best.items():
            for inserts in range(3):
                ways = [(state, 3, "D")]
                if c != "-":
                    ways.append((READ[state, ROLE[state][0]], 2 + c.isupper(), "R"))
                    ways += [(READ[state, c.lower()], int(c.isupper()), "K")] if (state, c.lower()) in READ else []
                for t, more, edit in ways:
                    found = (cost + 2 * inserts + more, audit + "I" * inserts + edit)
                    after[t] = min(after.get(t, found), found)
                state = READ[state, ROLE[state][0]]
        best = after
    return min((c + 2 * n, a + "I" * n) for s, n in ((0, 0), (3, 0), (2, 1), (1, 2)) if s in best for c, a in [best[s]])


def test_crossings_find_the_least_audit():
    rng = random.Random(5)
    for _ in range(3_000):
        codes = "".join(rng.choices("suaSUA?-", k=rng.randrange(14)))
        audit = R.edits(codes, 0, R.best_end(codes), True)
        assert (R.cost_of(audit, codes), audit) == search(codes)


def expected(rows, ids):
    """conv_id -> the columns of the query, row by row in plain Python."""
    out = {}
    for conv_id in ids:
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv_id]
        mine.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1:]))
        seen, codes, counts, illegal = set(), "", dict.fromkeys(("blank", "duplicate", "truncated"), 0), 0
        for i, (_, role, text) in enumerate(mine):
            last = text.strip(" \t\n\x0b\f\r")[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            initial = role[:1] if role[:1] in set("sua") else "?"
            codes += "-" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
            illegal += i > 0 and mine[i - 1][1][:1] + role[:1] not in ("su", "ua", "au")
        cost, audit = search(codes)
        lines, state, left = [], 0, iter(mine)
        for edit in audit:
            role, text = (ROLE[state], "") if edit == "I" else next(left)[1:]
            if edit != "D":
                role = ROLE[state] if edit == "R" else role
                lines.append(f"{role}:{text}")
                state = READ[state, role[0]]
        turns = {t for t, _, _ in mine if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv_id] = (gaps, *counts.values(), illegal, cost, audit, digest)
    return out


def got(df):
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r["conv_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def odd_rows():
    """Hot and NULL conversations, NULLs, ties, copies, empty and unknown roles, a long text."""
    rng = random.Random(9)
    texts = ["Yes.", "No", "", " \n", None, "Why?", "É bien", "ok!\t", "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    rows = [(rng.choice([1, 2, 3, 4, None]), rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)) for _ in range(150)]
    rows += [(7, t, ("user", "assistant")[t % 2], f"Turn {t}" + "." * (t % 3 > 0)) for t in range(90) if t % 17]
    rows += [(8, None, "user", "again.")] * 40
    rows += [(9, 0, "user", "long " * 100_000 + "end."), (9, 1, "assistant", "Done.")]
    return rows


@pytest.mark.parametrize("block_rows, block_chars, partitions", [(16_384, 8_000_000, 4), (5, 8_000_000, 4), (1, 1, 7)])
def test_repair_equals_brute_force(spark, conf, block_rows, block_chars, partitions):
    conf("spark.sql.shuffle.partitions", partitions)
    conf("spark.sql.adaptive.enabled", "false")
    rows = odd_rows()
    turns = spark.createDataFrame(rows, TURNS).withColumn("block", F.lit("x")).withColumn("part", F.lit(1))
    ids = spark.createDataFrame([(c,) for c in (1, 2, 3, 4, None, 7, 8, 9, 10, 10)], "conv_id long")
    pieces = R.repair(turns, ids, block_rows, block_chars)
    want = expected(rows, [1, 2, 3, 4, None, 7, 8, 9, 10])
    assert got(R.digests(pieces)) == want
    assert want[10] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_turns_are_returned(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Bye.")]
    (piece,) = R.repair(spark.createDataFrame(rows, TURNS)).collect()
    assert (piece["cost"], piece["audit"]) == search("a-u") == (7, "IKDKI")
    assert [tuple(t) for t in piece["turns"]] == [
        ("I", "user", ""),
        ("K", "assistant", "Hello."),
        ("K", "user", "Bye."),
        ("I", "assistant", ""),
    ]


def test_empty(spark):
    empty = spark.createDataFrame([], TURNS)
    assert R.digests(R.repair(empty, empty)).count() == 0
    assert R.repair(R.damaged(empty)).count() == 0


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", "A. b! c? d") for c in (*range(8), None) for t in (*range(8), None)]
    want = []
    for c, t, role, text in rows:
        way = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if way == 1 else "A b c d" if way == 2 else text
        want += [(c, t, "user" if way == 4 else role, text)] * (way != 0) * (1 + (way == 3))
    found = [tuple(r) for r in R.damaged(spark.createDataFrame(rows, TURNS)).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
