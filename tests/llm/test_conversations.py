from __future__ import annotations

import hashlib
import random
import re
from functools import lru_cache

import pytest

from shopledger.llm import conversations as repair
from shopledger.llm import queries
from shopledger.llm.oracle import ORACLE
from tools.compare import differences, oracle_connection

LEGAL = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_faults(rows: list[tuple[str, str]]) -> list[str]:
    out = []
    for at, (role, text) in enumerate(rows):
        seen = [ch for ch in text if ch not in " \t\n\v\f\r"]
        if not seen:
            out.append("blank")
        elif (role, text) in rows[:at]:
            out.append("duplicate")
        else:
            out.append("" if seen[-1] in ".!?" else "truncated")
    return out


def plain_repair(rows: list[tuple[str, str]]) -> tuple[int, str, list[str]]:
    """The least (cost, letters) with their lines, forward over all edits."""
    faults = plain_faults(rows)

    @lru_cache(maxsize=None)
    def best(at: int, initials: str, inserted: int) -> tuple:
        """From a turn on; ``initials`` is what was put out, shortened."""
        found = []
        if at == len(rows) and LEGAL.fullmatch(initials):
            found.append((0, "", ()))
        if inserted < 3:
            for role in ("user", "assistant"):
                if possible(initials + role[0]):
                    rest = best(at, short(initials + role[0]), inserted + 1)
                    found.append((2 + rest[0], "I" + rest[1], (f"{role}:", *rest[2])))
        if at < len(rows):
            role, text = rows[at]
            rest = best(at + 1, initials, 0)
            found.append((3 + rest[0], "D" + rest[1], rest[2]))
            if faults[at] not in ("blank", "duplicate"):
                extra = faults[at] == "truncated"
                for new, letter, cost in ((role, "K", 0), ("user", "R", 2), ("assistant", "R", 2)):
                    if possible(initials + new[:1]) and new:
                        rest = best(at + 1, short(initials + new[0]), 0)
                        line = f"{new}:{text}"
                        found.append((cost + extra + rest[0], letter + rest[1], (line, *rest[2])))
        return min(found, default=(1 << 30, "", ()))

    cost, letters, lines = best(0, "", 0)
    return cost, letters, list(lines)


def possible(initials: str) -> bool:
    return any(LEGAL.fullmatch(initials + more) for more in ("", "a", "ua"))


def short(initials: str) -> str:
    """The same choices from here on, in few letters."""
    return initials if len(initials) < 4 else initials[: 1 + initials.count("s")] + (
        "a" if initials[-1] == "a" else "au"
    )


def test_least_edits_by_brute_force():
    rng = random.Random(4)
    for _ in range(400):
        rows = [
            (rng.choice(["user", "assistant", "system", "tool", "", "u2"]), rng.choice(["a.", "b", " ", "", "c!", "d?"]))
            for _ in range(rng.randint(0, 7))
        ]
        found = repair.solved(list(range(len(rows))), [r for r, _ in rows], [t for _, t in rows])
        lines = [f"{r}:{t}" for r, t in zip(found["roles"], found["texts"])]
        assert (found["cost"], found["edits"], lines) == plain_repair(rows), rows
        assert LEGAL.fullmatch("".join(r[0] for r in found["roles"]))


def test_pieces_give_the_walk_of_the_whole():
    rng = random.Random(8)
    for _ in range(200):
        codes = [4 * rng.randrange(4) + rng.randrange(4) for _ in range(rng.randint(1, 60))]
        cut = rng.randint(0, len(codes))
        head, tail = codes[:cut], codes[cut:]
        after = repair.through(repair.table_of(tail), repair.END)
        assert after == repair.backward(tail, repair.END)
        first, state = repair.walk(head, after, repair.NOTHING)
        second, last = repair.walk(tail, repair.END, state)
        assert (first + second, last) == repair.walk(codes, repair.END, repair.NOTHING)


def turns_of(seed: int, conversations: int, most: int) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for key in range(conversations):
        for _ in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool"])
            turn = rng.choice([None, *range(12)])
            out.append((key, turn, role, rng.choice(["A.", "b", "", " \n", "c?", "d é!", "e "])))
    return out


def flat(found: repair.Repaired) -> dict:
    """Per key: report, edits, lines."""
    out = {}
    for row in found.whole.collect():
        lines = [f"{r}:{t}" for r, t in zip(row.roles, row.texts)]
        out[row.key] = ([row[n] for n in repair.REPORT_NAMES], row.edits, lines)
    reports = {row.key: [row[n] for n in repair.REPORT_NAMES] for row in found.long_report.collect()}
    for row in found.long_pieces.orderBy("piece").collect():
        if row.key in reports:
            out[row.key] = (reports.pop(row.key), "", [])
        report, edits, lines = out[row.key]
        lines += [f"{r}:{t}" for r, t in zip(row.roles, row.texts)]
        out[row.key] = (report, edits + row.edits, lines)
    assert not reports
    return out


def plain_all(rows: list[tuple]) -> dict:
    out = {}
    for key in {row[0] for row in rows}:
        own = [(t, r or "", x or "") for k, t, r, x in rows if k == key]
        digest = {x: hashlib.sha256(x.encode()).hexdigest() for _, _, x in own}
        own.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1], digest[row[2]]))
        pairs = [(r, x) for _, r, x in own]
        faults = plain_faults(pairs)
        known = [t for t, _, _ in own if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [r[:1] for r, _ in pairs]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        found = repair.solved([t for t, _, _ in own], [r for r, _ in pairs], [x for _, x in pairs])
        lines = [f"{r}:{t}" for r, t in zip(found["roles"], found["texts"])]
        counts = [faults.count(name) for name in ("blank", "duplicate", "truncated")]
        out[key] = ([gaps, *counts, illegal, found["cost"]], found["edits"], lines)
    return out


@pytest.mark.parametrize("most_turns", [2, 5, 65_536])
def test_tasks_and_pieces_do_not_show(spark, tmp_path, most_turns):
    rows = turns_of(most_turns, 40, 15) + [(None, 1, "user", "x."), (None, None, None, None)]
    rows += [(99, 3, "user", "again.")] * 25 + [(98, t, "user", "a.") for t in range(60)]
    found = repair.repair(
        spark.createDataFrame(rows, SCHEMA).repartition(3), str(tmp_path), most_turns=most_turns
    )
    assert flat(found) == plain_all(rows)
    digests = {row.key: row for row in repair.line_digests(found.long_pieces).collect()}
    whole = flat(found)
    for key, row in digests.items():
        assert row.edits == whole[key][1]
        assert row.sha256 == hashlib.sha256("\n".join(whole[key][2]).encode()).hexdigest()


def test_a_conversation_of_a_third_of_all_turns_is_split(spark, conf, tmp_path):
    conf(adaptive__coalescePartitions__enabled="false", shuffle__partitions="8")
    rows = [(7, 5, "user", "the same.")] * 3000 + turns_of(1, 800, 14)
    found = repair.repair(spark.createDataFrame(rows, SCHEMA), str(tmp_path), most_turns=500)
    pieces = found.long_pieces.filter("key = 7").select("piece", "roles", "edits").collect()
    assert len(pieces) >= 6 and max(len(row.edits) for row in pieces) <= 502
    assert flat(found)[7] == plain_all(rows)[7]


def test_empty_table_and_other_columns(spark, tmp_path):
    schema = "c string, t int, r string, x string, `key` string, `piece` long, `a b` long"
    columns = repair.Columns("c", "t", "r", "x")
    some = spark.createDataFrame([("q", 1, "user", "y" * 300_000 + ".", "k", 1, 2)], schema)
    found = repair.repair(some, f"{tmp_path}/a", columns, most_bytes=1000)
    assert flat(found) == {
        "q": ([0, 0, 0, 0, 0, 2], "KI", [f"user:{'y' * 300_000}.", "assistant:"])
    }
    assert flat(repair.repair(some.limit(0), f"{tmp_path}/b", columns)) == {}


def test_same_rows_as_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = oracle_connection(folder)
    found = queries.QUERIES["op12_conversation_repair"](spark, folder)
    assert differences(found, con, ORACLE["op12_conversation_repair"]) is None


def test_query_on_nulls_and_dropped_conversations(spark, tmp_path):
    rows = turns_of(3, 60, 9) + [(None, t, r, x) for t in range(9) for r, x in ((None, "a"), ("user", None))]
    rows += [(1000 + k, t, "user", "b.") for k in range(80) for t in (0,)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.QUERIES["op12_conversation_repair"](spark, str(tmp_path))
    con = oracle_connection("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW conversations AS FROM read_parquet('{tmp_path}/conversations.parquet/part-*')")
    assert differences(found, con, ORACLE["op12_conversation_repair"]) is None
    empty = hashlib.sha256(b"").hexdigest()
    assert found.filter((found.audit == "") & (found.repaired_sha256 == empty)).count() > 0
