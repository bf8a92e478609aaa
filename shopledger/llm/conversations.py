"""Repair of conversation structure by a square-root checkpointed dynamic programme.

A conversation's roles shall read ``(s?(ua)+)?`` by their initials: nothing, or an optional
system turn and then user and assistant in turns. Four states say what has been put out:
nothing, a system turn, a user turn, an assistant turn. The cheapest cost from each state
to the end is a vector that is stepped backwards over the turns and stored at every
sqrt(n)-th turn only. Walking forward, the vectors of one block at a time are computed
anew from the checkpoint behind it, and of the edits that are on a cheapest way ("tight")
the least letter is taken: D < I < K < R.

Turns are ranged by conversation and order, so that a task holds whole conversations and
solves them as it reads them. What may go on in another task, or is long, is left over in
pieces. A piece's own costs are a 4 x 4 table, so pieces are steps like turns are: their
tables give the vector behind each piece, a walk from each entry state gives its exit
states, and following those picks one walk. A conversation of any share of all turns is
thus worked on by many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.sources.staging import stage

Vector = tuple[int, int, int, int]

# States, by what was put out last. A conversation may end in NOTHING or ASSISTANT.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)

# The state that an inserted or reroled turn leads to, by state, and the role it has.
NEXT = (USER, USER, ASSISTANT, USER)
NEXT_ROLE = ("user", "user", "assistant", "user")

# Initials as numbers; all others are 0. KEPT is the state that a kept turn leads to.
INITIALS = {"s": 1, "u": 2, "a": 3}
KEPT = (
    (None, SYSTEM, USER, None),
    (None, None, USER, None),
    (None, None, None, ASSISTANT),
    (None, None, USER, None),
)
LEGAL = {(1, 2), (2, 3), (3, 2)}

# Faults. A turn's code is 4 * fault + initial.
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)

# The costs of edits, and of keeping or reroling a truncated turn.
DELETE, INSERT, REROLE, KEPT_TRUNCATED = 3, 2, 2, 1

FAR = 1 << 50

# Cost from each state where no turn is left: missing turns are inserted.
END: Vector = (0, 2 * INSERT, INSERT, 0)
END_EDITS = ("", "II", "I", "")

STRINGS = pa.list_(pa.string())

SPACE = " \t\n\v\f\r"


@dataclass(frozen=True)
class Columns:
    """The columns that are read; all others are ignored."""

    key: str = "conv_id"
    turn: str = "turn"
    role: str = "role"
    text: str = "text"


def own_fault(text: str) -> int:
    """The fault a text shows by itself."""
    rest = text.rstrip(SPACE)
    if not rest:
        return BLANK
    return FINE if rest[-1] in ".!?" else TRUNCATED


def code_of(role: str, fault: int) -> int:
    return 4 * fault + INITIALS.get(role[:1], 0)


def identity(role: str, text: str) -> bytes:
    raw = role.encode()
    return hashlib.sha256(b"%d:%b%b" % (len(raw), raw, text.encode())).digest()


def step(code: int, after: Vector) -> Vector:
    """The costs before a turn, from those behind it."""
    fault, initial = code >> 2, code & 3
    found = [DELETE + cost for cost in after]
    if fault < BLANK:
        extra = KEPT_TRUNCATED if fault == TRUNCATED else 0
        for state in range(4):
            kept = KEPT[state][initial]
            best = extra + REROLE + after[NEXT[state]]
            if kept is not None:
                best = min(best, extra + after[kept])
            if best < found[state]:
                found[state] = best
    nothing, system, user, assistant = found
    user, assistant = min(user, INSERT + assistant), min(assistant, INSERT + user)
    return min(nothing, INSERT + user), min(system, INSERT + user), user, assistant


def backward(codes: Sequence[int], after: Vector) -> Vector:
    for code in reversed(codes):
        after = step(code, after)
    return after


def table_of(codes: Sequence[int]) -> list[int]:
    """Costs from each state before the turns to each state behind them, row by row."""
    ends = [
        backward(codes, tuple(0 if state == end else FAR for state in range(4)))
        for end in range(4)
    ]
    return [min(FAR, ends[end][state]) for state in range(4) for end in range(4)]


def through(table: Sequence[int], after: Vector) -> Vector:
    """``backward`` over the turns of a table."""
    return tuple(min(table[4 * s + e] + after[e] for e in range(4)) for s in range(4))


def walk(codes: Sequence[int], after: Vector, state: int) -> tuple[str, int]:
    """(least letters of the cheapest edits, state behind them) from a state on.

    Memory beside the codes and letters is the vectors of sqrt(n) checkpoints and of one
    block of sqrt(n) turns.
    """
    size = len(codes)
    block = isqrt(size) + 1
    marks, vector = {size: after}, after
    for at in range(size - 1, -1, -1):
        vector = step(codes[at], vector)
        if at % block == 0:
            marks[at] = vector
    edits = []
    for low in range(0, size, block):
        high = min(low + block, size)
        vectors = [marks[high]]
        for at in range(high - 1, low - 1, -1):
            vectors.append(step(codes[at], vectors[-1]))
        vectors.reverse()
        for at in range(low, high):
            here, behind = vectors[at - low], vectors[at - low + 1]
            fault, initial = codes[at] >> 2, codes[at] & 3
            extra = KEPT_TRUNCATED if fault == TRUNCATED else 0
            while True:
                cost = here[state]
                if cost == DELETE + behind[state]:
                    edits.append("D")
                    break
                if cost == INSERT + here[NEXT[state]]:
                    edits.append("I")
                    state = NEXT[state]
                    continue
                kept = KEPT[state][initial]
                if kept is not None and cost == extra + behind[kept]:
                    edits.append("K")
                    state = kept
                else:
                    edits.append("R")
                    state = NEXT[state]
                break
    return "".join(edits), state


def replay(
    edits: str, state: int, roles: Sequence[str], texts: Sequence[str]
) -> tuple[list[str], list[str]]:
    """Roles and texts after the edits, beginning in a state."""
    new_roles, new_texts, at = [], [], 0
    for letter in edits:
        if letter == "D":
            at += 1
            continue
        if letter == "K":
            role = roles[at]
            state = KEPT[state][INITIALS[role[:1]]]
        else:
            role, state = NEXT_ROLE[state], NEXT[state]
        new_roles.append(role)
        if letter == "I":
            new_texts.append("")
        else:
            new_texts.append(texts[at])
            at += 1
    return new_roles, new_texts


# Counts of a conversation or piece, beside its turns' range.
COUNTS = ("blank", "duplicate", "truncated", "illegal")


def counts_of(turns: Sequence[int | None], codes: Sequence[int]) -> dict[str, int | None]:
    """Counts of faults and illegal neighbours, and what gaps are found from."""
    known = [turn for turn in turns if turn is not None]
    faults = [code >> 2 for code in codes]
    initials = [code & 3 for code in codes]
    return {
        "blank": faults.count(BLANK),
        "duplicate": faults.count(DUPLICATE),
        "truncated": faults.count(TRUNCATED),
        "illegal": sum(pair not in LEGAL for pair in zip(initials, initials[1:])),
        "low": known[0] if known else None,
        "high": known[-1] if known else None,
        "different": sum(a != b for a, b in zip(known, known[1:])) + bool(known),
    }


def gaps_of(counts: dict[str, int | None]) -> int:
    if counts["low"] is None:
        return 0
    return counts["high"] - counts["low"] + 1 - counts["different"]


REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
REPORT_NAMES = [part.split()[0] for part in REPORT.split(", ")]


def solved(turns: Sequence[int | None], roles: Sequence[str], texts: Sequence[str]) -> dict:
    """A whole conversation's report, edits and repaired turns."""
    codes, seen = [], set()
    for role, text in zip(roles, texts):
        fault = own_fault(text)
        if fault != BLANK:
            name = identity(role, text)
            if name in seen:
                fault = DUPLICATE
            seen.add(name)
        codes.append(code_of(role, fault))
    counts = counts_of(turns, codes)
    edits, state = walk(codes, END, NOTHING)
    edits += END_EDITS[state]
    new_roles, new_texts = replay(edits, NOTHING, roles, texts)
    return {name: counts[name] for name in COUNTS} | {
        "gaps": gaps_of(counts),
        "cost": backward(codes, END)[NOTHING],
        "edits": edits,
        "roles": new_roles,
        "texts": new_texts,
    }


class _Packer:
    """Packs a task's turns, which come in order, into conversations and pieces."""

    def __init__(self, key_type: pa.DataType, most_turns: int, most_bytes: int):
        self.most_turns, self.most_bytes = most_turns, most_bytes
        self.schema = pa.schema(
            [("piece", pa.int64()), ("key", key_type)]
            + [(name, pa.int64()) for name in REPORT_NAMES]
            + [("edits", pa.string()), ("turns", pa.list_(pa.int64()))]
            + [("roles", STRINGS), ("texts", STRINGS)]
        )
        self.key, self.begun, self.whole = None, False, False
        self.out, self.out_bytes = [], 0
        self._clear()

    def _clear(self) -> None:
        self.places, self.turns, self.roles, self.texts, self.bytes = [], [], [], [], 0

    def _put_piece(self) -> None:
        if self.places:
            self._put({"turns": self.turns, "roles": self.roles, "texts": self.texts})

    def _put(self, row: dict) -> None:
        self.out.append({"piece": self.places[0], "key": self.key} | row)
        self.out_bytes += self.bytes
        self._clear()

    def add(self, key, place: int, turn: int | None, role: str, text: str) -> None:
        if not self.begun or key != self.key:
            if self.whole:
                self._put(solved(self.turns, self.roles, self.texts))
            else:
                self._put_piece()
            # The first conversation may have begun in the task before.
            self.key, self.whole, self.begun = key, self.begun, True
        elif len(self.places) >= self.most_turns or self.bytes >= self.most_bytes:
            self.whole = False
            self._put_piece()
        self.places.append(place)
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(role) + len(text) + 64

    def batches(self, at_least: int) -> Iterator[pa.RecordBatch]:
        if self.out and self.out_bytes >= at_least:
            yield pa.RecordBatch.from_pylist(self.out, self.schema)
            self.out, self.out_bytes = [], 0

    def end(self) -> Iterator[pa.RecordBatch]:
        # The last conversation may go on in the next task.
        self._put_piece()
        yield from self.batches(0)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.DataType]]:
    """Rows one by one, with the type of their key."""
    for batch in batches:
        key_type = batch.schema.field("key").type
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0], key_type


def _batch(row: dict, key_type: pa.DataType, **types: pa.DataType) -> pa.RecordBatch:
    """One row with the columns piece, key and those of ``types``."""
    named = [("piece", pa.int64()), ("key", key_type), *types.items()]
    return pa.RecordBatch.from_pylist([row], pa.schema(named))


@dataclass(frozen=True)
class Repaired:
    """``whole``: key, report columns, edits, roles, texts of each conversation that one
    task held. ``long_report`` (key and report columns) and ``long_pieces`` (piece, key,
    edits, roles, texts; in the order of ``piece``) describe the others."""

    whole: DataFrame
    long_report: DataFrame
    long_pieces: DataFrame


def repair(
    turns: DataFrame,
    folder: str,
    columns: Columns = Columns(),
    *,
    most_turns: int = 65_536,
    most_bytes: int = 8 << 20,
) -> Repaired:
    """Faults, cheapest edits and repaired turns of every conversation.

    Turns are taken by ``turn``, nulls first; equal ones by role, then by the SHA-256 of
    their text. A null role or text counts as empty; a null key is a conversation of its
    own; repeated rows are duplicates. A turn is blank without a character beyond white
    space, else a duplicate if role and text occurred before, else truncated if the last
    such character is none of ``.!?``. An empty table gives empty results. A piece has at
    most ``most_turns`` turns, and ends after the turn that brings it to ``most_bytes``.
    """
    text = F.coalesce(F.col(columns.text), F.lit(""))
    order = [
        F.col("key"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("name"), F.col("copy")
    ]
    # The last key lets equal rows of one turn go to several tasks.
    ranged = (
        turns.select(
            F.col(columns.key).alias("key"),
            F.col(columns.turn).cast("long").alias("turn"),
            F.coalesce(F.col(columns.role), F.lit("")).alias("role"),
            text.alias("text"),
            F.sha2(text, 256).alias("name"),
            F.monotonically_increasing_id().alias("copy"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("key", "turn", "role", "text", F.monotonically_increasing_id().alias("place"))
    )
    kind = ranged.schema["key"].dataType.simpleString()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = None
        for batch in batches:
            if packer is None:
                packer = _Packer(batch.schema.field("key").type, most_turns, most_bytes)
            found = [batch.column(c).to_pylist() for c in ("key", "place", "turn", "role", "text")]
            for row in zip(*found):
                packer.add(*row)
                yield from packer.batches(4 << 20)
        if packer is not None:
            yield from packer.end()

    dealt = stage(
        ranged.mapInArrow(
            deal,
            f"piece bigint, key {kind}, {REPORT}, edits string, turns array<bigint>, "
            "roles array<string>, texts array<string>",
        ),
        folder,
        "dealt",
    )
    whole = dealt.filter("edits is not null").select("key", *REPORT_NAMES, "edits", "roles", "texts")
    pieces = dealt.filter("edits is null").select("piece", "key", "turns", "roles", "texts")
    report, repaired = _long(pieces, folder, kind)
    return Repaired(whole, report, repaired)


def _coded(pieces: DataFrame, folder: str, kind: str) -> DataFrame:
    """(piece, key, turns, codes) of every piece.

    Whether a turn is the first of its kind is an aggregate over the conversation's turn
    names; it comes back to the turn by its place, which no other turn has.
    """

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, key_type in _rows(batches):
            piece, roles, texts = row["piece"], row["roles"], row["texts"]
            codes = map(code_of, roles, map(own_fault, texts))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([piece] * len(roles), pa.int64()),
                    pa.array([row["key"]] * len(roles), key_type),
                    pa.array(range(piece, piece + len(roles)), pa.int64()),
                    pa.array(codes, pa.int32()),
                    pa.array(map(identity, roles, texts), pa.binary()),
                ],
                ["piece", "key", "place", "code", "name"],
            )

    turns = pieces.select("piece", "key", "roles", "texts").mapInArrow(
        named, f"piece bigint, key {kind}, place bigint, code int, name binary"
    )
    first = turns.groupBy("key", "name").agg(F.min("place").alias("place")).select(
        "place", F.lit(True).alias("first")
    )
    repeated = F.col("first").isNull() & (F.shiftright("code", 2) != BLANK)
    code = F.when(repeated, 4 * DUPLICATE + F.col("code") % 4).otherwise(F.col("code"))
    codes = (
        turns.select("piece", "place", "code")
        .join(first, "place", "left")
        .groupBy("piece")
        .agg(F.sort_array(F.collect_list(F.struct("place", code.alias("code")))).alias("codes"))
        .select("piece", F.col("codes.code").alias("codes"))
    )
    return stage(
        pieces.select("piece", "key", "turns").join(codes, "piece"), folder, "coded"
    )


def _long(pieces: DataFrame, folder: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """(report, repaired pieces) of conversations in pieces.

    Of a conversation in one task there is never more than a row a piece, without texts.
    """
    coded = _coded(pieces, folder, kind)
    whole, many = pa.int64(), pa.list_(pa.int64())
    counted = (*COUNTS, "low", "high", "different", "head", "tail")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, key_type in _rows(batches):
            codes = row["codes"]
            found = row | counts_of(row["turns"], codes) | {
                "head": codes[0] & 3, "tail": codes[-1] & 3, "costs": table_of(codes)
            }
            yield _batch(found, key_type, **dict.fromkeys(counted, whole), costs=many)

    columns = ", ".join(f"{name} bigint" for name in counted)
    sums = coded.mapInArrow(summed, f"piece bigint, key {kind}, {columns}, costs array<bigint>")

    def joined(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda row: row["piece"])
        after, out = END, []
        for row in reversed(rows):
            out.append({"piece": row["piece"], "key": row["key"], "after": after, "last": not out})
            after = through(row["costs"], after)
        total = {name: sum(row[name] for row in rows) for name in (*COUNTS, "different")}
        for a, b in zip(rows, rows[1:]):
            total["illegal"] += (a["tail"], b["head"]) not in LEGAL
        known = [row for row in rows if row["low"] is not None]
        total["different"] -= sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
        total["low"] = known[0]["low"] if known else None
        total["high"] = known[-1]["high"] if known else None
        out[-1] |= {n: total[n] for n in COUNTS} | {"gaps": gaps_of(total), "cost": after[NOTHING]}
        types = [("piece", whole), ("key", group.schema.field("key").type), ("after", many)]
        types += [("last", pa.bool_())] + [(name, whole) for name in REPORT_NAMES]
        return pa.Table.from_pylist(out, pa.schema(types))

    ends = stage(
        sums.groupBy("key").applyInArrow(
            joined, f"piece bigint, key {kind}, after array<bigint>, last boolean, {REPORT}"
        ),
        folder,
        "ends",
    )

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, key_type in _rows(batches):
            ways = [walk(row["codes"], tuple(row["after"]), state) for state in range(4)]
            found = row | {"ways": [way[0] for way in ways], "exits": [way[1] for way in ways]}
            yield _batch(found, key_type, ways=STRINGS, exits=many)

    ways = stage(
        coded.select("piece", "key", "codes")
        .join(ends.select("piece", "after"), "piece")
        .mapInArrow(walked, f"piece bigint, key {kind}, ways array<string>, exits array<bigint>"),
        folder,
        "ways",
    )

    def followed(group: pa.Table) -> pa.Table:
        state, out = NOTHING, []
        for row in sorted(group.to_pylist(), key=lambda row: row["piece"]):
            out.append({"piece": row["piece"], "entry": state})
            state = row["exits"][state]
        return pa.Table.from_pylist(out, pa.schema([("piece", whole), ("entry", whole)]))

    entries = (
        ways.select("piece", "key", "exits")
        .groupBy("key")
        .applyInArrow(followed, "piece bigint, entry bigint")
    )

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, key_type in _rows(batches):
            state = row["entry"]
            edits = row["ways"][state]
            if row["last"]:
                edits += END_EDITS[row["exits"][state]]
            roles, texts = replay(edits, state, row["roles"], row["texts"])
            found = row | {"edits": edits, "roles": roles, "texts": texts}
            yield _batch(found, key_type, edits=pa.string(), roles=STRINGS, texts=STRINGS)

    chosen = ways.drop("key").join(entries, "piece").join(ends.select("piece", "last"), "piece")
    out = (
        pieces.drop("turns")
        .join(chosen, "piece")
        .mapInArrow(
            repaired,
            f"piece bigint, key {kind}, edits string, roles array<string>, texts array<string>",
        )
    )
    return ends.filter("cost is not null").select("key", *REPORT_NAMES), out


def line_digests(pieces: DataFrame) -> DataFrame:
    """(key, edits, sha256) of conversations in pieces.

    The digest is that of the lines ``role:text``. It can only be made from first to last,
    so a conversation's pieces go through one task, one after the other; the task holds
    one piece and the letters.
    """
    kind = pieces.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, type_, digest, edits, lines = None, None, None, [], 0

        def row() -> pa.RecordBatch:
            columns = [pa.array([key], type_), ["".join(edits)], [digest.hexdigest()]]
            return pa.RecordBatch.from_arrays(
                [columns[0], *(pa.array(c, pa.string()) for c in columns[1:])],
                ["key", "edits", "sha256"],
            )

        for found, type_ in _rows(batches):
            if digest is None or found["key"] != key:
                if digest is not None:
                    yield row()
                key, digest, edits, lines = found["key"], hashlib.sha256(), [], 0
            edits.append(found["edits"])
            for role, text in zip(found["roles"], found["texts"]):
                digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                lines += 1
        if digest is not None:
            yield row()

    return (
        pieces.repartition("key")
        .sortWithinPartitions("key", "piece")
        .mapInArrow(run, f"key {kind}, edits string, sha256 string")
    )
