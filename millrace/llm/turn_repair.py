"""Conversation structure repair: the cheapest edits that give each conversation legal roles.

Rows are edited in order: kept (K, 0), given the role user or assistant (R, 2) or deleted (D, 3;
blank rows and those whose role and text were seen before must be); empty rows of user or assistant
can be inserted anywhere (I, 2). A truncated row that stays costs 1 more. The initials of the roles
must come out as `(s?(ua)+)?`. Of the cheapest edits those with the least string of initials are taken.

The cost of finishing, from each of the four states of that pattern, is a vector; its least entry put
aside, only a few dozen vectors exist. Four-Russians tables hold, for each of them and each block of
BLOCK symbols, the vector before the block and the cost put aside. A conversation is one symbol a
row, walked from its end by one lookup a block. The edits are then read from its start: each block's
vectors are found again from the one behind it, backwards, and at each row the least edit that is
on a cheapest way is taken. That is the least string, as every edit leads to one state only.

Conversations lie in runs (`segments`). A run's rows do for every vector at its end what the table
does for a block, so the runs of a long conversation are worked out apart, chained by a narrow scan
from the last to the first for the vectors and another one back for the states, and then repaired apart.
Only the digest of a whole conversation has to see its rows in turn; it is fed run by run.

NULL role or text counts as one space. Rows are ordered by turn (NULLs first), role and text; equal rows
are duplicates. Rows without a conversation id are one conversation. Texts of any length are whole.
Other columns are left out. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.rows import slices
from millrace.llm.segments import digest, pack, scan, split_groups
from millrace.session import stage

WHITE = " \t\n\x0b\x0c\r"
BLOCK = 4
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

# States: nothing yet, after s, after u, after a.
START, S, U, A = range(4)
INSERTED = (U, U, A, U)  # the state after an inserted or rerole'd row
ROLES = {U: "user", A: "assistant"}
KEPT = {(START, "s"): S, (START, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}

# Symbols: two for each initial (whole, truncated), a row that must go, no row.
INITIALS = "sua"
GONE, NONE = 2 * len(INITIALS) + 2, 2 * len(INITIALS) + 3
SYMBOLS = NONE + 1

# Faults of a row, by which counters go.
FINE, BLANK, DUPLICATE, CUT, ABSENT = range(5)


class Tables:
    """Vectors, and for each of them and each symbol or block the one before it and the cost put aside."""

    def __init__(self):
        self.vectors = [(0, 4, 2, 0)]  # at the end: a pair to insert after s, a row after u
        number = {self.vectors[0]: 0}
        self.before, self.aside = [], []
        for vector in self.vectors:  # grows in the loop
            for symbol in range(SYMBOLS):
                raw = self._back(vector, symbol)
                least = min(raw)
                normal = tuple(c - least for c in raw)
                if normal not in number:
                    number[normal] = len(self.vectors)
                    self.vectors.append(normal)
                self.before.append(number[normal])
                self.aside.append(least)
        one = np.array(self.before).reshape(-1, SYMBOLS)
        cost = np.array(self.aside).reshape(-1, SYMBOLS)
        blocks = np.array(list(product(range(SYMBOLS), repeat=BLOCK)))
        at = np.repeat(np.arange(len(self.vectors))[:, None], len(blocks), axis=1)
        total = np.zeros_like(at)
        for place in reversed(range(BLOCK)):
            total += cost[at, blocks[:, place]]
            at = one[at, blocks[:, place]]
        self.width = len(blocks)
        self.block_before, self.block_aside = at.ravel().tolist(), total.ravel().tolist()
        self.edits = {
            (state, v, x): self._least_edits(state, v, x)
            for state in range(4) for v in range(len(self.vectors)) for x in range(SYMBOLS)
        }

    @staticmethod
    def _ways(state: int, symbol: int) -> list[tuple[str, int, int]]:
        """(edit, cost, state after) of a row, but for inserts before it."""
        if symbol == NONE:
            return [("", 0, state)]
        ways = [("D", DELETE, state)]
        if symbol != GONE:
            extra = TRUNCATED if symbol % 2 else 0
            kept = KEPT.get((state, (INITIALS + "-")[symbol // 2]))
            if kept is not None:
                ways.append(("K", KEEP + extra, kept))
            ways.append(("R", REROLE + extra, INSERTED[state]))
        return ways

    def _back(self, vector: tuple, symbol: int) -> list[int]:
        raw = [min(cost + vector[after] for _, cost, after in self._ways(q, symbol)) for q in range(4)]
        for _ in range(3):  # inserts before the row
            raw = [min(c, INSERT + raw[INSERTED[q]]) for q, c in enumerate(raw)]
        return raw

    def _least_edits(self, state: int, v: int, symbol: int) -> tuple[str, int]:
        """The least edits on a cheapest way over a row, with `v` behind it, and the state after it."""
        raw, behind, edits = self._back(self.vectors[v], symbol), self.vectors[v], ""
        while True:
            ways = self._ways(state, symbol) + ([("I", INSERT, None)] if symbol != NONE else [])
            for edit, cost, after in sorted(ways):
                if edit == "I":
                    if raw[state] == cost + raw[INSERTED[state]]:
                        edits, state = edits + "I", INSERTED[state]
                        break
                elif raw[state] == cost + behind[after]:
                    return edits + edit, after

    def _blocks(self, symbols: bytes) -> list[int]:
        padded = np.frombuffer(symbols + bytes([NONE]) * (-len(symbols) % BLOCK), np.uint8).astype(np.int64)
        return (padded.reshape(-1, BLOCK) @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1)).tolist()

    def walk(self, symbols: bytes, end: int = 0) -> tuple[list[int], int]:
        """The vectors at the blocks' ends, in reverse, the last one before all; and the cost put aside."""
        vectors, total = [end], 0
        for block in reversed(self._blocks(symbols)):
            at = end * self.width + block
            total += self.block_aside[at]
            end = self.block_before[at]
            vectors.append(end)
        return vectors, total

    def trace(self, symbols: bytes, end: int = 0, state: int = START, last: bool = True) -> tuple[list[str], int, int]:
        """The edits at each row, with an entry for those after the last one, the state behind it, and the cost."""
        vectors, total = self.walk(symbols, end)
        total += self.vectors[vectors[-1]][state]
        edits: list[str] = []
        for n, begin in enumerate(range(0, len(symbols), BLOCK)):
            block, behind = symbols[begin : begin + BLOCK], [vectors[-2 - n]]
            for symbol in reversed(block[1:]):
                behind.append(self.before[behind[-1] * SYMBOLS + symbol])
            for symbol in block:
                edit, state = self.edits[state, behind.pop(), symbol]
                edits.append(edit)
        tail = ""
        while last and self.vectors[end][state]:
            tail, state = tail + "I", INSERTED[state]
        if not last:
            total -= self.vectors[end][state]
        return [*edits, tail], state, total


@lru_cache(maxsize=1)
def tables() -> Tables:
    """The tables, made once per Python worker."""
    return Tables()


def pack_turns(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: Column | None = None
) -> DataFrame:
    """Runs of the conversations' rows; rows that are `gone` hold the place of their conversation only."""
    text_, role_ = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (text, role))
    gone = F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))
    named = rows.select(
        F.col(conv_id).alias("conv_id"),
        F.when(~gone, F.col(turn)).alias("turn"),
        F.when(gone, "").otherwise(role_).alias("role"),
        F.when(gone, "").otherwise(text_).alias("text"),
        gone.alias("gone"),
    )
    bare = F.btrim("text", F.lit(WHITE))
    fault = (
        F.when(F.col("gone"), ABSENT).when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), CUT)
    ).otherwise(FINE)
    named = named.withColumn("fault", fault.cast("byte")).drop("gone")
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    return pack(named, "conv_id", order, ["turn", "role", "text", "fault"])


def _faults(row: dict) -> list[int]:
    """The first fault of each row, those seen earlier in the run or, by `again`, in a run before."""
    seen: set[tuple[str, str]] = set()
    faults, again = [], set(row.get("again") or ())
    for n, (role, text, fault) in enumerate(zip(row["role"], row["text"], row["fault"])):
        if fault in (FINE, CUT):
            if n in again or (role, text) in seen:
                fault = DUPLICATE
            seen.add((role, text))
        faults.append(fault)
    return faults


def _symbols(roles: list[str], faults: list[int]) -> bytes:
    fate = {BLANK: GONE, DUPLICATE: GONE, ABSENT: NONE}
    return bytes(
        fate.get(f, 2 * ((INITIALS.find(r[:1]) if r else -1) % (len(INITIALS) + 1)) + (f == CUT))
        for r, f in zip(roles, faults)
    )


def _repeated_across(parts: DataFrame) -> DataFrame:
    """(seg, again): places in a run of rows whose role and text an earlier run of the conversation has."""
    rows = parts.select("conv_id", "seg", F.posexplode(F.arrays_zip("role", "text", "fault")).alias("pos", "row"))
    rows = rows.where(F.col("row.fault").isin(FINE, CUT))
    key = F.to_json(F.struct("conv_id", "row.role", "row.text"))
    rows = rows.select("seg", "pos", F.md5(key.cast("binary")).alias("key"))
    first = rows.groupBy("key").agg(F.min("seg").alias("first"), F.max("seg").alias("last")).where("last > first")
    later = rows.join(first, "key").where("seg > first")
    return later.groupBy("seg").agg(F.collect_set("pos").alias("again"))


def _in_context(parts: DataFrame) -> DataFrame:
    """The runs of split conversations with the rows seen before, the vector behind, the state before and whether it is the last."""

    def functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = []
            for row in part.to_pylist():
                symbols = _symbols(row["role"], _faults(row))
                walks = [tables().walk(symbols, v)[0][-1] for v in range(len(tables().vectors))]
                found.append({"conv_id": row["conv_id"], "seg": row["seg"], "symbols": symbols, "before": walks})
            yield pa.RecordBatch.from_pylist(found, pa.schema([
                part.schema.field("conv_id"), ("seg", pa.int64()), ("symbols", pa.binary()), ("before", pa.list_(pa.int32()))
            ]))

    def behind(last: dict | None, row: dict) -> dict:
        end = last["left"] if last else 0
        return {"seg": row["seg"], "behind": end, "left": row["before"][end], "last": last is None}

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = []
            for row in part.to_pylist():
                ends = [tables().trace(row["symbols"], row["behind"], q, False)[1] for q in range(4)]
                found.append({"conv_id": row["conv_id"], "seg": row["seg"], "ends": ends})
            yield pa.RecordBatch.from_pylist(found, pa.schema([
                part.schema.field("conv_id"), ("seg", pa.int64()), ("ends", pa.list_(pa.int32()))
            ]))

    def entry(last: dict | None, row: dict) -> dict:
        state = last["after"] if last else START
        return {"seg": row["seg"], "state": state, "after": row["ends"][state]}

    id_type = parts.schema["conv_id"].dataType.simpleString()
    parts = parts.join(stage(_repeated_across(parts)), "seg", "left")
    walked = stage(parts.mapInArrow(functions, f"conv_id {id_type}, seg long, symbols binary, before array<int>"))
    right = stage(scan(walked.drop("symbols"), "conv_id", behind, "seg long, behind long, left long, last boolean", down=True))
    ends = walked.join(right, "seg").mapInArrow(exits, f"conv_id {id_type}, seg long, ends array<int>")
    states = stage(scan(ends, "conv_id", entry, "seg long, state long, after long"))
    return parts.join(right.select("seg", "behind", "last"), "seg").join(states.select("seg", "state"), "seg")


REPAIRED = (
    "seg long, alone boolean, audit string, roles array<string>, texts array<string>, cost long, "
    "blank long, duplicate long, truncated long, illegal long, first_turn {0}, last_turn {0}, n_turns long, "
    "first_initial string, last_initial string"
)
LEGAL = {"su", "ua", "au"}


def _repair_run(row: dict) -> dict:
    faults = _faults(row)
    symbols = _symbols(row["role"], faults)
    state = row["state"]
    edits, _, cost = tables().trace(symbols, row["behind"], state, row["last"])
    roles, texts = [], []
    for edit, role, text in zip(edits, [*row["role"], ""], [*row["text"], ""]):
        for e in edit:
            if e == "K":
                state = KEPT[state, role[:1]]
                roles.append(role)
                texts.append(text)
            elif e != "D":
                state = INSERTED[state]
                roles.append(ROLES[state])
                texts.append(text if e == "R" else "")
    here = [n for n, f in enumerate(faults) if f != ABSENT]
    initials = [row["role"][n][:1] for n in here]
    turns = [row["turn"][n] for n in here if row["turn"][n] is not None]
    return {
        "conv_id": row["conv_id"], "seg": row["seg"], "alone": row["alone"], "audit": "".join(edits),
        "roles": roles, "texts": texts, "cost": cost,
        "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(CUT),
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
        "n_turns": sum(a != b for a, b in zip([None, *turns], turns)),
        "first_initial": initials[0] if initials else None, "last_initial": initials[-1] if initials else None,
    }


def repair(packed: DataFrame) -> DataFrame:
    """The runs of `pack_turns`, repaired: initials of the edits, new roles and texts, counts and costs.

    `alone` runs are whole conversations. `packed` is read more than once and should be staged.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            typed = {"conv_id": part.schema.field("conv_id").type}
            turn = part.schema.field("turn").type.value_type
            typed |= {"first_turn": turn, "last_turn": turn}
            found = [_repair_run(row) for row in part.to_pylist()]
            yield pa.record_batch(
                [pa.array([r[n] for r in found], typed.get(n) or types[n]) for n in names], names=names
            )

    turn_type = packed.schema["turn"].dataType.elementType.simpleString()
    schema = f"conv_id {packed.schema['conv_id'].dataType.simpleString()}, " + REPAIRED.format(turn_type)
    string, number = pa.string(), pa.int64()
    types = {"alone": pa.bool_(), "audit": string, "roles": pa.list_(string), "texts": pa.list_(string)}
    types |= {"first_initial": string, "last_initial": string}
    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    types = {n: types.get(n, number) for n in names}

    split = stage(split_groups(packed, "conv_id")).withColumnRenamed("conv_id", "split_id")
    same = packed["conv_id"].eqNullSafe(split["split_id"])
    plain = packed.join(split, same, "left_anti").select(
        "*", F.lit(None).cast("array<int>").alias("again"), F.lit(0).cast("long").alias("behind"),
        F.lit(True).alias("last"), F.lit(START).cast("long").alias("state"), F.lit(True).alias("alone"),
    )
    parts = _in_context(packed.join(split, same, "left_semi")).withColumn("alone", F.lit(False))
    return plain.mapInArrow(run, schema).unionByName(stage(parts.mapInArrow(run, schema)))


def repaired_turns(repaired: DataFrame) -> DataFrame:
    """(conv_id, seg, pos, role, text): the repaired rows, in the order of seg and pos."""
    rows = repaired.select("conv_id", "seg", F.posexplode(F.arrays_zip("roles", "texts")).alias("pos", "row"))
    return rows.select("conv_id", "seg", "pos", F.col("row.roles").alias("role"), F.col("row.texts").alias("text"))


def report(repaired: DataFrame) -> DataFrame:
    """A row for each conversation: gaps, faults, cost, the edits' initials, and the digest of `role:text` lines."""
    lines = F.zip_with("roles", "texts", lambda role, text: F.concat(role, F.lit(":"), text))
    repaired = repaired.withColumn("body", F.array_join(lines, "\n")).drop("texts")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0)).cast("long")
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    alone = repaired.where("alone").select(
        "conv_id", gaps.alias("gaps"), *counts, "audit", F.sha2("body", 256).alias("repaired_sha256")
    )
    parts = repaired.where("NOT alone")
    before = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    last_turn, last_initial = (F.last(c, ignorenulls=True).over(before) for c in ("last_turn", "last_initial"))
    meeting = F.concat(last_initial, F.col("first_initial"))
    joined = parts.select(
        "conv_id", "seg", *counts, "audit", "first_turn", "last_turn", "n_turns",
        F.coalesce((last_turn == F.col("first_turn")).cast("long"), F.lit(0)).alias("same_turn"),
        F.when(meeting.isNull() | meeting.isin(*LEGAL), 0).otherwise(1).alias("meeting"),
    ).groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in counts], F.sum("meeting").alias("meeting"),
        F.min("first_turn").alias("first_turn"), F.max("last_turn").alias("last_turn"),
        (F.sum("n_turns") - F.sum("same_turn")).alias("n_turns"),
        F.array_join(F.sort_array(F.collect_list(F.struct("seg", "audit")))["audit"], "").alias("audit"),
    )
    joined = joined.withColumn("illegal", F.col("illegal") + F.col("meeting"))
    joined = joined.select("conv_id", gaps.alias("gaps"), *counts, "audit")
    bodies = parts.withColumn("body", F.when(F.size("roles") > 0, F.col("body")))
    digests = digest(bodies, "conv_id", "body", "\n", name="repaired_sha256").withColumnRenamed("conv_id", "digest_id")
    whole = joined.join(digests, joined["conv_id"].eqNullSafe(digests["digest_id"])).drop("digest_id")
    return alone.unionByName(whole)

