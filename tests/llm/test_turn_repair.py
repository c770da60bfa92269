"""Repaired conversations against a plain search over all edits, whole and cut into many runs."""

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import queries, turn_repair
from millrace.llm.turn_repair import ABSENT, BLANK, CUT, DUPLICATE, FINE
from conftest import rows

LEGAL = re.compile(r"(s?(ua)+)?")
NEXT = {"": ["s", "u"], "s": ["u"], "u": ["a"], "a": ["u"]}
NAMES = {"u": "user", "a": "assistant"}


def plain_repair(turns):
    """(cost, audit, repaired) of (role, text, must go, truncated): all ways from the end, by last initial."""
    far = (10**9, "", None)
    best = {q: far for q in NEXT}
    best[""] = best["a"] = (0, "", [])

    def inserted(best):
        for _ in range(4):
            for q, after in NEXT.items():
                for r in set(after) & {"u", "a"}:
                    cost, audit, done = best[r]
                    if done is not None:
                        best[q] = min(best[q], (cost + 2, "I" + audit, [(NAMES[r], ""), *done]), key=lambda x: x[:2])
        return best

    best = inserted(best)
    for role, text, must_go, cut in reversed(turns):
        before = {}
        for q, after in NEXT.items():
            cost, audit, done = best[q]
            ways = [(cost + 3, "D" + audit, done)]
            for r in after if not must_go else []:
                cost, audit, done = best[r]
                if done is None:
                    continue
                if role[:1] == r:
                    ways.append((cost + cut, "K" + audit, [(role, text), *done]))
                if r != "s":
                    ways.append((cost + 2 + cut, "R" + audit, [(NAMES[r], text), *done]))
            before[q] = min(ways, key=lambda x: x[:2])
        best = inserted(before)
    return best[""]


def plain_report(table):
    """The contract's row for each conversation, from (conv_id, turn, role, text) rows."""
    groups = {}
    for conv, turn, role, text in table:
        kept = groups.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        row = (turn, "user" if fault == 4 else role, text)
        kept += [] if fault == 0 else [row] * (2 if fault == 3 else 1)
    found = []
    for conv, kept in groups.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, turns, counts = set(), [], [0, 0, 0]
        for _, role, text in kept:
            bare = text.strip(" \t\n\x0b\x0c\r")
            kind = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if kind is not None:
                counts[kind] += 1
            turns.append((role, text, kind in (0, 1), int(kind == 2)))
        cost, audit, repaired = plain_repair(turns)
        assert LEGAL.fullmatch("".join(r[0] for r, _ in repaired))
        numbers = [t for t, _, _ in kept if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        found.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(found, key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def reported(spark, table, tmp_path, name="t"):
    folder = f"{tmp_path}/{name}"
    spark.createDataFrame(table, SCHEMA).repartition(3).write.parquet(f"{folder}/conversations.parquet")
    return rows(queries.QUERIES["op12_turn_repair"](spark, folder).select(COLUMNS))


def random_table(seed, n_convs, longest):
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "sys", "Unknown", "", None]
    texts = ["Hi.", "Yes!", "no", "Why? ", " \n", "", None, "A b c.", "end\t", "é."]
    table = []
    for conv in [*range(n_convs), None, -7]:
        turns = [r.choice([None, t, t, t, t + 3, t // 2]) for t in range(r.randint(1, longest))]
        table += [(conv, t, r.choice(roles[: r.choice([2, 3, 10])]), r.choice(texts) if r.random() < 0.5 else f"Text {r.random()}.") for t in turns]
    return table


def test_table_equals_plain_search(spark, con, tmp_path):
    table = con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert reported(spark, table, tmp_path) == plain_report(table)


@pytest.mark.parametrize("batch", [3, 10_000])
def test_random_conversations_equal_plain_search(spark, tmp_path, conf, batch):
    """With three rows a batch each conversation is many runs, chained by the scans."""
    conf(spark__sql__execution__arrow__maxRecordsPerBatch=str(batch))
    table = random_table(5, 120, 30) + random_table(6, 3, 400)
    assert reported(spark, table, tmp_path) == plain_report(table)


def test_empty_edges_and_columns(spark, tmp_path):
    assert reported(spark, [], tmp_path, "empty") == []
    gone = [(c, 0, "user", "Hi.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    digest = hashlib.sha256(b"").hexdigest()
    assert reported(spark, gone, tmp_path, "gone") == sorted(
        [(c, 0, 0, 0, 0, 0, 0, "", digest) for c, *_ in gone], key=repr
    )
    table = [("x", 1, "user", "Hi. " * 200_000, 0), ("x", 2, "assistant", "Yes.", 0), (None, 1, "tool", "Ok.", 0)]
    df = spark.createDataFrame(table, "id string, turn int, role string, text string, seg int")
    repaired = turn_repair.repair(turn_repair.pack_turns(df, conv_id="id"))
    assert {(r.conv_id, r.audit) for r in turn_repair.report(repaired).collect()} == {("x", "KK"), (None, "D")}
    assert [r.text for r in turn_repair.repaired_turns(repaired).orderBy("pos").collect()] == ["Hi. " * 200_000, "Yes."]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from([FINE, BLANK, DUPLICATE, CUT, ABSENT])), max_size=14), st.data())
def test_blocks_and_runs_equal_plain_search(turns, data):
    symbols = turn_repair._symbols([r for r, _ in turns], [f for _, f in turns])
    present = [(r, "", f in (BLANK, DUPLICATE), int(f == CUT)) for r, f in turns if f != ABSENT]
    tables = turn_repair.tables()
    cost, audit, _ = plain_repair(present)
    edits, _, total = tables.trace(symbols)
    assert (total, "".join(edits)) == (cost, audit)
    cut = data.draw(st.integers(0, len(symbols)))
    head, tail = symbols[:cut], symbols[cut:]
    behind = tables.walk(tail)[0][-1]
    first, state, a = tables.trace(head, behind, last=False)
    second, _, b = tables.trace(tail, 0, state)
    assert (a + b, "".join(first + second)) == (cost, audit)
