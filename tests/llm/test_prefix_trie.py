"""Prefix tries against plain dictionaries of prefixes, with containers of any size and runs of any length."""

import hashlib
import random
import zlib

import pytest

from millrace.llm import prefix_trie, queries
from conftest import rows

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_nodes(sequences):
    """The nodes' rows from {conversation: list of (role, text)}."""
    members = {}
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[c] for c in below) or 1
        saved[node] = sum(saved[c] for c in below) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    found = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(sequences[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        found.append((min(convs), len(node), parent, len(convs), len(children.get(node, [])), leaves[node], saved[node], digest))
    return sorted(found, key=repr)


def grouped(table):
    sequences = {}
    for conv, turn, role, text in sorted(table, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", hash_of(r))):
        if conv is not None:
            sequences.setdefault(conv, []).append((role or "", text or ""))
    return sequences


def hash_of(row):
    role, text = row[2] or "", row[3] or ""
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def plain_rebuilt(own):
    found = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        found[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return found


def random_table(seed, n_convs, longest):
    r = random.Random(seed)
    texts = ["a", "bb", "", None, "ü日", "ccc"]
    table = []
    for n in range(n_convs):
        conv = r.choice([n, n * 7, 100 * n])
        many = r.choice([1, 2, 2, 5])
        for t in range(r.randint(1, longest)):
            table.append((conv, r.choice([t, t, t, None]), r.choice(["u", "u", None, "s"]), r.choice(texts[:many])))
    copies = [(9000 + n, t, "u", f"c{t}") for n in range(n_convs) for t in range(5)]
    return table + copies + [(None, 0, "u", "a"), (None, 1, "u", "b")]


@pytest.mark.parametrize("limit, batch", [(1, 10_000), (7, 3), (60, 10_000), (10**9, 4)])
def test_tries_equal_plain_dictionaries(spark, conf, limit, batch):
    conf(spark__sql__execution__arrow__maxRecordsPerBatch=str(batch))
    table = random_table(limit, 60, 12)
    packed = prefix_trie.pack_conversations(spark.createDataFrame(table, SCHEMA).repartition(3))
    got = prefix_trie.trie(packed, limit).select(COLUMNS)
    assert rows(got) == plain_nodes(grouped(table))
    got = prefix_trie.trie(queries.rebuilt(packed), limit).select(COLUMNS)
    assert rows(got) == plain_nodes(plain_rebuilt(grouped(table)))


def test_deep_copies_burst_in_few_rounds(spark):
    """Many equal, long conversations: every level above the last ones is burst, in log2(depth) rounds."""
    table = [(c, t, "u", f"t{t}") for c in range(8) for t in range(100)]
    packed = prefix_trie.pack_conversations(spark.createDataFrame(table, SCHEMA))
    found = prefix_trie.stage(prefix_trie.paths(packed))
    assert prefix_trie.burst(found, 40).select("depth").distinct().count() == 96
    assert rows(prefix_trie.trie(packed, 40).select(COLUMNS)) == plain_nodes(grouped(table))


def test_edges(spark):
    named = spark.createDataFrame([(None, 1, "u", "x", 0)], SCHEMA + ", seg int")
    assert prefix_trie.trie(prefix_trie.pack_conversations(named)).collect() == []
    table = [(5, None, None, None), (5, 0, "u", "word " * 100_000), (5, 0, "u", "word " * 100_000), (6, 0, "", "")]
    packed = prefix_trie.pack_conversations(spark.createDataFrame(table, SCHEMA))
    assert rows(prefix_trie.trie(packed).select(COLUMNS)) == plain_nodes(grouped(table))
