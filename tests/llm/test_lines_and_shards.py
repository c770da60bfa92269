import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import line_dedup, shards
from millrace.llm.line_dedup import PerfectHash, build_index, drop_repeated_lines, probe
from millrace.llm.queries import QUERIES

from .conftest import FOLDER


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_perfect_hash_is_minimal(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64))
    slots = PerfectHash.of(keys).slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))


def test_probe_finds_counts_and_knows_strangers(spark):
    counts = spark.createDataFrame([(h, h % 50) for h in range(-500, 500)], "hash long, n_docs long")
    index = build_index(counts, 7).selectExpr("*", "0L AS copy")
    visits = spark.createDataFrame([(h, 0, 0, h % 1000) for h in range(-700, 700)], "hash long, k1 long, k2 long, pos int")
    visits = visits.selectExpr("pmod(hash, 7) AS shard", "0L AS copy", "hash", "hash AS k1", "k2", "pos")
    got = {r.k1: r.n_docs for r in probe(visits, index).collect()}
    assert got == {h: max(h % 50, 0) if -500 <= h < 500 else 0 for h in range(-700, 700)}


def test_lines_by_hand(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 5)
    monkeypatch.setattr(line_dedup, "SHARD_VISITS", 3)
    rng = random.Random(1)
    docs = [(i, "\n".join(rng.choice(["Shared", " shared\t", "", "  ", f"own {i}", f"few {i % 7}"]) for _ in range(6))) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    keys = {i: [x.strip(" \t\n\x0b\x0c\r").lower() for x in t.split("\n")] for i, t in docs}
    n = {}
    for own in keys.values():
        for k in set(own):
            n[k] = n.get(k, 0) + 1
    wanted = {i: "\n".join(x for x, k in zip(t.split("\n"), keys[i]) if not k or n[k] < 10) for i, t in docs}
    assert {r.doc_id: r.text for r in drop_repeated_lines(df).collect()} == wanted


def test_lines_on_edges(edges, empty):
    got = drop_repeated_lines(edges, min_docs=2, counters=("shard", "n"))
    assert got.columns == [*edges.columns, "n"]
    rows = {(r.doc_id, (r.text or "")[:5], r.shard, r.n) for r in got.collect()}
    assert {(1, "", 3, 3), (None, "", 1, 1), (2, "", 1, 0), (3, "", 1, 0), (7, "x", 1, 0)} <= rows
    assert drop_repeated_lines(empty).count() == 0


def test_a_line_repeated_within_a_document_visits_once(spark, monkeypatch):
    seen = []

    def watched(visits, index):
        seen.append(visits.groupBy("shard", "copy").count().agg(F.sum("count"), F.max("count")).first())
        return probe(visits, index)

    monkeypatch.setattr(line_dedup, "probe", watched)
    docs = [(0, "hot\n" * 10**6 + "own 0\n\nmine")] + [(i, f"hot\nown {i}\nHOT ") for i in range(1, 40)]
    got = drop_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string"), counters=("n", "lost")).collect()
    assert {(r.doc_id, r.text, r.n, r.lost) for r in got} == {
        (0, "own 0\n\nmine", 10**6 + 3, 10**6), *((i, f"own {i}", 3, 2) for i in range(1, 40))
    }
    assert seen[0][0] == 81 and seen[0][1] <= line_dedup.SHARD_VISITS


def test_rows_are_documents_also_where_ids_repeat(spark):
    docs = [(1, f"shared\nown {i}") for i in range(10)] + [(None, "void\nx")] * 10 + [(2, "few")] * 9
    got = drop_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted(
        [("1", f"own {i}") for i in range(10)] + [("None", "")] * 10 + [("2", "few")] * 9
    )


def best_capacity(sizes, n):
    """The smallest capacity by trying all sums of neighbours."""
    sums = {sum(sizes[a:b]) for a in range(len(sizes)) for b in range(a + 1, len(sizes) + 1)}
    for capacity in sorted(sums):
        used, at = 1, 0
        for s in sizes:
            if s > capacity:
                break
            if at + s > capacity:
                used, at = used + 1, 0
            at += s
        else:
            if used <= n:
                return capacity
    return 0


@pytest.mark.parametrize("n", [1, 3, 24])
def test_shards_are_as_even_as_can_be(spark, n):
    rng = random.Random(n)
    docs = [(i, "t" * rng.randrange(60) + str(rng.randrange(40))) for i in range(150)] + [(i, "hot " * 20) for i in range(150, 190)]
    docs += [(None, None), (None, None), (1, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = shards.assign_shards(df, n).collect()
    grouped = {}
    for r in spark.createDataFrame(docs, "doc_id long, text string").select(
        "text", shards.text_group(F.col("text")).alias("g"), shards.row_size(F.col("text")).alias("s")
    ).collect():
        grouped.setdefault(r.g, [r.text, 0])[1] += r.s
    order = sorted(grouped)
    best = best_capacity([grouped[g][1] for g in order], n)
    load = {}
    for r in rows:
        load[r.shard] = load.get(r.shard, 0) + r.size
    assert max(load.values()) == best and set(load) <= set(range(n))
    homes = {}
    for r in rows:
        homes.setdefault(r.text, set()).add(r.shard)
    assert all(len(s) == 1 for s in homes.values())
    number = {grouped[g][0]: i for i, g in enumerate(order)}
    placed = sorted((number[t], min(s)) for t, s in homes.items())
    assert [s for _, s in placed] == sorted(s for _, s in placed)
    for shard in load:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


@pytest.mark.parametrize("place", [0.0, 0.5, 1.0])
def test_a_hot_group_leaves_no_shard_empty(spark, place):
    sizes = [(i, 100) for i in range(2000)]
    hot = int(place * 2000)
    df = spark.createDataFrame(sizes + [(hot, 100_000)], "g long, s long")
    # Groups in order of `g`, spread over the whole range of the order.
    group = F.col("g") * (1 << 52) - F.lit(1 << 62)
    rows = shards.assign_shards(df, 24, group=group, size=F.col("s"))
    load = {r["shard"]: r["s"] for r in rows.groupBy("shard").agg(F.sum("size").alias("s")).collect()}
    assert set(load) == set(range(24)) and max(load.values()) in (100_000, 100_100)
    rest = sorted(load.values())[:-1]
    assert rest[-1] <= 1.2 * 200_000 / 23 and rest[0] >= 0.5 * 200_000 / 23


def test_shard_query(spark, texts):
    rows = QUERIES["op4_shard"](spark, FOLDER).collect()
    assert {r.doc_id: r.size for r in rows} == {i: len(t.encode()) + 8 for i, t in texts.items()}
    load = {}
    for r in rows:
        load[r.shard] = load.get(r.shard, 0) + r.size
    assert set(load) == set(range(24))
    most = max(len(t.encode()) + 8 for t in texts.values())
    assert max(load.values()) <= sum(load.values()) / 24 + 2 * most


def test_shards_on_edges(edges, empty):
    got = shards.assign_shards(edges)
    assert sorted(got.columns) == sorted([*edges.columns, "size", "slot"])
    assert got.count() == edges.count()
    assert shards.assign_shards(empty).count() == 0
