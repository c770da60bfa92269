import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from millrace.llm.queries import QUERIES
from millrace.llm.simhash import fingerprint, keep_one, links, near_duplicates
from millrace.llm.components import components

from .conftest import FOLDER


def plain(text):
    words = text.lower().split(" ") if text.isascii() and "\n" not in text else text.encode().lower().decode("utf8").split()
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def unite(values, linked):
    group = {v: v for v in values}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in linked:
        group[max(top(a), top(b))] = min(top(a), top(b))
    return {v: top(v) for v in values}


def test_fingerprints():
    for text in ("", "  ", "One", "one two", "A b C d", "the cat sat on the mat " * 50):
        assert fingerprint(text.encode()) & (1 << 64) - 1 == plain(text)
    assert fingerprint("É x\x0by\x85z".encode()) == fingerprint("É X y\x85z".encode())


def test_query_equals_brute_force(spark, texts):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op7_simhash_dedup"](spark, FOLDER).collect()}
    prints = {i: fingerprint(t.encode()) & (1 << 64) - 1 for i, t in texts.items()}
    ids = sorted(prints)
    near = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    roots = unite(ids, near)
    assert got == {i: (f"{prints[i]:016x}", roots[i]) for i in ids}


def test_tiles_lose_no_link(spark):
    """Clusters of neighbours and one large ball, in tiles of a few rows."""
    rng = random.Random(0)
    prints = {rng.getrandbits(64) for _ in range(300)}
    centre = rng.getrandbits(64)
    prints |= {centre ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(200)}
    prints |= {p ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for p in list(prints)[:150]} | {0, (1 << 64) - 1, 1}
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(signed)], "doc_id long, fingerprint long")
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    roots = unite(signed, near)
    for rows in (7, 4096):
        stars = links(df.select("fingerprint"), 2, rows)
        found = {r.node: r.root for r in components(stars).collect()}
        assert {p: found.get(p, p) for p in signed} == roots
        assert stars.count() < 40 * len(signed)


def test_one_of_each_group_stays(spark, edges, empty):
    kept = keep_one(edges)
    assert kept.columns == edges.columns
    got = sorted(((r.doc_id, (r.text or "")[:6]) for r in kept.collect()), key=repr)
    assert got == sorted([(1, "The qu"), (2, ""), (None, "a b c"), (5, "word w"), (6, "é ñ 日本"), (7, "x")], key=repr)
    assert keep_one(empty).count() == 0


def test_a_group_without_ids(spark):
    df = spark.createDataFrame([(None, 5), (None, 5), (None, 4)], "doc_id long, fingerprint long")
    assert {(r.component_id, r.root) for r in near_duplicates(df).collect()} == {(None, 4)}


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(1000, i) for i in range(1001, 1200)]
    df = spark.createDataFrame([*chain, *hub, (5, 5), (None, 3)], "a long, b long").repartition(5)
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**dict.fromkeys(range(101, 161), 100), **dict.fromkeys(range(1001, 1200), 1000)}
    assert components(df.where(F.lit(False))).count() == 0
