"""Line dedup: lines that many documents share are dropped from all of them.

A line's key is the line without white space at its ends and with A-Z in lower case; keys are
compared by their 64-bit hash. Steps:

1. One scan turns each text into the hashes of its lines (narrow, equal rows once, staged).
2. The documents of each hash are counted, with sums in the map tasks.
3. The distinct hashes are dealt to shards by their value. Each shard becomes one minimal perfect
   hash with two arrays, fingerprints and counts, indexed by it. A shard has a bounded number of
   hashes, so a task's memory is bounded whatever the corpus.
4. Each document's distinct hashes visit their shard and probe its arrays; no line is joined to a line.
   A shard that gets many visits, as one with a hot line does, is copied to as many tasks as they need.
5. The hashes to drop go back to their documents, where they are turned into line numbers. So a line
   that one document repeats ever so often is one visit.

NULL or empty text is one empty line, which has no key. Each row counts as a document of its own, also
where ids or whole rows repeat or ids are NULL. A document that loses all lines keeps an empty text.
An empty table gives no rows. Other columns, of any name, stay as they are. Distinct lines with equal
64-bit hashes count as one line. One text with its lines' hashes has to fit into a task's memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.rows import fold, fresh, row_key, slices, with_key
from millrace.session import stage

WHITE = " \t\n\x0b\x0c\r"
SHARD_KEYS = 1 << 14  # hashes of a shard, about
SHARD_VISITS = 1 << 14  # probes of a copy of a shard, about
INDEX = "shard long, sizes array<long>, bits binary, fingerprints binary, counts binary"


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of bits, and the rank of a key's bit.

    On each level the keys left over are thrown into twice as many bits; a key alone in its bit is
    placed there, the others go to the next level.
    """

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels, left = [], [], keys
        while len(left):
            size = -(-2 * len(left) // 64) * 64
            at = _mix(left, len(sizes)) % np.uint64(size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            left = left[~alone[at.astype(np.int64)]]
        words = np.concatenate(levels) if levels else np.zeros(0, np.uint64)
        return cls(np.array(sizes, np.int64), words)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; for a key that was not given at first, any slot or -1."""
        slots = np.full(len(keys), -1, np.int64)
        left, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = (_mix(keys[left], level) % np.uint64(size)).astype(np.int64)
            word, bit = base // 64 + at // 64, (at % 64).astype(np.uint64)
            placed = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            rank = self.before[word] + np.bitwise_count(below)
            slots[left[placed]] = rank[placed]
            left, base = left[~placed], base + size
        return slots


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """Another hash of 64-bit hashes for each seed."""
    x = keys + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


def line_hashes(text: Column, min_chars: int = 1) -> Column:
    """The hash of each line's key, in the order of the lines; NULL for a shorter key."""

    def of(line: Column) -> Column:
        key = F.btrim(line, F.lit(WHITE))
        return F.when(F.char_length(key) >= min_chars, F.xxhash64(key))

    return F.transform(F.split(fold(F.coalesce(text, F.lit(""))), "\n", -1), of)


def count_lines(hashed: DataFrame, hashes: str = "hashes") -> DataFrame:
    """(hash, n_docs): in how many rows each line hash is found, if a row of `hashed` stands for `n`."""
    once = hashed.select("n", F.explode(F.array_distinct(hashes)).alias("hash")).where("hash IS NOT NULL")
    return once.groupBy("hash").agg(F.sum("n").alias("n_docs"))


def build_index(counts: DataFrame, n_shards: int) -> DataFrame:
    """INDEX: one row per shard, from `count_lines`."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        keys = group["hash"].to_numpy().view(np.uint64)
        function = PerfectHash.of(keys)
        slots = function.slots(keys)
        fingerprints, n_docs = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.uint32)
        fingerprints[slots] = _fingerprints(keys)
        n_docs[slots] = np.minimum(group["n_docs"].to_numpy(), 0xFFFFFFFF)
        arrays = [function.words, fingerprints, n_docs]
        row = [int(group["shard"].iloc[0]), function.sizes.tolist(), *(a.tobytes() for a in arrays)]
        return pd.DataFrame([row], columns=["shard", "sizes", "bits", "fingerprints", "counts"])

    return counts.withColumn("shard", _shard(n_shards)).groupBy("shard").applyInPandas(build, INDEX)


def _shard(n_shards: int) -> Column:
    return F.pmod("hash", F.lit(n_shards)).cast("long")


def probe(visits: DataFrame, index: DataFrame) -> DataFrame:
    """`visits` (shard, copy, hash, k1, k2) with `n_docs` from the arrays of their shard's copy.

    0 for a hash that the index does not have.
    """

    def look(visits: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
        n_docs = np.zeros(len(visits), np.int64)
        if len(shards) and len(visits):
            shard = shards.iloc[0]
            function = PerfectHash(
                np.array(shard["sizes"], np.int64), np.frombuffer(shard["bits"], np.uint64)
            )
            fingerprints = np.frombuffer(shard["fingerprints"], np.uint32)
            counts = np.frombuffer(shard["counts"], np.uint32)
            keys = visits["hash"].to_numpy().view(np.uint64)
            slots = function.slots(keys)
            known = (slots >= 0) & (fingerprints[slots] == _fingerprints(keys))
            n_docs = np.where(known, counts[slots], 0).astype(np.int64)
        return visits[["k1", "k2", "hash"]].assign(n_docs=n_docs)

    by = ["shard", "copy"]
    return (
        visits.groupBy(*by)
        .cogroup(index.groupBy(*by))
        .applyInPandas(look, "k1 long, k2 long, hash long, n_docs long")
    )


def line_numbers(hashed: DataFrame, hits: DataFrame) -> DataFrame:
    """(k1, k2, dropped): the numbers of the lines in `hashed` (k1, k2, hashes) that `hits` (k1, k2, hash) name."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            numbers = []
            for at in range(part.num_rows):
                hashes, hit = part.column("hashes")[at].values, part.column("hit")[at].values
                told = hashes.is_valid().to_numpy(zero_copy_only=False)
                same = np.isin(hashes.fill_null(0).to_numpy(), hit.to_numpy())
                numbers.append(np.flatnonzero(same & told).astype(np.int32))
            dropped = pa.array(numbers, pa.list_(pa.int32()))
            yield pa.record_batch([part.column("k1"), part.column("k2"), dropped], names=["k1", "k2", "dropped"])

    hit = hits.groupBy("k1", "k2").agg(F.collect_set("hash").alias("hit"))
    return hashed.join(hit, ["k1", "k2"]).mapInArrow(find, "k1 long, k2 long, dropped array<int>")


def repeated_lines(
    docs: DataFrame, min_docs: int, min_chars: int = 1, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """(k1, k2, dropped): the numbers of the lines to drop, for the rows that have any."""
    hashed = docs.select(
        *[c.alias(n) for c, n in zip(row_key(doc_id, text), ("k1", "k2"))],
        line_hashes(F.col(text), min_chars).alias("hashes"),
    )
    # Rows of one id and text have the same lines: they probe once, and count as often as they stand.
    once = [F.any_value("hashes").alias("hashes"), F.count(F.lit(1)).alias("n")]
    hashed = stage(hashed.groupBy("k1", "k2").agg(*once))
    counts = stage(count_lines(hashed))
    n_shards = max(1, -(-counts.count() // SHARD_KEYS))
    loads = counts.groupBy(_shard(n_shards).alias("shard")).agg(F.sum("n_docs").alias("_visits"))
    copies = stage(loads.selectExpr("shard", f"ceil(_visits / {SHARD_VISITS}) AS copies"))
    index = build_index(counts, n_shards).join(copies, "shard")
    index = index.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    visits = (
        hashed.select("k1", "k2", F.explode(F.array_distinct("hashes")).alias("hash"))
        .where("hash IS NOT NULL")
        .withColumn("shard", _shard(n_shards))
        .join(copies, "shard")
        .withColumn("copy", F.pmod(F.xxhash64("k1", "k2"), F.col("copies")))
    )
    hits = probe(visits.drop("copies"), index.drop("copies")).where(F.col("n_docs") >= min_docs)
    return line_numbers(hashed, hits)


def drop_repeated_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    text: str = "text",
    doc_id: str = "doc_id",
    counters: tuple[str, str] | None = None,
) -> DataFrame:
    """`docs` with the lines of `min_docs` or more documents taken out of `text`.

    `counters` may name two new columns: the lines before dropping, and the lines dropped.
    """
    keyed, (k1, k2) = with_key(docs, doc_id, text)
    lines, dropped = fresh(keyed, "_lines", "_dropped")
    found = stage(repeated_lines(docs, min_docs, min_chars, text, doc_id))
    found = found.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("dropped").alias(dropped))
    joined = keyed.join(found, [k1, k2], "left")
    # A generated column: else each line kept would split the text once more.
    split = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    joined = joined.select("*", F.explode(F.array(split)).alias(lines))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
    new_text = F.array_join(F.transform(kept, lambda at: F.get(F.col(lines), at)), "\n")
    columns = {text: F.when(F.col(dropped).isNull(), F.col(text)).otherwise(new_text)}
    if counters:
        n_dropped = F.coalesce(F.size(dropped), F.lit(0))
        n_dropped = F.when(F.col(dropped).isNull(), F.lit(0)).otherwise(n_dropped)
        columns |= {
            counters[0]: F.size(lines).cast("long"),
            counters[1]: n_dropped.cast("long"),
        }
    return joined.withColumns(columns).drop(k1, k2, lines, dropped)
