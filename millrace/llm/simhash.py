"""SimHash near-dedup: fingerprints, compared exactly in tiles of rows with near population counts.

1. A text's fingerprint has a bit set if more than half of its shingles' hashes have it set.
2. Equal fingerprints become one, so copies cost nothing and never meet one another.
3. A fingerprint's cell is the four population counts of its 16-bit quarters. Fingerprints that
   differ in at most `radius` bits lie in cells whose counts differ by at most `radius` in sum, so
   all other pairs of cells are skipped. There are at most 17^4 cells, whatever the corpus.
4. Cells are cut into tiles; each pair of tiles that is left is compared with numpy's exclusive-or
   and bit counts. A pair of tiles reports its links as stars, at most one per row.
5. Stars are joined into components.

A NULL or blank text has no words and the fingerprint 0, which is linked like any other. Repeated
rows share a fingerprint. A component whose ids are all NULL has the id NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.rows import row_key, runs, slices, with_key
from millrace.llm.tiles import Stars, TilePlan
from millrace.session import stage

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
TILE_ROWS = 4096
QUARTERS, LEVELS = 4, 17


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of a UTF-8 text, as a signed 64-bit number. 0 for a text without words."""
    parts = text.lower().split()  # bytes: A-Z only, and ASCII white space
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    n = max(1, len(parts) - words + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    ends = ends[len(parts) - n :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, n
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        bits = np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(
    docs: DataFrame, words: int = SHINGLE_WORDS, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """(k1, k2, doc_id, fingerprint), a row for each row of `docs`; the fingerprint is a long."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column("text").cast(pa.binary()).to_pylist()
            prints = pa.array([fingerprint(t or b"", words) for t in texts], pa.int64())
            kept = [part.column(c) for c in ("k1", "k2", "doc_id")]
            yield pa.record_batch([*kept, prints], names=["k1", "k2", "doc_id", "fingerprint"])

    k1, k2 = row_key(doc_id, text)
    rows = docs.select(
        k1.alias("k1"), k2.alias("k2"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")
    )
    schema = rows.drop("text").schema.add("fingerprint", "long")
    return rows.mapInArrow(compute, schema)


def _neighbours(radius: int) -> np.ndarray:
    """Differences of the counts of two cells that may hold linked fingerprints."""
    steps = range(-radius, radius + 1)
    return np.array([d for d in product(steps, repeat=QUARTERS) if sum(map(abs, d)) <= radius])


def _counts(prints: np.ndarray) -> np.ndarray:
    """Population counts of the quarters, one row per fingerprint."""
    return np.bitwise_count(prints.view(np.uint16).reshape(-1, QUARTERS)).astype(np.int64)


_PLACES = LEVELS ** np.arange(QUARTERS)


def links(distinct: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(a, b) fingerprints: stars that connect all pairs of `distinct` within `radius` bits."""
    quarter = [F.bit_count(F.shiftrightunsigned("fingerprint", 16 * q).bitwiseAND(0xFFFF)) for q in range(QUARTERS)]
    cell = sum(c * int(p) for c, p in zip(quarter, _PLACES))
    sizes = np.zeros(LEVELS**QUARTERS, np.int64)
    for row in distinct.groupBy(cell.alias("cell")).count().collect():  # 17^4 rows at most
        sizes[row["cell"]] = row["count"]
    plan, near = TilePlan(sizes, tile_rows), _neighbours(radius)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1 << 13):
            prints = part.column("fingerprint").to_numpy()
            counts = _counts(prints)
            own = plan.own(counts @ _PLACES, prints.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33))
            for step in near:
                to = counts + step
                row = np.flatnonzero(((to >= 0) & (to < LEVELS)).all(axis=1))
                picked, pair = plan.meetings(own[row], to[row] @ _PLACES)
                row = row[picked]
                yield pa.record_batch([pair, own[row], prints[row]], names=["pair", "own", "fingerprint"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "pair"):
            prints = group.column("fingerprint").to_numpy()
            one, two = plan.sides(group.column("pair")[0].as_py(), group.column("own").to_numpy())
            stars = Stars(len(prints))
            other = one if two is None else two
            for at in range(0, len(one), 256):
                rows = one[at : at + 256]
                apart = np.bitwise_count(prints[rows, None].view(np.uint64) ^ prints[None, other].view(np.uint64))
                i, j = np.nonzero(apart <= radius)
                stars.add(rows[i], other[j])
            row, root = stars.edges()
            if len(row):
                yield pa.record_batch([prints[row], prints[root]], names=["a", "b"])

    dealt = distinct.select("fingerprint").mapInArrow(deal, "pair long, own long, fingerprint long")
    met = dealt.repartition("pair").sortWithinPartitions("pair")
    return met.mapInArrow(compare, "a long, b long")


def near_duplicates(prints: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """`prints` (doc_id, fingerprint, ...) with `component_id`, the smallest doc_id reached by links.

    `root` is the smallest fingerprint reached. `prints` is read several times and should be staged.
    """
    nodes = stage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("_first")))
    roots = components(links(nodes, radius, tile_rows))
    joined = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "_first", F.coalesce("root", "fingerprint").alias("root")
    )
    joined = stage(joined)
    firsts = stage(joined.groupBy("root").agg(F.min("_first").alias("component_id")))
    named = stage(joined.join(firsts, "root").select("fingerprint", "component_id", "root"))
    return prints.join(named, "fingerprint")


def keep_one(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """`docs` with one row of each group of near duplicates.

    The row with the smallest id stays; of rows that share it, the one whose text has the smallest
    hash; of rows equal in both, any one. A group whose ids are all NULL keeps one row as well.
    """
    found = stage(near_duplicates(stage(fingerprints(docs, words, text, doc_id)), radius))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k2", "k1")
    first = found.groupBy("root").agg(F.min(place).alias("_place"))
    keepers = first.select(F.col("_place.k1").alias("k1"), F.col("_place.k2").alias("k2"))
    keepers = stage(keepers.join(found.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")), ["k1", "k2"]))
    keyed, keys = with_key(docs, doc_id, text)

    def rows_of(some: DataFrame) -> DataFrame:
        return keyed.join(some.toDF(*keys), keys, "left_semi")

    kept = rows_of(keepers.where("n = 1").select("k1", "k2"))
    repeated = rows_of(keepers.where("n > 1").select("k1", "k2")).dropDuplicates(keys)
    return kept.unionByName(repeated).select(*docs.columns)
