"""Embedding near-dedup: balanced binary codes by iterative quantisation, and multi-index tables.

1. Equal vectors become one class with a size, so copies never meet one another.
2. Rotations are learnt on a bounded sample (`SAMPLE` classes, those with the smallest hash): the
   sample is centred and turned to its principal axes, and the axes are rotated in turns so that the
   signs of the coordinates lose as little as they can (iterative quantisation). A rotation gives
   `BITS` bits at most, the signs of the rotated coordinates; a vector's code is those of all
   rotations, one after another.
3. Each run of `width` bits of the code is the key of one table; the width grows with the logarithm of
   the number of classes, so that a bucket keeps its size. Tables, and rotations for them, are added
   until `RECALL` of three kinds of pairs at the threshold share a bucket: those of the sample, and
   vectors of the sample moved there along differences within the sample and in any direction. Where
   `MAX_TABLES` don't suffice, keys become shorter, and in the end all rows share one bucket.
4. Buckets of one row have no pair. Larger ones are compared in tiles of `TILE_ROWS`, each pair of
   tiles a group of its own. A pair counts in the first table it shares, if the codes of the first
   rotation differ in at most `radius` bits (learnt on the same pairs, within the same recall), and is
   a link if the cosine of the original vectors, in double precision, reaches the threshold.
5. Tiles report counts and stars per row, never pairs; the stars are joined into components.

Vectors that are NULL, empty, zero, or hold NULL or non-finite parts link with nothing. A vector
shorter than the longest counts as filled up with zeros. Repeated rows are vectors of their own. A
component whose ids are all NULL has the id NULL. An empty table gives no rows. Other columns, of any
name, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.rows import runs, slices
from millrace.llm.tiles import Stars
from millrace.session import stage

THRESHOLD = 0.9
SAMPLE = 8192
TURNS = 30
BITS = 64
RECALL = 0.97
MAX_TABLES = 256
BUCKET_ROWS = 512  # rows of a bucket that the keys' width aims at
MIN_WIDTH = 4
PAIRS = 2048  # of each kind, on which recall is measured
TILE_ROWS = 512


def usable(vector: Column) -> Column:
    """Finite throughout and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class Quantiser:
    """Codes: the signs of centred unit vectors, cut to their main axes, after a learnt rotation."""

    def __init__(self, mean: np.ndarray, rotation: np.ndarray):
        self.mean, self.rotation = mean, rotation

    @classmethod
    def fit(cls, sample: np.ndarray, bits: int, turns: int = TURNS, seed: int = 0) -> Quantiser:
        unit = _unit(sample)
        dim = unit.shape[1]
        mean = unit.mean(axis=0) if len(unit) else np.zeros(dim)
        centred = unit - mean
        _, axes = np.linalg.eigh(centred.T @ centred)
        axes = axes[:, -bits:]
        turned = centred @ axes
        rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
        for _ in range(turns):
            signs = np.where(turned @ rotation >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(signs.T @ turned)
            rotation = (left @ right).T
        return cls(mean, axes @ rotation)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """One row of bytes per vector."""
        return np.packbits((_unit(vectors) - self.mean) @ self.rotation >= 0, axis=1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    # Scaled by the largest part first: the squares of tiny or huge parts would leave the range.
    vectors = vectors / np.maximum(np.abs(vectors).max(axis=1, keepdims=True), 1e-300)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The lists of a column as rows of one matrix, filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    matrix = np.zeros((len(column), dim))
    matrix[np.arange(dim) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return matrix


def classes(vectors: DataFrame, vector: str, vec_id: str) -> tuple[DataFrame, DataFrame]:
    """Staged rows (vec_id, usable, v1, v2), and classes (cid, v1, v2, vector, size, first_id)."""
    v = F.col(vector)
    keyed = vectors.select(
        F.col(vec_id).alias("vec_id"),
        usable(v).alias("usable"),
        F.xxhash64(v).alias("v1"),
        F.xxhash64(F.reverse(v)).alias("v2"),
        v.alias("vector"),
    )
    rows = stage(keyed.drop("vector"))
    found = keyed.where("usable").groupBy("v1", "v2").agg(
        F.any_value("vector").alias("vector"),
        F.count(F.lit(1)).alias("size"),
        F.min("vec_id").alias("first_id"),
    )
    return rows, stage(found.withColumn("cid", F.monotonically_increasing_id()))


@dataclass
class Tables:
    """Keys of `count` tables, each `width` bits of the code, and the radius of the first rotation."""

    quantisers: list[Quantiser]
    width: int
    count: int
    radius: int
    recall: float = 1.0  # the least of the kinds of pairs it was measured on

    @classmethod
    def fit(
        cls, sample: np.ndarray, bits: int, n_rows: int, threshold: float = THRESHOLD, recall: float = RECALL
    ) -> Tables:
        # Measured on other vectors than it is learnt on, where there are enough for both.
        aside = np.arange(len(sample)) % 4 == 0 if len(sample) >= 1024 else np.ones(len(sample), bool)
        kinds = near_pairs(_unit(sample), aside, threshold)
        sample = sample if aside.all() else sample[~aside]
        first = Quantiser.fit(sample, bits)
        if not kinds:
            return cls([first], 0, 1, bits)
        left, right = (np.concatenate([pair[side] for pair in kinds.values()]) for side in (0, 1))
        kind = np.repeat(np.arange(len(kinds)), [len(pair[0]) for pair in kinds.values()])
        quantisers, equal = [first], [_bits([first], left) == _bits([first], right)]
        apart = (~equal[0]).sum(axis=1)
        lost = (1 - recall) / 4
        radius = int(max(np.quantile(apart[kind == k], 1 - lost, method="higher") for k in range(len(kinds))))
        rng = np.random.default_rng(1)
        for width in range(max(MIN_WIDTH, int(np.ceil(np.log2(max(1, n_rows / BUCKET_ROWS))))), 0, -1):
            met = np.zeros(len(kind), bool)
            for t in range(MAX_TABLES):
                while len(quantisers) * bits < (t + 1) * width:
                    part = sample[rng.permutation(len(sample))[: max(SAMPLE // 4, bits)]]
                    quantisers.append(Quantiser.fit(part, bits, seed=len(quantisers)))
                    equal.append(_bits(quantisers[-1:], left) == _bits(quantisers[-1:], right))
                at = np.arange(t * width, (t + 1) * width)
                met |= np.all([equal[i // bits][:, i % bits] for i in at], axis=0)
                found = met & (apart <= radius)
                reached = min(found[kind == k].mean() for k in range(len(kinds)))
                if reached >= recall:
                    used = -(-(t + 1) * width // bits)
                    return cls(quantisers[:used], width, t + 1, radius, float(reached))
        return cls([first], 0, 1, bits)

    def keys(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The code of the first rotation as one number, and a row of keys, one per table."""
        bits = _bits(self.quantisers, vectors)
        own = len(self.quantisers[0].rotation[0])
        lead = np.zeros((len(bits), 8), np.uint8)
        lead[:, : own // 8] = np.packbits(bits[:, :own], axis=1)
        powers = 1 << np.arange(self.width, dtype=np.int64)
        cut = bits[:, : self.count * self.width].reshape(len(bits), self.count, self.width)
        return lead.view(np.uint64)[:, 0], cut @ powers


def _bits(quantisers: list[Quantiser], vectors: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.concatenate([q.codes(vectors) for q in quantisers], axis=1), axis=1)


def near_pairs(
    unit: np.ndarray, aside: np.ndarray, threshold: float, pairs: int = PAIRS
) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit vectors at or just above the threshold, by kind; none from fewer than two vectors.

    `own` are the sample's, where there are enough of them to measure on. `along` and `any` are
    vectors of its part `aside` with a partner at the threshold, in the direction of the difference between
    two others, and in a random direction.
    """
    if len(unit) < 2:
        return {}
    rng, kinds = np.random.default_rng(2), {}
    some = rng.choice(np.flatnonzero(aside), size=pairs)
    one, two = rng.integers(len(unit), size=(2, pairs))
    for name, step in (("along", unit[one] - unit[two]), ("any", rng.normal(size=(pairs, unit.shape[1])))):
        at = unit[some]
        step = step - at * (step * at).sum(axis=1, keepdims=True)
        length = np.linalg.norm(step, axis=1, keepdims=True)
        fit_ = length[:, 0] > 1e-6
        if fit_.any():
            moved = threshold * at[fit_] + np.sqrt(max(0.0, 1 - threshold**2)) * step[fit_] / length[fit_]
            kinds[name] = at[fit_], moved
    own = []
    for begin in range(0, len(unit), 1024):
        cosine = unit[begin : begin + 1024] @ unit.T
        i, j = np.nonzero((cosine >= threshold) & (cosine <= threshold + (1 - threshold) / 4))
        own.append(np.stack([i + begin, j])[:, i + begin < j])
    own = np.concatenate(own, axis=1)
    if own.shape[1] >= 100:
        own = own[:, rng.permutation(own.shape[1])[:pairs]]
        kinds["own"] = unit[own[0]], unit[own[1]]
    return kinds


def fit(
    found: DataFrame, dim: int, threshold: float = THRESHOLD, recall: float = RECALL, sample: int = SAMPLE
) -> Tables:
    """Tables learnt on the classes with the smallest hashes, `sample` of them at most."""
    some = found.orderBy("v1", "v2").limit(sample).select("vector").toArrow().column("vector")
    return Tables.fit(_matrix(some.combine_chunks(), dim), min(dim, BITS), found.count(), threshold, recall)


def class_links(
    found: DataFrame,
    dim: int,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    sample: int = SAMPLE,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """(cid, links, root): per class and tile pair, vectors linked with it and the root of its star."""
    tables = fit(found, dim, threshold, recall, sample)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 4096):
            matrix = _matrix(part.column("vector"), dim)
            lead, keys = tables.keys(matrix)
            columns = [
                part.column("cid"),
                part.column("size"),
                pa.array(lead.view(np.int64)),
                pa.array(list(keys), pa.list_(pa.int64())),
                pa.array([r.tobytes() for r in matrix], pa.binary()),
            ]
            yield pa.record_batch(columns, names=["cid", "size", "lead", "keys", "vector"])

    coded = stage(found.select("cid", "size", "vector").mapInArrow(
        encode, "cid long, size long, lead long, keys array<long>, vector binary"
    ))
    # Buckets stay in Spark: their number grows with the rows.
    buckets = coded.select(F.posexplode("keys").alias("nth", "key")).groupBy("nth", "key").count()
    splits = F.ceil(F.col("count") / tile_rows).cast("int").alias("splits")
    buckets = stage(buckets.where("count > 1").select("nth", "key", splits))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "nth", "key", "low", "high"):
            low, high = (group.column(c)[0].as_py() for c in ("low", "high"))
            own = group.column("own").to_numpy()
            one, other = np.flatnonzero(own == low), np.flatnonzero(own == high)
            lead = group.column("lead").to_numpy().view(np.uint64)
            i, j = np.nonzero(np.bitwise_count(lead[one][:, None] ^ lead[other]) <= tables.radius)
            a, b = one[i], other[j]
            apart = a != b  # a row meets itself in its own tile
            a, b = a[apart], b[apart]
            keys = group.column("keys").combine_chunks().flatten().to_numpy().reshape(len(own), tables.count)
            for t in range(group.column("nth")[0].as_py()):
                if not len(a):
                    break
                new = keys[a, t] != keys[b, t]
                a, b = a[new], b[new]
            if not len(a):
                continue
            vectors = _unit(_bytes(group.column("vector"), dim * 8).view(np.float64))
            near = np.concatenate([
                np.einsum("ij,ij->i", vectors[a[at : at + (1 << 14)]], vectors[b[at : at + (1 << 14)]]) >= threshold
                for at in range(0, len(a), 1 << 14)
            ])
            a, b = a[near], b[near]
            if not len(a):
                continue
            cids, sizes = group.column("cid").to_numpy(), group.column("size").to_numpy()
            stars, count = Stars(len(cids)), np.zeros(len(cids), np.int64)
            stars.add(a, b)
            np.add.at(count, a, sizes[b])
            if low != high:
                np.add.at(count, b, sizes[a])
            rows = np.flatnonzero(count)
            yield pa.record_batch([cids[rows], count[rows], cids[stars.label[rows]]], names=["cid", "links", "root"])

    dealt = coded.select("*", F.posexplode("keys").alias("nth", "key")).join(buckets, ["nth", "key"])
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("cid"), F.col("splits")).cast("int"))
    dealt = dealt.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("splits") - 1))).select(
        "nth", "key", F.least("own", "met").alias("low"), F.greatest("own", "met").alias("high"),
        "own", "cid", "size", "lead", "keys", "vector",
    )
    by = ["nth", "key", "low", "high"]
    return dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(compare, "cid long, links long, root long")


def _bytes(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Binary values of one width as rows of bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    sample: int = SAMPLE,
    vector: str = "embedding",
    vec_id: str = "vec_id",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of `vectors`."""
    rows, found = classes(vectors, vector, vec_id)
    dim = found.agg(F.max(F.size("vector"))).first()[0] or 1
    dim = -(-dim // 8) * 8
    links = stage(class_links(found, dim, threshold, recall, sample))
    roots = components(links.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    counted = stage(links.groupBy("cid").agg(F.sum("links").alias("links")))
    joined = found.select("cid", "v1", "v2", "size", "first_id").join(counted, "cid", "left")
    joined = joined.join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    joined = stage(joined.select(
        "v1", "v2", "first_id",
        (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.coalesce("root", "cid").alias("root"),
    ))
    firsts = stage(joined.groupBy("root").agg(F.min("first_id").alias("component_id")))
    named = stage(joined.join(firsts, "root").select("v1", "v2", "n_links", "component_id"))
    named = named.withColumn("usable", F.lit(True))
    result = rows.join(named, ["usable", "v1", "v2"], "left")
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
