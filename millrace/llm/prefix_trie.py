"""Conversation prefix trie: a burst trie over the turns of all conversations.

A node is a distinct sequence of first turns; its members are the conversations that start with it.

1. A turn's id is the 128-bit hash of its role and text. A conversation's path is the list of the hashes
   of its prefixes, a polynomial in the ids modulo a prime, so that the runs (`segments`) of a long
   conversation are hashed apart and chained by a narrow scan.
2. All conversations begin in one container, under the root. A container of more than `limit` turns is
   burst by the next turn's id into containers one turn deeper, each under the head that the next
   prefix is. One aggregate over the prefixes of the conversations still in oversized containers settles
   1, 2, 4, … levels of bursts at a time, so the rounds grow with the logarithm of the depth.
3. The containers that remain are dealt to shards by their heads. A shard sorts its conversations by
   head and path and sweeps them: a stack holds the path at hand, and a node is closed when the next
   path leaves it. A sweep holds one container, at most `limit` turns.
4. Burst nodes are put together from aggregates. Each node belongs to its smallest member. What lies
   below a burst node is the sum, over its members, of what nodes and containers of their own they
   have at its depth and deeper: a running sum per conversation, then a sum per node.

Rows are ordered by turn (NULLs first), role and the turn's id. NULL role or text counts as empty. Rows
without a conversation id are left out, as they are no conversation. Repeated rows are turns of their own.
Equal conversations share all their nodes. Texts of any length count whole. Other columns are left
out. Empty tables give no rows, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.rows import slices
from millrace.llm.segments import digest, pack, scan, split_groups
from millrace.session import stage

LIMIT = 1 << 14  # turns of a container
PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"base of the prefix hash").digest()) % PRIME
ROOT = bytes(16)


def pack_conversations(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, seg, start, first, ids, chars): runs of turns, `first` the number of turns in the runs before.

    `start` marks the conversation's first run.
    """
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    named = rows.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        role_.alias("role"),
        F.unhex(F.md5(F.concat(F.char_length(role_), F.lit(":"), role_, text_))).alias("ids"),
        F.char_length(text_).alias("chars"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("ids")]
    packed = stage(pack(named, "conv_id", order, ["ids", "chars"]))
    split = stage(split_groups(packed, "conv_id")).select("conv_id")

    def count(last: dict | None, row: dict) -> dict:
        first = last["next"] if last else 0
        return {"seg": row["seg"], "first": first, "next": first + row["n"]}

    sizes = packed.select("conv_id", "seg", F.size("ids").alias("n")).join(split, "conv_id", "left_semi")
    firsts = stage(scan(sizes, "conv_id", count, "seg long, first long, next long")).select("seg", "first")
    first = F.coalesce("first", F.lit(0)).cast("long")
    joined = packed.join(firsts, "seg", "left")
    return joined.select("conv_id", "seg", (first == 0).alias("start"), first.alias("first"), "ids", "chars")


def paths(packed: DataFrame) -> DataFrame:
    """(conv_id, seg, first, length, path, chars): the prefixes' hashes; the root comes first, so `first` counts it too.

    `length` is the number of all prefixes of the conversation.
    """
    id_type = packed.schema["conv_id"].dataType.simpleString()

    def run_hash(ids: list[bytes], h: int) -> list[int]:
        found = []
        for turn in ids:
            h = (h * BASE + int.from_bytes(turn) + 1) % PRIME
            found.append(h)
        return found

    def whole_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hashes = [run_hash(ids, 0)[-1:] or [0] for ids in part.column("ids").to_pylist()]
            own = pa.array([h[0].to_bytes(16) for h in hashes], pa.binary())
            sizes = pa.array([len(ids) for ids in part.column("ids")], pa.int64())
            columns = [part.column("conv_id"), part.column("seg"), own, sizes]
            yield pa.record_batch(columns, names=["conv_id", "seg", "own", "n"])

    def chain(last: dict | None, row: dict) -> dict:
        begin = int.from_bytes(last["after"]) if last else 0
        after = (begin * pow(BASE, row["n"], PRIME) + int.from_bytes(row["own"])) % PRIME
        n = (last["n"] if last else 0) + row["n"]
        return {"conv_id": row["conv_id"], "seg": row["seg"], "begin": begin.to_bytes(16), "after": after.to_bytes(16), "n": n}

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found, chars = [], []
            rows = zip(*(part.column(c).to_pylist() for c in ("start", "begin", "ids", "chars")))
            for start, begin, ids, sizes in rows:
                path = [h.to_bytes(16) for h in run_hash(ids, int.from_bytes(begin))]
                found.append([ROOT, *path] if start else path)
                chars.append([0, *sizes] if start else sizes)
            kept = {c: part.column(c) for c in ("conv_id", "seg", "first", "length")}
            kept |= {"path": pa.array(found, pa.list_(pa.binary())), "chars": pa.array(chars, pa.list_(pa.int32()))}
            yield pa.record_batch(list(kept.values()), names=list(kept))

    split = stage(split_groups(packed, "conv_id")).select("conv_id")
    parts = packed.join(split, "conv_id", "left_semi").mapInArrow(
        whole_hash, f"conv_id {id_type}, seg long, own binary, n long"
    )
    schema = f"conv_id {id_type}, seg long, begin binary, after binary, n long"
    chained = stage(scan(parts, "conv_id", chain, schema))
    lengths = chained.groupBy("conv_id").agg(F.max("n").alias("all"))
    known = stage(chained.join(lengths, "conv_id").select("seg", "begin", (F.col("all") + 1).alias("length")))
    joined = packed.join(known, "seg", "left").select(
        "conv_id",
        "seg",
        "start",
        F.when(F.col("start"), 0).otherwise(F.col("first") + 1).cast("long").alias("first"),
        F.coalesce("length", F.size("ids") + 1).cast("long").alias("length"),
        F.coalesce("begin", F.lit(ROOT)).alias("begin"),
        "ids",
        "chars",
    )
    return joined.mapInArrow(
        prefixes, f"conv_id {id_type}, seg long, first long, length long, path array<binary>, chars array<int>"
    )


def burst(found: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(conv_id, depth, prefix, chars, n_left, n_convs, first_id, size): the burst prefixes of each conversation.

    `found` are staged `paths`; `n_left` counts the conversation's prefixes from this one on, `size` those
    of all members. Prefixes nest, so a conversation's burst ones are those above its container.
    """
    done, low, high, active = None, 0, 1, None
    while True:
        rows = found.where((F.col("first") < high) & (F.col("first") + F.size("path") > low))
        if active is not None:
            rows = rows.join(active, "conv_id", "left_semi")
        rows = rows.select("conv_id", "first", "length", F.posexplode(F.arrays_zip("path", "chars")).alias("pos", "at"))
        depth = F.col("first") + F.col("pos")
        rows = rows.select(
            "conv_id", depth.alias("depth"), F.col("at.path").alias("prefix"), F.col("at.chars").alias("chars"),
            (F.col("length") - depth).alias("n_left"),
        ).where((F.col("depth") >= low) & (F.col("depth") < high))
        counted = rows.groupBy("prefix").agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("first_id"), F.sum("n_left").alias("size")
        )
        large = stage(counted.where(F.col("size") > limit))
        level = stage(rows.join(large, "prefix"))
        done = level if done is None else done.unionByName(level)
        active = level.where((F.col("depth") == high - 1) & (F.col("n_left") > 1)).select("conv_id")
        if active.isEmpty():
            return done
        low, high = high, 2 * high + 1


NODES = (
    "conv_id {0}, depth long, parent_conv_id {0}, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, is_head boolean"
)


class _Node:
    __slots__ = ("depth", "chars", "above", "first_id", "n_convs", "n_children", "n_leaves", "saved", "ends")

    def __init__(self, depth: int, chars: int, above: _Node | None):
        self.depth, self.chars, self.above = depth, chars, above
        self.first_id, self.n_convs, self.n_children, self.n_leaves, self.saved = None, 0, 0, 0, 0
        self.ends: list = []

    def close(self) -> None:
        """All members are known: finish, and add what there is to the node above."""
        self.n_convs += len(self.ends)
        if self.ends:
            self.first_id = self.ends[0] if self.first_id is None else min(self.first_id, self.ends[0])
        self.n_leaves = self.n_leaves or 1
        self.saved += (self.n_convs - 1) * self.chars
        if (up := self.above) is not None:
            up.n_convs += self.n_convs
            up.n_children += 1
            up.n_leaves += self.n_leaves
            up.saved += self.saved
            up.first_id = self.first_id if up.first_id is None else min(up.first_id, self.first_id)

    def row(self) -> tuple:
        up = self.above
        ends = hashlib.sha256(",".join(map(str, self.ends)).encode()).hexdigest()
        counts = (self.n_convs, self.n_children, self.n_leaves, self.saved, ends)
        return (self.first_id, self.depth, up.first_id if up else None, *counts, up is None)


def sweep(rows: Iterator[tuple]) -> Iterator[list[_Node]]:
    """The nodes of each container, from (conversation, depth of the head, path, characters) in the order of path, conversation."""
    nodes: list[_Node] = []
    stack: list[_Node] = []
    last: list = [None]
    for conv, head, path, chars in rows:
        if path[0] != last[0]:
            while stack:
                stack.pop().close()
            if nodes:
                yield nodes
            nodes, last = [], []
        shared, most = 0, min(len(last), len(path))
        while shared < most and last[shared] == path[shared]:
            shared += 1
        while len(stack) > shared:
            stack.pop().close()
        for n in range(shared, len(path)):
            stack.append(_Node(head + n, chars[n], stack[-1] if stack else None))
            nodes.append(stack[-1])
        stack[-1].ends.append(conv)
        last = path
    while stack:
        stack.pop().close()
    if nodes:
        yield nodes


def sweep_containers(found: DataFrame, bursts: DataFrame) -> DataFrame:
    """NODES of all containers; heads have no parent yet."""
    id_type = found.schema["conv_id"].dataType.simpleString()
    schema = NODES.format(id_type)
    heads = bursts.groupBy("conv_id").agg(F.count(F.lit(1)).alias("head"))
    rows = found.join(heads, "conv_id", "left").withColumn("head", F.coalesce("head", F.lit(0)))
    rows = rows.where(F.col("head") < F.col("length"))
    begin = F.greatest(F.col("head") - F.col("first"), F.lit(0)).cast("int") + 1
    cut = lambda c: F.slice(c, begin, F.size(c))
    rows = rows.select("conv_id", "seg", "head", "first", "length", cut("path").alias("path"), cut("chars").alias("chars"))
    rows = rows.where(F.size("path") > 0)
    # What is left of a conversation has at most `limit` turns; it is whole in one run but where runs meet.
    whole = (F.col("length") - F.col("head")) == F.size("path")
    met = rows.where(~whole).groupBy("conv_id", "head").agg(
        F.sort_array(F.collect_list(F.struct("seg", "path", "chars"))).alias("runs")
    )
    met = met.select("conv_id", "head", F.flatten("runs.path").alias("path"), F.flatten("runs.chars").alias("chars"))
    rows = rows.where(whole).select("conv_id", "head", "path", "chars").unionByName(met)
    shards = rows.withColumn("top", F.get("path", F.lit(0))).repartition("top").sortWithinPartitions("path", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list = []

        def rows() -> Iterator[tuple]:
            for part in slices(batches):
                kinds[:] = [part.schema.field("conv_id").type]
                yield from zip(*(part.column(c).to_pylist() for c in ("conv_id", "head", "path", "chars")))

        def batch(nodes: list[tuple]) -> pa.RecordBatch:
            key, long = kinds[0], pa.int64()
            types = [key, long, key, long, long, long, long, pa.string(), pa.bool_()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*nodes), types)], names=names)

        ready: list[tuple] = []
        for nodes in sweep(rows()):
            ready += [n.row() for n in nodes]
            if len(ready) >= 4096:
                yield batch(ready)
                ready = []
        if ready:
            yield batch(ready)

    names = StructType.fromDDL(schema).names
    return shards.select("conv_id", "head", "path", "chars").mapInArrow(run, schema)


def trie(packed: DataFrame, limit: int = LIMIT) -> DataFrame:
    """A row for each node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    found = stage(paths(packed))
    bursts = burst(found, limit)
    swept = stage(sweep_containers(found, bursts))
    own = F.col("conv_id") == F.col("first_id")
    zero = F.lit(0).cast("long")
    burst_rows = bursts.select(
        "conv_id", "depth", "prefix", "n_left", "n_convs", "first_id", own.alias("own"), F.lit(False).alias("is_head"),
        F.when(own, (F.col("n_convs") - 1) * F.col("chars")).otherwise(0).alias("saved"),
        F.when(own & (F.col("size") == F.col("n_convs")), 1).otherwise(0).cast("long").alias("leaves"),
    )
    head_rows = swept.where("is_head").select(
        "conv_id", "depth", F.lit(None).cast("binary").alias("prefix"), zero.alias("n_left"), zero.alias("n_convs"),
        F.col("conv_id").alias("first_id"), F.lit(True).alias("own"), F.lit(True).alias("is_head"),
        F.col("saved_tokens").alias("saved"), F.col("n_leaves").alias("leaves"),
    )
    up = Window.partitionBy("conv_id").orderBy(F.col("depth").desc())
    so_far = up.rowsBetween(Window.unboundedPreceding, 0)
    rows = stage(
        burst_rows.unionByName(head_rows).select(
            "conv_id", "depth", "prefix", "n_left", "n_convs", "first_id", "own", "is_head",
            F.sum("saved").over(so_far).alias("saved"), F.sum("leaves").over(so_far).alias("leaves"),
            F.coalesce(F.lag("own").over(up).cast("long"), zero).alias("child"),
            F.lead("first_id").over(up).alias("above"),
        )
    )
    inner = rows.where("NOT is_head")
    nodes = inner.groupBy("prefix").agg(
        F.min("first_id").alias("conv_id"), F.min("depth").alias("depth"),
        F.min(F.when(F.col("own"), F.col("above"))).alias("parent_conv_id"), F.max("n_convs").alias("n_convs"),
        F.sum("child").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
    )
    ends = inner.where("n_left = 1").select("prefix", "conv_id", F.col("conv_id").cast("string").alias("id"))
    runs = pack(ends, "prefix", ["conv_id"], ["id"]).select("prefix", "seg", F.array_join("id", ",").alias("ids"))
    digests = digest(runs, "prefix", "ids", ",", name="ends_sha256")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    nodes = nodes.join(digests, "prefix", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))
    above = rows.where("is_head").select("conv_id", "depth", F.col("above").alias("_above"))
    swept = swept.join(above, ["conv_id", "depth"], "left")
    swept = swept.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above"))
    columns = [c for c in swept.columns if c not in ("is_head", "_above")]
    return swept.select(columns).unionByName(nodes.select(columns))
