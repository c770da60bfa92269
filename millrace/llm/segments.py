"""Long groups in pieces: rows in the order of a key and more, packed into bounded runs of one key.

A group's rows are sorted over all tasks by range, so a hot key is split wherever its rows differ in the
order, and packed as arrays, at most an Arrow batch in a run. Most groups are one run, which any
task can treat alone. The few that are several runs are solved by a narrow row for each run: `scan`
walks these in order, with one value carried along and nothing kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from millrace.llm.rows import slices


def pack(rows: DataFrame, key: str, order: list[Column | str], values: list[str], seg: str = "seg") -> DataFrame:
    """(key, seg, values as arrays): runs of rows with one key, `seg` ascending in the order of all rows."""
    by = [F.col(key).asc_nulls_first(), *order]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    numbered = ordered.select(key, F.monotonically_increasing_id().alias(seg), *values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column(key).dictionary_encode(null_encoding="encode").indices.to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(codes[1:] != codes[:-1]) + 1]).astype(np.int32)
            offsets = pa.array(np.append(starts, batch.num_rows).astype(np.int32))
            heads = batch.take(pa.array(starts))
            lists = [pa.ListArray.from_arrays(offsets, batch.column(v)) for v in values]
            yield pa.record_batch([heads.column(key), heads.column(seg), *lists], names=[key, seg, *values])

    types = {f.name: f.dataType for f in numbered.schema.fields}
    fields = [StructField(key, types[key]), StructField(seg, LongType())]
    return numbered.mapInArrow(run, StructType(fields + [StructField(v, ArrayType(types[v])) for v in values]))


def split_groups(packed: DataFrame, key: str) -> DataFrame:
    """The keys that have more than one run, with their number."""
    return packed.groupBy(key).agg(F.count(F.lit(1)).alias("n_runs")).where("n_runs > 1")


def scan(
    runs: DataFrame, key: str, step: Callable[[dict | None, dict], dict], schema: str, down: bool = False, seg: str = "seg"
) -> DataFrame:
    """One row out for each run: `step` of what it gave for the key's run before (None at first) and the run's row.

    The runs of a key go through one task, in order; only the last result is kept. Each run stands for up
    to an Arrow batch of rows, so these rows are few.
    """
    place = F.col(seg).desc() if down else F.col(seg).asc()
    ordered = runs.repartition(key).sortWithinPartitions(F.col(key).asc_nulls_first(), place)
    target = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, last = None, None
        for batch in batches:
            found = []
            for n in range(batch.num_rows):
                row = {name: batch.column(name)[n].as_py() for name in batch.schema.names}
                if last is None or row[key] != at:
                    at, last = row[key], None
                last = step(last, row)
                found.append(last)
            if found:
                out = {f.name: [r[f.name] for r in found] for f in target.fields}
                yield pa.record_batch([pa.array(c) for c in out.values()], names=list(out))

    return ordered.mapInArrow(run, schema)


def digest(runs: DataFrame, key: str, body: str, separator: str, seg: str = "seg", name: str = "sha256") -> DataFrame:
    """(key, SHA-256 in hex) of the bodies of a key's runs, joined by the separator; NULL bodies are left out.

    The digest can't be put together from parts, so one task sees a key's runs in turn; it holds one
    body at a time.
    """
    ordered = runs.select(key, seg, body).repartition(key)
    ordered = ordered.sortWithinPartitions(F.col(key).asc_nulls_first(), seg)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, found, begun, schema = None, None, False, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{key: at, name: found.hexdigest()}], schema)

        for part in slices(batches, 1):
            schema = schema or pa.schema([part.schema.field(key), (name, pa.string())])
            value, text = part.column(key)[0].as_py(), part.column(body)[0].as_py()
            if found is None or value != at:
                if found is not None:
                    yield row()
                at, found, begun = value, hashlib.sha256(), False
            if text is not None:
                found.update(((separator if begun else "") + text).encode())
                begun = True
        if found is not None:
            yield row()

    return ordered.mapInArrow(run, StructType([runs.schema[key]]).add(name, "string"))
