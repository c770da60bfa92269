"""What the operators share: names that clash with no column, keys of rows, small slices of a batch."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores as it takes to differ from the columns of `df`."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def fold(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def row_key(doc_id: str, text: str) -> list[Column]:
    """Two hashes that tell rows apart by id and text; NULLs are values of their own.

    What the operators find out about a row depends on its text alone, so rows that share both
    hashes get the same answer, whether their id is repeated or NULL.
    """
    return [F.xxhash64(F.col(doc_id)), F.xxhash64(F.col(text))]


def with_key(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, list[str]]:
    names = fresh(docs, "_k1", "_k2")
    return docs.withColumns(dict(zip(names, row_key(doc_id, text)))), names


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Rows with the same values of `keys`, which come together, as one table each."""
    import numpy as np

    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        columns = [table.column(key).to_numpy() for key in keys]
        changes = np.any([values[1:] != values[:-1] for values in columns], axis=0)
        cuts = [0, *(np.flatnonzero(changes) + 1).tolist()]
        for begin, end in zip(cuts, cuts[1:]):
            yield table.slice(begin, end - begin)
        rest = table.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield rest
