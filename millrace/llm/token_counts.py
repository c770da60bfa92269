"""Token counts: huge documents are encoded in overlapping chunks, which are spliced where both agree.

A document of at most `chunk + overlap` characters is encoded whole. A longer one is cut into chunks
that start every `chunk` characters and reach `overlap` characters into the next one, and the chunks
are dealt to all tasks. Each chunk is encoded with offsets; it reports where words (the pieces that the
tokenizer splits a text into before merging) start in the overlaps at its two ends, and how many
tokens come before. Two neighbours are spliced at the first word start that both have.

Why such a word start is stable: whether a word ends at a place depends only on the text before it
and on `Margin` characters after it, which the left chunk has seen, as places nearer to its end are not
reported. So a word start of the left chunk, right from its own splice on, is one of the whole text's.
The search for words has no memory: from a place where a word starts, it goes on with the text after
it alone. So the right chunk, which has a word start there too, has the whole text's tokens from there
on, up to its own end. Merges do not cross words.

Where two neighbours have no word start in common, as inside a word longer than the overlap, the
document is cut anew with chunks and overlaps four times as long, until all its neighbours agree or
one chunk holds it.

NULL counts as empty and has no tokens. Strings of special tokens inside a text are what the
library makes of them. Repeated rows each get their own row. Other columns stay; an input column named
as a new one is replaced. Empty tables give no rows.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType
from tokenizers import Tokenizer

from millrace.llm.rows import fresh, slices
from millrace.session import stage

CHUNK = 1 << 16  # characters from one chunk's start to the next one's
OVERLAP = 1 << 10
SEAMS = (
    "key string, chunk long, last boolean, n_tokens long, "
    "starts array<long>, starts_before array<long>, ends array<long>, ends_before array<long>"
)


class Counter:
    """Counts tokens with one tokenizer, given as the text of its file."""

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task on each core
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.margin = margin(spec)

    def counts(self, texts: list[str | None]) -> list[int]:
        found = self.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
        return [len(e) for e in found]

    def word_starts(self, text: str) -> tuple[list[int], list[int], int]:
        """Places where words start, how many tokens come before each, and the number of all tokens."""
        found = self.tokenizer.encode(text, add_special_tokens=False)
        places, before, last = [], [], -1
        for n, (word, (place, _)) in enumerate(zip(found.word_ids, found.offsets)):
            if word != last or word is None:
                places.append(place)
                before.append(n)
                last = word
        return places, before, len(found)


def margin(spec: str) -> int | None:
    """How many characters after a place settle whether a word ends there; None if that is not known.

    Known for a byte-level splitter without a prefix space, whose longest look-ahead is a contraction's
    three characters, with no normaliser and plain special strings: these can reach across a place by
    their length.
    """
    parts = json.loads(spec)
    splitter = parts.get("pre_tokenizer") or {}
    added = parts.get("added_tokens") or []
    known = (
        parts.get("normalizer") is None
        and splitter.get("type") == "ByteLevel"
        and splitter.get("use_regex", True)
        and not splitter.get("add_prefix_space", True)
        and parts.get("post_processor") is None
        and not any(a.get("lstrip") or a.get("rstrip") or a.get("single_word") for a in added)
    )
    return max([3, *(len(a["content"]) for a in added)]) + 1 if known else None


@lru_cache(maxsize=2)
def _counter(spec: str) -> Counter:
    """One tokenizer per file and Python worker, kept between tasks."""
    return Counter(spec)


def read_tokenizer(path: str) -> str:
    """The tokenizer's file, read by the driver; it goes to the executors as a broadcast of its size."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def count_tokens(
    docs: DataFrame,
    spec: str,
    text: str = "text",
    n_tokens: str = "n_tokens",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """`docs` with the number of tokens of `text`.

    Tokenizers for which `margin` knows no proof encode each document whole, however long.
    """
    if not 0 < overlap <= chunk:
        raise ValueError("the overlap must have at least one character and at most a chunk's length")
    docs = docs.drop(n_tokens) if n_tokens != text else docs
    if margin(spec) is None:
        return _whole(docs, spec, text, n_tokens)
    if overlap <= margin(spec):
        raise ValueError(f"the overlap must be longer than {margin(spec)} characters")
    is_long = F.coalesce(F.char_length(text) > chunk + overlap, F.lit(False))
    key, total = fresh(docs, "_key", "_total")
    spliced = splice_counts(docs.where(is_long).select(F.col(text).alias("text")), spec, chunk, overlap)
    spliced = spliced.select(F.col("key").alias(key), F.col("n_tokens").alias(total))
    long = docs.where(is_long).withColumn(key, F.md5(text)).join(spliced, key)
    long = long.select(*[docs_column(long, c) for c in docs.columns], F.col(total).alias(n_tokens))
    return _whole(docs.where(~is_long), spec, text, n_tokens).unionByName(long)


def docs_column(df: DataFrame, name: str) -> Column:
    return df[f"`{name}`"]


def _whole(docs: DataFrame, spec: str, text: str, n_tokens: str) -> DataFrame:
    broadcast = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(broadcast.value)
        for part in slices(batches):
            counts = pa.array(counter.counts(part.column(text).to_pylist()), pa.int64())
            yield pa.record_batch([*part.columns, counts], names=[*part.schema.names, n_tokens])

    return docs.mapInArrow(run, StructType(list(docs.schema.fields)).add(n_tokens, LongType()))


def splice_counts(texts: DataFrame, spec: str, chunk: int, overlap: int) -> DataFrame:
    """(key, n_tokens) of long texts by the MD5 of the text; equal texts get one row.

    Each round takes the texts that no round before could splice. Its seams are staged, so a round
    starts from files and the number of rounds is that of how often a text can be cut into four.
    """
    done = None
    while True:
        seams = stage(_encode_chunks(texts, spec, chunk, overlap))
        spliced = stage(splice(seams))
        good = spliced.where("n_open = 0").select("key", "n_tokens")
        done = good if done is None else done.unionByName(good)
        open_keys = spliced.where("n_open > 0").select("key")
        if open_keys.isEmpty():
            return done
        texts = texts.withColumn("key", F.md5("text")).join(open_keys, "key", "left_semi").select("text")
        chunk, overlap = 4 * chunk, 4 * overlap


def _encode_chunks(texts: DataFrame, spec: str, chunk: int, overlap: int) -> DataFrame:
    """SEAMS: a row for each chunk, with the word starts in the overlaps at its ends, from the text's start."""
    broadcast = texts.sparkSession.sparkContext.broadcast(spec)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            key, text = part.column("key")[0].as_py(), part.column("text")[0].as_py()
            n_chunks = max(1, -(-(len(text) - overlap) // chunk))
            for n in range(n_chunks):
                last = n == n_chunks - 1
                piece = text[n * chunk : None if last else (n + 1) * chunk + overlap]
                yield pa.record_batch([[key], [n], [last], [piece]], names=["key", "chunk", "last", "piece"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(broadcast.value)
        schema = None
        for part in slices(batches, 1):
            row = {name: part.column(name)[0].as_py() for name in ("key", "chunk", "last", "piece")}
            begin, piece = row["chunk"] * chunk, row.pop("piece")
            places, before, row["n_tokens"] = counter.word_starts(piece)
            found = list(zip(places, before))
            head = [(begin + p, b) for p, b in found if p < overlap] if begin else []
            tail = [(begin + p, b) for p, b in found if chunk <= p <= len(piece) - counter.margin]
            tail = [] if row["last"] else tail
            row |= {"starts": [p for p, _ in head], "starts_before": [b for _, b in head]}
            row |= {"ends": [p for p, _ in tail], "ends_before": [b for _, b in tail]}
            schema = schema or pa.schema(
                [("key", pa.string()), ("chunk", pa.int64()), ("last", pa.bool_()), ("n_tokens", pa.int64())]
                + [(n, pa.list_(pa.int64())) for n in ("starts", "starts_before", "ends", "ends_before")]
            )
            yield pa.RecordBatch.from_pylist([row], schema)

    keyed = texts.select(F.md5("text").alias("key"), "text")
    chunks = keyed.mapInArrow(cut, "key string, chunk long, last boolean, piece string")
    # Deals the chunks to all tasks; copies of a text fall together, most of them before the shuffle.
    return chunks.dropDuplicates(["key", "chunk"]).mapInArrow(encode, SEAMS)


def splice(seams: DataFrame) -> DataFrame:
    """(key, n_tokens, n_open) from SEAMS: `n_open` neighbours without a word start in common.

    The tokens of a text are those of its last chunk and, for each splice, what the left chunk has
    before it less what the right one has.
    """
    left = seams.where("NOT last").select("key", (F.col("chunk") + 1).alias("chunk"), "ends", "ends_before")
    pairs = seams.drop("ends", "ends_before").join(left, ["key", "chunk"], "left")
    place = F.array_min(F.array_intersect("ends", "starts"))
    at = lambda places, counts: F.get(F.col(counts), (F.array_position(places, place) - 1).cast("int"))
    step = F.when(F.col("chunk") > 0, at("ends", "ends_before") - at("starts", "starts_before"))
    total = F.when(F.col("last"), F.col("n_tokens")).otherwise(0)
    sums = pairs.select("key", "chunk", total.alias("total"), step.alias("step")).groupBy("key")
    return sums.agg(
        (F.sum("total") + F.sum(F.coalesce("step", F.lit(0)))).alias("n_tokens"),
        F.count_if((F.col("chunk") > 0) & F.col("step").isNull()).alias("n_open"),
    )
