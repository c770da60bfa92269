"""SentencePiece encoding and decoding, for models of the merge (BPE) type.

An encoding is fixed by its pairs: pieces follow one another in an encoding if and only if each two
neighbours do so alone, that is, if the two pieces' text is encoded as these two. So the last piece
of each prefix of a text is unique, and can be told from those of shorter prefixes:

1. An Aho-Corasick automaton finds all pieces that end at a character.
2. Such a piece is the prefix's last if what lies before it is empty, or if the last piece of what
   lies before it is compatible with it. Exactly one is. It goes into the prefix table.
3. The ids are read off the table backwards.

Whether two pieces are compatible is found by merging their characters in the order of the model's
scores, once per pair and Python worker. A character that no piece has is written as its bytes.

A text is cut before a space mark that follows another character, where no piece reaches across;
such a stretch's ids are kept for its next use, in a table of bounded size.

NULL counts as empty, and an empty text has no ids. Texts of any length are encoded whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from millrace.llm.rows import slices

SPACE = "▁"
KEPT = 3 << 17  # stretches in each of the two halves of a worker's table


class Encoder:
    """Encodes and decodes with one model, given as the bytes of its file."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        sp = self.library
        special = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
        pieces = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not special(i)}
        self.score = {p: sp.get_score(i) for p, i in pieces.items()}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.pieces = sorted(pieces, key=pieces.get)
        self.number = {p: n for n, p in enumerate(self.pieces)}
        self.ids = [pieces[p] for p in self.pieces]
        self.automaton = ahocorasick.Automaton()
        for piece, n in self.number.items():
            if self._merged(piece) == [piece]:  # the others never come out of merging
                self.automaton.add_word(piece, (len(piece), n))
        self.automaton.make_automaton()
        self.fits: dict[int, bool] = {}
        self.young: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}
        across = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        self.stretch = re.compile(r"(?s).+" if across else f"(?s){SPACE}*[^{SPACE}]*")

    def _merged(self, text: str) -> list[str]:
        """The pieces of a short text: the best-scored neighbours are joined first, the left one of equals."""
        parts = list(text)
        while len(parts) > 1:
            joined = [self.score.get(a + b) for a, b in zip(parts, parts[1:])]
            best = max((s for s in joined if s is not None), default=None)
            if best is None:
                break
            i = joined.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the two pieces' text is encoded as these two."""
        a, b = self.pieces[left], self.pieces[right]
        if len(self.fits) > 8 * KEPT:
            self.fits.clear()
        known = self.fits[left * len(self.pieces) + right] = self._merged(a + b) == [a, b]
        return known

    def prefix_table(self, text: str) -> tuple[list[int], list[int]]:
        """Length and number of the last piece of each prefix; number -1 for a character of no piece."""
        length, last = [1] * (len(text) + 1), [-1] * (len(text) + 1)
        width, known = len(self.pieces), self.fits.get
        for end, (size, piece) in self.automaton.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            if before := end - size:
                left = last[before]
                if left >= 0:
                    fits = known(left * width + piece)
                    if fits is None:
                        fits = self._compatible(left, piece)
                    if not fits:
                        continue
            length[end], last[end] = size, piece
        return length, last

    def _stretch_ids(self, text: str) -> list[int]:
        length, last = self.prefix_table(text)
        ids: list[int] = []
        end = len(text)
        while end:
            if last[end] >= 0:
                ids.append(self.ids[last[end]])
            else:
                ids.extend(self.bytes[b] for b in reversed(text[end - 1].encode()))
            end -= length[end]
        ids.reverse()
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        ids: list[int] = []
        young, old = self.young, self.old
        for stretch in self.stretch.findall(SPACE + text.replace(" ", SPACE)):
            found = young.get(stretch)
            if found is None:
                if not stretch:
                    continue
                found = old.get(stretch)
                if found is None:
                    found = self._stretch_ids(stretch)
                if len(stretch) <= 64:
                    young[stretch] = found
            ids += found
        if len(young) > KEPT:  # what was not used since the last time goes
            self.young, self.old = {}, young
        return ids

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids) if ids else ""


@lru_cache(maxsize=2)
def _encoder(model: bytes) -> Encoder:
    """One encoder per model and Python worker, kept between tasks."""
    return Encoder(model)


def read_model(path: str) -> bytes:
    """The model's file, read by the driver; it goes to the executors as a broadcast of its size."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: bytes, text: str = "text", ids: str = "ids") -> DataFrame:
    """`docs` with the array of ids of `text`."""
    return _mapped(docs, model, text, ids, None)


def encode_and_decode(
    docs: DataFrame, model: bytes, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """`docs` with the ids of `text` and the text that they decode to, in one pass."""
    return _mapped(docs, model, text, ids, decoded)


def decode(docs: DataFrame, model: bytes, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """`docs` with the text that an array of ids decodes to; a NULL array gives an empty text."""
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(broadcast.value)
        for part in slices(batches):
            lists = part.column(ids).to_pylist()
            yield _extended(part, {decoded: pa.array([encoder.decode(x or []) for x in lists], pa.string())})

    kept = docs.drop(decoded)
    return kept.mapInArrow(run, _schema(kept).add(decoded, "string"))


def _mapped(docs: DataFrame, model: bytes, text: str, ids: str, decoded: str | None) -> DataFrame:
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(broadcast.value)
        for part in slices(batches):
            lists = [encoder.encode(t) for t in part.column(text).to_pylist()]
            ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            flat = np.fromiter((i for x in lists for i in x), np.int32, int(ends[-1]))
            new = {ids: pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))}
            if decoded:
                new[decoded] = pa.array([encoder.decode(x) for x in lists], pa.string())
            yield _extended(part, new)

    kept = docs.drop(ids, *([decoded] if decoded else []))
    schema = _schema(kept).add(ids, ArrayType(IntegerType()))
    return kept.mapInArrow(run, schema.add(decoded, "string") if decoded else schema)


def _schema(df: DataFrame) -> StructType:
    """The schema as a copy that can be added to."""
    return StructType(list(df.schema.fields))


def _extended(part: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.record_batch([*part.columns, *new.values()], names=[*part.schema.names, *new])


def digests(encoded: DataFrame, doc_id: str = "doc_id", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    joined = F.array_join(F.col(ids).cast("array<string>"), ",")
    return encoded.select(
        doc_id,
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2(decoded, 256).alias("decoded_sha256"),
    )
