"""Language ID with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from its code point. An n-gram's vector binds its
letters' vectors, permuted by their place, by multiplication. A text's vector is the bundle (sum) of
its n-grams' vectors, and a language's prototype the bundle of all its texts. A text is given the
language whose prototype has the largest cosine with the text's vector; of equal ones the first in
the order of names.

Letters are the characters that Unicode calls so, in lower case; every run of others counts as one
space. Prototypes are learnt from all rows with a language: each task bundles its rows, and Spark
adds the bundles up. What comes to the driver is one vector per language.

A NULL text, or one without a letter, is `UNKNOWN` with score 0; so is any text where there is nothing
to learn from. Rows with a NULL language are not learnt from. Repeated rows are learnt from each
time. Texts are read whole, a piece at a time. Other columns stay, but for one named as a new column,
which is replaced. Empty tables give no rows, or no prototypes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.rows import fresh, slices

UNKNOWN = "und"
DIM = 1024
NGRAM = 3
SEED = 7
PIECE = 1 << 18  # characters that are bundled at a time
BLOCK = 1 << 12  # distinct n-grams that are bound at a time
KNOWN = 1 << 16  # letters whose vectors a worker keeps
SPACE = 32


class Letters:
    """Random vectors of code points, each made when it is first seen."""

    def __init__(self, dim: int = DIM, ngram: int = NGRAM, seed: int = SEED):
        self.dim, self.ngram, self.seed = dim, ngram, seed
        self.letter = np.zeros(0x110000, np.int8)  # 0: not looked at, 1: a letter, 2: none
        self.place = np.full(0x110000, -1, np.int32)  # of a letter's vector in the table
        self.table = np.zeros((0, dim), np.int8)

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """The vectors of distinct code points; the table keeps those of up to KNOWN letters."""
        new = codes[self.place[codes] < 0]
        if len(new):
            if len(self.table) + len(new) > KNOWN:
                self.place[:], self.table, new = -1, self.table[:0], codes
            made = [np.random.default_rng([self.seed, c]).integers(0, 2, self.dim, np.int8) for c in new.tolist()]
            self.place[new] = np.arange(len(self.table), len(self.table) + len(new))
            self.table = np.concatenate([self.table, np.array(made, np.int8) * 2 - 1])
        return self.table[self.place[codes]]

    def codes(self, text: str) -> np.ndarray:
        """Code points of a text in lower case: letters, with one space for each run of others."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        new = np.unique(points[self.letter[points] == 0])
        if len(new):
            self.letter[new] = [1 if chr(c).isalpha() else 2 for c in new.tolist()]
        points = np.where(self.letter[points] == 1, points, SPACE)
        points = np.concatenate([[SPACE], points, [SPACE]]).astype(np.int64)
        return points[np.concatenate([[True], (points[1:] != SPACE) | (points[:-1] != SPACE)])]

    def grams(self, points: np.ndarray) -> np.ndarray:
        """Numbers of the n-grams, in order."""
        n = len(points) - self.ngram + 1
        numbers = np.zeros(max(n, 0), np.int64)
        for i in range(self.ngram if n > 0 else 0):
            numbers = numbers << 21 | points[i : i + n]
        return numbers

    def bound(self, numbers: np.ndarray) -> np.ndarray:
        """One vector per n-gram: its letters' vectors, permuted by their place and multiplied."""
        product = np.ones((len(numbers), self.dim), np.int8)
        for i in range(self.ngram):
            codes, where = np.unique(numbers >> 21 * i & 0x1FFFFF, return_inverse=True)
            product *= np.roll(self.vectors(codes), i, axis=1)[where]
        return product.astype(np.float32)

    def bundles(self, texts: list[np.ndarray]) -> np.ndarray:
        """The sum of the n-grams' vectors of each text, given as its n-grams.

        At most BLOCK distinct n-grams of a piece are bound and counted at a time. All sums are whole
        numbers, small enough in a piece for 32-bit floats to hold them exactly.
        """
        total = np.zeros((len(texts), self.dim), np.float64)
        row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        flat = np.concatenate(texts) if texts else np.zeros(0, np.int64)
        for at in range(0, len(flat), PIECE):
            numbers, which = np.unique(flat[at : at + PIECE], return_inverse=True)
            rows, low = row[at : at + PIECE], row[at]
            order = np.argsort(which, kind="stable")
            n, cuts = int(rows[-1] - low) + 1, range(0, len(numbers) + BLOCK, BLOCK)
            ends = np.searchsorted(which[order], cuts)
            for begin, first, last in zip(cuts, ends, ends[1:]):
                own = numbers[begin : begin + BLOCK]
                some = order[first:last]
                places = (rows[some] - low) * len(own) + which[some] - begin
                counts = np.bincount(places, minlength=n * len(own)).reshape(n, -1)
                total[low : low + n] += counts.astype(np.float32) @ self.bound(own)
        return total


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """The prototype of each language: the bundle of all n-grams of all its texts."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums = Letters(), {}
        for part in slices(batches):
            langs = np.array(part.column("lang").to_pylist(), object)
            texts = part.column("text").to_pylist()
            for name in set(langs):
                grams = [letters.grams(letters.codes(texts[i])) for i in np.flatnonzero(langs == name)]
                sums[name] = sums.get(name, 0) + letters.bundles([np.concatenate(grams)])[0]
        yield pa.record_batch(
            [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
            names=["lang", "vector"],
        )

    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")
    parts = rows.mapInArrow(bundle, "lang string, vector array<double>")
    sums = parts.select("lang", F.posexplode("vector").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    found = sums.toPandas()  # languages x DIM numbers
    found = found.sort_values(["lang", "at"])
    return {name: group["x"].to_numpy() for name, group in found.groupby("lang")}


def predict(
    docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", columns: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """`docs` with the predicted language and the cosine, not less than 0, as its score."""
    names = sorted(prototypes)
    matrix = np.array([prototypes[n] for n in names], np.float64).reshape(len(names), DIM)
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for part in slices(batches):
            codes = [letters.codes(t or "") for t in part.column(text).to_pylist()]
            known = [bool(names) and bool((c != SPACE).any()) for c in codes]
            langs, scores = [UNKNOWN] * len(codes), [0.0] * len(codes)
            if any(known):
                vectors = letters.bundles([letters.grams(c) for c in codes])
                norms = np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)
                cosines = vectors @ matrix.T / norms[:, None]
                best = cosines.argmax(axis=1)
                for i in np.flatnonzero(known).tolist():
                    langs[i] = names[best[i]]
                    scores[i] = float(min(1.0, max(0.0, cosines[i, best[i]])))
            new = [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.record_batch([*part.columns, *new], names=[*part.schema.names, *columns])

    kept = docs.drop(*columns)
    return kept.mapInArrow(run, StructType(list(kept.schema.fields)).add(columns[0], "string").add(columns[1], "double"))


def keep_known(
    docs: DataFrame, prototypes: dict[str, np.ndarray], min_score: float, text: str = "text"
) -> DataFrame:
    """`docs` without the rows whose language is unknown or is told with a lower score."""
    columns = tuple(fresh(docs, "_lang", "_score"))
    found = predict(docs, prototypes, text, columns)
    return found.where((F.col(columns[0]) != UNKNOWN) & (F.col(columns[1]) >= min_score)).select(*docs.columns)
