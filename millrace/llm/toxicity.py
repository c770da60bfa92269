"""Toxicity by a support vector machine on a subsequence string kernel, with Nystroem landmarks.

The kernel of two strings counts their common subsequences of `ORDER` letters, each step of which may
skip up to `GAP` - 1 letters on either side at the price of `DECAY` per letter skipped. So a word
with inserted or missing letters still resembles the word that it hides, and so does one with an
ending of its own.

A text's units are its words, letters only, in lower case; digits and signs that stand for letters
inside a word are read as these, and letters that are spelled one by one are put together. Words of
more than `UNIT` letters are cut into overlapping units; those of two or three letters get a mark at
both ends. The kernel of two units is scaled to 1 for a unit and itself, and raised to the power `POWER`,
which is a kernel again and tells likeness from chance. The kernel of two texts is the sum over all
pairs of units of their distinct words.

1. Landmarks are letter runs that toxic training texts have far more often than others, chosen so
   that they do not resemble one another.
2. A unit is mapped by its kernel values with the landmarks, times the inverse square root of the landmarks'
   own kernel matrix (Nystroem), and a text is the sum of its units.
3. A linear machine with squared hinge loss separates these vectors; its margin becomes a score from 0 to 1 by a logistic curve fitted on the training rows.

The machine is fitted on a bounded sample of labelled rows (`SAMPLE` of each class at most, those
with the smallest hash of their id); counting their words is a Spark job. Scores are made of whole
texts in the tasks.

A NULL text is scored like an empty one, by the machine's offset. Several labels of one id count as
toxic if any is; NULL labels do not count. With no rows of one class, or no letter run that tells the
classes apart (it must be in three toxic training texts), there is nothing to learn, and every score is 0.
Equally good landmarks are taken in the order of their letters. Repeated rows are scored alike. Texts of any
length are read whole, in time proportional to their length. Other columns stay, but for one named as
the new column, which is replaced. Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructType

from millrace.llm.rows import slices
from millrace.session import stage

ORDER, GAP, DECAY = 4, 3, 0.5
POWER = 4
UNIT = 24
LANDMARKS = 32
CANDIDATES = 1 << 14  # of landmarks, best first, that the driver chooses among
LEAST_ODDS = 3.0  # natural logarithm, of a landmark in toxic against other training texts
SAMPLE = 4000
KEPT = 3 << 17  # words in each of the two halves of a worker's table
SIGNS = str.maketrans("@$!013457", "asioleast")
INSIDE = re.compile(r"(?<=[^\W\d_])[@$!013457]+(?=[^\W\d_])")
FIRST, LAST = "^$"  # marks of a short word's ends
LETTER, ONLY_SIGNS = re.compile(r"[^\W\d_]\W*\Z"), re.compile(r"\W+\Z")


def words_of(text: str) -> set[str]:
    """The distinct words of a text, and the words that are spelled letter by letter: three or more single letters in a row."""
    words = text.lower().split()
    found, letters, spelled = set(words), 0, []
    for word in [*words, "end"]:
        if LETTER.match(word):
            letters += 1
            spelled.append(word)
        elif spelled and ONLY_SIGNS.match(word):
            spelled.append(word)
        else:
            if letters > 2:
                found.add("".join(spelled))
            letters, spelled = 0, []
    return found


def units_of(word: str) -> list[str]:
    """The units of one word."""
    word = INSIDE.sub(lambda m: m[0].translate(SIGNS), word)
    letters = "".join(filter(str.isalpha, word))
    if len(letters) < ORDER:
        return [f"{FIRST}{letters}{LAST}"] if len(letters) >= ORDER - 2 else []
    if len(letters) <= UNIT:
        return [letters]
    return [letters[at : at + UNIT] for at in range(0, len(letters) - UNIT // 2, UNIT // 2)]


def _matrix(strings: list[str]) -> np.ndarray:
    """Code points of strings of at most UNIT letters, filled up with 0."""
    padded = "".join(s.ljust(UNIT, "\0")[:UNIT] for s in strings)
    return np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, UNIT)


def _subsequences(points: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
    """For each way of skipping letters: its price, and the subsequences' codes, one row per string."""
    width = points.shape[1]
    for steps in product(range(1, GAP + 1), repeat=ORDER - 1):
        ends = np.cumsum([0, *steps]).tolist()
        n = width - ends[-1]
        if n > 0:
            code = np.zeros((len(points), n), np.uint64)
            for at in ends:
                code = code << np.uint64(64 // ORDER) | points[:, at : at + n]
            yield DECAY ** (ends[-1] - ORDER + 1), code


def _hash(codes: np.ndarray) -> np.ndarray:
    return codes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(46)


def _own_kernel(points: np.ndarray) -> np.ndarray:
    """The kernel of each string with itself."""
    letters, small = np.unique(points, return_inverse=True)
    small = small.reshape(points.shape).astype(np.uint64) + np.uint64(letters[0] != 0)
    listed = [(np.where(Landmarks._whole(c), c, 0), p) for p, c in _subsequences(small)]
    codes = np.concatenate([c for c, _ in listed], axis=1)
    prices = np.concatenate([np.full(c.shape[1], p) for c, p in listed])
    order = np.argsort(codes, axis=1)
    codes = np.take_along_axis(codes, order, axis=1)
    new = np.ones(codes.shape, bool)
    new[:, 1:] = codes[:, 1:] != codes[:, :-1]
    starts = np.flatnonzero(new)
    sums = np.add.reduceat(prices[order].ravel(), starts) * (codes.ravel()[starts] > 0)
    return np.bincount(starts // codes.shape[1], sums**2, len(points))


class Landmarks:
    """Kernel values of units with a list of strings, scaled to 1 for equal ones.

    The few subsequences that the landmarks have are listed with their weights; a unit's are looked
    up there.
    """

    def __init__(self, strings: list[str]):
        self.strings = strings
        points = _matrix(strings)
        # Letters that no landmark has are 0, and so are places behind a string's end.
        self.letters = np.zeros(0x110000, np.uint16)
        known = np.unique(points[points > 0])
        self.letters[known] = np.arange(1, len(known) + 1)
        weights: dict[int, np.ndarray] = {}
        for price, codes in _subsequences(self.letters[points].astype(np.uint64)):
            for i, at in zip(*np.nonzero(self._whole(codes))):
                row = weights.setdefault(int(codes[i, at]), np.zeros(len(strings)))
                row[i] += price
        self.codes = np.array(sorted(weights), np.uint64)
        self.weights = np.array([weights[int(c)] for c in self.codes]).reshape(-1, len(strings))
        self.maybe = np.zeros(1 << 18, bool)
        self.maybe[_hash(self.codes).astype(np.int64)] = True
        self.weights /= np.sqrt((self.weights**2).sum(axis=0))

    @staticmethod
    def _whole(codes: np.ndarray) -> np.ndarray:
        """Codes with no 0 among their letters."""
        bits, whole = 64 // ORDER, np.ones(codes.shape, bool)
        for i in range(ORDER):
            whole &= (codes >> np.uint64(bits * i)) & np.uint64((1 << bits) - 1) != 0
        return whole

    def values(self, strings: list[str]) -> np.ndarray:
        points = self.letters[_matrix(strings)].astype(np.uint64)
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        found = np.zeros((len(strings), len(self.strings)), np.float64)
        for low, high in ((0, 8), (8, 12), (12, 16), (16, UNIT)):
            rows = np.flatnonzero((lengths > low) & (lengths <= high))
            for price, codes in _subsequences(points[rows, :high]):
                i, at = np.nonzero(self.maybe[_hash(codes).astype(np.int64)])
                code = codes[i, at]
                place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
                same = self.codes[place] == code
                np.add.at(found, rows[i[same]], price * self.weights[place[same]])
        near = np.flatnonzero(found.any(axis=1))
        if len(near):
            found[near] /= np.sqrt(_own_kernel(_matrix([strings[i] for i in near])))[:, None]
        return found**POWER


@dataclass
class Machine:
    """Landmarks, the machine's weights on their kernel values, and the logistic curve."""

    strings: list[str] = field(default_factory=list)
    weights: np.ndarray | None = None
    offset: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def scores(self, values: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(values))
        margin = values.astype(np.float64) @ self.weights + self.offset
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -50, 50)))


class Reader:
    """Kernel values of whole texts, summed over their words; what is known of a word is kept for its next use."""

    def __init__(self, strings: list[str]):
        self.landmarks = Landmarks(strings)
        self.young: dict[str, np.ndarray | None] = {}
        self.old: dict[str, np.ndarray | None] = {}

    def values(self, texts: list[str]) -> np.ndarray:
        words = [words_of(t) for t in texts]
        new: dict[str, None] = {}
        for own in words:
            for word in own:
                if word not in self.young:
                    if word in self.old:
                        self.young[word] = self.old[word]
                    else:
                        new[word] = None
        units, of = [], []
        for word in new:
            parts = units_of(word)
            units += parts
            of += [word] * len(parts)
        self.young.update(new)
        for at in range(0, len(units), 1 << 14):
            found = self.landmarks.values(units[at : at + (1 << 14)]).astype(np.float32)
            for i in np.flatnonzero(found.any(axis=1)).tolist():
                known = self.young[of[at + i]]
                self.young[of[at + i]] = found[i] if known is None else known + found[i]
        result = np.zeros((len(texts), len(self.landmarks.strings)), np.float32)
        for row, own in zip(result, words):
            some = [v for v in map(self.young.__getitem__, own) if v is not None]
            if some:
                np.sum(some, axis=0, out=row)
        if len(self.young) > KEPT:
            self.young, self.old = {}, self.young
        return result


def letter_runs(counted: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """(run, rank): runs of ORDER to ORDER + 4 letters that tell toxic texts from others, from units (unit, t, c) with their texts.

    The rank is by how often toxic texts have the run, by the odds and by its length.
    """
    size = F.char_length("unit")
    of = lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda at: F.substring(F.col("unit"), at, F.lit(n))
    )
    runs = [F.when(size >= n, of(n)).otherwise(F.array().cast("array<string>")) for n in range(ORDER, ORDER + 5)]
    runs = counted.select("t", "c", F.explode(F.array_distinct(F.concat(*runs))).alias("run"))
    runs = runs.groupBy("run").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    odds = F.log((F.col("t") + 0.5) / n_toxic) - F.log((F.col("c") + 2) / n_clean)
    runs = runs.where(F.col("t") >= max(3, n_toxic // 500)).withColumn("odds", odds).where(F.col("odds") > LEAST_ODDS)
    return runs.select("run", (F.col("t") * F.col("odds") * F.char_length("run")).alias("rank"))


def choose_landmarks(ranked: list[str], most: int = LANDMARKS) -> list[str]:
    """The first runs of a list but those that have `ORDER` letters in a row in common with a chosen one."""
    chosen: list[str] = []
    alike: set[str] = set()
    for run in ranked:
        parts = {run[at : at + ORDER] for at in range(len(run) - ORDER + 1)}
        if not parts & alike:
            chosen.append(run)
            alike |= parts
        if len(chosen) == most:
            break
    return chosen


def train(values: np.ndarray, toxic: np.ndarray, strings: list[str], ridge: float = 1e-5) -> Machine:
    """A machine on the kernel values of training texts with their labels, 0 or 1."""
    landmarks = Landmarks(strings)
    own = landmarks.values(strings)
    power, axes = np.linalg.eigh(own + 1e-6 * np.eye(len(strings)))
    to_space = axes / np.sqrt(np.maximum(power, 1e-3))
    x = np.column_stack([values @ to_space, np.ones(len(values))])
    y = np.where(toxic, 1.0, -1.0)
    weight = np.full(len(y), 1 / len(y))
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-9

    def loss(w: np.ndarray) -> float:
        return float(weight @ np.maximum(0, 1 - y * (x @ w)) ** 2 + w @ penalty @ w)

    for _ in range(200):  # Newton steps of the squared hinge loss, halved until they lower it
        active = y * (x @ w) < 1
        a, c = x[active], weight[active]
        step = np.linalg.solve(a.T @ (c[:, None] * a) + penalty, a.T @ (c * y[active])) - w
        length, before = 1.0, loss(w)
        while loss(w + length * step) > before and length > 1e-6:
            length /= 2
        w = w + length * step
        if before - loss(w) < 1e-12:
            break
    margin = x @ w
    slope, shift = _logistic(margin, toxic)
    return Machine(strings, to_space @ w[:-1], float(w[-1]), slope, shift)


def _logistic(margin: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve on margins, by Newton steps with a weak prior."""
    x, theta = np.column_stack([margin, np.ones(len(margin))]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -50, 50)))
        slope = x.T @ (p - toxic) / len(x) + 1e-3 * (theta - [1, 0])
        curve = x.T @ ((p * (1 - p))[:, None] * x) / len(x) + 1e-3 * np.eye(2)
        theta = theta - np.linalg.solve(curve, slope)
    return max(float(theta[0]), 1e-3), float(theta[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    where: Column,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "toxic",
    sample: int = SAMPLE,
    landmarks: int = LANDMARKS,
) -> Machine:
    """A machine learnt from the labelled rows for which `where`, a condition on the id, holds."""
    marked = labels.where(where & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).alias("_toxic"))
    marked = stage(marked.where("_id IS NOT NULL"))
    order = F.xxhash64("_id")
    some = [marked.where(c).orderBy(order).limit(sample) for c in ("_toxic = 1", "_toxic = 0")]
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(text, F.lit("")).alias("_text"))
    rows = stage(rows.join(stage(some[0].union(some[1])), "_id"))
    sizes = {r["_toxic"]: r["count"] for r in rows.groupBy("_toxic").count().collect()}
    if len(sizes) < 2:
        return Machine()

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [{u for w in words_of(t) for u in units_of(w)} for t in part.column("_text").to_pylist()]
            toxic = np.repeat(part.column("_toxic").to_numpy(), [len(f) for f in found]).astype(np.int32)
            yield pa.record_batch([pa.array([u for f in found for u in f], pa.string()), toxic], names=["unit", "toxic"])

    counted = rows.mapInArrow(units, "unit string, toxic int").groupBy("unit").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")
    )
    best = letter_runs(counted, sizes[1], sizes[0]).orderBy(F.desc("rank"), "run").limit(CANDIDATES)
    strings = choose_landmarks([r.run for r in best.collect()], landmarks)
    if not strings:
        return Machine()
    found = _valued(rows, strings, "_text").select("_toxic", "_values").toArrow()
    values = np.array(found.column("_values").to_pylist(), np.float64)
    return train(values, found.column("_toxic").to_numpy() == 1, strings)


def _valued(rows: DataFrame, strings: list[str], text: str) -> DataFrame:
    """`rows` with the array `_values` of kernel values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(strings)
        for part in slices(batches):
            values = reader.values([t or "" for t in part.column(text).to_pylist()])
            column = pa.array(values.tolist(), pa.list_(pa.float32()))
            yield pa.record_batch([*part.columns, column], names=[*part.schema.names, "_values"])

    return rows.mapInArrow(run, StructType(list(rows.schema.fields)).add("_values", ArrayType(FloatType())))


def score(docs: DataFrame, machine: Machine, text: str = "text", column: str = "score") -> DataFrame:
    """`docs` with a score from 0 to 1, higher for texts that are likelier to be toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(machine.strings) if machine.strings else None
        for part in slices(batches):
            texts = [t or "" for t in part.column(text).to_pylist()]
            values = reader.values(texts) if reader else np.zeros((len(texts), 0))
            new = pa.array(machine.scores(values), pa.float64())
            yield pa.record_batch([*part.columns, new], names=[*part.schema.names, column])

    kept = docs.drop(column)
    return kept.mapInArrow(run, StructType(list(kept.schema.fields)).add(column, "double"))
