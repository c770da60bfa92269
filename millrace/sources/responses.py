"""The response log as a data source: filters on dataset, fetch batch and region reach its files and lines.

`scan_responses` reads what `read_response_log` reads, of the datasets, batches and regions asked for.
Folders named `dataset=…`, `batch_id=…` or `region=…` that can't hold such a line are not opened; of other
lines, those that say something else are left out in the reader, before they are handed to Spark. The
files are planned as ranges of bytes. A line belongs to the range in which it ends.

As a stream, the offset is the length of each file that has been read. A file may grow; its last line is read when
its line break has arrived.

The folder must be one that pyarrow's file systems can open (a path or a URI).
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
)

from millrace.sources.landed import parse_lines

NAME = "response_log"
TOLD = ("dataset", "batch_id", "region")  # columns that filters are taken for
SPLIT_BYTES = 64 << 20
BLOCK = 1 << 16  # bytes read at a time
LINES = 4096  # of a record batch, at most
BATCH_BYTES = 8 << 20
DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


@dataclass
class LogFile:
    path: str
    size: int
    told: dict[str, str | None]  # what the folders say


@dataclass
class Range(InputPartition):
    """The lines of a file that end in [begin, end); with `tail`, also what follows the last line break."""

    path: str
    begin: int
    end: int
    tail: bool
    told: dict[str, str | None]


def _file_system(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def list_files(path: str) -> list[LogFile]:
    """The folder's files in the order of their names, without hidden ones and those of Spark's own use."""
    from pyarrow import fs

    system, root = _file_system(path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        return [LogFile(root, info.size, {})]
    found = []
    for file in system.get_file_info(fs.FileSelector(root, recursive=True)):
        parts = file.path[len(root) :].strip("/").split("/")
        if file.type != fs.FileType.File or any(p.startswith(("_", ".")) for p in parts):
            continue
        told = dict(p.split("=", 1) for p in parts[:-1] if "=" in p)
        told = {k: None if v == DEFAULT_PARTITION else unquote(v) for k, v in told.items() if k in TOLD}
        found.append(LogFile(file.path, file.size, told))
    return sorted(found, key=lambda f: f.path)


def lines_of(path: str, part: Range) -> Iterator[bytes]:
    """The lines of a range, without their breaks."""
    system, _ = _file_system(path)
    with system.open_input_file(part.path) as file:
        at, rest = _line_begin(file, part.begin), b""
        file.seek(at)
        while True:
            block = file.read(BLOCK)
            pieces = (rest + block).split(b"\n")
            at += len(block)
            rest = pieces.pop()
            ends = at - len(rest)
            # Where each line's break lies, told from the block's end.
            places = []
            for piece in reversed(pieces):
                ends -= 1
                places.append(ends)
                ends -= len(piece)
            for piece, place in zip(pieces, reversed(places)):
                if place >= part.end:
                    return
                if place >= part.begin:
                    yield piece
            if not block:
                if rest and part.tail:
                    yield rest
                return
            if at >= part.end and not rest and not part.tail:
                return


def _line_begin(file, place: int) -> int:
    """Where the line that holds a place begins."""
    while place > 0:
        back = min(BLOCK, place)
        file.seek(place - back)
        found = file.read(back).rfind(b"\n")
        if found >= 0:
            return place - back + found + 1
        place -= back
    return 0


def said(line: bytes) -> dict[str, str | None]:
    """What a line says in the columns of TOLD; nothing for one that is no JSON object."""
    try:
        found = json.loads(line, parse_int=str, parse_float=str)
    except (ValueError, RecursionError):
        return {}
    if not isinstance(found, dict):
        return {}
    return {k: _text(found.get(k)) for k in TOLD}


def _text(value) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, separators=(",", ":"))


def batches_of(path: str, part: Range, wanted: dict[str, set]) -> Iterator[pa.RecordBatch]:
    """(value, dataset, batch_id, region): the lines of a range that say what is wanted."""
    left = {k: v for k, v in wanted.items() if k not in part.told}
    rows: list[tuple] = []
    size = 0
    for line in lines_of(path, part):
        line = line.removesuffix(b"\r")
        if not line.strip():
            continue
        told = {**said(line), **part.told}
        if any(told.get(k) not in values for k, values in left.items()):
            continue
        rows.append((line.decode("utf-8", "replace"), *[told.get(k) for k in TOLD]))
        size += len(line)
        if len(rows) == LINES or size > BATCH_BYTES:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, pa.string()) for c in zip(*rows)], names=["value", *TOLD])


class ResponseReader(DataSourceReader):
    def __init__(self, path: str, split_bytes: int):
        self.path, self.split_bytes = path, split_bytes
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for one in filters:
            column = one.attribute[0] if isinstance(one, (EqualTo, In)) and len(one.attribute) == 1 else None
            if column not in TOLD:
                yield one
                continue
            values = {one.value} if isinstance(one, EqualTo) else set(one.value)
            self.wanted[column] = self.wanted.get(column, values) & values

    def partitions(self) -> Sequence[Range]:
        files = [
            f for f in list_files(self.path) if all(f.told[k] in v for k, v in self.wanted.items() if k in f.told)
        ]
        return [
            Range(f.path, begin, min(begin + self.split_bytes, f.size), begin + self.split_bytes >= f.size, f.told)
            for f in files
            for begin in range(0, f.size, self.split_bytes)
        ]

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        if partition is not None:  # None where no file is left to read
            yield from batches_of(self.path, partition, self.wanted)


class ResponseStreamReader(DataSourceStreamReader):
    """Offsets are {file: bytes read}. All files of the folder are in them, so old ones should be moved away in time."""

    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {f.path: f.size for f in list_files(self.path)}

    def partitions(self, start: dict, end: dict) -> Sequence[Range]:
        told = {f.path: f.told for f in list_files(self.path)}
        grown = {path: size for path, size in end.items() if size > start.get(path, 0)}
        return [Range(path, start.get(path, 0), size, False, told.get(path, {})) for path, size in grown.items()]

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        if partition is not None:
            yield from batches_of(self.path, partition, {})

    def commit(self, end: dict) -> None:
        pass


class ResponseLogSource(DataSource):
    """Options: `path`, and `splitBytes`, the length of a range."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "value STRING, dataset STRING, batch_id STRING, region STRING"

    def reader(self, schema) -> ResponseReader:
        return ResponseReader(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)))

    def streamReader(self, schema) -> ResponseStreamReader:
        return ResponseStreamReader(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make the source known to the session, and let filters be pushed into Python sources."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(ResponseLogSource)


def scan_responses(
    spark: SparkSession,
    path: str,
    dataset: str | None = None,
    batches: Sequence[str] | None = None,
    region: str | None = None,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """`read_response_log` of the lines that name the dataset, one of the batches and the region.

    Without any of them, all lines; a torn line names nothing. A line that names them but does not fit
    RESPONSE_LOG otherwise is kept in `_corrupt_record`.
    """
    register(spark)
    lines = spark.read.format(NAME).option("path", path).option("splitBytes", split_bytes).load()
    if dataset is not None:
        lines = lines.where(F.col("dataset") == dataset)
    if batches is not None:
        lines = lines.where(F.col("batch_id").isin(*batches) if batches else F.lit(False))
    if region is not None:
        lines = lines.where(F.col("region") == region)
    return parse_lines(lines)


def stream_responses(spark: SparkSession, path: str) -> DataFrame:
    """The same as a stream: lines are read once each, when their line break has arrived."""
    register(spark)
    return parse_lines(spark.readStream.format(NAME).option("path", path).load())
