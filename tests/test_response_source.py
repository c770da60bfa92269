"""The response log as a data source: equal to the plain reader, pruned by its filters, and as a stream."""

import json
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.sources.landed import read_response_log, torn_lines
from millrace.sources.responses import Range, lines_of, list_files, scan_responses, stream_responses

ROW = {"tier": "CHALLENGER", "division": "I", "page": None, "url": "u", "status": 200, "ts": "2024-01-01T00:00:00Z"}


def line(n, **more):
    return json.dumps({**ROW, "key": f"k{n}", "body": "é" * (n % 50) + f'{{"n": {n}}}', **more}, ensure_ascii=n % 2 == 0)


@pytest.fixture
def folder(tmp_path):
    """Datasets and batches as folders, regions in the lines; torn, blank and mistyped lines; no break at the end."""
    for dataset in ("match_raw", "summoner_raw"):
        for batch in ("b 1", "b2"):
            part = tmp_path / "log" / f"dataset={dataset}" / f"batch_id={batch.replace(' ', '%20')}"
            part.mkdir(parents=True)
            lines = [line(n, region=("KR", "JP1", None)[n % 3]) for n in range(40)]
            lines[7:7] = ["", "  ", '{"key": "torn', "[1]", '"text"', "oops", line(99, region="KR", status="soon"), "{}"]
            (part / "part-0.json").write_text("\n".join(lines))
            (part / "_SUCCESS").write_text("")
    return str(tmp_path / "log")


@pytest.mark.parametrize("split", [997, 1 << 20])
def test_equals_the_plain_reader(spark, folder, split):
    assert rows(scan_responses(spark, folder, split_bytes=split)) == rows(read_response_log(spark, folder))
    assert torn_lines(scan_responses(spark, folder, split_bytes=split)).count() == 20


def test_filters_reach_files_and_lines(spark, folder):
    asked = scan_responses(spark, folder, "match_raw", ["b 1", "b3"], "KR")
    plain = read_response_log(spark, folder)
    plain = plain.where("dataset = 'match_raw' AND batch_id IN ('b 1', 'b3') AND region = 'KR'")
    assert rows(asked.where("_corrupt_record IS NULL")) == rows(plain) and plain.count() == 14
    assert asked.where("_corrupt_record IS NOT NULL").count() == 1
    plan = spark._jvm.PythonSQLUtils.explainString(asked._jdf.queryExecution(), "formatted")
    pushed = plan[plan.index("PushedFilters") :].splitlines()[0]
    for part in ("match_raw", "b 1", "KR"):
        assert part in pushed
    assert asked.rdd.getNumPartitions() == 1
    assert scan_responses(spark, folder, "match_raw", []).count() == 0
    assert scan_responses(spark, folder, "none").count() == 0


def test_lines_belong_to_the_range_they_end_in(tmp_path):
    rng = random.Random(1)
    content = "".join(rng.choice("ab\n") * rng.randint(1, 9) for _ in range(300)).encode()
    (tmp_path / "f").write_bytes(content)
    path = str(tmp_path / "f")
    for step in (1, 2, 7, 50, 10**6):
        found = []
        for begin in range(0, len(content), step):
            end = min(begin + step, len(content))
            found += lines_of(path, Range(path, begin, end, end == len(content), {}))
        assert found == content.split(b"\n")[: None if not content.endswith(b"\n") else -1]
    assert [f.size for f in list_files(path)] == [len(content)]


def test_stream_reads_each_line_once(spark, tmp_path):
    log, target, state = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "state")
    log.mkdir()

    def run():
        query = stream_responses(spark, str(log)).writeStream.format("parquet").option("checkpointLocation", state)
        query.trigger(availableNow=True).start(target).awaitTermination(120)
        return sorted(r.key for r in spark.read.parquet(target).select(F.col("key")).collect())

    first = line(1, dataset="match_raw", region="KR")
    (log / "a.json").write_text(first + "\n" + line(2)[:9])
    assert run() == ["k1"]
    with open(log / "a.json", "a") as file:
        file.write(line(2)[9:] + "\n")
    (log / "b.json").write_text(line(3) + "\n" + line(4) + "\n")
    assert run() == ["k1", "k2", "k3", "k4"]
    os.utime(log / "b.json")
    assert run() == ["k1", "k2", "k3", "k4"]
