"""Completeness of a chain against a plain walk, and numbers without gaps under hot values."""

import random

import pytest
from conftest import rows

from millrace.operators.batching import numbered, request_batches
from millrace.operators.chain import chain_gaps, descent

DEPENDS = [("b", "a"), ("c", "b"), ("d", "c"), ("e", "a")]


def test_descent(spark):
    assert rows(descent(spark, DEPENDS)) == [("a", 0, 4), ("b", 1, 2), ("c", 2, 1), ("d", 3, 0), ("e", 1, 0)]
    with pytest.raises(ValueError):
        descent(spark, [("a", "b"), ("b", "a")])


def test_gaps_equal_a_plain_walk(spark):
    rng = random.Random(2)
    wanted = [(rng.choice([None, *range(9)]), rng.choice("bcde"), rng.choice([None, "x", "y", "z"])) for _ in range(150)]
    landed = [(rng.choice("bcde"), rng.choice([None, "x", "y"])) for _ in range(6)]
    depth, below = {"b": 1, "c": 2, "d": 3, "e": 1}, {"b": 2, "c": 1, "d": 0, "e": 0}
    missing = {w for w in wanted if w[2] is not None and w[1:] not in landed}
    expected = []
    for root in {m[0] for m in missing}:
        own = [m[1] for m in missing if m[0] == root]
        first = min(own, key=lambda d: (depth[d], d))
        expected.append((root, first, own.count(first), len(own), sum(below[d] for d in own)))
    got = chain_gaps(
        spark.createDataFrame(wanted, "root long, dataset string, key string").repartition(3),
        spark.createDataFrame(landed, "dataset string, key string"),
        DEPENDS,
    )
    assert rows(got) == sorted(expected, key=repr)


def test_numbers_have_no_gaps(spark, executed):
    """A hot value, NULLs and equal rows; columns named like the helper's; no window over all rows."""
    values = [(1, n % 7, "x") for n in range(5000)] + [(None, 0, "y"), (2, 0, "z"), (2, 0, "z"), (0, 9, "w")]
    df = spark.createDataFrame(values, "a long, b long, _part string").repartition(8)
    found = numbered(df, ["a", "b"])
    assert found.columns == ["a", "b", "_part", "n"]
    got = sorted(found.collect(), key=lambda r: r.n)
    assert [r.n for r in got] == list(range(len(values)))
    assert [(r.a, r.b) for r in got] == sorted(((a, b) for a, b, _ in values), key=lambda v: (v[0] is not None, v[0] or 0, v[1]))
    assert "Window" not in executed(found)
    assert numbered(df.limit(0), ["a"]).count() == 0


def test_batches_keep_all_limits(spark):
    got = request_batches(spark.range(1000), ["id"], {1: 3, 10: 7, 60: 20}).orderBy("n").collect()
    starts = [r.earliest_s for r in got]
    assert starts == sorted(starts) and [r.batch for r in got] == sorted(r.batch for r in got)
    for seconds, requests in ((1, 3), (10, 7), (60, 20)):
        assert all(starts[i + requests] - starts[i] >= seconds for i in range(len(starts) - requests))
    assert len({r.batch for r in got}) == len(set(starts))
    with pytest.raises(ValueError):
        request_batches(spark.range(3), ["id"], {1: 1, 2: 100})
