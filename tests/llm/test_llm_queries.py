"""Queries with SQL against it; every query on tables whose rows are all edge cases, and on empty ones."""

import pytest
from compare import duck_result, spark_result
from .conftest import EDGES, FOLDER

import __spark_entry__ as registry
from millrace.llm.oracles import ORACLES
from millrace.llm.queries import QUERIES

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "benchmark": "item_id long, text string",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}
ROWS = {
    "documents": [(i, t, None if n % 3 else "en", None, None) for n, (i, t) in enumerate(EDGES)],
    "benchmark": [(1, "a b"), (None, "the LAZY dog"), (2, None), (3, "")],
    "embeddings": [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, None, None), (4, [0.0, 0.0], 0),
        (5, [None, 1.0], 0), (6, [float("nan"), 1.0], 0), (None, [0.0, 1.0], 0), (7, [0.0, 1.0, 0.0], 0),
        (8, [float("inf"), 1.0], 0), (9, [], 0), (10, [0.0, -1.0], 0),
    ],
    "labels": [(1, 0, 1), (1, 0, 0), (2, None, None), (None, 1, 1), (7, 0, 0)],
    "conversations": [(1, 0, "user", "hi"), (None, None, None, None), (1, 0, "user", "hi")],
}


def write(spark, folder, empty):
    for name, schema in SCHEMAS.items():
        rows = [] if empty else ROWS[name]
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    names, got = spark_result(QUERIES[name](spark, FOLDER))
    sql_names, expected, _ = duck_result(con, ORACLES[name])
    assert names == sql_names
    assert got == expected


def test_all_are_registered():
    named = registry.queries()
    assert {n.split("_")[0] for n in named if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in named


def test_every_query_takes_edge_cases(spark, tmp_path):
    folder = write(spark, tmp_path / "edges", empty=False)
    counts = {name: len(q(spark, folder).collect()) for name, q in QUERIES.items()}
    wanted = {name: len(ROWS["documents"]) for name in QUERIES}
    wanted |= {"op5_embedding_dedup": 12, "op8_tool_linking": 3, "op12_turn_repair": 2, "op13_prefix_trie": 1}
    assert counts == wanted
    links = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in QUERIES["op5_embedding_dedup"](spark, folder).collect()}
    assert {(1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True), (6, 0, 6, True)} <= links
    assert {(7, 1, 7, True), (None, 1, 7, False), (8, 0, 8, True), (9, 0, 9, True), (10, 0, 10, True)} <= links


def test_every_query_takes_empty_tables(spark, tmp_path):
    folder = write(spark, tmp_path / "empty", empty=True)
    for name, q in QUERIES.items():
        assert q(spark, folder).collect() == [], name
    assert registry.queries()["pipeline"](spark, folder).collect() == []
