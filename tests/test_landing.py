from conftest import rows
from pyspark.sql import functions as F

from millrace.functions.json_text import listing_size, value_at, value_or
from millrace.operators.audit import Batch, with_audit
from millrace.operators.landing import (
    check_arrays,
    land_document,
    land_id_array,
    land_opaque_document,
    land_paged_array,
    parse_document,
    parse_opaque_document,
    parse_paged_array,
)
from millrace.operators.paging import before_first_empty
from millrace.sources.landed import read_bodies, read_response_log, torn_lines


def test_array_elements_become_rows(spark):
    body = '[{"a": 1, "b": "x", "extra": [1, 2]}, {"b": null}, {"a": "bad", "b": "y"}, "abc", null, 7]'
    pages = spark.createDataFrame([(1, body), (2, "[]"), (3, "oops"), (4, None)], "page int, body string")
    df = land_paged_array(pages, "a bigint, b string, c boolean")
    assert df.columns == ["page", "a", "b", "c", "_raw_json", "_pos"]
    assert [r[:4] + (r._pos,) for r in df.orderBy("_pos").collect()] == [
        (1, 1, "x", None, 0),
        (1, None, None, None, 1),
        (1, None, "y", None, 2),
    ]
    bad = parse_paged_array(pages, "a bigint, b string, c boolean").where("_bad_element AND _is_element")
    assert rows(bad.select("_pos", "_raw_json")) == [(3, "abc"), (4, None), (5, "7")]
    first = df.where("_pos = 0").first()._raw_json
    assert first == '{"a":1,"b":"x","extra":[1,2]}'


def test_a_field_missing_everywhere_is_null(spark):
    pages = spark.createDataFrame([('[{"b": "x"}]',)], "body string")
    assert land_paged_array(pages, "a string, b string").select("a", "b").first() == (None, "x")


def test_id_lists(spark):
    df = spark.createDataFrame([("p", '["a", "b"]'), ("q", "[]"), ("r", "{")], "key string, body string")
    assert rows(land_id_array(df, "id")) == [("p", "a"), ("p", "b")]


DOCUMENTS = [
    ("k1", '{"metadata": {"matchId": "m1"}, "info": {"platformId": "KR", "gameCreation": 17}}'),
    ("k2", '{"info": {"gameCreation": "soon"}}'),
    ("k3", '{"metadata": {"matchId": null}}'),
    ("k4", "{}"),
    ("k5", "oops"),
    ("k6", '{"metadata": {"matchId": "m6"}'),
    ("k7", "[]"),
    ("k8", None),
    ("k9", " "),
]
FIELDS = {"platform": ("info.platformId", "string"), "created": ("info.gameCreation", "bigint")}


def test_documents_fall_back_to_the_requested_key(spark):
    df = spark.createDataFrame(DOCUMENTS, "key string, body string")
    out = land_document(df, "id", "key", "metadata.matchId", FIELDS)
    assert rows(out.select("key", "id", "platform", "created")) == sorted(
        [
            ("k1", "m1", "KR", 17),
            ("k2", "k2", None, None),
            ("k3", "k3", None, None),
            ("k4", "k4", None, None),
        ],
        key=repr,
    )
    assert rows(out.where("key = 'k1'").select("body")) == [(DOCUMENTS[0][1],)]


def test_malformed_documents_are_flagged(spark):
    df = spark.createDataFrame(DOCUMENTS, "key string, body string")
    bad = parse_document(df, "id", "key", "metadata.matchId", FIELDS).where("_malformed")
    assert rows(bad.select("key")) == [("k5",), ("k6",), ("k7",), ("k8",), ("k9",)]
    blank = parse_opaque_document(df, "id", "key").where("_malformed")
    assert rows(blank.select("key")) == [("k8",), ("k9",)]


def test_documents_are_parsed_once(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    out = land_document(df, "id", "event_type", "a.b", {"k": ("k", "bigint")}, body="props")
    plan = out.select("id", "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    assert "ReadSchema: struct<event_type:string,props:string>" in plan


def test_opaque_documents_are_not_looked_into(spark):
    df = spark.createDataFrame([("a", "not json"), ("b", "")], "key string, body string")
    assert rows(land_opaque_document(df, "id", "key")) == [("a", "not json", "a")]


def test_listing_size(spark):
    bodies = ["[]", " [ ] ", "[1]", "{}", "null", '{"a":1}', "oops", "", None]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    sizes = [r[0] for r in df.select(listing_size(F.col("body"))).collect()]
    assert sizes == [0, 0, 1, 0, 0, None, None, None, None]
    flags = [tuple(r) for r in check_arrays(df).select("_malformed", "_empty").collect()]
    assert flags == [(s is None, s == 0) for s in sizes]


def test_json_values(spark):
    df = spark.createDataFrame([('{"a":{"b":"5"},"n":null}',), ("{}",), ("oops",)], "j string")
    j, d = F.col("j"), F.lit("d")
    out = df.select(
        value_at(j, "a.b", "bigint"),
        value_or(j, "n", d),
        value_or(j, "n", d, keep_null=True),
        value_or(j, "a.b", d, keep_null=True),
    )
    assert [tuple(r) for r in out.collect()] == [
        (5, "d", None, "5"),
        (None, "d", "d", "d"),
        (None, "d", "d", "d"),
    ]


def test_pages_stop_per_scope(spark):
    sizes = [("a", 1, 3), ("a", 2, 0), ("a", 3, 2), ("a", 4, 0), ("b", 1, 1), ("b", 2, 1), (None, 1, 0)]
    df = spark.createDataFrame(sizes, "scope string, page int, n int")
    out = before_first_empty(df, ["scope"], "page", df.where("n = 0"))
    assert rows(out) == [("a", 1, 3), ("b", 1, 1), ("b", 2, 1)]


def test_few_stops_are_broadcast(spark, executed):
    df = spark.range(0, 1000, 1, 4).selectExpr("id % 7 AS scope", "id AS page", "id % 100 AS n")
    out = before_first_empty(df, ["scope"], "page", df.where("n = 0"))
    plan = executed(out)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_audit_columns_are_constants_of_the_run(spark):
    batch = Batch()
    df = with_audit(spark.range(0, 100, 1, 4), batch, region="KR", page=F.col("id"))
    assert df.columns == ["id", "_region", "_page", "_batch_id", "_ingested_at"]
    assert df.select("_batch_id", "_ingested_at").distinct().count() == 1
    assert df.where("_page = id").count() == 100
    assert Batch().batch_id != batch.batch_id


def test_landed_files(spark, tmp_path):
    (tmp_path / "m%201.json").write_text('{"a":\n 1}')
    (tmp_path / "m2.json").write_text("{}")
    out = read_bodies(spark, str(tmp_path))
    assert {r[1] for r in rows(out)} == {'{"a":\n 1}', "{}"}
    assert ("m2", "{}") in rows(out)

    log = tmp_path / "log"
    log.mkdir()
    (log / "1.jsonl").write_text('{"dataset": "d", "key": "k", "status": 200, "body": "[]"}\n')
    row = read_response_log(spark, str(log)).first()
    assert (row.dataset, row.key, row.status, row.body, row.page) == ("d", "k", 200, "[]", None)
    (log / "2.jsonl").write_text('{"dataset": "d", "key"\n{"dataset": "e"}\n')
    found = read_response_log(spark, str(log))
    assert rows(torn_lines(found)) == [('{"dataset": "d", "key"',)]
    assert found.count() == 3 and torn_lines(found.drop("_corrupt_record")).count() == 0
