import json

from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.landing import land_id_array
from millrace.sources.tables import ensure_table, scan
from millrace.streaming.landing import merge_stream


def test_arriving_responses_are_merged_once(spark, schema, tmp_path):
    landing, table = tmp_path / "landing", f"{schema}.ids"
    landing.mkdir()
    ensure_table(spark, table, "puuid string, match_id string")

    def land(log):
        lists = log.where(F.col("status") == 200).select(F.col("key").alias("puuid"), "body")
        return land_id_array(lists, "match_id")

    def arrive(name, *lists):
        lines = [json.dumps({"key": k, "status": 200, "body": json.dumps(ids)}) for k, ids in lists]
        (landing / name).write_text("\n".join(lines))

    def take_in():
        query = merge_stream(
            spark, str(landing), table, ["puuid", "match_id"], land, str(tmp_path / "ckpt"), 1
        )
        assert query.awaitTermination(120)
        assert query.exception() is None

    arrive("1.json", ("p", ["a", "b"]), ("q", []))
    arrive("2.json", ("p", ["b", "c"]))
    take_in()
    assert rows(scan(spark, table)) == [("p", "a"), ("p", "b"), ("p", "c")]
    arrive("3.json", ("p", ["a"]), ("q", ["a"]))
    take_in()
    assert rows(scan(spark, table)) == [("p", "a"), ("p", "b"), ("p", "c"), ("q", "a")]
