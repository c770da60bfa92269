"""The six jobs on small responses, with the cases that real ones bring."""

import json
from dataclasses import replace
from datetime import datetime, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.audit import Batch
from millrace.plans import datasets
from millrace.plans.ingest import Run, ingest, ingest_all, null_keys, own_responses, plan_requests
from millrace.sources.landed import read_response_log
from millrace.sources.tables import append

AT = datetime(2024, 1, 1, tzinfo=timezone.utc)


def response(dataset, body, key=None, page=None, status=200, kind=None, after=None, **scope):
    place = {"region": "KR", "tier": "CHALLENGER", "division": "I", **scope}
    text = body if body is None or isinstance(body, str) else json.dumps(body)
    return (
        dataset, "fetch-1", place["region"], place["tier"], place["division"], key, page, "u",
        status, kind, after, AT, text,
    )


def log_of(spark, *responses):
    return spark.createDataFrame(list(responses), schemas.RESPONSE_LOG)


def entry(puuid, points=1):
    return {"puuid": puuid, "leaguePoints": points, "wins": 2, "veteran": True, "more": {"x": 1}}


def pages(*bodies, **scope):
    return [response("league_entries", b, page=i + 1, **scope) for i, b in enumerate(bodies)]


@pytest.fixture
def run(schema):
    return Run("kr", "challenger", bronze=schema, host_suffix=".x", batch=Batch("b1", AT))


def table(spark, run, name):
    return spark.table(run.table(name))


def test_league_entries_stop_at_the_first_empty_page(spark, run):
    log = log_of(
        spark,
        *pages([entry("a"), entry("b")], [entry("c")], [], [entry("late")]),
        *pages([entry("other")], tier="MASTER"),
        *pages([entry("other")], division="II"),
    )
    out = ingest(spark, datasets.LEAGUE_ENTRIES, log, run)
    assert (out["new_rows"], out["requests_made"], out["count_429"]) == (3, 4, 0)
    got = table(spark, run, "league_entries")
    assert got.columns == [c.strip().split()[0] for c in schemas.LEAGUE_ENTRIES.split(",")]
    assert rows(got.select("puuid", "_page")) == [("a", 1), ("b", 1), ("c", 2)]
    row = got.where("puuid = 'a'").first()
    assert (row.leaguePoints, row.wins, row.veteran, row.summonerId) == (1, 2, True, None)
    assert json.loads(row._raw_json) == entry("a")
    assert (row._region, row._tier, row._batch_id) == ("KR", "CHALLENGER", "b1")
    assert row._source_url.startswith("https://kr.x/") and row._source_url.endswith("/I?page=1")


def test_first_values_and_copies_in_one_batch_stay(spark, run):
    first = log_of(spark, *pages([entry("a", 10)], [entry("a", 11)], []))
    assert ingest(spark, datasets.LEAGUE_ENTRIES, first, run)["new_rows"] == 2
    again = log_of(spark, *pages([entry("a", 99), entry("b", 1)], []))
    assert ingest(spark, datasets.LEAGUE_ENTRIES, again, run)["new_rows"] == 1
    points = table(spark, run, "league_entries").select("puuid", "leaguePoints")
    assert rows(points) == [("a", 10), ("a", 11), ("b", 1)]


def test_null_keys_enter_each_run_unless_rejected(spark, schema):
    log = log_of(spark, *pages([{"wins": 1}], []))
    run = Run(bronze=schema)
    assert [ingest(spark, datasets.LEAGUE_ENTRIES, log, run)["new_rows"] for _ in range(2)] == [1, 1]
    strict = Run(bronze=schema, reject_null_keys=True)
    assert ingest(spark, datasets.LEAGUE_ENTRIES, log, strict)["new_rows"] == 0


def everything(spark):
    responses = [
        *pages([entry("a"), entry("b")], []),
        response("match_ids", ["m1", "m2"], key="a"),
        response("match_ids", [], key="b"),
        response("match_ids", ["m9"], key="nobody"),
        response("match_raw", {"metadata": {"matchId": "m1"}, "info": {"platformId": "KR", "gameCreation": 5}}, key="m1"),
        response("match_raw", None, key="m2", status=429, kind="method", after=3),
        response("match_raw", {"info": {}}, key="m2"),
        response("match_raw", {}, key="m9"),
        response("match_timeline_raw", {"frames": [1]}, key="m1"),
        response("match_timeline_raw", None, key="m2", status=404),
        response("summoner_raw", {"puuid": "a", "level": 3}, key="a"),
        response("summoner_raw", "oops", key="b"),
        response("account_raw", {"puuid": "z"}, key="a"),
        response("account_raw", {}, key="b"),
    ]
    return log_of(spark, *responses)


def test_all_datasets_and_a_second_run(spark, run):
    log = everything(spark)
    first = ingest_all(spark, log, run)
    assert {n: c["new_rows"] for n, c in first.items()} == {
        "league_entries": 2,
        "match_ids": 2,
        "match_raw": 2,
        "match_timeline_raw": 1,
        "summoner_raw": 1,
        "account_raw": 2,
    }
    assert first["match_ids"]["requests_made"] == 3
    assert (first["match_raw"]["requests_made"], first["match_raw"]["count_429"]) == (3, 1)
    assert first["match_timeline_raw"]["failures"] == 1
    assert first["summoner_raw"]["rejected"] == 1
    assert first["account_raw"]["key_mismatch"] == 1

    matches = table(spark, run, "match_raw")
    assert rows(matches.select("match_id", "platform_id", "game_creation", "_source_url")) == [
        ("m1", "KR", 5, "https://asia.x/lol/match/v5/matches/m1"),
        ("m2", None, None, "https://asia.x/lol/match/v5/matches/m2"),
    ]
    assert matches.where("match_id = 'm2'").first().raw_json == '{"info": {}}'
    accounts = table(spark, run, "account_raw").select("puuid", "_region")
    assert rows(accounts) == [("b", "KR"), ("z", "KR")]

    # 'a' is still pending, as its account names another key; that key is known by now
    second = ingest_all(spark, log, run)
    assert {c["new_rows"] for c in second.values()} == {0}

    status = table(spark, run, "ingestion_log").groupBy("dataset").agg(
        F.array_sort(F.collect_set("status")).alias("s"), F.count("*").alias("n")
    )
    assert rows(status) == [
        ("account_raw", ["SUCCESS"], 2),
        ("league_entries", ["SUCCESS"], 2),
        ("match_ids", ["SUCCESS"], 2),
        ("match_raw", ["SUCCESS"], 2),
        ("match_timeline_raw", ["PARTIAL"], 2),
        ("summoner_raw", ["PARTIAL"], 2),
    ]
    recent = "batch_id = 'b1' AND run_start <= run_end AND run_start > now() - INTERVAL 1 HOUR"
    assert table(spark, run, "ingestion_log").where(recent).count() == 12


def test_requests_are_planned_for_pending_keys_only(spark, run):
    ingest(spark, datasets.LEAGUE_ENTRIES, log_of(spark, *pages([entry("a"), entry("b")], [])), run)
    ids = plan_requests(spark, datasets.MATCH_IDS, run)
    assert rows(ids.select("key")) == [("a",), ("b",)]
    summoner = log_of(spark, response("summoner_raw", {"puuid": "a"}, key="a"))
    ingest(spark, datasets.SUMMONER, summoner, run)
    assert rows(plan_requests(spark, datasets.SUMMONER, run)) == [
        ("b", "https://kr.x/lol/summoner/v4/summoners/by-puuid/b")
    ]
    # listed ids stay listed for every run: the ids of a player change
    assert plan_requests(spark, datasets.MATCH_IDS, run).count() == 2
    other = Run("jp1", "challenger", bronze=run.bronze)
    assert plan_requests(spark, datasets.ACCOUNT, other).count() == 0
    with pytest.raises(ValueError, match="paged"):
        plan_requests(spark, datasets.LEAGUE_ENTRIES, run)


def test_next_pages_of_listings(spark, run):
    entries = datasets.LEAGUE_ENTRIES
    nothing = log_of(spark, *pages([entry("a")], tier="MASTER"))
    assert rows(plan_requests(spark, entries, run, nothing).select("batch_id", "page")) == [(None, 1)]
    begun = log_of(spark, *pages([entry("a")], [entry("b")]), response("league_entries", None, page=3, status=429))
    asked = plan_requests(spark, entries, run, begun)
    assert rows(asked.select("batch_id", "page")) == [("fetch-1", 3)]
    assert asked.first()._source_url.endswith("page=3")
    assert plan_requests(spark, entries, run, log_of(spark, *pages([entry("a")], []))).count() == 0
    named = replace(run, fetched=("fetch-1", "fetch-2"))
    assert rows(plan_requests(spark, entries, named, begun).select("batch_id", "page")) == [("fetch-1", 3), ("fetch-2", 1)]


def test_a_null_key_is_not_asked_for(spark, run):
    ingest(spark, datasets.LEAGUE_ENTRIES, log_of(spark, *pages([entry("a"), {"wins": 1}], [])), run)
    assert rows(plan_requests(spark, datasets.SUMMONER, run).select("key")) == [("a",)]
    assert null_keys(spark, datasets.SUMMONER, run) == 1


def listed(spark, run, *puuids):
    ingest(spark, datasets.LEAGUE_ENTRIES, log_of(spark, *pages([entry(p) for p in puuids], [])), run)


def at(row, ts, batch="fetch-1"):
    return (row[0], batch, *row[2:11], ts, row[12])


def test_one_response_per_key_lands(spark, run):
    listed(spark, run, "a")
    late, early = datetime(2024, 2, 1), datetime(2024, 1, 1)
    log = log_of(
        spark,
        at(response("summoner_raw", {"puuid": "a", "v": 2}, key="a"), late),
        at(response("summoner_raw", {"puuid": "a", "v": 1}, key="a"), early),
        at(response("summoner_raw", {"puuid": "a", "v": 1}, key="a"), early),
        at(response("summoner_raw", {"puuid": "a", "v": 0}, key="a", region="JP1"), early),
    )
    out = ingest(spark, datasets.SUMMONER, log, run)
    assert (out["new_rows"], out["requests_made"]) == (1, 3)
    assert json.loads(table(spark, run, "summoner_raw").first().raw_json)["v"] == 1


def test_a_log_that_grows_during_a_run(spark, run, tmp_path, monkeypatch):
    """A stranger and a second answer are appended between the two passes over the bodies."""
    from millrace.plans import ingest as module

    listed(spark, run, "a", "b")
    path = str(tmp_path / "log")
    log_of(spark, response("summoner_raw", {"puuid": "a"}, key="a")).write.parquet(path)
    real = module.insert_counted

    def grow(rows_, name):
        more = [
            response("summoner_raw", {}, key="stranger"),
            at(response("summoner_raw", {"late": 1}, key="a"), datetime(2025, 1, 1)),
            response("summoner_raw", {}, key="b"),
        ]
        log_of(spark, *more).write.mode("append").parquet(path)
        return real(rows_, name)

    monkeypatch.setattr(module, "insert_counted", grow)
    out = ingest(spark, datasets.SUMMONER, spark.read.parquet(path), run)
    assert out["new_rows"] == 1
    assert rows(table(spark, run, "summoner_raw").select("puuid", "raw_json")) == [("a", '{"puuid": "a"}')]


def test_the_first_of_two_listings_wins(spark, run):
    first = [at(r, datetime(2024, 1, 1), "z") for r in pages([entry("a", 1), entry("b", 1), {"wins": 1}], [])]
    second = [at(r, datetime(2024, 1, 2), "y") for r in pages([entry("a", 2), entry("c", 2)], [])]
    assert ingest(spark, datasets.LEAGUE_ENTRIES, log_of(spark, *first, *second), run)["new_rows"] == 4
    got = table(spark, run, "league_entries").select("puuid", "leaguePoints")
    assert rows(got) == sorted([("a", 1), ("b", 1), ("c", 2), (None, None)], key=repr)


def test_a_run_of_nothing_but_429s_failed(spark, run):
    listed(spark, run, "a", "b")
    log = log_of(
        spark,
        response("summoner_raw", None, key="a", status=429, kind="method", after=1),
        response("summoner_raw", None, key="a", status=429, kind="service"),
        response("summoner_raw", None, key="b", status=429),
    )
    out = ingest(spark, datasets.SUMMONER, log, run)
    assert (out["unanswered"], out["requests_made"], out["count_429"]) == (2, 0, 3)
    last = table(spark, run, "ingestion_log").where("dataset = 'summoner_raw'").first()
    assert (last.status, last.requests_made) == ("FAILED", 0)


def test_junk_elements_are_rejected_and_never_land(spark, run):
    log = log_of(spark, *pages(["abc", None, 7, entry("a")], []))
    outs = [ingest(spark, datasets.LEAGUE_ENTRIES, log, run) for _ in range(2)]
    assert [(o["new_rows"], o["rejected"], o["requests_made"]) for o in outs] == [(1, 3, 2), (0, 3, 2)]


def test_only_the_named_fetch_batches_are_read(spark, run, schema, conf):
    conf(spark__sql__maxMetadataStringLength="2000")
    log = log_of(
        spark,
        *pages([entry("a")], []),
        *[at(r, AT, "fetch-2") for r in pages([entry("b")], [])],
    )
    log.write.partitionBy("dataset", "batch_id").saveAsTable(f"{schema}.responses")
    named = replace(run, fetched=("fetch-2",))
    own = own_responses(spark.table(f"{schema}.responses"), datasets.LEAGUE_ENTRIES, named)
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "fetch-2" in plan[plan.index("PartitionFilters") :]
    out = ingest(spark, datasets.LEAGUE_ENTRIES, spark.table(f"{schema}.responses"), named)
    assert (out["new_rows"], out["requests_made"]) == (1, 2)
    assert rows(table(spark, run, "league_entries").select("puuid")) == [("b",)]


def test_torn_lines_are_logged(spark, run, tmp_path):
    line = json.dumps({"dataset": "summoner_raw", "status": 200})
    (tmp_path / "1.jsonl").write_text(f"{line}\n{line[:20]}\n")
    ingest_all(spark, read_response_log(spark, str(tmp_path)), run)
    torn = table(spark, run, "ingestion_log").where("dataset = 'response_log'").first()
    assert (torn.rejected, torn.status) == (1, "FAILED")


def test_pending_matches_are_not_scoped_to_a_region(spark, run):
    ids = [("p", "m1", "KR"), ("q", "m2", "JP1")]
    ingest(spark, datasets.LEAGUE_ENTRIES, log_of(spark, *pages([])), run)
    ingest(spark, datasets.MATCH_IDS, log_of(spark, response("match_ids", [], key="p")), run)
    rows_ = spark.createDataFrame(ids, "puuid string, match_id string, _region string").selectExpr(
        "*", "'T' AS _tier", "'b' AS _batch_id", "timestamp'2024-01-01' AS _ingested_at"
    )
    append(rows_, run.table("match_ids"))
    assert rows(plan_requests(spark, datasets.MATCH_RAW, run).select("key")) == [("m1",), ("m2",)]


def test_wide_bodies_are_not_shuffled(spark, run, monkeypatch, executed):
    """What is written of documents goes from the scan of the log to the table."""
    from millrace.plans import ingest as module

    plans = []
    real = module.insert_counted

    def spy(rows_, *args):
        plans.append(executed(rows_))
        return real(rows_, *args)

    monkeypatch.setattr(module, "insert_counted", spy)
    ingest_all(spark, everything(spark), run)
    assert len(plans) == 4
    assert all("Exchange hashpartitioning" not in p.split("== Initial Plan ==")[0] for p in plans)


def test_datasets_are_looked_at_side_by_side(spark, run, monkeypatch):
    """All six count their responses before any of them waits for its keys."""
    from threading import Barrier

    from millrace.plans import ingest as module

    met, real = Barrier(len(datasets.DATASETS), timeout=120), module.batch_counters

    def counted(*args):
        met.wait()
        return real(*args)

    monkeypatch.setattr(module, "batch_counters", counted)
    out = ingest_all(spark, everything(spark), run)
    assert list(out) == [d.name for d in datasets.DATASETS]
    assert [c["new_rows"] for c in out.values()] == [2, 2, 2, 1, 1, 2]
    assert table(spark, run, "ingestion_log").count() == 6


def test_a_dataset_whose_keys_failed_lands_nothing(spark, run, monkeypatch):
    from millrace.plans import ingest as module

    def fail(*args, **kwargs):
        raise RuntimeError("no listing")

    monkeypatch.setattr(module, "merge_into", fail)  # of the listing only
    with pytest.raises(RuntimeError, match="no listing"):
        ingest_all(spark, everything(spark), run)
    assert {table(spark, run, d.name).count() for d in datasets.DATASETS} == {0}


def test_documents_that_name_one_key(spark, run):
    """The first one lands, be it by the key asked for or not, unless the table has the key."""
    listed(spark, run, *"abcdef")
    ingest(spark, datasets.ACCOUNT, log_of(spark, response("account_raw", {"puuid": "f"}, key="f")), run)
    answers = [("a", "z", 1), ("b", "z", 2), ("c", "c", 2), ("d", "c", 1), ("e", "f", 1)]
    log = log_of(
        spark,
        *[at(response("account_raw", {"puuid": p, "from": k}, key=k), datetime(2024, 1, t)) for k, p, t in answers],
    )
    out = ingest(spark, datasets.ACCOUNT, log, run)
    assert (out["new_rows"], out["key_mismatch"]) == (2, 4)
    got = [(r.puuid, json.loads(r.raw_json).get("from")) for r in table(spark, run, "account_raw").collect()]
    assert sorted(got, key=repr) == [("c", "d"), ("f", None), ("z", "a")]


def test_documents_are_parsed_once(spark, run, monkeypatch, executed):
    """What lands was parsed by the pass that looked at the bodies."""
    from millrace.plans import ingest as module

    listed(spark, run, "p")
    ingest(spark, datasets.MATCH_IDS, log_of(spark, response("match_ids", ["m1"], key="p")), run)
    plans, real = [], module.insert_counted

    def spy(rows_, name):
        plans.append(executed(rows_))
        return real(rows_, name)

    monkeypatch.setattr(module, "insert_counted", spy)
    body = {"metadata": {"matchId": "m1"}, "info": {"platformId": "KR", "gameCreation": 5}}
    ingest(spark, datasets.MATCH_RAW, log_of(spark, response("match_raw", body, key="m1")), run)
    assert len(plans) == 1 and "from_json" not in plans[0]
    assert rows(table(spark, run, "match_raw").select("platform_id", "game_creation")) == [("KR", 5)]


def test_counters_without_429s(spark):
    from millrace.operators.responses import with_action
    from millrace.operators.runlog import batch_counters

    log = with_action(everything(spark)).withColumn("batch_id", F.col("dataset"))
    for calm in (log.where("status <> 429"), log.where("false")):
        for by in ([], ["batch_id"]):
            both = [rows(batch_counters(calm, by, "ts", ["key"], told)) for told in (True, False)]
            assert both[0] == both[1]
