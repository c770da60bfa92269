import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions import routing
from millrace.functions.urls import URL_FORMATS, fill
from millrace.operators.validate import UnknownKeys, known_text, missing_keys, require_known
from millrace.plans.datasets import DATASETS
from millrace.plans.ingest import Run, source_url

EXPECTED = {
    "asia": {"KR", "JP1"},
    "americas": {"NA1", "BR1", "LA1", "LA2"},
    "europe": {"EUW1", "EUN1", "TR1", "RU", "ME1"},
    "sea": {"OC1", "PH2", "SG2", "TH2", "TW2", "VN2"},
}


def test_map_has_17_platforms_in_four_regions():
    assert len(routing.PLATFORM_TO_REGION) == 17
    for region, platforms in EXPECTED.items():
        assert {p for p, r in routing.PLATFORM_TO_REGION.items() if r == region} == platforms


def test_constants():
    assert routing.RANKED_QUEUE == "RANKED_SOLO_5x5"
    assert routing.DEFAULT_MATCH_COUNT == 20


def test_hosts(spark):
    df = spark.createDataFrame([("KR",), ("na1",), ("FAKE",), (None,)], "p string")
    out = df.select(
        "p",
        routing.platform_host(F.col("p"), ".x").alias("own"),
        routing.region_host(F.col("p"), ".x").alias("region"),
    )
    assert rows(out) == sorted(
        [
            ("KR", "kr.x", "asia.x"),
            ("na1", "na1.x", "americas.x"),
            ("FAKE", "fake.x", None),
            (None, None, None),
        ],
        key=repr,
    )


def test_run_parameters():
    assert routing.run_parameters("kr", "challenger") == ("KR", "CHALLENGER")
    assert routing.run_parameters("NA1", "GRANDMASTER") == ("NA1", "GRANDMASTER")
    with pytest.raises(routing.UnknownPlatform, match="BR1, EUN1"):
        routing.run_parameters("INVALID_REGION", "CHALLENGER")
    with pytest.raises(routing.UnknownPlatform):
        Run(region="FAKE")


def test_source_urls_of_all_datasets(spark):
    run = Run("kr", "challenger", host_suffix=".x")
    one = spark.range(1)
    urls = {
        d.name: one.select(source_url(d, run, F.lit("k"), F.lit(3))).first()[0] for d in DATASETS
    }
    assert urls == {
        "league_entries": "https://kr.x/lol/league-exp/v4/entries/RANKED_SOLO_5x5/CHALLENGER/I?page=3",
        "match_ids": "https://asia.x/lol/match/v5/matches/by-puuid/k/ids?queue=420&start=0&count=20",
        "match_raw": "https://asia.x/lol/match/v5/matches/k",
        "match_timeline_raw": "https://asia.x/lol/match/v5/matches/k/timeline",
        "summoner_raw": "https://kr.x/lol/summoner/v4/summoners/by-puuid/k",
        "account_raw": "https://asia.x/riot/account/v1/accounts/by-puuid/k",
    }
    assert set(URL_FORMATS) == {d.name for d in DATASETS}


def test_fill_is_null_with_a_null_part(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(df.select(fill("x/{k}", k=F.col("k")))) == [("x/a",), (None,)]


def test_require_known(spark):
    known = spark.createDataFrame([("CLICK",), ("VIEW",)], "t string")
    require_known(spark.createDataFrame([("click",), ("View",)], "t string"), known, "t")
    with pytest.raises(UnknownKeys, match="1 unknown t: BUY$"):
        require_known(spark.createDataFrame([("buy",), ("click",)], "t string"), known, "t")


def test_unknown_keys_are_named_whatever_the_number_of_known_ones(spark):
    known = spark.range(2000).select(F.col("id").cast("string").alias("t"))
    assert len(known_text(known, "t").first()[0].split(", ")) == 2000
    asked = spark.range(1990, 2030).select(F.col("id").cast("string").alias("t"))
    with pytest.raises(UnknownKeys, match="30 unknown t: 2000, 2001, .*2009 and 20 more") as error:
        require_known(asked, known, "t")
    assert "known:" not in str(error.value)


def test_missing_keys(spark):
    need = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    have = spark.createDataFrame([("a",), ("c",)], "k string")
    assert rows(missing_keys(need, have, "k")) == [("b",)]
