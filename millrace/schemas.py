"""Explicit schemas. Nothing here is inferred, so a column that is NULL in every row is legal."""

from __future__ import annotations

# Table columns, in the order of the tables that users already have.
LEAGUE_ENTRY = (
    "summonerId STRING, leagueId STRING, queueType STRING, tier STRING, rank STRING, "
    "leaguePoints BIGINT, wins BIGINT, losses BIGINT, veteran BOOLEAN, inactive BOOLEAN, "
    "freshBlood BOOLEAN, hotStreak BOOLEAN, puuid STRING"
)
LEAGUE_ENTRIES = (
    f"{LEAGUE_ENTRY}, _raw_json STRING, _region STRING, _tier STRING, _page BIGINT, "
    "_batch_id STRING, _ingested_at TIMESTAMP, _source_url STRING"
)
MATCH_IDS = (
    "puuid STRING, match_id STRING, _region STRING, _tier STRING, _batch_id STRING, "
    "_ingested_at TIMESTAMP"
)
MATCH_RAW = (
    "match_id STRING, raw_json STRING, platform_id STRING, game_creation BIGINT, "
    "_batch_id STRING, _ingested_at TIMESTAMP, _source_url STRING"
)
MATCH_TIMELINE_RAW = (
    "match_id STRING, raw_json STRING, _batch_id STRING, _ingested_at TIMESTAMP, "
    "_source_url STRING"
)
PLAYER_RAW = (
    "puuid STRING, raw_json STRING, _region STRING, _batch_id STRING, _ingested_at TIMESTAMP, "
    "_source_url STRING"
)

# The run log names its dataset and counts what was rejected.
INGESTION_LOG = (
    "batch_id STRING, dataset STRING, run_start TIMESTAMP, run_end TIMESTAMP, "
    "requests_made BIGINT, count_429 BIGINT, new_rows BIGINT, rejected BIGINT, status STRING"
)

# One row per response, as a fetcher lands it. `key` is the requested key (NULL for a list page),
# `page` the page number (NULL otherwise), `body` the text exactly as received.
RESPONSE_LOG = (
    "dataset STRING, batch_id STRING, region STRING, tier STRING, division STRING, "
    "key STRING, page BIGINT, url STRING, status INT, rate_limit_type STRING, "
    "retry_after INT, ts TIMESTAMP, body STRING"
)
