"""The six ingested datasets: table, merge key, where keys come from, and how a body is landed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from millrace import schemas
from millrace.operators.landing import (
    check_arrays,
    parse_document,
    parse_id_array,
    parse_opaque_document,
    parse_paged_array,
)


@dataclass(frozen=True)
class Dataset:
    name: str
    columns: str
    merge_on: tuple[str, ...]
    regional: bool  # asked of the region's host, else of the platform's
    key: str | None = None
    keys_from: str | None = None  # table that lists the keys to ask for; None: a paged listing
    keys_scoped: bool = False  # only keys of the run's region and tier
    once: bool = False  # leave out keys that the dataset's own table has
    parse: Callable[[DataFrame], DataFrame] = check_arrays  # adds _malformed to all responses
    explode: Callable[[DataFrame], DataFrame] | None = None  # all elements of bodies that are arrays


def _league_entries(pages: DataFrame) -> DataFrame:
    return parse_paged_array(pages, schemas.LEAGUE_ENTRY)


def _match_ids(lists: DataFrame) -> DataFrame:
    return parse_id_array(lists, "match_id")


def _match_raw(documents: DataFrame) -> DataFrame:
    fields = {
        "platform_id": ("info.platformId", "string"),
        "game_creation": ("info.gameCreation", "bigint"),
    }
    return parse_document(documents, "match_id", "key", "metadata.matchId", fields)


def _match_timeline(documents: DataFrame) -> DataFrame:
    return parse_opaque_document(documents, "match_id", "key")


def _player(documents: DataFrame) -> DataFrame:
    return parse_document(documents, "puuid", "key", "puuid")


LEAGUE_ENTRIES = Dataset(
    "league_entries",
    schemas.LEAGUE_ENTRIES,
    merge_on=("puuid", "_region", "_tier"),
    regional=False,
    explode=_league_entries,
)
MATCH_IDS = Dataset(
    "match_ids",
    schemas.MATCH_IDS,
    merge_on=("puuid", "match_id"),
    regional=True,
    key="puuid",
    keys_from="league_entries",
    keys_scoped=True,
    explode=_match_ids,
)
MATCH_RAW = Dataset(
    "match_raw",
    schemas.MATCH_RAW,
    merge_on=("match_id",),
    regional=True,
    key="match_id",
    keys_from="match_ids",
    once=True,
    parse=_match_raw,
)
MATCH_TIMELINE = Dataset(
    "match_timeline_raw",
    schemas.MATCH_TIMELINE_RAW,
    merge_on=("match_id",),
    regional=True,
    key="match_id",
    keys_from="match_raw",
    once=True,
    parse=_match_timeline,
)
SUMMONER = Dataset(
    "summoner_raw",
    schemas.PLAYER_RAW,
    merge_on=("puuid",),
    regional=False,
    key="puuid",
    keys_from="league_entries",
    keys_scoped=True,
    once=True,
    parse=_player,
)
ACCOUNT = Dataset(
    "account_raw",
    schemas.PLAYER_RAW,
    merge_on=("puuid",),
    regional=True,
    key="puuid",
    keys_from="league_entries",
    keys_scoped=True,
    once=True,
    parse=_player,
)

# In an order in which each dataset follows the one that lists its keys.
DATASETS = (LEAGUE_ENTRIES, MATCH_IDS, MATCH_RAW, MATCH_TIMELINE, SUMMONER, ACCOUNT)
