"""Request addresses as column expressions."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# The address of each dataset's request. No secret is ever part of one.
URL_FORMATS = {
    "league_entries": "https://{host}/lol/league-exp/v4/entries/{queue}/{tier}/{division}?page={page}",
    "match_ids": "https://{host}/lol/match/v5/matches/by-puuid/{key}/ids?queue={queue_id}&start={start}&count={count}",
    "match_raw": "https://{host}/lol/match/v5/matches/{key}",
    "match_timeline_raw": "https://{host}/lol/match/v5/matches/{key}/timeline",
    "summoner_raw": "https://{host}/lol/summoner/v4/summoners/by-puuid/{key}",
    "account_raw": "https://{host}/riot/account/v1/accounts/by-puuid/{key}",
}


def fill(template: str, **values: Column | str | int) -> Column:
    """`template` with each {name} replaced by a column or a constant; NULL if a column is NULL."""
    parts: list[Column] = []
    for text, name, _, _ in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if name is not None:
            value = values[name]
            parts.append(value.cast("string") if isinstance(value, Column) else F.lit(str(value)))
    return F.concat(*parts)
