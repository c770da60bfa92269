"""Platform and region hosts, and the check of run parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Platform code -> region.
PLATFORM_TO_REGION = {
    "KR": "asia",
    "JP1": "asia",
    "NA1": "americas",
    "BR1": "americas",
    "LA1": "americas",
    "LA2": "americas",
    "EUW1": "europe",
    "EUN1": "europe",
    "TR1": "europe",
    "RU": "europe",
    "ME1": "europe",
    "OC1": "sea",
    "PH2": "sea",
    "SG2": "sea",
    "TH2": "sea",
    "TW2": "sea",
    "VN2": "sea",
}

# Fixed value: what follows the platform or region in a host name.
HOST_SUFFIX = ".api.riotgames.com"

# The ranked queue, ids asked for per player (the source allows 100).
RANKED_QUEUE = "RANKED_SOLO_5x5"
RANKED_QUEUE_ID = 420
DEFAULT_MATCH_COUNT = 20


class UnknownPlatform(ValueError):
    """A platform code without a region."""


def known_platforms() -> list[str]:
    return sorted(PLATFORM_TO_REGION)


def region_of(platform: Column) -> Column:
    """Region of a platform code in any case; NULL where unknown.

    The map is a 17-entry literal, so the lookup is a projection: no join, no shuffle.
    """
    entries = [F.lit(x) for pair in PLATFORM_TO_REGION.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), F.upper(platform))


def platform_host(platform: Column, suffix: str = HOST_SUFFIX) -> Column:
    """Host of the platform itself. Unknown codes are not refused here."""
    return F.concat(F.lower(platform), F.lit(suffix))


def region_host(platform: Column, suffix: str = HOST_SUFFIX) -> Column:
    """Host of the platform's region; NULL where the platform is unknown."""
    return F.concat(region_of(platform), F.lit(suffix))


def run_parameters(region: str, tier: str) -> tuple[str, str]:
    """Upper-cased (region, tier); an unknown region is an error. The tier is not checked."""
    if region.upper() not in PLATFORM_TO_REGION:
        raise UnknownPlatform(f"unknown platform {region!r}; known: {', '.join(known_platforms())}")
    return region.upper(), tier.upper()
