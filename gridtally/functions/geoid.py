"""Area codes: regions, nested prefixes, padding, per-vintage column names."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# State codes of each region.
REGION_STATES: dict[str, list[str]] = {
    "NE1": ["09", "23", "25", "33", "44", "50"],
    "MA2": ["34", "36", "42"],
    "NEC3": ["17", "18", "26", "39", "55"],
    "WNC4": ["19", "20", "27", "29", "31", "38", "46"],
    "SA5": ["10", "11", "12", "13", "24", "45", "37", "51", "54"],
    "ESC6": ["01", "21", "28", "47"],
    "WSC7": ["05", "22", "40", "48"],
    "M8": ["04", "08", "16", "30", "32", "35", "49", "56"],
    "P9": ["06", "41", "53"],
}

# Number of leading characters that identify an area.
LEVEL_LENGTHS: dict[str, int] = {
    "blocks": 15,
    "block_groups": 12,
    "tracts": 11,
    "counties": 5,
}

# Code column of each level in the files of the 2000 vintage.
CODE_COLUMNS_2000: dict[str, str] = {
    "blocks": "BLKIDFP00",
    "block_groups": "BKGPIDFP00",
    "tracts": "CTIDFP00",
    "counties": "CNTYIDFP00",
}

PARENT_LEVELS: tuple[str, ...] = tuple(n for n in LEVEL_LENGTHS if n != "blocks")


def known_states(regions: Iterable[str] | None = None) -> list[str]:
    """State codes of the given regions, or of all of them."""
    return [s for r in (regions or REGION_STATES) for s in REGION_STATES[r]]


def code_column(vintage: int, level: str = "blocks") -> str:
    """Name of the area-code column in files of a vintage and level."""
    if int(vintage) == 2000:
        return CODE_COLUMNS_2000[level]
    return f"GEOID{int(vintage) % 100:02d}"


def state_of(geoid: Column) -> Column:
    return F.substring(geoid, 1, 2)


def area_prefix(geoid: Column, level: str) -> Column:
    """Code of the enclosing area of a level."""
    return F.substring(geoid, 1, LEVEL_LENGTHS[level])


def region_of(geoid: Column) -> Column:
    """Region of an area code, NULL for states outside every region.

    The table is a constant, so this is a lookup in a literal map and needs no
    join.
    """
    pairs = [F.lit(x) for r, states in REGION_STATES.items() for s in states for x in (s, r)]
    return F.try_element_at(F.create_map(*pairs), state_of(geoid))


def in_regions(geoid: Column, regions: Iterable[str] | None = None) -> Column:
    return state_of(geoid).isin(known_states(regions))


def pad_code(code: Column, length: int = LEVEL_LENGTHS["blocks"]) -> Column:
    """Area code that was read as a number, padded with zeroes again.

    Codes that already have more digits stay whole (``lpad`` alone would cut
    them).  Text that is no number gives NULL.
    """
    digits = code.try_cast(f"decimal({max(length, 20)},0)").cast("string")
    return F.when(F.length(digits) >= length, digits).otherwise(F.lpad(digits, length, "0"))


def parent_codes(geoid: Column, levels: Sequence[str]) -> Column:
    """Array of ``(level, geoid)`` for the enclosing areas."""
    return F.array(
        *[F.struct(F.lit(n).alias("level"), area_prefix(geoid, n).alias("geoid")) for n in levels]
    )
