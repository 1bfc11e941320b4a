"""Attributes of a prediction file, taken from its path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The file naming patterns.
YEAR_PATTERN = r"^[0-9]{4}"
REGION_PATTERN = r"[A-Z]+[0-9]"
PART_PATTERN = r"(?<=part)[0-9]+"
PART_SUFFIX = r"\.part[0-9]+"


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def strip_extension(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[A-Za-z0-9]+$", "")


def _first_match(text: Column, pattern: str) -> Column:
    return F.regexp_substr(text, F.lit(pattern))


def file_year(path: Column) -> Column:
    return _first_match(base_name(path), YEAR_PATTERN)


def file_region(path: Column) -> Column:
    return _first_match(base_name(path), REGION_PATTERN)


def file_part(path: Column) -> Column:
    return _first_match(base_name(path), PART_PATTERN)


def file_species(path: Column, extension: str = "rds") -> Column:
    """The name piece before the extension; a part number is taken out first."""
    whole = F.regexp_replace(base_name(path), f"^(.*?){PART_SUFFIX}", "$1")
    return _first_match(whole, rf"[^\.]+(?=\.{extension})")


def file_attributes(path: Column, extension: str = "rds") -> dict[str, Column]:
    return {
        "year": file_year(path),
        "region": file_region(path),
        "part_number": file_part(path),
        "species": file_species(path, extension),
    }
