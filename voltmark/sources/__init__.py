"""Landing of raw extracts and the tables of a lake."""

from voltmark.sources.lake import Lake
from voltmark.sources.landing import land, land_files, land_rows

__all__ = ["Lake", "land", "land_files", "land_rows"]
