"""Names of sites as one key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def site_key(base_url: Column) -> Column:
    """``base_url`` without scheme, letter case, leading ``www.`` and trailing slashes."""
    bare = F.regexp_replace(F.lower(F.trim(base_url)), r"^[a-z][a-z0-9+.\-]*://", "")
    return F.regexp_replace(F.regexp_replace(bare, r"^www\.", ""), r"/+$", "")
