"""Surrogate keys and content hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casegrid.functions._util import to_col

# Fixed values that must equal the warehouse convention being reproduced:
# the null placeholder and the separator of the md5 surrogate key, and the
# field separator (U+241F, the visible "symbol for unit separator") of the
# narrative content hash.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"
CONTENT_SEP = "␟"


def surrogate_key(*cols) -> Column:
    """md5 over '-'-joined text casts; a null part becomes a placeholder.

    The key is never null, so a null dimension member still gets a key.
    ``concat_ws`` is avoided on purpose: it drops nulls, which would collide
    ('a', null) with (null, 'a').
    """
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(SURROGATE_SEP))
        parts.append(F.coalesce(to_col(c).cast("string"), F.lit(SURROGATE_NULL)))
    return F.md5(F.concat(*parts))


def content_hash(*cols, sep: str = CONTENT_SEP) -> Column:
    """sha256 hex of the fields joined by ``sep``; a null field counts as ''."""
    return F.sha2(F.concat_ws(sep, *[F.coalesce(to_col(c), F.lit("")) for c in cols]), 256)
