"""Stable keys: message groups and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CHUNK = 8  # hex digits folded at a time; 16**8 * groups stays far below 2**63


def hash_remainder(value: Column, groups: int) -> Column:
    """sha256(value) read as one big number, modulo `groups`.

    Folded in eight fixed steps of plain arithmetic, so it stays in generated code.
    """
    digest = F.sha2(value.cast("string").cast("binary"), 256)
    rest = F.lit(0).cast("bigint")
    for start in range(1, 65, _CHUNK):
        chunk = F.conv(F.substring(digest, start, _CHUNK), 16, 10).cast("bigint")
        rest = (rest * F.lit(16**_CHUNK) + chunk) % F.lit(groups)
    return rest


def message_group(member_id: Column, groups: int = 10) -> Column:
    return F.concat(F.lit("group-"), hash_remainder(member_id, groups).cast("string"))


def surrogate_key(*parts: Column) -> Column:
    """128-bit key text of a natural key.

    The same key always gets the same id, on any executor and in any run, so no global
    numbering is needed. Each part is written with its length, NULL as '-', which keeps
    different keys apart.
    """
    texts = [p.cast("string") for p in parts]
    coded = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat_ws("|", *coded).cast("binary"))
