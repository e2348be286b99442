"""The one definition of business-key hashing, as columns and in plain Python."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: parts of a key are joined with DELIMITER, and an absent part reads ABSENT
DELIMITER, ABSENT = "||", "^^"


def component(c: Column | str) -> Column:
    """A part of a key as it is hashed: text, without blanks at the ends, upper case; null reads ABSENT."""
    return F.coalesce(F.upper(F.trim((F.col(c) if isinstance(c, str) else c).cast("string"))), F.lit(ABSENT))


def hash_key(parts: Sequence[Column | str]) -> Column:
    """64 lower-case hex digits of SHA-256 over the parts, in the order given."""
    if not parts:
        raise ValueError("a hash key needs a part")
    return F.sha2(F.concat_ws(DELIMITER, *map(component, parts)), 256)


def hash_diff(attributes: Sequence[Column | str]) -> Column:
    """The state of a satellite; attributes that differ in case alone are one state."""
    return hash_key(attributes)


def hash_hex(values: Sequence[object]) -> str:
    """What `hash_key` gives for these values. Blanks at the ends are spaces only, as in Spark."""
    if not values:
        raise ValueError("a hash key needs a part")
    parts = [ABSENT if v is None else str(v).strip(" ").upper() for v in values]
    return hashlib.sha256(DELIMITER.join(parts).encode()).hexdigest()
