"""Hash keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_fields(fields: Sequence[str | Column], sep: str = "|", null: str = "_null_") -> Column:
    cols = [F.col(f) if isinstance(f, str) else f for f in fields]
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit(null)) for c in cols])


def surrogate_key(fields: Sequence[str | Column]) -> Column:
    """Stable key of several fields; NULL and the empty text differ."""
    return F.md5(joined_fields(fields).cast("binary"))


def surrogate_key64(fields: Sequence[str | Column]) -> Column:
    """The 64-bit form: half the shuffle bytes, with collisions possible beyond some billion keys."""
    return F.xxhash64(joined_fields(fields))


def token(c, salt: str) -> Column:
    """Irreversible token of a value."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sha2(F.concat(F.lit(salt), c.cast("string")).cast("binary"), 256)
