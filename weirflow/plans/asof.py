"""Point-in-time lookup of versioned rows without a range join.

Facts and versions are merged on the time axis of their key, and each fact takes the latest version
before it. A range join would pair every fact of a hot key with every version of that key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.plans.segments import plan_cuts, running_window


def asof_lookup(
    facts: DataFrame, versions: DataFrame, key: str, fact_time: str, valid_from: str, valid_to: str | None,
    attributes: Sequence[str], *, segments: int | None = None,
) -> DataFrame:
    """Each fact with the attributes of the version valid at its time, NULL where there is none.

    ``valid_to`` is inclusive; a NULL end means the version is still open. Versions of a key do not overlap.
    """
    taken = [valid_from, *([valid_to] if valid_to else []), *attributes]
    marks = versions.select(
        F.col(key), F.col(valid_from).alias("__at"), F.lit(0).alias("__fact"),
        F.struct(*taken).alias("__version"),
    )
    rows = facts.withColumns({"__at": F.col(fact_time), "__fact": F.lit(1)})
    merged = rows.unionByName(marks, allowMissingColumns=True)
    latest = running_window(
        merged, [key], ["__at", "__fact"], {"__hit": ("max", "__version")}, cuts=plan_cuts(facts, fact_time, segments, keys=[key])
    ).filter(F.col("__fact") == 1)
    valid = F.lit(True)
    if valid_to:
        end = F.col(f"__hit.{valid_to}")
        valid = end.isNull() | (F.col(fact_time) <= end)
    return latest.select(
        *facts.columns, *[F.when(valid, F.col(f"__hit.{a}")).alias(a) for a in attributes]
    )
