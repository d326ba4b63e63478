"""The newest version of each element, kept up to date from a stream of versions.

The batch extract looks for it in a whole dump; here it is state: one row per id, merged
on the map side and kept by the state store. Updates carry deleted versions too, so that a
sink can remove what is gone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.elements import eligible


def newest_stream(versions: DataFrame) -> DataFrame:
    """Rows like those of ``versions``: the newest eligible version of each id whose versions
    arrived. For output mode "update", or "complete" where all elements are wanted."""
    rows = eligible(versions)
    others = [c for c in rows.columns if c != "id"]
    best = rows.groupBy("id").agg(F.max_by(F.struct(*others), "version").alias("newest"))
    return best.select("id", *[F.col(f"newest.{c}").alias(c) for c in others])
