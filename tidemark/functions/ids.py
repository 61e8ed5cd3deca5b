"""Row identifiers for sinks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def random_id() -> Column:
    """32 hex digits, a UUID without dashes (a replayed batch gets new ids)."""
    return F.regexp_replace(F.expr("uuid()"), "-", "")


def deterministic_id(*cols: str | Column, batch_id: int | Column | None = None) -> Column:
    """32 hex digits from the row's content (and the batch id if given), so a replayed
    batch produces the same ids and the target can drop the copies."""
    parts = [F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"),
                        F.lit("\u0000")) for c in cols]
    if batch_id is not None:
        parts.append(F.lit(batch_id).cast("string") if not isinstance(batch_id, Column)
                     else batch_id.cast("string"))
    return F.substring(F.sha2(F.concat_ws("\u0001", *parts), 256), 1, 32)
