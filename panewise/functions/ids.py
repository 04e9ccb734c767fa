"""Keys for records that come without one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def random_id() -> Column:
    """A new key per row. Not repeatable: a recomputed row gets another one."""
    return F.uuid()


def content_id(*parts: Column) -> Column:
    """A key made from columns that identify the row; a retried task gives the same key."""
    return F.md5(F.concat_ws(":", *[part.cast("string") for part in parts]))
