"""Intermediate tables and small helpers that the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panewise.session import shared_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lost executors cost no recomputation."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drawn(share: Column | float, *key: str) -> Column:
    """True for about this share of the rows, by a hash of the key; always true for a share of 1."""
    value = F.xxhash64(*key)
    # Two draws of 20 bits make one of 40, so that few rows of very many are no more than asked for.
    turn = F.pmod(value, F.lit(1 << 20)) * (1 << 20) + F.pmod(F.shiftright(value, 20), F.lit(1 << 20))
    return turn < share * float(1 << 40)


def fold(key: str, residue: int) -> Column:
    """crc32 of a key as text, modulo ``residue``. Null keys fall into no fold."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % residue
