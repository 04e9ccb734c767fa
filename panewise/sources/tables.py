"""Parquet tables as batch frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    if not sf_dir:
        raise ValueError("the folder that holds the tables is not set")
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def table_pattern(sf_dir: str, name: str) -> str:
    """The path of a table for a file stream, which takes a table that is one file only as a pattern."""
    folder, _, file = table_path(sf_dir, name).rpartition("/")
    return f"{folder}/{{{file}}}"
