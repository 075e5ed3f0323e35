"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.tables import discard, materialize, shared_dir, ship, uses

__all__ = ["SPACE_RUN", "discard", "materialize", "n_partitions", "read", "shared_dir", "ship", "uses", "words"]

#: A word is a maximal run of characters other than space and U+0009..U+000D.
SPACE_RUN = "[ \\t-\\r]+"


def n_partitions(spark: SparkSession) -> int:
    """How many tasks a shuffle is planned for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words(text: Column) -> Column:
    """The words of a text (null: none), in order."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
