"""Resolving the many spellings of a channel's name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.functions.text import strip, strip_at


def spelling(name: Column) -> Column:
    """What is left to compare of a written name: no blanks, no ``@``, no letter case."""
    return F.lower(strip_at(strip(name)))


def with_username(rows: DataFrame, channels: DataFrame, name: str, out: str = "username") -> DataFrame:
    """Add the channel's username as ``out``; NULL where ``name`` is NULL, empty or unknown.

    A name of digits only is a channel's id. The channel table isn't hinted: Catalyst broadcasts it as long
    as it is below the session's threshold and else joins by shuffle, where AQE splits the hot names.
    """
    by_name = channels.where(~F.col("username").rlike("^[0-9]+$")).select(
        F.lower("username").alias("__spelled"), F.col("username").alias(out)
    )
    by_id = channels.select(F.col("id").cast("string").alias("__spelled"), F.col("username").alias(out))
    rows = rows.drop(out) if out in rows.columns and out != name else rows
    keyed = rows.withColumn("__spelled", spelling(F.col(name)))
    return keyed.join(by_name.unionByName(by_id), "__spelled", "left").drop("__spelled")
