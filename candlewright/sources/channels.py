"""Channel lists and resume marks kept as small files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.schemas import SCRAPE_CHECKPOINTS


def read_channel_lists(spark: SparkSession, path: str) -> DataFrame:
    """A YAML file of channel names under language keys to ``position, language, channel``, in the file's order.

    Only that shape is read: ``channels:`` above keys with lists of plain or quoted names; ``#`` begins a comment.
    """
    lines = spark.read.text(path, wholetext=True).select(F.explode(F.split("value", r"\r?\n")).alias("line"))
    rows: list[tuple[int, str, str]] = []
    language = None
    for row in lines.collect():  # one settings file
        line = row.line.split(" #")[0].rstrip()
        entry = line.strip()
        if entry.startswith("- ") and language:
            rows.append((len(rows) + 1, language, entry[2:].strip().strip("\"'")))
        elif entry.endswith(":") and line.startswith(" "):
            language = entry[:-1].strip()
    return spark.createDataFrame(rows, "position int, language string, channel string")


def concatenated(*lists: DataFrame) -> DataFrame:
    """Channel lists one after the other, duplicates kept: ``list_no`` tells whose a row is."""
    numbered = [rows.withColumn("list_no", F.lit(i)) for i, rows in enumerate(lists, 1)]
    out = numbered[0]
    for rows in numbered[1:]:
        out = out.unionByName(rows)
    return out


def read_scrape_marks(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON file per channel, named after it, to ``channel, last_message_id, last_scraped_at``."""
    files = spark.read.schema("last_message_id bigint, last_scraped_at string").option("multiLine", True).option("pathGlobFilter", "*.json")
    rows = files.json(folder).withColumn("channel", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1))
    at = F.to_timestamp("last_scraped_at").cast("timestamp_ntz")
    return rows.select(*(c.name if c.name != "last_scraped_at" else at.alias(c.name) for c in SCRAPE_CHECKPOINTS.fields))
