"""Title dictionary: one ``"id": "Title",`` entry per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkdex.functions.text import trim_control
from inkdex.sources.stage_text import fitting, last_by_line, text_lines

# Fixed value: an entry is a quoted id, a colon, and a title up to the last quote of the line.
ENTRY = r'(?s)^"([^"]*)"[^:]*:[\x00-\x20]*"(.+)"'


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id string, title)``; lines of any other form are skipped, the last entry of an id wins."""
    line = trim_control(F.col("value"))
    entries = text_lines(spark, path).where(line.rlike(ENTRY))
    return last_by_line(
        entries.select(
            F.regexp_extract(line, ENTRY, 1).alias("doc_id"),
            F.regexp_extract(line, ENTRY, 2).alias("title"),
            "line_at",
        ),
        "doc_id",
        "title",
    )


def write_titles(titles: DataFrame, path: str) -> None:
    """Entries that ``read_titles`` reads back; a quote in an id or a line break is an error."""
    doc_id, title = fitting(F.col("doc_id"), '["\\n\\r]'), fitting(F.col("title"), "[\\n\\r]")
    entry = F.format_string('"%s": "%s",', doc_id, title)
    titles.select(entry.alias("value")).write.mode("overwrite").text(path)
