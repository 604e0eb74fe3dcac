"""Streaming wrappers: text documents as they arrive through the stateless transforms, and tallies by window.

Transforms of one document (lines, normalisation) take a stream as they take a table. Folds over a document need
its pages together: a document that arrives as one row has them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.functions import patterns as P
from quirelake.operators.normalize import normalize_lines
from quirelake.sources import text as S


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of (doc_id, text): new files of a folder, whole."""
    rows = spark.readStream.format("text").option("wholetext", "true").load(folder)
    return rows.select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text"))


def normalized_lines(docs: DataFrame, rules: P.Rules = P.TEXTBOOK) -> DataFrame:
    return normalize_lines(S.page_lines(S.text_pages(docs)), rules)


def event_counts(events: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """window, event_type, n, total of an event stream, closed by a watermark."""
    rows = events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return rows.select(F.col("window.start").alias("start"), "event_type", "n", "total")
