"""Registration of queries, tables and the geometry that text tables get for layout operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its name, with the SQL that must agree."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def planted(df: DataFrame, number: Column, given: list[str], between: str) -> DataFrame:
    """df with one of the given strings put after each text, in turn by number."""
    return df.withColumn("text", F.concat("text", F.lit(between), in_turn(number, given)))


def in_turn(number: Column, given: list) -> Column:
    return F.element_at(F.array(*map(F.lit, given)), (number % len(given) + 1).cast("int"))


def sql_value(v) -> str:
    if isinstance(v, str):
        parts = re.findall(r"[^\n\t]+|[\n\t]", v) or [""]
        return " || ".join(f"chr({ord(p)})" if p in ("\n", "\t") else "'" + p.replace("'", "''") + "'" for p in parts)
    if isinstance(v, list | tuple):
        return f"[{', '.join(map(sql_value, v))}]"
    return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v)


def sql_rows(name: str, columns: str, rows: list[tuple]) -> str:
    """A common table of literal rows."""
    return f"{name} AS (SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(sql_value, r)) + ')' for r in rows)}) AS v({columns}))"


#: Four lines a page on a sheet of 595 x 842; the first and the last stand in the edge zones.
LINES_PER_PAGE, PAGE_WIDTH, PAGE_HEIGHT = 4, 595.0, 842.0


def layout_lines(docs: DataFrame) -> DataFrame:
    """Lines of documents with coordinates derived from their number and length."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "text"))
    n = F.char_length("text")
    return lines.select(
        "doc_id", (F.col("line_no") / LINES_PER_PAGE).cast("int").alias("page_no"), "line_no", "text",
        (55.0 + 9.0 * (n % 3)).alias("x0"), (40.0 + 250.0 * (F.col("line_no") % LINES_PER_PAGE)).alias("y0"),
        (55.0 + 9.0 * (n % 3) + 5.0 * F.least(n, F.lit(90))).alias("x1"), (52.0 + 250.0 * (F.col("line_no") % LINES_PER_PAGE)).alias("y1"),
        F.when((F.col("line_no") == 0) & (n < 40), 15.0).otherwise(10.5).alias("size"),
    )


LAYOUT_SQL = """
layout AS (
  SELECT doc_id, CAST(line_no // 4 AS INT) AS page_no, line_no, text,
         55.0 + 9.0 * (length(text) % 3) AS x0, 40.0 + 250.0 * (line_no % 4) AS y0,
         55.0 + 9.0 * (length(text) % 3) + 5.0 * least(length(text), 90) AS x1, 52.0 + 250.0 * (line_no % 4) AS y1,
         CASE WHEN line_no = 0 AND length(text) < 40 THEN 15.0 ELSE 10.5 END AS size
  FROM (SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS INT) AS line_no, unnest(parts) AS text
        FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)))
"""
LINES_SQL = """
lines AS (
  SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS INT) AS line_no, unnest(parts) AS text
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))
"""
