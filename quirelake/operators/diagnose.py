"""Diagnosis of a corpus before conversion: one row a document, from samples of its pages.

Cases: null texts are pages without text. A null id is one document. Pages of equal number are ranked in any order. Documents without a
page in the sample have no row. Of terms met as often the first in order counts. Empty tables give no rows. Other columns aren't read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirelake.functions import patterns as P
from quirelake.functions.patterns import TEXTBOOK, Rules
from quirelake.sources.text import sampled_pages

PARSERS = {"text_single_column": ["pymupdf", "pymupdf4llm", "marker"], "text_two_column": ["pymupdf", "mineru", "marker"], "scanned": ["paddleocr", "upstage"]}
HANJA = r"[\x{4e00}-\x{9fff}]"


def page_sample(pages: DataFrame, k: int = 24) -> DataFrame:
    """Pages of an even sample of k of each document; pages are ranked by number."""
    ranked = pages.withColumn("__r", F.row_number().over(Window.partitionBy("doc_id").orderBy("page_no")) - 1).withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy("doc_id")))
    return ranked.where(F.array_contains(sampled_pages(F.col("__n"), k), F.col("__r").cast("int"))).drop("__r", "__n")


def entity_tallies(pages: DataFrame, rules: Rules = TEXTBOOK) -> DataFrame:
    """doc_id and counts over its pages."""
    n = lambda rx: F.sum(F.regexp_count("text", F.lit(rx)))
    return pages.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("pages"), F.sum(F.char_length("text")).alias("chars"), F.count_if(F.trim("text") != "").alias("text_pages"), n(rules.case_star).alias("stars"), n(rules.case_loose).alias("cases"),
        n(rules.mnemonic).alias("mnemonics"), n(r"\([0-9]{2}\)").alias("exam_years"), n(P.BONUS_MARK).alias("boxes"), n(HANJA).alias("hanja"), n(P.SIDE).alias("sidenotes"), n(P.SIDE_MERGED).alias("sidenotes_merged"),
        n(P.char_class([b for b in P.OPEN_BRACKETS]) + f"(?=[0-9]{{2,4}}(?:{rules.suffixes})[0-9])").alias("bad_brackets"),
        F.count_if(F.col("text").rlike(r"(?m)^\s*[A-Z]\s*-\s*[0-9]+\s*\.")).alias("problem_pages"),
    )


def top_terms(pages: DataFrame, pattern: str, k: int = 10, group: int = 0) -> DataFrame:
    """doc_id, term, n: the k most frequent matches of each document."""
    hits = pages.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(group))).alias("term")).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("doc_id").orderBy(F.desc("n"), "term")
    return hits.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).drop("rn")


def page_layout(lines: DataFrame, rules: DataFrame | None, width: float, height: float, bottom: float = 0.42, ratio: float = 0.92) -> DataFrame:
    """doc_id, page_no, columns, lines, chars, note_lines, note_rule of lines with boxes, size and body_size."""
    mid, band = width / 2, width * 0.06
    body = F.col("y0") > height * 0.1
    n = F.count_if(body)
    two = (n > 0) & (F.count_if(body & (F.col("x0") < mid - band) & (F.col("x1") > mid + band)) <= n * 0.08) & (F.count_if(body & (F.col("x1") <= mid + band)) >= n * 0.25) & (F.count_if(body & (F.col("x0") >= mid - band)) >= n * 0.25)
    limit = height * (1 - bottom)
    note = (F.col("y0") >= limit) & (F.col("size") < F.col("body_size") * ratio)
    out = lines.groupBy("doc_id", "page_no").agg(F.when(two, 2).otherwise(1).alias("columns"), F.count(F.lit(1)).alias("lines"), F.sum(F.char_length("text")).alias("chars"), F.count_if(note).alias("note_lines"))
    if rules is None:
        return out.withColumn("note_rule", F.lit(False))
    ruled = rules.where((F.col("orient") == "h") & (F.col("pos") >= limit * 0.9) & (F.col("hi") - F.col("lo") > width * 0.2)).select("doc_id", "page_no").distinct().withColumn("note_rule", F.lit(True))
    return out.join(ruled, ["doc_id", "page_no"], "left").withColumn("note_rule", F.coalesce("note_rule", F.lit(False)))


def note_numbers(lines: DataFrame, height: float, k: int = 20, bottom: float = 0.42, ratio: float = 0.92) -> DataFrame:
    """doc_id, numbers: the least k distinct leading numbers of small low lines."""
    small = lines.where((F.col("y0") >= height * (1 - bottom)) & (F.col("size") < F.col("body_size") * ratio))
    got = small.select("doc_id", F.regexp_extract(F.trim("text"), r"^([0-9]{1,4})\b", 1).alias("n")).where("n <> ''").select("doc_id", F.col("n").cast("int").alias("n")).distinct()
    ranked = got.withColumn("rn", F.row_number().over(Window.partitionBy("doc_id").orderBy("n"))).where(F.col("rn") <= k)
    return ranked.groupBy("doc_id").agg(F.sort_array(F.collect_list("n")).alias("numbers"))


def diagnose(pages: DataFrame, columns: DataFrame | None = None, rules: Rules = TEXTBOOK, sample: int = 24) -> DataFrame:
    """doc_id, tallies of the sample, layer, parser_key, parser_order and profile_hint. columns: doc_id, columns."""
    out = entity_tallies(page_sample(pages, sample), rules)
    out = out.join(columns, "doc_id", "left").withColumn("columns", F.coalesce("columns", F.lit(1))) if columns is not None else out.withColumn("columns", F.lit(1))
    scanned = (F.col("text_pages") == 0) | (F.col("chars") / F.col("pages") < 40)
    key = F.when(scanned, "scanned").when(F.col("columns") >= 2, "text_two_column").otherwise("text_single_column")
    order = F.create_map(*[x for k, v in PARSERS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    hint = F.when(F.col("problem_pages") >= 2, "casebook").when(F.col("sidenotes") > 0, "textbook").when(F.col("doc_id").cast("string").rlike("사례|case"), "casebook").otherwise("textbook")
    return out.withColumn("parser_key", key).withColumn("parser_order", order[F.col("parser_key")]).withColumn("profile_hint", hint)


def stored(spark: SparkSession, path: str, docs: DataFrame) -> DataFrame | None:
    """The stored diagnosis at path joined to docs by doc_id, if it has all of them, else None."""
    try:
        known = spark.read.parquet(path)
    except AnalysisException:
        return None
    ids = docs.select(F.col("doc_id").cast("string").alias("doc_id")).distinct()
    known = known.withColumn("doc_id", F.col("doc_id").cast("string"))
    return known.join(ids, "doc_id", "left_semi") if ids.join(known, "doc_id", "left_anti").limit(1).count() == 0 else None
