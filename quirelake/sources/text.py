"""Sources: text documents, page and block JSON lines, Markdown corpora, file folders.

A text document is a row (doc_id, text); pages are rows (doc_id, page_no, text); lines
are rows (doc_id, page_no, line_no, text) with line_no the place in reading order.

Cases: a null text is one empty page. Ids may be null or repeat: rows are cut one by one. Blank rows of JSON lines are skipped, unknown
keys are an error where strict. A folder without files of the kind gives no rows. Other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirelake.functions import patterns as P

PAGE_MARK = r"(?m)^<!--\s*page\s+([0-9]+)\s*-->\s*$"

LINE_FIELDS = "text STRING, size DOUBLE, bold BOOLEAN, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE, column INT, zone STRING, sup_numbers ARRAY<INT>"
PAGES_JSON = f"number INT, width DOUBLE, height DOUBLE, kind STRING, body_size DOUBLE, sidenotes ARRAY<STRUCT<text: STRING, y: DOUBLE>>, lines ARRAY<STRUCT<{LINE_FIELDS}>>"
BLOCKS_JSON = (
    "kind STRING, text STRING, level INT, page INT, cases ARRAY<STRUCT<id: STRING, label: STRING, standard: BOOLEAN>>, mnemonics ARRAY<STRING>, "
    "meta STRUCT<exam_years: ARRAY<INT>, sidenote: STRING, outline: ARRAY<STRING>, bonus_topic: STRING>"
)


def split_lines(text: Column, *, feeds: bool = False) -> Column:
    """Lines of a text at any line break; a final break opens no empty line. feeds: at line feeds only, and what follows the last
    one is a line too, also if it is empty; a null text has none."""
    if feeds:
        return F.split(text, "\n", -1)
    body = F.regexp_replace(text, f"(?:{P.LINE_BREAK})\\z", "")
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(body, P.LINE_BREAK))


def text_pages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pages of plain texts: cut at <!-- page N --> marks, which give the numbers (text before the
    first mark goes), else at form feeds, numbered from 1."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    numbers = F.regexp_extract_all(t, F.lit(PAGE_MARK), F.lit(1))
    marked = F.zip_with(numbers, F.slice(F.split(t, PAGE_MARK), 2, F.greatest(F.size(numbers), F.lit(1))), lambda n, x: F.struct(n.cast("int").alias("page_no"), x.alias("text")))
    plain = F.transform(F.split(t, "\f"), lambda x, i: F.struct((i + 1).alias("page_no"), x.alias("text")))
    pages = F.when(F.size(numbers) > 0, marked).otherwise(plain)
    return docs.select(F.col(id_col).alias("doc_id"), F.explode(pages).alias("p")).select("doc_id", "p.page_no", "p.text")


def page_lines(pages: DataFrame, *, keep_empty: bool = True, feeds: bool = False) -> DataFrame:
    """Lines of pages, right-trimmed, numbered from 0 in each page. feeds: as in split_lines, and whole, spaces at their ends too."""
    out = pages.select("doc_id", "page_no", F.posexplode(split_lines(F.col("text"), feeds=feeds)).alias("line_no", "text"))
    out = out if feeds else out.withColumn("text", F.regexp_replace("text", r"(?U)\s+$", ""))
    return out if keep_empty else out.where(F.trim("text") != "")


def conversation_pages(turns: DataFrame) -> DataFrame:
    """Conversations as documents of several pages: a turn is a page."""
    return turns.select(F.col("conv_id").alias("doc_id"), F.col("turn").cast("int").alias("page_no"), "text")


def page_range(pages: DataFrame, spec: str | None) -> DataFrame:
    """Pages of a 1-based inclusive range such as '120-145', '7' or '10-'; the filter reaches the scan."""
    if not spec:
        return pages
    first, _, last = spec.partition("-")
    low = int(first) if first.strip() else 1
    keep = F.col("page_no") >= low
    if "-" not in spec:
        keep = F.col("page_no") == low
    elif last.strip():
        keep = keep & (F.col("page_no") <= int(last))
    return pages.where(keep)


def read_json_lines(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """JSON lines of a fixed schema. Blank rows are skipped; strict: an unknown key is an error."""
    if strict:
        known = {f.name for f in T._parse_datatype_string(schema).fields}
        keys = spark.read.text(path).where(F.trim("value") != "").select(F.explode(F.json_object_keys("value")).alias("k")).distinct().limit(1000)
        odd = sorted(r.k for r in keys.collect() if r.k not in known)
        if odd:
            raise ValueError(f"unknown keys in {path}: {', '.join(odd)}")
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, PAGES_JSON)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, BLOCKS_JSON)


def markdown_corpus(spark: SparkSession, root: str) -> DataFrame:
    """(path, name, text) of all *.md under root but README.md and what lies in a folder named _*."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").text(root, wholetext=True)
    files = files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))
    base = root.rstrip("/").split("/")[-1]
    inside = F.regexp_extract("path", f".*?/{P.literal(base)}/(.*)$", 1)
    return files.where((F.col("name") != "README.md") & ~inside.rlike("(^|/)_[^/]*/"))


def binary_documents(spark: SparkSession, folder: str, *, recursive: bool = True, glob: str = "*.pdf") -> DataFrame:
    """(path, name, length, content) of the files of a folder; equal name and length count once."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", glob).load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "content").dropDuplicates(["name", "length"])


def sampled_pages(n: Column, k: int) -> Column:
    """0-based page numbers to look at: all if there are k at most, else k spread evenly over 5 % to 95 %."""
    lo, hi = F.floor(n * 0.05), F.floor(n * 0.95)
    step = F.greatest(F.lit(1), F.floor((hi - lo) / k))
    spread = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: F.least(n - 1, lo + j * step).cast("int"))
    return F.when(n <= 0, F.array().cast("array<int>")).when(n <= k, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(spread)
