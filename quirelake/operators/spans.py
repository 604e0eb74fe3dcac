"""Lines from coloured spans: margin notes apart, superscripts as references, colours and bold as marks.

Spans have doc_id, page_no, line_no, span_no, text, box, size, bold, rgb and origin_y (their baseline).

Cases: null and blank spans are left out, a null colour is the body's, documents without a body size have 10 points. Colours met
at one place are taken in order of their number. Empty tables give no rows. Other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirelake.functions.text import is_body_colour, rgb_parts, to_hex

LINE = ["doc_id", "page_no", "line_no"]
SIDE_NOTE = "^s[A-Z]-[0-9]{1,3}$"
SUPERSCRIPT = "^[0-9]{1,4}$"


def palette(spans: DataFrame, distance: float = 60.0) -> DataFrame:
    """doc_id, rgb, hex: the representative of each colour that isn't the body's. Colours in order of first use join the
    first representative within distance, else found one. The fold is over a document's distinct colours."""
    rows = spans.where(F.trim("text") != "").where(~is_body_colour(F.col("rgb")))
    first = rows.groupBy("doc_id", "rgb").agg(F.min(F.struct("page_no", "line_no", "span_no")).alias("at"))
    listed = first.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "rgb"))), lambda x: x["rgb"]).alias("colours"))

    def near(a: Column, b: Column) -> Column:
        return F.sqrt(F.aggregate(F.zip_with(rgb_parts(a), rgb_parts(b), lambda x, y: ((x - y) * (x - y)).cast("double")), F.lit(0.0), lambda s, v: s + v)) <= distance

    def step(a: Column, c: Column) -> Column:
        hit = F.get(F.filter(a["reps"], lambda r: near(r, c)), F.lit(0))
        return F.struct(F.when(hit.isNull(), F.concat(a["reps"], F.array(c))).otherwise(a["reps"]).alias("reps"), F.concat(a["out"], F.array(F.struct(c.alias("rgb"), F.coalesce(hit, c).alias("rep")))).alias("out"))

    start = F.struct(F.array().cast("array<int>").alias("reps"), F.array().cast("array<struct<rgb: int, rep: int>>").alias("out"))
    folded = listed.select("doc_id", F.explode(F.aggregate("colours", start, step)["out"]).alias("o"))
    return folded.select("doc_id", "o.rgb", to_hex(F.col("o.rep")).alias("hex"))


def palette_counts(spans: DataFrame, distance: float = 60.0) -> DataFrame:
    """doc_id, hex, spans, chars by representative colour."""
    rows = spans.where(F.trim("text") != "").join(palette(spans, distance), ["doc_id", "rgb"])
    return rows.groupBy("doc_id", "hex").agg(F.count(F.lit(1)).alias("spans"), F.sum(F.char_length(F.trim("text"))).alias("chars"))


def palette_samples(spans: DataFrame, distance: float = 60.0, most: int = 5) -> DataFrame:
    """doc_id, hex, page_no, text of the first `most` spans of each representative colour."""
    rows = spans.where(F.trim("text") != "").join(palette(spans, distance), ["doc_id", "rgb"])
    w = Window.partitionBy("doc_id", "hex").orderBy("page_no", "line_no", "span_no")
    return rows.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= most).select("doc_id", "hex", "page_no", F.trim("text").alias("text"))


def margin_notes(spans: DataFrame, width: float, ratio: float = 0.78, pattern: str = SIDE_NOTE) -> tuple[DataFrame, DataFrame]:
    """(spans without margin notes, notes: doc_id, page_no, note_no, text, y)."""
    note = (F.col("x0") >= width * ratio) & F.trim("text").rlike(pattern)
    notes = spans.where(note).select("doc_id", "page_no", F.col("line_no").alias("note_no"), F.trim("text").alias("text"), F.bround("y0", 1).alias("y"))
    return spans.where(~note), notes


def marked_lines(spans: DataFrame, bodies: DataFrame, *, emphasis: bool = True, overrides: dict[str, str] | None = None, distance: float = 60.0, ratio: float = 0.82, rise: float = 0.12, superscript: str = SUPERSCRIPT) -> DataFrame:
    """doc_id, page_no, line_no, text, size, bold, box, sup_numbers. Spans of one mark are wrapped together, spaces at
    their ends outside the mark; small raised digits become references. overrides: a mark by colour."""
    rows = spans.where(F.trim("text") != "").join(bodies, "doc_id", "left").join(palette(spans, distance), ["doc_id", "rgb"], "left")
    body = F.coalesce("body_size", F.lit(10.0))
    base = F.max("origin_y").over(Window.partitionBy(*LINE))
    rows = rows.withColumn("sup", (F.col("size") < body * ratio) & (base - F.col("origin_y") > body * rise) & F.trim("text").rlike(superscript))
    mark = F.when(F.lit(not emphasis) | F.col("sup"), "")
    for colour, m in (overrides or {}).items():
        mark = mark.when(F.col("hex") == colour, m)
    mark = mark.when(F.col("hex").isNotNull(), "==").when(F.col("bold") & is_body_colour(F.col("rgb")), "**").otherwise("")
    rows = rows.withColumn("mark", mark).withColumn("piece", F.when(F.col("sup"), F.concat(F.lit("[^"), F.trim("text").cast("int").cast("string"), F.lit("]"))).otherwise(F.col("text")))
    w = Window.partitionBy(*LINE).orderBy("span_no")
    rows = rows.withColumn("__n", F.coalesce(F.col("mark") != F.lag("mark").over(w), F.lit(False)).cast("int")).withColumn("island", F.sum("__n").over(w))
    runs = rows.groupBy(*LINE, "island").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("span_no", "piece"))), lambda x: x["piece"]), "").alias("t"), F.first("mark").alias("mark"),
        F.max(F.when(~F.col("sup"), F.col("size"))).alias("size"), F.min(F.when(~F.col("sup"), F.col("bold"))).alias("bold"), F.count_if(~F.col("sup")).alias("plain"),
        F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.max(body).alias("body"),
        F.transform(F.sort_array(F.collect_list(F.when(F.col("sup"), F.struct("span_no", F.trim("text").cast("int").alias("n"))))), lambda x: x["n"]).alias("sups"),
    )
    core = F.trim("t")
    wrapped = F.when((F.col("mark") == "") | (core == ""), F.col("t")).otherwise(F.concat(F.regexp_extract("t", r"^(\s*)", 1), "mark", core, "mark", F.regexp_extract("t", r"(\s*)$", 1)))
    out = runs.withColumn("t", wrapped).groupBy(*LINE).agg(
        F.rtrim(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("island", "t"))), lambda x: x["t"]), "")).alias("text"), F.bround(F.coalesce(F.max("size"), F.max("body")), 2).alias("size"),
        F.coalesce(F.min("bold"), F.lit(False)).alias("bold"), *[F.bround(f(c), 1).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))],
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("island", "sups"))), lambda x: x["sups"])).alias("sup_numbers"),
    )
    return out.where(F.trim("text") != "")


def ordered_lines(lines: DataFrame, width: float, columns: int | None = None) -> DataFrame:
    """lines (with zone) with column and place: footnotes last; by column where the page has two (asked for, or
    eight body lines that look like it), then from top to bottom."""
    page = Window.partitionBy("doc_id", "page_no")
    mid, band = width / 2, width * 0.06
    in_body = F.col("zone") == "body"
    n = F.count_if(in_body).over(page)
    share = lambda c: F.count_if(in_body & c).over(page)
    looks = (n >= 8) & (share((F.col("x0") < mid - band) & (F.col("x1") > mid + band)) <= n * 0.08) & (share(F.col("x1") <= mid + band) >= n * 0.25) & (share(F.col("x0") >= mid - band) >= n * 0.25)
    two = F.lit(columns == 2) if columns else looks
    rows = lines.withColumn("column", F.when(two & in_body & ((F.col("x0") + F.col("x1")) / 2 >= mid), 1).otherwise(0))
    w = page.orderBy(F.col("zone") == "footnote", "column", F.bround("y0", 1), "x0")
    return rows.withColumn("place", F.row_number().over(w) - 1)
