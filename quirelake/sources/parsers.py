"""Parser registry: functions that turn documents into page tables, chosen by name or by a diagnosis.

PDF libraries are optional: a parser whose library is missing is listed as unavailable.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.sources import text as S

SPANS = (
    "doc_id string, page_no int, block_no int, line_no int, span_no int, text string, x0 double, y0 double, x1 double, y1 double, size double, bold boolean, italic boolean, mono boolean, link string, rgb int, origin_y double, "
    "width double, height double, error string"
)


@dataclass(frozen=True)
class Parser:
    name: str
    kind: str  # layout or markdown
    parse: Callable[..., DataFrame]
    needs: str | None = None
    blocked: str | None = None  # why it can't be used at all

    def available(self) -> tuple[bool, str]:
        if self.blocked:
            return False, self.blocked
        missing = self.needs is not None and importlib.util.find_spec(self.needs) is None
        return not missing, f"{self.needs} is not installed" if missing else ""


_registry: dict[str, Parser] = {}


def register(parser: Parser) -> Parser:
    _registry[parser.name] = parser
    return parser


def get_parser(name: str) -> Parser:
    if name not in _registry:
        raise KeyError(f"no parser {name!r}; there are {', '.join(sorted(_registry))}")
    return _registry[name]


def availability() -> dict[str, tuple[bool, str]]:
    return {n: p.available() for n, p in sorted(_registry.items())}


def pick_parser(order: list[str]) -> Parser:
    """The first of order that is available."""
    for name in order:
        if name in _registry and _registry[name].available()[0]:
            return _registry[name]
    raise LookupError(f"none of {', '.join(order)} is available")


def _pdf_spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pymupdf  # only where it is installed

    names = [c.split()[0] for c in SPANS.split(", ")]
    for pdf in batches:
        for path, data in zip(pdf["path"], pdf["content"], strict=True):
            rows = []
            try:
                with pymupdf.open(stream=bytes(data), filetype="pdf") as doc:
                    if doc.needs_pass:
                        raise ValueError("password")
                    for page in doc:
                        for b, block in enumerate(page.get_text("dict")["blocks"]):
                            for ln, line in enumerate(block.get("lines", [])):
                                for sp, s in enumerate(line["spans"]):
                                    font, flags = s.get("font", ""), s.get("flags", 0)
                                    rows.append((path, page.number, b, ln, sp, s["text"], *map(float, s["bbox"]), float(s["size"]), bool(flags & 16) or "Bold" in font, bool(flags & 2), bool(flags & 8), None, s.get("color", 0), float(s["origin"][1]), float(page.rect.width), float(page.rect.height), None))
            except Exception as e:  # a broken document is a row, not the end of the batch
                rows = [(path, *[None] * (len(names) - 2), "password" if str(e) == "password" else f"open: {e}")]
            yield pd.DataFrame(rows, columns=names)


PARTS = "path string, page_no int, kind string, seq int, x0 double, y0 double, x1 double, y1 double, text string, level int, data binary, error string"


def _pdf_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pymupdf

    names = [c.split()[0] for c in PARTS.split(", ")]

    def parts(doc) -> Iterator[tuple]:
        """page_no, kind, box, text, level, data"""
        for key, value in (doc.metadata or {}).items():
            if value:
                yield None, "metadata", (None,) * 4, f"{key}={value}", None, None
        for level, title, page, *_ in doc.get_toc():
            yield page - 1, "bookmark", (None,) * 4, title, level, None
        for page in doc:
            for link in page.get_links():
                if link.get("uri"):
                    yield page.number, "link", tuple(map(float, link["from"])), link["uri"], None, None
            for image in page.get_images(full=True):
                for box in page.get_image_rects(image[0]):
                    found = doc.extract_image(image[0])
                    yield page.number, "image", tuple(map(float, box)), found["ext"], None, found["image"]
            for drawing in page.get_drawings():
                for item in drawing["items"]:
                    box = (*item[1], *item[2]) if item[0] == "l" else tuple(item[1]) if item[0] == "re" else None
                    if box:
                        yield page.number, "rule", (min(box[0], box[2]), min(box[1], box[3]), max(box[0], box[2]), max(box[1], box[3])), None, None, None

    for pdf in batches:
        for path, data in zip(pdf["path"], pdf["content"], strict=True):
            rows = []
            try:
                with pymupdf.open(stream=bytes(data), filetype="pdf") as doc:
                    if doc.needs_pass:
                        raise ValueError("password")
                    for k, (page, kind, box, text, level, content) in enumerate(parts(doc)):
                        rows.append((path, page, kind, k, *box, text, level, content, None))
            except Exception as e:  # as for spans
                rows = [(path, *[None] * (len(names) - 2), "password" if str(e) == "password" else f"open: {e}")]
            yield pd.DataFrame(rows, columns=names)


def pdf_parts(files: DataFrame) -> DataFrame:
    """Metadata, bookmarks, links, images and drawn lines and boxes of PDF files (path, content), a row each."""
    return files.select("path", "content").mapInPandas(_pdf_parts, PARTS)


def part_tables(parts: DataFrame, thin: float = 3.0, least: float = 8.0) -> dict[str, DataFrame]:
    """The converter's tables of parts: links, images, toc, and rules, which are thin and long; boxes are four rules."""
    at = [F.col("path").alias("doc_id"), "page_no"]
    box = ["x0", "y0", "x1", "y1"]
    of = lambda kind: parts.where(F.col("kind") == kind)
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    rule = lambda orient, pos, lo, hi: F.struct(F.lit(orient).alias("orient"), F.col(pos).alias("pos"), F.col(lo).alias("lo"), F.col(hi).alias("hi"))
    flat = F.when(h <= thin, F.array(rule("h", "y0", "x0", "x1"))).when(w <= thin, F.array(rule("v", "x0", "y0", "y1")))
    drawn = flat.otherwise(F.array(rule("h", "y0", "x0", "x1"), rule("h", "y1", "x0", "x1"), rule("v", "x0", "y0", "y1"), rule("v", "x1", "y0", "y1")))
    return {
        "links": of("link").select(*at, F.col("seq").alias("link_no"), *box, F.col("text").alias("uri")),
        "images": of("image").select(*at, F.col("seq").alias("img_no"), *box, "data", F.col("text").alias("ext")),
        "toc": of("bookmark").select(*at, "seq", "level", F.col("text").alias("title")),
        "rules": of("rule").select(*at, F.explode(drawn).alias("r")).select("doc_id", "page_no", "r.*").where(F.col("hi") - F.col("lo") >= least),
    }


def pdf_spans(files: DataFrame) -> DataFrame:
    """Spans of PDF files (path, content); a document that can't be opened is one row with error set."""
    return files.select("path", "content").mapInPandas(_pdf_spans, SPANS)


def rule_pages(docs: DataFrame) -> DataFrame:
    """Pages of Markdown texts cut at lines that are --- or {n}-----."""
    parts = F.split("text", r"\n(?:---|\{[0-9]+\}-{3,})\n")
    return docs.select("doc_id", F.posexplode(parts).alias("p", "text")).select("doc_id", (F.col("p") + 1).alias("page_no"), "text")


def ocr_lines(boxes: DataFrame) -> DataFrame:
    """OCR boxes (doc_id, page_no, text, x, y) as lines: by rows of ten points, then left to right."""
    from pyspark.sql import Window

    w = Window.partitionBy("doc_id", "page_no").orderBy(F.bround(F.col("y") / 10), "x")
    return boxes.withColumn("line_no", F.row_number().over(w) - 1)


def element_pages(elements: DataFrame) -> DataFrame:
    """Pages of a network parser's answer (doc_id, page, seq, markdown): its elements by page, in order."""
    rows = elements.groupBy("doc_id", F.coalesce("page", F.lit(1)).cast("int").alias("page_no")).agg(F.sort_array(F.collect_list(F.struct("seq", "markdown"))).alias("e"))
    return rows.select("doc_id", "page_no", F.array_join("e.markdown", "\n").alias("text"))


register(Parser("textfile", "markdown", S.text_pages))
register(Parser("marker", "markdown", rule_pages, "marker"))
register(Parser("mineru", "markdown", rule_pages, "mineru"))
register(Parser("pymupdf", "layout", pdf_spans, "pymupdf"))
register(Parser("pymupdf4llm", "markdown", rule_pages, "pymupdf4llm"))
register(Parser("paddleocr", "markdown", ocr_lines, "paddleocr"))
register(Parser("upstage", "markdown", element_pages, blocked="it sends documents to a service; only its stored answers can be read"))
