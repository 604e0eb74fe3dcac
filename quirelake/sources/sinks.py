"""Sinks: JSON lines, one file a row, ZIP bundles, reports.

Cases: files without a name aren't written, null contents are empty files; of equal names the last written stays. Reports of empty tables
have their headings only. Reports take the first rows in order, as many as they say.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quirelake.operators.render import zip_bundles


def write_json_lines(df: DataFrame, path: str) -> int:
    """Write df as JSON lines; returns how many rows, counted as they are written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return seen.get["n"]


def _writer(folder: str):
    """A file for each row, by the JVM-free file system of the library for Arrow: any store that its URIs name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = (fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), os.path.abspath(folder)))
        for b in batches:
            names = b.column("name").to_pylist()
            for name, data in zip(names, b.column("content").to_pylist(), strict=True):
                path = f"{root.rstrip('/')}/{name}"
                store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(path) as out:
                    out.write(data or b"")
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([len(x or b"") for x in b.column("content").to_pylist()], pa.int64())], names=["name", "size"])

    return run


def write_files(files: DataFrame, folder: str) -> int:
    """Write each row of files (name, content) as a file of that name under folder, which all executors reach; names may have
    folders of their own. A file written twice, by a task that is repeated, is the same. Returns how many."""
    rows = files.select("name", F.col("content").cast("binary").alias("content")).where("name is not null")
    return rows.mapInArrow(_writer(folder), "name string, size long").count()


def write_bundles(files: DataFrame, folder: str) -> None:
    """Write a ZIP for each bundle as rows (bundle, content)."""
    zip_bundles(files).write.mode("overwrite").parquet(folder)


def report(findings: DataFrame, verdict: DataFrame, most: int = 200) -> str:
    """A Markdown report of the first findings of a check."""
    v = verdict.first()
    rows = findings.orderBy("level", "check", "location", "message").limit(most).collect()
    head = [f"# {v.verdict}", "", f"{v.failed} failures, {v.warned} warnings", "", "| level | check | message | location |", "| --- | --- | --- | --- |"]
    return "\n".join(head + [f"| {r.level} | {r.check} | {r.message} | {r.location} |".replace("\n", " ") for r in rows]) + "\n"


def tally_text(tally: DataFrame, key: str, count: str = "n", most: int = 1000) -> str:
    """A tally as lines of count and key, the most frequent first."""
    return "".join(f"{r[count]:>6}  {r[key]}\n" for r in tally.orderBy(F.desc(count), key).limit(most).collect())


def download(files: DataFrame) -> DataFrame:
    """What a bundle is delivered as: 'zip' if it has assets beside its Markdown, else 'md'."""
    return files.groupBy("bundle").agg(F.when(F.count_if(~F.col("name").endswith(".md")) > 0, "zip").otherwise("md").alias("kind"), F.count(F.lit(1)).alias("files"))


def _share(part: int, whole: int) -> str:
    return f"{100.0 * part / whole:.1f}%" if whole else "-"


def palette_report(counts: DataFrame, samples: DataFrame, total_spans: int, most: int = 1000) -> str:
    """Markdown of one document's palette (hex, spans, chars) with samples (hex, page_no, text), a few by nature."""
    rows = counts.orderBy(F.desc("spans"), "hex").limit(most).collect()
    shown: dict[str, list] = {}
    for r in samples.orderBy("hex", "page_no").limit(10 * most).collect():
        shown.setdefault(r.hex, []).append(f"- p.{r.page_no} {r.text}")
    coloured = sum(r.spans for r in rows)
    lines = ["# Colours", "", f"- spans: {total_spans:,}", f"- coloured spans: {coloured:,} ({_share(coloured, total_spans)})", f"- colours after merging: {len(rows)}", ""]
    lines += [{0: "> There is no coloured text.", 1: "> One colour."}.get(len(rows), "> More than one colour: look at the samples before choosing how to merge them."), "", "| colour | spans | characters | share |", "|---|---:|---:|---:|"]
    lines += [f"| `{r.hex}` | {r.spans:,} | {r.chars:,} | {_share(r.spans, coloured)} |" for r in rows]
    for r in rows:
        lines += ["", f"### `{r.hex}`", "", *shown.get(r.hex, [])]
    return "\n".join(lines) + "\n"


def crosscheck_report(terms: DataFrame, pairs: DataFrame, label_a: str = "A", label_b: str = "B", most: int = 200) -> str:
    """Markdown of a comparison of two tallies: counts by side, pairs of near misses, then the first terms of each side."""
    sizes = {r.side: r.n for r in terms.groupBy("side").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pairs = pairs.count()
    both = sizes.get("both", 0)
    lines = ["# Terms of two sources", "", f"- {label_a}: {sizes.get('a', 0) + both} terms, {label_b}: {sizes.get('b', 0) + both} terms", f"- in both: {both}", f"- suspicious pairs: {n_pairs}", ""]
    if n_pairs:
        lines += ["## Suspicious pairs, none of them mended", "", f"| {label_a} | {label_b} | distance |", "|---|---|---:|", *(f"| `[{r.x}]` | `[{r.y}]` | {r.distance} |" for r in pairs.orderBy("distance", "x", "y").limit(most).collect()), ""]
    for side, title in (("both", "In both"), ("a", f"Only in {label_a}"), ("b", f"Only in {label_b}")):
        rows = terms.where(F.col("side") == side).orderBy("term").limit(most).collect()
        if rows:
            lines += [f"## {title}", "", *(f"- `[{r.term}]` {r.n_a or 0} / {r.n_b or 0}" for r in rows), ""]
    return "\n".join(lines)


def diagnosis_report(diagnosis: DataFrame, most: int = 1000) -> str:
    """Markdown of a diagnosis: a section a document, with what was counted and what it suggests."""
    lines = ["# Diagnosis", ""]
    for r in diagnosis.orderBy("doc_id").limit(most).collect():
        d = r.asDict(recursive=True)
        lines += [f"## {d.pop('doc_id')}", "", *(f"- {k}: {', '.join(map(str, v)) if isinstance(v, list) else v}" for k, v in d.items()), ""]
    return "\n".join(lines)


def index_text(names: list[str], title: str = "Reports") -> str:
    """A list of links to report files, by name."""
    return "\n".join([f"# {title}", "", *(f"- [{n}]({n})" for n in sorted(names))]) + "\n"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small text to any file system that Spark reaches."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
