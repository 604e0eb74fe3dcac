"""Language identification by fusing evidence, the Bayesian way.

For each record and language l:
  log P(text | l)       byte trigrams in 2**16 hash bins, tempered: the mean over the text's trigrams
                        counts as at most `text_weight` independent ones
  log P(declared | l)   how texts of l declare themselves (html lang), from grouped soft counts
  log P(l | host)       the host's prior, smoothed towards that of its address suffix, that
                        towards the whole corpus; a record's own count is left out
Soft counts are the posteriors from text alone, summed by host, suffix and declared
language; they cover all records. Only the trigram table is fitted on a bounded
sample: `max_train_rows` labelled documents with the least hashes of their ids.

The hosts' priors are joined as a table, by hash of host, one row a host; a hot host is split by
the adaptive skew join. The languages, some dozens at most, are known to the driver.

Cases: a null text is empty and gives no text evidence: the priors decide. A missing or unknown
declaration and a missing address count as values of their own. Null labels are left out; with no
labels at all the language is null and its probability 0. Ids may be null or repeat: records are
told one by one. An empty table gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.llm.common import _LOWER, _SPACE, cut, text_of

BINS = 1 << 16
DECLARED = r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})"
HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"
#: What isn't a page's visible text, then any tag.
HIDDEN = r"(?is)<!--.*?-->|<(script|style|head)\b.*?</\1\s*>|<[a-z/!][^>]*>"

_fold = _LOWER.copy()
_fold[_SPACE] = 32
_fold[33:65] = 32  # digits and most punctuation part words only
_fold[91:97] = 32


def trigram_bins(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all trigrams of the texts, one text after another, and how many each has."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    data = _fold[np.frombuffer(b" ".join([b"", *texts, b"", b""]), np.uint8)].astype(np.uint32)
    code = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    bins = ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)
    # a text of n bytes stands between two spaces: n trigrams
    at = np.concatenate([[0], np.cumsum(size + 1)[:-1]]).astype(np.int64)
    keep = np.ones(len(bins), bool)
    keep[at[1:] - 1] = False
    return bins[keep][: int(size.sum())], size


def text_evidence(texts: list[bytes], table: np.ndarray, weight: float) -> np.ndarray:
    """Tempered log likelihoods, texts x languages."""
    bins, size = trigram_bins(texts)
    out = np.zeros((len(texts), table.shape[1]))
    filled = np.flatnonzero(size)
    if len(filled):
        starts = np.concatenate([[0], np.cumsum(size[filled])[:-1]]).astype(np.int64)
        for k in range(table.shape[1]):
            out[filled, k] = np.add.reduceat(table[bins, k].astype(np.float64), starts) / size[filled] * np.minimum(size[filled], weight)
    return out


def train(labelled: DataFrame, *, id_col: str, text_col: str, lang_col: str, max_train_rows: int) -> tuple[list[str], np.ndarray]:
    """Languages and trigram table from a bounded sample of labelled rows."""
    rows = labelled.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("lang is not null and id is not null")
    few = rows.select("id", F.xxhash64("id").alias("h")).distinct().orderBy("h", "id").limit(max_train_rows).select(F.col("id").alias("k"))
    counts = rows.join(F.broadcast(few), F.col("id") == F.col("k")).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for b in batches:
            for lang, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                bins, _ = trigram_bins([t.as_py().encode("utf-8", "replace")])
                total[lang] = total.get(lang, 0) + np.bincount(bins, minlength=BINS)
        for lang, c in total.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(c[at])], names=["lang", "bin", "n"])

    got = counts.mapInArrow(run, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toArrow()  # at most BINS rows a language
    names = sorted(set(got["lang"].to_pylist()))
    table = np.full((BINS, len(names)), 0.5)
    where = {n: k for k, n in enumerate(names)}
    np.add.at(table, (got["bin"].to_numpy(), [where[x] for x in got["lang"].to_pylist()]), got["n"].to_numpy())
    return names, np.log(table / table.sum(0)).astype(np.float32) if names else table.astype(np.float32)


def page_records(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, text, declared, host, suffix of web pages."""
    html = text_of(html_col)
    host = F.lower(F.nullif(F.regexp_extract(F.col(url_col), HOST, 1), F.lit("")))
    return pages.select(
        F.col(id_col).alias("id"), F.regexp_replace(html, HIDDEN, " ").alias("text"),
        F.nullif(F.lower(F.regexp_extract(html, DECLARED, 1)), F.lit("")).alias("declared"), host.alias("host"), F.substring_index(host, ".", -1).alias("suffix"),
    )


def _softmax(parts: list[Column]) -> list[Column]:
    top = F.greatest(*parts) if len(parts) > 1 else parts[0]
    e = [F.exp(p - top) for p in parts]
    total = sum(e[1:], e[0])
    return [x / total for x in e]


def identify(records: DataFrame, names: list[str], table: np.ndarray, *, text_weight: float = 40.0, host_strength: float = 5.0, suffix_strength: float = 20.0, declared_smooth: float = 1.0) -> DataFrame:
    """records (id, text, declared, host, suffix, and any others) -> id, lang, prob, text_lang,
    declared, host, suffix and the others."""
    others = [c for c in records.columns if c not in ("id", "text", "declared", "host", "suffix")]
    if not names:
        none = F.lit(None).cast("string")
        return records.select("id", none.alias("lang"), F.lit(0.0).alias("prob"), none.alias("text_lang"), "declared", "host", "suffix", *others)
    shared = records.sparkSession.sparkContext.broadcast(table)  # BINS x languages
    L = range(len(names))

    @F.pandas_udf("array<double>")
    def evidence(text):
        import pandas as pd

        out: list = []
        part, size = [], 0
        for t in [*text, None]:
            if t is not None:
                part.append(t.encode("utf-8", "replace"))
                size += len(part[-1])
            if part and (t is None or size > 1 << 20):
                out += text_evidence(part, shared.value, text_weight).tolist()
                part, size = [], 0
        return pd.Series(out)

    e = [F.get("ll", F.lit(k)) for k in L]
    rows = records.withColumn("ll", evidence("text")).drop("text")
    rows = rows.withColumns({f"p{k}": c for k, c in enumerate(_softmax(e))})
    known = F.when(F.col("declared").isin(names), F.col("declared")).otherwise(F.when(F.col("declared").isNull(), F.lit("-")).otherwise(F.lit("?")))
    rows = cut(rows.withColumn("says", known))

    sums = [F.sum(f"p{k}").alias(f"s{k}") for k in L]
    host = rows.groupBy("host", "suffix").agg(*sums, F.count(F.lit(1)).alias("n"))
    suffix = host.groupBy("suffix").agg(*[F.sum(f"s{k}").alias(f"x{k}") for k in L], F.sum("n").alias("xn")).withColumnRenamed("suffix", "xs")
    whole = suffix.agg(*[F.sum(f"x{k}") for k in L], F.sum("xn")).first()
    total = float(whole[len(names)] or 0)
    base = [((whole[k] or 0.0) + 1.0) / (total + len(names)) for k in L]
    parent = [(F.col(f"x{k}") + suffix_strength * base[k]) / (F.col("xn") + suffix_strength) for k in L]
    prior = host.join(suffix, F.col("suffix").eqNullSafe(F.col("xs"))).select(F.col("host").alias("h"), F.col("suffix").alias("hs"), "n", *[f"s{k}" for k in L], *[c.alias(f"u{k}") for k, c in enumerate(parent)])
    # at most a row a language and two more
    said = {r["says"]: [r[f"d{k}"] for k in L] for r in rows.groupBy("says").agg(*[F.sum(f"p{k}").alias(f"d{k}") for k in L]).collect()}
    values = sorted(said) or ["-"]
    mass = [sum(v[k] for v in said.values()) for k in L]
    likely = {v: [float(np.log((said[v][k] + declared_smooth * (10 if v == names[k] else 1)) / (mass[k] + declared_smooth * (len(values) + 9)))) for k in L] for v in said}

    joined = rows.join(prior, F.col("host").eqNullSafe(F.col("h")) & F.col("suffix").eqNullSafe(F.col("hs")))
    own = [F.log((F.greatest(F.col(f"s{k}") - F.col(f"p{k}"), F.lit(0.0)) + host_strength * F.col(f"u{k}")) / (F.col("n") - 1 + host_strength)) for k in L]
    told = []
    for k in L:
        c = F.lit(0.0)
        for v in said:
            c = F.when(F.col("says") == v, F.lit(likely[v][k])).otherwise(c)
        told.append(c)
    joined = joined.withColumns({f"f{k}": F.get("ll", F.lit(k)) + told[k] + own[k] for k in L})
    post = _softmax([F.col(f"f{k}") for k in L])
    best = F.array_max(F.array(*[F.struct(p.alias("p"), F.lit(-k).alias("k"), F.lit(n).alias("lang")) for (k, n), p in zip(enumerate(names), post, strict=True)]))
    alone = F.array_max(F.array(*[F.struct(F.col(f"p{k}").alias("p"), F.lit(-k).alias("k"), F.lit(n).alias("lang")) for k, n in enumerate(names)]))
    return joined.select("id", best.alias("b"), alone.alias("a"), "declared", "host", "suffix", *others).select(
        "id", F.col("b.lang").alias("lang"), F.col("b.p").alias("prob"), F.col("a.lang").alias("text_lang"), "declared", "host", "suffix", *others
    )


def op7_langid(spark: SparkSession, sf_dir: str, max_train_rows: int = 4000) -> DataFrame:
    """Every row of pages (page_id set) and of documents (doc_id set; a document's host is its source)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    known = docs.where(~(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2))
    names, table = train(known, id_col="doc_id", text_col="text", lang_col="lang", max_train_rows=max_train_rows)
    pages = page_records(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")).withColumn("kind", F.lit("page"))
    none = F.lit(None).cast("string")
    texts = docs.select(F.col("doc_id").alias("id"), text_of("text").alias("text"), none.alias("declared"), F.col("source").alias("host"), F.lit("(source)").alias("suffix"), F.lit("document").alias("kind"))
    out = identify(pages.unionByName(texts), names, table)
    document = F.col("kind") == "document"
    return out.select(
        F.when(document, F.col("id")).alias("doc_id"), F.when(~document, F.col("id")).alias("page_id"), "lang", "prob", "text_lang", "declared", F.when(document, F.lit(None)).otherwise(F.col("host")).alias("host")
    )
