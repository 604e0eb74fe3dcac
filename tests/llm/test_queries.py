"""The registered queries over whole tables: their columns and rows, and how right they are where labels tell."""

import hashlib

import pytest
from pyspark.sql import functions as F

from quirelake.llm import registry

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op2_quality": {"doc_id", "held_out", "score", "predicted"},
    "op3_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op4_fingerprint": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    "op5_html": {"page_id", "url", "text", "n_chars"},
    "op6_token_counts": {"doc_id", "n_tokens", "edited_tokens", "reencoded", "edited_sha256"},
    "op7_langid": set(),
    "op8_exact_dedup": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op9_ngram_jaccard": {"doc_id", "class_id", "class_size", "n_links"},
    "op10_suffix_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = registry.QUERIES[name](spark, SF)
    assert COLUMNS[name] <= set(got.columns)
    rows = got.collect()
    if name == "op5_html":
        assert sorted(r.page_id for r in rows) == sorted(r.page_id for r in spark.read.parquet(f"{SF}/pages.parquet").collect())
    elif name != "op7_langid":
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    if name == "op1_mixing":
        assert all(r.taken <= 2 * r["size"] and r["size"] == len(texts[r.doc_id].encode().split()) for r in rows)
    if name == "op3_bpe":
        assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in rows)
    if name == "op10_suffix_dedup":
        assert all(r.n_bytes == len(texts[r.doc_id].encode()) and 0 <= r.n_removed <= r.n_bytes for r in rows)


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality is not null")
    rows = registry.QUERIES["op2_quality"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows)
    good = [r for r in rows if r.quality == 1]
    assert sum(r.predicted for r in good) >= 0.97 * len(good)


def test_languages_of_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    got = registry.QUERIES["op7_langid"](spark, sf).collect()
    want = {("d", r.doc_id): r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    html = F.regexp_extract("html", '<html lang="([a-z]+)"', 1)
    want |= {("p", r.page_id): r.want for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", html.alias("want")).collect()}
    found = {("d", r.doc_id) if r.doc_id is not None else ("p", r.page_id): r for r in got}
    assert set(found) == set(want) and sum(found[k].lang == v for k, v in want.items()) >= 0.99 * len(want)
    # texts alone, of documents that the classifier didn't learn from
    held_out = spark.read.parquet(f"{sf}/documents.parquet").where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2).collect()
    assert sum(found["d", r.doc_id].text_lang == r.lang for r in held_out) >= 0.95 * len(held_out) > 100
