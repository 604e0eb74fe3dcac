"""The stages of the pipeline on a small table, each against what it should keep."""

import corpus_pipeline
from quirelake.llm import bpe, exact_dedup, quality


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, before, sf).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == corpus_pipeline.COLUMNS, name
        kept.append(docs)
    scored = {r.doc_id for r in quality.score_quality(spark.read.parquet(f"{sf}/documents.parquet"), labels).collect() if r.predicted}
    assert {r.doc_id for r in kept[0].collect()} == scored
    exact = {r.doc_id for r in exact_dedup.duplicate_groups(kept[0]).collect() if r.kept}
    assert {r.doc_id for r in kept[1].collect()} == exact
    near = [r.doc_id for r in kept[2].collect()]
    assert len(near) == len(set(near)) and set(near) <= exact
    mixed = [r.doc_id for r in kept[3].collect()]
    assert set(mixed) <= set(near) and max(map(mixed.count, mixed)) <= 2
    last = kept[4].collect()
    assert len(last) == len(mixed) and all(r.round_trip and r.n_tokens == len(r.ids) for r in last)


def test_run_equals_the_stages(spark):
    sf = "/root/testdata/sf0.001"
    got = corpus_pipeline.run(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    key = lambda r: (r.doc_id, r.n_tokens, r.ids)
    assert sorted(map(key, got.collect())) == sorted(map(key, docs.collect()))


def test_ranks_are_bounded(tmp_path, monkeypatch):
    import pytest

    monkeypatch.setattr(bpe, "MAX_RANK_BYTES", 10)
    (tmp_path / "r").write_bytes(b"x" * 11)
    with pytest.raises(ValueError):
        bpe.read_ranks(str(tmp_path / "r"))


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls in any column, repeated rows, empty texts, further columns with clashing names, an empty table."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, k string, maybe boolean, row_key long, position double"
    good = " ".join(f"word{i} tells{i * 7 % 13}" for i in range(60)) + "."
    rows = [(1, good, "en", "a", 5, "x", True, 1, 0.5), (1, good, "en", "a", 5, "x", True, 1, 0.5), (None, good, None, None, None, None, None, None, None), (2, None, "en", None, None, "x", True, 1, 0.5), (3, "", "en", "b", 0, "x", True, 1, 0.5), (4, good + " more", "en", "b", 9, "x", True, 1, 0.5)]
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0), (4, 1, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for part, name in ((rows, "rows"), ([], "none")):
        docs = spark.createDataFrame(part, schema)
        for k, (stage_name, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}{k}")
            docs = spark.read.parquet(f"{tmp_path}/{name}{k}")
            if k == 1 and part:
                assert sorted((r.text or "") for r in docs.collect()) == sorted({"", good, good + " more"}), stage_name
        if not part:
            assert docs.count() == 0


def test_codec_is_kept_by_content():
    import public_tokenizers

    class Shared:
        def __init__(self, value):
            self.value = value

    data = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    one = bpe.codec_of(Shared(data), public_tokenizers.PATTERN)
    assert bpe.codec_of(Shared(bytes(bytearray(data))), public_tokenizers.PATTERN) is one
    other = bpe.codec_of(Shared(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))), public_tokenizers.PATTERN)
    assert other is not one and len(bpe._encodings) == 1
