"""A corpus pipeline of the training-data operators, counted as part of quirelake.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and reread as the next stage's docs. All stages but the last return the
columns of documents; the last returns a row a training position, encoded.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.llm import bpe, exact_dedup, mixing, ngram_join, quality
from quirelake.llm.common import shared_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.7 at least.

    Null and empty texts are scored as well, ids may be null or repeat, long texts are read whole; each row is decided on its own,
    so that repeated rows stay or go together. Labels of null ids or without a quality teach nothing; without labels of both kinds the
    score is their mean, 0.5 if there are none. An empty table stays empty. Columns beyond those of documents are dropped."""
    return quality.keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(*COLUMNS)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, A-Z lowered, the document with the largest id.

    A null text is empty, and empty texts are equal. A null id is less than any other; of rows equal in text and id one stays. An
    empty table stays empty. Columns beyond those of documents are dropped."""
    return exact_dedup.drop_duplicates(docs).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the least id.

    Texts without words are like no other and stay. Rows without an id stay, one for each text; of rows that share the least id of
    a class, one for each text. An empty table stays empty. Columns beyond those of documents are dropped."""
    return ngram_join.drop_near_duplicates(docs).select(*COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each copy of a document that the mix takes, in training order.

    Documents that the mix doesn't take go, so do those without words; one that it takes twice has two rows. A null source is a
    source of its own. Rows that are equal in id, source and text share their positions. An empty table stays empty. Columns
    beyond those of documents are dropped."""
    names, safe = docs.columns, [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*safe)
    at = {n: c for n, c in zip(names, safe, strict=True)}
    # ids may be null or repeat; JSON tells a null from an empty string
    key = F.sha2(F.to_json(F.struct(F.col(at["doc_id"]).alias("a"), F.col(at["source"]).alias("b"), F.sha2(at["text"], 256).alias("c"))), 256)
    rows = rows.withColumn("row_key", F.unhex(key))
    plan = mixing.plan_mix(rows, id_col="row_key", text_col=at["text"], source_col=at["source"]).dropDuplicates(["row_key"])
    order = plan.select(F.col("row_key").alias("k"), F.explode("positions").alias("position"))
    out = rows.join(order, F.col("row_key") == F.col("k")).repartitionByRange("position").sortWithinPartitions("position")
    return out.select(*[F.col(at[c]).alias(c) for c in COLUMNS])


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether the ids decode to its text.

    A null text is empty and has no ids. Rows are encoded one by one, whole, so that repeated rows are as good as any. An empty
    table stays empty."""
    return bpe.encode_checked(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_duplicates),
    ("ngram_jaccard_join", near_duplicates),
    ("source_mixing", source_mixing),
    ("bpe_encoding", bpe_encoding),
]
#: Trees, MinHash and BPE can't be expressed in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What a stage returns is written to the shared folder and read again; when the next stage is written,
    it is removed."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid4().hex}"
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = f"{folder}/{k}_{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if last:
                _remove(spark, last)
            last = path
    return docs
