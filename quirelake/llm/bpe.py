"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

The rank file is read once on the driver and broadcast (its size is checked), so
executors need no copy of it. A text longer than `split_chars` is cut before
encoding at safe boundaries: places where a visible character is followed by a
space, tab or line feed. No match of the pre-token pattern spans such a place and
none looks past it, so the ids are those of the whole text. Ids are turned back
into raw bytes, never through a string, so bytes that aren't UTF-8 on their own
survive.

Cases: a null text is empty; an empty text has no ids, the hashes of the empty
byte string and 0 tokens. Ids may be null or repeat: each row is handled alone. Very
long texts are encoded whole, piece by piece. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.llm.common import text_of

MAX_RANK_BYTES = 64 << 20
_SAFE = re.compile(r"\S(?=[ \t\n])")
#: A run of white space so long that the library's regex would exhaust its stack.
_LONG_GAP = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")
_encodings: dict = {}


def split_safely(text: str, limit: int = 100_000) -> list[str]:
    """Parts of about limit characters whose encodings, one after another, are the whole's."""
    out, at = [], 0
    while len(text) - at > limit:
        m = _SAFE.search(text, at + limit)
        if not m:
            break
        out.append(text[at : m.end()])
        at = m.end()
    out.append(text[at:])
    return out


class Codec:
    """tiktoken with given ranks; encode and decode whole texts."""

    def __init__(self, rank_file: bytes, pattern: str):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_file.splitlines() if line)}
        self.enc = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.names = [str(i) for i in range(max(ranks.values()) + 1)]

    def encode(self, text: str, limit: int = 100_000) -> list[int]:
        if len(text) <= min(limit, 10_000):
            return self.enc.encode_ordinary(text)
        ids: list[int] = []
        at = 0
        for gap in _LONG_GAP.finditer(text):
            # the pattern takes such a run as one match, but leaves its last character to what follows
            end = gap.end() - (gap.end() < len(text))
            ids += self._encode_parts(text[at : gap.start()], limit)
            ids += self.enc._encode_single_piece(text[gap.start() : end])
            at = end
        return ids + self._encode_parts(text[at:], limit)

    def _encode_parts(self, text: str, limit: int) -> list[int]:
        ids: list[int] = []
        for part in split_safely(text, limit):
            ids += self.enc.encode_ordinary(part)
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return self.enc.decode_bytes(ids)


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        data = f.read(MAX_RANK_BYTES + 1)
    if len(data) > MAX_RANK_BYTES:
        raise ValueError(f"{path} has more than {MAX_RANK_BYTES} bytes")
    return data


def codec_of(shared, pattern: str) -> Codec:
    """The codec of a broadcast rank file; a Python worker keeps the last one, told by its content."""
    data = shared.value
    key = (hashlib.blake2b(data).digest(), pattern)
    if key not in _encodings:
        _encodings.clear()
        _encodings[key] = Codec(data, pattern)
    return _encodings[key]


def _share(spark: SparkSession, path: str | None, pattern: str | None):
    import public_tokenizers

    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return spark.sparkContext.broadcast(read_ranks(path)), pattern or public_tokenizers.PATTERN


def encode_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rank_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Id and ids (array<int>) of every row."""
    shared, pattern = _share(docs.sparkSession, rank_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared, pattern)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([codec.encode(t) for t in part.column(1).to_pylist()], pa.list_(pa.int32()))], names=["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode_documents(tokens: DataFrame, *, id_col: str = "doc_id", ids_col: str = "ids", rank_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Id and the raw bytes (binary) that each row's ids stand for."""
    shared, pattern = _share(tokens.sparkSession, rank_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([codec.decode(x or []) for x in b.column(1).to_pylist()], pa.binary())], names=["id", "bytes"])

    kind = tokens.schema[id_col].dataType.simpleString()
    return tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"id {kind}, bytes binary").withColumnRenamed("id", id_col)


def round_trip_digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rank_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Id, n_tokens, ids_sha256, decoded_sha256 of every row: encoded and decoded in one
    narrow pass, so that ids needn't be stored."""
    shared, pattern = _share(docs.sparkSession, rank_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared, pattern)
        names = codec.names
        for b in batches:
            n, a, d = [], [], []
            for t in b.column(1):
                ids = codec.encode(t.as_py())
                n.append(len(ids))
                a.append(hashlib.sha256(",".join([names[i] for i in ids]).encode()).hexdigest())
                d.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)


def encode_checked(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rank_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Id, n_tokens, ids and round_trip (the ids decode to the text's bytes) of every row."""
    shared, pattern = _share(docs.sparkSession, rank_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared, pattern)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = part.column(1).to_pylist()
                ids = [codec.encode(t) for t in texts]
                same = [codec.decode(x) == t.encode() for x, t in zip(ids, texts, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(same)], names=["id", "n_tokens", "ids", "round_trip"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_tokens long, ids array<int>, round_trip boolean")
    return out.withColumnRenamed("id", id_col)


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
