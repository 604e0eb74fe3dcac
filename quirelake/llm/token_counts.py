"""Edit-aware token counts.

A text is cut into pre-tokens (matches of the tokenizer's pattern), each encoded on its own,
so the count of a text is the sum over its pre-tokens. A document keeps a segment tree over
leaves of `leaf` pre-tokens: node k holds the tokens, pre-tokens and characters of its subtree; a leaf
holds the lengths and counts of its pre-tokens. `build_trees` makes the trees as a binary column that is stored with the texts,
`apply_edits` changes stored trees: it encodes nothing but what the edits touch, and returns texts and trees for the next edits.

An edit (start, stop, replacement; in characters) finds its first leaf by descending the tree, matches
again from the last pre-token that can't depend on the edited characters, and stops where a match of the new
text begins where one of the old text began, past the edit: matching has no memory, so
from there on nothing changes. Only pre-tokens in between are encoded; their leaves are
replaced and the sums of the subtrees above them updated.

The context: whether a match ends at e depends on the text up to e + 1 (a contraction, or the last
character of white space, which is left to what follows), so pre-tokens that end 3 or more
characters before the edit stand.

Cases: a null text is empty: no pre-tokens, 0 tokens; an edit then inserts. Edits beyond the end
are cut at the end; an edit without effect re-encodes its context only. Ids may be null or
repeat: rows are handled one by one. A null tree is built from its text. Very long texts and pre-tokens are handled whole.
An empty table gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.llm.bpe import Codec, _share, codec_of
from quirelake.llm.common import text_of

LEAF, BACK = 64, 3


class Counter:
    """Token counts of pre-tokens, remembered up to a bound."""

    def __init__(self, codec: Codec, pattern: str, most: int = 200_000):
        self.codec, self.most, self.memo = codec, most, {}
        self.pattern = regex.compile(pattern)

    def count(self, piece: str) -> int:
        n = self.memo.get(piece)
        if n is None:
            if len(self.memo) >= self.most:
                self.memo.clear()
            n = len(self.codec.enc._encode_single_piece(piece))
            if len(piece) < 64:
                self.memo[piece] = n
        return n


class CountTree:
    """Segment tree over the pre-tokens of one text."""

    def __init__(self, text: str, counter: Counter, leaf: int = LEAF, stored: bytes | None = None):
        self.text, self.counter, self.leaf = text, counter, leaf
        if stored is None:
            pieces = counter.pattern.findall(text)
            lens, counts, sizes = list(map(len, pieces)), list(map(counter.count, pieces)), []
            self.encoded = len(pieces)  # pre-tokens encoded by the last operation
        else:
            self.leaf, *parts = _unpacked(stored)
            lens, counts, sizes = parts
            self.encoded = 0
        ends = list(accumulate(sizes)) if sizes else [*range(self.leaf, len(lens), self.leaf), len(lens)]
        starts = [0, *ends[:-1]]
        self.leaves = [lens[a:b] for a, b in zip(starts, ends, strict=True)]  # lengths of the pre-tokens of each leaf
        self.counts = [counts[a:b] for a, b in zip(starts, ends, strict=True)]
        self._build(list(map(self._sum, self.leaves, self.counts)))

    def packed(self) -> bytes:
        """The tree as bytes: its leaf size and, by leaf, lengths and counts of pre-tokens."""
        arrays = [list(chain.from_iterable(self.leaves)), list(chain.from_iterable(self.counts)), list(map(len, self.leaves))]
        head = np.array([self.leaf, len(arrays[0]), len(arrays[2])], "<u4")
        return head.tobytes() + zlib.compress(np.concatenate([np.array(x, "<u4") for x in arrays]).tobytes(), 1)

    @staticmethod
    def _sum(lens: list[int], counts: list[int]) -> tuple[int, int, int]:
        return sum(counts), len(lens), sum(lens)

    def _build(self, sums: list[tuple[int, int, int]]) -> None:
        self.width = 1 << max(0, len(sums) - 1).bit_length()
        self.tree = [(0, 0, 0)] * self.width + sums + [(0, 0, 0)] * (self.width - len(sums))
        for k in range(self.width - 1, 0, -1):
            self._pull(k)

    def _pull(self, k: int) -> None:
        a, b = self.tree[2 * k], self.tree[2 * k + 1]
        self.tree[k] = (a[0] + b[0], a[1] + b[1], a[2] + b[2])

    @property
    def tokens(self) -> int:
        return self.tree[1][0]

    @property
    def pieces(self) -> int:
        return self.tree[1][1]

    def locate(self, char: int) -> tuple[int, int]:
        """The leaf that holds a character, and the characters before it; the last leaf past the end."""
        k, before = 1, 0
        while k < self.width:
            left = self.tree[2 * k][2]
            k *= 2
            if char - before >= left and self.tree[k + 1][1]:
                before += left
                k += 1
        return k - self.width, before

    def edit(self, start: int, stop: int, new: str) -> int:
        """Replace text[start:stop] by new; returns the new number of tokens."""
        old_len = len(self.text)
        start = min(max(0, start), old_len)
        stop = min(max(start, stop), old_len)
        self.text = self.text[:start] + new + self.text[stop:]
        shift = len(self.text) - old_len
        # the last pre-token that ends BACK or more characters before the edit, and what precedes it, stand
        first, at = self.locate(max(0, start - BACK))
        kept = 0
        for n in self.leaves[first]:
            if at + n > start - BACK:
                break
            kept += 1
            at += n
        # old starts from the edit on, leaf by leaf
        leaf, place, pos = first, kept, at
        fresh: list[str] = []
        done = False
        for m in self.counter.pattern.finditer(self.text, at):
            begin = m.start() - shift
            while pos < begin or pos < stop:
                if leaf >= len(self.leaves):
                    break
                if place >= len(self.leaves[leaf]):
                    leaf, place = leaf + 1, 0
                    continue
                pos += self.leaves[leaf][place]
                place += 1
            if pos == begin >= stop and pos < old_len:
                done = True
                break
            fresh.append(m[0])
        last = len(self.leaves)
        if done:
            if leaf < len(self.leaves) and place >= len(self.leaves[leaf]):
                leaf, place = leaf + 1, 0
            last = leaf + 1
        rest = slice(place, None) if done else slice(0, 0)
        tail = min(leaf, len(self.leaves) - 1)
        lens = self.leaves[first][:kept] + list(map(len, fresh)) + self.leaves[tail][rest]
        counts = self.counts[first][:kept] + list(map(self.counter.count, fresh)) + self.counts[tail][rest]
        self.encoded = len(fresh)
        n = last - first
        if (n - 1) * self.leaf < len(lens) <= 2 * n * self.leaf or (n == 1 and lens and len(lens) <= 2 * self.leaf):
            # the same number of leaves holds them: only sums above change
            size = -(-len(lens) // n)
            for k in range(n):
                part = slice(k * size, (k + 1) * size)
                self.leaves[first + k], self.counts[first + k] = lens[part], counts[part]
                self.tree[self.width + first + k] = self._sum(lens[part], counts[part])
            for k in sorted({k for j in range(first, last) for k in self._above(self.width + j)}, reverse=True):
                self._pull(k)
        else:
            sums = [self.tree[self.width + k] for k in range(len(self.leaves))]
            parts = [slice(k, k + self.leaf) for k in range(0, len(lens), self.leaf)]
            self.leaves[first:last], self.counts[first:last] = [lens[p] for p in parts], [counts[p] for p in parts]
            sums[first:last] = [self._sum(lens[p], counts[p]) for p in parts]
            if not self.leaves:
                self.leaves, self.counts, sums = [[]], [[]], [(0, 0, 0)]
            self._build(sums)
        return self.tokens

    @staticmethod
    def _above(k: int) -> list[int]:
        out = []
        while k > 1:
            k //= 2
            out.append(k)
        return out


def _unpacked(data: bytes) -> tuple[int, list[int], list[int], list[int]]:
    leaf, pieces, leaves = np.frombuffer(data[:12], "<u4").tolist()
    x = np.frombuffer(zlib.decompress(data[12:]), "<u4").tolist()
    return leaf, x[:pieces], x[pieces : 2 * pieces], x[2 * pieces : 2 * pieces + leaves]


def build_trees(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), rank_path: str | None = None, pattern: str | None = None, leaf: int = LEAF) -> DataFrame:
    """id, text, tree, n_tokens of every row, and the columns named in carry."""
    shared, pattern = _share(docs.sparkSession, rank_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(codec_of(shared, pattern), pattern)
        for b in batches:
            trees = [CountTree(t.as_py(), counter, leaf) for t in b.column("text")]
            made = [pa.array([t.packed() for t in trees], pa.binary()), pa.array([t.tokens for t in trees], pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns, *made], names=[*b.schema.names, "tree", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), *carry)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{schema}, tree binary, n_tokens long").withColumnRenamed("id", id_col)


EDITED = "n_chars long, n_pretokens long, n_tokens long, edited_tokens long, edited_pretokens long, reencoded long"


def apply_edits(trees: DataFrame, *, id_col: str = "doc_id", edits_col: str, rank_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """id, text, tree after the edits of every row of trees (id, text, tree, edits: array of struct<start, stop, new>, applied in
    order, each to the text that the one before left), the counts before and after; reencoded: pre-tokens that the edits encoded."""
    shared, pattern = _share(trees.sparkSession, rank_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(codec_of(shared, pattern), pattern)
        names = ["id", "text", "tree", *(x.split()[0] for x in EDITED.split(", "))]
        kinds = [pa.string(), pa.binary(), *[pa.int64()] * 6]
        for b in batches:
            rows = []
            for t, stored, edits in zip(b.column(1), b.column(2), b.column(3).to_pylist(), strict=True):
                tree = CountTree(t.as_py(), counter, stored=stored.as_py())
                before, touched = (len(tree.text), tree.pieces, tree.tokens), 0
                for e in edits or ():
                    if e is not None:
                        tree.edit(e["start"] or 0, e["stop"] or 0, e["new"] or "")
                        touched += tree.encoded
                rows.append((tree.text, tree.packed(), *before, tree.tokens, tree.pieces, touched))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[k] for r in rows], kinds[k]) for k in range(8))], names=names)

    kind = trees.schema[id_col].dataType.simpleString()
    edits = F.transform(F.col(edits_col), lambda e: F.struct(e["start"].cast("int").alias("start"), e["stop"].cast("int").alias("stop"), e["new"].alias("new")))
    out = trees.select(F.col(id_col).alias("id"), text_of("text").alias("text"), "tree", edits.alias("edits")).mapInArrow(run, f"id {kind}, text string, tree binary, {EDITED}")
    return out.withColumnRenamed("id", id_col)


def count_edited(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", edits_col: str, **options) -> DataFrame:
    """Counts of every text before and after its edits. Trees are built where they are edited, in one worker."""
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.lit(None).cast("binary").alias("tree"), F.col(edits_col).alias("edits"))
    out = apply_edits(plain, id_col="id", edits_col="edits", **options)
    return out.select(F.col("id").alias(id_col), *(x.split()[0] for x in EDITED.split(", ")), F.sha2("text", 256).alias("edited_sha256"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with three edits: its first 40 characters put in at a third, a deletion of 25 characters at
    two thirds, and one word at the end."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    text, n = text_of("text"), F.char_length(text_of("text"))
    edits = F.array(
        F.struct(F.floor(n / 3).alias("start"), F.floor(n / 3).alias("stop"), F.substring(text, 1, 40).alias("new")),
        F.struct(F.floor(n * 2 / 3).alias("start"), (F.floor(n * 2 / 3) + 25).alias("stop"), F.lit("").alias("new")),
        F.struct((n + 40).cast("long").alias("start"), (n + 40).cast("long").alias("stop"), F.lit(" end").alias("new")),
    )
    return count_edited(docs.withColumn("edits", edits), edits_col="edits")
