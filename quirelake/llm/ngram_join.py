"""N-gram Jaccard self-join by MinHash banding.

1. Every whole text becomes the set of its 5-word shingles (64-bit hashes). Texts with
   equal sets are one class of copies; only one node for each distinct set goes on.
2. Banding: `band_shape` picks the fewest bands, with as many rows a band as the
   permutation budget allows, that find a pair at the threshold with the target
   recall. Nodes are shuffled on (band, hash of the band's rows).
3. Each bucket links its members to its least member (a star, never all pairs);
   the components of these stars are the candidate groups: two nodes that share
   any bucket are in the same group.
4. Verification on full sets: the sets of a group are dealt out in blocks of `block`
   nodes and `block_shingles` shingles (some 100 MB of bit sets for two), and every two blocks of a group meet in one task's memory, where
   intersections are counted on bit sets. No pair leaves the task: what comes out is the
   number of links of each node and a spanning forest of the links.
5. Components of the verified links are the classes. A class is named by its least id.

A hot bucket costs its number of members in the shuffle; a hot group of g different
texts is dealt over (g / block)^2 / 2 tasks. Its link counts are exact, so that is work in
the square of g, in parallel; it adds no rows but the sets in blocks.

Cases: a null text is empty. A text without words has no shingles: it has no links and is
a class of its own. A text of 1 to 4 words is one shingle. Rows that repeat are copies
of each other. A class is named by its least id that isn't null; when near-duplicates
are dropped, rows without an id stay, one for each text.
An empty table gives an empty result. Other columns aren't touched; `drop_near_duplicates`
returns exactly the columns that it was given.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirelake.llm.common import cut, mix64, shingle_set, text_of


def band_shape(threshold: float = 0.8, recall: float = 0.9995, permutations: int = 160) -> tuple[int, int]:
    """(bands, rows): most rows a band such that 1 - (1 - threshold**rows)**bands >= recall."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1) if threshold < 1 else (1, 1)
    for rows in range(1, 65):
        p = threshold**rows
        bands = 1 if p >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-p))
        if bands * rows <= permutations:
            best = (bands, rows)
    return best


def minhash_bands(shingles: np.ndarray, bands: int, rows: int, seed: int = 1) -> np.ndarray:
    """A 64-bit hash for each band."""
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    low = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    step = max(1, 200_000 // (bands * rows))
    for i in range(0, len(shingles), step):
        x = shingles[i : i + step, None] * a
        x += b
        x ^= x >> np.uint64(32)  # the high half, where multiplication mixes well, decides
        x *= np.uint64(0x9E3779B97F4A7C15)
        np.minimum(low, x.min(axis=0), out=low)
    acc = np.zeros(bands, np.uint64)
    for k in range(rows):
        acc = mix64(acc + low.reshape(bands, rows)[:, k])
    return acc.view(np.int64)


def _node(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=16).digest()


def _sketch(n: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, list | None] = {}
        for batch in batches:
            nodes, out, sizes = [], [], []
            for t in batch.column(1):
                s = shingle_set(t.as_py().encode("utf-8", "replace"), n)
                node = _node(s) if len(s) else None
                nodes.append(node)
                sizes.append(len(s))
                if node is not None and node not in memo:
                    if len(memo) > 2000:
                        memo.clear()
                    memo[node] = minhash_bands(s, bands, rows).tolist()
                out.append(memo[node] if node is not None else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(out, pa.list_(pa.int64()))], names=["id", "node", "size", "bands"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node reached) for all nodes of the edges u, v, by alternating
    large and small stars, until a round changes nothing. What is written each round has a row an edge."""
    now = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), "m")
        small = large.join(least, F.col("u") == F.col("n"))
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct()
        now = cut(small)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links a-b."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            root[p] = q
            out.append((x, y))
    return out


def verify_block(sets: list[np.ndarray], left: np.ndarray, copies: np.ndarray, threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links among sets with Jaccard of at least threshold: the number of linked copies of each,
    and a spanning forest. left: -1 pairs of all, else only pairs of a 0 and a 1."""
    n = len(sets)
    size = np.fromiter(map(len, sets), np.int64, n)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        hit = both >= threshold * (size.sum() - both) - 1e-9
        return (copies[::-1] * hit).astype(np.int64), [(0, 1)] if hit else []
    owner = np.repeat(np.arange(n), size)
    word, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = np.flatnonzero(times > 1)
    place = np.full(len(word), -1)
    place[often] = np.arange(len(often))
    keep = place[at] >= 0
    bit, row = place[at][keep], owner[keep]
    width = max(1, -(-len(often) // 64))
    bits = np.zeros(n * width, np.uint64)
    np.bitwise_or.at(bits, row * width + bit // 64, np.uint64(1) << (bit % 64).astype(np.uint64))
    bits = bits.reshape(n, width)
    links, pa_, pb = np.zeros(n, np.int64), [], []
    for i in range(n):
        other = np.arange(i + 1, n) if left[i] < 0 else np.flatnonzero(left == 1) if left[i] == 0 else np.zeros(0, np.int64)
        # sizes alone rule out most of the rest
        other = other[(np.minimum(size[other], size[i]) >= threshold * np.maximum(size[other], size[i]) - 1e-9)]
        if not len(other):
            continue
        mine = np.flatnonzero(bits[i])
        both = np.bitwise_count(bits[np.ix_(other, mine)] & bits[i, mine]).sum(1)
        hit = other[both >= threshold * (size[i] + size[other] - both) - 1e-9]
        links[i] += copies[hit].sum()
        links[hit] += copies[i]
        pa_ += [i] * len(hit)
        pb += hit.tolist()
    return links, _forest(n, np.array(pa_, np.int64), np.array(pb, np.int64))


VERIFIED = "node binary, links long, u binary, v binary"


def _verify(threshold: float):
    """Reads rows sorted by (grp, i, j); yields links of nodes (u null) and forest edges (node null)."""

    def flush(rows: list) -> pa.RecordBatch:
        nodes = [r[0] for r in rows]
        left = np.array([-1 if r[4] == r[5] else int(r[3] != r[4]) for r in rows])
        links, forest = verify_block([np.frombuffer(r[1], "<u8") for r in rows], left, np.array([r[2] for r in rows], np.int64), threshold)
        hit = np.flatnonzero(links)
        n, m = len(hit), len(forest)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([nodes[k] for k in hit] + [None] * m, pa.binary()),
                pa.array(links[hit].tolist() + [None] * m, pa.int64()),
                pa.array([None] * n + [nodes[a] for a, _ in forest], pa.binary()),
                pa.array([None] * n + [nodes[b] for _, b in forest], pa.binary()),
            ],
            names=["node", "links", "u", "v"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for b in batches:
            for g, i, j, node, data, copies, mine in zip(*(b.column(k).to_pylist() for k in ("grp", "i", "j", "node", "data", "copies", "blk")), strict=True):
                if (g, i, j) != key:
                    if len(rows) > 1:
                        yield flush(rows)
                    key, rows = (g, i, j), []
                rows.append((node, data, copies, mine, i, j))
        if len(rows) > 1:
            yield flush(rows)

    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                sets = [shingle_set(t.encode("utf-8", "replace"), n) for t in part.column("text").to_pylist()]
                good = [k for k, (s, node) in enumerate(zip(sets, part.column("node").to_pylist(), strict=True)) if len(s) and _node(s) == node]
                rest = part.select(["grp", "node", "copies", "blk", "blks"]).take(pa.array(good, pa.int32()))
                yield pa.RecordBatch.from_arrays([*rest.columns, pa.array([sets[k].astype("<u8").tobytes() for k in good], pa.binary())], names=["grp", "node", "copies", "blk", "blks", "data"])

    return run


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8, recall: float = 0.9995, permutations: int = 160, block: int = 1024, block_shingles: int = 500_000) -> DataFrame:
    """One row a row of docs: id, class_id (least id of its class), class_size, n_links (rows with
    a Jaccard similarity of threshold at least, copies included), n_copies (rows with the same set)."""
    bands, rows = band_shape(threshold, recall, permutations)
    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    sketch = cut(plain.mapInArrow(_sketch(n, bands, rows), f"id {kind}, node binary, size long, bands array<long>"))
    nodes = cut(sketch.where("node is not null").groupBy("node").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.first("bands").alias("bands")))

    # band and hash in one 64-bit key: a chance collision only adds a candidate
    banded = nodes.select("node", F.posexplode("bands").alias("band", "hash")).select("node", F.xxhash64("band", "hash").alias("bucket"))
    stars = banded.groupBy("bucket").agg(F.min("node").alias("v"), F.count(F.lit(1)).alias("m")).where("m > 1").select("bucket", "v")
    edges = banded.join(stars, "bucket").where("node <> v").select(F.col("node").alias("u"), "v")
    grouped = components(edges)
    named = grouped.join(nodes.select("node", "rep", "copies", "size"), "node")
    # a block has about so many nodes at most, and so many shingles, of which the bit sets of two blocks are made
    blks = F.ceil(F.greatest(F.count(F.lit(1)) / block, F.sum("size") / block_shingles)).cast("int")
    members = named.join(named.groupBy("root").agg(blks.alias("blks")), "root")
    members = cut(members.select("node", "rep", "copies", F.col("root").alias("grp"), F.pmod(F.xxhash64("node"), F.col("blks")).cast("int").alias("blk"), "blks"))

    # texts of one row of each node; rows that share its id but not its set fall out by the node's hash
    texts = plain.join(members.withColumnRenamed("rep", "id"), "id").mapInArrow(_sets(n), "grp binary, node binary, copies long, blk int, blks int, data binary").dropDuplicates(["node"])
    lost = _null_reps(plain, members, n)
    dealt = texts.unionByName(lost).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blks") - 1))).select(
        "grp", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"), "node", "data", "copies", "blk"
    )
    verified = cut(dealt.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j").mapInArrow(_verify(threshold), VERIFIED))
    links = verified.where("node is not null").groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(verified.where("u is not null").select("u", "v"))

    info = nodes.select("node", "rep", "copies").join(classes, "node", "left").join(links, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = info.groupBy("root").agg(F.min("rep").alias("class_id"), F.sum("copies").alias("class_size"))
    info = info.join(named, "root").select("node", "class_id", "class_size", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "copies")
    single = sketch.where("node is null").select("id", F.col("id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies"))
    out = sketch.where("node is not null").select("id", "node").join(info, "node").select("id", "class_id", "class_size", "n_links", F.col("copies").alias("n_copies"))
    return out.unionByName(single).withColumnRenamed("id", id_col)


def _null_reps(plain: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """Sets of the nodes that only rows without an id have."""
    none = members.where("rep is null").drop("rep")
    schema = "node binary, data binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [s for t in b.column(0).to_pylist() if len(s := shingle_set(t.encode("utf-8", "replace"), n))]
            yield pa.RecordBatch.from_arrays([pa.array(list(map(_node, sets)), pa.binary()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], names=["node", "data"])

    found = plain.where("id is null").select("text").mapInArrow(run, schema)
    return found.join(none, "node").dropDuplicates(["node"]).select("grp", "node", "copies", "blk", "blks", "data")


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs but one of each class only, the one with the least id; all their columns."""
    names, safe = docs.columns, [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*safe)
    id_c, text_c = safe[names.index(id_col)], safe[names.index(text_col)]
    found = cut(near_duplicates(rows, id_col=id_c, text_col=text_c, **options).select(F.col(id_c).alias("k"), "class_id", "class_size"))
    gone = found.where("class_size > 1 and k <> class_id and k is not null").select("k").distinct()
    left = rows.join(gone, F.col(id_c) == F.col("k"), "left_anti")
    # rows that share the least id of their class, or have none: one for each text
    odd = found.where("class_size > 1").groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or k is null").select("k")
    twin = left.join(odd, F.col(id_c).eqNullSafe(F.col("k"))).drop("k")
    order = Window.partitionBy(id_c, F.xxhash64(text_c)).orderBy(F.xxhash64(*safe))
    twin = twin.withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")
    return left.join(odd, F.col(id_c).eqNullSafe(F.col("k")), "left_anti").unionByName(twin).toDF(*names)


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
