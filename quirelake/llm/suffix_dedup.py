"""Suffix-array deduplication of repeated byte strings, by deep-shallow sorting.

A byte goes if it lies in a string of `length` bytes that also starts anywhere else.

Sorting all suffixes would shuffle many times the input, so suffixes are sorted at
anchors only. The anchor of a window of `length` bytes is the leftmost least of the
hashes of its `gram`-byte substrings; equal windows have equal anchors at equal
offsets, so every repeat shows as two anchors with the same gram whose common
extension, left and right, reaches `length` bytes. Nothing is lost by it.

1. Each text emits its anchors: hash of the gram, 96-bit hash of the context (at most
   length - gram bytes left, length bytes right), text key (128 bits of its SHA-256), offsets; texts that are
   equal in a batch emit once, with their number. Anchors are dealt by gram; those of grams that have more than
   1 in `hot_share` of the anchors of a sample are dealt by context too, which only spreads the work.
2. An anchor whose whole context is met twice is repeated as far as its context reaches.
3. Of each distinct context one place goes on, if its gram has another context too. The contexts are fetched from the texts and dealt by gram. Their suffixes (the right contexts) are sorted deep-shallow:
   multikey quicksort on 8-byte symbols to `shallow` bytes, then a blind trie for each
   group with a longer common prefix. Over the intervals of common prefixes the
   left extensions are compared, which gives the repeated window ranges of each anchor.
4. Ranges are joined to the texts, merged and cut out. The texts are shuffled once, for steps 3 and 4.

A gram with more than `group_limit` distinct contexts is not collected in a task:
its windows are hashed and counted by (gram, offset, hash) instead, an exact way too.

Cases: a null text is empty: nothing is removed, the hash is that of no bytes.
Texts under `length` bytes keep all. Ids may be null or repeat: rows are joined by their
text, and repeated rows are repeats of each other. An empty table gives an empty result.
Other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirelake.llm.common import ByteHash, cut, text_of


def anchor_offsets(hashes: np.ndarray, width: int) -> np.ndarray:
    """Leftmost argmin of every window of width values, distinct and sorted."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.int64)
    # minima of windows by doubling; ties go to the left as the offset is compared last
    low, at, span = hashes.copy(), np.arange(n), 1
    while span * 2 <= width:
        m = len(low) - span
        right = low[span:] < low[:m]
        at = np.where(right, at[span:], at[:m])
        low = np.where(right, low[span:], low[:m])
        span *= 2
    m, shift = n - width + 1, width - span
    right = low[shift : shift + m] < low[:m]
    at = np.where(right, at[shift : shift + m], at[:m])
    return np.unique(at)


def anchors(data: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, gram hashes and context hashes (two columns) of the anchors of a text."""
    n = len(data)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2), np.int64)
    start = np.arange(n - gram + 1)
    grams = ByteHash(np.frombuffer(data, np.uint8)).of(start, start + gram)
    at = anchor_offsets(grams, length - gram + 1)
    reach = length - gram
    digests = [hashlib.blake2b(data[max(0, p - reach) : p + length], digest_size=16, key=str(min(p, reach)).encode()).digest() for p in at.tolist()]
    context = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return at, grams[at].view(np.int64), context >> np.array([0, 32])


# -- deep-shallow sorting ------------------------------------------------------------


def common_prefix(a: bytes, b: bytes) -> int:
    m = min(len(a), len(b))
    x = int.from_bytes(a[:m], "big") ^ int.from_bytes(b[:m], "big")
    return m - (x.bit_length() + 7) // 8


def multikey_quicksort(items: list[bytes], rows: list[int], depth: int, shallow: int) -> list[list[int]]:
    """Groups of rows in ascending order; rows of one group agree up to `shallow` bytes.
    Three-way partitioning on symbols of 8 bytes; an ended string sorts before a longer one."""
    out: list[list[int]] = []
    todo = [(rows, depth)]
    while todo:
        part, d = todo.pop()
        if len(part) < 2 or d >= shallow:
            out.append(part)
            continue
        symbol = {i: (items[i][d : d + 8].ljust(8, b"\0"), min(len(items[i]) - d, 8)) for i in part}
        pivot = symbol[part[len(part) // 2]]
        less = [i for i in part if symbol[i] < pivot]
        more = [i for i in part if symbol[i] > pivot]
        same = [i for i in part if symbol[i] == pivot]
        if more:
            todo.append((more, d))
        # all ended within this symbol: equal, so nothing is left to sort
        todo.append((same, d + 8 if pivot[1] == 8 else shallow))
        if less:
            todo.append((less, d))
    return out


class BlindTrie:
    """Compacted trie that keeps branch depths and first bytes only. A string finds its
    place by one blind descent, one comparison and one climb."""

    def __init__(self, items: list[bytes], first: int):
        self.items = items
        self.root: list = [len(items[first]), {}, [first]]  # depth, children by byte, strings that end here

    def _byte(self, s: bytes, d: int) -> int:
        return s[d] if d < len(s) else -1

    def _any(self, node: list) -> int:
        while not node[2]:
            node = next(iter(node[1].values()))
        return node[2][0]

    def insert(self, row: int) -> None:
        s = self.items[row]
        path, node = [], self.root
        while node[0] < len(s) and node[1]:
            path.append(node)
            child = node[1].get(self._byte(s, node[0]))
            if child is None:
                break
            node = child
        else:
            path.append(node)
        shared = common_prefix(s, self.items[self._any(node)])
        # the highest node at least as deep as the common prefix
        for k, here in enumerate(path):
            if here[0] >= shared:
                break
        if here[0] > shared:
            twin = [here[0], here[1], here[2]]
            here[0], here[2] = shared, []
            here[1] = {self._byte(self.items[self._any(twin)], shared): twin}
        if here[0] == len(s):
            here[2].append(row)
        else:
            b = self._byte(s, here[0])
            if b in here[1]:  # only if the descent stopped early
                raise AssertionError("blind trie lost its way")
            here[1][b] = [len(s), {}, [row]]

    def order(self) -> list[int]:
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            out += node[2]
            todo += [node[1][b] for b in sorted(node[1], reverse=True)]
        return out


def deep_shallow_sort(items: list[bytes], depth: int = 0, shallow: int = 24) -> list[int]:
    """Rows of items in ascending order of their bytes; items agree up to `depth` bytes."""
    out: list[int] = []
    for group in multikey_quicksort(items, list(range(len(items))), depth, max(depth, shallow)):
        if len(group) > 1:
            trie = BlindTrie(items, group[0])
            for row in group[1:]:
                trie.insert(row)
            group = trie.order()
        out += group
    return out


def prefix_intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of the internal nodes of the tree of sorted strings, where
    lcp[k] is that of string k and k + 1."""
    stack: list[list[int]] = []
    for k, v in enumerate([*lcp, -1]):
        first = k
        while stack and stack[-1][0] > v:
            r, first = stack.pop()
            yield r, first, k
        if v >= 0 and (not stack or stack[-1][0] < v):
            stack.append([v, first])


def repeated_ranges(lefts: list[bytes], rights: list[bytes], length: int, gram: int) -> list[tuple[int, int]]:
    """For each of distinct contexts (bytes before an anchor reversed, bytes from it on): how
    many bytes before and after the anchor lie in windows that another context has too; (0, 0) for none."""
    n = len(rights)
    best = [(0, 0)] * n
    if n == 2:
        r, v = common_prefix(rights[0], rights[1]), common_prefix(lefts[0], lefts[1])
        return [(v, r)] * 2 if v + r >= length else best
    order = deep_shallow_sort(rights, min(gram, min(map(len, rights))), gram + 16)
    lcp = [common_prefix(rights[a], rights[b]) for a, b in zip(order, order[1:], strict=False)]
    lo, hi = np.zeros(n, np.int64), np.zeros(n, np.int64)
    rank = np.empty(n, np.int64)
    by_left = sorted(range(n), key=lefts.__getitem__)
    rank[by_left] = np.arange(n)
    between = np.array([common_prefix(lefts[a], lefts[b]) for a, b in zip(by_left, by_left[1:], strict=False)], np.int64)
    table = [between]  # for minima over ranges of the left order
    while 2 * (1 << (len(table) - 1)) <= len(between):
        half, prev = 1 << (len(table) - 1), table[-1]
        table.append(np.minimum(prev[:-half], prev[half:]))
    at = np.array(order)
    for r, first, last in prefix_intervals(lcp):
        if r < gram:
            continue
        rows = at[first : last + 1]
        rows = rows[np.argsort(rank[rows])]
        a, b = rank[rows[:-1]], rank[rows[1:]]
        level = np.frexp((b - a).astype(float))[1] - 1
        v = np.empty(len(a), np.int64)
        for k in np.unique(level):
            m = level == k
            v[m] = np.minimum(table[k][a[m]], table[k][b[m] - (1 << k)])
        v = np.maximum(np.append(v, 0), np.insert(v, 0, 0))
        hit = v + r >= length
        rows, v = rows[hit], v[hit]
        lo[rows] = np.maximum(lo[rows], v)
        hi[rows] = np.maximum(hi[rows], r)
    return list(zip(lo.tolist(), hi.tolist(), strict=True))


# -- Spark ---------------------------------------------------------------------------

ANCHOR = "k1 long, k2 long, pos array<int>, times int, gram long, c1 long, c2 int"
CONTEXT = "k1 long, k2 long, pos int, gram long, alone boolean, wide boolean, lft binary, rgt binary"
RANGE = "k1 long, k2 long, lo int, hi int"
TEXT = ["k1", "k2"]  # a text's key, 128 bits of its SHA-256


def _emit_anchors(length: int, gram: int):
    """A row for each distinct context of a text, with all its offsets: a text of one repeated word has few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, got, texts = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)), [], []
            times, seen = Counter(keys), set()
            for k, t in enumerate(b.column(2)):
                if keys[k] not in seen:
                    seen.add(keys[k])
                    got.append(anchors(t.as_py().encode("utf-8", "replace"), length, gram))
                    texts.append(np.full(len(got[-1][0]), k, np.int32))
            if not got:
                continue
            at, grams, ctx, text = np.concatenate([x[0] for x in got]), np.concatenate([x[1] for x in got]), np.concatenate([x[2] for x in got]), np.concatenate(texts)
            order = np.lexsort((ctx[:, 1], ctx[:, 0], grams, text))
            at, grams, ctx, text = at[order], grams[order], ctx[order], text[order]
            new = np.ones(len(at), bool)
            new[1:] = (text[1:] != text[:-1]) | (grams[1:] != grams[:-1]) | (ctx[1:] != ctx[:-1]).any(axis=1)
            first = np.flatnonzero(new)
            of = pa.array(text[first])
            count = pa.array([times[k] for k in keys], pa.int32()).take(of)
            pos = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)).astype(np.int32)), pa.array(at.astype(np.int32)))
            c1, c2 = pa.array(ctx[first, 0]), pa.array(ctx[first, 1].astype(np.int32))
            rows = pa.RecordBatch.from_arrays([b.column(0).take(of), b.column(1).take(of), pos, count, pa.array(grams[first]), c1, c2], names=["k1", "k2", "pos", "times", "gram", "c1", "c2"])
            for k in range(0, rows.num_rows, 50_000):
                yield rows.slice(k, 50_000)

    return run


def _emit_contexts(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, (t, wanted) in enumerate(zip(b.column("text"), b.column("wanted").to_pylist(), strict=True)):
                data = t.as_py().encode("utf-8", "replace")
                pos, of = [w["pos"] for w in wanted], pa.array([k] * len(wanted), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("k1").take(of), b.column("k2").take(of), pa.array(pos, pa.int32()), pa.array([w["gram"] for w in wanted], pa.int64()),
                        pa.array([w["alone"] for w in wanted], pa.bool_()), pa.array([w["wide"] for w in wanted], pa.bool_()),
                        pa.array([data[max(0, p - length + gram) : p][::-1] for p in pos], pa.binary()), pa.array([data[p : p + length] for p in pos], pa.binary()),
                    ],
                    names=["k1", "k2", "pos", "gram", "alone", "wide", "lft", "rgt"],
                )

    return run


def _ranges_of_groups(length: int, gram: int):
    """Reads contexts sorted by gram; yields the repeated ranges of those whose context is met once."""

    def flush(rows: list, out: list) -> None:
        for row, (v, r) in zip(rows, repeated_ranges([x[5] for x in rows], [x[6] for x in rows], length, gram), strict=True):
            if r and row[4]:
                out.append((row[0], row[1], row[2] - v, row[2] + r))

    def batch(out: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kinds[k]) for k in range(4)], names=["k1", "k2", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], []
        for b in batches:
            for row in zip(*(b.column(k).to_pylist() for k in ("k1", "k2", "pos", "gram", "alone", "lft", "rgt")), strict=True):
                if row[3] != key:
                    if len(rows) > 1:
                        flush(rows, out)
                    key, rows = row[3], []
                rows.append(row)
            if len(out) > 10_000:
                yield batch(out)
                out = []
        if len(rows) > 1:
            flush(rows, out)
        if out:
            yield batch(out)

    return run


def _window_hashes(length: int, gram: int):
    """For grams with too many contexts: a hash of each window that holds the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = []
            for v, r in zip(b.column("lft").to_pylist(), b.column("rgt").to_pylist(), strict=True):
                data = np.frombuffer(v[::-1] + r, np.uint8)
                start = np.arange(max(0, len(data) - length + 1))
                h = ByteHash(data).of(start, start + length).view(np.int64)
                # by bytes before the anchor, from len(v) down
                hashes.append([{"d": len(v) - int(s), "h": int(x)} for s, x in zip(start, h, strict=True) if s <= len(v)])
            kind = pa.list_(pa.struct([("d", pa.int32()), ("h", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in ("k1", "k2", "pos", "gram", "alone")), pa.array(hashes, kind)], names=["k1", "k2", "pos", "gram", "alone", "w"])

    return run


def _merge_and_cut(length: int):
    """Cuts ranges out of texts. Ranges are cut at a text's ends; what is shorter than length then is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, removed, spans, digest = [], [], [], []
            for t, ranges in zip(b.column(1), b.column(2).to_pylist(), strict=True):
                data = t.as_py().encode("utf-8", "replace")
                kept, end, n, m = hashlib.sha256(), 0, 0, 0
                for lo, hi in sorted((max(0, x["lo"]), min(len(data), x["hi"])) for x in ranges or ()):
                    if hi - lo < length:
                        continue
                    if lo > end or not m:
                        kept.update(data[end:lo])
                        m += 1
                        n += hi - lo
                        end = hi
                    elif hi > end:
                        n += hi - end
                        end = hi
                kept.update(data[end:])
                size.append(len(data))
                removed.append(n)
                spans.append(m)
                digest.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            )

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    keyed = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).withColumn("sha", F.sha2("text", 256))
    # never null, so that no join puts a filter of its own before the exchange
    half = lambda k: F.coalesce(F.conv(F.substring("sha", k, 16), 16, -10).cast("long"), F.lit(0))
    return keyed.withColumn("k1", half(1)).withColumn("k2", half(17)).drop("sha")


def _hot_grams(texts: DataFrame, emit, hot_share: int) -> list[int]:
    """Grams with more than 1 in hot_share of the anchors of a sample of texts: less than hot_share of them."""
    sample = texts.where(F.rand(3) < 1 / 64).mapInArrow(emit, ANCHOR).groupBy("gram").agg(F.sum(F.size("pos") * F.col("times")).alias("n"))
    total = sample.agg(F.sum("n")).first()[0] or 0
    return [r.gram for r in sample.where(F.col("n") > max(16, total / hot_share)).select("gram").collect()]


def repeated_spans(docs: DataFrame, *, text_col: str = "text", length: int = 200, gram: int = 64, group_limit: int = 100_000, hot_share: int = 1000) -> DataFrame:
    """k1, k2 (128 bits of the text's SHA-256), ranges: array of (lo, hi), which may overlap and reach beyond the text."""
    return _spans(_keyed(docs.select(text_col), text_col, text_col).drop("id"), length, gram, group_limit, hot_share)


def _spans(keyed: DataFrame, length: int, gram: int, group_limit: int, hot_share: int) -> DataFrame:
    texts, emit = keyed.where(F.octet_length("text") >= length).select(*TEXT, "text"), _emit_anchors(length, gram)
    hot = F.array(*[F.lit(g).cast("long") for g in _hot_grams(texts, emit, hot_share)]).cast("array<bigint>")
    is_hot = F.array_contains(hot, F.col("gram"))
    found = texts.mapInArrow(emit, ANCHOR).withColumn("salt", F.when(is_hot, F.pmod("c1", F.lit(1024))).otherwise(F.lit(-1))).repartition("gram", "salt")
    by_gram, by_ctx = Window.partitionBy("gram", "salt"), Window.partitionBy("gram", "salt", "c1", "c2")
    found = found.withColumn("same", F.sum(F.size("pos") * F.col("times")).over(by_ctx)).withColumn("rn", F.row_number().over(by_ctx.orderBy(*TEXT)))
    ctx = F.struct("c1", "c2")
    found = found.withColumn("mixed", (F.col("salt") >= 0) | (F.min(ctx).over(by_gram) != F.max(ctx).over(by_gram)))  # hot grams are taken to have several contexts
    # whole contexts met twice; of the others one place for each distinct context
    keep = found.where("same > 1 or mixed").select(*TEXT, "pos", "gram", (F.col("same") == 1).alias("alone"), (F.col("mixed") & (F.col("rn") == 1)).alias("asked"))
    keep = cut(keep.where("not alone or asked"))
    whole = keep.where("not alone").select(*TEXT, F.transform("pos", lambda p: F.struct((p - (length - gram)).alias("lo"), (p + length).alias("hi"))).alias("r"))

    # grams of several contexts one of which is met once are all that can bring something new
    width = keep.where("asked").groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.max("alone").alias("news")).where("news and n > 1")
    wide = (F.col("n") > group_limit).alias("wide")
    of, wide_grams = keep.where("asked"), width.select("gram", wide)
    # the width of hot grams, less than hot_share of them, is broadcast, so that their rows don't meet in a task
    asked = of.where(is_hot).join(F.broadcast(wide_grams.where(is_hot)), "gram").unionByName(of.where(~is_hot).join(wide_grams.where(~is_hot), "gram"))
    asked = asked.select(*TEXT, F.struct(F.get("pos", F.lit(0)).alias("pos"), "gram", "alone", "wide").alias("w"))
    asked = asked.groupBy(*TEXT).agg(F.collect_set("w").alias("wanted"))
    # all columns go on, unread ones too: with the columns of the join in remove_repeats Spark shuffles the texts once for both
    one = keyed.join(asked, TEXT).dropDuplicates(TEXT)
    contexts = one.mapInArrow(_emit_contexts(length, gram), CONTEXT)
    cold = contexts.where("not wide").repartition("gram").sortWithinPartitions("gram").mapInArrow(_ranges_of_groups(length, gram), RANGE)
    one_range = F.array(F.struct(F.col("lo").cast("int").alias("lo"), F.col("hi").cast("int").alias("hi"))).alias("r")
    ranges = whole.unionByName(cold.select(*TEXT, one_range))
    if width.where(F.col("n") > group_limit).limit(1).count():
        windows = contexts.where("wide").mapInArrow(_window_hashes(length, gram), "k1 long, k2 long, pos int, gram long, alone boolean, w array<struct<d int, h long>>")
        windows = windows.select(*TEXT, "pos", "gram", "alone", F.explode("w").alias("w"))
        often = windows.groupBy("gram", F.col("w.d").alias("d"), F.col("w.h").alias("h")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("gram").alias("g"), "d", "h")
        met = windows.where("alone").join(often, (F.col("gram") == F.col("g")) & (F.col("w.d") == F.col("d")) & (F.col("w.h") == F.col("h")))
        met = met.select(*TEXT, (F.col("pos") - F.col("d")).alias("lo"), (F.col("pos") - F.col("d") + length).alias("hi"))
        ranges = ranges.unionByName(met.select(*TEXT, one_range))
    return ranges.groupBy(*TEXT).agg(F.flatten(F.collect_set("r")).alias("ranges"))


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 200, gram: int = 64, group_limit: int = 100_000, hot_share: int = 1000) -> DataFrame:
    """Id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    keyed, kind = _keyed(docs, id_col, text_col), docs.schema[id_col].dataType.simpleString()
    joined = keyed.join(_spans(keyed, length, gram, group_limit, hot_share), TEXT, "left").select("id", "text", "ranges")
    return joined.mapInArrow(_merge_and_cut(length), f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string").withColumnRenamed("id", id_col)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
