"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics (FEATURES) come from whole texts, computed for a batch of documents at
once on one byte array. The trees grow by histograms of at most 64 quantile bins a
statistic, on logistic loss, and are flattened into arrays (feature, threshold,
left, right, value), which numpy walks for all rows and trees level by level.

The model is fitted on a bounded sample of the labelled rows: `max_train_rows` (20,000
by default) with the smallest hashes of their id. Everything else covers all rows.
Labels, language, source and id are no input of a score.

Cases: a null text is empty and gets a score from the statistics of an empty text.
Labels without a quality or an id are left out; of several labels of an id the
largest counts. Without labels of both kinds the score is their mean, 0.5 if there
are none. Ids may be null or repeat: rows are scored one by one. Other columns
aren't read; `keep_quality` returns exactly the columns that it was given.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.llm.common import _SPACE, ByteHash, text_of, word_bounds

FEATURES = (
    "log_bytes", "log_words", "word_mean", "word_sd", "upper", "digit", "punct", "symbol", "non_ascii", "space", "line_mean", "log_lines",
    "words_unique", "top_word", "lines_unique", "pairs_unique", "fives_unique", "ends_stop", "ends_symbol", "capital_words", "upper_words", "entropy",
)
_CLASS = np.zeros(256, np.int64)  # 0 other, 1 upper, 2 lower, 3 digit, 4 punctuation, 5 symbol, 6 non-ASCII, 7 white space
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 6
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 4
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 5
_CLASS[_SPACE] = 7


def _share_distinct(group: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """By group: distinct keys over keys, and the largest key's share (1 and 0 for none)."""
    total = np.bincount(group, minlength=n)
    if not len(key):
        return np.ones(n), np.zeros(n)
    order = np.lexsort((key, group))
    g, k = group[order], key[order]
    new = np.ones(len(k), bool)
    new[1:] = (g[1:] != g[:-1]) | (k[1:] != k[:-1])
    first = np.flatnonzero(new)
    runs = np.diff(np.append(first, len(k)))
    most = np.zeros(n)
    np.maximum.at(most, g[first], runs)
    distinct = np.bincount(g[first], minlength=n)
    some = np.maximum(total, 1)
    return np.where(total, distinct / some, 1.0), most / some


def statistics(texts: list[bytes]) -> np.ndarray:
    """A row of FEATURES for every text."""
    n = len(texts)
    # a line feed after each text keeps words and lines of neighbours apart
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    size = np.fromiter(map(len, texts), np.int64, n)
    start = np.concatenate([[0], np.cumsum(size + 1)[:-1]]).astype(np.int64)
    doc = np.repeat(np.arange(n, dtype=np.int32), size + 1)  # at most 4096 texts: its products fit
    kind = np.bincount(doc * 8 + _CLASS[data], minlength=8 * n).reshape(n, 8).astype(float)
    kind[:, 7] -= 1
    chars = np.maximum(size, 1)
    hist = np.bincount(doc * 256 + data, minlength=256 * n).reshape(n, 256).astype(float)
    hist[:, 10] -= 1
    p = hist / chars[:, None]
    entropy = -(p * np.log2(np.maximum(p, 1e-12))).sum(1)
    hashes = ByteHash(data)
    ws, we = word_bounds(data)
    wdoc = doc[ws] if len(ws) else np.zeros(0, np.int64)
    words = np.bincount(wdoc, minlength=n)
    some = np.maximum(words, 1)
    length = (we - ws).astype(float)
    mean = np.bincount(wdoc, length, n) / some
    sd = np.sqrt(np.maximum(np.bincount(wdoc, length * length, n) / some - mean * mean, 0))
    wh = hashes.of(ws, we)
    unique, top = _share_distinct(wdoc, wh, n)

    def grams(k: int) -> np.ndarray:
        if len(wh) < k:
            return np.ones(n)
        g = wh[: len(wh) - k + 1].copy()
        for i in range(1, k):
            g = g * np.uint64(0x9FB21C651E98DF25) + wh[i : len(wh) - k + 1 + i]
        inside = wdoc[k - 1 :] == wdoc[: len(wdoc) - k + 1]
        return _share_distinct(wdoc[: len(wdoc) - k + 1][inside], g[inside], n)[0]

    ends = np.flatnonzero(data == 10)
    ls = np.concatenate([[0], ends[:-1] + 1])
    filled = ends > ls
    ldoc = doc[ls[filled]]
    lines = np.bincount(ldoc, minlength=n)
    lines_unique, _ = _share_distinct(ldoc, hashes.of(ls[filled], ends[filled]), n)
    last, first = (data[we - 1], data[ws]) if len(ws) else (np.zeros(0, np.uint8),) * 2
    share = lambda mask: np.bincount(wdoc, mask.astype(float), n) / some
    upper_sum = np.concatenate([[0], np.cumsum(_CLASS[data] == 1)])
    lower_sum = np.concatenate([[0], np.cumsum(_CLASS[data] == 2)])
    loud = (upper_sum[we] - upper_sum[ws] >= 2) & (lower_sum[we] == lower_sum[ws])
    del start
    cols = [
        np.log1p(size), np.log1p(words), mean, sd, kind[:, 1] / chars, kind[:, 3] / chars, kind[:, 4] / chars, kind[:, 5] / chars, kind[:, 6] / chars, kind[:, 7] / chars,
        size / np.maximum(lines, 1), np.log1p(lines), unique, top, lines_unique, grams(2), grams(5),
        share(np.isin(last, [33, 46, 63])), share(_CLASS[last] == 5), share(_CLASS[first] == 1), share(loud), entropy,
    ]
    return np.stack(cols, axis=1)


@dataclass
class Forest:
    """Trees as flat arrays. A node with left < 0 is a leaf; rows with x <= threshold go left."""

    base: float = 0.0
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    depth: int = 0

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.roots):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        node = np.tile(self.roots, (len(x), 1))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            inner = self.left[node] >= 0
            goes_left = x[row, self.feature[node]] <= self.threshold[node]
            node = np.where(inner, np.where(goes_left, self.left[node], self.right[node]), node)
        return 1 / (1 + np.exp(-(self.base + self.value[node].sum(1))))


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, min_rows: int = 20, l2: float = 1.0) -> Forest:
    """Gradient boosting on logistic loss with histograms of quantile bins."""
    if not len(y) or y.min() == y.max():
        mean = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
        return Forest(base=float(np.log(mean / (1 - mean))))
    m, f = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(f)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)  # bin <= k: x <= edge k
    base = float(np.log(y.mean() / (1 - y.mean())))
    raw = np.full(m, base)
    out: dict[str, list] = {k: [] for k in ("roots", "feature", "threshold", "left", "right", "value")}

    def leaf(g: float, h: float) -> int:
        for k, v in (("feature", 0), ("threshold", 0.0), ("left", -1), ("right", -1), ("value", -rate * g / (h + l2))):
            out[k].append(v)
        return len(out["value"]) - 1

    offset = np.arange(f) * bins
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        out["roots"].append(leaf(grad.sum(), hess.sum()))
        todo = [(out["roots"][-1], np.arange(m), 0)]
        while todo:
            node, rows, level = todo.pop()
            raw_add = out["value"][node]
            if level < depth and len(rows) >= 2 * min_rows:
                at = (binned[rows] + offset).ravel()
                hg = np.bincount(at, np.repeat(grad[rows], f), f * bins).reshape(f, bins).cumsum(1)
                hh = np.bincount(at, np.repeat(hess[rows], f), f * bins).reshape(f, bins).cumsum(1)
                hn = np.bincount(at, minlength=f * bins).reshape(f, bins).cumsum(1)
                gt, ht = hg[:, -1:], hh[:, -1:]
                gain = hg**2 / (hh + l2) + (gt - hg) ** 2 / (ht - hh + l2) - gt**2 / (ht + l2)
                gain[(hn < min_rows) | (len(rows) - hn < min_rows)] = -np.inf
                j, b = divmod(int(gain.argmax()), bins)
                if gain[j, b] > 1e-6 and b < len(edges[j]):
                    goes = binned[rows, j] <= b
                    kids = [leaf(grad[r].sum(), hess[r].sum()) for r in (rows[goes], rows[~goes])]
                    out["feature"][node], out["threshold"][node] = j, float(edges[j][b])
                    out["left"][node], out["right"][node] = kids
                    todo += [(kids[0], rows[goes], level + 1), (kids[1], rows[~goes], level + 1)]
                    continue
            raw[rows] += raw_add
    return Forest(base, *(np.array(out[k], t) for k, t in (("roots", np.int32), ("feature", np.int32), ("threshold", float), ("left", np.int32), ("right", np.int32), ("value", float))), depth=depth)


def _scores(docs: DataFrame, model: Forest, id_col: str, text_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand nodes
    score = _score_udf(shared)
    return docs.select(F.col(id_col), score(text_of(text_col)).alias("score"))


def _batches(texts: Iterable[bytes], most: int = 1 << 20) -> Iterator[list[bytes]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= most or len(part) >= 4096:
            yield part
            part, size = [], 0
    if part:
        yield part


def _as_bytes(texts) -> Iterator[bytes]:
    return ((t or "").encode("utf-8", "replace") for t in texts)


def _score_udf(shared):
    @F.pandas_udf("double")
    def score(text):
        import pandas as pd

        got = [shared.value.score(statistics(part)) for part in _batches(_as_bytes(text))]
        return pd.Series(np.concatenate(got) if got else np.zeros(0))

    return score


def is_held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_train_rows: int = 20_000, **options) -> Forest:
    """Fit on the labelled rows whose crc32 remainder isn't 2, on a sample of at most max_train_rows."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).where("id is not null and y is not null")
    known = known.where(~is_held_out("id")).groupBy("id").agg(F.max("y").alias("y"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(max_train_rows)
    # ids of a bounded sample: the broadcast holds max_train_rows rows at most
    joined = docs.select(F.col(id_col).alias("doc"), text_of(text_col).alias("text")).join(F.broadcast(sample), F.col("doc") == F.col("id")).select("id", "y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for part in _batches(_as_bytes(b.column(2).to_pylist())):
                x = statistics(part)
                rows = b.slice(at, len(part))
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["id", "y", "x"])
                at += len(part)

    found = joined.mapInArrow(run, f"id {known.schema['id'].dataType.simpleString()}, y double, x array<double>")
    # ids that repeat in docs: one row each before anything goes to the driver, so that the sample keeps its bound
    got = found.groupBy("id").agg(F.min(F.struct("y", "x")).alias("r")).select("id", "r.y", "r.x").toArrow()
    rows = sorted({i: (y, x) for i, y, x in sorted(zip(got["id"].to_pylist(), got["y"].to_pylist(), got["x"].to_pylist(), strict=True))}.items())
    x = np.array([r[1][1] for r in rows]).reshape(-1, len(FEATURES))
    return fit(x, (np.array([r[1][0] for r in rows]) > 0).astype(float), **options)


def score_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7, **options) -> DataFrame:
    """id, held_out, score, predicted for every row of docs."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, **options)
    return _scores(docs, model, id_col, text_col).select(id_col, is_held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7, **options) -> DataFrame:
    """The rows of docs with a score of threshold at least, with all their columns."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, **options)
    score = _score_udf(docs.sparkSession.sparkContext.broadcast(model))
    names, safe = docs.columns, [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*safe)
    return rows.where(score(text_of(safe[names.index(text_col)])) >= threshold).toDF(*names)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
