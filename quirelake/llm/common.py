"""Helpers the operators share: the shared folder, ASCII words, byte hashes.

Every operator takes the names of the columns it reads, selects only those
and returns a documented set of columns, so further columns of the input,
whatever their names, can't clash with what it makes on the way.
"""

from __future__ import annotations

import re
import tempfile

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ensure_shared_dir(spark: SparkSession) -> None:
    """Keep the session's spark.checkpoint.dir. Where none is set, a local session, which is one machine, gets a folder of its
    own (tests); on a cluster that is an error, since executors wouldn't see it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        given = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
        if not given and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="quirelake-checkpoint-"))


def shared_folder(spark: SparkSession) -> str:
    """The folder for tables that driver and executors share."""
    ensure_shared_dir(spark)
    return spark.sparkContext.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: a checkpoint in the folder that driver and executors share."""
    ensure_shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_of(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


#: Odd base and its inverse modulo 2**64, for hashes of substrings by prefix sums.
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_TABLE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {"p": np.ones(1, np.uint64), "q": np.ones(1, np.uint64)}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers[name]
    if len(have) < n:
        steps = np.full(max(n, 2 * len(have)), base, np.uint64)
        steps[0] = 1
        have = _powers[name] = np.multiply.accumulate(steps)
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A finaliser with good avalanche (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class ByteHash:
    """64-bit hashes of any substrings of one byte array, each in O(1) after one pass."""

    def __init__(self, data: np.ndarray):
        self.n = len(data)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(_TABLE[data] * _power("p", _P, self.n), out=self.sums[1:])
        self.inv = _power("q", _P_INV, self.n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of data[start:end], for arrays of starts and ends."""
        raw = (self.sums[end] - self.sums[start]) * self.inv[start]
        return mix64(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without ASCII white space) of a byte array."""
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = _SPACE[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    return edge[::2], edge[1::2]


def shingle_set(text: bytes, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles of a text, A-Z lowered, words
    joined by one space. A text of fewer than n words but at least one is one shingle;
    a text without words has none."""
    data = _LOWER[np.frombuffer(text, np.uint8)]
    start, end = word_bounds(data)
    m = len(start)
    if not m:
        return np.zeros(0, np.uint64)
    word = ByteHash(data).of(start, end)
    k = min(n, m)
    acc = np.full(m - k + 1, np.uint64(k), np.uint64)
    for i in range(k):
        acc = mix64(acc * np.uint64(0x9FB21C651E98DF25) + word[i : m - k + 1 + i])
    return np.unique(acc)
