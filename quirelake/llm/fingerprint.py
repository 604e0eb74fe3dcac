"""Document fingerprints: bottom-k sketches of 5-word shingle hashes, in DataFrame functions only.

A sketch is the sorted array of the k least distinct 64-bit hashes of a text's shingles
(A-Z lowered, words parted by ASCII white space). Sketches of parts merge into that of the
whole; two estimate resemblance and containment, one the number of distinct shingles. With
no more than k distinct shingles all of these are exact.

The edited-text query needs each document's neighbour in descending order of id. Rows are dealt into slices of that
order, so many that a slice has no more than some `rows_per_slice` rows and `bytes_per_slice` bytes. The slices' bounds are keys
from a sample of bounded size, drawn by weight: id, hash of the text, and a random number, so that null, equal and repeated ids are split as
well. The bounds of up to 256 ranges are literals; of more slices, each range's own bounds come from a sample that is
grouped by range (256 rows of at most 4,095 bounds). Within a slice the neighbour is the next row; the last row of a slice
gets the first row of the next slice that has any, by a join of one row a slice. So texts are shuffled once, no
task holds the table, and nothing that is broadcast grows with it. Bounds only deal the work; results don't depend on them.

Cases: a null text is empty; an empty sketch is like another empty one (1.0) and unlike any other
(0.0). A text of 1 to 4 words is one shingle. A null id comes last; rows with equal ids are
ordered by a hash of the text. A table of one row is its own neighbour. An empty table gives an
empty result. Other columns aren't read. Ids may be of any type that can be ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirelake.llm.common import ascii_lower, text_of

K = 256


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingle_hashes(text: Column, n: int = 5) -> Column:
    """Hashes of all n-word shingles of a text, in order, repeats included."""
    words = F.array_remove(F.split(ascii_lower(text), r"[\x20\x09-\x0D]+"), "")

    def grams(h: Column) -> Column:
        long = F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(n)]))
        short = F.array(F.aggregate(h, F.lit(n).cast("long"), lambda a, x: F.xxhash64(a, x)))
        return F.when(F.size(h) >= n, long).when(F.size(h) > 0, short).otherwise(F.array().cast("array<bigint>"))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), grams)


def bottom_k(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K, n: int = 5) -> Column:
    return bottom_k(shingle_hashes(text, n), k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of what a and b are sketches of."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_all(sketches: DataFrame, by: list[str], col: str, k: int = K) -> DataFrame:
    """Sketch of each group's union. The least hashes are found by a window over narrow rows, so
    that no group is collected."""
    one = sketches.select(*by, F.explode(col).alias("h")).distinct()
    ranked = one.withColumn("rn", F.row_number().over(Window.partitionBy(*by).orderBy("h"))).where(F.col("rn") <= k)
    return ranked.groupBy(*by).agg(F.sort_array(F.collect_list("h")).alias(col))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets, 0 to 1."""
    return _let(merge(a, b, k), lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(u, F.array_intersect(a, b))) / F.size(u)))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    union = distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), resemblance(a, b, k) * union / distinct_count(a, k)))


def as_text(a: Column) -> Column:
    """A sketch as a string: base64 of its hashes, 8 bytes each."""
    return F.base64(F.unhex(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")))


RANGES, FINE, PER_BOUND = 256, 4096, 64  # most ranges, most slices of one, rows sampled for a bound
KEY = ("id", "th", "rn")


def _below(bounds: Column, key: Column, most: int) -> Column:
    """How many of less than most sorted bounds are less than key, by bisection; most is a power of 2."""
    steps = F.array(*[F.lit(most >> k) for k in range(1, most.bit_length())])
    return F.aggregate(steps, F.lit(0), lambda lo, w: F.when(F.get(bounds, lo + w - 1) < key, lo + w).otherwise(lo))


def _sliced(rows: DataFrame, rows_per_slice: int, bytes_per_slice: int) -> DataFrame:
    """rows (id, text, th, rn) with slice, a number that rises as keys fall."""
    # a row weighs its bytes and its share of a slice's rows, so that a slice of full weight exceeds neither bound
    weight = F.octet_length("text") + F.lit(bytes_per_slice // rows_per_slice)
    total = rows.agg(F.sum(weight)).first()[0] or 0
    wanted = min(max(1, -(-total // bytes_per_slice)), RANGES * FINE)
    if wanted == 1:
        return rows.withColumn("slice", F.lit(0).cast("long"))
    key = F.struct(*KEY)

    def sample(bounds: int) -> DataFrame:
        return rows.where(F.rand(29) < weight * (bounds * PER_BOUND / total)).select(*KEY)

    ranges = min(wanted, RANGES)
    found = sample(ranges).orderBy(*KEY).limit(4 * RANGES * PER_BOUND).collect()  # about ranges * PER_BOUND rows
    cuts = [found[len(found) * k // ranges] for k in range(1, ranges)] if found else []
    bounds = F.array(*[F.struct(F.lit(c.id).cast(rows.schema["id"].dataType).alias("id"), F.lit(c.th).alias("th"), F.lit(c.rn).alias("rn")) for c in cuts])
    rows = rows.withColumn("range", _below(bounds, key, RANGES))
    if wanted <= RANGES:
        return rows.withColumn("slice", -F.col("range").cast("long")).drop("range")
    fine = -(-wanted // RANGES)
    keys = sample(wanted).select(_below(bounds, key, RANGES).alias("range"), key.alias("key")).groupBy("range").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    of = F.transform(F.sequence(F.lit(1), F.lit(fine - 1)), lambda k: F.get("keys", F.floor(F.size("keys") * k / fine).cast("int")))
    # at most RANGES rows of FINE - 1 keys
    rows = rows.join(F.broadcast(keys.select("range", of.alias("inner"))), "range", "left")
    return rows.withColumn("slice", -(F.col("range").cast("long") * FINE + F.coalesce(_below(F.col("inner"), key, FINE), F.lit(0)))).drop("range", "inner")


def _with_next_head(ends: DataFrame, block: int = 2048) -> DataFrame:
    """slice, id, text of each slice's last row with next_text, the head of the next slice there is, or of the first for the last. Slices meet in
    blocks, blocks in one task, which has a row for block slices of rows_per_slice rows each."""
    blocked = ends.withColumn("block", F.floor(F.col("slice") / block)).repartition("block")
    inside = blocked.withColumn("next_text", F.lead("head").over(Window.partitionBy("block").orderBy("slice")))
    # all columns, so that both read one exchange
    firsts = blocked.groupBy("block").agg(F.min(F.struct("slice", "head", "id", "text")).alias("first"))
    every = Window.orderBy("block")
    later = F.coalesce(F.lead("first.head").over(every), F.first("first.head").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    firsts = firsts.select(F.col("block").alias("b"), later.alias("later"))
    return inside.join(firsts, F.col("block").eqNullSafe(F.col("b"))).select("id", "text", F.coalesce("next_text", "later").alias("next_text"))


def neighbours(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rows_per_slice: int = 4096, bytes_per_slice: int = 32 << 20) -> DataFrame:
    """id, text, next_text of every row, and fp, next_fp, the sketches of the two, where the next is
    by descending id and that of the last is the first."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).withColumn("th", F.xxhash64("text")).withColumn("rn", F.rand(17))
    dealt = _sliced(rows, rows_per_slice, bytes_per_slice).repartition("slice")
    w = Window.partitionBy("slice").orderBy(F.col("id").desc_nulls_last(), F.col("th").desc(), F.col("rn").desc())
    inner = dealt.withColumn("fp", sketch(F.col("text")))
    inner = inner.withColumn("next_text", F.lead("text").over(w)).withColumn("next_fp", F.lead("fp").over(w)).where("next_text is not null")
    # one row a slice of its ends; it reads the same exchange
    placed = dealt.withColumn("next_text", F.lead("text").over(w)).withColumn("above", F.lag("text").over(w)).where("next_text is null or above is null")
    ends = placed.groupBy("slice").agg(F.max(F.when(F.col("next_text").isNull(), F.struct("id", "text", "th", "rn"))).alias("last"), F.max(F.when(F.col("above").isNull(), F.col("text"))).alias("head"))
    ends = _with_next_head(ends.select("slice", "last.id", "last.text", "head"))
    ends = ends.withColumn("fp", sketch(F.col("text"))).withColumn("next_fp", sketch(F.col("next_text")))
    names = ["id", "text", "next_text", "fp", "next_fp"]
    return inner.select(*names).unionByName(ends.select(*names))


def edited_fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rows_per_slice: int = 4096, bytes_per_slice: int = 32 << 20) -> DataFrame:
    rows = neighbours(docs, id_col=id_col, text_col=text_col, rows_per_slice=rows_per_slice, bytes_per_slice=bytes_per_slice)
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("half", F.floor(F.col("n_chars") / 2).cast("int"))
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - F.col("half")).cast("int")), F.substring("next_text", F.lit(1), F.col("half")))
    rows = rows.select("id", "n_chars", "fp", "next_fp", edited.alias("edited"))
    rows = rows.select("id", "n_chars", "fp", "next_fp", F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("edited")).alias("edited_fp"))
    return rows.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        resemblance(F.col("fp"), F.col("edited_fp")).alias("near_edited"), resemblance(F.col("fp"), F.col("next_fp")).alias("near_next"),
        distinct_count(F.col("fp")).alias("distinct_shingles"), containment(F.col("fp"), F.col("edited_fp")).alias("contained_in_edited"),
    )


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
