"""Mixing sources to target weights as a curriculum that changes over time.

1. Size of a document: its words. Sizes are summed by source (map-side first).
2. Targets: the token budget is shared by weight; a source's target stops at
   `max_repeats` times its size and the excess is reshared by weight until none is above.
3. Each source has a weight schedule over training time 0..1, piecewise linear between
   knots. Its integral, scaled to the source's target, is the source's cumulative
   token demand.
4. Within a source documents stand in a hashed order. A document's place in the
   source's stream of tokens is the running sum before it, pass after pass. The
   inverse of the cumulative demand at that place is its training position.
5. Documents are range-sorted by position.

The running sum is exact and needs no task that holds a source: rows are dealt by
(source, slice of the hash), summed within the slice; the slices' totals, some
2,000 rows to one, are summed in blocks of some 2,000, and the blocks' over the source.

Sources are a table as well, of any length: they get their rank by a range sort, targets by a few aggregations,
and are broadcast only if their measured size is at most `max_broadcast_bytes`.

Cases: a null text has size 0; documents of size 0 are never taken and have no position.
A null source is a source of its own, sorted last. A source whose documents are all
empty has target 0. Rows with equal ids are told apart by size in the order, else are
interchangeable. An empty table gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirelake.llm.common import WORD, cut, text_of

Schedule = Sequence[tuple[float, float]]
#: Shape of the schedules of sources with weights 3, 1, 2: early, steady, late.
SHAPES: tuple[Schedule, ...] = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))


def share_unit(sources: DataFrame, total: float, max_repeats: float) -> float:
    """Target of a source for a unit of weight: targets are the lesser of weight times unit and max_repeats times size, and their
    sum is the total. The sum grows with the unit, ever more slowly, so that Newton's steps from below settle at the exact unit
    once they close no further source; each step is one aggregation of sources (size, weight)."""
    most = max_repeats * F.col("size")
    ratio = F.when(F.col("weight") > 0, most / F.col("weight"))
    live = sources.where("size > 0 and weight > 0").select(most.alias("most"), "weight", ratio.alias("ratio"))
    unit, closed = 0.0, -1
    while True:
        over = F.col("ratio") <= unit
        row = live.agg(F.count_if(over), F.sum(F.when(over, F.col("most"))), F.sum(F.when(~over, F.col("weight"))), F.sum("most")).first()
        if row[0] == closed:
            return unit
        closed = row[0]
        if not row[2] or float(row[3]) <= total:
            return float("inf")
        unit = (total - float(row[1] or 0)) / float(row[2])


def cumulative(schedule: Schedule) -> list[tuple[float, float, float, float]]:
    """Segments (t0, share of demand before t0, weight at t0, slope) of a schedule whose
    integral over 0..1 is scaled to 1."""
    pts = sorted((float(t), max(0.0, float(w))) for t, w in schedule)
    if not pts or pts[0][0] > 0:
        pts = [(0.0, pts[0][1] if pts else 1.0), *pts]
    if pts[-1][0] < 1:
        pts = [*pts, (1.0, pts[-1][1])]
    whole = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(pts, pts[1:], strict=False))
    if whole <= 0:
        return [(0.0, 0.0, 1.0, 0.0)]
    out, before = [], 0.0
    for a, b in zip(pts, pts[1:], strict=False):
        if b[0] > a[0]:
            out.append((a[0], before, a[1] / whole, (b[1] - a[1]) / whole / (b[0] - a[0])))
            before += (b[0] - a[0]) * (a[1] + b[1]) / 2 / whole
    return out


SOURCE = "source string, size long, n long, weight double, demand array<array<double>>"


def _ranked(sums: DataFrame, weight_of, schedule_of) -> DataFrame:
    """Sources with weights and demand, which the caller gives by the rank of a source in code point order, null last. Ranks are places in
    range-sorted partitions; the driver knows the number of rows of each partition only."""
    order = [F.col("source").isNull(), F.col("source")]
    placed = cut(sums.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))
    before, at = {}, 0
    for r in placed.groupBy("part").count().orderBy("part").collect():
        before[r.part], at = at, at + r["count"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = None
        for b in batches:
            rows = []
            for source, size, n, part in zip(*(b.column(c).to_pylist() for c in ("source", "size", "n", "part")), strict=True):
                k = before[part] if k is None else k
                rows.append({"source": source, "size": size, "n": n, "weight": float(weight_of(k, source)), "demand": [list(map(float, x)) for x in cumulative(schedule_of(k, source))]})
                k += 1
            kinds = [("source", pa.string()), ("size", pa.int64()), ("n", pa.int64()), ("weight", pa.float64()), ("demand", pa.list_(pa.list_(pa.float64())))]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))

    return cut(placed.mapInArrow(run, SOURCE))


def plan_mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight_of: Callable[[int, str | None], float] = lambda i, s: (3.0, 1.0, 2.0)[i % 3],
    schedule_of: Callable[[int, str | None], Schedule] = lambda i, s: SHAPES[i % 3],
    budget: float = 1.5,
    max_repeats: float = 2.0,
    seed: int = 17,
    rows_per_slice: int = 2048,
    slices_per_block: int = 2048,
    max_broadcast_bytes: int = 16 << 20,
) -> DataFrame:
    """One row a document: id, source, size, source_size, target, taken, copies, and
    positions: array of its training positions (0..1), one for each copy.

    weight_of and schedule_of get the rank of the source by code point (null last) and its name;
    budget is the share of all sizes that the mix takes."""
    # narrow and read three times: written once, so that texts are read once
    sized = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size")))
    sources = _ranked(sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")), weight_of, schedule_of)
    whole = sources.agg(F.sum("size"), F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + F.size("demand") * 40 + 64)).first()
    unit = share_unit(sources, budget * (whole[0] or 0), max_repeats)
    target = F.when((F.col("size") > 0) & (F.col("weight") > 0), F.least(max_repeats * F.col("size"), F.col("weight") * F.lit(unit))).otherwise(0.0)
    keyed = sources.select(F.col("source").alias("s"), F.col("size").alias("source_size"), target.alias("target"), F.greatest(F.lit(1), F.ceil(F.col("n") / rows_per_slice)).cast("long").alias("slices"), "demand")
    if (whole[1] or 0) <= max_broadcast_bytes:
        keyed = F.broadcast(keyed)
    of = F.col("source").eqNullSafe(F.col("s"))

    # a source has as many slices as its rows need
    named = sized.withColumn("order", F.xxhash64(F.lit(seed), "id", "size")).join(keyed.select("s", "slices"), of).drop("s")
    named = named.withColumn("slice", F.pmod(F.shiftrightunsigned("order", 20), F.col("slices"))).drop("slices")
    within = Window.partitionBy("source", "slice").orderBy("order", "id", "size")
    rows = named.withColumn("before", F.sum("size").over(within) - F.col("size"))
    offsets = _offsets(named.groupBy("source", "slice").agg(F.sum("size").alias("slice_size")), slices_per_block)
    rows = rows.join(offsets, rows["source"].eqNullSafe(offsets["s"]) & (rows["slice"] == offsets["k"])).drop("s", "k")
    rows = rows.withColumn("at", F.col("before") + F.col("offset")).join(keyed.drop("slices"), of).drop("s")
    # whole passes, and one more for those whose middle lies in the rest
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-9)).otherwise(0)
    rest = F.col("target") - passes * F.col("source_size")
    copies = F.when(F.col("size") == 0, F.lit(0)).otherwise(passes + F.when(F.col("at") + F.col("size") / 2 <= rest, 1).otherwise(0)).cast("int")
    rows = rows.withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies"))
    return rows.withColumn("positions", _positions()).select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "taken", "copies", "positions")


def _offsets(totals: DataFrame, slices_per_block: int) -> DataFrame:
    """s, k, offset: what comes before each slice in its source. Slices are summed in blocks, blocks in their source, so that a source of
    n rows is n / (rows_per_slice * slices_per_block) rows to one task."""
    totals = cut(totals.withColumn("block", F.floor(F.col("slice") / slices_per_block)))
    blocks = totals.groupBy("source", "block").agg(F.sum("slice_size").alias("block_size"))
    earlier = F.sum("block_size").over(Window.partitionBy("source").orderBy("block")) - F.col("block_size")
    blocks = blocks.select(F.col("source").alias("bs"), F.col("block").alias("bb"), earlier.alias("earlier"))
    inside = F.sum("slice_size").over(Window.partitionBy("source", "block").orderBy("slice")) - F.col("slice_size")
    joined = totals.withColumn("inside", inside).join(blocks, F.col("source").eqNullSafe(F.col("bs")) & (F.col("block") == F.col("bb")))
    return joined.select(F.col("source").alias("s"), F.col("slice").alias("k"), (F.col("inside") + F.col("earlier")).alias("offset"))


def _positions():
    """Inverse of the cumulative demand at the middle of each copy of a document."""
    return F.expr("""
      transform(if(copies > 0, sequence(0, copies - 1), array()), j ->
        aggregate(
          transform(array(least(1D, (j * source_size + at + size / 2D) / target)), u ->
            named_struct('u', u, 's', element_at(filter(demand, d -> d[1] <= u), -1))),
          0D,
          (acc, x) -> x.s[0] + if(abs(x.s[3]) < 1e-12,
            if(x.s[2] > 0, (x.u - x.s[1]) / x.s[2], 0D),
            (sqrt(greatest(0D, x.s[2] * x.s[2] + 2 * x.s[3] * (x.u - x.s[1]))) - x.s[2]) / x.s[3])))
    """)


def training_order(plan: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", partitions: int | None = None) -> DataFrame:
    """One row a copy, range-sorted by training position: id, source, copy, position."""
    out = plan.select(F.col(id_col), F.col(source_col), F.posexplode("positions").alias("copy", "position"))
    return (out.repartitionByRange(partitions, "position") if partitions else out.repartitionByRange("position")).sortWithinPartitions("position", id_col)


def mix_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """plan_mix, range-sorted by the first position of each document; those not taken come last."""
    plan = plan_mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    place = F.coalesce(F.try_element_at("positions", F.lit(1)), F.lit(2.0) + F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) / F.lit(1 << 20))
    return plan.withColumn("first_position", F.try_element_at("positions", F.lit(1))).repartitionByRange(place).sortWithinPartitions(place)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix_documents(docs).select("doc_id", "size", "source_size", "target", "taken", "first_position")
