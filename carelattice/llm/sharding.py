"""Uniform shuffle into shards of exact sizes.

A uniformly random permutation of all rows deals partition i to shard j a hypergeometric number of rows. This operator draws
that communication matrix first, exactly and with exact margins, and then needs one local permutation, one exchange and one
more permutation inside each shard:

1. ``communication``: rows per (partition, shard). The partitions form a tree with a bounded fan-out; a node splits its
   column sums among its children by hypergeometric draws (inverse distribution function, weights outwards from the mode),
   so nothing depends on all partitions at once and every level is one small DataFrame step.
2. The rows of a partition are ranked in random order; the ranks are cut at the cumulated counts of its matrix row.
3. The rows of a shard are ranked again in random order. A shard is ranked in buckets of a bounded expected size (leading
   bits of the random key) whose offsets are prefix sums, so no task sorts a whole shard.

All randomness is a hash of (seed, row position), so a repeated task deals the same.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carelattice.llm.small import free_prefix
from carelattice.llm.words import fold_sum, let
from carelattice.runtime import cut_lineage

FAN_OUT = 32
BUCKET_ROWS = 4096
SPREAD = 9.0


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the hash of ``parts``."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def hypergeometric(u: Column, total: Column, marked: Column, drawn: Column) -> Column:
    """Quantile ``u`` of the number of marked items among ``drawn`` of ``total`` items, ``marked`` of them marked.

    Weights are ratios to the mode, summed over the support within SPREAD standard deviations (beyond that a double holds
    no share of the total), so no factorials are needed and the cost is the standard deviation, not the size.
    """
    return let(F.struct(u.alias("u"), total.alias("n"), marked.alias("m"), drawn.alias("d")), lambda x: _quantile(x["u"], x["n"], x["m"], x["d"]))


def _quantile(u: Column, total: Column, marked: Column, drawn: Column) -> Column:
    low = F.greatest(F.lit(0).cast("long"), drawn + marked - total)
    high = F.least(drawn, marked)
    share = marked.cast("double") / F.greatest(total, F.lit(1))
    spread = F.sqrt(drawn * share * (1 - share) * (total - drawn) / F.greatest(total - 1, F.lit(1)))
    reach = F.ceil(spread * SPREAD + 12).cast("long")
    mode = F.least(high, F.greatest(low, F.floor((drawn + 1).cast("double") * (marked + 1) / (total + 2)).cast("long")))
    box = F.struct(total.alias("n"), marked.alias("m"), drawn.alias("d"), mode.alias("mode"), F.greatest(low, mode - reach).alias("low"), F.least(high, mode + reach).alias("high"), u.alias("u"))

    def up(s: Column, b: Column) -> Column:  # weight of k + 1 over that of k, k = s
        return (b["m"] - s).cast("double") * (b["d"] - s) / ((s + 1).cast("double") * (b["n"] - b["m"] - b["d"] + s + 1))

    def down(s: Column, b: Column) -> Column:  # weight of k - 1 over that of k
        return s.cast("double") * (b["n"] - b["m"] - b["d"] + s) / ((b["m"] - s + 1).cast("double") * (b["d"] - s + 1))

    def above(b: Column) -> Column:
        return F.when(b["high"] > b["mode"], F.sequence(b["mode"], b["high"] - 1)).otherwise(F.array().cast("array<long>"))

    def below(b: Column) -> Column:
        return F.when(b["mode"] > b["low"], F.sequence(b["mode"], b["low"] + 1, F.lit(-1).cast("long"))).otherwise(F.array().cast("array<long>"))

    def mass(steps: Column, b: Column, ratio) -> Column:
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
        step = lambda acc, k: F.struct((acc["w"] * ratio(k, b)).alias("w"), (acc["sum"] + acc["w"] * ratio(k, b)).alias("sum"))
        return F.aggregate(steps, start, step, lambda acc: acc["sum"])

    def search(b: Column, over: Column, under: Column) -> Column:
        target = b["u"] * (1 + over + under)
        start = F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum"), b["mode"].alias("k"))

        def walk(goal: Column, ratio, by: int):
            def step(acc: Column, k: Column) -> Column:
                w = acc["w"] * ratio(k, b)
                go = acc["sum"] < goal
                return F.struct(w.alias("w"), F.when(go, acc["sum"] + w).otherwise(acc["sum"]).alias("sum"), F.when(go, k + by).otherwise(acc["k"]).alias("k"))

            return step

        # the mode, then what lies above it, then what lies below: any fixed order of the values gives the same law
        upward = F.aggregate(above(b), start, walk(target, up, 1), lambda acc: acc["k"])
        rest = target - over
        downward = F.aggregate(below(b), start, walk(rest, down, -1), lambda acc: acc["k"])
        return F.when(target <= 1 + over, upward).otherwise(downward)

    weighed = let(box, lambda b: F.struct(b.alias("b"), mass(above(b), b, up).alias("over"), mass(below(b), b, down).alias("under")))
    return let(weighed, lambda x: search(x["b"], x["over"], x["under"]))


def split_columns(columns: Column, drawn: Column, *key: Column) -> Column:
    """How ``drawn`` of the rows with column sums ``columns`` spread over the columns: a multivariate hypergeometric draw."""
    start = F.struct(fold_sum(columns).alias("rest"), drawn.alias("need"), F.array().cast("array<long>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        k = hypergeometric(uniform(*key, F.size(acc["out"])), acc["rest"], x, acc["need"])
        return let(k, lambda v: F.struct((acc["rest"] - x).alias("rest"), (acc["need"] - v).alias("need"), F.concat(acc["out"], F.array(v)).alias("out")))

    return F.aggregate(columns, start, step, lambda acc: acc["out"])


def communication(sizes: DataFrame, total: int, shards: int, seed: int, partitions: int) -> DataFrame:
    """The matrix: (part, counts array<long>), one row per partition of ``sizes`` (part, n).

    ``total`` is the sum of n; shard j gets total div shards rows, the first total mod shards shards one more.
    ``partitions`` bounds part from above. Each level holds at most FAN_OUT children per node.
    """
    spark = sizes.sparkSession
    levels = max(1, math.ceil(math.log(max(partitions, 2), FAN_OUT)))
    margin = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda j: (F.lit(total // shards) + (j < total % shards).cast("int")).cast("long"))
    nodes = spark.range(1).select(F.col("id").alias("node"), margin.alias("counts"))
    for level in range(levels - 1, -1, -1):
        width = FAN_OUT**level
        children = (
            sizes.groupBy(F.floor(F.col("part") / width).cast("long").alias("child"))
            .agg(F.sum("n").alias("n"))
            .groupBy(F.floor(F.col("child") / FAN_OUT).cast("long").alias("node"))
            .agg(F.sort_array(F.collect_list(F.struct("child", "n"))).alias("children"))
        )
        start = F.struct(F.col("counts").alias("left"), F.array().cast("array<struct<child:bigint,counts:array<bigint>>>").alias("out"))

        def deal(acc: Column, c: Column) -> Column:
            row = split_columns(acc["left"], c["n"], F.lit(seed), F.lit(width), c["child"])
            return let(
                row,
                lambda r: F.struct(
                    F.zip_with(acc["left"], r, lambda a, b: a - b).alias("left"),
                    F.concat(acc["out"], F.array(F.struct(c["child"].alias("child"), r.alias("counts")))).alias("out"),
                ),
            )

        dealt = F.aggregate("children", start, deal, lambda acc: acc["out"])
        nodes = nodes.join(children, "node").select(F.explode(dealt).alias("x")).select(F.col("x.child").alias("node"), F.col("x.counts").alias("counts"))
    return nodes.withColumnRenamed("node", "part")


def bucket_slots(rows: DataFrame, group: str, key: Column, order: list[Column], buckets: int) -> DataFrame:
    """``rows`` with ``slot``: the rank from 0 within ``group`` by the non-negative 62-bit ``key``, then ``order``.

    The rank is the number of rows in lower buckets plus the rank within the bucket.
    """
    p, width = free_prefix(rows.columns), (1 << 62) // buckets + 1
    keyed = rows.withColumn(p + "key", key).withColumn(p + "bucket", F.floor(F.col(p + "key") / F.lit(width)).cast("long"))
    counts = keyed.groupBy(group, p + "bucket").agg(F.count(F.lit(1)).alias(p + "n"))
    before = F.coalesce(F.sum(p + "n").over(Window.partitionBy(group).orderBy(p + "bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(F.col(group), F.col(p + "bucket"), before.alias(p + "before"))
    ranked = keyed.withColumn(p + "rank", F.row_number().over(Window.partitionBy(group, p + "bucket").orderBy(p + "key", *order)) - 1)
    return ranked.join(offsets, [group, p + "bucket"]).withColumn("slot", F.col(p + "before") + F.col(p + "rank")).drop(p + "key", p + "bucket", p + "before", p + "rank")


def shuffle_into_shards(rows: DataFrame, shards: int, seed: int = 0, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows`` in uniformly random order over ``shards`` shards: adds shard (int) and slot (long, gapless from 0 per shard).

    Shard sizes differ by one row at most, whatever the values: null keys, repeated rows and hot keys are rows like any
    other, an empty table gives an empty result. Existing columns shard and slot are replaced, all others may have any name. The rows are staged once in
    the shared folder with their position, so that both passes and every retry see the same partitions.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    plain = rows.drop("shard", "slot")
    p = free_prefix(plain.columns)
    staged = cut_lineage(
        plain.withColumn(p + "at", F.monotonically_increasing_id()).withColumn(p + "part", F.shiftright(F.col(p + "at"), 33)), "shard-rows"
    )
    sizes = cut_lineage(staged.groupBy(F.col(p + "part").alias("part")).agg(F.count(F.lit(1)).alias("n")), "shard-sizes")
    facts = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.max("part"), F.lit(0)).alias("top")).first()
    total = facts["n"]
    matrix = communication(sizes, total, shards, seed, facts["top"] + 1)
    matrix = matrix.select(F.col("part").alias(p + "part"), F.col("counts").alias(p + "counts"))
    local = Window.partitionBy(p + "part").orderBy(F.xxhash64(F.lit(seed), F.lit("local"), p + "at"), p + "at")
    ends = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda j: fold_sum(F.slice(p + "counts", F.lit(1), j)))
    dealt = (
        staged.withColumn(p + "rank", F.row_number().over(local) - 1)
        .join(matrix.withColumn(p + "ends", ends), p + "part")
        .withColumn("shard", F.size(F.filter(p + "ends", lambda e: e <= F.col(p + "rank"))))
        .drop(p + "rank", p + "counts", p + "ends", p + "part")
    )
    key = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("shard"), p + "at"), 2)
    buckets = max(1, math.ceil(total / shards / bucket_rows))
    return bucket_slots(dealt, "shard", key, [F.col(p + "at")], buckets).select(*plain.columns, F.col("shard").cast("int"), F.col("slot").cast("long"))
