"""Merkle manifest of a table: leaves, roots, membership proofs.

Rows are leaves of one tree per group (a null group is a group); the roots of the groups, in order, are the leaves of the
tree of the whole table. A node is the SHA-256 of up to ``FAN`` hexadecimal digests written one after the other.

Checkpoint and recompute: only every ``STRIDE``-th level is written. A subtree of ``FAN ** STRIDE`` stored neighbours is one
group, whose bounded array of digests is folded in place, so a level in between never leaves the row. Proofs go from the top
down: a stored node gets the steps above it once, its subtree regenerates the levels in between from its stored descendants,
hands every descendant its siblings and forgets them. Per row of the table that is one exchange up and one down.

Places in a tree are ranks, found without sorting a group in one task: rows are range-partitioned by group and order, and
a place is the place in the partition plus the rows of the group in earlier partitions (a table of one row per partition and
group). All steps are column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carelattice.llm.words import let
from carelattice.runtime import cut_lineage

FAN, BITS = 16, 4
#: Levels from one stored level to the next: a subtree has FAN ** STRIDE = 256 stored nodes.
STRIDE = 2
PATH = "array<struct<left:string,right:string>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(*values: Column) -> Column:
    """SHA-256 of the values, each as `-` if null, else its length in UTF-8 bytes, `:` and the value as text."""
    parts = []
    for v in values:
        text = v.cast("string")
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts), 256)


def tree_key(group: Column) -> Column:
    """A text without nulls in the order of the group: null first, then bytewise."""
    return F.when(group.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), group.cast("string")))


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with (pos, height): place in its ``tree`` by ``order``, and the levels that tree has above its leaves."""
    tie = nodes.withColumn("_tie", F.monotonically_increasing_id())  # equal rows need not share a partition
    ranged = tie.repartitionByRange("tree", *order, "_tie").sortWithinPartitions("tree", *order, "_tie").drop("_tie")
    rows = cut_lineage(ranged.withColumn("_id", F.monotonically_increasing_id()), "merkle-rows")
    part = F.shiftright("_id", 33).alias("_part")
    spans = rows.groupBy("tree", part).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.sum("_n").over(Window.partitionBy("tree"))
    spans = spans.select("tree", "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), whole.alias("_whole"))
    height = F.when(F.col("_whole") == 1, F.lit(0)).otherwise(F.length(F.hex(F.col("_whole") - 1)))  # hexadecimal digits
    found = rows.withColumn("_part", part).join(cut_lineage(spans, "merkle-spans"), ["tree", "_part"])
    return found.select(*nodes.columns, (F.col("_id") + F.col("_shift")).alias("pos"), height.alias("height"))


def parents(digests: Column) -> Column:
    """Digests of the runs of FAN neighbours of a non-empty array."""
    return let(
        digests,
        lambda a: F.transform(F.sequence(F.lit(0), F.shiftright(F.size(a) - 1, BITS)), lambda i: F.sha2(F.array_join(F.slice(a, i * FAN + 1, F.lit(FAN)), ""), 256)),
    )


def subtrees(rows: DataFrame, *more: str) -> DataFrame:
    """(tree, pos, height, members): stored nodes by aligned subtree, in order; ``more`` columns travel along."""
    member = F.struct("pos", "digest", *[c for c in more if c != "digest"])
    return rows.groupBy("tree", F.shiftright("pos", BITS * STRIDE).alias("sub")).agg(
        F.first("height").alias("height"), F.sort_array(F.collect_list(member)).alias("members")
    ).withColumnRenamed("sub", "pos")


def build(leaves: DataFrame, order: list[str]) -> list[DataFrame]:
    """Stored levels over ``leaves`` (tree, digest, ...): the leaves with (pos, height), then every STRIDE-th level.

    A tree of height h has its root, at pos 0, in the level ceil(h / STRIDE), where ``height <= STRIDE * level``. The driver
    learns the greatest height only.
    """
    levels = [cut_lineage(placed(leaves, order), "merkle-level")]
    tallest = levels[0].agg(F.max("height")).first()[0] or 0
    for base in range(0, tallest, STRIDE):
        up = F.col("members")["digest"]
        for step in range(STRIDE):
            up = F.when(F.col("height") > base + step, parents(up)).otherwise(up) if step else parents(up)
        top = subtrees(levels[-1].where(F.col("height") > base)).select("tree", "pos", "height", F.get(up, F.lit(0)).alias("digest"))
        levels.append(cut_lineage(top, "merkle-level"))
    return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of every tree's root."""
    found = [rows.where(F.col("height") <= STRIDE * k).select("tree", "digest") for k, rows in enumerate(levels)]
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def _steps(inside: list[Column], at: Column, height: Column, base: int) -> Column:
    """Siblings of member ``at`` of a subtree, as left and right texts, for each of its levels."""

    def step(digests: Column, place: Column) -> Column:
        start = place - F.pmod(place, F.lit(FAN))
        left = F.array_join(F.slice(digests, start + 1, place - start), "")
        right = F.array_join(F.slice(digests, place + 2, start + FAN - 1 - place), "")
        return F.array(F.struct(left.alias("left"), right.alias("right")))

    out = []
    for k, digests in enumerate(inside):
        one = step(digests, F.shiftright(at, BITS * k))
        out.append(one if k == 0 else F.when(height > base + k, one).otherwise(F.array().cast(PATH)))
    return F.concat(*out)


def _members(base: int, own: list[str]):
    """Members of a subtree with all steps above them, from its regenerated levels."""

    def each(level: Column) -> Column:
        inside = [level[f"l{i}"] for i in range(STRIDE)]
        return F.transform(
            F.col("members"),
            lambda m, i: F.struct(m["pos"].alias("pos"), F.concat(_steps(inside, i, F.col("height"), base), F.col("path")).alias("path"), *[m[c].alias(c) for c in own]),
        )

    return each


def paths(levels: list[DataFrame], outer: DataFrame, payload: list[str]) -> DataFrame:
    """(payload, path, the further columns of ``outer``) of every leaf.

    ``outer`` (tree, path, ...) has the steps above each root; a step holds the digests left and right of the node, in order.
    """
    extra = [c for c in outer.columns if c not in ("tree", "path")]
    above = None
    for k in range(len(levels) - 1, -1, -1):
        rows, base, own = levels[k], STRIDE * k, payload if k == 0 else []
        done = rows.where(F.col("height") <= base).join(outer, "tree").select("tree", "pos", "path", *extra, *own)
        if above is not None:
            grouped = subtrees(rows.where(F.col("height") > base), *own).join(above, ["tree", "pos"])
            inside = [F.col("members")["digest"]]
            for _ in range(1, STRIDE):
                inside.append(parents(inside[-1]))
            regenerated = F.struct(*[a.alias(f"l{i}") for i, a in enumerate(inside)])
            one = grouped.select("tree", *extra, F.explode(let(regenerated, _members(base, own))).alias("m"))
            done = done.unionByName(one.select("tree", *extra, "m.pos", "m.path", *[f"m.{c}" for c in own]))
        above = done if k == 0 else cut_lineage(done, "merkle-paths")
    return above.select(*payload, "path", *extra)


def fold(leaf: Column, path: Column) -> Column:
    """Root that a leaf and the steps above it give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda s: F.array(s["left"], s["right"]))), ""), 256)


def manifest(rows: DataFrame, group: str, order: str, fields: tuple[str, ...], more: dict[str, Column] | None = None) -> DataFrame:
    """(order, leaf, more, subroot, root, path) of every row of ``rows``.

    A leaf is the digest of ``fields``; leaves of a group stand by ``order`` (null first), equal ones by their digest, so
    repeated rows and null keys have a defined root. Any field may be null, texts may have any length; other columns are not
    read, whatever their names. A group of one row has that leaf as root; an empty table gives no rows. ``more`` adds
    columns computed from the row.
    """
    extra = more or {}
    leaves = rows.select(
        tree_key(F.col(f"`{group}`")).alias("tree"), F.col(f"`{order}`").alias("key"), digest_of(*[F.col(f"`{f}`") for f in fields]).alias("digest"),
        *[c.alias(f"more{i}") for i, c in enumerate(extra.values())],
    )
    levels = build(leaves, ["key", "digest"])
    tops = cut_lineage(roots(levels).withColumn("own", F.col("tree")), "merkle-roots")
    upper = build(tops.select(F.lit("all").alias("tree"), "own", "digest"), ["own"])
    root = roots(upper).select("tree", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
    outer = paths(upper, root, ["own", "digest"]).select(F.col("own").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    found = paths(levels, cut_lineage(outer, "merkle-outer"), ["key", "digest", *[f"more{i}" for i in range(len(extra))]])
    return found.select(F.col("key").alias(order), F.col("digest").alias("leaf"), *[F.col(f"more{i}").alias(n) for i, n in enumerate(extra)], "subroot", "root", "path")


def lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit(docs: DataFrame) -> DataFrame:
    """Proof of every row of documents, checked against the root after a tampering with every fifth doc_id by CRC-32.

    Tampering lower-cases A-Z of the text; a null text, or one without capitals, stays as it is, and so does a row without
    doc_id.
    """
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    changed = digest_of(*[lowered(F.col(f)) if f == "text" else F.col(f) for f in FIELDS])
    found = manifest(docs.select(*FIELDS), "source", "doc_id", FIELDS, {"changed": F.when(F.coalesce(chosen, F.lit(False)), changed)})
    folded = fold(F.coalesce("changed", "leaf"), F.col("path"))
    out = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
