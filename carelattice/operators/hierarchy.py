"""Parent hierarchies by pointer doubling.

After round k every node points 2^k levels up, so a chain of depth d needs log2(d) joins instead
of d. Each round is one join of the unresolved nodes, written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carelattice.runtime import cut_lineage, salted_lookup


def parents(nodes: DataFrame, id_col: str = "id", parent_col: str = "parent_id") -> DataFrame:
    """One (node, parent) row per id; of several rows of one id the greatest parent counts."""
    return (
        nodes.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("node"))
        .agg(F.max(parent_col).alias("parent"))
    )


def _missing_parents(tree: DataFrame) -> DataFrame:
    """Parents that are no node. Parents are made distinct before the join."""
    known = tree.select(F.col("node").alias("parent"))
    return tree.where(F.col("parent").isNotNull()).select("parent").distinct().join(known, "parent", "left_anti")


def broken_parents(nodes: DataFrame, id_col: str = "id", parent_col: str = "parent_id") -> DataFrame:
    """Nodes whose parent does not exist."""
    tree = parents(nodes, id_col, parent_col)
    return tree.join(_missing_parents(tree), "parent", "left_semi").select("node", "parent")


def _climb(tree: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(resolved, stuck): depth of every node that reaches a root, and the jump map of the others.

    A root has no parent or one that does not exist. The loop ends when a round resolves nothing:
    depths along a chain are contiguous, so no finite chain can be left then.
    """
    tree = cut_lineage(tree)
    known = tree.select(F.col("node").alias("parent"), F.lit(True).alias("_known"))
    jumps = cut_lineage(
        salted_lookup(tree, known, "parent", "left").select(
            "node", F.when(F.col("_known"), F.col("parent")).alias("up"), F.lit(1).cast("bigint").alias("steps")
        )
    )
    left = jumps.where("up IS NOT NULL").count()
    while left:
        target = jumps.select(
            F.col("node").alias("up"), F.col("up").alias("_up"), F.col("steps").alias("_steps")
        )
        moving = salted_lookup(jumps.where("up IS NOT NULL"), target, "up", "inner").select(
            "node", F.col("_up").alias("up"), (F.col("steps") + F.col("_steps")).alias("steps")
        )
        jumps = cut_lineage(jumps.where("up IS NULL").unionByName(moving))
        now = jumps.where("up IS NOT NULL").count()
        if now == left:
            break
        left = now
    return (
        jumps.where("up IS NULL").select("node", F.col("steps").alias("depth")),
        jumps.where("up IS NOT NULL").select("node", "up"),
    )


def facts(nodes: DataFrame, id_col: str = "id", parent_col: str = "parent_id") -> DataFrame:
    """(node, parent, depth, broken, cyclic) of every node, from a single climb.

    ``depth`` is 1 for a root and NULL on a cycle and below one; ``broken`` marks a parent that
    does not exist; ``cyclic`` marks members of a cycle, not nodes that merely lead into one.
    """
    tree = cut_lineage(parents(nodes, id_col, parent_col))
    resolved, stuck = _climb(tree)
    known = resolved.unionByName(stuck.select("node", F.lit(None).cast("bigint").alias("depth")))
    missing = _missing_parents(tree).withColumn("broken", F.lit(True))
    members = _members(stuck).withColumn("cyclic", F.lit(True))
    return (
        tree.join(known, "node")
        .join(members, "node", "left")
        .join(missing, "parent", "left")
        .select(
            "node",
            "parent",
            "depth",
            F.coalesce("broken", F.lit(False)).alias("broken"),
            F.coalesce("cyclic", F.lit(False)).alias("cyclic"),
        )
    )


def depths(nodes: DataFrame, id_col: str = "id", parent_col: str = "parent_id") -> DataFrame:
    """Depth of every node, 1 for a root; NULL on a cycle and below one."""
    resolved, stuck = _climb(parents(nodes, id_col, parent_col))
    return resolved.unionByName(stuck.select("node", F.lit(None).cast("bigint").alias("depth")))


def deepest(nodes: DataFrame, id_col: str = "id", parent_col: str = "parent_id") -> DataFrame:
    """The deepest node (smallest id on a tie) and its depth."""
    return (
        depths(nodes, id_col, parent_col)
        .where("depth IS NOT NULL")
        .orderBy(F.desc("depth"), "node")
        .limit(1)
    )


def cycle_members(nodes: DataFrame, id_col: str = "id", parent_col: str = "parent_id") -> DataFrame:
    """Nodes that lie on a cycle, not those that merely lead into one."""
    return _members(_climb(parents(nodes, id_col, parent_col))[1])


def _members(jumps: DataFrame) -> DataFrame:
    """On nodes that never reach a root, the images of a jump shrink to the cycles; doubling the
    jump until the image stops shrinking leaves exactly the members."""
    image = cut_lineage(jumps.select(F.col("up").alias("node")).distinct())
    size = image.count()
    while size:
        target = jumps.select(F.col("node").alias("up"), F.col("up").alias("_up"))
        jumps = cut_lineage(salted_lookup(jumps, target, "up", "inner").select("node", F.col("_up").alias("up")))
        image = cut_lineage(jumps.select(F.col("up").alias("node")).distinct())
        now = image.count()
        if now == size:
            break
        size = now
    return image


def ancestors(
    nodes: DataFrame, levels: int = 5, id_col: str = "id", parent_col: str = "parent_id"
) -> DataFrame:
    """(node, ancestor, level) for up to ``levels`` levels up; edges are never walked twice."""
    tree = cut_lineage(parents(nodes, id_col, parent_col))
    known = tree.select(F.col("node").alias("ancestor"), F.col("parent").alias("_next"))
    step = tree.where("parent IS NOT NULL").select(
        "node", F.col("parent").alias("ancestor"), F.array("node").alias("_seen")
    )
    out = None
    for level in range(1, levels + 1):
        step = cut_lineage(salted_lookup(step, known, "ancestor"))
        found = step.select("node", "ancestor", F.lit(level).alias("level"))
        out = found if out is None else out.unionByName(found)
        # an edge is named by its lower end: a walk may return to a node but not leave it twice
        step = step.where(F.col("_next").isNotNull() & ~F.array_contains("_seen", F.col("ancestor"))).select(
            "node",
            F.col("_next").alias("ancestor"),
            F.array_append("_seen", F.col("ancestor")).alias("_seen"),
        )
    return out


def _ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``rank``, 0 to n - 1 by ``order`` over the whole table: range partitions and the rows before each."""
    ids = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_id", 33).alias("_part")
    sizes = ids.groupBy(part).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row per partition
    offsets = sizes.select("_part", (before - F.col("_first")).alias("_shift"))
    return ids.withColumn("_part", part).join(F.broadcast(offsets), "_part").select(*rows.columns, (F.col("_id") + F.col("_shift")).alias("rank"))


def intervals(nodes: DataFrame, id_col: str = "id", parent_col: str = "parent_id") -> DataFrame:
    """(node, depth, first, last): the subtree of a node is the nodes whose ``first`` lies between its ``first`` and ``last``.

    ``first`` is the place in the preorder of the forest, 1 to n, siblings and roots by id. Nodes on a cycle and below one have no
    interval and are left out. An Euler tour is a list with two entries per node, entered and left; pointer doubling finds for
    every entry how many nodes are entered from there to the end, in log2(2 n) joins whatever the depth. The next sibling is
    the next row of the whole table in the order of parents, so children of one parent, however many, share no task.
    """
    tree = cut_lineage(parents(nodes, id_col, parent_col))
    resolved = cut_lineage(_climb(tree)[0])
    known = resolved.select(F.col("node").alias("parent"), F.lit(True).alias("_known"))
    kept = tree.join(resolved, "node")
    up = cut_lineage(salted_lookup(kept, known, "parent", "left").select("node", "depth", F.when(F.col("_known"), F.col("parent")).alias("parent")))
    ranked = cut_lineage(_ranked(up, "parent", "node"))
    following = ranked.select((F.col("rank") - 1).alias("rank"), F.col("node").alias("_next"), F.struct("parent").alias("_of"))
    sibling = F.when(F.struct("parent").eqNullSafe(F.col("_of")), F.col("_next"))
    family = ranked.join(following, "rank", "left").select("node", "depth", "parent", sibling.alias("sibling"))
    children = up.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.min("node").alias("child"))
    family = cut_lineage(family.join(children, "node", "left"))
    entry = lambda node, left: F.when(node.isNotNull(), F.struct(node.alias("node"), F.lit(left).alias("left")))
    entered = entry(F.col("node"), False), F.coalesce(entry(F.col("child"), False), entry(F.col("node"), True)), F.lit(1).cast("bigint")
    leaving = entry(F.col("node"), True), F.coalesce(entry(F.col("sibling"), False), entry(F.col("parent"), True)), F.lit(0).cast("bigint")
    both = F.array(*[F.struct(at.alias("at"), to.alias("to"), n.alias("n")) for at, to, n in (entered, leaving)])
    tour = cut_lineage(family.select(F.explode(both).alias("x")).select("x.*"))
    open_ = tour.where("to IS NOT NULL").count()
    while open_:
        ahead = tour.select(F.col("at").alias("to"), F.col("to").alias("_to"), F.col("n").alias("_n"))
        # every entry is pointed at by one other at most, so no key is hot
        moved = tour.where("to IS NOT NULL").join(ahead, "to").select("at", F.col("_to").alias("to"), (F.col("n") + F.col("_n")).alias("n"))
        tour = cut_lineage(tour.where("to IS NULL").unionByName(moved), "tour")
        open_ = tour.where("to IS NOT NULL").count()
    here = F.col("at.left")
    ends = tour.groupBy(F.col("at.node").alias("node")).agg(F.max(F.when(~here, F.col("n"))).alias("_in"), F.max(F.when(here, F.col("n"))).alias("_out"))
    total = F.lit(resolved.count())
    return ends.join(resolved, "node").select("node", "depth", (total - F.col("_in") + 1).alias("first"), (total - F.col("_out")).alias("last"))


def rollup(labels: DataFrame, weights: DataFrame, block: int = 1 << 16) -> DataFrame:
    """(node, nodes, total): size of every subtree and the sum of ``weights`` (node, weight: bigint) over it, itself included.

    ``labels`` are :func:`intervals`. Running sums along ``first`` are made by blocks of bounded size; a subtree is the
    difference of two of them, found by two equi-joins.
    """
    weight = weights.groupBy("node").agg(F.sum("weight").alias("weight"))
    rows = cut_lineage(labels.join(weight, "node", "left").select("node", "first", "last", F.coalesce("weight", F.lit(0).cast("bigint")).alias("weight")))
    in_block = F.shiftright(F.col("first"), block.bit_length() - 1).alias("_block")
    sums = rows.groupBy(in_block).agg(F.sum("weight").alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))  # one row per block
    inside = F.sum("weight").over(Window.partitionBy("_block").orderBy("first"))
    running = rows.withColumn("_block", in_block).withColumn("_inside", inside).join(sums.select("_block", before.alias("_before")), "_block")
    running = cut_lineage(running.select("first", "weight", (F.col("_before") + F.col("_inside")).alias("running")))
    upto = running.select(F.col("first").alias("last"), F.col("running").alias("_upto"))
    start = running.select("first", (F.col("running") - F.col("weight")).alias("_start"))
    return rows.join(upto, "last").join(start, "first").select("node", (F.col("last") - F.col("first") + 1).alias("nodes"), (F.col("_upto") - F.col("_start")).alias("total"))
