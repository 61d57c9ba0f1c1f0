"""Parent-child links to full hierarchies (problem 3).

Subtree sizes are summed upward, preorder ranges of siblings are allocated
downward by prefix sums, and a node's descendants are the nodes of its range
(nested set). The pass downward places a node below its ancestors: it gives the
range, the root and the depth. Both passes double the distance covered in each
round, so a chain of depth d takes log2(d) rounds instead of d. Nodes that have
not reached a root when the number of open nodes stops falling are on or under a cycle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.session import cut, table

#: Siblings are ranked in blocks of so many ids, so one huge family is no single task.
SIBLING_BLOCK = 4096


def _round(df: DataFrame) -> tuple[DataFrame, int]:
    """The state of a round with its lineage cut, and how many nodes are open, counted as it is written."""
    seen = Observation()
    state = cut(df.observe(seen, F.count_if(F.col("ptr").isNotNull()).alias("open")))
    return state, seen.get["open"]


def _upward(nodes: DataFrame) -> DataFrame:
    """node, parent -> plus ptr (null: reached a root), size, low.

    After k rounds ptr is the 2**k-th ancestor, size counts the descendants
    nearer than 2**k and low is the least id of the 2**k nodes from here up.
    """
    start = nodes.select("node", "parent", F.col("parent").alias("ptr"), F.lit(1).cast("long").alias("size"), F.least("node", F.coalesce("parent", "node")).alias("low"))
    state, left = _round(start)
    reach, cyclic = 1, None
    while left:
        far = state.select(F.col("node").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("low").alias("low2"))
        moved = state.join(far, "ptr", "left").select("node", "parent", F.col("ptr2").alias("ptr"), "size", F.least("low", F.coalesce("low2", "low")).alias("low"))
        # what a node hands up is added to its 2**k-th ancestor; sums are formed before they are sent
        sent = state.where("ptr is not null").groupBy(F.col("ptr").alias("node")).agg(F.sum("size").alias("more"))
        state, now = _round(moved.join(sent, "node", "left").select("node", "parent", "ptr", (F.col("size") + F.coalesce("more", F.lit(0))).alias("size"), "low"))
        reach *= 2
        before, left = left, now
        # no node has a depth from reach / 2 to reach: all that are open end in cycles
        if cyclic is None and left == before:
            cyclic = left
        if cyclic is not None and reach >= cyclic:
            break
    return state


def _downward(nodes: DataFrame, paths: bool) -> DataFrame:
    """node, parent, size (acyclic) -> node, root, depth, pre and, if asked for, path."""
    block = F.shiftright("node", SIBLING_BLOCK.bit_length() - 1)
    kids = nodes.where("parent is not null").withColumn("block", block)
    inside = Window.partitionBy("parent", "block").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("parent").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = kids.groupBy("parent", "block").agg(F.sum("size").alias("sum")).select("parent", "block", F.coalesce(F.sum("sum").over(across), F.lit(0)).alias("earlier"))
    zero = F.lit(0).cast("long")
    kids = kids.withColumn("inside", F.coalesce(F.sum("size").over(inside), zero)).join(blocks, ["parent", "block"])
    path = [F.array("title").alias("path")] if paths else []
    start = kids.select("node", F.col("parent").alias("ptr"), F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth"), (F.col("inside") + F.col("earlier") + 1).alias("pre"), *path)
    roots = nodes.where("parent is null").select("node", F.col("parent").alias("ptr"), F.col("node").alias("root"), zero.alias("depth"), zero.alias("pre"), *path)
    state, left = _round(start.unionByName(roots))
    while left:
        far = state.select(*[F.col(c).alias("ptr" if c == "node" else f"{c}2") for c in state.columns])
        longer = [F.when(F.col("ptr").isNull(), F.col("path")).otherwise(F.concat("path2", "path")).alias("path")] if paths else []
        summed = [(F.col(c) + F.coalesce(f"{c}2", zero)).alias(c) for c in ("depth", "pre")]
        state, left = _round(state.join(far, "ptr", "left").select("node", F.col("ptr2").alias("ptr"), F.coalesce("root2", "root").alias("root"), *summed, *longer))
    return state.drop("ptr")


def hierarchy(nodes: DataFrame, edges: DataFrame, paths: bool = True) -> DataFrame:
    """One row for each node: node_id, parent_id, root_id, depth, pre, n_descendants, in_cycle[, path].

    nodes: id bigint, title. edges: child bigint, parent bigint.

    Within a root, the descendants of a node are the nodes whose pre is in
    (pre, pre + n_descendants]. On or under a cycle depth is -1, root_id the
    smallest id on that cycle, and pre, n_descendants and path are null. Of
    several parents the smallest id counts, of several titles the smallest;
    a parent that is no node is none; null ids are left out; a node that is its
    own parent is a cycle of one. No nodes give no rows.
    """
    nodes = nodes.select("id", "title").where("id is not null").groupBy(F.col("id").cast("long").alias("node")).agg(F.min("title").alias("title"))
    edges = edges.select("child", "parent").where("child is not null and parent is not null").distinct()
    known = edges.join(nodes.select(F.col("node").alias("parent")), "parent", "left_semi").groupBy(F.col("child").alias("node")).agg(F.min("parent").cast("long").alias("parent"))
    base = cut(nodes.join(known, "node", "left"))
    up = _upward(base.drop("title"))
    tree = up.where("ptr is null").join(base.select("node", "title"), "node")
    down = _downward(tree, paths)
    path = ["path"] if paths else []
    free = tree.select("node", "parent", "size").join(down, "node").select("node", "parent", "root", "depth", "pre", (F.col("size") - 1).alias("n_descendants"), F.lit(False).alias("in_cycle"), *path)
    # ptr of a cyclic node lies on its cycle, and low of that node is the least id there
    stuck = up.where("ptr is not null")
    low = stuck.select(F.col("node").alias("ptr"), F.col("low").alias("root2"))
    none = [F.lit(None).cast("long").alias(c) for c in ("pre", "n_descendants")]
    stuck = stuck.join(low, "ptr").select("node", "parent", F.col("root2").alias("root"), F.lit(-1).cast("long").alias("depth"), *none, F.lit(True).alias("in_cycle"), *([F.lit(None).cast("array<string>").alias("path")] if paths else []))
    both = free.unionByName(stuck)
    return both.select(F.col("node").alias("node_id"), F.col("parent").alias("parent_id"), F.col("root").alias("root_id"), F.col("depth").cast("int").alias("depth"), "pre", "n_descendants", "in_cycle", *path)


def descendants(tree: DataFrame) -> DataFrame:
    """(node_id, descendant_id, steps): each node's nested-set range joined with the nodes in it.

    Ranges are cut into blocks before they are opened, so no row holds a whole range.
    """
    tree = tree.where("not in_cycle").select("node_id", "root_id", "depth", "pre", "n_descendants")
    block = 1024
    start = F.sequence(F.col("pre") + 1, F.col("pre") + F.col("n_descendants"), F.lit(block))
    ranges = tree.where("n_descendants > 0").select("node_id", "root_id", F.col("depth").alias("top"), (F.col("pre") + F.col("n_descendants")).alias("last"), F.explode(start).alias("first"))
    places = ranges.select("node_id", "root_id", "top", F.explode(F.sequence("first", F.least(F.col("first") + block - 1, F.col("last")))).alias("pre"))
    below = tree.select("root_id", "pre", F.col("node_id").alias("descendant_id"), "depth")
    return places.join(below, ["root_id", "pre"]).select("node_id", "descendant_id", (F.col("depth") - F.col("top")).alias("steps"))


def categories(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The nodes (targets) and edges (subcategory links of their category pages)."""
    targets = table(spark, sf_dir, "targets").select("id", "title")
    pages = table(spark, sf_dir, "pages").where("category_key is not null").select(F.col("id").alias("from_id"), F.col("category_key").alias("title")).distinct()
    links = table(spark, sf_dir, "links").where("kind = 1 and target is not null").select("from_id", F.col("target").alias("parent")).distinct()
    child = targets.distinct().join(pages, "title").select(F.col("id").alias("child"), "from_id")
    return targets, child.join(links, "from_id").select("child", "parent")


def category_tree(spark: SparkSession, sf_dir: str, paths: bool = True) -> DataFrame:
    return hierarchy(*categories(spark, sf_dir), paths=paths)


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_tree(spark, sf_dir, paths=False).where("parent_id is not null").select("node_id", "root_id", "depth")
