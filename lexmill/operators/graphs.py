"""References between templates and modules: edges, closure, components, reach."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import cut
from lexmill.wikitext import expand

#: Most redirects that are followed from one title.
MAX_HOPS = 32
#: Hops of one job; a job's plan and its repeated work grow with them.
STEPS = 4


def references(pages: DataFrame, key: list[str], body: str, included: bool = False) -> DataFrame:
    """key, kind, target, dynamic_template, dynamic_module: one row per reference; a page
    with none but a dynamic name has one row with a null target."""
    schema = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in key)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for *k, text in pdf[[*key, body]].itertuples(index=False, name=None):
                if text is None or "{{" not in text:
                    continue
                found = expand.references(text, included=included)
                flags = (found["dynamic_template"], found["dynamic_module"])
                rows += [(*k, kind, target, *flags) for kind, target in found["refs"]] or ([(*k, None, None, *flags)] if any(flags) else [])
            yield pd.DataFrame(rows, columns=[*key, "kind", "target", "dynamic_template", "dynamic_module"])

    return pages.select(*key, body).mapInPandas(run, f"{schema}, kind string, target string, dynamic_template boolean, dynamic_module boolean")


def reachable(edges: DataFrame, roots: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """(node, hops): all nodes that can be reached from the roots, and how near they are.

    edges: src, dst; null ends are no edges. A job expands the frontier by STEPS
    hops, so long chains need fewer jobs; only the last layer is the next frontier.
    """
    edges = cut(edges.select("src", "dst").where("src is not null and dst is not null").distinct())
    seen = cut(roots.select(F.col(roots.columns[0]).alias("node")).where("node is not null").distinct().withColumn("hops", F.lit(0)))
    frontier, hops = seen.select("node"), 0
    while max_rounds is None or hops < max_rounds:
        steps = STEPS if max_rounds is None else min(STEPS, max_rounds - hops)
        layers = None
        for step in range(1, steps + 1):
            frontier = frontier.join(edges, frontier["node"] == edges["src"]).select(F.col("dst").alias("node")).distinct()
            layer = frontier.withColumn("hops", F.lit(hops + step))
            layers = layer if layers is None else layers.unionByName(layer)
        hops += steps
        new = cut(layers.groupBy("node").agg(F.min("hops").alias("hops")).join(seen, "node", "left_anti"))
        if new.isEmpty():
            break
        seen = cut(seen.unionByName(new))
        frontier = new.where(F.col("hops") == hops).select("node")
    return seen


def follow(moves: DataFrame, starts: DataFrame, max_hops: int = MAX_HOPS) -> DataFrame:
    """(start, node, hops, loop): where each start ends by following moves (src, dst).

    The distance doubles in each round. More than max_hops is a loop; of several
    moves from a title the least one counts.
    """
    step = cut(moves.where("src is not null and dst is not null").groupBy("src").agg(F.min("dst").alias("dst")).withColumn("n", F.lit(1).cast("long")))
    rounds = max_hops.bit_length()
    for _ in range(rounds):
        onward = step.select(F.col("src").alias("dst"), F.col("dst").alias("dst2"), F.col("n").alias("n2"))
        step = cut(step.join(onward, "dst", "left").select("src", F.coalesce("dst2", "dst").alias("dst"), (F.col("n") + F.coalesce("n2", F.lit(0))).alias("n")))
    begun = starts.select(F.col(starts.columns[0]).alias("start")).distinct()
    out = begun.join(step, begun["start"] == step["src"], "left")
    loop = F.coalesce(F.col("n") > max_hops, F.lit(False))
    return out.select("start", F.when(~loop, F.coalesce("dst", "start")).alias("node"), F.when(~loop, F.coalesce("n", F.lit(0))).cast("int").alias("hops"), loop.alias("loop"))


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component): strongly connected components, named by their least node.

    Nodes without an incoming or outgoing edge are components of their own and
    are trimmed; of the rest, forward and backward least labels spread until
    they are stable, and nodes with both labels equal to one pivot make its
    component. Rounds follow the depth of the cyclic part, not of the graph.
    """
    edges = cut(edges.select("src", "dst").where("src <> dst").distinct())
    left = cut(nodes.select(F.col(nodes.columns[0]).alias("node")).where("node is not null").distinct())
    done = None
    while True:
        edges = edges.join(left.select(F.col("node").alias("src")), "src", "left_semi").join(left.select(F.col("node").alias("dst")), "dst", "left_semi").select("src", "dst")
        while True:
            for _ in range(STEPS):
                edges = edges.join(edges.select(F.col("dst").alias("src")).distinct(), "src", "left_semi").join(edges.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi").select("src", "dst")
            edges = cut(edges)
            both = edges.select(F.col("src").alias("node")).distinct().intersect(edges.select(F.col("dst").alias("node")).distinct())
            single = cut(left.join(both, "node", "left_anti").withColumn("component", F.col("node")))
            if single.isEmpty():
                break
            done = single if done is None else done.unionByName(single)
            left = cut(left.join(single, "node", "left_anti"))
        if left.isEmpty():
            break
        fore, back = _least(edges, left, "src", "dst"), _least(edges, left, "dst", "src")
        # the pivot of a label is the node that carries its own name both ways
        both = fore.withColumnRenamed("label", "f").join(back.withColumnRenamed("label", "b"), "node")
        found = cut(both.where("f = b").select("node", F.col("f").alias("component")))
        done = found if done is None else done.unionByName(found)
        left = cut(left.join(found, "node", "left_anti"))
    empty = nodes.select(F.col(nodes.columns[0]).alias("node"), F.col(nodes.columns[0]).alias("component")).where("false")
    return empty if done is None else done


def _least(edges: DataFrame, nodes: DataFrame, start: str, end: str) -> DataFrame:
    """(node, label): the least node from which each node can be reached."""
    labels = cut(nodes.withColumn("label", F.col("node")))
    while True:
        new = labels
        for _ in range(STEPS):
            sent = edges.join(new, edges[start] == new["node"]).select(F.col(end).alias("node"), "label")
            new = new.unionByName(sent).groupBy("node").agg(F.min("label").alias("label"))
        new = cut(new)
        if new.join(labels, ["node", "label"], "left_anti").isEmpty():
            return new
        labels = new


def reach(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(component, reach): seeds summed along the acyclic graph of components.

    edges: src, dst; seeds: node, value. Values of a component add up, parallel
    edges between components count once, and a source counts once per path.
    Sums stop at the greatest long.
    """
    ends = edges.select(F.col("src").alias("node")).union(edges.select(F.col("dst").alias("node"))).union(seeds.select("node")).distinct()
    parts = cut(components(edges, ends))
    a, b = parts.toDF("src", "a"), parts.toDF("dst", "b")
    links = cut(edges.join(a, "src").join(b, "dst").where("a <> b").select("a", "b").distinct())
    wave = cut(parts.join(seeds, "node", "left").groupBy("component").agg(F.sum(F.coalesce("value", F.lit(0))).cast("decimal(38,0)").alias("value")))
    top = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    total, waves = wave, 0
    while True:
        wave = cut(links.join(wave, links["a"] == wave["component"]).groupBy("b").agg(F.least(F.sum("value"), top).cast("decimal(38,0)").alias("value")).where("value > 0").toDF("component", "value"))
        if wave.isEmpty():
            break
        total, waves = total.unionByName(wave), waves + 1
        if waves % 16 == 0:
            total = cut(total.groupBy("component").agg(F.least(F.sum("value"), top).cast("decimal(38,0)").alias("value")))
    total = total.groupBy("component").agg(F.least(F.sum("value"), top).cast("decimal(38,0)").alias("value"))
    return total.select("component", F.col("value").cast("long").alias("reach"))
