"""Parent-child rows to full hierarchies: hash splitters, walks to the next splitter, a reduced pointer graph."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..runtime import materialize

CYCLE, AMBIGUOUS = "CYCLE", "AMBIGUOUS"


def _splitter(node: Column, every: int) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(every)) == 0


def _store(df: DataFrame, name: str, open_kind: str) -> tuple[DataFrame, int]:
    """df as a written table, and how many of its rows are of open_kind, counted while it is written."""
    seen = Observation()
    out = materialize(df.observe(seen, F.count_if(F.col("kind") == open_kind).alias("n")), name)
    return out, seen.get["n"]


def _double(state: DataFrame, still_open: int, open_kind: str, name: str, limit: int) -> tuple[DataFrame, int]:
    """Pointer doubling: rows of open_kind take over the pointer of the row they point at, until none is open, a round closes none, or it is the limit-th.

    Every node of a walk that ends has a row of its own, so as long as walks that end are open, one of them is within twice the steps made and closes in the next round: if none
    does, all that are left go round. Every round is a written table, so neither lineage nor a lost executor makes it start again."""
    before = None
    for _ in range(limit):
        if not still_open or still_open == before:
            break
        before = still_open
        ahead = state.select(F.col("node").alias("cur"), F.col("cur").alias("_cur"), F.col("dist").alias("_dist"), F.col("kind").alias("_kind"), *([F.col("seg").alias("_seg")] if "seg" in state.columns else []))
        moved = state.where(F.col("kind") == open_kind).join(ahead, "cur").select(
            "node", F.col("_cur").alias("cur"), (F.col("dist") + F.col("_dist")).alias("dist"), F.col("_kind").alias("kind"),
            *([F.concat("seg", "_seg").alias("seg")] if "seg" in state.columns else []),
        )
        state, still_open = _store(state.where(F.col("kind") != open_kind).unionByName(moved), name, open_kind)
    return state, still_open


def resolve_hierarchy(edges: DataFrame, *, parent: str = "parent", child: str = "child", every: int = 8, walk_rounds: int = 7, paths: bool = False) -> DataFrame:
    """For each child: root, depth and, with paths, the nodes from the child up to its root.

    Deterministic splitters are the nodes whose hash is divisible by every. Each node walks to its next splitter or to
    the end of its chain, by at most 2**walk_rounds steps; walks that met no splitter by then are solved by themselves (long
    splitterless stretches end, splitterless cycles don't). The splitters, about 1/every of the nodes, form the reduced pointer
    graph, which is solved the same way; node and splitter results are then put together.

    root is the node without parent at the end; AMBIGUOUS if a node with several parents comes first (the child itself included), or CYCLE
    if a node comes twice, both with depth -1 and a null path. Edges with a null end are ignored, repeated edges count once, an edge from a
    node to itself is a cycle, no edges give no rows; other columns are ignored.
    Result: (node, root, depth[, path]).
    """
    e = edges.select(F.col(child).alias("node"), F.col(parent).alias("up")).where("node is not null and up is not null").distinct()
    up = materialize(e.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("up").alias("up")), "hierarchy-up")
    single, several = up.where("n = 1"), up.where("n > 1").select("node")
    n_nodes = up.count()
    ahead = up.select(F.col("node").alias("up"), F.col("n").alias("_n"))
    kind = F.when(F.col("_n").isNull(), "T").when(F.col("_n") > 1, "A").when(_splitter(F.col("up"), every), "S").otherwise("I")
    start = single.join(ahead, "up", "left").select("node", F.col("up").alias("cur"), F.lit(1).cast("bigint").alias("dist"), kind.alias("kind"), *([F.array("up").alias("seg")] if paths else []))
    state, left = _store(start, "hierarchy-walk", "I")
    state, left = _double(state, left, "I", "hierarchy-walk", walk_rounds)
    if left:  # no splitter within 2**walk_rounds steps: these point only at each other or at solved nodes
        state, left = _double(state, left, "I", "hierarchy-rest", math.ceil(math.log2(n_nodes + 1)) + 1)
        state = state.withColumn("kind", F.when(F.col("kind") == "I", "C").otherwise(F.col("kind")))
    reduced, left = _store(state.where(_splitter(F.col("node"), every)), "hierarchy-reduced", "S")
    if left:
        reduced, left = _double(reduced, left, "S", "hierarchy-reduced", math.ceil(math.log2(reduced.count() + 1)) + 1)
    solved = reduced.select(F.col("node").alias("cur"), F.col("cur").alias("_cur"), F.col("dist").alias("_dist"), F.when(F.col("kind") == "S", "C").otherwise(F.col("kind")).alias("_kind"), *([F.col("seg").alias("_seg")] if paths else []))
    ends = state.where("kind <> 'S'").select("node", "cur", "dist", "kind", *(["seg"] if paths else []))
    via = state.where("kind = 'S'").join(solved, "cur").select("node", F.col("_cur").alias("cur"), (F.col("dist") + F.col("_dist")).alias("dist"), F.col("_kind").alias("kind"), *([F.concat("seg", "_seg").alias("seg")] if paths else []))
    ok = F.col("kind") == "T"
    root = F.when(ok, F.col("cur")).when(F.col("kind") == "A", AMBIGUOUS).otherwise(CYCLE)
    out = ends.unionByName(via).select("node", root.alias("root"), F.when(ok, F.col("dist")).otherwise(-1).cast("int").alias("depth"), *([F.when(ok, F.concat(F.array("node"), "seg")).alias("path")] if paths else []))
    amb = several.select("node", F.lit(AMBIGUOUS).alias("root"), F.lit(-1).alias("depth"), *([F.lit(None).cast("array<string>").alias("path")] if paths else []))
    return out.unionByName(amb)


def descendants(resolved: DataFrame) -> DataFrame:
    """(node, descendant, distance) of every node above another on a resolved path; as many rows as the paths have steps."""
    return resolved.where("path is not null").select(F.col("node").alias("descendant"), F.posexplode("path").alias("distance", "node")).where("distance > 0").select("node", "descendant", "distance")
