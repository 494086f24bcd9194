"""Walks over parent links and dependency edges, level by level.

Each level is one join of the frontier with the edge table, checkpointed to the shared folder, so the
plan stays flat and a lost executor does not replay earlier levels.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.session import cut_lineage


def _together(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def hierarchy_paths(nodes: DataFrame, node: str, parent: str, name: str, sep: str = " > ") -> DataFrame:
    """Every node reachable from a root (NULL parent) with its path of names and its depth."""
    base = nodes.select(node, name, parent)
    level = cut_lineage(
        base.filter(F.col(parent).isNull()).withColumns({"full_path": F.col(name).cast("string"), "depth": F.lit(0)})
    )
    done = []
    while not level.isEmpty():
        done.append(level)
        above = level.select(
            F.col(node).alias(parent), F.col("full_path").alias("__path"), F.col("depth").alias("__depth")
        )
        level = cut_lineage(
            base.join(above, parent).select(
                node, name, parent,
                F.concat_ws(sep, "__path", F.col(name)).alias("full_path"), (F.col("__depth") + 1).alias("depth"),
            )
        )
    return _together(done) if done else level


def descendants(nodes: DataFrame, node: str, parent: str, root) -> DataFrame:
    """The node ``root`` and everything below it. A node is visited once, so cycles end."""
    reached = cut_lineage(nodes.filter(F.col(node) == root))
    level, done = reached, [reached]
    while not level.isEmpty():
        above = level.select(F.col(node).alias(parent))
        seen = _together(done).select(node)
        level = cut_lineage(nodes.join(above, parent, "left_semi").join(seen, node, "left_anti"))
        done.append(level)
    return _together(done)


def downstream_impact(
    edges: DataFrame, source: str, target: str, kind: str, start, max_depth: int = 10
) -> DataFrame:
    """Everything downstream of ``start``: hops, one shortest path, and the kinds of the edges that lead in.

    The result is what listing all cycle-free paths of at most ``max_depth`` edges gives, without listing
    them: a breadth-first walk keeps one shortest path per node (the smallest one in text order). An edge
    counts when its source can be reached without passing its target. For edges that do not lead back
    up this holds by itself; for the others a walk that avoids the target decides.
    """
    links = edges.select(F.col(source).alias("s"), F.col(target).alias("t"), F.col(kind).alias("kind")).distinct()
    links = cut_lineage(links)
    onward = links.filter((F.col("s") != F.col("t")) & (F.col("t") != start))
    origin = F.lit(start).cast(links.schema["s"].dataType)
    level = cut_lineage(
        links.filter(F.col("s") == start).select("s").distinct()
        .select(origin.alias("n"), F.lit(0).alias("hops"), F.array(origin.cast("string")).alias("path"))
    )
    done = [level]
    for depth in range(1, max_depth + 1):
        seen = _together(done).select("n")
        step = (
            level.join(onward, F.col("n") == F.col("s"))
            .select(F.col("t").alias("n"), F.array_append("path", F.col("t").cast("string")).alias("path"))
            .join(seen, "n", "left_anti")
            .groupBy("n").agg(F.min("path").alias("path"))
            .select("n", F.lit(depth).alias("hops"), "path")
        )
        level = cut_lineage(step)
        if level.isEmpty():
            break
        done.append(level)
    reached = cut_lineage(_together(done))

    from_ = reached.select(F.col("n").alias("s"), F.col("hops").alias("hs"))
    to = reached.select(F.col("n").alias("t"), F.col("hops").alias("ht"))
    inner = onward.join(from_, "s").join(to, "t").filter(F.col("hs") < max_depth)
    certain = inner.filter(F.col("hs") <= F.col("ht")).select("t", "kind")
    doubtful = cut_lineage(inner.filter(F.col("hs") > F.col("ht")).select("s", "t", "kind"))
    kinds = certain.unionByName(_reached_without(doubtful, onward, start, max_depth))
    own = links.filter((F.col("s") == start) & (F.col("t") == start))
    kinds = kinds.unionByName(own.select("t", "kind")).distinct()
    found = reached.filter(F.col("hops") > 0).unionByName(
        own.select(F.col("t").alias("n"), F.lit(1).alias("hops"), F.array(*[F.lit(start).cast("string")] * 2).alias("path"))
        .distinct()
    )
    per_node = kinds.groupBy(F.col("t").alias("n")).agg(
        F.concat_ws(",", F.array_sort(F.collect_set("kind"))).alias("transform_types")
    )
    return found.join(per_node, "n", "left").select(
        F.col("n").alias("affected"), F.col("hops").alias("hops_from_source"),
        F.concat_ws(">", "path").alias("dependency_path"), "transform_types",
    )


def _reached_without(doubtful: DataFrame, onward: DataFrame, start, max_depth: int) -> DataFrame:
    """Those edges (s, t) whose source can be reached in fewer than ``max_depth`` steps without passing t."""
    if doubtful.isEmpty():
        return doubtful.select("t", "kind")
    start_type = onward.schema["s"].dataType
    level = cut_lineage(
        doubtful.select(F.col("t").alias("avoid")).distinct().withColumn("n", F.lit(start).cast(start_type))
    )
    done = [level]
    for _ in range(1, max_depth):
        seen = _together(done)
        level = cut_lineage(
            level.join(onward.select("s", "t"), F.col("n") == F.col("s"))
            .filter(F.col("t") != F.col("avoid")).select("avoid", F.col("t").alias("n")).distinct()
            .join(seen, ["avoid", "n"], "left_anti")
        )
        if level.isEmpty():
            break
        done.append(level)
    walked = _together(done).select(F.col("avoid").alias("t"), F.col("n").alias("s"))
    return doubtful.join(walked, ["s", "t"], "left_semi").select("t", "kind")
