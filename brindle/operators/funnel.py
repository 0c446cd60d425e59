"""Counts of reads along the stages of a pipeline, as shares of parent, base and root."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.folder import removed, written


def depths(levels: list[tuple[str, str | None, str | None]]) -> list[tuple[str, str | None, str | None, str, int]]:
    """(level, parent, base, root, depth) of levels (level, parent, base)."""
    parent = {level: up for level, up, _ in levels}
    out = []
    for level, up, base in levels:
        at, depth = level, 0
        while parent.get(at) is not None:
            at, depth = parent[at], depth + 1
            if depth > len(levels):
                raise ValueError(f"{level} has itself for an ancestor")
        out.append((level, up, base, at, depth))
    return out


def closure(tree: DataFrame, node: str = "level", parent: str = "parent") -> DataFrame:
    """(node, root, depth) of a parent table of any size; a node without a parent, or with one that is no node, is a root.

    Each round every node takes its present ancestor's ancestor, so a depth of d takes about log2 d joins. Nodes must be distinct
    and not null; one that is its own ancestor is an error.
    """
    nodes = tree.select(F.col(node).alias("node"), F.col(parent).alias("up"))
    known = nodes.select(F.col("node").alias("up"))
    first = nodes.join(known.withColumn("known", F.lit(1)), "up", "left")
    at = written(first.select("node", F.when(F.col("known").isNotNull(), F.col("up")).otherwise(F.col("node")).alias("root"), F.when(F.col("known").isNotNull(), 1).otherwise(0).cast("long").alias("depth")), "closure")
    total, rounds = at.count(), 0
    while True:
        above = at.select(F.col("node").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        after = written(at.join(above, "root").select("node", F.col("next").alias("root"), (F.col("depth") + F.col("more")).alias("depth")), "closure")
        moved = after.agg(F.sum("depth")).first()[0] != at.agg(F.sum("depth")).first()[0]
        removed(at)
        at, rounds = after, rounds + 1
        if not moved:
            return at.select(F.col("node").alias(node), "root", "depth")
        if 2 ** (rounds - 1) > total:
            raise ValueError("a node is its own ancestor")


def funnel(counts: DataFrame, levels: list[tuple[str, str | None, str | None]]) -> DataFrame:
    """(sample, level, depth, n, frac_parent, frac_base, frac_root) of counts (sample, level, n); roots have no shares."""
    spark = counts.sparkSession
    tree = F.broadcast(spark.createDataFrame(depths(levels), "level string, parent string, base string, root string, depth int"))
    out = counts.join(tree, "level")
    for kind in ("parent", "base", "root"):
        other = counts.select("sample", F.col("level").alias(kind), F.col("n").alias(f"n_{kind}"))
        out = out.join(other, ["sample", kind], "left")
        share = F.round(F.col("n") / F.nullif(F.col(f"n_{kind}"), F.lit(0)), 6)
        out = out.withColumn(f"frac_{kind}", F.when(F.col("parent").isNotNull(), share) if kind == "root" else share)
    return out.select("sample", "level", "depth", "n", "frac_parent", "frac_base", "frac_root")


def tree_text(rows: list, levels: list[tuple[str, str | None, str | None]]) -> str:
    """Lines of collected funnel rows of one sample, indented by depth."""
    by = {r["level"]: r for r in rows}
    show = lambda x: "-" if x is None else format(x, ".3g")
    return "\n".join(f"{'  ' * depth}{level}\t{by[level]['n']}\t{show(by[level]['frac_parent'])}\t{show(by[level]['frac_root'])}" for level, _, _, _, depth in depths(levels) if level in by)


def write_funnel(rows: DataFrame, path: str) -> None:
    """Funnel rows as one CSV file, by sample, depth and level."""
    rows.coalesce(1).sortWithinPartitions("sample", "depth", "level").write.csv(path, header=True)


def write_counts(counts: DataFrame, path: str) -> None:
    """The raw counts (level, path, count) that a funnel is made of, as one CSV file."""
    counts.select("level", "path", "count").coalesce(1).sortWithinPartitions("level", "path").write.csv(path, header=True)


def chunks(rows: DataFrame, n: int, index: str = "idx", count: int | None = None) -> DataFrame:
    """rows (with a gapless index from 0) with chunk: n contiguous parts of ceil(count / n), or where that makes fewer, of the floor with the rest in the last."""
    total = rows.count() if count is None else count
    if total < n:
        raise ValueError("fewer rows than chunks")
    size = -(-total // n)
    if -(-total // size) != n:
        size = total // n
    return rows.withColumn("chunk", F.least(F.expr(f"{index} div {size}"), F.lit(n - 1)))
