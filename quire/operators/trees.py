"""Hierarchies kept as adjacency lists."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def _settled(df: DataFrame) -> DataFrame:
    """``df`` kept in the shared checkpoint folder, so that rounds neither recompute each other nor depend on executors."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        where = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not where:
            if not context.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            where = tempfile.mkdtemp(prefix="quire-")
            atexit.register(shutil.rmtree, where, ignore_errors=True)
        context.setCheckpointDir(where)
    return df.checkpoint()


def ancestors(nodes: DataFrame) -> DataFrame:
    """``node, ancestor, depth`` from (id, parent): every ancestor that exists; a walk ends at a cycle.

    Each round doubles the depth that is known: pairs of the greatest depth so far are joined with all pairs, and pairs met
    before, which only a cycle brings back, are dropped. So the rounds grow with the logarithm of the depth.
    """
    edges = nodes.where("parent IS NOT NULL AND parent <> id").select("id", "parent")
    up = edges.select(F.col("id").alias("node"), F.col("parent").alias("ancestor"), F.lit(1).cast("long").alias("depth"))
    known = _settled(up.join(nodes.select(F.col("id").alias("ancestor")), "ancestor", "left_semi").select("node", "ancestor", "depth"))
    reach = 1
    while True:
        last = known.where(F.col("depth") == reach)
        further = last.join(known.toDF("ancestor", "next", "more"), "ancestor").select("node", F.col("next").alias("ancestor"), (F.col("depth") + F.col("more")).alias("depth"))
        further = _settled(further.where("node <> ancestor").join(known, ["node", "ancestor"], "left_anti").groupBy("node", "ancestor").agg(F.min("depth").alias("depth")))
        if further.isEmpty():
            return known.select("node", "ancestor", F.col("depth").cast("int").alias("depth"))
        known, reach = _settled(known.unionByName(further)), 2 * reach


def lowest_groups(nodes: DataFrame) -> DataFrame:
    """Nodes that are containers of leaves: issues, and volumes without an issue below them. ``nodes``: id, parent, type."""
    issues = nodes.where("type = 'issue'").select("id")
    above = ancestors(nodes).join(issues.withColumnRenamed("id", "node"), "node", "left_semi").select(F.col("ancestor").alias("id")).distinct()
    volumes = nodes.where("type = 'volume'").select("id").join(above, "id", "left_anti")
    return issues.union(volumes)


def outline(nodes: DataFrame, included: Column) -> DataFrame:
    """``id, level, path``: included nodes with the number of included nodes above them; children of others move up.
    ``path`` sorts in pre-order (positions of the node and its ancestors). ``nodes``: id, parent, position."""
    marked = nodes.select("id", "parent", "position", included.alias("kept"))
    up = ancestors(nodes).join(marked.select(F.col("id").alias("ancestor"), F.col("kept").alias("up_kept"), F.col("position").alias("up_position")), "ancestor")
    g = up.groupBy("node").agg(F.sum(F.col("up_kept").cast("int")).alias("level"), F.transform(F.sort_array(F.collect_list(F.struct((-F.col("depth")).alias("d"), "up_position"))), lambda x: x["up_position"]).alias("above"))
    out = marked.join(g, F.col("id") == F.col("node"), "left").where("kept")
    return out.select("id", F.coalesce("level", F.lit(0)).alias("level"), F.concat(F.coalesce("above", F.array().cast("array<bigint>")), F.array(F.col("position").cast("bigint"))).alias("path"))


def spliced(nodes: DataFrame, kept: Column) -> DataFrame:
    """Kept nodes with the nearest kept ancestor as parent."""
    marked = nodes.select("id", "parent", kept.alias("kept"))
    up = ancestors(nodes).join(marked.where("kept").select(F.col("id").alias("ancestor")), "ancestor")
    near = up.groupBy("node").agg(F.min_by("ancestor", "depth").alias("parent"))
    return marked.where("kept").select("id").join(near.withColumnRenamed("node", "id"), "id", "left")


def levels_to_parents(df: DataFrame, keys: list[str], order: str, level: str) -> DataFrame:
    """Parents from a sequence of levels: the nearest entry before with a smaller level, found in a stack that a fold keeps."""
    rows = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order, level))).alias("rows"))
    start = F.struct(F.array().cast("array<struct<at:bigint,level:bigint>>").alias("stack"), F.array().cast("array<struct<at:bigint,level:bigint,parent:bigint>>").alias("out"))

    def step(a: Column, r: Column) -> Column:
        above = F.filter(a["stack"], lambda s: s["level"] < r[level])
        me = F.struct(r[order].cast("bigint").alias("at"), r[level].cast("bigint").alias("level"))
        entry = F.struct(r[order].cast("bigint").alias("at"), r[level].cast("bigint").alias("level"), F.get(above, F.size(above) - 1)["at"].alias("parent"))
        return F.struct(F.concat(above, F.array(me)).alias("stack"), F.concat(a["out"], F.array(entry)).alias("out"))

    out = rows.select(*keys, F.explode(F.aggregate("rows", start, step)["out"]).alias("o"))
    return out.select(*keys, F.col("o.at").alias(order), F.col("o.level").alias(level), F.col("o.parent").alias("parent"))
