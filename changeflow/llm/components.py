"""Connected components of a graph of links, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.tables import written


def connected_components(links: DataFrame, a: str = "id", b: str = "hub") -> DataFrame:
    """(id, component) of every node that has a link; component is its smallest id.

    Each round hooks every node to its smallest neighbour, follows those hooks to
    their roots, and goes on with the links between roots.  Links to one node are
    combined before the shuffle, so a hub with very many links costs a row per
    task; the graph shrinks by half each round at least.
    """
    edges = written(_canonical(links.select(F.col(a).alias("u"), F.col(b).alias("v"))), "links")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooks = written(
            both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("root")), "hooks"
        )
        while True:
            up = hooks.select(F.col("u").alias("root"), F.col("root").alias("next"))
            jumped = hooks.join(up, "root").select("u", F.col("next").alias("root"), (F.col("root") != F.col("next")).alias("moved"))
            jumped = written(jumped, "hooks")
            hooks = jumped.select("u", "root")
            if jumped.where("moved").isEmpty():
                break
        of_v = hooks.select(F.col("u").alias("v"), F.col("root").alias("root_v"))
        shorter = edges.join(hooks, "u").join(of_v, "v").select(
            F.col("root").alias("u"), F.col("root_v").alias("v")
        )
        edges = written(_canonical(shorter), "links")
        if labels is None:
            labels = hooks.select(F.col("u").alias("id"), F.col("root").alias("component"))
        else:
            step = hooks.select(F.col("u").alias("component"), "root")
            labels = labels.join(step, "component", "left").select(
                "id", F.coalesce("root", "component").alias("component")
            )
            labels = written(labels, "labels")
    if labels is None:
        labels = links.sparkSession.createDataFrame([], "id bigint, component bigint")
    return labels


def _canonical(links: DataFrame) -> DataFrame:
    u, v = F.least("u", "v"), F.greatest("u", "v")
    return links.select(u.alias("u"), v.alias("v")).where("u != v").distinct()
