"""Connected components as Spark joins."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmetrics.llm.common import Workspace


def components(edges: DataFrame, step: Workspace | None = None, name: str = "component") -> DataFrame:
    """(node, label): the smallest node reachable over ``edges`` (columns a, b: long).

    Every round takes the smallest label among neighbours, then follows labels
    once (pointer jumping), so the rounds grow with the logarithm of the longest
    chain. Minima combine map-side, and take repeated edges as they are; hub rows are split by
    AQE's skew join. Each round is written as a table, which cuts the lineage and packs small
    parts into few tasks; the round before goes. The last one is among the tables of ``step``, if given.
    """
    step = step or Workspace(edges.sparkSession, "components")
    both = edges.where("a <> b").select("a", "b")
    both = step.write(both.unionAll(both.select(F.col("b").alias("a"), F.col("a").alias("b"))), f"{name}-edges")
    label = step.write(both.groupBy("a").agg(F.min("b").alias("m"))
                       .select(F.col("a").alias("node"), F.least("a", "m").alias("label")), f"{name}-0")
    for turn in count(1):
        near = (both.join(label, both["b"] == label["node"]).groupBy("a")
                .agg(F.min("label").alias("near")))
        lower = (label.join(near, label["node"] == near["a"])
                 .select("node", F.least("label", "near").alias("next"),
                         F.col("label").alias("before")))
        jump = lower.select(F.col("node").alias("via"), F.col("next").alias("onward"))
        found = step.write(lower.join(jump, lower["next"] == jump["via"], "left")
                           .select("node", F.least("next", F.coalesce("onward", "next")).alias("label"),
                                   "before"), f"{name}-{turn}")
        step.drop(f"{name}-{turn - 1}")
        label = found.select("node", "label")
        if not found.where("label <> before").take(1):
            step.drop(f"{name}-edges")
            return label
