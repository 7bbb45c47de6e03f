"""Connected components by iterated minimum labels with pointer jumping, every step a join or a grouped minimum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelcast.llm.common import settled, stage_table


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of the undirected ``edges`` (u, v).

    A round takes each node's smallest label among itself and its neighbours, then follows that label once, so a
    path of n nodes needs about log2(n) rounds.  Each round is written to the shared folder."""
    return settled(edges.sparkSession, lambda: _components(edges))


def _components(edges: DataFrame) -> DataFrame:
    both = stage_table(edges.select("u", "v").union(edges.select("v", "u")).distinct())
    labels = stage_table(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label"))
                         .select(F.col("u").alias("node"), "label"))
    while True:
        near = (both.join(labels.withColumnsRenamed({"node": "v", "label": "lv"}), "v")
                .groupBy("u").agg(F.min("lv").alias("low")))
        lowered = labels.join(near, labels["node"] == near["u"]).select(
            "node", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        lowered = stage_table(lowered)
        jump = lowered.select(F.col("node").alias("j_node"), F.col("label").alias("j_label"))
        stepped = stage_table(lowered.join(jump, lowered["label"] == jump["j_node"], "left").select(
            "node", "old", F.least("label", F.coalesce("j_label", "label")).alias("label")))
        labels = stepped.select("node", "label")
        if stepped.where("label <> old").limit(1).count() == 0:
            return labels
