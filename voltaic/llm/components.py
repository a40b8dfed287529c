"""Connected components of a link table, by joins and minimum aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaic.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """Label the nodes of ``links`` (columns ``u``, ``v``) by their component.

    Returns ``node`` and ``root``, the smallest node reachable. Nodes are the
    ends of links; an empty table has none; repeated links, links in both
    directions and links of a node to itself change nothing. A link with a
    NULL end is ignored.

    Each round takes the smallest label among neighbours and then the label of
    that label, so path lengths at least halve. Labels are one row per node,
    so every join has a unique side; a hub with very many links is split by
    the adaptive skew join and pre-aggregated by ``min`` before its shuffle.
    """
    links = links.select("u", "v").where("u <> v")
    both = cut(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = cut(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("near")).select("node", F.least("node", "near").alias("root")))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("v"), "root"), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        step = labels.join(near, "node").select("node", "root", F.least("root", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("root").alias("beyond"))
        moved = cut(step.join(jump, "next").select("node", F.least("next", "beyond").alias("root"), (F.least("next", "beyond") != F.col("root")).alias("changed")))
        changed = moved.agg(F.max("changed")).first()[0]
        labels = moved.select("node", "root")
        if not changed:
            return labels
