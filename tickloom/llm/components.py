"""Connected components of a link table, by smallest label with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import stored_narrow


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of ``links`` (a, b) reaches.

    Each round gives a node the smallest label among its own, its neighbours' and its label's own label,
    and is written, so that a lost executor costs one round at most. Labels of a node with very many
    links are reduced by partial minima; nothing is gathered per node. Chains halve with each round.
    """
    both = stored_narrow(
        links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = stored_narrow(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("label")),
        "labels",
    )
    while True:
        over = both.join(labels, both["b"] == labels["node"]).select("a", "label")
        reached = over.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        closer = labels.join(reached, "node").select("node", "label", F.least("label", "near").alias("next"))
        ends = closer.select(F.col("node").alias("next"), F.col("next").alias("end"))
        jumped = closer.join(ends, "next").select("node", F.least("next", "end").alias("new"), "label")
        step = stored_narrow(jumped.select("node", F.col("new").alias("label"), (F.col("new") < F.col("label")).alias("moved")), "labels")
        labels = step.select("node", "label")
        if step.filter("moved").isEmpty():
            return labels
