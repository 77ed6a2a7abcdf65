"""Connected components of a graph of links, as joins: no vertex, link or component passes the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over links (a, b), for each id that has a link.

    In each round an id takes the smallest label of its neighbours, a root the smallest label that any of its members
    has seen, and labels are replaced by the labels of those: trees shrink by half and more, so rounds grow
    as the logarithm of the longest path. Each round is written, so a lost executor costs no earlier round.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("label")), "labels")
    while True:
        near = both.join(labels, both["a"] == labels["id"]).groupBy("b").agg(F.min("label").alias("near"))
        seen = stored(labels.join(near, labels["id"] == near["b"]).select("id", "label", F.least("label", "near").alias("seen")), "labels-seen")
        roots = seen.groupBy(F.col("label").alias("root")).agg(F.min("seen").alias("least"))
        hooked = stored(
            seen.join(roots, seen["label"] == roots["root"]).select("id", F.col("label").alias("old"), F.least("seen", "least").alias("label")),
            "labels-hooked",
        )
        jump = hooked.select(F.col("id").alias("at"), F.col("label").alias("further"))
        labels = stored(hooked.join(jump, hooked["label"] == jump["at"]).select("id", "old", F.col("further").alias("label")), "labels")
        if labels.filter("old <> label").isEmpty():
            return labels.select("id", F.col("label").alias("component"))
        labels = labels.select("id", "label")
