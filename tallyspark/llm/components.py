"""Classes of linked ids, found by passing the smallest label along links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def linked_classes(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, class_id) for every id of ``links`` (a, b): class_id is the smallest id it is linked to over any number of links.

    Each round joins labels to links and jumps to the label of the label, so
    chains shorten about threefold a round; lineage is cut by a table in the
    shared folder. The joins sort and merge, since the number of links can't be
    foretold. Only whether a label moved comes to the driver.
    """
    links = materialise(links.select("a", "b").where("a <> b").distinct())
    both = links.union(links.select("b", "a"))
    labels = materialise(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("near")).select("id", F.least("id", "near").alias("label")))
    for _ in range(most_rounds):
        near = both.join(labels.hint("merge"), both["b"] == labels["id"]).groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        moved = labels.join(near.hint("merge"), "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = moved.select(F.col("id").alias("label"), F.col("label").alias("far"))
        new = materialise(moved.join(jump.hint("merge"), "label", "left").select("id", "old", F.least("label", F.coalesce("far", "label")).alias("label")))
        changed = new.where("old <> label").limit(1).count()
        labels = new.select("id", "label")
        if not changed:
            return labels.select("id", F.col("label").alias("class_id"))
    raise RuntimeError(f"labels still move after {most_rounds} rounds")
