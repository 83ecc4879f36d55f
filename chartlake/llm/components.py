"""Connected components of a link table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, saved


def components(links: DataFrame) -> DataFrame:
    """(id, component): for each id in links (a, b) the smallest id it is joined to.

    Every round takes the smallest label among the neighbours, then the label
    of that label, so chains shorten by more than half a round. Labels are
    saved each round; nothing is collected but the count of changes.
    """
    def side(labels: DataFrame, n: int) -> DataFrame:
        return F.broadcast(labels) if n <= BROADCAST_ROWS else labels

    edges = saved(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = saved(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                   .select("id", F.least("id", "m").alias("component")), "labels")
    n = labels.count()  # stays the same
    while True:
        near = (edges.join(side(labels, n), F.col("b") == F.col("id")).groupBy("a")
                .agg(F.min("component").alias("m")))
        step = labels.join(side(near, n), F.col("id") == F.col("a")).select(
            "id", F.col("component").alias("was"), F.least("component", "m").alias("now"))
        step = saved(step, "labels")
        far = step.select(F.col("id").alias("to"), F.col("now").alias("then"))
        jumped = saved(step.join(side(far, n), F.col("now") == F.col("to")).select(
            "id", "was", F.least("now", "then").alias("component")), "labels")
        labels = jumped.select("id", "component")
        if jumped.where(F.col("component") != F.col("was")).isEmpty():
            return labels
