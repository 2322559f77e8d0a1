"""Connected components of a link table, by minimum labels and pointer jumps.

Every round a node takes the least label among its neighbours and itself,
then the label of its label, so labels travel along doubled distances.  Hot
nodes only meet partial minima.  Each round's labels are written to the
shared folder, which cuts the lineage and survives lost executors; the driver
sees one count a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.sources.files import materialize


def components(links: DataFrame) -> DataFrame:
    """node, comp (the least node of its component) for every node of the
    links a, b."""
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # The first round needs no labels: the least of a node and its neighbours.
    labels = materialize(both.groupBy(F.col("a").alias("node"))
                         .agg(F.least(F.col("a"), F.min("b")).alias("comp")), "labels")
    while True:
        heard = (both.join(labels.select(F.col("node").alias("b"), F.col("comp").alias("other")), "b")
                 .groupBy(F.col("a").alias("node")).agg(F.min("other").alias("other")))
        told = labels.join(heard, "node").select("node", "comp", F.least("comp", "other").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("comp").alias("far"))
        labels = materialize(told.join(jump, "low").select(
            "node", F.least("low", "far").alias("comp"), (F.least("low", "far") < F.col("comp")).alias("moved")),
            "labels")
        if labels.filter("moved").isEmpty():
            return labels.select("node", "comp")
        labels = labels.select("node", "comp")
