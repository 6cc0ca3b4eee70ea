"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.shared import Scratch


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` for every id in ``edges`` (columns ``a, b``, long).

    The component is the smallest id within reach. Each round points every id at its
    smallest neighbour, follows the pointers to their ends and contracts the edges; the
    number of ids in play at least halves. Every round's tables are written to the shared
    folder, so lineage stays short. An empty edge table gives an empty result.
    """
    scratch = Scratch(edges.sparkSession)
    write_table = scratch.write
    live = edges.where("a is not null and b is not null and a <> b").select("a", "b").distinct()
    live = write_table(live, "edges")
    ids = live.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    labels = ids.select("id", F.col("id").alias("component"))
    while not live.isEmpty():
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("at"), F.least("a", "b").alias("to"))
        point = write_table(point, "pointers")
        while True:  # follow pointers; their length doubles each time
            next_ = point.select(F.col("at").alias("to"), F.col("to").alias("further"))
            point = write_table(point.join(next_, "to").select(
                "at", "further", (F.col("further") != F.col("to")).alias("moved")), "pointers")
            still = point.where("moved").isEmpty()
            point = point.select("at", F.col("further").alias("to"))
            if still:
                break
        one = point.select(F.col("at").alias("a"), F.col("to").alias("x"))
        two = point.select(F.col("at").alias("b"), F.col("to").alias("y"))
        live = write_table(live.join(one, "a").join(two, "b").where("x <> y").select(
            F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
        three = point.select(F.col("at").alias("component"), F.col("to").alias("root"))
        labels = write_table(labels.join(three, "component", "left").select(
            "id", F.coalesce("root", "component").alias("component")), "labels")
        scratch.drop((live, labels))
    return labels
