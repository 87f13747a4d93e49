"""Connected components of a link table, by least labels and jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, label`` for every id in ``links``; the label is the smallest id that can be reached.

    Each round takes the least label among neighbours and then the label of that label, so a chain of n links needs
    about log n rounds. Every round is staged. Links may repeat and may name one id twice; no link may hold a null.
    """
    pairs = links.select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = staged(pairs.union(pairs.select("y", "x")).distinct(), "links")
    labels = staged(both.groupBy(F.col("x").alias("id")).agg(F.min("y").alias("y"))
                    .select("id", F.least("id", "y").alias("label")), "labels")
    while True:
        near = (both.join(labels, F.col("y") == F.col("id")).groupBy("x").agg(F.min("label").alias("near")))
        step = labels.join(near, F.col("id") == F.col("x")).select(
            "id", F.col("label").alias("old"), F.least("label", "near").alias("to"))
        goal = labels.select(F.col("id").alias("to"), F.col("label").alias("beyond"))
        new = staged(step.join(goal, "to").select("id", F.least("to", "beyond").alias("label"), "old"), "labels")
        if new.filter("label <> old").isEmpty():
            return new.select("id", "label")
        labels = new.select("id", "label")
