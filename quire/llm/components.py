"""Connected components of a link table, as rounds of Spark joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import land


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component among n nodes linked by a-b (one bounded tile, in numpy)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def components(links: DataFrame) -> DataFrame:
    """Links (a, b: long) to (node, label): the smallest node reachable, for every node that has a link.

    Each round takes the smallest label among neighbours (a combined
    aggregate) and then the label of that label, so chains halve.  Rounds are
    landed in the checkpoint folder; only the count of changes reaches the
    driver.  It ends when nothing changes.
    """
    pairs = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    pairs = land(pairs, "links")
    labels = land(pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = pairs.join(labels, pairs["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        met = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("met"))
        jump = labels.select(F.col("node").alias("met"), F.col("label").alias("further"))
        new = met.join(jump, "met", "left").select("node", F.least("met", F.coalesce("further", "met")).alias("label"), "old")
        new = land(new, "labels")
        labels = new.select("node", "label")
        if not new.where("label <> old").limit(1).count():
            return labels
