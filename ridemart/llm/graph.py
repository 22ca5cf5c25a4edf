"""Connected components of slim edge tables."""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.llm.cluster import written


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(id, component) for every id on an edge (a, b); the component is its smallest id.

    Labels go to the neighbours and then jump along themselves, so a path of
    length n takes about log n rounds; each round is a table below ``folder``.
    Minima combine map-side, so an id with very many links is no hot spot.
    """
    folder = f"{folder}/components-{uuid.uuid4().hex}"
    both = written(edges.select(F.col("a"), F.col("b")).union(edges.select(F.col("b"), F.col("a"))).distinct(), folder, "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component")), folder, "labels-0")
    for step in itertools.count(1):
        near = (both.join(labels.select(F.col("id").alias("b"), F.col("component").alias("c")), "b")
                .groupBy("a").agg(F.min("c").alias("c")).withColumnRenamed("a", "id"))
        near = labels.join(near, "id").select("id", F.col("component").alias("old"), F.least("component", "c").alias("component"))
        further = labels.select(F.col("id").alias("component"), F.col("component").alias("further"))
        labels = written(near.join(further, "component").select("id", "old", F.col("further").alias("component")), folder, f"labels-{step}")
        if labels.where("old <> component").isEmpty():
            return labels.drop("old")
        labels = labels.drop("old")
