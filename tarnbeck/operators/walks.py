"""Walks along parent links, one join a step, for trees of any depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Steps after which what was found is written as one table.
COMPACT = 8


def cut(df: DataFrame) -> DataFrame:
    """df written to spark.checkpoint.dir, its lineage cut; to the warehouse where that is unset."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        spark.sparkContext.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tarnbeck-checkpoints")
    return df.checkpoint()


def walk(starts: DataFrame, links: DataFrame, within: list[str] = ()) -> DataFrame:
    """(*within, root, node, depth): all nodes that each root reaches, itself at depth 0, each once at its least depth.

    starts has (*within, root), links has (*within, src, dst). A node that a root has reached is not walked again, so
    cycles end. Each step is one equi-join of the newest nodes with the links; null links lead nowhere.
    """
    links = links.where("src IS NOT NULL AND dst IS NOT NULL").select(*(F.col(c).alias(f"_{c}") for c in within), "src", "dst").distinct()
    newest = starts.select(*within, "root", F.col("root").alias("node"), F.lit(0).alias("depth")).distinct()
    found, depth = newest, 0
    while True:
        depth += 1
        same = F.col("node") == F.col("src")
        for c in within:
            same = same & (F.col(c) == F.col(f"_{c}"))
        step = newest.join(links, same).select(*within, "root", F.col("dst").alias("node")).distinct()
        newest = cut(step.join(found, [*within, "root", "node"], "left_anti").withColumn("depth", F.lit(depth)))
        if newest.isEmpty():
            return found
        found = found.unionByName(newest)
        if depth % COMPACT == 0:
            found = cut(found)
