"""Connected components with DataFrames (used by DBSCAN and HDBSCAN).

Min-label propagation with pointer jumping: every round each node takes the
smallest label among itself and its neighbours, then jumps to its label's
label.  Rounds are ``groupBy`` minima (map-side combined) and joins; the label
table is checkpointed into the shared checkpoint folder every round, so the
lineage stays one round long and a lost executor only costs that round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionary.session import materialize


def connected_components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(node, component): component = smallest node id of the component.

    Rounds go on until no label changes.

    ``edges``: (src, dst) undirected.  ``nodes``: optional (node) list so that
    isolated nodes appear as their own component.
    """
    both = (edges.select(F.col("src").alias("a"), F.col("dst").alias("b"))
            .unionByName(edges.select(F.col("dst").alias("a"), F.col("src").alias("b"))))
    both = materialize(both.where(F.col("a") != F.col("b")).distinct())
    seeds = both.select(F.col("a").alias("node"))
    if nodes is not None:
        seeds = seeds.unionByName(nodes.select("node"))
    labels = materialize(
        seeds.unionByName(both.select(F.col("b").alias("node"))).distinct()
        .join(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")), "node", "left")
        .select("node", F.least(F.col("node"), F.coalesce("m", "node")).alias("label")))
    while True:
        # neighbours' labels
        hop = (both.join(labels.withColumnRenamed("node", "b"), "b")
               .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("nl")))
        nxt = (labels.join(hop, "node", "left")
               .select("node", F.least("label", F.coalesce("nl", "label")).alias("label")))
        # pointer jumping: label <- label(label)
        jump = nxt.join(nxt.select(F.col("node").alias("label"), F.col("label").alias("ll")),
                        "label", "left")
        nxt = materialize(jump.select("node", F.least("label", F.coalesce("ll", "label"))
                                      .alias("label")))
        changed = (nxt.join(labels.withColumnRenamed("label", "old"), "node")
                   .where(F.col("label") != F.col("old")).limit(1).count())
        labels = nxt
        if changed == 0:
            return labels.withColumnRenamed("label", "component")


def global_rank(df: DataFrame, order_cols: list[str], name: str = "rank") -> DataFrame:
    """1-based positions in the total order ``order_cols`` (must be unique).

    A range-partitioned sort (no single-task window): the position is the
    row index inside its sorted partition (from ``monotonically_increasing_id``)
    plus the row count of the partitions before it (one row per partition
    reaches the driver).  The sorted data is materialised once so both uses
    see the same partitions.
    """
    srt = materialize(df.orderBy(*order_cols)
                      .withColumn("_p", F.spark_partition_id())
                      .withColumn("_m", F.monotonically_increasing_id()))
    counts = sorted((r["_p"], r["count"]) for r in srt.groupBy("_p").count().collect())
    offsets, acc = {}, 0
    for p, c in counts:
        offsets[p] = acc
        acc += c
    spark = df.sparkSession
    off = spark.createDataFrame(list(offsets.items()), "_p int, _off long")
    local = F.col("_m") - F.shiftleft(F.col("_p").cast("long"), 33)
    return (srt.join(F.broadcast(off), "_p")
            .withColumn(name, F.col("_off") + local + F.lit(1))
            .drop("_p", "_m", "_off"))
