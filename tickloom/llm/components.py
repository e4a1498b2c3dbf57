"""Connected components of a table of links, by rounds of re-hanging links under smaller ends."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.sources.stage import materialize


def _hang(links: DataFrame, both_ways: bool) -> DataFrame:
    """Link the ends around each node to the smallest of them.

    ``both_ways`` looks at all neighbours and moves the larger ones, else at the smaller ones alone
    and moves those and the node. A node with many neighbours is combined before the shuffle and
    its rows are joined, not gathered.
    """
    sides = links.union(links.select("b", "a")).toDF("node", "near") if both_ways else links.toDF("node", "near")
    least = sides.groupBy("node").agg(F.min("near").alias("least"))
    least = least.withColumn("least", F.least("node", "least"))
    joined = sides.join(least, "node")
    moved = joined.select(F.col("near").alias("a"), F.col("least").alias("b"))
    moved = moved.where(F.col("a") > F.col("node")) if both_ways else moved.union(least.select("node", "least"))
    return moved.where("a > b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node that has a link.

    ``links`` has two columns of one comparable type. Self-links and nulls count for nothing. Each
    round is written to the shared folder, which cuts lineage and survives lost executors.
    """
    a, b = (F.col(c) for c in links.columns)
    links = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    links = materialize(links.where("a > b").distinct(), "links")
    state = None
    while True:
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        # One sort of the large step, then the small one; a fixed point is a star per component.
        links = materialize(_hang(_hang(links, True), False), "links")
    roots = links.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return links.toDF("node", "root").union(roots)
