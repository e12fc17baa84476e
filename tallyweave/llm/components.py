"""Connected components by alternating stars, on tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.session import shared_folder


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node on an edge (a, b) of longs; the root is the least node reachable.

    Each round hangs the larger neighbours of every node, then its smaller ones, below the
    least of them.  Edges only ever shrink towards stars, each round is a table of its own,
    and nothing but two sums per round reaches the driver.
    """
    spark = edges.sparkSession
    path = shared_folder(spark, "components")
    edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct().write.parquet(
        f"{path}/0"
    )
    now = spark.read.parquet(f"{path}/0")
    last = None
    for i in range(1, most_rounds + 1):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        small.write.parquet(f"{path}/{i}")
        now = spark.read.parquet(f"{path}/{i}")
        sums = tuple(now.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first())
        if sums == last:
            break
        last = sums
    else:
        raise RuntimeError("components have not settled")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
