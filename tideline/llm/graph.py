"""Connected components of links, by stars, in jobs whose results are written to shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame, scratch: str) -> DataFrame:
    """(node, component): the smallest node reachable from each node of the links (a, b).

    Each round links every node's larger neighbours to its smallest one, then every node's
    smaller neighbours likewise, until nothing changes. Each round's links are written below
    `scratch` and read again, so lineage stays short. Nodes without links are not returned.
    """
    spark = links.sparkSession
    found = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    before = None
    for round_ in range(200):
        folder = f"{scratch}/round-{round_}"
        found.write.parquet(folder)
        found = spark.read.parquet(folder)
        now = found.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
        found = _small_star(_large_star(found))
    else:
        raise ArithmeticError("components did not settle")
    return found.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        found.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    others = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
