"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.shared import hot_of, salted, spread, written


def components(links: DataFrame) -> DataFrame:
    """id, component_id (the smallest id that links reach) of every id in ``links`` (a, b).

    Large-star and small-star rounds, each an aggregation and a join by id: every id is
    hung on the smallest neighbour it knows, until nothing changes. Rounds grow with the
    logarithm of the longest chain, and every round but the last one hangs an id on a smaller
    one, so they end. Ids with very many links, a star's centre, are dealt among salts.
    Repeated links, links to itself and both directions of a link do no harm. Only counts come
    to the driver.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, n = written(edges, "edges"), -1
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("rows")).withColumn("m", F.least("u", "m"))
        least = written(least, "least")
        n = edges.count() if n < 0 else n
        hot = hot_of(least, "u", 2 * n)
        # Large star: larger neighbours hang on the smallest one.
        larger = salted(both.filter("v > u"), hot, "u", "v").join(spread(least.drop("rows"), hot, "u"), ["u", "__salt"])
        large = larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: smaller neighbours and the id itself do.
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        following = written(small.unionByName(down.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = following.count()
        if after == n and not following.join(edges, ["u", "v"], "left_anti").limit(1).count():
            break
        edges, n = following, after
    hung = edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return hung.unionByName(roots)
