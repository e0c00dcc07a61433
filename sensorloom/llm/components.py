"""Connected components of a table of links, by alternating star steps in Spark."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.session import freeze


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node around."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Hang every node and its smaller neighbours on the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links(a, b)``; the root is the smallest node reachable.

    Every round is written to the shared folder, so a lost executor costs one round at most. Nodes
    with very many links are aggregated before they meet, and AQE splits their joins. Links of a
    node with itself say nothing and are left out; no links give no rows.
    """
    links = freeze(links.where("a != b").select("a", "b").distinct(), "links")
    state = None
    while True:
        # Equal sums over two rounds mean that every component has become a star.
        now = tuple(links.agg(F.count("*"), F.expr("sum(pmod(xxhash64(a, b), 1000000007))")).first())
        if now == state:
            break
        state = now
        if not now[0]:
            break
        links = freeze(_small_star(_large_star(links)), "links")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
