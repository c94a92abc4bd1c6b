"""Connected components of a table of links, by contraction to the smallest neighbour."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, saved


def components(links: DataFrame) -> DataFrame:
    """vertex, component (the smallest vertex reachable) for every vertex of links(a, b).

    Each round maps every vertex to its smallest neighbour, itself included, and carries the links
    over to the images, without loops and repeats. The smallest vertex of a component stays where
    it is, and the others come to it in a number of rounds that grows with the logarithm of the
    size. Minima are pre-aggregated, joins can be split, tables are written each round: nothing
    gathers a component, and a lost executor costs one round at most.
    """
    edges = saved(links.select("a", "b").filter("a <> b").distinct(), "edges")
    names = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = saved(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
        if names is None:
            now = saved(least.select(F.col("v").alias("vertex"), F.col("m").alias("component")), "names")
        else:
            moved = names.join(least, F.col("component") == F.col("v"), "left")
            now = saved(moved.select("vertex", F.coalesce("m", "component").alias("component")), "names")
            forget(names)
        names = now
        x, y = least.select(F.col("v").alias("a"), F.col("m").alias("x")), least.select(F.col("v").alias("b"), F.col("m").alias("y"))
        new = edges.join(x, "a").join(y, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a <> b").distinct()
        old, edges = edges, saved(new, "edges")
        forget(old)
        if not edges.head(1):
            return names
