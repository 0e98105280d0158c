"""Connected components of a link table by alternating large and small stars.

Each step is a group-by and a join whose two sides are tables in the shared folder: Spark sees their sizes, broadcasts the
minima while they are small and otherwise splits the partitions of a hub in the join. Link tables are dealt to as many
partitions as their rows need, ``PART_ROWS`` a partition, up to the session's number: most are small, and steps are many.
Edges are never gathered per node and nothing but counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


PART_ROWS = 50_000


def _dealt(edges: DataFrame, rows: int) -> DataFrame:
    """Edges by their upper node, over the partitions that so many rows need."""
    width = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return edges.repartition(max(1, min(width, -(-rows // PART_ROWS))), "u")


def _is_star_forest(edges: DataFrame, rows: int) -> bool:
    """Each node has one parent, and no parent has one. Edges keep their components, so such a forest is the answer."""
    if not _dealt(edges, rows).groupBy("u").count().where("count > 1").isEmpty():
        return False
    parents = _dealt(edges.select(F.col("v").alias("u")), rows).distinct()
    return edges.join(parents, "u", "left_semi").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node with a link to another; root is the least node of its component. Nulls link nothing."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = staged(edges, "edges")
    rows = edges.count()
    edges = staged(_dealt(edges, rows).distinct(), "edges")
    while not _is_star_forest(edges, rows):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(_dealt(both, 2 * rows).groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "large")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(_dealt(large, rows).distinct(), "edges")
        least = staged(_dealt(large, rows).groupBy("u").agg(F.min("v").alias("m")), "small")
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(_dealt(small.unionByName(least.withColumnRenamed("m", "v")), 2 * rows).distinct(), "edges")
        rows = edges.count()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
