"""Connected components by contraction, as joins and aggregates; nothing of the graph reaches the driver."""

from pyspark.sql import DataFrame, functions as F

from watchmill.session import written


def _is_empty(df: DataFrame) -> bool:
    return df.limit(1).count() == 0


def _roots(edges: DataFrame) -> DataFrame:
    """``id``, ``root``: every node hangs below its smallest neighbour if that is smaller; paths are then halved."""
    both = edges.select(F.col("u").alias("id"), F.col("v").alias("root")).union(edges.select("v", "u"))
    parent = written(both.groupBy("id").agg(F.min("root").alias("root")).select(
        "id", F.least("id", "root").alias("root")), "parents")
    while True:
        above = parent.select(F.col("id").alias("root"), F.col("root").alias("top"))
        jumped = parent.join(above, "root").select("id", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved"))
        jumped = written(jumped, "jumped")
        parent = jumped.drop("moved")
        if _is_empty(jumped.filter("moved")):
            return parent


def components(edges: DataFrame) -> DataFrame:
    """``id``, ``component``: of every node that occurs in ``edges`` (``u``, ``v``), the smallest node it reaches.

    Each round hooks nodes to their smallest neighbour, jumps to the roots in a logarithmic number of joins and
    keeps only the edges between different roots, so at least half of the open nodes go. A node with very many
    edges is reduced by a minimum before the shuffle. Null ends and loops are ignored; no edges, no rows.
    """
    edges = written(edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    found = None
    while not _is_empty(edges):
        roots = _roots(edges)
        first, second = roots.toDF("u", "ru"), roots.toDF("v", "rv")
        edges = written(
            edges.join(first, "u").join(second, "v").filter("ru <> rv")
            .select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct(), "edges")
        if found is None:
            found = roots
        else:
            higher = roots.toDF("root", "top")
            found = written(found.join(higher, "root", "left").select("id", F.coalesce("top", "root").alias("root")), "roots")
    if found is None:
        return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return found.select("id", F.col("root").alias("component"))
