"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm.spark_env import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction step: every node hands its neighbours to its smallest one.
    The minimum is a partial aggregate, so a node with many links is not gathered."""
    both = edges.select("u", "v") if not large else \
        edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(least, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node in ``links`` (two long columns ``a``, ``b``):
    ``component`` is the smallest id reachable. No links give an empty result;
    null ends and self links are ignored."""
    edges = stored(links.filter("a is not null and b is not null and a != b")
                   .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = F.struct(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")))
    before = edges.select(mark).first()[0]
    while before[0]:
        edges = stored(_star(_star(edges, True), False), "edges")
        now = edges.select(mark).first()[0]
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
