"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.batches import written
from clickloom.operators.skew import key_copy


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for each node of the edges (a, b); root is its component's lowest node.

    Each round hangs the neighbours of a node below the lowest node it knows, first those
    above it, then those below (large and small star). Rounds grow with the logarithm of the
    longest path, and are written to the shared folder, as the next starts from files. Edges
    with a null end and loops are left out; repeats do no harm.
    """
    stars = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    stars = stars.where(F.col("u") != F.col("v")).dropna().distinct()
    stars = written(stars, "component-edges")
    state = _state(stars)
    while state[0]:
        stars = written(_small_star(_large_star(stars)), "component-edges")
        before, state = state, _state(stars)
        if state == before:
            break
    below = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return below.unionByName(roots)


def _state(stars: DataFrame) -> tuple:
    return tuple(
        stars.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).head()
    )


def _large_star(stars: DataFrame) -> DataFrame:
    both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("low"))
    lowest = lowest.select(F.col("u").alias("of"), F.least("u", "low").alias("low"))
    above = both.where(F.col("v") > F.col("u")).join(lowest, F.col("u") == key_copy("of"))
    return above.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(stars: DataFrame) -> DataFrame:
    lowest = stars.groupBy("u").agg(F.min("v").alias("low")).withColumnRenamed("u", "of")
    joined = stars.join(lowest, F.col("u") == key_copy("of"))
    pair = F.explode(
        F.array(
            F.struct(F.col("u").alias("u"), F.col("low").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("low").alias("v")),
        )
    )
    out = joined.select(pair.alias("e")).select("e.u", "e.v")
    return out.where(F.col("u") != F.col("v")).distinct()
