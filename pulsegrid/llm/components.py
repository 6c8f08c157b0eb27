"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dealt_anew, materialize, remove


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) of every node of `edges` (u, v): component is the smallest node reachable.

    Loops, repeated edges and either direction are fine; edges with a null end are ignored. Each
    step is two shuffled joins over a table that is written and read back, so no lineage grows and
    nothing comes to the driver but two numbers. A hub's edges meet its one minimum in a join of two
    plain exchanges (see `dealt_anew`), so adaptive execution splits the hub over tasks.
    """
    spark = edges.sparkSession
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
    before = None
    while (state := _state(now)) != before:
        before = state
        if not state[0]:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = dealt_anew(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "u")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = dealt_anew(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = large.join(least, "u").select(F.explode(F.expr("array(struct(v as u, m as v), struct(u, m as v))")).alias("e")).select("e.*").where("u > v").distinct()
        new = materialize(small, label)
        remove(spark, now)
        now = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
