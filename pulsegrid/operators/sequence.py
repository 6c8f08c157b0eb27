"""Dense numbers over a whole order, without a task that gets all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: monotonically_increasing_id has the partition above these bits and the row's place in it below.
_BITS = 33


def dense_sequence(rows: DataFrame, order: list[str], path: str, name: str = "sequence") -> DataFrame:
    """`rows` with 1..n in the order of these columns, which should tell all rows apart (rows that tie in all
    of them are numbered in any order, and meet in one task).

    The rows are dealt by ranges of the order, sorted where they are, and written to `path` with their place;
    a number is the place in the partition plus the rows of the partitions before. The only
    window is over those counts, one for each partition, and so is what is joined.
    """
    spark = rows.sparkSession
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    placed.write.parquet(path)
    written = spark.read.schema(placed.schema).parquet(path).withColumn("_part", F.shiftright("_place", _BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = written.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    at = F.col("_before") + F.col("_place").bitwiseAND((1 << _BITS) - 1) + 1
    return written.join(F.broadcast(starts), "_part").select(*rows.columns, at.alias(name))


def numbered_by(rows: DataFrame, by: list[str], order: list[str], name: str = "place") -> DataFrame:
    """`rows` with 0..n-1 inside each group of `by`, in the order of these columns. The first of them is a time:
    a group's days are numbered apart and the days before are added from their counts, so no task gets a
    whole group, however large its share is."""
    day = F.coalesce(F.unix_date(F.col(order[0]).cast("date")), F.lit(-(1 << 31)))
    rows = rows.withColumn("_day", day)
    days = rows.groupBy(*by, "_day").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    starts = days.select(*by, "_day", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(*by, "_day").orderBy(*order)) - 1
    return rows.join(starts, [*by, "_day"]).withColumn(name, F.col("_before") + place).drop("_day", "_before")
