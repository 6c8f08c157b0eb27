"""Rollups by a versioned metric configuration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def latest_keys(configs: DataFrame) -> DataFrame:
    """(OPCMetricID, Timestamp) of each metric's newest version. Versions that tie all stay, repeated."""
    newest = Window.partitionBy("OPCMetricID").orderBy(F.desc("Timestamp"))
    return configs.select("OPCMetricID", "Timestamp", F.rank().over(newest).alias("rk")).where("rk = 1").drop("rk")


def latest(configs: DataFrame) -> DataFrame:
    """Newest versions, once for each of the versions they tie with: k that tie become k * k rows, as a
    join back by key would give, without the join."""
    ties = latest_weighted(configs)
    return ties.withColumn("weight", F.explode(F.expr("sequence(1, cast(weight as int))"))).drop("weight")


def latest_weighted(configs: DataFrame) -> DataFrame:
    """Newest versions, each row once, with how often `latest` has it as `weight`."""
    return latest_once(configs).withColumn("weight", F.count("*").over(Window.partitionBy("OPCMetricID")))


def latest_once(configs: DataFrame) -> DataFrame:
    """Newest versions, each row once, without a join."""
    newest = Window.partitionBy("OPCMetricID").orderBy(F.desc("Timestamp"))
    return configs.withColumn("rk", F.rank().over(newest)).where("rk = 1").drop("rk")


def chosen(configs: DataFrame) -> DataFrame:
    """(AggregationInterval, OPCTagID, OPCMetricID, weight): how many configurations that aggregate at all (a
    null type doesn't) a tag's readings meet. Rows that have a `weight` stand for so many."""
    held = F.sum("weight") if "weight" in configs.columns else F.count("*")
    aggregating = configs.where((F.col("AggregationType") != "None") & F.col("OPCTagID").isNotNull())
    return aggregating.groupBy("AggregationInterval", "OPCTagID", "OPCMetricID").agg(held.alias("weight"))


def figures_by_tag(readings: DataFrame, bucket_minutes: int | None = None) -> DataFrame:
    """One row a tag (and bucket): sum, number, minimum and maximum of its values. Values that are text are
    added up as numbers and compared by the alphabet."""
    by = [F.col("OPCTagID")]
    if bucket_minutes:
        by.append(F.window("timestamp", f"{bucket_minutes} minutes").start.alias("bucket"))
    number = F.col("Value").cast("double") if dict(readings.dtypes)["Value"] == "string" else F.col("Value")
    return readings.where(F.col("OPCTagID").isNotNull()).groupBy(*by).agg(F.sum(number).alias("_sum"), F.count("Value").alias("_count"), F.min("Value").alias("Minimum"), F.max("Value").alias("Maximum"))


def rollup(readings: DataFrame, configs: DataFrame, interval: str | None = None, bucket_minutes: int | None = None) -> DataFrame:
    """Sum, Count, Average, Minimum and Maximum of Value per tag and metric, of one interval or, by
    interval, of all in one pass. An interval only chooses configurations; with `bucket_minutes`
    times are grouped too.

    Every reading counts once for each configuration of its tag, so readings are reduced to a row a tag
    (and bucket) first, and only those rows meet the configurations: sums and counts are weighted by the
    number of configurations that a tag and metric have, the other figures stay. No reading is joined,
    and a tag with most of the readings is one row.
    """
    held = chosen(configs.where(F.col("AggregationInterval") == interval) if interval else configs)
    by = ["OPCTagID", "OPCMetricID"]
    if not interval:
        by.insert(0, "AggregationInterval")
    if bucket_minutes:
        by.append("bucket")
    return weighted(figures_by_tag(readings, bucket_minutes), held, by)


def weighted(figures: DataFrame, held: DataFrame, by: list[str]) -> DataFrame:
    """Rows of `figures_by_tag` with the configurations of their tags, as `chosen` gives them."""
    total, number = F.col("_sum") * F.col("weight"), F.col("_count") * F.col("weight")
    average = F.try_divide(F.col("_sum").cast("double"), "_count")
    return figures.join(held, "OPCTagID").select(*by, total.alias("Sum"), number.alias("Count"), average.alias("Average"), "Minimum", "Maximum")


def write_by_interval(rollups: DataFrame, path: str, generation: str) -> None:
    """All intervals of one run as JSON, one folder each, in one pass."""
    rollups.write.partitionBy("AggregationInterval").json(f"{path}/{generation}")


def send_by_interval(spark: SparkSession, path: str, generation: str, send: Callable[[str, str], None]) -> None:
    """Hand each written file of each interval to `send(interval, JSON lines)`, file by file, on the
    executors; blank lines and empty files are left out. What sends must bear a repeated file."""
    lines = spark.read.text(f"{path}/{generation}", wholetext=True)  # a file at a time; the folders name the intervals

    def run(rows) -> None:
        for r in rows:
            text = "\n".join(x for x in r["value"].splitlines() if x.strip())
            if text:
                send(r["AggregationInterval"], text)

    lines.select("AggregationInterval", "value").foreachPartition(run)
