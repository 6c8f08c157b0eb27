"""Aggregations over readings. All work alike on batch and streaming tables unless they say otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.functions.codec import floor_to


def figures(value: str = "value", counted: str | None = None) -> list[Column]:
    """count, avg, min, max and sum. What is counted matters for nulls: rows by default."""
    v = F.col(value)
    return [F.count(F.col(counted) if counted else F.lit(1)).alias("count"), F.avg(v).alias("avg"), F.min(v).alias("min"), F.max(v).alias("max"), F.sum(v).alias("sum")]


def windowed(readings: DataFrame, minutes: int = 5, delay: str | None = None) -> DataFrame:
    """Figures per tag and window, by the window's start; counts the tags that aren't null. With `delay`
    the state of a stream is bounded by a watermark."""
    rows = readings.withWatermark("timestamp", delay) if delay else readings
    found = rows.groupBy(F.window("timestamp", f"{minutes} minutes").alias("w"), "opc_tag_id").agg(*figures(counted="opc_tag_id"))
    return found.select("opc_tag_id", F.col("w.start").alias("aggregate"), "count", "avg", "min", "max", "sum")


def bucketed(readings: DataFrame, unit: str) -> DataFrame:
    """Figures per tag and HOUR or MINUTE, counting rows; the average of none is 0."""
    found = readings.groupBy("opc_tag_id", floor_to(F.col("timestamp"), unit).alias("aggregate")).agg(*figures())
    return found.withColumn("avg", F.coalesce("avg", F.lit(0.0)))


def per_topic(readings: DataFrame) -> DataFrame:
    return readings.groupBy("topic").agg(F.count("*").alias("count"))


def statistics(rows: DataFrame, value: str, *by: str) -> DataFrame:
    """Count, min, max, sum, mean, and population variance and deviation, in one pass."""
    v = F.col(value)
    return rows.groupBy(*by).agg(F.count(v).alias("count"), F.min(v).alias("min"), F.max(v).alias("max"), F.sum(v).alias("sum"), F.avg(v).alias("mean"), F.var_pop(v).alias("variance"), F.stddev_pop(v).alias("stdev"))


#: Columns of stored partials: `mean` counts from `near`.
MOMENTS = ("n", "near", "mean", "m2", "sum", "min", "max")


def moments(rows: DataFrame, value: str, *by: Column | str, near: float = 0.0) -> DataFrame:
    """Partial statistics that `merge_moments` can put together later: number, mean, sum of squared
    deviations from it (`m2`), sum, minimum and maximum of the values that aren't null; no row where all are.

    The mean is kept as a distance from `near`. For large values that differ little give a number close to
    them: their differences from it are exact, so no digit of the deviations is lost."""
    v = F.col(value)
    off = v - F.lit(near)
    found = rows.where(v.isNotNull()).groupBy(*by)
    found = found.agg(F.count(v).alias("n"), F.avg(off).alias("mean"), F.var_pop(off).alias("_var"), F.sum(v).alias("sum"), F.min(v).alias("min"), F.max(v).alias("max"))
    return found.withColumns({"m2": F.col("_var") * F.col("n"), "near": F.lit(float(near))}).drop("_var")


def _pair(a: Column, b: Column) -> Column:
    """Two partials as one: the mean moves by its share of their distance, which m2 gains as a square. Nothing
    is taken from sums of squares."""
    n = a["n"] + b["n"]
    off = (b["near"] - a["near"]) + (b["mean"] - a["mean"])
    share = b["n"] / n
    mean, m2 = a["mean"] + off * share, a["m2"] + b["m2"] + off * off * a["n"] * share
    return F.struct(n.alias("n"), a["near"].alias("near"), mean.alias("mean"), m2.alias("m2"))


#: Groups that a group's partials are merged in before the last merge, so no list grows with all of them.
MERGED_APART = 256


def _merged_in_turn(partials: DataFrame, *keys: Column | str) -> DataFrame:
    each = F.array_sort(F.collect_list(F.struct("near", "mean", "m2", F.col("n").cast("double").alias("n"))))  # sorted: the same result each time
    first = F.struct(*[each[0][c].alias(c) for c in ("n", "near", "mean", "m2")])
    rest = [F.sum("sum").alias("sum"), F.min("min").alias("min"), F.max("max").alias("max")]
    return partials.groupBy(*keys).agg(F.aggregate(F.slice(each, 2, 1 << 30), first, _pair).alias("_m"), *rest)


def merge_moments(partials: DataFrame, *by: Column | str) -> DataFrame:
    """Partials of any union of windows, from stored partials, in the form that `moments` gives."""
    named = partials.select(*[F.col(c) if isinstance(c, str) else c for c in by], *MOMENTS)
    keys = named.columns[: len(by)]
    part = F.pmod(F.xxhash64(*MOMENTS), F.lit(MERGED_APART)).alias("_part")
    apart = _merged_in_turn(named, *keys, part).select(*keys, "_m.*", "sum", "min", "max")
    whole = _merged_in_turn(apart, *keys).select(*keys, "_m.*", "sum", "min", "max")
    return whole.withColumn("n", F.col("n").cast("long"))


def described(partials: DataFrame) -> DataFrame:
    """The figures of `statistics` from partials."""
    by = [c for c in partials.columns if c not in MOMENTS]
    variance = F.col("m2") / F.col("n")
    mean = (F.col("near") + F.col("mean")).alias("mean")
    return partials.select(*by, F.col("n").alias("count"), "min", "max", "sum", mean, variance.alias("variance"), F.sqrt(variance).alias("stdev"))


def total(aggregates: DataFrame) -> DataFrame:
    """The readings that a table of aggregates accounts for."""
    return aggregates.agg(F.sum("count").alias("total_count"))


def merged(partials: DataFrame, *by: str) -> DataFrame:
    """Figures of figures: counts and sums add up, the average is weighted."""
    found = partials.groupBy(*by).agg(F.sum("count").alias("count"), F.min("min").alias("min"), F.max("max").alias("max"), F.sum("sum").alias("sum"))
    return found.withColumn("avg", F.when(F.col("count") > 0, F.col("sum") / F.col("count")).otherwise(F.lit(0.0)))


#: Group of a time series: columns that are never null, so that joins and windows share one exchange.
_GROUP = ["_key", "_none", "_day"]


def _by_day(rows: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows with the columns of _GROUP: their key's and day's. Null times are in one first day."""
    k = F.col(key)
    day = F.coalesce(F.unix_date(F.col(ts).cast("date")), F.lit(-(1 << 31)))
    return rows.withColumns({"_key": F.coalesce(k.cast("string"), F.lit("")), "_none": k.isNull(), "_day": day})


def running(readings: DataFrame) -> DataFrame:
    """Sum, count and average so far of each tag, by time and id (batch only). Sums are exact decimals; null
    values add nothing, and the sum is null before the first value.

    A tag's days are summed apart and the days before are added from their totals, so no task gets
    all readings of a tag, however large its share is.
    """
    rows = _by_day(readings.select("opc_tag_id", "timestamp", "id", F.col("value").cast("decimal(18,2)").alias("_v")), "opc_tag_id", "timestamp")
    days = rows.groupBy(*_GROUP).agg(F.sum("_v").alias("_s"), F.count("_v").alias("_n"))
    earlier = Window.partitionBy(*_GROUP[:2]).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    starts = days.select(*_GROUP, F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_s0"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"))
    w = Window.partitionBy(*_GROUP).orderBy("timestamp", "id").rowsBetween(Window.unboundedPreceding, 0)
    n = F.col("_n0") + F.count("_v").over(w)
    total = F.col("_s0") + F.coalesce(F.sum("_v").over(w), F.lit(0))
    found = rows.join(starts, _GROUP).select("opc_tag_id", "timestamp", "id", F.when(n > 0, total).cast("decimal(28,2)").alias("running_sum"), n.alias("running_count"))
    return found.withColumn("running_avg", F.try_divide(F.col("running_sum").cast("double"), "running_count"))


def weighted_average(pairs: DataFrame, *by: str, sums: str = "sum", counts: str = "count") -> DataFrame:
    """The average that (sum, count) pairs make together; null where they count nothing."""
    total = pairs.groupBy(*by).agg(F.sum(sums).alias("sum"), F.sum(counts).alias("count"))
    return total.withColumn("avg", F.try_divide("sum", "count"))


def latest_per_key(readings: DataFrame, day: Column) -> DataFrame:
    """The last reading written for each (tag, day, time): the largest id (batch only)."""
    keyed = readings.withColumn("day", day)
    last = F.max_by(F.struct(*[c for c in keyed.columns if c not in ("opc_tag_id", "day", "timestamp")]), "id")
    return keyed.groupBy("opc_tag_id", "day", "timestamp").agg(last.alias("r")).select("opc_tag_id", "day", "timestamp", "r.*")


def range_read(aggregates: DataFrame, tag: int, since: Column, before: Column) -> DataFrame:
    """One tag's aggregates in [since, before), newest first; over a stored table both bounds reach the scan."""
    return aggregates.where((F.col("opc_tag_id") == tag) & (F.col("aggregate") >= since) & (F.col("aggregate") < before)).orderBy(F.desc("aggregate"))


def validation_counts(readings: DataFrame, app: str) -> DataFrame:
    """The counter row that a run adds."""
    return readings.agg(F.count("*").alias("spark_count")).select(F.lit(app).alias("id"), F.lit(0).cast("long").alias("producer_count"), F.lit(0).cast("long").alias("producer_error_count"), "spark_count")


def decoded_counts() -> list[Column]:
    """What to observe of decoded readings while they are written: all, those with problems, and the good ones."""
    bad = F.size("problems") > 0
    return [F.count(F.lit(1)).alias("producer_count"), F.count_if(bad).alias("producer_error_count"), F.count_if(~bad).alias("spark_count")]


def counter_row(spark: SparkSession, app: str, seen: dict[str, int]) -> DataFrame:
    """The counter row that a batch adds, from what was observed; a batch without rows adds zeros."""
    names = ("producer_count", "producer_error_count", "spark_count")
    return spark.createDataFrame([(app, *(int(seen.get(k) or 0) for k in names))], "id string, producer_count long, producer_error_count long, spark_count long")


def rate(rows: DataFrame, ts: str, *by: str) -> DataFrame:
    """Rows a second between the first and the last; null where that is no time at all."""
    us = F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))
    found = rows.groupBy(*by).agg(F.count("*").alias("total_count"), us.alias("_us"))
    return found.select(*by, "total_count", F.try_divide(F.col("total_count") * 1_000_000.0, F.col("_us")).alias("rate"))


def offset_ranges(records: DataFrame, offset: str = "offset") -> DataFrame:
    """From (inclusive) and until (exclusive) of the offsets seen of each topic, with their number."""
    return records.groupBy("topic").agg(F.min(offset).alias("from_offset"), (F.max(offset) + 1).alias("until_offset"), F.count("*").alias("records"))


def cycles(events: DataFrame, key: str, ts: str, kind: str, start: str, end: str, tie: str) -> DataFrame:
    """Each start that the same key's next event ends, with the microseconds between (batch only).

    The next event is looked for within the key's day; the day's last event goes on with the first
    of the key's next day, so no task gets all events of a key.
    """
    at = F.struct(F.col(ts).alias("ts"), F.col(kind).alias("kind"))
    rows = _by_day(events.select(key, ts, kind, tie), key, ts)
    firsts = rows.groupBy(*_GROUP).agg(F.min_by(at, F.struct(ts, tie)).alias("_first"))
    later = firsts.select(*_GROUP, F.lead("_first").over(Window.partitionBy(*_GROUP[:2]).orderBy("_day")).alias("_later"))
    following = F.lead(at).over(Window.partitionBy(*_GROUP).orderBy(ts, tie))
    ahead = rows.join(later, _GROUP).select(key, F.col(ts).alias("started"), kind, tie, F.coalesce(following, "_later").alias("_next"))
    micros = F.unix_micros(F.col("_next.ts").cast("timestamp")) - F.unix_micros(F.col("started").cast("timestamp"))
    return ahead.where((F.col(kind) == start) & (F.col("_next.kind") == end)).select(key, tie, "started", F.col("_next.ts").alias("ended"), micros.alias("micros"))
