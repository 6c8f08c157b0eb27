"""The registered queries over the telemetry operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions import codec
from pulsegrid.operators import aggregates, rollup
from pulsegrid.plans import flows, records
from pulsegrid.sources import readers
from pulsegrid.streaming import runner

DELAY = "24 hours"
TAG = 7
SINCE, BEFORE = "2024-01-05 00:00:00", "2024-01-20 00:00:00"
#: The priorities that play the intervals, in the intervals' order.
PRIORITIES = {"fiveminutes": "1-URGENT", "fifteenminutes": "2-HIGH", "thirtyminutes": "3-MEDIUM", "hour": "4-NOT SPECIFIED", "day": "5-LOW"}


def _ntz(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


def _r(name: str, digits: int) -> Column:
    return F.round(name, digits).alias(name)


def _figures(df: DataFrame) -> DataFrame:
    return df.select("opc_tag_id", _ntz("aggregate"), "count", _r("avg", 4), "min", "max", _r("sum", 2))


def _figures_sql(bucket: str, count: str = "count(*)") -> str:
    return f"""select user_id opc_tag_id, {bucket} aggregate, {count} "count", round(avg(value), 4) "avg", min(value) "min", max(value) "max", round(sum(value), 2) "sum"
        from events group by 1, 2"""


_WINDOW_SQL = _figures_sql("time_bucket(interval '5 minutes', ts)", "count(user_id)")


def signals_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = readers.signals(spark, sf_dir)
    return s.select("id", "value", codec.day_of(F.col("timestamp")).alias("day"), _ntz("timestamp"), "quality", "opc_tag_id", "proxied_type_name")


def signal_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = readers.signals(spark, sf_dir).withColumn("value", F.floor("value").cast("long")).withColumn("extended_properties", F.array("topic"))
    good, _ = codec.split_quarantine(codec.decode_signals(codec.encode_signals(s)))
    return good.select("unique_id", "id", "value", "day", _ntz("timestamp"), "quality", "opc_tag_reading_id", "opc_tag_id", "proxied_type_name", F.array_join("extended_properties", ",").alias("extended_properties"))


def event_props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "k string")
    return readers.table(spark, sf_dir, "events").select("event_id", codec.to_long(props.k).alias("k"))


def agg_window_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _figures(aggregates.windowed(readers.signals(spark, sf_dir)))


def agg_window_5min_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _figures(runner.drain(aggregates.windowed(readers.signal_stream(spark, sf_dir), delay=DELAY), "complete", "window-complete"))


def agg_window_5min_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _figures(runner.drain(aggregates.windowed(readers.signal_stream(spark, sf_dir), delay=DELAY), "append", "window-append"))


def agg_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _figures(aggregates.bucketed(readers.signals(spark, sf_dir), "HOUR"))


def agg_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _figures(aggregates.bucketed(readers.signals(spark, sf_dir), "MINUTE"))


def topic_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.per_topic(readers.signals(spark, sf_dir))


def topic_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runner.drain(aggregates.per_topic(readers.signal_stream(spark, sf_dir)), "complete", "topic-count")


def latest_config_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.latest_keys(readers.configs(spark, sf_dir)).select("OPCMetricID", _ntz("Timestamp"))


def _config(df: DataFrame) -> DataFrame:
    return df.select("OPCMetricID", _ntz("Timestamp"), "OPCTagID", "AggregationInterval", "AggregationType")


def latest_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _config(rollup.latest(readers.configs(spark, sf_dir)))


def latest_config_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _config(rollup.latest_once(readers.configs(spark, sf_dir)))


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.signals(spark, sf_dir).select(F.col("opc_tag_id").alias("OPCTagID"), F.col("value").alias("Value"), "timestamp")


def _rolled(df: DataFrame, *first: str) -> DataFrame:
    return df.select(*first, "OPCTagID", "OPCMetricID", _r("Sum", 2), "Count", _r("Average", 4), "Minimum", "Maximum")


def _rollup_of(interval: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rolled(rollup.rollup(_readings(spark, sf_dir), rollup.latest_weighted(readers.configs(spark, sf_dir)), interval))

    return query


def rollup_all_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolled(rollup.rollup(_readings(spark, sf_dir), rollup.latest_weighted(readers.configs(spark, sf_dir))), "AggregationInterval")


def rollup_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rollup.rollup(_readings(spark, sf_dir), rollup.latest_once(readers.configs(spark, sf_dir)), bucket_minutes=60)
    return _rolled(found.withColumn("bucket", F.col("bucket").cast("timestamp_ntz")), "AggregationInterval", "bucket")


def rollup_string_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values as text: sums and averages convert them, minimum and maximum go by the alphabet."""
    text = _readings(spark, sf_dir).withColumn("Value", F.floor("Value").cast("long").cast("string"))
    found = rollup.rollup(text, rollup.latest_weighted(readers.configs(spark, sf_dir)).withColumn("AggregationInterval", F.lit("any")), "any")
    return found.withColumn("Average", F.round("Average", 4))


def _stats(df: DataFrame, *first: str) -> DataFrame:
    return df.select(*first, "count", "min", "max", _r("sum", 2), _r("mean", 4), _r("variance", 3), _r("stdev", 4))


def stats_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(aggregates.statistics(readers.signals(spark, sf_dir), "value"))


def stats_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(aggregates.statistics(readers.signals(spark, sf_dir), "value", "topic"), "topic")


def reconcile_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.total(aggregates.windowed(readers.signals(spark, sf_dir)))


def merged_by_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = aggregates.merged(aggregates.windowed(readers.signals(spark, sf_dir)), "opc_tag_id")
    return found.select("opc_tag_id", "count", "min", "max", _r("sum", 2))


def running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.running(readers.signals(spark, sf_dir)).select("opc_tag_id", _ntz("timestamp"), "id", F.col("running_sum").cast("double").alias("running_sum"))


def running_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The average so far, with the count that it weighs."""
    return aggregates.running(readers.signals(spark, sf_dir)).select("opc_tag_id", _ntz("timestamp"), "id", _r("running_avg", 6), "running_count")


def point_range_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    # windows begin at the bounds, so both reach the scan as bounds on the readings
    events = readers.table(spark, sf_dir, "events").where((F.col("user_id") == TAG) & (F.col("ts") >= F.lit(SINCE).cast("timestamp_ntz")) & (F.col("ts") < F.lit(BEFORE).cast("timestamp_ntz")))
    return _figures(aggregates.range_read(aggregates.windowed(readers.as_signals(events)), TAG, F.lit(SINCE).cast("timestamp"), F.lit(BEFORE).cast("timestamp")))


def latest_signal_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    # to the hour, so that keys really collide
    s = readers.signals(spark, sf_dir).withColumn("timestamp", F.date_trunc("HOUR", "timestamp"))
    return aggregates.latest_per_key(s, codec.day_of(F.col("timestamp"))).select("opc_tag_id", "day", _ntz("timestamp"), "id", "value", "quality", "proxied_type_name")


def validation_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.validation_counts(readers.signals(spark, sf_dir), "app")


def cycle_time_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = readers.table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "event_id")
    found = aggregates.cycles(e, "user_id", "ts", "event_type", "view", "purchase", "event_id")
    return found.select("user_id", "event_id", _ntz("started"), _ntz("ended"), "micros")


QUERIES = {
    "signals_project": signals_project,
    "signal_json_roundtrip": signal_json_roundtrip,
    "event_props_json": event_props_json,
    "agg_hour": agg_hour,
    "agg_minute": agg_minute,
    "agg_window_5min": agg_window_5min,
    "agg_window_5min_stream": agg_window_5min_stream,
    "agg_window_5min_append": agg_window_5min_append,
    "topic_count": topic_count,
    "topic_count_stream": topic_count_stream,
    "latest_config_keys": latest_config_keys,
    "latest_config": latest_config,
    "latest_config_dedup": latest_config_dedup,
    **{f"rollup_{k}": _rollup_of(v) for k, v in PRIORITIES.items()},
    "rollup_all_intervals": rollup_all_intervals,
    "rollup_string_values": rollup_string_values,
    "rollup_bucketed": rollup_bucketed,
    "stats_global": stats_global,
    "stats_by_type": stats_by_type,
    "reconcile_total": reconcile_total,
    "merged_by_tag": merged_by_tag,
    "running_sum": running_sum,
    "running_avg": running_avg,
    "point_range_read": point_range_read,
    "latest_signal_per_key": latest_signal_per_key,
    "validation_counters": validation_counters,
    "cycle_time_pairs": cycle_time_pairs,
    **flows.QUERIES,
    **records.QUERIES,
}

_CONFIG_SQL = """config as (select o_custkey OPCMetricID, o_orderdate "Timestamp", o_custkey OPCTagID, o_orderpriority AggregationInterval,
    case o_orderstatus when 'P' then 'None' else o_orderstatus end AggregationType from orders),
  ranked as (select *, rank() over (partition by OPCMetricID order by "Timestamp" desc) rk from config),
  keys as (select OPCMetricID, "Timestamp" from ranked where rk = 1),
  latest as (select c.* from config c join keys k on c.OPCMetricID = k.OPCMetricID and c."Timestamp" = k."Timestamp")"""
_ROLLED = """round(sum(value), 2) "Sum", count(value) "Count", round(avg(value), 4) Average, min(value) Minimum, max(value) Maximum"""
_STATS = """count(value) "count", min(value) "min", max(value) "max", round(sum(value), 2) "sum", round(avg(value), 4) mean, round(var_pop(value), 3) variance, round(stddev_pop(value), 4) stdev"""
_RUNNING = "over (partition by user_id order by ts, event_id rows unbounded preceding)"
_DAY = "strftime(date_trunc('day', {}), '%Y-%m-%dT%H:%M:%SZ')"

ORACLE_SQL: dict[str, str] = {
    "signals_project": f"""select event_id id, value, {_DAY.format("ts")} "day", ts "timestamp", cast(json_extract_string(props, '$.k') as bigint) quality, user_id opc_tag_id, event_type proxied_type_name from events""",
    "signal_json_roundtrip": f"""select cast(null as varchar) unique_id, event_id id, cast(floor(value) as bigint) value, {_DAY.format("ts")} "day", ts "timestamp", cast(json_extract_string(props, '$.k') as bigint) quality,
        event_id opc_tag_reading_id, user_id opc_tag_id, event_type proxied_type_name, event_type extended_properties from events""",
    "event_props_json": "select event_id, cast(json_extract_string(props, '$.k') as bigint) k from events",
    "agg_hour": _figures_sql("date_trunc('hour', ts)"),
    "agg_minute": _figures_sql("date_trunc('minute', ts)"),
    "agg_window_5min": _WINDOW_SQL,
    "agg_window_5min_stream": _WINDOW_SQL,
    "agg_window_5min_append": f"""select * from ({_WINDOW_SQL}) where aggregate + interval '5 minutes' <= (select max(ts) from events) - interval '24 hours'""",
    "topic_count": """select event_type topic, count(*) "count" from events group by 1""",
    "topic_count_stream": """select event_type topic, count(*) "count" from events group by 1""",
    "latest_config_keys": f"with {_CONFIG_SQL} select * from keys",
    "latest_config": f"with {_CONFIG_SQL} select * from latest",
    "latest_config_dedup": f"with {_CONFIG_SQL} select * exclude (rk) from ranked where rk = 1",
    **{f"rollup_{k}": f"with {_CONFIG_SQL} select OPCTagID, OPCMetricID, {_ROLLED} from events join latest on user_id = OPCTagID where AggregationInterval = '{v}' and AggregationType <> 'None' group by 1, 2" for k, v in PRIORITIES.items()},
    "rollup_all_intervals": f"with {_CONFIG_SQL} select AggregationInterval, OPCTagID, OPCMetricID, {_ROLLED} from events join latest on user_id = OPCTagID where AggregationType <> 'None' group by 1, 2, 3",
    "rollup_string_values": f"""with {_CONFIG_SQL}, e as (select user_id, cast(cast(floor(value) as bigint) as varchar) v from events)
        select OPCTagID, OPCMetricID, sum(cast(v as double)) "Sum", count(v) "Count", round(avg(cast(v as double)), 4) Average, min(v) Minimum, max(v) Maximum
        from e join latest on user_id = OPCTagID where AggregationType <> 'None' group by 1, 2""",
    "rollup_bucketed": f"""with {_CONFIG_SQL} select AggregationInterval, time_bucket(interval '60 minutes', ts) bucket, OPCTagID, OPCMetricID, {_ROLLED}
        from events join (select * from ranked where rk = 1) on user_id = OPCTagID where AggregationType <> 'None' group by 1, 2, 3, 4""",
    "stats_global": f"select {_STATS} from events",
    "stats_by_type": f"select event_type topic, {_STATS} from events group by 1",
    "reconcile_total": f"""select cast(sum("count") as bigint) total_count from ({_WINDOW_SQL})""",
    "merged_by_tag": """select user_id opc_tag_id, count(*) "count", min(value) "min", max(value) "max", round(sum(value), 2) "sum" from events group by 1""",
    "running_sum": f"""select user_id opc_tag_id, ts "timestamp", event_id id, cast(sum(cast(value as decimal(18, 2))) {_RUNNING} as double) running_sum from events""",
    "running_avg": f"""select user_id opc_tag_id, ts "timestamp", event_id id, round(cast(sum(cast(value as decimal(18, 2))) {_RUNNING} as double) / count(value) {_RUNNING}, 6) running_avg, count(value) {_RUNNING} running_count from events""",
    "point_range_read": f"""select * from ({_WINDOW_SQL}) where opc_tag_id = {TAG} and aggregate >= timestamp '{SINCE}' and aggregate < timestamp '{BEFORE}' order by aggregate desc""",
    "latest_signal_per_key": f"""with s as (select user_id opc_tag_id, date_trunc('hour', ts) "timestamp", event_id id, value, cast(json_extract_string(props, '$.k') as bigint) quality, event_type proxied_type_name from events),
        r as (select *, row_number() over (partition by opc_tag_id, "timestamp" order by id desc) rk from s)
        select opc_tag_id, {_DAY.format('"timestamp"')} "day", "timestamp", id, value, quality, proxied_type_name from r where rk = 1""",
    "validation_counters": "select 'app' id, cast(0 as bigint) producer_count, cast(0 as bigint) producer_error_count, count(*) spark_count from events",
    "cycle_time_pairs": """with a as (select user_id, event_id, ts started, event_type, lead(ts) over w ended, lead(event_type) over w n from events window w as (partition by user_id order by ts, event_id))
        select user_id, event_id, started, ended, epoch_us(ended) - epoch_us(started) micros from a where event_type = 'view' and n = 'purchase'""",
    **flows.ORACLE_SQL,
    **records.ORACLE_SQL,
}
