"""Registered queries that go through sources, codecs, streams and sinks, and their SQL.

The table `events` is sent as messages, some of them broken by rule, and what comes out of the
pipelines is held against SQL over the table itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions import codec
from pulsegrid.operators import aggregates, rollup
from pulsegrid.plans import pipelines
from pulsegrid.sources import readers
from pulsegrid.sources.schemas import INTERVALS, RECORD
from pulsegrid.streaming import runner
from pulsegrid.streaming.keyed import KeyedTable

#: What isn't a full instant, though some of it could be read as one.
BAD_TIMES = ("2016", "2016-03", "2016-03-03", "2016-03-03T10:00:00", "12:30", "T12:30:00", "yesterday")
#: Readings before it come late.
LATE = "2024-01-15 00:00:00"
OFFSET_TOPIC = "view"


def _ntz(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.table(spark, sf_dir, "events")


def _whole(readings: DataFrame) -> DataFrame:
    """Readings whose values are whole numbers, as their wire format has them."""
    return readings.withColumn("value", F.floor("value").cast("long"))


def payload(events: DataFrame) -> DataFrame:
    """Every event as a message; by its id's last digit 0 is a bare object, 1 has a quoted fraction, 2 no
    number, 3 and 4 no instant, 5 no JSON, 6 nothing, 7 no time, 8 a second object."""
    k = F.col("event_id") % 10
    whole = F.floor("value").cast("long").cast("string")
    value = F.when(k == 1, F.concat(F.lit('"'), whole, F.lit('.7"'))).when(k == 2, F.lit('"abc"')).otherwise(whole)
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    bad = F.element_at(F.array(*map(F.lit, BAD_TIMES)), (F.col("event_id") % len(BAD_TIMES) + 1).cast("int"))
    time = F.when(k == 7, "null").otherwise(F.concat(F.lit('"'), F.when(k.isin(3, 4), bad).otherwise(stamp), F.lit('"')))
    one = F.format_string('{"ID":%d,"Value":%s,"Timestamp":%s,"OPCTagID":%d}', "event_id", value, time, "user_id")
    text = F.when(k == 5, "{").when(k == 6, "").when(k == 0, one).when(k == 8, F.concat(F.lit("["), one, F.lit(',{"ID":-1}]'))).otherwise(F.concat(F.lit("["), one, F.lit("]")))
    place = [(F.col("user_id") % 3).cast("int").alias("partition"), F.lit(None).cast("binary").alias("key"), F.col("event_type").alias("topic"), F.col("event_id").alias("offset")]
    return events.select(text.cast("binary").alias("value"), F.col("ts").cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"), *place)


def _send(messages: DataFrame, path: str) -> None:
    messages.select(*RECORD.fieldNames()).write.mode("append").parquet(path)


def _settings(spark: SparkSession, label: str) -> dict[str, str]:
    at = runner.shared_folder(spark, label)
    return {"app": f"{label}-{uuid.uuid4().hex[:8]}", "checkpoint": f"{at}/checkpoint", "files": f"{at}/messages", "out": f"{at}/out"}


def decode_mixed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = codec.decode_signals(payload(_events(spark, sf_dir)))
    none = F.lit(-1)
    return found.select(F.coalesce("id", none).alias("id"), F.coalesce("value", none).alias("value"), "day", F.array_join("problems", ",").alias("problems"))


def extended_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists that hold nulls, are empty, null or absent."""
    k = F.col("event_id") % 4
    inner = F.when(k == 0, F.concat(F.lit(',"ExtendedProperties":["a",null,"'), "event_type", F.lit('"]'))).when(k == 1, ',"ExtendedProperties":[]').when(k == 2, ',"ExtendedProperties":null').otherwise("")
    text = F.concat(F.lit('[{"ID":'), F.col("event_id").cast("string"), F.lit(',"Timestamp":"2024-01-01T00:00:00Z"'), inner, F.lit("}]"))
    found = codec.decode_signals(_events(spark, sf_dir).select(text.alias("value")))
    return found.select("id", F.size("extended_properties").cast("long").alias("n"), F.array_join("extended_properties", "|", "null").alias("joined"))


def event_codec_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events encoded and decoded; by their number modulo 8, 1 to 7 break one rule each."""
    k = F.col("event_id") % 8
    digest = F.md5(F.col("event_id").cast("string"))
    made = F.concat_ws("-", *[F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    events = _events(spark, sf_dir).select(
        F.when(k == 5, "x").otherwise(made).alias("id"), F.when(k == 1, 0).otherwise(F.col("event_id") + 1).cast("long").alias("sequence"),
        F.when(k != 2, "Node-1").alias("node_id"), F.when(k == 7, "").otherwise(made).alias("job_id"),
        F.when(k == 3, "OTHER").when(k != 4, "START").alias("type"), F.when(k != 6, F.col("ts").cast("timestamp")).alias("timestamp"),
        F.lit(None).cast("string").alias("generator_id"), F.when(F.col("event_id") % 3 == 0, F.lit(1)).cast("long").alias("version"),
    )
    found = codec.decode_events(codec.encode_events(events))
    return found.select("id", "sequence", "node_id", "job_id", "type", F.date_trunc("SECOND", "timestamp").cast("timestamp_ntz").alias("timestamp"), F.coalesce("version", F.lit(-1)).alias("version"), F.array_join("problems", ",").alias("problems"))


def event_floor_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return _events(spark, sf_dir).select("event_id", codec.event_floor(ts, "HOURS").alias("hour"), codec.event_floor(ts, "MINUTES").alias("minute"))


def millis_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = codec.from_millis(F.col("event_id") * 60_007)
    return _events(spark, sf_dir).select("event_id", ts.cast("timestamp_ntz").alias("at"), codec.iso(ts).alias("text"))


def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings written as JSON lines and read by schema."""
    at = runner.shared_folder(spark, "json-scan")
    _events(spark, sf_dir).select(F.col("user_id").alias("OPCTagID"), F.floor("value").cast("string").alias("Value")).write.json(at)
    found = spark.read.schema("OPCTagID long, Value string").json(at)
    return found.groupBy("OPCTagID").agg(F.count("Value").alias("n"), F.sum(codec.to_long(F.col("Value"))).alias("total"), F.min("Value").alias("first_text"))


def json_by_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollups written as JSON, a folder for each interval and one file in it, and read back."""
    at = runner.shared_folder(spark, "json-interval")
    readings = readers.signals(spark, sf_dir).select(F.col("opc_tag_id").alias("OPCTagID"), F.col("value").alias("Value"))
    found = rollup.rollup(readings, rollup.latest_once(readers.configs(spark, sf_dir)))
    rollup.write_by_interval(found.repartition(len(INTERVALS), "AggregationInterval"), at, "g1")
    back = spark.read.schema("AggregationInterval string, OPCTagID long, OPCMetricID long, Sum double, Count long").json(f"{at}/g1")
    return back.select("AggregationInterval", "OPCTagID", "OPCMetricID", F.round("Sum", 2).alias("Sum"), "Count")


def _ingested(spark: SparkSession, sf_dir: str, label: str, only: str) -> dict[str, str]:
    """All messages taken in, into one of the tables: half of them, a stop, and the other half after a restart."""
    s = _settings(spark, label)
    messages = payload(_events(spark, sf_dir))
    for half in (0, 1):
        _send(messages.where(F.col("offset") % 2 == half), s["files"])
        pipelines.Ingest(**s, raw=only == "raw", counts=only == "counts", figures=only == "figures", quarantine=f"{s['out']}-bad").run(spark)
    return s


def ingest_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _ingested(spark, sf_dir, "ingest-signals", "raw")
    return KeyedTable(spark, f"{s['out']}/signals", "signals").read().select("opc_tag_id", "day", _ntz("timestamp"), "id", "value")


def ingest_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _ingested(spark, sf_dir, "ingest-counters", "counts")
    found = KeyedTable(spark, f"{s['out']}/counters", "signal_validation", pipelines.COUNTERS).read()
    return found.select(F.col("producer_count").alias("total_count"), F.col("producer_error_count").alias("total_error_count"), "spark_count")


def ingest_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After compaction, so both ways of merging are in it."""
    s = _ingested(spark, sf_dir, "ingest-aggregates", "figures")
    table = KeyedTable(spark, f"{s['out']}/aggregates", "signal_aggregate", pipelines.FIGURES)
    table.compact()
    return table.read().select("opc_tag_id", _ntz("aggregate"), "count", "sum", "min", "max")


def window_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of figures in update mode, upserted by tag and window."""
    s = _settings(spark, "window-upserts")
    table = KeyedTable(spark, s["out"], "ss_signal_aggregation")
    found = aggregates.windowed(_whole(readers.signal_stream(spark, sf_dir)), delay="24 hours")
    runner.start(found, runner.StreamConfig(s["app"], s["checkpoint"], "update"), table.apply).awaitTermination()
    return table.read().select("opc_tag_id", _ntz("aggregate"), "count", F.round("avg", 4).alias("avg"), "min", "max", "sum")


def latest_by_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of one tag and hour collide; the last written stays, within a batch the one of the largest id."""
    at = runner.shared_folder(spark, "upserts")
    table = KeyedTable(spark, at, "signals")
    rows = _whole(readers.signals(spark, sf_dir)).withColumn("timestamp", F.date_trunc("HOUR", "timestamp")).withColumn("extended_properties", F.array().cast("array<string>"))
    rows = rows.withColumn("day", codec.day_of(F.col("timestamp")))
    for number, part in enumerate((rows.where("id % 3 <> 0"), rows.where("id % 3 = 0"))):
        table.apply(part, number, "writer")
    return table.read().select("opc_tag_id", "day", _ntz("timestamp"), "id", "value")


def topic_count_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _settings(spark, "topic-counts")
    _send(payload(_events(spark, sf_dir)), s["files"])
    pipelines.TopicCounts(**s).run(spark)
    return KeyedTable(spark, s["out"], "ss_signal_validation").read().select("topic", "spark_count")


def topic_count_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Into a table of the driver's memory: five rows, by a trigger that fires again and again until all is in."""
    s = _settings(spark, "topic_memory")
    name = s["app"].replace("-", "_")
    query = runner.start(aggregates.per_topic(readers.signal_stream(spark, sf_dir)), runner.StreamConfig(name, s["checkpoint"], "complete", "1 second"), fmt="memory")
    query.processAllAvailable()
    query.stop()
    return spark.table(name)


def agg_window_5min_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete mode, the result in order."""
    found = aggregates.windowed(readers.signal_stream(spark, sf_dir)).orderBy("aggregate", "opc_tag_id")
    out = runner.drain(found, "complete", "window-ordered").orderBy("aggregate", "opc_tag_id")
    return out.select("opc_tag_id", _ntz("aggregate"), "count", F.round("avg", 4).alias("avg"), "min", "max", F.round("sum", 2).alias("sum"))


def late_readings_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half comes first; what comes behind it, after a restart, is beyond the watermark."""
    s = _settings(spark, "late")
    rows = _whole(readers.signals(spark, sf_dir)).select("opc_tag_id", "timestamp", "value")
    table = KeyedTable(spark, s["out"], "ss_signal_aggregation")
    for part in (rows.where(f"timestamp >= '{LATE}'"), rows.where(f"timestamp < '{LATE}'")):
        part.write.mode("append").parquet(s["files"])
        stream = spark.readStream.schema(rows.schema).parquet(s["files"])
        runner.start(aggregates.windowed(stream, delay="24 hours"), runner.StreamConfig(s["app"], s["checkpoint"], "update"), table.apply).awaitTermination()
    return table.read().select("opc_tag_id", _ntz("aggregate"), "count", "min", "max", "sum")


def stored_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _settings(spark, "offsets")
    _send(payload(_events(spark, sf_dir)), s["files"])
    pipelines.LogOffsets(**s).run(spark)
    return readers.stored_offsets(KeyedTable(spark, s["out"], "offsets").read(), OFFSET_TOPIC)


def progress_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that a stream's stored progress accounts for."""
    s = _settings(spark, "progress")
    _send(payload(_events(spark, sf_dir)), s["files"])
    pipelines.TopicCounts(**s, statistics=f"{s['out']}-progress").run(spark)
    found = KeyedTable(spark, f"{s['out']}-progress", "query_statistics").read()
    return found.agg(F.sum(F.get_json_object("json", "$.numInputRows").cast("long")).alias("input_rows"))


def reading_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = aggregates.rate(readers.signals(spark, sf_dir), "timestamp", "topic")
    return found.select("topic", "total_count", F.round("rate", 9).alias("rate"))


QUERIES = {f.__name__: f for f in (
    decode_mixed_payloads, extended_properties, event_codec_rules, event_floor_text, millis_times, json_scan, json_by_interval, ingest_signals, ingest_counters, ingest_aggregates,
    window_upserts, latest_by_upserts, topic_count_table, topic_count_memory, agg_window_5min_ordered, late_readings_dropped, stored_offsets, progress_rows, reading_rates,
)}

_DAY = "strftime(date_trunc('day', {}), '%Y-%m-%dT%H:%M:%SZ')"
_WHOLE = "cast(floor(value) as bigint)"
#: Events whose messages can be decoded.
_GOOD = "event_id % 10 not in (2, 3, 4, 5, 6, 7)"
_WINDOWED = """select user_id opc_tag_id, time_bucket(interval '5 minutes', ts) aggregate, count(*) "count", {avg}min({v}) "min", max({v}) "max", {sum} "sum" from events {where} group by 1, 2"""

ORACLE_SQL = {
    "decode_mixed_payloads": f"""select case when k <> 5 then event_id else -1 end id, case when k not in (2, 5) then {_WHOLE} else -1 end value, case when k not in (3, 4, 5, 7) then {_DAY.format("ts")} end "day",
        case when k = 2 then 'Value' when k = 5 then 'payload' when k in (3, 4, 7) then 'Timestamp' else '' end problems from (select *, event_id % 10 k from events) where k <> 6""",
    "extended_properties": """select event_id id, case event_id % 4 when 0 then 3 else 0 end::bigint n, case event_id % 4 when 0 then 'a|null|' || event_type else '' end joined from events""",
    "event_codec_rules": """with e as (select *, event_id % 8 k, md5(event_id::varchar) h from events), m as (select *, concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4), substr(h, 17, 4), substr(h, 21, 12)) u from e)
        select case k when 5 then 'x' else u end id, case k when 1 then 0 else event_id + 1 end "sequence", case when k <> 2 then 'Node-1' end node_id, case k when 7 then '' else u end job_id, case k when 3 then 'OTHER' when 4 then null else 'START' end "type",
        case when k <> 6 then date_trunc('second', ts) end "timestamp", case when event_id % 3 = 0 then 1 else -1 end::bigint "version",
        case k when 1 then 'sequence' when 2 then 'nodeId' when 3 then 'type' when 4 then 'type' when 5 then 'id' when 6 then 'timestamp' when 7 then 'jobId' else '' end problems from m""",
    "event_floor_text": """select event_id, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S.000Z') "hour", strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%S.000Z') "minute" from events""",
    "millis_times": """select event_id, epoch_ms(event_id * 60007) "at", strftime(epoch_ms(event_id * 60007), '%Y-%m-%dT%H:%M:%S.%gZ') "text" from events""",
    "json_scan": f"""select user_id OPCTagID, count(*) n, cast(sum({_WHOLE}) as bigint) total, min(cast({_WHOLE} as varchar)) first_text from events group by 1""",
    "json_by_interval": """with config as (select o_custkey m, o_orderpriority i, o_orderstatus s, rank() over (partition by o_custkey order by o_orderdate desc) rk from orders)
        select i AggregationInterval, user_id OPCTagID, m OPCMetricID, round(sum(value), 2) "Sum", count(value) "Count" from events join config on user_id = m where rk = 1 and s <> 'P' group by 1, 2, 3""",
    "ingest_signals": f"""select user_id opc_tag_id, {_DAY.format("ts")} "day", ts "timestamp", event_id id, {_WHOLE} value from events where {_GOOD}""",
    "ingest_counters": f"""select count(*) total_count, count(*) filter (where not ({_GOOD})) total_error_count, count(*) filter (where {_GOOD}) spark_count from events where event_id % 10 <> 6""",
    "ingest_aggregates": f"""select user_id opc_tag_id, date_trunc('hour', ts) aggregate, count(*) "count", cast(sum({_WHOLE}) as bigint) "sum", min({_WHOLE}) "min", max({_WHOLE}) "max" from events where {_GOOD} group by 1, 2""",
    "window_upserts": _WINDOWED.format(v=_WHOLE, avg=f'round(avg({_WHOLE}), 4) "avg", ', sum=f"cast(sum({_WHOLE}) as bigint)", where=""),
    "latest_by_upserts": f"""with s as (select user_id opc_tag_id, date_trunc('hour', ts) "timestamp", event_id id, {_WHOLE} value from events),
        r as (select *, row_number() over (partition by opc_tag_id, "timestamp" order by id % 3 = 0 desc, id desc) rk from s)
        select opc_tag_id, {_DAY.format('"timestamp"')} "day", "timestamp", id, value from r where rk = 1""",
    "topic_count_table": "select event_type topic, count(*) spark_count from events group by 1",
    "topic_count_memory": """select event_type topic, count(*) "count" from events group by 1""",
    "agg_window_5min_ordered": _WINDOWED.format(v="value", avg='round(avg(value), 4) "avg", ', sum="round(sum(value), 2)", where="") + " order by 2, 1",
    "late_readings_dropped": _WINDOWED.format(v=_WHOLE, avg="", sum=f"cast(sum({_WHOLE}) as bigint)", where=f"where ts >= timestamp '{LATE}'"),
    "stored_offsets": f"""select event_type topic, cast(user_id % 3 as int) "partition", min(event_id) from_offset, max(event_id) + 1 to_offset from events where event_type = '{OFFSET_TOPIC}' group by 1, 2 order by 2 desc""",
    "progress_rows": "select count(*) input_rows from events",
    "reading_rates": "select event_type topic, count(*) total_count, round(count(*) * 1000000.0 / (epoch_us(max(ts)) - epoch_us(min(ts))), 9) rate from events group by 1",
}
