"""Registered queries over record logs, state, observed counts, drifted payloads and bucketed tables, and their SQL."""

from __future__ import annotations

import hashlib
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions import codec
from pulsegrid.operators import aggregates, rollup
from pulsegrid.operators.sequence import dense_sequence
from pulsegrid.plans import pipelines
from pulsegrid.sources import bucketed, readers, record_log
from pulsegrid.sources.schemas import TABLES, ddl
from pulsegrid.streaming import runner, state
from pulsegrid.streaming.keyed import KeyedTable

#: Records before it are in the log when a stream starts for the first time, the others when it starts again.
EARLIER = "offset < {half}"
#: Idle time that ends a session.
IDLE_HOURS = 6
BUCKETS = 8


def _ntz(name: str):
    return F.col(name).cast("timestamp_ntz").alias(name)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records: a topic for each type, three partitions, their ids as offsets."""
    from pulsegrid.plans.flows import payload

    return payload(readers.table(spark, sf_dir, "events"))


def _halves(rows: DataFrame, column: str) -> list[DataFrame]:
    """Rows below and from the middle of a column's range on."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    half = (low + high + 1) // 2 if low is not None else 0
    return [rows.where(F.col(column) < half), rows.where(F.col(column) >= half)]


def _log(spark: SparkSession, sf_dir: str, label: str) -> str:
    at = runner.shared_folder(spark, label)
    record_log.append(messages(spark, sf_dir), f"{at}/log")
    return at


def _followed(spark: SparkSession, sf_dir: str, label: str, **chosen: str) -> DataFrame:
    """What a stream over a log takes: started on half of the records, and again when the others have come."""
    at = runner.shared_folder(spark, label)
    for part in _halves(messages(spark, sf_dir), "offset"):
        record_log.append(part, f"{at}/log")
        taken = record_log.stream(spark, f"{at}/log", **chosen)
        runner.start(taken, runner.StreamConfig(label, f"{at}/checkpoint"), path=f"{at}/out").awaitTermination()
    return spark.read.schema(taken.schema).parquet(f"{at}/out")


def _taken(records: DataFrame) -> DataFrame:
    return records.select("topic", "partition", "offset", F.length(F.col("value").cast("string")).alias("length"), _ntz("timestamp"))


def log_subscribe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two topics by name, from the beginning, over a restart."""
    return _taken(_followed(spark, sf_dir, "log-subscribe", topics="view, purchase"))


def log_assign_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed partitions, from given offsets."""
    starting = json.dumps({"view": {"1": 500, "2": -2}, "click": {"0": -1}})
    return _taken(_followed(spark, sf_dir, "log-assign", assign='{"view": [1, 2], "click": [0]}', starting=starting))


def log_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only what comes after the first start; all topics that a pattern finds."""
    return _taken(_followed(spark, sf_dir, "log-latest", subscribePattern="[pv].*", starting="latest"))


def log_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic and partitions that appear after the first start, with `latest`, are read from where they begin."""
    at = runner.shared_folder(spark, "log-discovery")
    rows = messages(spark, sf_dir).where("topic in ('view', 'click')")
    for part in (rows.where("topic = 'view' and partition = 0"), rows.where("not (topic = 'view' and partition = 0)")):
        record_log.append(part, f"{at}/log")
        taken = record_log.stream(spark, f"{at}/log", topics="view,click", starting="latest")
        runner.start(taken, runner.StreamConfig("log-discovery", f"{at}/checkpoint"), path=f"{at}/out").awaitTermination()
    return _taken(spark.read.schema(taken.schema).parquet(f"{at}/out"))


def log_offsets_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log read batch by batch by a pipeline that saves the offsets, passed-through options included."""
    at = _log(spark, sf_dir, "log-offsets")
    settings = {"app": "log-offsets", "checkpoint": f"{at}/checkpoint", "log": f"{at}/log", "starting": "earliest"}
    pipelines.LogOffsets(**settings, out=f"{at}/out", options={"source.subscribePattern": "v.*|click"}).run(spark)
    return KeyedTable(spark, f"{at}/out", "offsets").read()


def offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offsets of each topic as the log has them."""
    found = record_log.records(spark, f"{_log(spark, sf_dir, 'offset-ranges')}/log", subscribePattern=".*")
    return aggregates.offset_ranges(found).orderBy(F.desc("topic"))


def idle_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each tag, over four micro-batches in the order of time; those that are over."""
    at = runner.shared_folder(spark, "idle-sessions")
    rows = readers.signals(spark, sf_dir).select("opc_tag_id", "timestamp", "value", F.col("timestamp").cast("long").alias("s"))
    for part in [q for half in _halves(rows, "s") for q in _halves(half, "s")]:
        part.drop("s").write.mode("append").parquet(f"{at}/in")
        stream = spark.readStream.schema(part.drop("s").schema).parquet(f"{at}/in")
        found = state.idle_sessions(stream, f"{IDLE_HOURS} hours")
        runner.start(found, runner.StreamConfig("idle-sessions", f"{at}/checkpoint", state="rocksdb"), path=f"{at}/out").awaitTermination()
    out = spark.read.schema(found.schema).parquet(f"{at}/out")
    return out.select("opc_tag_id", _ntz("started"), _ntz("ended"), "readings", "count", F.round("sum", 2).alias("sum"), "min", "max")


def stats_by_day_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics by day from partials of five minutes that are stored, not from readings."""
    at = runner.shared_folder(spark, "moments")
    five = F.window("timestamp", "5 minutes").start.alias("window")
    aggregates.moments(readers.signals(spark, sf_dir), "value", "topic", five).write.parquet(at)
    stored = spark.read.parquet(at)
    found = aggregates.described(aggregates.merge_moments(stored, "topic", F.date_format("window", "yyyy-MM-dd").alias("day")))
    # a hair up, so that what lies between two rounded values falls to the same one in any arithmetic
    rounded = [F.round(F.col(c) + 1e-8, n).alias(c) for c, n in (("sum", 2), ("mean", 4), ("variance", 3), ("stdev", 4))]
    return found.select("topic", "day", "count", "min", "max", *rounded)


def observed_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that a stream counts while it writes them, taken from its stored progress, over two runs."""
    at = runner.shared_folder(spark, "observed")
    app, table = f"observed-{uuid.uuid4().hex[:8]}", KeyedTable(spark, f"{at}/progress", "query_statistics")
    for part in _halves(messages(spark, sf_dir), "offset"):
        part.write.mode("append").parquet(f"{at}/in")
        pipelines.ObservedSignals(app=app, checkpoint=f"{at}/checkpoint", files=f"{at}/in", out=f"{at}/out", statistics=f"{at}/progress").run(spark)
    seen = F.from_json(F.get_json_object("json", f"$.observedMetrics.{pipelines.READINGS}"), "producer_count long, producer_error_count long, spark_count long")
    total = [F.sum(seen[c]).alias(c) for c in ("producer_count", "producer_error_count", "spark_count")]
    return table.read().agg(*total, F.lit(spark.read.parquet(f"{at}/out").count()).alias("written"))


def _written_rows(spark: SparkSession, sf_dir: str, kind: str, schema: str) -> DataFrame:
    at = runner.shared_folder(spark, "row-writer")
    for part in _halves(messages(spark, sf_dir), "offset"):
        record_log.append(part, f"{at}/log")
        pipelines.PersistRows(app="rows", checkpoint=f"{at}/checkpoint", log=f"{at}/log", topics="view,click,purchase", out=f"{at}/out").run(spark)
    return spark.read.schema(schema).json(f"{at}/out/{kind}/*/*/")


def row_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages written row by row and read back."""
    found = _written_rows(spark, sf_dir, "rows", "topic string, partition int, offset long, value string")
    return found.select("topic", "partition", "offset", F.length("value").alias("length"))


def row_writer_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without payload, which the row writer keeps apart."""
    return _written_rows(spark, sf_dir, "empty", "topic string, partition int, offset long")


def _totals_stream(spark: SparkSession, sf_dir: str, label: str) -> tuple[str, DataFrame]:
    """A stream of running totals over several micro-batches and a restart, its state in RocksDB; its folder."""
    at = runner.shared_folder(spark, label)
    rows = readers.signals(spark, sf_dir).select("opc_tag_id", "id", F.col("value").cast("decimal(18,2)").alias("value"))
    table = KeyedTable(spark, f"{at}/out", "running_totals")
    for part in _halves(rows, "id"):
        part.repartition(3).write.mode("append").parquet(f"{at}/in")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
        found = stream.groupBy("opc_tag_id").agg(F.sum("value").alias("total"), F.count("value").alias("count"))
        runner.start(found, runner.StreamConfig(label, f"{at}/checkpoint", "update", state="rocksdb"), sink=table.apply).awaitTermination()
    return at, table.read()


def _totals(found: DataFrame) -> DataFrame:
    total = F.col("total").cast("double")
    return found.select("opc_tag_id", total.alias("running_sum"), F.col("count").alias("running_count"), F.round(total / F.col("count"), 6).alias("running_avg"))


def running_totals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum, count and average of each tag so far, as a stream in update mode: each batch has what has changed."""
    return _totals(_totals_stream(spark, sf_dir, "running-totals")[1])


def running_totals_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same totals read from the state that the stream has left, without the stream."""
    at, _ = _totals_stream(spark, sf_dir, "running-state")
    held = runner.state_of(spark, f"{at}/checkpoint")
    total, count = held.columns[1], held.columns[-1]
    return _totals(held.select("opc_tag_id", F.col(f"`{total}`").alias("total"), F.col(f"`{count}`").alias("count")))


def _drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of mixed shapes; by the id's last digit 1 has a field more, 2 an object for a value, 3 another
    name for it, 4 is in an array, 5 has a text for a number, 6 is no object, 7 no JSON."""
    k = F.col("event_id") % 10
    whole = F.floor("value").cast("long").cast("string")
    value = F.when(k == 2, F.concat(F.lit('"Value":{"v":'), whole, F.lit("}"))).when(k == 3, F.concat(F.lit('"Val":'), whole)).otherwise(F.concat(F.lit('"Value":'), F.when(k == 5, '"many"').otherwise(whole)))
    more = F.when(k == 1, F.concat(F.lit(',"Site":{"name":"'), "event_type", F.lit('","no":1}'))).when(k == 9, ',"Site":null').otherwise("")
    one = F.concat(F.lit('{"ID":'), F.col("event_id").cast("string"), F.lit(","), value, more, F.lit(',"Timestamp":"2024-01-01T00:00:00Z"}'))
    text = F.when(k == 4, F.concat(F.lit("["), one, F.lit("]"))).when(k == 6, F.col("event_id").cast("string")).when(k == 7, "{").otherwise(one)
    return codec.decode_drifted(readers.table(spark, sf_dir, "events").select(text.alias("value")))


def drifted_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of mixed shapes: what could be read, and what else was there."""
    found = _drifted(spark, sf_dir).groupBy("id", "value", F.array_join("lost", ",").alias("lost"), F.array_join(F.map_keys("extra"), ",").alias("fields"), F.array_join(F.map_values("extra"), ",").alias("extra"))
    return found.agg(F.count("*").alias("readings")).select(F.coalesce("id", F.lit(-1)).alias("id"), F.coalesce("value", F.lit(-1)).alias("value"), "lost", "fields", "extra", "readings")


def drifted_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.unknown_fields(_drifted(spark, sf_dir))


def rollup_bucketed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollups over tables in buckets of the tag: neither grouping nor join moves a row."""
    at, tag = runner.shared_folder(spark, "bucketed"), uuid.uuid4().hex[:12]
    rows = readers.signals(spark, sf_dir).select(F.col("opc_tag_id").alias("OPCTagID"), "timestamp", F.col("value").alias("Value"))
    readings = bucketed.ensure(spark, f"readings_{tag}", rows, "OPCTagID", BUCKETS, ("timestamp",), f"{at}/readings")
    held = rollup.chosen(rollup.latest_weighted(readers.configs(spark, sf_dir)))
    held = bucketed.ensure(spark, f"configs_{tag}", held, "OPCTagID", BUCKETS, ("OPCMetricID",), f"{at}/configs")
    found = rollup.weighted(rollup.figures_by_tag(readings), held, ["AggregationInterval", "OPCTagID", "OPCMetricID"])
    return found.select("AggregationInterval", "OPCTagID", "OPCMetricID", F.round("Sum", 2).alias("Sum"), "Count", F.round("Average", 4).alias("Average"), "Minimum", "Maximum")


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.table(spark, sf_dir, "events").select("ts", "event_id", "event_type")
    return dense_sequence(rows, ["ts", "event_id"], f"{runner.shared_folder(spark, 'sequence')}/rows")


def event_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events numbered by time and id."""
    return _numbered(spark, sf_dir).select("sequence", "event_id", "event_type")


def cycle_generator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by their numbers as cycles of one node: odd ones start a job and even ones end it."""
    found = readers.as_cycle(_numbered(spark, sf_dir))
    return found.select("sequence", F.lit("Node-1").alias("node_id"), "job_id", "type", F.col("ts").alias("timestamp"), "even")


def produced_consumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings produced into a log in two rounds, and consumed by a stream that stops between them."""
    at = runner.shared_folder(spark, "produce")
    rows = readers.signals(spark, sf_dir).withColumns({"value": F.floor("value").cast("long"), "extended_properties": F.array("topic")})
    for k, part in enumerate(_halves(rows, "id")):
        part.write.parquet(f"{at}/readings/{k}")
        pipelines.Produce(readings=f"{at}/readings/{k}", log=f"{at}/log").run(spark)
        settings = {"app": "consume", "checkpoint": f"{at}/checkpoint", "log": f"{at}/log", "out": f"{at}/out", "fail_fast": True}
        pipelines.PersistSignals(**settings, options={"source.subscribePattern": ".*"}).run(spark)
    found = KeyedTable(spark, f"{at}/out", "signals").read()
    return found.select("opc_tag_id", "day", _ntz("timestamp"), "id", "value", "quality", "proxied_type_name")


def produced_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets of produced messages have no gaps, and a tag's messages are in the order of time."""
    at = runner.shared_folder(spark, "produce-offsets")
    rows = readers.signals(spark, sf_dir).withColumns({"value": F.floor("value").cast("long"), "extended_properties": F.array("topic")})
    for k, part in enumerate(_halves(rows, "id")):
        part.write.parquet(f"{at}/readings/{k}")
        pipelines.Produce(readings=f"{at}/readings/{k}", log=f"{at}/log", partitions=1).run(spark)
    sent = record_log.records(spark, f"{at}/log", subscribePattern=".*")
    return sent.select("topic", "offset", _ntz("timestamp"), F.col("key").cast("string").cast("long").alias("opc_tag_id"))


def sent_by_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollups written as JSON by interval, each file that isn't empty handed on by the executors, and what
    was received read back."""
    at = runner.shared_folder(spark, "send")
    rows = readers.signals(spark, sf_dir).select(F.col("opc_tag_id").alias("OPCTagID"), F.col("value").alias("Value"))
    rollup.write_by_interval(rollup.rollup(rows, rollup.latest_weighted(readers.configs(spark, sf_dir))), f"{at}/out", "g1")
    rollup.send_by_interval(spark, f"{at}/out", "g1", ReceivedFiles(f"{at}/received"))
    back = spark.read.schema("interval string, line string").json(f"{at}/received")
    fields = F.from_json("line", "OPCTagID long, OPCMetricID long, Sum double, Count long")
    return back.select("interval", fields.alias("r")).select("interval", "r.OPCTagID", "r.OPCMetricID", F.round("r.Sum", 2).alias("Sum"), "r.Count")


class ReceivedFiles:
    """A receiver for `rollup.send_by_interval` that keeps what it is sent, a file for each text."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self, interval: str, text: str) -> None:
        from pyarrow import fs

        there, root = fs.FileSystem.from_uri(self.path)
        there.create_dir(root)
        name = hashlib.sha256(f"{interval}\n{text}".encode()).hexdigest()  # a text that is sent again is the same file
        with there.open_output_stream(f"{root}/{name}.json") as f:
            for line in text.splitlines():
                f.write(json.dumps({"interval": interval, "line": line}).encode() + b"\n")


def metrics_pushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a listener pushes of a stream's progress: rows in, and what the stream itself has counted."""
    at = runner.shared_folder(spark, "metrics")
    pushed, app = [], f"metrics-{uuid.uuid4().hex[:8]}"
    listener = runner.MetricsListener(lambda name, value, labels: pushed.append((name, value)) if labels["query"] == app else None)
    messages(spark, sf_dir).write.parquet(f"{at}/in")
    spark.streams.addListener(listener)
    try:
        pipelines.ObservedSignals(app=app, checkpoint=f"{at}/checkpoint", files=f"{at}/in", out=f"{at}/out").run(spark)
        for _ in range(100):  # the listener hears late
            if any(name == f"{pipelines.READINGS}.spark_count" for name, _ in pushed):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    rows = spark.createDataFrame(pushed, "name string, value double")
    wanted = ["input_rows", *[f"{pipelines.READINGS}.{k}" for k in ("producer_count", "producer_error_count", "spark_count")]]
    return rows.where(F.col("name").isin(wanted)).groupBy("name").agg(F.sum("value").cast("long").alias("value"))


def ddl_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the registry made by its SQL, filled, made again without effect, and read by tag and day."""
    at, name = runner.shared_folder(spark, "ddl"), f"signals_{uuid.uuid4().hex[:12]}"
    rows = readers.signals(spark, sf_dir).withColumns({"value": F.floor("value").cast("long"), "extended_properties": F.array("topic"), "day": codec.day_of(F.col("timestamp"))})
    for _ in range(2):
        spark.sql(ddl("signals", name, f"{at}/signals", BUCKETS))
    rows.repartition(BUCKETS, "opc_tag_id").select(*TABLES["signals"].schema.fieldNames()).write.insertInto(name)
    return spark.table(name).groupBy("opc_tag_id", "day").agg(F.count("*").alias("readings"), F.sum("value").alias("total"), F.max("id").alias("last_id"))


QUERIES = {f.__name__: f for f in (
    log_subscribe, log_assign_offsets, log_latest, log_discovery, log_offsets_saved, offset_ranges, idle_sessions, stats_by_day_merged, observed_progress,
    row_writer, row_writer_empty, running_totals_stream, running_totals_state, drifted_payloads, drifted_fields, rollup_bucketed_tables, event_sequence, cycle_generator,
    produced_consumed, produced_offsets, sent_by_interval, metrics_pushed, ddl_tables,
)}

_WHOLE = "cast(floor(value) as bigint)"
#: Length of a message, by the rules of `payload`.
_RECORDS = f"""records as (select event_type topic, cast(user_id % 3 as int) "partition", event_id "offset", ts "timestamp", event_id % 10 k,
    (select (min(event_id) + max(event_id) + 1) // 2 from events) half,
    length(event_id::varchar) + length(user_id::varchar) + length({_WHOLE}::varchar) whole,
    len(list_extract(['2016', '2016-03', '2016-03-03', '2016-03-03T10:00:00', '12:30', 'T12:30:00', 'yesterday'], cast(event_id % 7 + 1 as int))) bad,
    length({_WHOLE}::varchar) v from events),
  sent as (select topic, "partition", "offset", "timestamp", half, cast(case k when 5 then 1 when 6 then 0 when 0 then o when 8 then o + 12 else o + 2 end as int) length from (
    select *, whole + 41 + case when k = 1 then 4 when k = 2 then 5 - v else 0 end + case when k = 7 then 4 when k in (3, 4) then bad + 2 else 29 end o from records))"""
_TAKEN = 'select topic, "partition", "offset", length, "timestamp" from sent'
_ROLLED = """round(sum(value), 2) "Sum", count(value) "Count", round(avg(value), 4) Average, min(value) Minimum, max(value) Maximum"""

ORACLE_SQL = {
    "log_subscribe": f"with {_RECORDS} {_TAKEN} where topic in ('view', 'purchase')",
    "log_assign_offsets": f"""with {_RECORDS} {_TAKEN} where topic = 'view' and "partition" = 1 and "offset" >= 500 or topic = 'view' and "partition" = 2
        or topic = 'click' and "partition" = 0 and "offset" >= half""",
    "log_latest": f"""with {_RECORDS} {_TAKEN} where topic[1] in ('p', 'v') and "offset" >= half""",
    "log_discovery": f"""with {_RECORDS} {_TAKEN} where topic in ('view', 'click') and not (topic = 'view' and "partition" = 0)""",
    "log_offsets_saved": """select event_type topic, cast(user_id % 3 as int) "partition", min(event_id) from_offset, max(event_id) + 1 to_offset
        from events where event_type in ('view', 'click') group by 1, 2""",
    "offset_ranges": "select event_type topic, min(event_id) from_offset, max(event_id) + 1 until_offset, count(*) records from events group by 1 order by 1 desc",
    "idle_sessions": f"""with a as (select *, lag(ts) over w before from events window w as (partition by user_id order by ts, event_id)),
        b as (select *, count(*) filter (where before is null or ts - before > interval '{IDLE_HOURS} hours') over (partition by user_id order by ts, event_id rows unbounded preceding) s from a),
        c as (select user_id opc_tag_id, s, min(ts) started, max(ts) ended, count(*) readings, count(value) "count", round(sum(value), 2) "sum", min(value) "min", max(value) "max" from b group by 1, 2)
        select c.* exclude (s) from c where s < (select max(s) from c d where d.opc_tag_id = c.opc_tag_id) or ended + interval '{IDLE_HOURS} hours' <= (select max(ts) from events)""",
    "stats_by_day_merged": """select event_type topic, strftime(ts, '%Y-%m-%d') "day", count(value) "count", min(value) "min", max(value) "max",
        round(sum(value) + 1e-8, 2) "sum", round(avg(value) + 1e-8, 4) mean, round(var_pop(value) + 1e-8, 3) variance, round(stddev_pop(value) + 1e-8, 4) stdev from events group by 1, 2""",
    "observed_progress": """select count(*) producer_count, count(*) filter (where event_id % 10 in (2, 3, 4, 5, 7)) producer_error_count,
        count(*) filter (where event_id % 10 not in (2, 3, 4, 5, 7)) spark_count, count(*) filter (where event_id % 10 not in (2, 3, 4, 5, 7)) written from events where event_id % 10 <> 6""",
    "row_writer": f"""with {_RECORDS} select topic, "partition", "offset", length from sent where length > 0 and topic in ('view', 'click', 'purchase')""",
    "row_writer_empty": f"""with {_RECORDS} select topic, "partition", "offset" from sent where length = 0 and topic in ('view', 'click', 'purchase')""",
    **{k: """select user_id opc_tag_id, cast(sum(cast(value as decimal(18, 2))) as double) running_sum, count(*) running_count,
        round(cast(sum(cast(value as decimal(18, 2))) as double) / count(*), 6) running_avg from events group by 1""" for k in ("running_totals_stream", "running_totals_state")},
    "drifted_payloads": f"""with e as (select *, event_id % 10 k, {_WHOLE} v from events)
        select case when k in (6, 7) then -1 else event_id end id, case when k in (2, 3, 5, 6, 7) then -1 else v end value,
        case when k in (2, 5) then 'Value' when k in (6, 7) then 'payload' else '' end lost, case k when 1 then 'Site' when 2 then 'Value' when 3 then 'Val' when 5 then 'Value' else '' end fields,
        case k when 1 then '{{"name":"' || event_type || '","no":1}}' when 2 then '{{"v":' || v || '}}' when 3 then v::varchar when 5 then '"many"' else '' end extra, count(*) readings from e group by all""",
    "drifted_fields": """select case event_id % 10 when 1 then 'Site' when 3 then 'Val' else 'Value' end field, count(*) readings from events where event_id % 10 in (1, 2, 3, 5) group by 1""",
    "rollup_bucketed_tables": f"""with config as (select o_custkey m, o_orderpriority i, o_orderstatus s, rank() over (partition by o_custkey order by o_orderdate desc) rk from orders),
        newest as (select *, count(*) over (partition by m) n from config where rk = 1), latest as (select m, i, s from newest, unnest(range(n)))
        select i AggregationInterval, user_id OPCTagID, m OPCMetricID, {_ROLLED} from events join latest on user_id = m where s <> 'P' group by 1, 2, 3""",
    "event_sequence": """select row_number() over (order by ts, event_id) "sequence", event_id, event_type from events""",
    "cycle_generator": """with n as (select ts, row_number() over (order by ts, event_id) i from events), h as (select *, sha256(((i - 1) // 2)::varchar) h from n)
        select i "sequence", 'Node-1' node_id, concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4), substr(h, 17, 4), substr(h, 21, 12)) job_id,
        case when i % 2 = 1 then 'START' else 'END' end "type", ts "timestamp", i % 2 = 0 even from h""",
    "produced_consumed": f"""select user_id opc_tag_id, strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%SZ') "day", ts "timestamp", event_id id, {_WHOLE} value,
        cast(json_extract_string(props, '$.k') as bigint) quality, event_type proxied_type_name from events""",
    "produced_offsets": """with h as (select *, event_id >= (select (min(event_id) + max(event_id) + 1) // 2 from events) later from events)
        select event_type topic, row_number() over (partition by event_type order by later, ts, event_id) - 1 "offset", ts "timestamp", user_id opc_tag_id from h""",
    "sent_by_interval": """with config as (select o_custkey m, o_orderpriority i, o_orderstatus s, rank() over (partition by o_custkey order by o_orderdate desc) rk from orders),
        newest as (select *, count(*) over (partition by m) n from config where rk = 1), latest as (select m, i, s from newest, unnest(range(n)))
        select i "interval", user_id OPCTagID, m OPCMetricID, round(sum(value), 2) "Sum", count(value) "Count" from events join latest on user_id = m where s <> 'P' group by 1, 2, 3""",
    "metrics_pushed": """with e as (select count(*) n, count(*) filter (where event_id % 10 <> 6) sent, count(*) filter (where event_id % 10 in (2, 3, 4, 5, 7)) bad from events)
        select unnest(['input_rows', 'readings.producer_count', 'readings.producer_error_count', 'readings.spark_count']) "name", unnest([n, sent, bad, sent - bad]) value from e""",
    "ddl_tables": f"""select user_id opc_tag_id, strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%SZ') "day", count(*) readings, cast(sum({_WHOLE}) as bigint) total, max(event_id) last_id from events group by 1, 2""",
}
