"""Whole pipelines, from a message source to a sink: what `python -m pulsegrid NAME` runs.

Each is one frozen dataclass of settings with a method `run(spark)`. Messages come from a broker
(`servers`, `topics`) or from a folder of Parquet files of RECORD rows (`files`). Without a trigger
a stream takes all there is and stops; `run` returns when it has. All sinks bear a repeated batch.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.functions import codec
from pulsegrid.operators import aggregates, rollup
from pulsegrid.operators.sequence import numbered_by
from pulsegrid.sources import files, readers, record_log
from pulsegrid.sources.schemas import INTERVALS
from pulsegrid.streaming import runner
from pulsegrid.streaming.keyed import KeyedTable, stream_id
from pulsegrid.streaming.rowwise import RowFiles

log = logging.getLogger("pulsegrid")
#: How rows of one key are merged: counters add up, and so do partial figures.
COUNTERS = {"producer_count": "sum", "producer_error_count": "sum", "spark_count": "sum"}
FIGURES = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}


@dataclass(frozen=True, kw_only=True)
class Streaming:
    """Settings that all streams share. Flags are real booleans; what has no default is required."""

    #: Name of the query and of the counters that it adds to.
    app: str
    #: Folder of the checkpoint; shared by driver and executors.
    checkpoint: str
    servers: str = ""
    topics: str = ""
    #: JSON of fixed partitions, instead of a subscription.
    assign: str | None = None
    #: earliest, latest, or offsets as JSON.
    starting: str = "earliest"
    #: Folder of a record log, instead of a broker.
    log: str | None = None
    files: str | None = None
    files_at_once: int | None = None
    #: Processing time between batches, such as "5 seconds".
    trigger: str | None = None
    #: Where progress goes as a keyed table, while the stream runs; nowhere by default.
    statistics: str | None = None
    #: Where readings that cannot be decoded go, as JSON; or stop at the first one.
    quarantine: str | None = None
    fail_fast: bool = False
    #: Keep the stream's state in RocksDB instead of in memory.
    rocksdb: bool = False
    #: Deltas of a part of a keyed table after which a batch compacts it; 0: never.
    compact_every: int = 0
    #: Options; see `records`.
    options: dict[str, str] = field(default_factory=dict)

    def records(self, spark: SparkSession) -> DataFrame:
        """Messages of the broker, of a record log, or of files. Of `options` those under `source.` go to the
        source as they are, without that prefix; the broker's own are `source.kafka...`."""
        passed = readers.passed_through(self.options, "source.")
        if unknown := self.options.keys() - {f"source.{k}" for k in passed}:
            raise ValueError(f"options must begin with source.: {sorted(unknown)}")
        if self.files:
            return readers.record_stream(spark, self.files, self.files_at_once)
        if self.log:
            return record_log.stream(spark, self.log, self.topics, self.assign, self.starting, **passed)
        if not self.servers:
            raise ValueError("servers, log or files must be set")
        return readers.message_stream(spark, self.servers, self.topics, self.starting, self.assign, **passed)

    def signals(self, spark: SparkSession) -> tuple[DataFrame, StreamingQuery | None]:
        """Good readings for a stream of figures, and the stream beside it that feeds it.

        Figures have no room for readings that cannot be decoded, so one stream decodes each message once:
        it writes the bad ones to `quarantine` and the good ones to a folder beside the checkpoint, which
        the stream of figures follows and clears. With `fail_fast` nothing stands between."""
        if not (self.quarantine or self.fail_fast):
            raise ValueError("quarantine or fail_fast must be set: a reading that cannot be decoded must not vanish")
        decoded = codec.decode_signals(self.records(spark))
        if self.fail_fast:
            return codec.split_quarantine(decoded, True)[0], None
        at = f"{self.checkpoint}-decoded"

        def sink(batch: DataFrame, number: int) -> None:
            name = f"{stream_id(spark)}-{number:012d}"
            if name in files.names(spark, f"{at}/rows"):
                return
            good, bad = codec.split_quarantine(batch)
            keep_apart(bad, self.quarantine, number)
            good.write.mode("overwrite").parquet(f"{at}/making/{name}")
            files.rename(spark, f"{at}/making/{name}", f"{at}/rows/{name}")  # there at once, or not at all

        files.make_folder(spark, f"{at}/rows")
        config = runner.StreamConfig(f"{self.app}-decoded", f"{at}/checkpoint", "append", self.trigger)
        first = runner.start(decoded, config, sink)
        if not self.trigger:
            first.awaitTermination()
        good = spark.readStream.schema(codec.split_quarantine(decoded)[0].schema).option("cleanSource", "delete").parquet(f"{at}/rows/*")
        return good, first

    def stream(self, spark: SparkSession, df: DataFrame, mode: str, sink: Callable[[DataFrame, int], None] | None = None, path: str | None = None, fmt: str = "parquet", beside: StreamingQuery | None = None, rows: object | None = None) -> None:
        listener = runner.ProgressTable(spark, self.app, self.statistics) if self.statistics else None
        if listener:
            spark.streams.addListener(listener)
        try:
            query = runner.start(df, runner.StreamConfig(self.app, self.checkpoint, mode, self.trigger, "rocksdb" if self.rocksdb else "memory"), sink, path, fmt, rows)
            while not query.awaitTermination(1):
                if beside and beside.exception():
                    break
            if beside:
                beside.awaitTermination()  # raises what stopped it
        finally:
            if beside:
                beside.stop()
            if listener:
                listener.close(query.recentProgress)
                spark.streams.removeListener(listener)


def keep_apart(bad: DataFrame, folder: str, number: int) -> None:
    """Write a batch's readings that cannot be decoded as JSON. The folder is the batch's and its stream's own,
    so a repeated batch writes the same again and nothing of another stream, or of one with a new checkpoint."""
    bad.write.mode("overwrite").json(f"{folder}/stream={stream_id(bad.sparkSession)}/batch={number}")


@dataclass(frozen=True, kw_only=True)
class Ingest(Streaming):
    """Raw readings, their counts and their figures by tag and HOUR or MINUTE, from one decoding.

    Each batch is decoded once, into a table beside the checkpoint that the batch deletes when it is done;
    readings, and those that cannot be decoded, are counted by that very write. From it up to three tables
    below `out` are fed: `signals`, `counters` and `aggregates`, whose figures are merged by key, so
    readings of any age count and no state grows. A batch that fails midway is repeated; tables that
    have it already leave it out."""

    out: str
    unit: str = "HOUR"
    raw: bool = True
    counts: bool = True
    figures: bool = True

    def run(self, spark: SparkSession) -> None:
        if not (self.quarantine or self.fail_fast or self.counts):
            raise ValueError("quarantine, fail_fast or counts must be set: a reading that cannot be decoded must not vanish")
        table = lambda *what: KeyedTable(spark, f"{self.out}/{what[0]}", *what[1:], compact_every=self.compact_every)
        signals, counters, aggregated = table("signals", "signals"), table("counters", "signal_validation", COUNTERS), table("aggregates", "signal_aggregate", FIGURES)

        def sink(batch: DataFrame, number: int) -> None:
            seen, at = Observation(), f"{self.checkpoint}-decoded/batch={number}"
            batch.observe(seen, *aggregates.decoded_counts()).write.mode("overwrite").parquet(at)
            if self.fail_fast and seen.get.get("producer_error_count"):
                codec.split_quarantine(spark.read.schema(batch.schema).parquet(at), True)[0].foreachPartition(lambda _: None)  # says which
            decoded = spark.read.schema(batch.schema).parquet(at)
            good, bad = codec.split_quarantine(decoded, self.fail_fast)
            if self.quarantine:
                keep_apart(bad, self.quarantine, number)
            if self.raw:
                signals.apply(good, number)
            if self.counts:
                counters.apply(aggregates.counter_row(spark, self.app, seen.get), number)
            if self.figures:
                aggregated.apply(aggregates.bucketed(good, self.unit), number)
            files.delete(spark, at)

        self.stream(spark, codec.decode_signals(self.records(spark)), "append", sink)


@dataclass(frozen=True, kw_only=True)
class PersistSignals(Streaming):
    """Raw readings into the keyed table `signals`; what cannot be decoded goes to `quarantine`."""

    out: str

    def run(self, spark: SparkSession) -> None:
        if not (self.quarantine or self.fail_fast):
            raise ValueError("quarantine or fail_fast must be set: a reading that cannot be decoded must not vanish")
        table = KeyedTable(spark, self.out, "signals", compact_every=self.compact_every)

        def sink(batch: DataFrame, number: int) -> None:
            good, bad = codec.split_quarantine(batch, self.fail_fast)
            if self.quarantine:
                keep_apart(bad, self.quarantine, number)
            table.apply(good, number)

        self.stream(spark, codec.decode_signals(self.records(spark)), "append", sink)


#: Name under which a stream's progress has the readings that it counts.
READINGS = "readings"


@dataclass(frozen=True, kw_only=True)
class ObservedSignals(Streaming):
    """Readings appended to Parquet files, and counted by that write: all, bad and good ones are in each
    progress under READINGS, where `statistics` and `MetricsListener` find them. Bad ones are counted only."""

    out: str

    def run(self, spark: SparkSession) -> None:
        seen = codec.decode_signals(self.records(spark)).observe(READINGS, *aggregates.decoded_counts())
        self.stream(spark, codec.split_quarantine(seen, self.fail_fast)[0], "append", path=self.out)


@dataclass(frozen=True, kw_only=True)
class PersistParquet(Streaming):
    """Messages as they came, as text, appended to Parquet files."""

    out: str

    def run(self, spark: SparkSession) -> None:
        self.stream(spark, self.records(spark).select(F.col("value").cast("string").alias("value")), "append", path=self.out)


@dataclass(frozen=True, kw_only=True)
class PersistRows(Streaming):
    """Messages row by row as JSON lines; those without payload are logged and kept apart."""

    out: str

    def run(self, spark: SparkSession) -> None:
        self.stream(spark, self.records(spark), "append", rows=RowFiles(self.out))


@dataclass(frozen=True, kw_only=True)
class Produce:
    """Readings (a table of Parquet files with the columns of SIGNAL and `topic`) as messages at the end of a
    record log. A message's partition is its tag's, so a tag's messages keep their order: by time and id.
    Offsets go on where each partition ends."""

    readings: str
    log: str
    partitions: int = 3

    def run(self, spark: SparkSession) -> None:
        record_log.append(self.messages(spark.read.parquet(self.readings), record_log.ends(spark, self.log)), self.log)

    def messages(self, rows: DataFrame, ends: DataFrame) -> DataFrame:
        place = F.pmod(F.xxhash64("opc_tag_id"), F.lit(self.partitions)).cast("int")
        coded = rows.select("topic", "timestamp", "id", place.alias("partition"), F.col("opc_tag_id").cast("string").cast("binary").alias("key"), codec.signal_json().alias("value"))
        numbered = numbered_by(coded, ["topic", "partition"], ["timestamp", "id"])
        found = numbered.join(F.broadcast(ends), ["topic", "partition"], "left")  # a row for each partition of the log
        offset = F.coalesce("until", F.lit(0)) + F.col("place")
        return found.select(F.col("value").cast("binary").alias("value"), "timestamp", F.lit(0).alias("timestampType"), "partition", "key", "topic", offset.alias("offset"))


@dataclass(frozen=True, kw_only=True)
class Cumulative(Streaming):
    """Figures so far of each tag and HOUR or MINUTE, kept as the stream's state. Readings of any age
    count; with `delay` the state is bounded and later ones are dropped. `Ingest` counts readings."""

    out: str
    unit: str = "HOUR"
    delay: str | None = None

    def run(self, spark: SparkSession) -> None:
        rows, first = self.signals(spark)
        if self.delay:
            rows = rows.withWatermark("timestamp", self.delay)
        table = KeyedTable(spark, self.out, "signal_aggregate", compact_every=self.compact_every)
        self.stream(spark, aggregates.bucketed(rows, self.unit), "update", table.apply, beside=first)


@dataclass(frozen=True, kw_only=True)
class WindowAggregates(Streaming):
    """Figures of each tag and window, late readings dropped after `delay`."""

    out: str
    delay: str
    minutes: int = 5
    mode: str = "append"

    def run(self, spark: SparkSession) -> None:
        rows, first = self.signals(spark)
        table = KeyedTable(spark, self.out, "ss_signal_aggregation", compact_every=self.compact_every)
        self.stream(spark, aggregates.windowed(rows, self.minutes, self.delay), self.mode, table.apply, beside=first)


@dataclass(frozen=True, kw_only=True)
class TopicCounts(Streaming):
    """Messages of each topic so far."""

    out: str

    def run(self, spark: SparkSession) -> None:
        table = KeyedTable(spark, self.out, "ss_signal_validation")
        counts = aggregates.per_topic(self.records(spark)).select(F.lit(self.app).alias("id"), "topic", F.col("count").alias("spark_count"))
        self.stream(spark, counts, "complete", table.apply)


@dataclass(frozen=True, kw_only=True)
class LogOffsets(Streaming):
    """Logs the offsets of each batch by topic and partition; with `out` keeps them as a table. They
    are for reading only: a stream goes on from its checkpoint."""

    out: str | None = None

    def run(self, spark: SparkSession) -> None:
        table = KeyedTable(spark, self.out, "offsets") if self.out else None

        def sink(batch: DataFrame, number: int) -> None:
            found = batch.groupBy("topic", "partition").agg(F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("to_offset"))
            rows = found.collect()  # one row for each partition of a topic
            for r in sorted(rows, key=lambda r: (r.topic, -r.partition)):
                log.info("batch %d: %s %d from %d until %d", number, *r)
            if table:
                table.apply(spark.createDataFrame(rows, found.schema), number)

        self.stream(spark, self.records(spark).select("topic", "partition", "offset"), "append", sink)


@dataclass(frozen=True, kw_only=True)
class Rollup:
    """All intervals' rollups of a table of readings by the newest configurations, as JSON by interval
    below `out`/`generation`; `single_files` makes one file of each, for what reads only one."""

    configs: str
    readings: str
    out: str
    generation: str
    single_files: bool = False
    #: Handed (interval, JSON lines) of each interval that has rows, to send them on; not from the command line.
    send: Callable[[str, str], None] | None = None

    def run(self, spark: SparkSession) -> None:
        configs = rollup.latest_weighted(readers.read_configs(spark, self.configs)).where(F.col("AggregationInterval").isin(*INTERVALS))
        readings = spark.read.schema("OPCTagID long, Value string").json(self.readings).withColumn("Value", F.expr("try_cast(Value as double)"))
        found = rollup.rollup(readings, configs)
        if self.single_files:
            found = found.repartition(len(INTERVALS), "AggregationInterval")
        rollup.write_by_interval(found, self.out, self.generation)
        if self.send:
            rollup.send_by_interval(spark, self.out, self.generation, self.send)


@dataclass(frozen=True, kw_only=True)
class Fail:
    """Fails at once, to see what a supervisor makes of it."""

    def run(self, spark: SparkSession) -> None:
        raise RuntimeError("failed on purpose")


PIPELINES = {
    "ingest": Ingest,
    "persist-signals": PersistSignals,
    "observed-signals": ObservedSignals,
    "persist-parquet": PersistParquet,
    "persist-rows": PersistRows,
    "produce": Produce,
    "cumulative": Cumulative,
    "window-aggregates": WindowAggregates,
    "topic-counts": TopicCounts,
    "log-offsets": LogOffsets,
    "rollup": Rollup,
    "fail": Fail,
}
