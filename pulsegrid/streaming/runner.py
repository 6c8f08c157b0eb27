"""Running the same transformations as streams, and watching them."""

from __future__ import annotations

import collections
import contextlib
import queue
import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import LongType, StructField, StructType

from pulsegrid.streaming.keyed import KeyedTable


@dataclass(frozen=True)
class StreamConfig:
    """How a stream runs. The checkpoint folder must be shared by driver and executors."""

    name: str
    checkpoint: str
    mode: str = "append"
    trigger: str | None = None  # processing time; None: all there is, then stop
    state: str = "memory"  # or rocksdb: state on disk, checkpointed by what has changed


#: Settings of the state in RocksDB; a stream keeps those that it was started with.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_STARTING = threading.Lock()


@contextlib.contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings while a stream starts, which copies them; one start at a time."""
    with _STARTING:
        before = {k: spark.conf.get(k, None) for k in settings}
        try:
            for k, v in settings.items():
                spark.conf.set(k, v)
            yield
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start(df: DataFrame, config: StreamConfig, sink: Callable[[DataFrame, int], None] | None = None, path: str | None = None, fmt: str = "parquet", rows: object | None = None, **options: str) -> StreamingQuery:
    """Start a stream into a batch function, a writer of rows (`open`, `process`, `close`) or a format: Parquet files (append only), `memory` (a table
    of the stream's name on the driver, for small aggregates), `console`, `json`, or, with its
    connector on the class path, `kafka`."""
    writer = df.writeStream.queryName(config.name).outputMode(config.mode).option("checkpointLocation", config.checkpoint)
    writer = writer.trigger(processingTime=config.trigger) if config.trigger else writer.trigger(availableNow=True)
    with _settings(df.sparkSession, ROCKSDB if config.state == "rocksdb" else {}):
        if rows is not None:
            return writer.foreach(rows).start()
        return writer.foreachBatch(sink).start() if sink else writer.format(fmt).options(**options).start(path)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder under spark.checkpoint.dir; where that is unset and all runs in one process (master
    `local`), a folder of this machine is set."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        top = "file://" + tempfile.mkdtemp(prefix="pulsegrid-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/streams/{label}-{uuid.uuid4().hex}"


def drain(df: DataFrame, mode: str, label: str, keys: tuple[str, ...] = (), state: str = "memory") -> DataFrame:
    """Run a stream over all there is and return what its sink holds: for append the files written, for
    complete the last batch's rows, for update the last row of each of `keys`, which must be given."""
    spark = df.sparkSession
    at = shared_folder(spark, label)
    config = StreamConfig(label, f"{at}/checkpoint", mode, state=state)
    if mode == "append":
        start(df, config, path=f"{at}/out").awaitTermination()
        return spark.read.schema(df.schema).parquet(f"{at}/out")
    if mode == "update":
        if not keys:
            raise ValueError("of a stream in update mode the keys must be named: each batch has only what has changed")
        start(df, config, sink=lambda batch, n: batch.write.mode("overwrite").parquet(f"{at}/out/_batch={n}")).awaitTermination()
        held = spark.read.schema(StructType([*df.schema.fields, StructField("_batch", LongType())])).option("basePath", f"{at}/out").parquet(f"{at}/out/_batch=*")
        last = F.max_by(F.struct(*df.columns), "_batch").alias("_last")
        return held.groupBy(*keys).agg(last).select("_last.*")
    start(df, config, sink=lambda batch, _: batch.write.mode("overwrite").parquet(f"{at}/out")).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{at}/out")


def state_of(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state that a stream's last batch has left, as a table (key, value): an audit that needs no stream."""
    found = spark.read.format("statestore").load(checkpoint)
    return found.select("key.*", "value.*")


class ProgressLog(StreamingQueryListener):
    """Keeps (id, time, json) of each progress of one stream, or of all, and hands it on."""

    def __init__(self, app: str, put: Callable[[tuple[str, str, str]], None], name: str | None = None):
        self.app, self.put, self.name = app, put, name

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.name in (None, p.name):
            self.put((self.app, p.timestamp, p.json))


class ProgressTable(ProgressLog):
    """Writes each progress of one stream into a keyed table of `query_statistics` as it comes. A thread
    of its own writes, so the listener's thread is never held up; what waits is at most what has come
    since the last write."""

    def __init__(self, spark: SparkSession, app: str, path: str):
        super().__init__(app, self._take, app)
        self.table, self._waiting = KeyedTable(spark, path, "query_statistics"), queue.SimpleQueue()
        self._seen: collections.deque = collections.deque(maxlen=1000)
        self._run, self._batch = uuid.uuid4().hex, 0
        self._writer = threading.Thread(target=self._write, daemon=True)
        self._writer.start()

    def _take(self, row: tuple[str, str, str] | None) -> None:
        self._waiting.put(row)

    def _write(self) -> None:
        spark, going = self.table.spark, True
        while going:
            rows = [self._waiting.get()]
            while not self._waiting.empty():
                rows.append(self._waiting.get())
            going = None not in rows
            new = [r for r in dict.fromkeys(rows) if r is not None and r[:2] not in self._seen]
            if new:
                self.table.apply(spark.createDataFrame(new, "id string, time string, json string"), self._batch, self._run)
                self._batch += 1
                self._seen.extend(r[:2] for r in new)

    def close(self, recent) -> None:
        """Write what has come; `recent` is the query's own last progress, since the listener hears late."""
        for p in recent:
            self._take((self.app, p.timestamp, p.json))
        self._take(None)
        self._writer.join()


class MetricsListener(StreamingQueryListener):
    """Hands the figures of each progress to `push(name, value, labels)`, for whatever exports metrics."""

    def __init__(self, push: Callable[[str, float, dict[str, str]], None]):
        self.push = push

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        p = event.progress
        labels = {"query": p.name or str(p.id)}
        for name, value in (("batch", p.batchId), ("input_rows", p.numInputRows), ("input_rows_per_second", p.inputRowsPerSecond), ("processed_rows_per_second", p.processedRowsPerSecond)):
            self.push(name, float(value or 0), labels)
        for name, row in p.observedMetrics.items():  # what the stream has counted itself, by `observe`
            for key, value in row.asDict().items():
                self.push(f"{name}.{key}", float(value or 0), labels)


def offsets_seen(progress) -> list[tuple[str, str, str]]:
    """(source, from, until) of one progress, as the source words them."""
    return [(s.description, s.startOffset, s.endOffset) for s in progress.sources]
