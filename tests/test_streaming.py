import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import aggregates, rollup
from pulsegrid.sources.schemas import RECORD, TABLES
from pulsegrid.streaming import runner
from pulsegrid.streaming.keyed import KeyedTable
from pulsegrid.streaming.state import idle_cumulative


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), "opc_tag_id long, t string, value double").select("opc_tag_id", F.col("t").cast("timestamp").alias("timestamp"), "value")


def _stream(spark, tmp_path, *batches):
    for k, rows in enumerate(batches):
        _rows(spark, *rows).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        time.sleep(1.1)  # files are taken by time
    schema = "opc_tag_id long, timestamp timestamp, value double"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")


def test_window_that_ends_at_the_watermark_is_out(spark, tmp_path):
    s = _stream(spark, tmp_path, [(1, "2024-01-01 11:56:00", 1.0), (1, "2024-01-01 12:01:00", 2.0)], [(1, "2024-01-02 12:00:00", 3.0)])
    out = runner.drain(aggregates.windowed(s, delay="24 hours"), "append", "edge").collect()
    assert [str(r["aggregate"]) for r in out] == ["2024-01-01 11:55:00"]


def test_late_reading_is_dropped_from_a_stream_only(spark, tmp_path):
    late = (1, "2024-01-01 00:00:00", 9.0)
    s = _stream(spark, tmp_path, [(1, "2024-01-05 00:00:00", 1.0)], [(1, "2024-01-05 01:00:00", 1.0)], [late])
    out = runner.drain(aggregates.windowed(s, delay="1 hour"), "append", "late")
    assert out.where("aggregate < '2024-01-02'").count() == 0
    assert aggregates.windowed(_rows(spark, late)).count() == 1


def _aggregates(spark, *rows):
    return spark.createDataFrame(list(rows), TABLES["signal_aggregate"].schema)


T0 = datetime(2024, 1, 1)
ONE, TWO, OTHER = (1, T0, 1, 5, 5, 5), (1, T0, 2, 9, 4, 5), (2, T0, 1, 1, 1, 1)


def _rows_of(table):
    return sorted(tuple(r) for r in table.read().collect())


def test_upsert_and_repeated_batch(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", "signal_aggregate")
    for k, rows in [(0, [ONE, OTHER]), (1, [TWO]), (0, [ONE]), (1, [ONE])]:
        table.apply(_aggregates(spark, *rows), k, "a")
    assert _rows_of(table) == [TWO, OTHER] and table.last_batch("a") == 1 and table.last_batch("b") == -1


def test_two_writers_and_a_new_checkpoint_lose_nothing(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", "signal_aggregate")
    table.apply(_aggregates(spark, ONE), 0, "a")
    table.apply(_aggregates(spark, OTHER), 0, "b")  # another stream's first batch
    assert _rows_of(table) == [ONE, OTHER]
    assert table.compact() == 1
    table.apply(_aggregates(spark, TWO), 0, "c")  # the first batch after a lost checkpoint
    table.apply(_aggregates(spark, ONE), 0, "a")  # a repeated one, behind the compaction
    assert _rows_of(table) == [TWO, OTHER]


def test_a_batch_that_fails_before_its_entry_changes_nothing(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, f"file://{tmp_path}/t", "signal_aggregate")
    table.apply(_aggregates(spark, ONE), 0, "a")
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_enter", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.apply(_aggregates(spark, TWO, OTHER), 1, "a")
    assert _rows_of(table) == [ONE]
    table.apply(_aggregates(spark, TWO, OTHER), 1, "a")
    assert _rows_of(table) == [TWO, OTHER] and table.vacuum() == 1 and _rows_of(table) == [TWO, OTHER]
    assert table.compact() == 1 and table.compact() == 0 and table.vacuum() == 2 and _rows_of(table) == [TWO, OTHER]


def test_last_write_wins_within_a_batch(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", "signals")
    rows = [("z", 1, 10), ("a", 2, 20), (None, 3, 30), ("y", 2, None)]
    table.apply(spark.createDataFrame([(u, i, v, "2024-01-01T00:00:00Z", T0, 1, 1, 7, "t", []) for u, i, v in rows], TABLES["signals"].schema), 0, "a")
    (r,) = table.read().collect()
    assert (r.id, r.value) == (3, 30)


def test_counters_add_up_once(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/c", "signal_validation", {k: "sum" for k in ("producer_count", "producer_error_count", "spark_count")})
    row = spark.createDataFrame([("app", 0, 0, 3)], TABLES["signal_validation"].schema)
    for batch in (0, 0, 1):
        table.apply(row, batch, "a")
    table.compact()
    table.apply(row, 2, "a")
    assert table.read().first().spark_count == 9


def test_stored_order(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", "signal_aggregate")
    table.apply(spark.range(1000).selectExpr("id % 5", "timestamp_seconds(id * 60)", "1L", "1L", "1L", "1L").toDF(*TABLES["signal_aggregate"].schema.fieldNames()).repartition(4), 0, "a")
    for f in tmp_path.glob("t/data/*/_part=*/*.parquet"):
        stored = [(r.opc_tag_id, -r["aggregate"].timestamp()) for r in spark.read.parquet(f"file://{f}").collect()]
        assert stored == sorted(stored)


def test_stop_and_restart(spark, tmp_path):
    """50 in, 50 out, over three runs of one checkpoint."""
    table = KeyedTable(spark, f"file://{tmp_path}/t", "signals")
    schema = TABLES["signals"].schema
    for k in range(3):
        rows = [(None, i, i, "2024-01-01T00:00:00Z", datetime(2024, 1, 1, 0, 0, i), 1, 1, i, "t", []) for i in range(50) if i % 3 == k]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        runner.start(stream, runner.StreamConfig("again", f"file://{tmp_path}/cp"), table.apply).awaitTermination()
    assert sorted(r.id for r in table.read().collect()) == list(range(50))
    entries = table._entries().values()
    assert len({w for e in entries for w in e["applied"]}) == 1 and len(entries) == 3


def test_ordered_complete_mode(spark, tmp_path):
    s = _stream(spark, tmp_path, [(k, f"2024-01-01 00:{50 - k:02}:00", 1.0) for k in range(40)])
    out = []
    runner.start(aggregates.windowed(s).orderBy("aggregate"), runner.StreamConfig("ordered", f"file://{tmp_path}/cp", "complete"), lambda b, _: out.append([r["aggregate"] for r in b.collect()])).awaitTermination()
    assert out[-1] == sorted(out[-1]) and len(out[-1]) > 5
    with pytest.raises(Exception, match="(?i)sort"):
        runner.start(s.orderBy("timestamp"), runner.StreamConfig("unordered", f"file://{tmp_path}/cp2", "append"), lambda b, _: None)


def test_an_idle_key_is_forgotten(spark, tmp_path):
    """A key that is silent for longer than its time starts from zero; another that goes on doesn't."""
    schema = "opc_tag_id long, timestamp timestamp, value double"
    put = lambda k, *rows: _rows(spark, *rows).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    put(0, (1, "2024-01-01 00:10:00", 1.0))
    s = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*")
    q = idle_cumulative(s, idle_ms=15_000).writeStream.format("memory").queryName("forgets").outputMode("update").option("checkpointLocation", f"file://{tmp_path}/cp").trigger(processingTime="200 milliseconds").start()

    def wait(n):
        for _ in range(300):
            if spark.table("forgets").count() >= n or q.exception():
                return
            time.sleep(0.1)

    try:
        wait(1)
        put(1, (1, "2024-01-01 00:20:00", 2.0))
        wait(2)
        time.sleep(22)
        put(2, (1, "2024-01-01 00:30:00", 4.0))
        wait(3)
    finally:
        q.stop()
    assert sorted((r["count"], r["sum"]) for r in spark.table("forgets").collect()) == [(1, 1.0), (1, 4.0), (2, 3.0)]


def test_broker_options():
    """What the connector is told, without the connector."""
    from pulsegrid.sources import readers

    class Reader:
        def __init__(self):
            self.told = {}

        def format(self, name):
            self.kind = name
            return self

        def options(self, **options):
            self.told |= options
            return self

        def load(self):
            return self

    class Session:
        @property
        def readStream(self):
            return Reader()

    r = readers.message_stream(Session(), "h:1", "a, b", "latest", **{"kafka.security.protocol": "SSL"})
    assert r.kind == "kafka" and r.told == {"kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": "latest", "kafka.security.protocol": "SSL"}
    fixed = readers.message_stream(Session(), "h:1", assign='{"a":[0,1]}', starting='{"a":{"0":0,"1":0}}')
    assert fixed.told == {"kafka.bootstrap.servers": "h:1", "assign": '{"a":[0,1]}', "startingOffsets": '{"a":{"0":0,"1":0}}'}
    with pytest.raises(ValueError):
        readers.message_stream(Session(), "h:1")


def test_metrics_are_pushed(spark, tmp_path):
    got = []
    listener = runner.MetricsListener(lambda *x: got.append(x))
    spark.streams.addListener(listener)
    try:
        s = _stream(spark, tmp_path, [(1, "2024-01-01 00:10:00", 1.0)])
        runner.start(s, runner.StreamConfig("pushed", f"file://{tmp_path}/cp"), lambda b, _: b.collect()).awaitTermination()
        for _ in range(100):
            if any(n == "input_rows" and v == 1.0 and x == {"query": "pushed"} for n, v, x in got):
                break
            time.sleep(0.1)
        assert any(n == "input_rows" and v == 1.0 and x == {"query": "pushed"} for n, v, x in got)
    finally:
        spark.streams.removeListener(listener)


def test_stream_into_a_keyed_table_and_its_progress(spark, sf_dir, tmp_path):
    from pulsegrid.sources import readers

    seen = []
    log = runner.ProgressLog("app", seen.append, "keyed")
    spark.streams.addListener(log)
    try:
        found = aggregates.windowed(readers.signal_stream(spark, sf_dir))
        table = KeyedTable(spark, f"file://{tmp_path}/k", "ss_signal_aggregation")
        q = runner.start(found, runner.StreamConfig("keyed", f"file://{tmp_path}/cp", "update"), sink=table.apply)
        q.awaitTermination()
        assert table.read().agg(F.sum("count")).first()[0] == 1000
        assert runner.offsets_seen(q.lastProgress)
        for _ in range(50):
            if seen:
                break
            time.sleep(0.1)
        assert seen and seen[0][0] == "app"
    finally:
        spark.streams.removeListener(log)


def test_idle_state_counts(spark, tmp_path):
    s = _stream(spark, tmp_path, [(1, "2024-01-01 00:10:00", 1.0), (1, "2024-01-01 00:20:00", 3.0), (2, "2024-01-01 00:10:00", 7.0)])
    q = idle_cumulative(s).writeStream.format("memory").queryName("idle").outputMode("update").option("checkpointLocation", f"file://{tmp_path}/cp").start()
    try:  # timeouts keep such a stream busy, so it is never through with everything
        for _ in range(300):
            if spark.table("idle").count() >= 2 or q.exception():
                break
            time.sleep(0.2)
    finally:
        q.stop()
    assert sorted((r.opc_tag_id, r["count"], r["sum"], r["min"], r["max"]) for r in spark.table("idle").collect()) == [(1, 2, 4.0, 1.0, 3.0), (2, 1, 7.0, 7.0, 7.0)]


def test_record_stream_and_json_sinks(spark, tmp_path):
    from pulsegrid.sources import readers

    row = (bytearray(b"{}"), None, 0, 0, None, "a", 1)
    spark.createDataFrame([row], RECORD).write.parquet(f"{tmp_path}/r")
    got = runner.drain(readers.record_stream(spark, f"{tmp_path}/r").select(F.col("value").cast("string").alias("value")), "append", "records")
    assert [r.value for r in got.collect()] == ["{}"]
    rollup.write_by_interval(spark.createDataFrame([("Hour", 1), ("Day", 2)], "AggregationInterval string, n long"), f"{tmp_path}/j", "g1")
    assert spark.read.json(f"{tmp_path}/j/g1").count() == 2
