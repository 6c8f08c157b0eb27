"""Whole pipelines over files of messages."""

import json
import logging

import pytest
from pyspark.sql import functions as F

from pulsegrid.__main__ import main, parser
from pulsegrid.functions import codec
from pulsegrid.operators import aggregates
from pulsegrid.plans import pipelines as P
from pulsegrid.sources import readers
from pulsegrid.streaming.keyed import KeyedTable


@pytest.fixture(scope="module")
def readings(spark, sf_dir):
    s = readers.signals(spark, sf_dir)
    return s.withColumn("value", F.floor("value").cast("long")).withColumn("extended_properties", F.array("topic"))


@pytest.fixture(scope="module")
def messages(spark, readings, tmp_path_factory):
    """1000 readings as messages of two topics, and one that isn't JSON."""
    path = f"file://{tmp_path_factory.mktemp('messages')}/m"
    topic = F.when(F.monotonically_increasing_id() % 2 == 0, "a").otherwise("b")
    good = codec.encode_signals(readings)
    rows = good.unionByName(spark.createDataFrame([("{",)], "value string"))
    rows.select(F.col("value").cast("binary").alias("value"), F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType"), F.lit(0).alias("partition"), F.lit(None).cast("binary").alias("key"), topic.alias("topic"), F.monotonically_increasing_id().alias("offset")).coalesce(1).write.parquet(path)
    return path


@pytest.fixture
def common(messages, tmp_path):
    return {"app": f"app{tmp_path.name}", "checkpoint": f"file://{tmp_path}/cp", "files": messages}


def test_persist_signals(spark, readings, common, tmp_path):
    P.PersistSignals(**common, out=f"file://{tmp_path}/t", quarantine=f"file://{tmp_path}/q").run(spark)
    table = KeyedTable(spark, f"file://{tmp_path}/t", "signals").read()
    keys = readings.select("opc_tag_id", "timestamp").distinct().count()
    assert table.count() == keys == table.select("opc_tag_id", "timestamp").distinct().count()
    assert [r.raw for r in spark.read.json(f"file://{tmp_path}/q").collect()] == ["{"]


def test_persist_parquet_from_the_command_line(spark, common, tmp_path):
    main(["persist-parquet", *[x for k, v in common.items() for x in (f"--{k}", v)], "--out", f"file://{tmp_path}/p"])
    assert spark.read.parquet(f"file://{tmp_path}/p").count() == 1001


@pytest.mark.parametrize("unit", ["HOUR", "MINUTE"])
def test_cumulative(spark, readings, common, tmp_path, unit):
    P.Cumulative(**common, out=f"file://{tmp_path}/t", unit=unit, quarantine=f"file://{tmp_path}/q").run(spark)
    want = aggregates.bucketed(readings, unit).select("opc_tag_id", "aggregate", "count", "sum", "min", "max")
    got = KeyedTable(spark, f"file://{tmp_path}/t", "signal_aggregate").read()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert [r.raw for r in spark.read.json(f"file://{tmp_path}/q").collect()] == ["{"]


def test_ingest_from_one_decoding(spark, readings, common, tmp_path):
    P.Ingest(**common, out=f"file://{tmp_path}/t", unit="MINUTE", quarantine=f"file://{tmp_path}/q").run(spark)
    assert KeyedTable(spark, f"file://{tmp_path}/t/signals", "signals").read().count() == readings.select("opc_tag_id", "timestamp").distinct().count()
    assert tuple(KeyedTable(spark, f"file://{tmp_path}/t/counters", "signal_validation", P.COUNTERS).read().first())[1:] == (1001, 1, 1000)
    want = aggregates.bucketed(readings, "MINUTE").select("opc_tag_id", "aggregate", "count", "sum", "min", "max")
    assert sorted(map(tuple, KeyedTable(spark, f"file://{tmp_path}/t/aggregates", "signal_aggregate", P.FIGURES).read().collect())) == sorted(map(tuple, want.collect()))
    assert [r.raw for r in spark.read.json(f"file://{tmp_path}/q").collect()] == ["{"]


@pytest.mark.parametrize("kind", [P.PersistSignals, P.Cumulative, P.WindowAggregates, P.Ingest])
def test_bad_readings_cannot_vanish(spark, common, tmp_path, kind):
    more = {"delay": "1 hour"} if kind is P.WindowAggregates else {"counts": False} if kind is P.Ingest else {}
    with pytest.raises(ValueError, match="vanish"):
        kind(**common, **more, out=f"file://{tmp_path}/t").run(spark)
    with pytest.raises(Exception, match="cannot decode"):
        kind(**common, **more, out=f"file://{tmp_path}/t", fail_fast=True).run(spark)


def test_window_aggregates_and_statistics(spark, readings, common, tmp_path):
    P.WindowAggregates(**common, out=f"file://{tmp_path}/t", delay="24 hours", mode="update", statistics=f"file://{tmp_path}/s", quarantine=f"file://{tmp_path}/q").run(spark)
    got = KeyedTable(spark, f"file://{tmp_path}/t", "ss_signal_aggregation").read()
    assert got.count() == aggregates.windowed(readings).count()
    assert got.agg(F.sum("count")).first()[0] == 1000
    progress = KeyedTable(spark, f"file://{tmp_path}/s", "query_statistics").read().collect()
    assert progress and all(json.loads(r.json)["name"] == common["app"] for r in progress)


def test_topic_counts(spark, common, tmp_path):
    P.TopicCounts(**common, out=f"file://{tmp_path}/t").run(spark)
    assert KeyedTable(spark, f"file://{tmp_path}/t", "ss_signal_validation").read().agg(F.sum("spark_count")).first()[0] == 1001


def test_offsets(spark, common, tmp_path, caplog):
    with caplog.at_level(logging.INFO, "pulsegrid"):
        P.LogOffsets(**common, out=f"file://{tmp_path}/o").run(spark)
    stored = KeyedTable(spark, f"file://{tmp_path}/o", "offsets").read()
    assert readers.stored_offsets(stored, "a").first().from_offset >= 0
    assert sum("until" in x for x in caplog.messages) == stored.count() == 2


def test_rollup(spark, tmp_path):
    configs = [{"OPCMetricID": 1, "OPCTagID": 5, "Timestamp": f"2024-01-0{d}T00:00:00Z", "AggregationInterval": "Hour", "AggregationType": t} for d, t in ((1, "None"), (2, "Sum"))]
    configs.append({"OPCMetricID": 2, "OPCTagID": 5, "Timestamp": "2024-01-01T00:00:00Z", "AggregationInterval": "Day", "AggregationType": "Sum"})
    for name, rows in (("configs", configs), ("readings", [{"OPCTagID": 5, "Value": "1.5"}, {"OPCTagID": 5, "Value": 2}, {"OPCTagID": 5, "Value": "x"}, {"OPCTagID": 6, "Value": 9}])):
        (tmp_path / f"{name}.json").write_text("\n".join(map(json.dumps, rows)))
    sent = str(tmp_path / "sent")

    def send(interval, text):
        with open(sent, "a") as f:
            f.write(f"{interval} {len(text.splitlines())}\n")

    P.Rollup(configs=f"file://{tmp_path}/configs.json", readings=f"file://{tmp_path}/readings.json", out=f"file://{tmp_path}/out", generation="g1", single_files=True, send=send).run(spark)
    assert sorted((tmp_path / "sent").read_text().splitlines()) == ["Day 1", "Hour 1"]
    got = spark.read.json(f"file://{tmp_path}/out/g1").collect()
    assert sorted((r.AggregationInterval, r.OPCTagID, r.OPCMetricID, r.Sum, r.Count) for r in got) == [("Day", 5, 2, 3.5, 2), ("Hour", 5, 1, 3.5, 2)]


def test_settings(spark, tmp_path):
    with pytest.raises(SystemExit):
        parser().parse_args(["window-aggregates", "--app", "a", "--checkpoint", "c", "--out", "o"])  # no delay
    with pytest.raises(ValueError):
        P.TopicCounts(app="a", checkpoint="c", out="o").run(spark)
    with pytest.raises(RuntimeError):
        P.Fail().run(spark)


def test_batches_write_only_their_rows(spark, tmp_path):
    t = KeyedTable(spark, f"file://{tmp_path}/t", "signal_aggregate")
    rows = lambda *days: spark.createDataFrame([(1, f"2024-01-0{d} 00:00:00", n) for d, n in days], "opc_tag_id long, t string, count long").selectExpr("opc_tag_id", "cast(t as timestamp) aggregate", "count", "count sum", "count min", "count max")
    t.apply(rows((1, 1), (2, 1)), 0, "a")
    t.apply(rows((2, 5), (3, 1)), 1, "a")
    assert sorted((str(r.aggregate)[:10], r["count"]) for r in t.read().collect()) == [("2024-01-01", 1), ("2024-01-02", 5), ("2024-01-03", 1)]
    assert sorted(len(v) for v in t._folders().values()) == [1, 1, 2]
    assert t.read("2024-01-03").count() == 1 and t.compact() == 1 and t.vacuum() == 2 and t.read().count() == 3
