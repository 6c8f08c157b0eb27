import json

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import codec
from pulsegrid.operators import aggregates, rollup
from pulsegrid.sources import readers

GOOD = {"ExtendedProperties": ["a", None], "ProxiedTypeName": "t", "OPCTagID": 12, "OPCTagReadingID": 1, "Quality": 3, "Timestamp": "2021-07-08T09:10:11.1234567Z", "Value": "640", "ID": 7, "UniqueID": None}
ID = "00000000-0000-4000-8000-00000000000a"


def _decode(spark, *payloads):
    rows = [(p if isinstance(p, (bytes, type(None))) else json.dumps(p).encode(),) for p in payloads]
    return codec.decode_signals(spark.createDataFrame(rows, "value binary")).collect()


@pytest.mark.parametrize("given,want", [("640", 640), (640, 640), ("12.7", 12), (12.7, 12), ("abc", None), (None, None)])
def test_value_forms(spark, given, want):
    (r,) = _decode(spark, [GOOD | {"Value": given}])
    assert r.value == want
    assert r.problems == (["Value"] if given == "abc" else [])


def test_shapes(spark):
    bare, two = _decode(spark, GOOD, [GOOD, GOOD | {"ID": 8}])
    assert bare.id == two.id == 7
    assert bare.day == "2021-07-08T00:00:00Z"
    assert bare.timestamp.microsecond == 123456
    assert bare.extended_properties == ["a", None]


def test_missing_and_bad(spark):
    assert _decode(spark, b"", None) == []
    (bad,) = _decode(spark, b"{")
    assert bad.problems and bad.raw == "{"
    (few,) = _decode(spark, [{"ID": 1, "Timestamp": "2016-03-03T00:00:00Z"}])
    assert few.extended_properties == [] and few.quality is None and few.problems == []


@pytest.mark.parametrize("text", ["2016", "2016-03", "2016-03-03", "2016-03-03T10:00:00", "2016-03-03 10:00:00Z", "12:30", "T12:30:00", "yesterday", "2016-02-30T00:00:00Z", "2016-03-03T10:00Z", "", None])
def test_only_full_instants_are_times(spark, text):
    (r,) = _decode(spark, [GOOD | {"Timestamp": text}])
    assert r.problems == ["Timestamp"] and r.timestamp is None and r.day is None
    (e,) = codec.decode_events(spark.createDataFrame([(json.dumps({"id": ID, "sequence": 1, "nodeId": "n", "jobId": ID, "type": "START", "timestamp": text}),)], "value string")).collect()
    assert e.problems == ["timestamp"]


def test_now_as_text(spark):
    r = spark.range(1).select(codec.now_iso().alias("n"), codec.from_millis(F.lit(1_500)).alias("m")).first()
    assert r.n[10] == "T" and r.n.endswith("Z") and len(r.n) == 24 and str(r.m) == "1970-01-01 00:00:01.500000"


def test_quarantine_and_fail_fast(spark):
    raw = spark.createDataFrame([(json.dumps([GOOD]),), ("{",)], "value string")
    good, bad = codec.split_quarantine(codec.decode_signals(raw))
    assert good.count() == 1 and bad.count() == 1
    with pytest.raises(Exception, match="cannot decode"):
        codec.split_quarantine(codec.decode_signals(raw), fail_fast=True)[0].collect()


def test_signal_round_trip(spark):
    raw = spark.createDataFrame([(json.dumps([GOOD]),)], "value string")
    good, _ = codec.split_quarantine(codec.decode_signals(raw))
    back = json.loads(codec.encode_signals(good).first().value)
    assert back == [GOOD | {"Value": 640, "Timestamp": "2021-07-08T09:10:11.123456Z"}]


def test_event_codec(spark):
    e = {"id": ID, "sequence": 3, "nodeId": "Node-1", "jobId": ID, "type": "START", "timestamp": "2023-11-05T04:47:29.398Z", "generatorId": None}
    bad = [e | {"sequence": 0}, {k: v for k, v in e.items() if k != "nodeId"}, e | {"type": "OTHER"}, e | {"type": None}, e | {"id": "x"}]
    rows = codec.decode_events(spark.createDataFrame([(json.dumps(x),) for x in [e, *bad]], "value string")).collect()
    assert [r.problems for r in rows] == [[], ["sequence"], ["nodeId"], ["type"], ["type"], ["id"]]
    good = codec.decode_events(spark.createDataFrame([(json.dumps(e),)], "value string"))
    assert json.loads(codec.encode_events(good).first().value) == e


def test_floors(spark):
    r = spark.sql("select timestamp '2023-11-05 04:47:29' t").select(codec.event_floor(F.col("t"), "HOURS").alias("h"), codec.event_floor(F.col("t"), "MINUTES").alias("m")).first()
    assert r == ("2023-11-05T04:00:00.000Z", "2023-11-05T04:47:00.000Z")
    with pytest.raises(ValueError):
        codec.event_floor(F.col("t"), "DAYS")
    with pytest.raises(ValueError):
        codec.floor_to(F.col("t"), "DAY")


def test_generators(spark):
    assert readers.random_events(spark, 100_000).agg(F.countDistinct("id"), F.max("sequence")).first() == (100_000, 100_000)
    kinds = [r.type for r in readers.cycle_events(spark, 4).orderBy("sequence").collect()]
    assert kinds == ["START", "END", "START", "END"]
    pairs = aggregates.cycles(readers.cycle_events(spark, 10, step_s=5), "job_id", "timestamp", "type", "START", "END", "sequence")
    assert {r.micros for r in pairs.collect()} == {5_000_000} and pairs.count() == 5
    with pytest.raises(ValueError):
        readers.topics_of(" , ")
    assert readers.topics_of("a, b") == ["a", "b"]
    assert readers.passed_through({"kafka.x": "1", "y": "2"}, "kafka.") == {"x": "1"}


def test_statistics_exact(spark):
    r = aggregates.statistics(spark.range(100_000).select(F.col("id").cast("double").alias("v")), "v").first()
    assert (r["count"], r["sum"], r["mean"]) == (100_000, 4999950000.0, 49999.5)
    assert r["variance"] == pytest.approx(833333333.25) and r["stdev"] == pytest.approx(28867.513458037913)


def test_null_values_and_ties(spark):
    rows = spark.createDataFrame([(1, 5.0), (1, None)], "opc_tag_id long, value double").withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    r = aggregates.bucketed(rows, "HOUR").first()
    assert (r["count"], r["sum"]) == (2, 5.0)
    c = spark.createDataFrame([(1, 1, 10, "Hour", "Sum"), (1, 1, 10, "Hour", "Sum"), (1, 1, 9, "Hour", "Sum"), (2, 2, 1, "Hour", "None"), (3, 3, 1, "Hour", None)], "OPCMetricID long, OPCTagID long, t long, AggregationInterval string, AggregationType string").withColumn("Timestamp", F.timestamp_seconds("t")).drop("t")
    assert rollup.latest(c).where("OPCMetricID = 1").count() == 4
    assert rollup.latest_once(c).where("OPCMetricID = 1").count() == 2
    readings = spark.createDataFrame([(k, 1.0) for k in (1, 2, 3)], "OPCTagID long, Value double")
    assert {r.OPCTagID for r in rollup.rollup(readings, c).collect()} == {1}


def test_sum_overflow_is_an_error(spark):
    rows = spark.createDataFrame([(1, (1 << 63) - 1), (1, 1)], "opc_tag_id long, value long").withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    with pytest.raises(Exception, match="OVERFLOW"):
        aggregates.bucketed(rows, "HOUR").collect()
