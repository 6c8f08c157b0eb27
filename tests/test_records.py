"""Record logs, state, observed counts, row-wise sinks, mergeable moments, sequences and bucketed tables."""

import ast
import json
import random
from datetime import datetime, timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import codec
from pulsegrid.operators import aggregates, rollup
from pulsegrid.operators.sequence import dense_sequence
from pulsegrid.plans import pipelines
from pulsegrid.sources import bucketed, record_log
from pulsegrid.sources.schemas import RECORD, TABLES
from pulsegrid.streaming import runner, state
from pulsegrid.streaming.keyed import KeyedTable
from pulsegrid.streaming.rowwise import RowFiles

T0 = datetime(2024, 1, 1)


def records(spark, *rows):
    return spark.createDataFrame([(None if v is None else v.encode(), T0, 0, p, None, t, o) for t, p, o, v in rows], RECORD)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# rollups


def test_no_reading_is_joined(spark, sf_dir):
    """Below the join the readings are a row a tag, and their scan is under an aggregation."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("OPCTagID"), F.col("value").alias("Value"), F.col("ts").alias("timestamp"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    configs = orders.select(F.col("o_custkey").alias("OPCMetricID"), F.col("o_custkey").alias("OPCTagID"), F.col("o_orderdate").alias("Timestamp"), F.col("o_orderpriority").alias("AggregationInterval"), F.lit("Sum").alias("AggregationType"))
    for minutes in (None, 60):
        tree = rollup.rollup(events, rollup.latest_weighted(configs), bucket_minutes=minutes)._jdf.queryExecution().optimizedPlan().toString().splitlines()
        joins = [k for k, line in enumerate(tree) if "Join" in line]
        assert len(joins) == 1
        side = tree[joins[0] + 1 :]
        assert "Aggregate" in side[0] and any("value" in line and "Relation" in line for line in side)


def test_rollup_weights_ties_and_nulls(spark):
    configs = spark.createDataFrame([(1, 7, 2, "Hour", "Sum"), (1, 7, 2, "Day", "Sum"), (1, 7, 1, "Hour", "Sum"), (2, 7, 1, "Hour", "None"), (3, 7, 1, "Hour", None), (4, 8, 1, "Hour", "Sum")], "OPCMetricID long, OPCTagID long, Timestamp long, AggregationInterval string, AggregationType string")
    readings = spark.createDataFrame([(7, 1.0), (7, None), (7, 4.0), (8, None), (9, 1.0), (None, 1.0)], "OPCTagID long, Value double")
    for newest in (rollup.latest, rollup.latest_weighted):
        got = {tuple(r) for r in rollup.rollup(readings, newest(configs)).collect()}
        assert got == {("Hour", 7, 1, 10.0, 4, 2.5, 1.0, 4.0), ("Day", 7, 1, 10.0, 4, 2.5, 1.0, 4.0), ("Hour", 8, 4, None, 0, None, None, None)}


# record logs


def test_log_refuses_what_does_not_go_on(spark, tmp_path):
    at = f"file://{tmp_path}/log"
    record_log.append(records(spark, ("a", 0, 0, "x"), ("a", 0, 5, "y"), ("b", 1, 7, "z")), at, segment=4)
    with pytest.raises(ValueError, match="goes on at 6"):
        record_log.append(records(spark, ("a", 0, 5, "again")), at)
    with pytest.raises(ValueError, match="need a topic"):
        record_log.append(records(spark, ("a/b", 0, 9, "x")), at)
    with pytest.raises(Exception, match="exactly one of"):
        record_log.records(spark, at).count()
    record_log.append(records(spark), at)
    got = record_log.records(spark, at, subscribePattern=".*")
    assert sorted((r.topic, r.offset) for r in got.collect()) == [("a", 0), ("a", 5), ("b", 7)]
    assert record_log.records(spark, at, topics="a", starting=json.dumps({"a": {"0": 1}}), ending=json.dumps({"a": {"0": 5}})).count() == 0
    assert record_log.records(spark, f"{at}-none", topics="a").count() == 0


def test_an_append_that_fails_leaves_nothing_to_see(spark, tmp_path, monkeypatch):
    at = f"file://{tmp_path}/log"
    record_log.append(records(spark, ("a", 0, 0, "x")), at)
    with monkeypatch.context() as m:
        m.setattr(record_log.files, "write_new", lambda *_: False)  # as when another came first
        with pytest.raises(RuntimeError, match="another append"):
            record_log.append(records(spark, ("a", 0, 1, "lost"), ("a", 1, 0, "lost")), at)
    record_log.append(records(spark, ("a", 0, 1, "kept")), at)
    assert sorted(bytes(r.value).decode() for r in record_log.records(spark, at, topics="a").collect()) == ["kept", "x"]


def test_log_stream_goes_on_where_it_stopped(spark, tmp_path):
    at = f"file://{tmp_path}"
    for k in range(3):
        record_log.append(records(spark, *[("a", p, 10 * k + o, f"{k}") for p in (0, 1) for o in range(4)]), f"{at}/log", segment=3)
        taken = record_log.stream(spark, f"{at}/log", topics="a", starting=json.dumps({"a": {"0": 2}}))
        query = runner.start(taken, runner.StreamConfig("log", f"{at}/checkpoint"), path=f"{at}/out")
        query.awaitTermination()
        assert ast.literal_eval(query.lastProgress["sources"][0]["endOffset"]) == {"a": {"0": 10 * k + 4, "1": 10 * k + 4}}
    rows = spark.read.schema(RECORD).parquet(f"{at}/out").collect()
    assert sorted((r.partition, r.offset) for r in rows) == [(p, 10 * k + o) for p in (0, 1) for k in range(3) for o in range(4) if p or k or o >= 2]


# state


def sessions(rows, gap):
    """(tag, started, ended, readings) of each session, and whether a later one follows."""
    out = []
    for tag in {t for t, _ in rows}:
        times = sorted(x for t, x in rows if t == tag)
        parts = [[times[0]]]
        for x in times[1:]:
            parts.append([x]) if x - parts[-1][-1] > gap else parts[-1].append(x)
        out += [((tag, p[0], p[-1], len(p)), k < len(parts) - 1) for k, p in enumerate(parts)]
    return out


def test_idle_sessions_end_by_readings_and_by_timers(spark, tmp_path):
    r = random.Random(3)
    batches, now, seen = [], T0, []
    for _ in range(4):
        rows = []
        for _ in range(25):
            now += timedelta(seconds=r.choice([1, 5, 20, 59, 60, 61, 90]))
            rows.append((r.choice([1, 2, None]), now, r.choice([None, 1.0, 2.5])))
        batches.append(rows)
        seen += [(t, x) for t, x, _ in rows]
    batches.append([(9, now + timedelta(hours=1), 1.0)])  # moves the watermark beyond all others
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "opc_tag_id long, timestamp timestamp, value double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("opc_tag_id long, timestamp timestamp, value double").parquet(f"{tmp_path}/in")
        config = runner.StreamConfig("sessions", f"{tmp_path}/checkpoint", state="rocksdb")
        runner.start(state.idle_sessions(stream), config, path=f"{tmp_path}/out").awaitTermination()
    found = spark.read.parquet(f"{tmp_path}/out").collect()
    want = sessions(seen, timedelta(seconds=60))
    assert sorted(((f.opc_tag_id or 0, f.started, f.ended, f.readings) for f in found)) == sorted((t or 0, *rest) for (t, *rest), _ in want)
    assert {f.closed_by for f in found} == {"reading", "timer"}
    values = [v for rows in batches[:4] for _, _, v in rows if v is not None]
    assert sum(f["count"] for f in found) == len(values) and sum(f["sum"] or 0 for f in found) == sum(values)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")  # the session's own is back


def test_idle_sessions_keep_many_tags_in_few_states(spark, tmp_path):
    """A call and a state entry serve many tags, large and null ones among them, over batches and a restart."""
    r = random.Random(4)
    tags = [None, *(2**60 + k for k in range(1500))]
    schema = "opc_tag_id long, timestamp timestamp, value double"
    batches = [[(t, T0 + timedelta(seconds=200 * k + r.randrange(200), microseconds=r.randrange(10**6)), r.choice([None, 1.0, float("nan"), 2.5])) for t in tags for _ in range(3)] for k in range(2)]
    batches.append([(1, T0 + timedelta(hours=1), 1.0)])
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        query = runner.start(state.idle_sessions(stream), runner.StreamConfig("many", f"{tmp_path}/checkpoint", state="rocksdb"), path=f"{tmp_path}/out")
        query.awaitTermination()
        assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) < len(tags)
    seen = [row for rows in batches[:2] for row in rows]
    want = [s for s, _ in sessions([(t or 0, x) for t, x, _ in seen], timedelta(seconds=60))]
    found = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted((f.opc_tag_id or 0, f.started, f.ended, f.readings) for f in found) == sorted(want)
    values = [v for _, _, v in seen if v is not None and v == v]
    assert sum(f["count"] for f in found) == len(values) and sum(f["sum"] or 0 for f in found) == sum(values)
    assert all((f["sum"] is None) == (f["min"] is None) == (f["max"] is None) == (not f["count"]) for f in found)


def test_sessions_are_folded_as_one_by_one():
    """Against reading by reading: earlier readings than the open session's, ties, nulls, infinite values."""
    r, order = random.Random(5), lambda row: (row[0] is None, row[0] or 0, row[1])
    for _ in range(60):
        held = {}
        for _ in range(4):
            new = sorted(((r.choice([None, 0, 1, 2]), r.randrange(120), r.choice([None, 1.0, -2.0, float("inf")])) for _ in range(r.randrange(1, 12))), key=lambda x: x[1])
            before = state.pd.DataFrame([(t, *h) for t, h in held.items()], columns=["opc_tag_id", *state._FIGURES]).astype({"opc_tag_id": "Int64"} | {c: "float64" for c in ("sum", "min", "max")})
            given = state.pd.DataFrame([(t or 0, t is None, x, v) for t, x, v in new], columns=["opc_tag_id", "untagged", "at", "value"])
            found, last = state._folded(before, given, 10)
            over = []
            for t, x, v in new:
                h = held.get(t)
                if h and x - h[1] > 10:
                    over.append((t, *h))
                    h = None
                a, b, n, k, total, low, high = h or (x, x, 0, 0, None, None, None)
                if v is not None:
                    total, low, high = (total + v, min(low, v), max(high, v)) if k else (v, v, v)
                    k += 1
                held[t] = (min(a, x), max(b, x), n + 1, k, total, low, high)
            for got, exact in ((found[~last], over), (found[last], [(t, *h) for t, h in held.items()])):
                rows = [tuple(None if state.pd.isna(v) else v for v in row) for row in got.itertuples(index=False)]
                assert sorted(rows, key=order) == sorted(exact, key=order)


def test_update_mode_needs_keys(spark, tmp_path):
    for k in (1, 2):
        spark.createDataFrame([(k, 1), (3, k)], "k long, v long").coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema("k long, v long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*").groupBy("k").agg(F.sum("v").alias("s"))
    with pytest.raises(ValueError, match="keys must be named"):
        runner.drain(stream, "update", "no-keys")
    assert sorted(map(tuple, runner.drain(stream, "update", "keys", ("k",)).collect())) == [(1, 1), (2, 1), (3, 3)]


# keyed tables and quarantine


def test_a_batch_outside_a_stream_needs_a_writer(spark, tmp_path):
    rows = spark.createDataFrame([(1, T0, 1, 5, 5, 5)], TABLES["signal_aggregate"].schema)
    with pytest.raises(ValueError, match="writer's name"):
        KeyedTable(spark, f"file://{tmp_path}/t", "signal_aggregate").apply(rows, 0)


def test_what_is_opened_does_not_grow_with_history(spark, tmp_path, monkeypatch):
    opened = []
    plain = KeyedTable._open
    monkeypatch.setattr(KeyedTable, "_open", lambda self, name: opened.append(name) or plain(self, name))
    monkeypatch.setattr(KeyedTable, "_write", lambda self, rows, version: {"p": [f"{version}/p"]})
    path, rows = f"file://{tmp_path}/t", spark.createDataFrame([], TABLES["signal_aggregate"].schema)
    table = KeyedTable(spark, path, "signal_aggregate")
    for n in range(200):
        table.apply(rows, n, f"w{n % 3}")
    assert len(opened) < 2.5 * 200  # each entry once, and the summaries
    opened.clear()
    fresh = KeyedTable(spark, path, "signal_aggregate")
    assert fresh.last_batch("w1") == 199 and len(opened) <= 21
    assert len(fresh._folders()["p"]) == 200 and len(fresh._names("ledger")) <= 50
    assert all(len(e["covers"]) <= 50 for e in fresh._entries().values())
    fresh.apply(rows, 196, "w1")  # repeated, behind many summaries
    assert len(fresh._folders()["p"]) == 200


def test_compaction_by_setting(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", "signal_aggregate", pipelines.FIGURES, compact_every=3)
    for n in range(6):
        table.apply(spark.createDataFrame([(1, T0, 1, n, n, n)], TABLES["signal_aggregate"].schema), n, "a")
        assert max(len(x) for x in table._folders().values()) <= 3
    assert [tuple(r) for r in table.read().collect()] == [(1, T0, 6, 15, 0, 5)]


@pytest.mark.parametrize("kind", ["persist", "ingest"])
def test_quarantine_keeps_what_other_streams_and_new_checkpoints_write(spark, tmp_path, kind):
    q = f"{tmp_path}/q"
    for k, (checkpoint, text) in enumerate([("c1", "{"), ("c2", "[["), ("c3", '{"ID":"x","Timestamp":"2024-01-01T00:00:00Z"}')]):
        records(spark, ("t", 0, k, text), ("t", 0, k + 10, '{"ID":1,"OPCTagID":1,"Timestamp":"2024-01-01T00:00:00Z"}')).write.parquet(f"{tmp_path}/{checkpoint}-in")
        settings = {"app": "q", "checkpoint": f"file://{tmp_path}/{checkpoint}", "files": f"{tmp_path}/{checkpoint}-in", "out": f"file://{tmp_path}/t", "quarantine": f"file://{q}"}
        (pipelines.PersistSignals if kind == "persist" else pipelines.Ingest)(**settings).run(spark)
    assert sorted(r.raw for r in spark.read.json(f"{q}/*/*/").collect()) == ["[[", "{", '{"ID":"x","Timestamp":"2024-01-01T00:00:00Z"}']
    if kind == "ingest":
        counted = KeyedTable(spark, f"file://{tmp_path}/t/counters", "signal_validation", pipelines.COUNTERS).read().first()
        assert tuple(counted)[1:] == (6, 3, 3)
        assert not any(p.is_dir() for p in tmp_path.glob("c*-decoded/batch=*"))


# row-wise sink


def test_rows_are_written_once(tmp_path):
    row = lambda offset, value: {"topic": "a", "partition": 0, "offset": offset, "value": value}
    sink = RowFiles(f"file://{tmp_path}/out")
    for error in (RuntimeError("lost"), None, None):
        opened = sink.open(0, 7)
        if opened:
            for x in (row(1, b"x"), row(2, b""), row(3, None), row(4, b"y")):
                sink.process(x)
        sink.close(error)
    assert not opened
    read = lambda kind: [json.loads(x)["offset"] for p in (tmp_path / "out" / kind).rglob("*") if p.is_file() for x in p.read_text().splitlines()]
    assert read("rows") == [1, 4] and read("empty") == [2, 3]


def test_a_repeated_epoch_and_a_new_checkpoint(spark, tmp_path):
    at = f"file://{tmp_path}"
    record_log.append(records(spark, ("a", 0, 0, "x"), ("a", 1, 0, ""), ("a", 1, 1, "é")), f"{at}/log")
    run = lambda checkpoint: pipelines.PersistRows(app="rows", checkpoint=f"{at}/{checkpoint}", log=f"{at}/log", topics="a", out=f"{at}/out").run(spark)
    run("c1")
    (tmp_path / "c1" / "commits" / "0").unlink()  # as if the epoch's end had been lost
    for crc in (tmp_path / "c1" / "commits").glob(".0.crc"):
        crc.unlink()
    run("c1")
    values = lambda: sorted(r.value for r in spark.read.schema("value string").json(f"{at}/out/rows/*/*/").collect())
    assert values() == ["x", "é"]
    run("c2")
    assert values() == ["x", "x", "é", "é"]


# moments


def test_moments_keep_their_digits(spark):
    r = random.Random(5)
    values = [1e9 + r.random() for _ in range(4000)]
    rows = spark.createDataFrame([(k % 7 % 2, k % 97, v) for k, v in enumerate(values)] + [(5, 1, None), (6, 1, 1e9)], "g long, w long, value double").repartition(5)
    partials = aggregates.moments(rows, "value", "g", "w", near=1e9)
    merged = aggregates.merge_moments(partials, "g")
    thirds = aggregates.merge_moments(partials, "g", (F.col("n") % 3).alias("third")).drop("third")
    other = aggregates.moments(rows, "value", "g", "w", near=1e9 + 0.5)
    twice = aggregates.merge_moments(thirds.where("g = 0").unionByName(other.where("g <> 0").drop("w")), "g")
    for found in (merged, twice):
        got = {x.g: x for x in aggregates.described(found).collect()}
        assert set(got) == {0, 1, 6} and got[6].variance == 0 and got[6]["count"] == 1
        for g in (0, 1):
            own = [Fraction(v) for k, v in enumerate(values) if k % 7 % 2 == g]
            mean = sum(own) / len(own)
            variance = float(sum((x - mean) ** 2 for x in own) / len(own))
            assert got[g]["count"] == len(own) and abs(got[g].variance - variance) < 1e-9 and abs(got[g]["mean"] - float(mean)) < 1e-6


# sequences, buckets, drift


def test_dense_sequence(spark, tmp_path):
    rows = spark.range(5000).selectExpr("id", "id % 7 as hot", "if(id < 3000, null, id) as t").repartition(9)
    got = dense_sequence(rows, ["t", "id"], f"file://{tmp_path}/a").collect()
    want = sorted(((r.t is not None, r.t or 0, r.id) for r in got))
    assert [r.sequence for r in sorted(got, key=lambda r: (r.t is not None, r.t or 0, r.id))] == list(range(1, 5001)) and len(want) == 5000
    tied = dense_sequence(rows, ["hot"], f"file://{tmp_path}/b").collect()
    assert sorted(r.sequence for r in tied) == list(range(1, 5001)) and [r.hot for r in sorted(tied, key=lambda r: r.sequence)] == sorted(r.hot for r in tied)
    assert dense_sequence(rows.where("false"), ["t"], f"file://{tmp_path}/c").count() == 0


def test_bucketed_tables_need_no_shuffle(spark, tmp_path):
    readings = spark.range(4000).selectExpr("id % 50 as OPCTagID", "cast(id as double) as Value", "timestamp_seconds(id) as timestamp")
    held = spark.range(50).selectExpr("'Hour' as AggregationInterval", "id as OPCTagID", "id as OPCMetricID", "1L as weight")
    a = bucketed.ensure(spark, "bucketed_readings", readings, "OPCTagID", 4, ("timestamp",), f"file://{tmp_path}/r")
    b = bucketed.ensure(spark, "bucketed_configs", held, "OPCTagID", 4)
    again = bucketed.ensure(spark, "bucketed_readings", readings.where("false"), "OPCTagID", 4)
    assert again.count() == 4000
    with pytest.raises(ValueError, match="not in 8 buckets"):
        bucketed.ensure(spark, "bucketed_readings", readings, "OPCTagID", 8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = rollup.weighted(rollup.figures_by_tag(a), b, ["OPCTagID"])
        assert found.count() == 50 and "Exchange" not in plan_of(found)
        # upserts by tag: the newest of what is there and what comes, both in buckets
        last = a.groupBy("OPCTagID").agg(F.max_by("Value", "timestamp").alias("Value"))
        assert "Exchange" not in plan_of(last) and "Exchange" not in plan_of(last.join(b, "OPCTagID", "full"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_drifted_fields_are_kept(spark):
    texts = ['{"ID":"5","Value":12.7,"New":[1,{"a":null}]}', '{"ID":{"x":1},"Quality":null}', "[]", "[1]", "null", "", None, '"text"', '{"a":1,"a":2}', "{" * 10_000, '[{"ID":7},{"ID":8}]', '{"":1}']
    got = [(r.id, r.value, r.extra, r.lost) for r in codec.decode_drifted(spark.createDataFrame([(t,) for t in texts], "value string")).collect()]
    assert got[0] == (5, 12, {"New": '[1,{"a":null}]'}, [])
    assert got[1] == (None, None, {"ID": '{"x":1}'}, ["ID"])
    assert [g[3] for g in got[2:6]] == [["payload"]] * 4  # [], [1], null and a text; what is empty is left out
    assert got[-2] == (7, None, {}, []) and got[-1] == (None, None, {"": "1"}, []) and len(got) == len(texts) - 2


# producing and sending


def test_produced_messages_keep_a_tags_order(spark, tmp_path):
    """Two rounds into three partitions: no gaps, nothing lost, a tag in one partition and in the order of time."""
    at = f"file://{tmp_path}"
    plain = spark.range(600).selectExpr(
        "cast(null as string) unique_id", "id", "id as value", "cast(null as string) day", "timestamp_seconds(1700000000 + id * 7919 % 400000) as timestamp", "1L as quality",
        "id as opc_tag_reading_id", "if(id < 300, 7, id % 11) as opc_tag_id", "'t' as proxied_type_name", "array(cast(null as string)) extended_properties", "if(id % 2 = 0, 'a', 'b') as topic",
    )
    for k in (0, 1):
        plain.where(f"id % 3 {'=' if k else '<>'} 0").repartition(5).write.parquet(f"{at}/{k}")
        pipelines.Produce(readings=f"{at}/{k}", log=f"{at}/log").run(spark)
    sent = record_log.records(spark, f"{at}/log", subscribePattern=".*").collect()
    ends = {(r.topic, r.partition): r.until for r in record_log.ends(spark, f"{at}/log").collect()}
    place, ids = {}, []
    for r in sorted(sent, key=lambda r: (r.topic, r.partition, r.offset)):
        own = place.setdefault((r.topic, r.partition), [])
        assert r.offset == len(own)
        (reading,) = json.loads(bytes(r.value))
        ids.append(reading["ID"])
        own.append((reading["ID"] % 3 == 0, reading["Timestamp"]))
        assert bytes(r.key).decode() == str(reading["OPCTagID"])
    assert sorted(ids) == list(range(600)) and {k: len(v) for k, v in place.items()} == ends
    assert all(v == sorted(v) for v in place.values())


def test_registry_tables_are_made_once(spark, tmp_path):
    from pulsegrid.sources.schemas import ddl

    for k, name in enumerate(TABLES):
        for _ in range(2):
            spark.sql(ddl(name, f"registry_{k}", f"file://{tmp_path}/{name}", 4))
        made = {r.col_name: r.data_type for r in spark.sql(f"describe extended registry_{k}").collect()}
        assert spark.table(f"registry_{k}").schema == TABLES[name].schema and made["Num Buckets"] == "4" and TABLES[name].key[0] in made["Sort Columns"]


def test_console_and_unknown_options(spark, tmp_path, capfd):
    records(spark, ("a", 0, 0, "seen on the console")).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(RECORD).parquet(f"{tmp_path}/in").selectExpr("cast(value as string) v")
    runner.start(stream, runner.StreamConfig("console", f"file://{tmp_path}/c"), fmt="console", truncate="false").awaitTermination()
    with pytest.raises(ValueError, match="must begin with source"):
        pipelines.TopicCounts(app="a", checkpoint="c", out="o", log="l", options={"kafka.group.id": "g"}).run(spark)


@pytest.mark.parametrize("kind", ["cumulative", "windows"])
def test_figures_and_quarantine_come_from_one_decoding(spark, tmp_path, monkeypatch, kind):
    """Over a restart; what stood between is cleared, and the source is read once."""
    made = []
    plain = codec.decode_signals
    monkeypatch.setattr(pipelines.codec, "decode_signals", lambda *a, **b: made.append(1) or plain(*a, **b))
    settings = {"app": "figures", "checkpoint": f"file://{tmp_path}/c", "files": f"{tmp_path}/in", "out": f"file://{tmp_path}/t", "quarantine": f"file://{tmp_path}/q", "rocksdb": True}
    for k in range(2):
        good = '{"ID":%d,"OPCTagID":1,"Value":%d,"Timestamp":"2024-01-01T00:0%d:00Z"}'
        records(spark, ("t", 0, 3 * k, good % (k, 10 + k, k)), ("t", 0, 3 * k + 1, f"[bad {k}"), ("t", 0, 3 * k + 2, "")).write.mode("append").parquet(f"{tmp_path}/in")
        run = pipelines.Cumulative(**settings) if kind == "cumulative" else pipelines.WindowAggregates(**settings, delay="1 hour", mode="update")
        run.run(spark)
    assert len(made) == 2
    table = KeyedTable(spark, f"file://{tmp_path}/t", "signal_aggregate" if kind == "cumulative" else "ss_signal_aggregation")
    assert [(r["count"], r["sum"], r["min"], r["max"]) for r in table.read().collect()] == [(2, 21, 10, 11)]
    assert sorted(r.raw for r in spark.read.json(f"{tmp_path}/q/*/*/").collect()) == ["[bad 0", "[bad 1"]


def test_counting_alone_fails_fast(spark, tmp_path):
    records(spark, ("t", 0, 0, "{"), ("t", 0, 1, '{"ID":1,"Timestamp":"2024-01-01T00:00:00Z"}')).write.parquet(f"{tmp_path}/in")
    settings = {"app": "q", "checkpoint": f"file://{tmp_path}/c", "files": f"{tmp_path}/in", "out": f"file://{tmp_path}/t", "raw": False, "figures": False}
    with pytest.raises(Exception, match="cannot decode"):
        pipelines.Ingest(**settings, fail_fast=True).run(spark)


def test_one_file_for_each_interval(spark, tmp_path):
    configs = [json.dumps({"OPCMetricID": k, "OPCTagID": k % 7, "Timestamp": "2024-01-01T00:00:00Z", "AggregationInterval": i, "AggregationType": "Sum"}) for k, i in enumerate(["Hour", "Day", "FiveMinutes"] * 20)]
    (tmp_path / "configs.json").write_text("\n".join(configs))
    (tmp_path / "readings.json").write_text("\n".join(json.dumps({"OPCTagID": k % 7, "Value": str(k)}) for k in range(500)))
    run = {"configs": f"{tmp_path}/configs.json", "readings": f"{tmp_path}/readings.json", "out": f"{tmp_path}/out", "generation": "g1"}
    pipelines.Rollup(**run, single_files=True).run(spark)
    parts = [p.parent.name for p in tmp_path.glob("out/g1/*/part-*")]
    assert sorted(parts) == ["AggregationInterval=Day", "AggregationInterval=FiveMinutes", "AggregationInterval=Hour"]
