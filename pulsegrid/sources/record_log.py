"""Records kept by topic, partition and offset in Parquet files, read as a batch or as a stream from any offset.

A log is a folder. `append` writes records below `data`, a folder for each topic, partition, segment of
SEGMENT offsets and append, and then a mark below `marks` that tells where each partition begins and
ends. Only what the newest mark covers is read, so an append that fails leaves nothing to see.

The source is named `record-log`. Options, as a message source words them: `subscribe` (topics, by
commas), `subscribePattern`, or `assign` (JSON of topic -> partitions); `startingOffsets` (`earliest`,
`latest`, or JSON of topic -> partition -> offset, -2 and -1 for the two words), for a batch also
`endingOffsets`. A stream goes on at the offsets in its checkpoint; partitions that appear later are read
from where they begin. Tasks open segments through pyarrow, so the folder must be on a file system that it knows.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from pulsegrid.sources import files
from pulsegrid.sources.schemas import RECORD

#: Offsets that one segment covers: the most that a task reads.
SEGMENT = 100_000
NAME = "record-log"
_TOPIC = re.compile(r"[A-Za-z0-9._-]+")
_ARROW = pa.schema([("value", pa.binary()), ("timestamp", pa.timestamp("us", "UTC")), ("timestampType", pa.int32()), ("partition", pa.int32()), ("key", pa.binary()), ("topic", pa.string()), ("offset", pa.int64())])
_STORED = ["value", "timestamp", "timestampType", "key", "offset"]

#: topic -> partition (as text) -> an offset.
Offsets = dict[str, dict[str, int]]


def append(records: DataFrame, path: str, segment: int = SEGMENT) -> None:
    """Add RECORD rows to a log, made if it isn't there. Offsets of a partition must go on where the log ends;
    gaps are allowed. One append at a time: of two that run at once one fails, and can be repeated."""
    spark, path = records.sparkSession, path.rstrip("/")
    ranges = records.groupBy("topic", "partition").agg(F.min("offset").alias("first"), (F.max("offset") + 1).alias("until")).collect()  # a row for each partition
    done = files.names(spark, f"{path}/marks")
    number = int(done[-1].partition(".")[0]) + 1 if done else 0
    mark = json.loads(files.read_text(spark, f"{path}/marks/{done[-1]}")) if done else {"segment": segment, "ranges": {}}
    for r in ranges:
        if not _TOPIC.fullmatch(r.topic or "") or r.partition is None or r["first"] is None or r["first"] < 0:
            raise ValueError(f"records need a topic of letters, digits, '.', '_' and '-', a partition and an offset: {r}")
        own = mark["ranges"].setdefault(r.topic, {}).setdefault(str(r.partition), [r["first"], r["first"]])
        if r["first"] < own[1]:
            raise ValueError(f"{r.topic} {r.partition} goes on at {own[1]}, not at {r['first']}")
        own[1] = r.until
    token = f"{number:012d}-{uuid.uuid4().hex[:12]}"
    rows = records.select(*RECORD.fieldNames(), F.expr(f"offset div {mark['segment']}").alias("segment"), F.lit(token).alias("append"))
    parts = ["topic", "partition", "segment", "append"]
    rows.hint("rebalance", *parts[:3]).sortWithinPartitions(*parts, "offset").write.partitionBy(*parts).mode("append").parquet(f"{path}/data")
    if not files.write_new(spark, f"{path}/marks/{number:012d}.json", json.dumps(mark | {"append": token})):
        raise RuntimeError(f"another append to {path} came first")


def ends(spark: SparkSession, path: str) -> DataFrame:
    """(topic, partition, first, until): where each partition of a log begins and ends; empty if there is no log."""
    done = files.names(spark, f"{path.rstrip('/')}/marks")
    held = json.loads(files.read_text(spark, f"{path.rstrip('/')}/marks/{done[-1]}"))["ranges"] if done else {}
    rows = [(t, int(p), *both) for t, ps in held.items() for p, both in ps.items()]
    return spark.createDataFrame(rows, "topic string, partition int, first long, until long")


class _Log:
    """What a reader needs to know of a log, without Spark."""

    def __init__(self, options: dict[str, str]):
        from pyarrow import fs

        self.options = options
        self.fs, self.root = fs.FileSystem.from_uri(options["path"]) if "://" in options["path"] or options["path"].startswith("file:") else (fs.LocalFileSystem(), options["path"])
        chosen = [k for k in ("subscribe", "subscribepattern", "assign") if options.get(k)]
        if len(chosen) != 1:
            raise ValueError("exactly one of subscribe, subscribePattern and assign must be set")

    def _list(self, path: str) -> list[str]:
        from pyarrow import fs

        return sorted(x.base_name for x in self.fs.get_file_info(fs.FileSelector(f"{self.root}/{path}", allow_not_found=True)) if not x.base_name.startswith((".", "_")))

    def _mark(self, name: str) -> dict:
        with self.fs.open_input_stream(f"{self.root}/marks/{name}") as f:
            return json.loads(f.read())

    def state(self) -> dict:
        """The newest mark."""
        done = self._list("marks")
        return self._mark(done[-1]) if done else {"segment": SEGMENT, "ranges": {}}

    def ranges(self, mark: dict) -> dict[str, dict[str, list[int]]]:
        """Of what a mark covers, the partitions asked for."""
        held = mark["ranges"]
        if assign := self.options.get("assign"):
            return {t: {str(p): held[t][str(p)] for p in ps if str(p) in held[t]} for t, ps in json.loads(assign).items() if t in held}
        if pattern := self.options.get("subscribepattern"):
            return {t: ps for t, ps in held.items() if re.fullmatch(pattern, t)}
        topics = {x.strip() for x in self.options["subscribe"].split(",") if x.strip()}
        return {t: ps for t, ps in held.items() if t in topics}

    def resolve(self, said: str, mark: dict) -> Offsets:
        """`earliest`, `latest` or offsets as JSON, for each partition; those that JSON leaves out begin at the beginning."""
        side = {"earliest": 0, "latest": 1}
        given = {} if said in side else {t: {str(p): o for p, o in ps.items()} for t, ps in json.loads(said).items()}
        out: Offsets = {}
        for t, ps in self.ranges(mark).items():
            for p, ends in ps.items():
                o = ends[side[said]] if said in side else given.get(t, {}).get(p, -2)
                out.setdefault(t, {})[p] = ends[o + 2] if o in (-2, -1) else o
        return out

    def pieces(self, start: Offsets, end: Offsets) -> list[_Piece]:
        """What lies between two offsets, a piece for each segment that it touches."""
        mark = self.state()
        size, marks, out = mark["segment"], set(self._list("marks")), []
        known: dict[str, bool] = {}  # whether an append was finished

        def finished(token: str) -> bool:
            if token not in known:
                name = f"{token.partition('-')[0]}.json"
                known[token] = name in marks and self._mark(name)["append"] == token
            return known[token]

        for t, ps in end.items():
            for p, until in ps.items():
                first = start.get(t, {}).get(p, mark["ranges"][t][p][0])
                if first >= until:
                    continue
                for s in (int(x.removeprefix("segment=")) for x in self._list(f"data/topic={t}/partition={p}")):
                    if first < (s + 1) * size and s * size < until:
                        at = f"data/topic={t}/partition={p}/segment={s}"
                        folders = [f"{at}/{x}" for x in self._list(at) if finished(x.removeprefix("append="))]
                        if folders:
                            out.append(_Piece(t, int(p), first, until, folders))
        return out

    def read(self, piece: _Piece) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        offset = ds.field("offset")
        for folder in piece.folders:
            held = ds.dataset(f"{self.root}/{folder}", filesystem=self.fs, format="parquet")
            for b in held.to_batches(columns=_STORED, filter=(offset >= piece.first) & (offset < piece.until)):
                if b.num_rows:
                    whole = {k: b.column(k) for k in _STORED} | {"topic": pa.array([piece.topic] * b.num_rows), "partition": pa.array([piece.partition] * b.num_rows, pa.int32())}
                    stamp = whole["timestamp"].cast(pa.timestamp("us"), safe=False) if whole["timestamp"].type.tz is None else whole["timestamp"]
                    yield pa.RecordBatch.from_arrays([(stamp if f.name == "timestamp" else whole[f.name]).cast(f.type) for f in _ARROW], schema=_ARROW)


class _Piece(InputPartition):
    def __init__(self, topic: str, partition: int, first: int, until: int, folders: list[str]):
        self.topic, self.partition, self.first, self.until, self.folders = topic, partition, first, until, folders


class _Stream(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.log = _Log(options)

    def initialOffset(self) -> dict:
        return self.log.resolve(self.log.options.get("startingoffsets", "latest"), self.log.state())

    def latestOffset(self) -> dict:
        return self.log.resolve("latest", self.log.state())

    def partitions(self, start: dict, end: dict) -> list[_Piece]:
        return self.log.pieces(start, end)

    def read(self, partition: _Piece) -> Iterator[pa.RecordBatch]:
        return self.log.read(partition)


class _Batch(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.log = _Log(options)

    def partitions(self) -> list[_Piece]:
        mark = self.log.state()
        ends = (self.log.resolve(self.log.options.get(k, word), mark) for k, word in (("startingoffsets", "earliest"), ("endingoffsets", "latest")))
        return self.log.pieces(*ends) or [_Piece("", 0, 0, 0, [])]

    def read(self, partition: _Piece) -> Iterator[pa.RecordBatch]:
        return self.log.read(partition)


class RecordLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        return RECORD

    def _plain(self) -> dict[str, str]:
        return {k.lower(): v for k, v in self.options.items()}

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Stream(self._plain())

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Batch(self._plain())


def _source(spark: SparkSession, path: str, chosen: dict[str, str], options: dict[str, str]) -> dict[str, str]:
    spark.dataSource.register(RecordLog)
    return {"path": path.rstrip("/"), **{k: v for k, v in chosen.items() if v}, **options}


def stream(spark: SparkSession, path: str, topics: str = "", assign: str | None = None, starting: str = "earliest", **options: str) -> DataFrame:
    """A log's records as a stream, from `starting` on or, after a restart, from where the checkpoint stands."""
    return spark.readStream.format(NAME).options(**_source(spark, path, {"subscribe": topics, "assign": assign, "startingOffsets": starting}, options)).load()


def records(spark: SparkSession, path: str, topics: str = "", assign: str | None = None, starting: str = "earliest", ending: str = "latest", **options: str) -> DataFrame:
    """A log's records between two offsets as a table."""
    return spark.read.format(NAME).options(**_source(spark, path, {"subscribe": topics, "assign": assign, "startingOffsets": starting, "endingOffsets": ending}, options)).load()
