"""A table with a key over Parquet files, for batches of streams: deltas, merged when read."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.sources import files
from pulsegrid.sources.schemas import TABLES

#: Entries after which a batch enters a summary of all.
SNAPSHOT = 20
_SUMMARY = "-sum-"
#: Where Spark keeps the id of the stream whose batch is being handled; the id outlives restarts.
_QUERY_ID = "sql.streaming.queryId"


def stream_id(spark: SparkSession) -> str:
    """The id of the stream whose batch is being handled; empty outside one."""
    return spark.sparkContext.getLocalProperty(_QUERY_ID) or ""


class KeyedTable:
    """Rows by key: of rows with one key the last written one counts, or `merge` tells, column by
    column, what becomes of them (`sum`, `min`, `max`).

    A batch is written as a delta, by parts (days, say), and then a ledger entry that names its folders
    is renamed into place. Nothing that no entry names is read, and an entry is known by its writer
    (the stream's id, which a checkpoint keeps) and batch number, so a batch that fails midway changes
    nothing, a repeated one changes nothing, and other writers lose nothing. Reading merges; `compact`
    merges for good, only the parts that have deltas. Entries are ordered by the writers' clocks; within
    a batch the last row of a key is the one of the largest `TABLES` order column, then of the largest
    other columns. The ledger needs a file system whose rename is atomic.

    After SNAPSHOT entries a batch also enters a summary of them all, so what is opened doesn't grow with
    the table's history; the entries of the summary before the last are deleted. With `compact_every` a
    batch that finds so many deltas compacts.
    """

    def __init__(self, spark: SparkSession, path: str, name: str, merge: dict[str, str] | None = None, compact_every: int = 0):
        self.spark, self.path, self.spec, self.merge = spark, path.rstrip("/"), TABLES[name], merge or {}
        self.compact_every = compact_every
        self._part = F.coalesce(F.expr(self.spec.part).cast("string"), F.lit("none"))
        self._stored = T.StructType([*self.spec.schema.fields, T.StructField("_order", T.StringType())])
        self._opened: dict[str, dict] = {}  # entries never change

    def _names(self, *names: str) -> list[str]:
        return files.names(self.spark, "/".join([self.path, *names]))

    def _open(self, name: str) -> dict | None:
        text = files.read_text(self.spark, f"{self.path}/ledger/{name}")
        return None if text is None else json.loads(text)

    def _entries(self) -> dict[str, dict]:
        """The ledger's entries that count, in order: the last summary and what it doesn't cover. Only those
        are opened, each once."""
        while True:
            names = [x for x in self._names("ledger") if not x.startswith(".")]
            base = max((x for x in names if _SUMMARY in x), default="")
            opened = {x: self._opened.get(x) or self._open(x) for x in names if x == base}
            if base and opened[base] is None:
                continue  # a newer one has replaced it meanwhile
            covered = set(opened[base]["covers"]) if base else set()
            opened |= {x: self._opened.get(x) or self._open(x) for x in names if x != base and x not in covered and _SUMMARY not in x}
            if None not in opened.values():
                break
        self._opened = opened
        done = opened[base]["applied"] if base else {}
        out, seen = {}, set()
        for name in sorted(opened):
            if name != base:  # a batch that two drivers applied at once counts once
                (one,) = opened[name]["applied"].items()
                if one in seen or name > base and one[1] <= done.get(one[0], -1):
                    continue
                seen.add(one)
            out[name] = opened[name]
        return out

    def last_batch(self, writer: str = "") -> int:
        """The last batch of a writer that has been applied; -1 if none was."""
        return max((x["applied"].get(writer, -1) for x in self._entries().values()), default=-1)

    def _enter(self, order: str, entry: dict) -> None:
        if not files.write_new(self.spark, f"{self.path}/ledger/{order}", json.dumps(entry)):
            raise RuntimeError(f"{order} cannot be entered into the ledger of {self.path}")

    def _summarize(self, entries: dict[str, dict], parts: dict[str, list[str]]) -> None:
        """Enter one entry for all of `entries`, with these folders; delete what the summary before it covers."""
        order = f"{max(entries)}{_SUMMARY}{uuid.uuid4().hex[:8]}"  # sorts right behind what it covers
        applied: dict[str, int] = {}
        for x in entries.values():
            for writer, batch in x["applied"].items():
                applied[writer] = max(batch, applied.get(writer, -1))
        there = self._names("ledger")
        before = {x for name, e in entries.items() if _SUMMARY in name for x in e["covers"]}
        covers = [x for x in there if x in before or x in entries]
        self._enter(order, {"applied": applied, "parts": parts, "covers": covers})
        for x in before.intersection(there):
            files.delete(self.spark, f"{self.path}/ledger/{x}")

    def _write(self, rows: DataFrame, version: str) -> dict[str, list[str]]:
        """Write rows with `_order` by parts; the folder of each part."""
        out = rows.withColumn("_part", self._part).hint("rebalance", "_part")  # few files a part, and a large part split
        out.sortWithinPartitions("_part", *[F.desc(c) if down else F.asc(c) for c, down in self.spec.clustering]).write.partitionBy("_part").parquet(f"{self.path}/data/{version}")
        unescape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        return {unescape(x.removeprefix("_part=")): [f"{version}/{x}"] for x in self._names("data", version) if x.startswith("_part=")}

    def apply(self, rows: DataFrame, batch: int, writer: str | None = None) -> None:
        """Use as the sink of a stream: `start(df, config, sink=table.apply)`. Without `writer` it is the
        id of the stream whose batch is being handled; outside a stream it must be given."""
        if writer is None:
            writer = stream_id(self.spark)
        if not writer:
            raise ValueError("outside a stream a batch is known only with its writer's name")
        if batch <= self.last_batch(writer):
            return
        order = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        cast = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.spec.schema.fields], F.lit(order).alias("_order"))
        parts = self._write(cast, order)
        self._enter(order, {"applied": {writer: batch}, "parts": parts, "covers": []})
        entries = self._entries()
        loose = sum(_SUMMARY not in x for x in entries)
        if self.compact_every and max((len(x) for x in self._folders().values()), default=0) > self.compact_every:
            self.compact()
        elif loose >= SNAPSHOT:
            self._summarize(entries, self._folders())

    def _folders(self) -> dict[str, list[str]]:
        found: dict[str, list[str]] = {}
        for entry in self._entries().values():
            for part, folders in entry["parts"].items():
                found.setdefault(part, []).extend(folders)
        return found

    def _load(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self._stored)
        return self.spark.read.schema(self._stored).parquet(*[f"{self.path}/data/{x}" for x in folders])

    def _merged(self, rows: DataFrame) -> DataFrame:
        key, names = list(self.spec.key), self.spec.schema.fieldNames()
        rest = [c for c in names if c not in key]
        if self.merge:
            how = {c: getattr(F, self.merge.get(c, "max")) for c in rest}
            return rows.groupBy(*key).agg(*[how[c](c).alias(c) for c in rest], F.max("_order").alias("_order")).select(*names, "_order")
        tie = [*[c for c in (self.spec.order,) if c], *[c for c in rest if c != self.spec.order]]
        last = F.max_by(F.struct(*rest, "_order"), F.struct("_order", *tie))  # partial results before the shuffle
        return rows.groupBy(*key).agg(last.alias("_r")).select(*key, "_r.*").select(*names, "_order")

    def read(self, *parts: str) -> DataFrame:
        """The table, or only some of its parts."""
        folders = [x for k, v in self._folders().items() if not parts or k in parts for x in v]
        return self._merged(self._load(folders)).drop("_order")

    def compact(self) -> int:
        """Merge parts that have more than one folder; the number of them. May run beside writers."""
        entries = self._entries()
        folders = self._folders()
        many = {k: v for k, v in folders.items() if len(v) > 1}
        if not many:
            return 0
        made = self._write(self._merged(self._load([x for v in many.values() for x in v])), f"{max(entries)}-{uuid.uuid4().hex[:8]}")
        self._summarize(entries, {**folders, **made})
        return len(many)

    def vacuum(self) -> int:
        """Delete folders and ledger entries that no entry that counts needs, when nothing reads them
        any more and no batch is being applied; the number of folders."""
        entries = self._entries()
        keep, gone = {x for v in self._folders().values() for x in v}, 0
        for version in self._names("data"):
            inside = self._names("data", version)
            kept = [x for x in inside if f"{version}/{x}" in keep]
            for part in [x for x in inside if x.startswith("_part=") and x not in kept]:
                gone += files.delete(self.spark, f"{self.path}/data/{version}/{part}")
            if not kept:
                files.delete(self.spark, f"{self.path}/data/{version}")
        for name in self._names("ledger"):
            if name not in entries:
                files.delete(self.spark, f"{self.path}/ledger/{name}")
        return gone
