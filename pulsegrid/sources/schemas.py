"""Schemas of records and sink tables, with the keys and clustering of the tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_L, _S, _D, _TS = T.LongType(), T.StringType(), T.DoubleType(), T.TimestampType()


def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])


#: What a message source gives, streaming or not.
RECORD = _fields(value=T.BinaryType(), timestamp=_TS, timestampType=T.IntegerType(), partition=T.IntegerType(), key=T.BinaryType(), topic=_S, offset=_L)

#: A reading as its codec gives it.
SIGNAL = _fields(unique_id=_S, id=_L, value=_L, day=_S, timestamp=_TS, quality=_L, opc_tag_reading_id=_L, opc_tag_id=_L, proxied_type_name=_S, extended_properties=T.ArrayType(_S))

EVENT = _fields(id=_S, sequence=_L, node_id=_S, job_id=_S, type=_S, timestamp=_TS, generator_id=_S, version=_L)
EVENT_TYPES = ("START", "END", "UNKNOWN")

#: Intervals that a metric configuration can name, with their length in minutes.
INTERVALS = {"FiveMinutes": 5, "FifteenMinutes": 15, "ThirtyMinutes": 30, "Hour": 60, "Day": 1440}

CONFIG = _fields(OPCMetricID=_L, OPCTagID=_L, Timestamp=_TS, AggregationInterval=_S, AggregationType=_S)


@dataclass(frozen=True)
class Table:
    schema: T.StructType
    key: tuple[str, ...]
    clustering: tuple[tuple[str, bool], ...] = ()  # column, descending
    #: SQL over key columns: the part of the table that a row lives in.
    part: str = "'all'"
    #: Of rows of one key in one batch the one of the largest was written last.
    order: str = ""


_AGGREGATE = dict(opc_tag_id=_L, aggregate=_TS, count=_L, sum=_L, min=_L, max=_L)
_DAY = "date_format(aggregate, 'yyyy-MM-dd')"

TABLES: dict[str, Table] = {
    "signals": Table(SIGNAL, ("opc_tag_id", "day", "timestamp"), (("opc_tag_id", False), ("timestamp", True)), "substring(day, 1, 10)", "id"),
    "signal_aggregate": Table(_fields(**_AGGREGATE), ("opc_tag_id", "aggregate"), (("opc_tag_id", False), ("aggregate", True)), _DAY),
    "ss_signal_aggregation": Table(_fields(**_AGGREGATE, avg=_D), ("opc_tag_id", "aggregate"), (("opc_tag_id", False), ("aggregate", True)), _DAY),
    "signal_validation": Table(_fields(id=_S, producer_count=_L, producer_error_count=_L, spark_count=_L), ("id",)),
    "ss_signal_validation": Table(_fields(id=_S, topic=_S, spark_count=_L), ("id", "topic")),
    "offsets": Table(_fields(topic=_S, partition=T.IntegerType(), from_offset=_L, to_offset=_L), ("topic", "partition"), (("topic", False), ("partition", False))),
    "running_totals": Table(_fields(opc_tag_id=_L, total=T.DecimalType(28, 2), count=_L), ("opc_tag_id",), (), "pmod(opc_tag_id, 16)"),
    "query_statistics": Table(_fields(id=_S, time=_S, json=_S), ("id", "time"), (("id", False), ("time", True)), "substring(time, 1, 10)"),
    "events": Table(_fields(id=_S, sequence=_L, node_id=_S, job_id=_S, type=_S, timestamp=_S, generator_id=_S), ("id",), (), "pmod(xxhash64(id), 64)"),
}


def ddl(table: str, name: str, path: str, buckets: int = 8) -> str:
    """SQL that makes a catalog table of one of `TABLES` if it isn't there: Parquet files at `path`, in buckets
    of the first key column, inside sorted by the clustering columns (upwards; Spark has no other order in files)."""
    spec = TABLES[table]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema.fields)
    order = ", ".join(f"`{c}`" for c in dict.fromkeys([spec.key[0], *[c for c, _ in spec.clustering]]))
    place = f"CLUSTERED BY (`{spec.key[0]}`) SORTED BY ({order}) INTO {buckets} BUCKETS"
    return f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {place} LOCATION '{path}'"
