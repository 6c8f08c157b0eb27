"""JSON codecs of readings and events, as expressions.

Numbers arrive plain or quoted, so they are read as strings and converted; what can't be converted
becomes null and is listed in `problems`, not dropped and not guessed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.sources.schemas import EVENT_TYPES

# The names that the wire formats of readings and events give their fields.
_NUMBERS = {"Value": "value", "ID": "id", "Quality": "quality", "OPCTagReadingID": "opc_tag_reading_id", "OPCTagID": "opc_tag_id"}
_WIRE = "array<struct<UniqueID:string,ID:string,Value:string,Timestamp:string,Quality:string,OPCTagReadingID:string,OPCTagID:string,ProxiedTypeName:string,ExtendedProperties:array<string>>>"
_EVENT_WIRE = "struct<id:string,sequence:string,nodeId:string,jobId:string,type:string,timestamp:string,generatorId:string,version:string>"
#: A full instant in UTC. Shorter forms would be filled up with today's date or the session's zone.
INSTANT = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d{1,9})?[Zz]$"
UUID = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def to_long(c: Column) -> Column:
    """A number or numeric text as a long, fractions cut off; null if it is neither."""
    return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))


def to_instant(c: Column) -> Column:
    """An ISO instant as a timestamp, cut to microseconds; null for any other text."""
    return F.when(c.rlike(INSTANT), F.try_to_timestamp(F.upper(c)))


def from_millis(c: Column) -> Column:
    """Milliseconds since 1970 as a time."""
    return F.timestamp_millis(c)


def iso(ts: Column) -> Column:
    """A time as ISO text in milliseconds, UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def now_iso() -> Column:
    return iso(F.current_timestamp())


def day_of(ts: Column) -> Column:
    """Midnight of the day (UTC session) as an ISO instant."""
    return F.date_format(ts, "yyyy-MM-dd'T'00:00:00'Z'")


def floor_to(ts: Column, unit: str) -> Column:
    """The hour or minute that a time falls into."""
    if unit.upper() not in ("HOUR", "MINUTE"):
        raise ValueError(f"unit must be HOUR or MINUTE, not {unit}")
    return F.date_trunc(unit.upper(), ts)


def decode_signals(records: DataFrame, value: str = "value") -> DataFrame:
    """Readings from message values: an array of objects, whose first counts, or a bare object.

    Adds `problems` (array of field names; `payload` for what isn't JSON). A Timestamp must be a full
    ISO instant; one that is absent or null is a problem too, since a reading without a time has no
    place in any table. Empty payloads are left out, as nothing was sent; use `split_quarantine` for
    the rest.
    """
    text = F.col(value).cast("string")
    # behind a generator the JSON is parsed once for a row, not once for each field
    rows = records.where(F.length(text) > 0).select(text.alias("_raw"), F.explode_outer(F.slice(F.from_json(text, _WIRE), 1, 1)).alias("_s"))
    numbers = {out: to_long(F.col(f"_s.{wire}")) for wire, out in _NUMBERS.items()}
    ts = to_instant(F.col("_s.Timestamp"))
    problems = [F.when(F.col("_s").isNull(), "payload"), F.when(F.col("_s").isNotNull() & ts.isNull(), "Timestamp")]
    problems += [F.when(F.col(f"_s.{wire}").isNotNull() & numbers[out].isNull(), wire) for wire, out in _NUMBERS.items()]
    return rows.select(
        F.when(F.col("_s.UniqueID") != "", F.col("_s.UniqueID")).alias("unique_id"), numbers["id"].alias("id"), numbers["value"].alias("value"), day_of(ts).alias("day"), ts.alias("timestamp"), numbers["quality"].alias("quality"),
        numbers["opc_tag_reading_id"].alias("opc_tag_reading_id"), numbers["opc_tag_id"].alias("opc_tag_id"), F.col("_s.ProxiedTypeName").alias("proxied_type_name"),
        F.coalesce("_s.ExtendedProperties", F.array().cast("array<string>")).alias("extended_properties"), F.array_compact(F.array(*problems)).alias("problems"), F.col("_raw").alias("raw"),
    )


def decode_drifted(records: DataFrame, value: str = "value") -> DataFrame:
    """Readings from messages whose fields may have drifted from the wire format, without losing any of them.

    The text becomes a VARIANT: fields of the wire format are taken from it where their type allows,
    whatever else there is stays, as JSON by name, in `extra`. `lost` names known fields that are there but
    can't be read as what they should be (their JSON stays in `extra`, too); what isn't a JSON object, or an
    array that begins with one, has `payload` there. Empty payloads are left out.
    """
    text = F.col(value).cast("string")
    v = F.try_parse_json(text)
    rows = records.where(F.length(text) > 0).select(text.alias("raw"), F.try_variant_get(F.coalesce(F.try_variant_get(v, "$[0]", "variant"), v), "$", "map<string,variant>").alias("_m"))
    rows = rows.withColumn("_f", F.map_filter(F.transform_values("_m", lambda _, x: F.to_json(x)), lambda _, x: x != "null"))
    texts = {wire: F.try_variant_get(F.col("_m")[wire], "$", "string") for wire in [*_NUMBERS, "Timestamp", "ProxiedTypeName"]}
    found = {out: to_long(texts[wire]) for wire, out in _NUMBERS.items()} | {"timestamp": to_instant(texts["Timestamp"]), "proxied_type_name": texts["ProxiedTypeName"]}
    wires = {**_NUMBERS, "Timestamp": "timestamp", "ProxiedTypeName": "proxied_type_name"}
    # behind a generator the JSON is parsed once for a row
    read = rows.select("raw", F.explode(F.array(F.struct(F.col("_f"), *[c.alias(out) for out, c in found.items()]))).alias("_r")).select("raw", "_r.*")
    known = F.array(*[F.when(F.col(out).isNotNull(), wire) for wire, out in wires.items()])
    lost = [F.when(F.col("_f")[wire].isNotNull() & F.col(out).isNull(), wire) for wire, out in wires.items()]
    extra = F.map_filter("_f", lambda k, _: ~F.array_contains(F.array_compact(known), k))
    payload = F.when(F.col("_f").isNull(), F.lit("payload"))
    return read.select(*found, F.coalesce(extra, F.expr("cast(map() as map<string,string>)")).alias("extra"), F.array_compact(F.array(payload, *lost)).alias("lost"), "raw")


def unknown_fields(drifted: DataFrame) -> DataFrame:
    """(field, readings): how many readings have a field that isn't read, by its name."""
    return drifted.select(F.explode(F.map_keys("extra")).alias("field")).groupBy("field").agg(F.count("*").alias("readings"))


def split_quarantine(decoded: DataFrame, fail_fast: bool = False) -> tuple[DataFrame, DataFrame]:
    """Good rows without the helper columns, and bad rows as they came. `fail_fast` raises at the first bad row."""
    good = decoded.where(F.size("problems") == 0).drop("problems", "raw")
    if fail_fast:
        check = F.when(F.size("problems") > 0, F.raise_error(F.concat(F.lit("cannot decode "), "raw"))).otherwise(F.lit(True))
        good = decoded.where(check.cast("boolean")).drop("problems", "raw")
    return good, decoded.where(F.size("problems") > 0).select("raw", "problems")


def signal_json() -> Column:
    """A reading's columns as a one-element JSON array, nulls written."""
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    names = {"ExtendedProperties": "extended_properties", "ProxiedTypeName": "proxied_type_name", "OPCTagID": "opc_tag_id", "OPCTagReadingID": "opc_tag_reading_id", "Quality": "quality"}
    body = F.struct(*[F.col(c).alias(wire) for wire, c in names.items()], stamp.alias("Timestamp"), F.col("value").alias("Value"), F.col("id").alias("ID"), F.col("unique_id").alias("UniqueID"))
    return F.to_json(F.array(body), {"ignoreNullFields": "false"})


def encode_signals(signals: DataFrame) -> DataFrame:
    """(value): each reading as a message."""
    return signals.select(signal_json().alias("value"))


def decode_events(records: DataFrame, value: str = "value") -> DataFrame:
    """Events with `problems`: required fields that are missing, ids that aren't UUIDs, sequence 0, unknown types."""
    text = F.col(value).cast("string")
    e = records.where(F.length(text) > 0).select(text.alias("raw"), F.explode_outer(F.array(F.from_json(text, _EVENT_WIRE))).alias("e"))
    sequence, ts = to_long(F.col("e.sequence")), to_instant(F.col("e.timestamp"))
    missing = lambda c: c.isNull() | (c == "")
    problems = [
        F.when(missing(F.col("e.id")) | ~F.col("e.id").rlike(UUID), "id"), F.when(F.coalesce(sequence, F.lit(0)) == 0, "sequence"), F.when(missing(F.col("e.nodeId")), "nodeId"),
        F.when(missing(F.col("e.jobId")) | ~F.col("e.jobId").rlike(UUID), "jobId"), F.when(~F.coalesce(F.col("e.type").isin(*EVENT_TYPES), F.lit(False)), "type"), F.when(ts.isNull(), "timestamp"),
    ]
    named = {"id": F.col("e.id"), "sequence": sequence, "node_id": F.col("e.nodeId"), "job_id": F.col("e.jobId"), "type": F.col("e.type"), "timestamp": ts}
    named |= {"generator_id": F.col("e.generatorId"), "version": to_long(F.col("e.version")), "problems": F.array_compact(F.array(*problems))}
    return e.select(*[c.alias(name) for name, c in named.items()], "raw")


def encode_events(events: DataFrame) -> DataFrame:
    """(value): each event as a JSON object; the version is left out where it is null."""
    stamp = iso(F.col("timestamp"))
    fields = [F.col("id"), F.col("sequence"), F.col("node_id").alias("nodeId"), F.col("job_id").alias("jobId"), F.col("type"), stamp.alias("timestamp"), F.col("generator_id").alias("generatorId")]
    plain = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return events.select(F.when(F.col("version").isNull(), plain).otherwise(F.to_json(F.struct(*fields, F.col("version")), {"ignoreNullFields": "false"})).alias("value"))


def event_floor(ts: Column, unit: str) -> Column:
    """A time floored to MINUTES or HOURS (UTC) as ISO text."""
    if unit not in ("MINUTES", "HOURS"):
        raise ValueError(f"unit must be MINUTES or HOURS, not {unit}")
    return iso(F.date_trunc(unit[:-1], ts))
