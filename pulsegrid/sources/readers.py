"""Sources: message streams and tables, files, generators, and the test tables seen as readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import CONFIG, RECORD

UTC = "spark.sql.session.timeZone"


def topics_of(names: str) -> list[str]:
    """A comma-separated list; at least one name."""
    found = [x.strip() for x in names.split(",") if x.strip()]
    if not found:
        raise ValueError("no topic named")
    return found


def passed_through(options: dict[str, str], prefix: str) -> dict[str, str]:
    """Options under a prefix, without it."""
    return {k.removeprefix(prefix): v for k, v in options.items() if k.startswith(prefix)}


def message_stream(spark: SparkSession, servers: str, topics: str = "", starting: str = "earliest", assign: str | None = None, **options: str) -> DataFrame:
    """A message broker's topics as a stream of RECORD rows; needs the broker's connector on the class
    path. `assign` (JSON of topic -> partitions) takes fixed partitions; `starting` may hold offsets as JSON."""
    chosen = {"assign": assign} if assign else {"subscribe": ",".join(topics_of(topics))}
    return spark.readStream.format("kafka").options(**{"kafka.bootstrap.servers": servers, "startingOffsets": starting}, **chosen, **options).load()


def record_stream(spark: SparkSession, path: str, files_at_once: int | None = None) -> DataFrame:
    """The same rows from a folder of Parquet files, where no broker is at hand."""
    reader = spark.readStream.schema(RECORD)
    return (reader.option("maxFilesPerTrigger", files_at_once) if files_at_once else reader).parquet(path)


def read_configs(spark: SparkSession, path: str) -> DataFrame:
    """Metric configurations from JSON lines, by schema rather than by a pass to infer one."""
    return spark.read.schema(CONFIG).json(path)


def stored_offsets(offsets: DataFrame, topic: str) -> DataFrame:
    return offsets.where(F.col("topic") == topic).orderBy(F.desc("partition"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_signals(events: DataFrame) -> DataFrame:
    """The table `events` as readings. Its times have no zone and are UTC; the value stays a double."""
    return events.select(
        F.lit(None).cast("string").alias("unique_id"), F.col("event_id").alias("id"), "value", F.col("ts").cast("timestamp").alias("timestamp"), F.get_json_object("props", "$.k").try_cast("bigint").alias("quality"),
        F.col("event_id").alias("opc_tag_reading_id"), F.col("user_id").alias("opc_tag_id"), F.col("event_type").alias("proxied_type_name"), F.col("event_type").alias("topic"),
    )


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_signals(table(spark, sf_dir, "events"))


def signal_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a stream of files."""
    schema = table(spark, sf_dir, "events").schema
    return as_signals(spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet"))


def configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table `orders` as versions of metric configurations: five priorities play the intervals,
    status P plays None."""
    names = {"o_custkey": ("OPCMetricID", "OPCTagID"), "o_orderdate": ("Timestamp",), "o_orderpriority": ("AggregationInterval",)}
    kind = F.when(F.col("o_orderstatus") == "P", "None").otherwise(F.col("o_orderstatus")).alias("AggregationType")
    return table(spark, sf_dir, "orders").select(*[F.col(c).alias(name) for c, own in names.items() for name in own], kind)


def as_cycle(numbered: DataFrame) -> DataFrame:
    """Numbered rows (`sequence` from 1) as events that turn between START and END, both of one job."""
    pair = F.sha2(F.expr("cast((sequence - 1) div 2 as string)"), 256)
    job = F.concat_ws("-", *[F.substring(pair, a, k) for a, k in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    even = F.col("sequence") % 2 == 0
    return numbered.withColumns({"job_id": job, "type": F.when(even, "END").otherwise("START"), "even": even})


def random_events(spark: SparkSession, n: int, node_id: str = "Node-1", start_s: int = 0, step_s: int = 0) -> DataFrame:
    """n events `step_s` seconds apart, of type UNKNOWN."""
    ids = spark.range(n)
    stamp = F.timestamp_seconds(F.lit(start_s) + F.col("id") * step_s).alias("timestamp")
    own = [F.expr("uuid()").alias("id"), (F.col("id") + 1).alias("sequence"), F.lit(node_id).alias("node_id"), F.expr("uuid()").alias("job_id"), F.lit("UNKNOWN").alias("type")]
    return ids.select(*own, stamp, F.lit("generator").alias("generator_id"), F.lit(1).cast("long").alias("version"))


def cycle_events(spark: SparkSession, n: int, node_id: str = "Node-1", start_s: int = 0, step_s: int = 1) -> DataFrame:
    """n events that turn between START and END, both of one job."""
    return as_cycle(random_events(spark, n, node_id, start_s, step_s)).drop("even")
