"""Helpers shared by the operators: column access, written intermediate tables, table readers."""

from __future__ import annotations

import re
import tempfile
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Bytes of the batches that go to Python workers, where the session has no bound of its own; one row may take more.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def col(name: str) -> Column:
    """The column of exactly this name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that clashing ones can't matter."""
    return df.select(*[col(v).alias(k) for k, v in names.items()])


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`.

    Only where the session has none and all runs in one process (master `local`: a test, a notebook)
    a folder of this machine is made and set; on a cluster the setting must be there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="pulsegrid-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{_own_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def _own_scratch(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/pulsegrid/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the tables that this application's operators have written in the shared folder. Results
    are read from them, so call it when those are written elsewhere."""
    p = spark._jvm.org.apache.hadoop.fs.Path(_own_scratch(spark))
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def bound_batches(spark: SparkSession) -> None:
    """Bound the batches that go to Python workers by BATCH_BYTES, from now on, in a session that has set
    no bound itself."""
    if _BATCH not in spark.conf.getAll:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back.

    Cuts the lineage, keeps columns prunable, and outlives any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    bound_batches(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table that `materialize` wrote and that nothing reads any more."""
    jvm = spark._jvm
    for f in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/pulsegrid/" in f:
            p = jvm.org.apache.hadoop.fs.Path(f)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


#: Bits of the filter that keeps rows from being moved in vain.
BITS = 1 << 26


def maybe_in(rows: DataFrame, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows whose `key` may be among that column of `wanted`: none of those is lost, few others stay.

    The keys are hashed into a bitmap of BITS bits, kept as rows of 4 KB: 8 MB at most, however many
    keys there are, so it can be broadcast. With far more keys than bits it lets all rows pass.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(BITS)) + 1
    maps = wanted.select(bit.alias("b")).groupBy(F.bitmap_bucket_number("b").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits"))
    place = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1
    return rows.join(F.broadcast(maps), (F.bitmap_bucket_number(bit) == F.col("bucket")) & is_set, "left_semi")


def dealt_anew(totals: DataFrame, key: str) -> DataFrame:
    """`totals` of a table by `key` (a long), for a join with that table on `key`.

    Spark would join the totals where they were aggregated, and adaptive execution splits a hot key
    only in joins of two plain exchanges. The key is therefore computed anew, which hides that the
    totals lie by it already, so they are dealt out again: one row for each key."""
    return totals.withColumn(key, F.col(key).bitwiseXOR(F.lit(0).cast("long")))


def raw_texts(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes; nulls are empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Numbered(NamedTuple):
    """Rows in a global order. `rows` has, beside its own columns, `_pid` (the partition, in order),
    `_idx` (place in it) and `_before` (weight of the rows before it in the partition); `parts` has
    (pid, rows, weight, rows before, weight before) of each partition that isn't empty."""

    rows: DataFrame
    parts: list[tuple[int, int, int, int, int]]

    def totals(self) -> tuple[int, int]:
        return sum(p[1] for p in self.parts), sum(p[2] for p in self.parts)

    def placed(self) -> DataFrame:
        """Rows with `_at` and `_weight_at`: rows and weight before each in the whole order.

        What is broadcast has one row for each partition."""
        spark = self.rows.sparkSession
        starts = spark.createDataFrame([(p[0], p[3], p[4]) for p in self.parts] or [(-1, 0, 0)], "_pid int, _r long, _w long")
        return self.rows.join(F.broadcast(starts), "_pid").select("*", (F.col("_r") + F.col("_idx")).alias("_at"), (F.col("_w") + F.col("_before")).alias("_weight_at")).drop("_r", "_w")


ROWS_A_PARTITION = 2_000_000


def number_rows(df: DataFrame, order: list[str], weight: str, label: str, written: bool = False) -> Numbered:
    """Put rows into a global order and number them, without a task that gets them all. `written` says
    that `df` comes from a written table, so that reading it again is cheap.

    The rows are dealt by ranges of the whole order, so that many rows that tie in its first
    columns are still spread; each partition numbers its own, and only the partitions' counts
    come to the driver. The numbered rows are written, so later reads see the same numbers.
    """
    spark = df.sparkSession
    source = df if written else materialize(df, f"{label}-source")  # ranges are sampled: don't compute the input twice
    n = max(shuffle_partitions(spark), -(-source.count() // ROWS_A_PARTITION))
    dealt = source.repartitionByRange(n, *order).sortWithinPartitions(*order)
    schema = T.StructType([*df.schema.fields, T.StructField("_pid", T.IntegerType()), T.StructField("_idx", T.LongType()), T.StructField("_before", T.LongType())])

    def run(batches):
        pid = TaskContext.get().partitionId()
        rows = before = 0
        for b in batches:
            w = np.nan_to_num(b.column(b.schema.get_field_index(weight)).to_numpy(zero_copy_only=False)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(w), pid, np.int32)), pa.array(np.arange(rows, rows + len(w))), pa.array(np.cumsum(w) - w + before)], names=[*b.schema.names, "_pid", "_idx", "_before"])
            rows, before = rows + len(w), before + int(w.sum())

    numbered = materialize(dealt.mapInArrow(run, schema), label)
    counts = sorted(tuple(r) for r in numbered.groupBy("_pid").agg(F.count("*"), F.sum(F.coalesce(F.col(weight), F.lit(0)).cast("long"))).collect())
    parts, rows, total = [], 0, 0
    for pid, n_rows, w in counts:
        parts.append((pid, n_rows, w, rows, total))
        rows, total = rows + n_rows, total + w
    return Numbered(numbered, parts)
