"""Catalog tables in buckets of a key, sorted inside: made once, then joined and grouped by it without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def ensure(spark: SparkSession, name: str, rows: DataFrame, by: str, buckets: int, sort: tuple[str, ...] = (), path: str | None = None) -> DataFrame:
    """The table `name`, made from `rows` if it isn't there: a bucket holds all rows of its keys, sorted by the
    key and `sort`. Rows are dealt to the buckets first, so each is one file. An existing table of other
    buckets is an error. With `path` the files are there and the catalog only points to them."""
    if not spark.catalog.tableExists(name):
        dealt = rows.repartition(buckets, by)
        writer = dealt.write.bucketBy(buckets, by).sortBy(by, *sort)
        (writer.option("path", path) if path else writer).saveAsTable(name)
    kept = {r.col_name: r.data_type for r in spark.sql(f"describe extended {name}").collect()}
    if (kept.get("Num Buckets"), kept.get("Bucket Columns")) != (str(buckets), f"[`{by}`]"):
        raise ValueError(f"{name} is not in {buckets} buckets of {by}")
    return spark.table(name)
