"""What the two vector searches share: which vectors take part, and reading them from Arrow."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick


def usable(df: DataFrame, id_col: str, vector_col: str, zero: bool, **more: str) -> DataFrame:
    """(vec_id, embedding array<double>) of the vectors that take part: with an id, not empty, no null
    or non-finite component, not all zero unless `zero`, and of the most common length (the larger of
    two equally common ones). `more` columns go along under the names given."""
    rows = pick(df, vec_id=id_col, embedding=vector_col, **more).selectExpr("cast(vec_id as long) vec_id", "cast(embedding as array<double>) embedding", *more)
    bad = "exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    rows = rows.where(f"vec_id is not null and embedding is not null and size(embedding) > 0 and not coalesce({bad}, true)")
    if not zero:
        rows = rows.where("exists(embedding, x -> x <> 0)")
    lengths = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("embedding") == (lengths[0]["d"] if lengths else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def rows_of(m: np.ndarray) -> pa.ListArray:
    n, d = m.shape
    return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * d, pa.array(np.ascontiguousarray(m).reshape(-1)))
