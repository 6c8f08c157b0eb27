"""Packing into optimal length buckets.

The global histogram of lengths has a bounded number of bins, since longer rows are cut. Dynamic
programming over it chooses the bucket boundaries with the least padding in all. Inside a bucket
every row is padded to the bucket's length, so a batch of the token budget holds the same number
of rows everywhere, and a row's batch follows from its number within the bucket.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, number_rows, pick, table

#: Longer rows are cut into pieces of this many tokens; nothing is dropped.
MAX_LENGTH = 4096
#: Lengths are rounded up to this, for devices that want it; at 1 padding is the least there can be.
#: MAX_LENGTH / MULTIPLE bins at most come to the driver.
MULTIPLE = 1
BUCKETS = 12
#: Tokens of a batch, padding included.
BUDGET = 32_768
WORDS = r"[^\x20\x09-\x0D]+"


def boundaries(bins: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper ends, among the bins, of the at most `buckets` buckets with the least padding.

    Of equally good choices the one whose last boundaries come earliest. No bins: no buckets.
    """
    m = len(bins)
    if not m:
        return []
    b, c = np.array(bins, np.int64), np.array(counts, np.int64)
    s0, s1 = np.concatenate([[0], np.cumsum(c)]), np.concatenate([[0], np.cumsum(b * c)])
    cost = np.concatenate([[0], b * s0[1:] - s1[1:]])  # of the first j bins in one bucket
    came = [np.zeros(m + 1, np.int64)]
    for k in range(2, min(buckets, m) + 1):
        best, prev = np.full(m + 1, np.iinfo(np.int64).max), np.zeros(m + 1, np.int64)
        for j in range(k, m + 1):
            i = np.arange(k - 1, j)
            total = cost[i] + b[j - 1] * (s0[j] - s0[i]) - (s1[j] - s1[i])
            at = int(total.argmin())
            best[j], prev[j] = total[at], i[at]
        cost = best
        came.append(prev)
    ends, j = [], m
    for prev in reversed(came):
        ends.append(int(b[j - 1]))
        j = int(prev[j])
    return ends[::-1]


def pieces(df: DataFrame, id_col: str, length_col: str, max_length: int = MAX_LENGTH) -> DataFrame:
    """(doc_id, piece, start, n_tokens): rows longer than max_length in pieces. A null length is 0."""
    rows = pick(df, doc_id=id_col, n=length_col).select(F.col("doc_id").cast("long"), F.greatest(F.coalesce(F.col("n").cast("long"), F.lit(0)), F.lit(0)).alias("n"))
    cut = rows.select("doc_id", "n", F.explode(F.expr(f"sequence(0L, greatest(n - 1, 0L) div {max_length})")).alias("piece"))
    return cut.select("doc_id", "piece", (F.col("piece") * max_length).alias("start"), F.least(F.col("n") - F.col("piece") * max_length, F.lit(max_length)).alias("n_tokens"))


def pack(df: DataFrame, id_col: str = "doc_id", length_col: str = "n_tokens", max_length: int = MAX_LENGTH, multiple: int = MULTIPLE, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """(doc_id, piece, start, n_tokens, bucket, bucket_len, batch, slot, padding) of every piece.

    Buckets count from 0 by length; a batch counts from 0 within its bucket and has at most
    max(1, budget div bucket_len) rows; slot is the place in the batch. Rows of a bucket are
    numbered by (doc_id, piece, n_tokens), nulls first; equal rows may swap numbers. Rows of
    length 0 are packed too; an empty table gives an empty result.
    """
    return _placed(pieces(df, id_col, length_col, max_length), multiple, buckets, budget)


def _placed(cut: DataFrame, multiple: int, buckets: int, budget: int) -> DataFrame:
    """Pieces with their places, and what other columns they have."""
    more = [c for c in cut.columns if c not in ("doc_id", "piece", "start", "n_tokens")]
    # written once for the histogram and the batches
    cut = materialize(cut.withColumn("bin", F.greatest(F.ceil(F.col("n_tokens") / multiple), F.lit(1)).cast("long") * multiple), "packing-pieces")
    seen = sorted((r["bin"], r["count"]) for r in cut.groupBy("bin").count().collect())  # at most max_length / multiple
    ends = boundaries([x for x, _ in seen], [n for _, n in seen], buckets) or [multiple]
    bucket = sum(((F.col("bin") > e).cast("int") for e in ends[:-1]), F.lit(0))
    rows = cut.drop("bin").withColumn("bucket", F.lit(0)) if len(ends) == 1 else cut.withColumn("bucket", bucket).drop("bin")
    numbered = number_rows(rows, ["bucket", "doc_id", "piece", "n_tokens"], "n_tokens", "packing", written=True)
    first = {r["bucket"]: r["at"] for r in numbered.placed().groupBy("bucket").agg(F.min("_at").alias("at")).collect()}
    starts = F.array(*[F.lit(first.get(k, 0)).cast("long") for k in range(len(ends))])
    length = F.array(*[F.lit(e).cast("long") for e in ends])[F.col("bucket")]
    return (
        numbered.placed()
        .withColumn("bucket_len", length)
        .withColumn("_n", F.col("_at") - starts[F.col("bucket")])
        .withColumn("_cap", F.greatest(F.expr(f"{int(budget)} div bucket_len"), F.lit(1)))
        .select("doc_id", "piece", "start", "n_tokens", "bucket", "bucket_len", F.expr("_n div _cap").alias("batch"), F.expr("_n % _cap").alias("slot"), (F.col("bucket_len") - F.col("n_tokens")).alias("padding"), *more)
    )


def token_batches(tokens: DataFrame, pad: int = 0, id_col: str = "doc_id", ids_col: str = "ids", max_length: int = MAX_LENGTH, multiple: int = MULTIPLE, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """(bucket, batch, bucket_len, doc_ids, pieces, lengths, input_ids): the batches themselves, one row
    each, from a table of token ids such as `bpe_automaton.encode` gives.

    input_ids has one list for each row of the batch, padded with `pad` to bucket_len; a batch holds
    `budget` ids at most (or one row), so none outgrows a task. Ids stay int where they are; other kinds
    become long. Null lists count as empty; null ids and repeated rows stay; an empty table gives no batch.
    """
    given = pick(tokens, doc_id=id_col, ids=ids_col)
    kind = "int" if given.schema["ids"].dataType.simpleString() == "array<int>" else "bigint"
    ids = F.coalesce(F.col("ids").cast(f"array<{kind}>"), F.array().cast(f"array<{kind}>"))
    rows = given.select(F.col("doc_id").cast("long"), ids.alias("ids"))
    n_pieces = F.expr(f"sequence(0L, greatest(size(ids) - 1L, 0L) div {max_length})")
    cut = rows.select("doc_id", "ids", F.explode(n_pieces).alias("piece")).select(
        "doc_id", "piece", (F.col("piece") * max_length).alias("start"),
        F.expr(f"slice(ids, cast(piece * {max_length} + 1 as int), {max_length})").alias("ids"),
    ).withColumn("n_tokens", F.size("ids").cast("long"))
    # the ids are written once and meet their places by row, so that only lengths are put in order
    held = materialize(cut.withColumn("_row", F.monotonically_increasing_id()), "packing-ids")
    places = _placed(held.drop("ids"), multiple, buckets, budget).select("_row", "bucket", "batch", "bucket_len", "slot", "doc_id", "piece", "n_tokens", "padding")
    filled = F.expr(f"concat(ids, array_repeat(cast({int(pad)} as {kind}), cast(padding as int)))")
    placed = held.select("_row", "ids").join(places, "_row").select("bucket", "batch", "bucket_len", F.struct("slot", "doc_id", "piece", "n_tokens", filled.alias("ids")).alias("r"))
    found = placed.groupBy("bucket", "batch").agg(F.max("bucket_len").alias("bucket_len"), F.array_sort(F.collect_list("r")).alias("r"))
    return found.select("bucket", "batch", "bucket_len", F.col("r.doc_id").alias("doc_ids"), F.col("r.piece").alias("pieces"), F.col("r.n_tokens").alias("lengths"), F.col("r.ids").alias("input_ids"))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) with the words of whole texts as tokens; a null text has none."""
    return pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORDS)), F.lit(0)).cast("long").alias("n_tokens"))


def op1_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(word_counts(table(spark, sf_dir, "documents")))


def pack_sql(docs: str = "select doc_id, text from documents") -> str:
    """The same in DuckDB's SQL, the dynamic programming as a recursive query."""
    return rf"""
with recursive d as ({docs}),
w as (select doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint n from d),
cut as (select doc_id, n, unnest(range(0, greatest(n - 1, 0) // {MAX_LENGTH} + 1))::bigint piece from w),
pieces as (select doc_id, piece, piece * {MAX_LENGTH} "start", least(n - piece * {MAX_LENGTH}, {MAX_LENGTH}) n_tokens from cut),
binned as (select *, greatest((n_tokens + {MULTIPLE - 1}) // {MULTIPLE}, 1) * {MULTIPLE} bin from pieces),
h as (select bin b, count(*) c from binned group by 1),
p as (select b, row_number() over (order by b) j, (sum(c) over (order by b))::bigint s0, (sum(b * c) over (order by b))::bigint s1 from h),
dp(k, j, cost, prev) as (
  select 1, j, b * s0 - s1, 0::bigint from p
  union all
  select k, j, cost, prev from (
    select x.k + 1 k, q.j, x.cost + q.b * (q.s0 - e.s0) - (q.s1 - e.s1) cost, x.j prev,
           row_number() over (partition by q.j order by x.cost + q.b * (q.s0 - e.s0) - (q.s1 - e.s1), x.j) r
    from dp x join p e on e.j = x.j join p q on q.j > x.j
    where x.k < least({BUCKETS}, (select count(*) from p)))
  where r = 1),
walk(k, j) as (
  select least({BUCKETS}, (select count(*) from p))::int, (select max(j) from p)
  union all
  select w.k - 1, x.prev from walk w join dp x on x.k = w.k and x.j = w.j where w.k > 1),
ends as (select (w.k - 1)::int bucket, p.b bucket_len from walk w join p on p.j = w.j),
placed as (select c.*, (select min(bucket) from ends where bucket_len >= c.bin) bucket from binned c),
numbered as (select doc_id, piece, "start", n_tokens, bucket, row_number() over (partition by bucket order by doc_id nulls first, piece, n_tokens) - 1 n from placed)
select doc_id, piece, "start", n_tokens, bucket, bucket_len, n // greatest({BUDGET} // bucket_len, 1) batch,
       n % greatest({BUDGET} // bucket_len, 1) slot, bucket_len - n_tokens padding
from numbered join ends using (bucket)
"""
