"""Exact top-k search by inner product with a KD-tree for each shard.

A bounded sample gives the top splits, by medians, and their leaves are the shards; a leaf that holds
more rows than a shard may is split further by a hash. Each shard's tree goes on splitting at
medians and keeps tight bounding boxes; the largest inner product that a box allows bounds its
subtree, and subtrees are visited best bound first until none can reach the k-th score. Every query
first searches the shard of the best bound; the k-th score found there travels with it to those
other shards whose box can still reach it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table
from .vectors import matrix, rows_of, usable

NEAREST = 5
#: Rows of a shard, until there are MAX_SHARDS of them; then they grow.
SHARD_ROWS = 16_384
#: Boxes are broadcast: two vectors for each shard.
MAX_SHARDS = 8192
#: Most rows that the top splits are taken from, chosen by a hash of the id; every row is searched.
SAMPLE = 16_384
LEAF = 128
#: Queries whose bounds of all shards are computed at once.
_AT_ONCE = 64


def largest(x: np.ndarray) -> int:
    """The largest absolute value; exact, for the least long has no positive twin."""
    return max(-int(x.min()), int(x.max()), 0) if x.size else 0


def number_kind(size: int):
    """A type in which sums up to this size are exact: doubles, longs, or Python's integers."""
    return np.float64 if size < 1 << 52 else np.int64 if size < 1 << 62 else object


class Splits:
    """Top splits of a tree: rows with x[axis] <= cut go left."""

    def __init__(self, x: np.ndarray, leaves: int):
        self.axis, self.cut, self.kids, self.leaf = [], [], [], []
        self.leaves = 0
        todo = [(x, leaves, -1, 0)]
        while todo:
            here, n, parent, side = todo.pop()
            me = len(self.axis)
            if parent >= 0:
                self.kids[parent][side] = me
            axis, cut = -1, 0
            if n > 1 and len(here) > 1:
                spread = here.max(0).astype(np.float64) - here.min(0)
                axis = int(spread.argmax())
                values = np.sort(here[:, axis])
                cut = int(values[min(len(values) - 2, max(0, len(values) * (n // 2) // n - 1))])
                if cut == values[-1]:  # the upper half ties: cut below it, if anything is there
                    lower = values[values < cut]
                    axis, cut = (axis, int(lower[-1])) if len(lower) else (-1, 0)
            self.axis.append(axis)
            self.cut.append(cut)
            self.kids.append([-1, -1])
            self.leaf.append(self.leaves if axis < 0 else -1)
            if axis < 0:
                self.leaves += 1
            else:
                low = here[:, axis] <= cut
                todo += [(here[low], n // 2, me, 0), (here[~low], n - n // 2, me, 1)]

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.axis[node] < 0:
                out[rows] = self.leaf[node]
            elif len(rows):
                low = x[rows, self.axis[node]] <= self.cut[node]
                todo += [(self.kids[node][0], rows[low]), (self.kids[node][1], rows[~low])]
        return out


class KdTree:
    """Over integer vectors; scores are exact integers."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.arange(len(x))
        self.lo, self.hi, self.kids, self.span = [], [], [], []
        todo = [(0, len(x), -1, 0)]
        while todo:
            a, z, parent, side = todo.pop()
            here, me = x[order[a:z]], len(self.lo)
            lo, hi = here.min(0), here.max(0)
            self.lo.append(lo)
            self.hi.append(hi)
            self.span.append((a, z))
            self.kids.append([-1, -1])
            if parent >= 0:
                self.kids[parent][side] = me
            if z - a > LEAF and (hi > lo).any():
                mid = (z - a) // 2
                order[a:z] = order[a:z][np.argpartition(here[:, int((hi - lo).argmax())], mid)]
                todo += [(a, a + mid, me, 0), (a + mid, z, me, 1)]
        self.ids, x = ids[order], x[order]
        self.limit = largest(x) * max(x.shape[1], 1)
        self._held = {np.int64: (x, np.array(self.lo, np.int64), np.array(self.hi, np.int64))}

    def _as(self, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows and boxes as numbers of a kind."""
        if kind not in self._held:
            self._held[kind] = tuple(a.astype(kind) for a in self._held[np.int64])
        return self._held[kind]

    def search(self, own: int, q: np.ndarray, k: int, floor: int) -> list[tuple[int, int]]:
        """(score, id) of the k best rows, of other ids than `own`, that score at least `floor`; ties
        to smaller ids."""
        kind = number_kind(self.limit * largest(q))
        q = q.astype(kind)
        x, lo, hi = self._as(kind)
        bound = hi @ np.maximum(q, 0) + lo @ np.minimum(q, 0)
        heap, best = [(-bound[0], 0)], []  # best: a heap of (score, -id), worst first
        while heap:
            b, node = heapq.heappop(heap)
            if -b < floor:
                break
            left, right = self.kids[node]
            if left >= 0:
                heapq.heappush(heap, (-bound[left], left))
                heapq.heappush(heap, (-bound[right], right))
                continue
            a, z = self.span[node]
            scores = x[a:z] @ q
            for i in np.flatnonzero(scores >= floor).tolist():
                row = (int(scores[i]), -int(self.ids[a + i]))
                if row[1] == -own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, row)
                elif row > best[0]:
                    heapq.heapreplace(best, row)
                if len(best) == k:
                    floor = max(floor, best[0][0])
        return [(s, -i) for s, i in sorted(best, reverse=True)]


_NONE = -(1 << 63)


def _boxes(sharded: DataFrame, wide: int) -> list[tuple[int, int, list[int], list[int]]]:
    """(shard, rows, least, largest) of each shard, at most one row for each on the driver."""
    kind = "shard int, n long, lo array<long>, hi array<long>"

    def merge(found: dict, shard: int, n: int, lo: np.ndarray, hi: np.ndarray) -> None:
        old = found.get(shard)
        found[shard] = (n, lo, hi) if old is None else (n + old[0], np.minimum(lo, old[1]), np.maximum(hi, old[2]))

    def out(found: dict) -> pa.RecordBatch:
        ids = sorted(found)
        side = lambda k: rows_of(np.array([found[i][k] for i in ids], np.int64).reshape(len(ids), wide))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array([found[i][0] for i in ids], pa.int64()), side(1), side(2)], names=["shard", "n", "lo", "hi"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for b in batches:
            x, shards = matrix(b.column(1)), b.column(0).to_numpy(zero_copy_only=False)
            for k in np.unique(shards):
                mine = x[shards == k]
                merge(found, int(k), len(mine), mine.min(0), mine.max(0))
        yield out(found)

    def all_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for b in batches:
            lo, hi = matrix(b.column(2)), matrix(b.column(3))
            for k, (shard, n) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                merge(found, shard, n, lo[k], hi[k])
        yield out(found)

    parts = sharded.select("shard", "v").mapInArrow(each, kind)
    return sorted(tuple(r) for r in parts.repartition("shard").mapInArrow(all_of, kind).collect())


def search(df: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", nearest: int = NEAREST, scale: int = 256, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that `is_query` (a condition on vec_id) chooses
    the rows of the highest integer inner products of floor(scale * x), ties to the smaller id.

    Vectors that are null, empty, or hold null or non-finite components take no part, nor do rows
    without id or of another length than most; zero vectors do. A component whose integer doesn't fit a
    long, or a score of a result that doesn't, is an error; all sums before are exact at any size. Rows
    of the query's own id are no candidates. With fewer candidates than wanted, all are returned; empty
    tables give no rows. `shard_rows` changes no result.
    """
    spark = df.sparkSession
    whole = f"transform(embedding, x -> if(abs({int(scale)}D * x) < 9223372036854775807D, cast(floor({int(scale)}D * x) as long), cast(raise_error('a component is too large for a long') as long)))"
    vectors = materialize(usable(df, id_col, vector_col, zero=True).select("vec_id", F.expr(whole).alias("v")), "kdtree-vectors")
    n = vectors.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    a_shard = max(int(shard_rows), -(-n // MAX_SHARDS))
    drawn = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE if n > a_shard else 1).toArrow()
    splits = spark.sparkContext.broadcast(Splits(matrix(drawn.column("v").combine_chunks()), -(-n // a_shard)))
    wide = len(drawn.column("v")[0])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(splits.value.place(matrix(b.column(1))))], names=["vec_id", "v", "shard"])

    sharded = vectors.mapInArrow(place, "vec_id long, v array<long>, shard int")
    boxes = _boxes(sharded, wide)
    held = spark.sparkContext.broadcast((np.array([b[0] for b in boxes], np.int32), np.array([-(-b[1] // a_shard) for b in boxes]), np.array([b[2] for b in boxes], np.int64), np.array([b[3] for b in boxes], np.int64)))
    pieces = [1] * (max(b[0] for b in boxes) + 1)
    for b in boxes:
        pieces[b[0]] = -(-b[1] // a_shard)
    piece = F.pmod(F.xxhash64("vec_id"), F.array(*map(F.lit, pieces))[F.col("shard")]).cast("int") if max(pieces) > 1 else F.lit(0)
    members = sharded.select("shard", piece.alias("piece"), F.lit(False).alias("ask"), "vec_id", "v", F.lit(_NONE).alias("floor"))

    def route(first: bool):
        """First to one piece of the shard of the best bound, then to all others whose bound reaches the floor."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, parts, lo, hi = held.value
            limit = max(largest(lo), largest(hi)) * max(lo.shape[1], 1)
            for b in batches:
                x, floors = matrix(b.column(1)), b.column(2).to_numpy(zero_copy_only=False)
                for at in range(0, len(x), _AT_ONCE):
                    q = x[at : at + _AT_ONCE]
                    kind = number_kind(limit * largest(q))
                    bound = np.maximum(q, 0).astype(kind) @ hi.T.astype(kind) + np.minimum(q, 0).astype(kind) @ lo.T.astype(kind)
                    src, to, which = [], [], []
                    for i, (best, floor) in enumerate(zip(bound, floors[at : at + _AT_ONCE].tolist(), strict=True)):
                        home = int(np.argmax(best))
                        for k in [home] if first else np.flatnonzero(best >= floor).tolist():
                            some = range(1) if first else range(1 if k == home else 0, int(parts[k]))
                            src += [at + i] * len(some)
                            to += [int(ids[k])] * len(some)
                            which += some
                    take = pa.array(src, pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(which, pa.int32()), pa.array(np.ones(len(src), bool)), b.column(0).take(take), rows_of(x[src].reshape(len(src), wide)), b.column(2).take(take)], names=["shard", "piece", "ask", "vec_id", "v", "floor"])

        return run

    def visit(queries: DataFrame, first: bool) -> DataFrame:
        asked = queries.mapInArrow(route(first), "shard int, piece int, ask boolean, vec_id long, v array<long>, floor long")
        met = members.unionByName(asked).repartition("shard", "piece").sortWithinPartitions("shard", "piece", "ask")
        return met.mapInArrow(run, "query_id long, vec_id long, score long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, gathered, tree = None, [], None
        for b in batches:
            shards, parts, asks, ids = (b.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            x, floors = matrix(b.column(4)), b.column(5).to_numpy(zero_copy_only=False)
            rows: list[tuple[int, int, int]] = []
            turn = np.flatnonzero(np.concatenate([[True], (shards[1:] != shards[:-1]) | (parts[1:] != parts[:-1]) | (asks[1:] != asks[:-1])])) if len(ids) else []
            for a, z in zip(turn, [*turn[1:], len(ids)], strict=True):
                if (shards[a], parts[a]) != at:
                    at, gathered, tree = (shards[a], parts[a]), [], None
                if not asks[a]:
                    gathered.append((ids[a:z], x[a:z]))
                    continue
                if tree is None:
                    if not gathered:
                        continue
                    tree = KdTree(*(np.concatenate(p) for p in zip(*gathered, strict=True)))
                for i in range(a, z):
                    rows += [(int(ids[i]), v, s) for s, v in tree.search(int(ids[i]), x[i], nearest, int(floors[i]))]
            if any(not -(1 << 63) <= r[2] < 1 << 63 for r in rows):
                raise OverflowError("a score is too large for a long")
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["query_id", "vec_id", "score"])

    queries = vectors.where(is_query(F.col("vec_id")))
    home = materialize(visit(queries.withColumn("floor", F.lit(_NONE)), True), "kdtree-home")
    kth = home.groupBy("query_id").agg(F.when(F.count("*") >= nearest, F.min("score")).alias("kth"))
    floors = queries.join(kth.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").select("vec_id", "v", F.coalesce("kth", F.lit(_NONE)).alias("floor"))
    found = home.unionByName(visit(floors, False)) if len(boxes) > 1 or max(pieces) > 1 else home
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def op10_topk_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)


ORACLE = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) v from embeddings
           where embedding is not null and len(embedding) > 0 and vec_id is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id query_id, c.vec_id, list_dot_product(q.v::double[], c.v::double[])::bigint score
      from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from s)
select query_id, rank::int rank, vec_id, score from r where rank <= 5
"""
