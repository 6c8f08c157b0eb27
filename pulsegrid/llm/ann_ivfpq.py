"""Approximate nearest neighbours by inner product: inverted file with product-quantised residuals.

A bounded sample fits the coarse centroids and the codebooks of the residuals. A sample of the queries
themselves, held against it, says how many lists a query must look into to reach the wanted recall, and
how far codes may be off before a row is left out. Every row is indexed: its list and its code. Lists
of near centroids lie together in a cell of about BLOCK rows, and a cell that holds more is cut into
blocks by a hash, so hot lists are spread. A query goes once to each block of the cells of its
lists, with the numbers of those lists; there asymmetric distance tables score their codes, the best
and all that tie with the last of them are scored again on the original vectors, then all whose code
leaves them room to reach the nearest of these, and the best of those of all blocks are the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table
from .vectors import matrix, rows_of, usable

NEAREST = 20
#: Lists for each square root of the rows, and the most of them.
LISTS_A_ROOT, MOST_LISTS = 2, 4096
#: Rows that centroids and codebooks are fitted on, chosen by a hash of the id: so many for each list,
#: between these bounds.
SAMPLE_A_LIST, LEAST_SAMPLE, MOST_SAMPLE = 16, 16_384, 65_536
#: The longest vectors, which are in the sample too: few rows that are near to almost every query.
LONGEST = 1024
#: Parts that a residual is cut into, and centroids of each.
PARTS, CODES = 16, 256
#: Share of the true neighbours, within the sample, that the probed lists must hold, and share of these
#: that must be scored again.
RECALL, RESCORED = 0.97, 0.99
#: Queries that those shares are measured on: so many as they come, and as many from all lists alike, so
#: that a crowd of queries that are alike doesn't speak for the others; and those that they are chosen from.
ASKED, MOST_ASKED = 256, 4096
#: Rows of a block, and rows of it at least that are scored again for a query.
BLOCK, RERANK = 4096, 100


def kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    k = max(1, min(k, len(x)))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        a = (x @ c.T - 0.5 * (c * c).sum(1)).argmax(1)
        n = np.bincount(a, minlength=k)
        s = np.zeros_like(c)
        np.add.at(s, a, x)
        c = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], x[rng.integers(len(x), size=k)])
    return c


@dataclass
class IvfPq:
    centroids: np.ndarray
    cuts: list[int]  # where the parts begin
    books: list[np.ndarray]
    probes: int
    cells: np.ndarray  # of each list
    #: How far a product by the code may be below the true one, as a share of the most it can be: the
    #: query's length times the distance of the row from what its code stands for.
    reach: float = 1.0

    def lists(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.centroids.T - 0.5 * (self.centroids**2).sum(1)).argmax(1)

    def codes(self, x: np.ndarray, lists: np.ndarray) -> np.ndarray:
        r = x - self.centroids[lists]
        parts = [r[:, a:b] for a, b in zip(self.cuts[:-1], self.cuts[1:], strict=True)]
        return np.stack([(p @ c.T - 0.5 * (c * c).sum(1)).argmax(1) for p, c in zip(parts, self.books, strict=True)], 1).astype(np.uint8)

    def decoded(self, lists: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What lists and codes (a row for each part) stand for."""
        return self.centroids[lists] + np.concatenate([c[k] for c, k in zip(self.books, codes, strict=True)], 1)

    def tables(self, q: np.ndarray) -> list[np.ndarray]:
        """Inner products of queries' parts with the codebooks: of each part, a row for each query."""
        return [q[:, a:b] @ c.T for a, b, c in zip(self.cuts[:-1], self.cuts[1:], self.books, strict=True)]


def lists_for(rows: int) -> int:
    return max(1, min(MOST_LISTS, int(LISTS_A_ROOT * math.sqrt(rows))))


def sample_for(rows: int) -> int:
    return min(MOST_SAMPLE, max(LEAST_SAMPLE, SAMPLE_A_LIST * lists_for(rows)))


def fit(x: np.ndarray, rows: int, nearest: int = NEAREST, block: int = BLOCK, seed: int = 5, ids: np.ndarray | None = None, asked: tuple[np.ndarray, np.ndarray] | None = None) -> IvfPq:
    """On a sample `x` of a table of `rows` vectors and their `ids`, and a sample of the queries: their ids
    and vectors. Without these the rows themselves are asked for."""
    rng = np.random.default_rng(seed)
    centroids = kmeans(x, min(lists_for(rows), max(1, len(x) // 8)), 8, rng)
    cuts = [0, *np.cumsum([len(p) for p in np.array_split(np.arange(x.shape[1]), min(PARTS, x.shape[1]))]).tolist()]
    middles = kmeans(centroids, max(1, min(-(-rows // block), len(centroids) // 4)), 8, rng)
    cells = (centroids @ middles.T - 0.5 * (middles**2).sum(1)).argmax(1)
    model = IvfPq(centroids, cuts, [], len(centroids), cells)
    lists = model.lists(x)
    r = x - centroids[lists]
    model.books = [kmeans(r[:, a:b], CODES, 6, rng) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    ids = np.arange(len(x)) if ids is None else ids
    own, queries = asked or (ids, x)
    k = min(nearest, len(x) - 1)
    if k > 0 and len(own):
        coded = model.decoded(lists, model.codes(x, lists).T)
        off = np.linalg.norm(x - coded, axis=1)
        measured = [needed(model, x, ids, lists, coded, off, own[some], queries[some], k) for some in both_ways(model.lists(queries), rng)]
        model.probes = max(int(share(ranks, RECALL)) + 1 for ranks, _ in measured)
        model.reach = min(1.0, max(float(share(below, RESCORED)) for _, below in measured))
    return model


def share(values: np.ndarray, part: float) -> float:
    """The least of the values that so large a part of them don't exceed."""
    return np.sort(values)[max(0, math.ceil(part * len(values)) - 1)]


def both_ways(lists: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """ASKED queries as they come, and as many from all of their lists alike."""
    mixed = rng.permutation(len(lists))
    order = mixed[np.argsort(lists[mixed], kind="stable")]
    turn = np.arange(len(order)) - np.searchsorted(lists[order], lists[order])  # of a query, within its list
    return mixed[:ASKED], order[np.lexsort((rng.random(len(order)), turn))][:ASKED]


def needed(model: IvfPq, x: np.ndarray, ids: np.ndarray, lists: np.ndarray, coded: np.ndarray, off: np.ndarray, own: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each query's true `k` nearest in the sample: the place of their lists among those that the query
    looks into, and the reach by which their codes fall short of the last one's product."""
    ranks, below = [], []
    for at in range(0, len(own), 32):  # so many rows of products at once
        q = queries[at : at + 32]
        scores = q @ x.T
        scores[own[at : at + 32, None] == ids] = -np.inf
        best = np.argpartition(scores, -k, axis=1)[:, -k:]
        least = np.take_along_axis(scores, best, 1).min(1)
        place = np.argsort(np.argsort(-(q @ model.centroids.T), axis=1, kind="stable"), axis=1)
        ranks.append(np.take_along_axis(place, lists[best], 1).ravel())
        most = np.linalg.norm(q, axis=1)[:, None] * off[best]
        short = least[:, None] - np.einsum("qd,qkd->qk", q, coded[best])
        below.append(np.divide(short, most, out=np.zeros_like(short), where=most > 0).ravel())
    return np.concatenate(ranks), np.maximum(np.concatenate(below), 0)


def best_codes(near: np.ndarray, n: int) -> np.ndarray:
    """The rows of the n largest approximate scores, and all that tie with the least of them: equal
    vectors have equal codes, so which of them come first is for the exact scores and ids to say."""
    if len(near) <= n:
        return np.arange(len(near))
    least = np.partition(near, -n)[-n]
    return np.flatnonzero(near >= least - 1e-9 * abs(least))  # sums of equal parts may differ by rounding


def worth(rows: np.ndarray, near: np.ndarray, room: np.ndarray, vectors: np.ndarray, v: np.ndarray, n: int, nearest: int) -> np.ndarray:
    """The rows to score again: the `n` best by their codes, and all that the `room` above their approximate
    scores may take to the last of the `nearest` of those or beyond."""
    first = best_codes(near, n)
    if len(first) == len(near):
        return rows
    least = np.partition(vectors[rows[first]] @ v, -nearest)[-nearest]
    chosen = near + room >= least - 1e-9 * abs(least)
    chosen[first] = True
    return rows[chosen]


def by_list(own: np.ndarray, vectors: np.ndarray, code: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, ...]:
    """A block's rows in the order of their lists, the codes by part."""
    order = np.argsort(lists, kind="stable")
    return own[order], vectors[order], np.ascontiguousarray(code[order].T).astype(np.intp), lists[order]


def rows_in(lists: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where the wanted lists' rows are, in a block in the order of lists: only those are looked at."""
    start, end = np.searchsorted(lists, wanted), np.searchsorted(lists, wanted, "right")
    size = end - start
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


def probed(model: IvfPq, queries: np.ndarray, sizes: np.ndarray, nearest: int, probes: int | None) -> list[np.ndarray]:
    """The lists that each query looks into: the best ones, and more until they hold enough candidates."""
    order = np.argsort(-(queries @ model.centroids.T), axis=1, kind="stable")
    held = np.cumsum(sizes[order], axis=1)
    n = np.maximum(model.probes if probes is None else probes, (held < nearest + 1).sum(1) + 1)
    return [o[:k] for o, k in zip(order, n.tolist(), strict=True)]


def search(df: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", nearest: int = NEAREST, probes: int | None = None, rerank: int | None = RERANK, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found for every row that `is_query` (a condition on
    vec_id) chooses, by inner product, ties to the smaller id.

    Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do
    rows without id or of another length than most. Rows of the query's own id are no candidates. A
    query looks into more lists until they hold enough candidates. Empty tables give no rows. `probes`
    sets the lists to look into (0 or less: all), `rerank` the least rows of a block that are scored again
    (None: all); with all of both the result is exact. `block` changes how rows are dealt.
    """
    spark = df.sparkSession
    vectors = usable(df, id_col, vector_col, zero=False)
    n = vectors.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def sample(rows: DataFrame, most: int, *first) -> tuple[np.ndarray, np.ndarray]:
        drawn = rows.orderBy(*first, F.xxhash64("vec_id"), "vec_id").limit(most).toArrow()
        return drawn.column("vec_id").to_numpy(), matrix(drawn.column("embedding").combine_chunks())

    longest = F.aggregate("embedding", F.lit(0.0), lambda total, c: total + c * c).desc()
    ids, x = (np.concatenate(two) for two in zip(sample(vectors, sample_for(n)), sample(vectors, LONGEST, longest), strict=True))
    ids, own = np.unique(ids, return_index=True)
    model = fit(x[own], n, nearest, block, ids=ids, asked=sample(vectors.where(is_query(F.col("vec_id"))), MOST_ASKED))
    if probes is not None and probes <= 0:
        probes = len(model.centroids)

    sent = spark.sparkContext.broadcast(model)  # a bounded number of centroids

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            x = matrix(b.column(1))
            if len(x):
                lists = m.lists(x)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lists.astype(np.int32)), pa.array(m.cells[lists].astype(np.int32)), pa.array([c.tobytes() for c in m.codes(x, lists)], pa.binary())], names=["vec_id", "embedding", "list", "cell", "code"])

    indexed = materialize(vectors.mapInArrow(index, "vec_id long, embedding array<double>, list int, cell int, code binary"), "ann-index")
    sizes = np.zeros(len(model.centroids), np.int64)
    for r in indexed.groupBy("list").count().collect():  # one row for each list
        sizes[r["list"]] = r["count"]
    n_cells = int(model.cells.max()) + 1
    blocks = -(-np.bincount(model.cells, sizes, n_cells).astype(np.int64) // block)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            x = matrix(b.column(1))
            for at in range(0, len(x), 256):
                part = x[at : at + 256]
                src, cells, block_, wanted = [], [], [], []
                for i, lists in enumerate(probed(m, part, sizes, nearest, probes)):
                    lists = lists[sizes[lists] > 0]
                    own = m.cells[lists]
                    for c in np.unique(own).tolist():
                        some = np.sort(lists[own == c]).tolist()
                        for j in range(int(blocks[c])):
                            src.append(at + i)
                            cells.append(c)
                            block_.append(j)
                            wanted.append(some)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(src, pa.int64())), rows_of(x[src]), pa.array(cells, pa.int32()), pa.array(block_, pa.int32()), pa.array(wanted, pa.list_(pa.int32()))], names=["vec_id", "embedding", "cell", "block", "wanted"])

    per_cell = F.array(*[F.lit(int(x)) for x in blocks])
    members = indexed.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.greatest(per_cell[F.col("cell")], F.lit(1))).cast("int"))
    queries = vectors.where(is_query(F.col("vec_id"))).mapInArrow(ask, "vec_id long, embedding array<double>, cell int, block int, wanted array<int>")
    members = members.select("cell", "block", F.lit(False).alias("ask"), "vec_id", "embedding", "code", F.array("list").alias("wanted"))
    both = members.unionByName(queries.select("cell", "block", F.lit(True).alias("ask"), "vec_id", "embedding", F.lit(None).cast("binary").alias("code"), "wanted"))
    met = both.repartition("cell", "block").sortWithinPartitions("cell", "block", "ask")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        at, gathered, held, off = None, [], None, None
        for b in batches:
            cells, parts, asks, ids = (b.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            x, codes, wanted = matrix(b.column(4)), b.column(5), b.column(6)
            out_q, out_v, out_s = [], [], []
            # runs of one block and one kind
            turn = np.flatnonzero(np.concatenate([[True], (cells[1:] != cells[:-1]) | (parts[1:] != parts[:-1]) | (asks[1:] != asks[:-1])])) if len(ids) else []
            for a, z in zip(turn, [*turn[1:], len(ids)], strict=True):
                key = (int(cells[a]), int(parts[a]))
                if key != at:
                    at, gathered, held = key, [], None
                if not asks[a]:
                    gathered.append((ids[a:z], x[a:z], np.frombuffer(b"".join(codes.slice(a, z - a).to_pylist()), np.uint8).reshape(z - a, -1), wanted.slice(a, z - a).flatten().to_numpy()))
                    continue
                if held is None:
                    if not gathered:
                        continue
                    held = by_list(*(np.concatenate(p) for p in zip(*gathered, strict=True)))
                    off = m.reach * np.linalg.norm(held[1] - m.decoded(held[3], held[2]), axis=1)
                own, vectors_, code, lists = held
                shares, tables = x[a:z] @ m.centroids.T, m.tables(x[a:z])
                for k, (q, v) in enumerate(zip(ids[a:z].tolist(), x[a:z], strict=True)):
                    rows = rows_in(lists, wanted[int(a) + k].values.to_numpy())
                    rows = rows[own[rows] != q]
                    if not len(rows):
                        continue
                    if rerank is not None:
                        # of a row: its list's share of the product, and its residual's by the tables
                        near = shares[k].take(lists.take(rows))
                        for t, c in zip(tables, code.take(rows, axis=1), strict=True):
                            near += t[k].take(c)
                        rows = worth(rows, near, off.take(rows) * math.sqrt(v @ v), vectors_, v, max(rerank, nearest), nearest)
                    exact = (vectors_[rows] * v).sum(1)  # each row's sum in the same order: equal rows tie
                    first = np.lexsort((own[rows], -exact))[:nearest]
                    out_q += [q] * len(first)
                    out_v.append(own[rows][first])
                    out_s.append(exact[first])
            yield pa.RecordBatch.from_arrays([pa.array(out_q, pa.int64()), pa.array(np.concatenate(out_v) if out_v else [], pa.int64()), pa.array(np.concatenate(out_s) if out_s else [], pa.float64())], names=["query_id", "vec_id", "score"])

    found = met.mapInArrow(score, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def op2_ann_ivfpq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)
