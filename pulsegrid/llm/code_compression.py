"""Vector codes by product quantisation, its codebooks fitted to all vectors by filtering Lloyd rounds.

Vectors become integers and are cut into PARTS consecutive parts. Once, every partition gathers its
vectors into chunks and builds a kd-tree over each part of a chunk, whose nodes keep the sum, the number
and the bounding box of their parts; the trees are a written table. A round sends the codebooks down the
trees: at a node, entries that another one beats over the whole box are left out, and where one entry is
left the node's parts are its own at once, by the cached sum and number. Only sums and numbers by entry
leave a task. All arithmetic is in exact integers, so the result is the one of plain Lloyd rounds, whatever
the chunks.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dealt_anew, materialize, table
from .vectors import matrix, usable

PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Components are floor(SCALE * x).
SCALE = 1024
#: Vectors of a chunk, and parts of a leaf.
CHUNK, LEAF = 8192, 32


def integers(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x). An error where squared distances would not fit a long."""
    y = np.floor(x * SCALE)
    limit = np.sqrt(float(1 << 60) / max(1, x.shape[1])) / 2
    if len(y) and np.abs(y).max() > limit:
        raise ValueError(f"components beyond {limit / SCALE:.3g} make squared distances that do not fit a long")
    return y.astype(np.int64)


def _packed(**arrays: np.ndarray) -> bytes:
    """Arrays as bytes, each as small as its values allow."""
    kinds = (np.int16, np.int32)
    out = io.BytesIO()
    fits = lambda a: next((k for k in kinds if not a.size or np.iinfo(k).min <= a.min() and a.max() <= np.iinfo(k).max), np.int64)
    np.savez(out, **{k: a.astype(fits(a)) for k, a in arrays.items()})
    return out.getvalue()


class Tree:
    """A kd-tree over the integer parts of one chunk; nodes keep their box, sum and number."""

    def __init__(self, x: np.ndarray, order: np.ndarray, span: np.ndarray, kids: np.ndarray, lo: np.ndarray, hi: np.ndarray, total: np.ndarray):
        self.x, self.order, self.span, self.kids, self.lo, self.hi, self.total = x, order, span, kids, lo, hi, total

    @classmethod
    def build(cls, x: np.ndarray, leaf: int = LEAF) -> Tree:
        order = np.arange(len(x))
        span, kids, lo, hi, total = [], [], [], [], []
        todo = [(0, len(x), -1, 0)]
        while todo:
            a, z, parent, side = todo.pop()
            here, me = x[order[a:z]], len(span)
            span.append((a, z))
            kids.append([-1, -1])
            lo.append(here.min(0))
            hi.append(here.max(0))
            total.append(here.sum(0))
            if parent >= 0:
                kids[parent][side] = me
            widest = int((hi[-1] - lo[-1]).argmax())
            if z - a > leaf and hi[-1][widest] > lo[-1][widest]:  # copies need no splitting
                mid = (z - a) // 2
                order[a:z] = order[a:z][np.argpartition(here[:, widest], mid)]
                todo += [(a, a + mid, me, 0), (a + mid, z, me, 1)]
        return cls(x[order], order, *(np.array(v) for v in (span, kids, lo, hi, total)))

    def to_bytes(self) -> bytes:
        return _packed(x=self.x, order=self.order, span=self.span, kids=self.kids, lo=self.lo, hi=self.hi, total=self.total)

    @classmethod
    def from_bytes(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as held:
            return cls(**{k: held[k].astype(np.int64) for k in held.files})

    def assign(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest entry of each part (in the tree's order; ties to the lower one), and the number and
        sum of each entry's parts."""
        largest = max(np.abs(self.x).max(initial=0), np.abs(book).max(initial=0))
        kind = np.float64 if 8 * book.shape[1] * int(largest) ** 2 < 1 << 52 else np.int64  # both exact
        book_, x, lo, hi = (a.astype(kind) for a in (book, self.x, self.lo, self.hi))
        squares = (book_**2).sum(1)
        owner = np.zeros(len(x), np.int64)
        number, total = np.zeros(len(book), np.int64), np.zeros(book.shape, np.int64)
        todo = [(0, np.arange(len(book)))]
        while todo:
            node, z = todo.pop()
            (a, b), (left, right) = self.span[node], self.kids[node]
            if len(z) > 1:
                c = book_[z]
                best = int(((2 * c - (lo[node] + hi[node])) ** 2).sum(1).argmin())
                corner = np.where(c > c[best], hi[node], lo[node])  # where an entry is at its best against that one
                theirs, its = ((c - corner) ** 2).sum(1), ((c[best] - corner) ** 2).sum(1)
                z = z[(theirs < its) | (theirs == its) & (z <= z[best])]
            if len(z) == 1:
                owner[a:b] = z[0]
                number[z[0]] += b - a
                total[z[0]] += self.total[node]
            elif left < 0:
                near = z[(squares[z] - 2 * (x[a:b] @ book_[z].T)).argmin(1)]
                owner[a:b] = near
                np.add.at(number, near, 1)
                np.add.at(total, near, self.x[a:b])
            else:
                todo += [(left, z), (right, z)]
        return owner, number, total


def planted(rows: DataFrame, parts: int = PARTS, chunk: int = CHUNK, leaf: int = LEAF) -> DataFrame:
    """(ids, labels, trees): chunks of (vec_id, embedding, label) with a tree for each part, written."""

    def grow(ids: list[np.ndarray], labels: list[pa.Array], xs: list[np.ndarray]) -> pa.RecordBatch:
        x = np.concatenate(xs)
        trees = [Tree.build(p, leaf).to_bytes() for p in np.split(x, parts, axis=1)]
        own = pa.array([np.concatenate(ids)], pa.list_(pa.int64()))
        named = pa.concat_arrays(labels)
        return pa.RecordBatch.from_arrays([own, pa.ListArray.from_arrays(pa.array([0, len(named)], pa.int32()), named), pa.array([trees], pa.list_(pa.binary()))], names=["ids", "labels", "trees"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, xs, size = [], [], [], 0
        for b in batches:
            for at in range(0, b.num_rows, chunk):
                part = b.slice(at, chunk)
                if size and size + part.num_rows > chunk:
                    yield grow(ids, labels, xs)
                    ids, labels, xs, size = [], [], [], 0
                ids.append(part.column(0).to_numpy())
                labels.append(part.column(2))
                xs.append(integers(matrix(part.column(1))))
                size += part.num_rows
        if size:
            yield grow(ids, labels, xs)

    return materialize(rows.mapInArrow(run, "ids array<long>, labels array<string>, trees array<binary>"), "codes-trees")


def _round(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one more round."""
    parts, entries, d = books.shape
    sums = [f"s{k}" for k in range(d)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, total = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for b in batches:
            for held in b.column(0):
                for p, data in enumerate(held):
                    _, n, s = Tree.from_bytes(data.as_py()).assign(books[p])
                    number[p] += n
                    total[p] += s
        p, e = np.nonzero(number)
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in (p, e, number[p, e], *total[p, e].T)], names=["part", "entry", "n", *sums])

    found = trees.select("trees").mapInArrow(run, f"part long, entry long, n long, {', '.join(f'{s} long' for s in sums)}")
    new = books.copy()
    for r in found.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *sums)]).collect():  # a row for each entry at most
        new[r[0], r[1]] = np.array(r[3:], np.int64) // r[2]
    return new


def codebooks(rows: DataFrame, trees: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """(parts, entries, components): the parts of the vectors of the smallest ids, after `rounds` rounds.
    Fewer vectors than entries make as many entries; rows that repeat an id are ordered by their vectors."""
    first = rows.select("vec_id", "embedding").orderBy("vec_id", "embedding").limit(entries).collect()
    x = integers(np.array([r.embedding for r in first]).reshape(len(first), -1))
    books = np.stack(np.split(x, parts, axis=1))
    for _ in range(rounds):
        books = _round(trees, books)
    return books


def codes(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every vector: its entries' indexes as hexadecimal digits, and the
    squared distances to them, added up."""
    parts, entries, _ = books.shape
    digits = max(2, len(f"{entries - 1:x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, labels, held in zip(*(b.column(k) for k in range(3)), strict=True):
                n = len(ids.values)
                code, error = np.zeros((n, parts), np.int64), np.zeros(n, np.int64)
                for p, data in enumerate(held):
                    tree = Tree.from_bytes(data.as_py())
                    near = tree.assign(books[p])[0]
                    code[tree.order, p] = near
                    error[tree.order] += ((tree.x - books[p][near]) ** 2).sum(1)
                text = ["".join(f"{e:0{digits}x}" for e in c) for c in code.tolist()]
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, pa.array(text, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return trees.mapInArrow(run, "vec_id long, label string, code string, error long")


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, chunk: int = CHUNK, leaf: int = LEAF) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error, label_error) of every vector that takes part, and the codebooks.
    label_error is the error added up over equal labels, nulls together.

    Vectors without id, empty, null, or with a null or non-finite component take no part, nor do those of
    a less common length; zero vectors do. The length must be a multiple of `parts`. Equal vectors have
    equal codes; rows that repeat are coded each. An empty table has no codebooks and gives no rows.
    """
    rows = materialize(usable(df, id_col, vector_col, zero=True, label=label_col).withColumn("label", F.col("label").cast("string")), "codes-rows")
    one = rows.first()
    if one is None:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error")), np.zeros((parts, 0, 0), np.int64)
    if len(one["embedding"]) % parts:
        raise ValueError(f"vectors of {len(one['embedding'])} components cannot be cut into {parts} equal parts")
    trees = planted(rows, parts, chunk, leaf)
    books = codebooks(rows, trees, parts, entries, rounds)
    coded = materialize(codes(trees, books).withColumn("_label", F.xxhash64("label")), "codes-coded")
    # one label may have most rows: its total is dealt out for a join of two plain exchanges, which can be split
    total = coded.groupBy("_label", F.col("label").alias("_own")).agg(F.sum("error").alias("label_error"))
    out = coded.join(dealt_anew(total, "_label"), "_label").where(F.col("label").eqNullSafe(F.col("_own")))
    return out.select("vec_id", "label", "code", "error", "label_error"), books


def digest(books: np.ndarray) -> str:
    """Hash of all components in the order of parts, entries and positions."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def op12_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _oracle() -> str:
    """Plain Lloyd rounds in DuckDB's SQL: every part against every entry. For vec_ids that don't repeat and
    vectors of one length; doubles are exact here, since all numbers are small."""
    steps = [
        f"""kept as (select vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::double)) x from embeddings where embedding is not null and vec_id is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"""pieces as materialized (select vec_id, p, x[p * (len(x) // {PARTS}) + 1:(p + 1) * (len(x) // {PARTS})] v from kept, range({PARTS}) t(p))""",
        f"""first_ as (select vec_id, row_number() over (order by vec_id) - 1 e from kept qualify e < {ENTRIES})""",
        """b0 as materialized (select p, e, v c from pieces join first_ using (vec_id))""",
    ]
    near = "list_inner_product(c, c) - 2 * list_inner_product(v, c) + list_inner_product(v, v)"
    for k in range(ROUNDS + 1):
        steps.append(f"a{k} as materialized (select vec_id, p, arg_min(e, ({near})::bigint * {ENTRIES} + e) e, min({near})::bigint d from pieces join b{k} using (p) group by 1, 2)")
        if k < ROUNDS:
            steps += [
                f"m{k} as (select p, e, i, floor(sum(v[i]) / count(*)) c from pieces join a{k} using (vec_id, p), unnest(range(1, len(v) + 1)) t(i) group by 1, 2, 3)",
                f"n{k} as (select p, e, list(c order by i) c from m{k} group by 1, 2)",
                f"b{k + 1} as materialized (select p, e, coalesce(n.c, b.c) c from b{k} b left join n{k} n using (p, e))",
            ]
    steps += [
        f"coded as (select vec_id, string_agg(printf('%02x', e), '' order by p) code, sum(d)::bigint error from a{ROUNDS} group by 1)",
        f"book as (select sha256(string_agg(array_to_string(list_transform(c, lambda y: y::bigint::varchar), ','), ',' order by p, e)) h from b{ROUNDS})",
    ]
    return f"""with {", ".join(steps)}
select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error, h codebooks_sha256 from coded join kept using (vec_id), book"""


ORACLE = _oracle()
