"""Sharding by minimax contiguous partition.

Rows are put in the order of a hash of their text, so equal texts form one atomic group of
neighbours. The smallest capacity is sought for which greedy filling, shard after shard and
group after group, needs no more shards than there are; then the order is cut there. The search
looks at many capacities at once: the greedy step of all of them, "the last group boundary within
reach", is one small distributed lookup that reads only the partitions it points to, so nothing
but a bounded number of positions comes to the driver, whatever the number or size of groups.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Numbered, materialize, number_rows, pick, table

SHARDS = 8
#: Capacities tried in one round.
AT_ONCE = 64


class Boundaries:
    """Where groups start in a numbered table with a column `_group`, for lookups by weight."""

    def __init__(self, numbered: Numbered):
        self.numbered, self.parts = numbered, numbered.parts
        self.rows, self.total = numbered.totals()
        ends = {r["_pid"]: r for r in numbered.rows.groupBy("_pid").agg(F.min_by("_group", "_idx").alias("first"), F.max_by("_group", "_idx").alias("last")).collect()}
        opens, last = [], None  # partitions whose first row starts a group
        for p in self.parts:
            if last is None or ends[p[0]]["first"] != last[0]:
                opens.append(p[0])
            last = (ends[p[0]]["last"],)
        self.starts = materialize(self._starts(set(opens)), "sharding-starts")
        self.has = {r["_pid"]: (r["low"], r["idx"], r["top"], r["top_idx"]) for r in self.starts.groupBy("_pid").agg(F.min("_before").alias("low"), F.min("_idx").alias("idx"), F.max("_before").alias("top"), F.max("_idx").alias("top_idx")).collect()}
        self.order = [p for p in self.parts if p[0] in self.has]
        self.begins = [p[4] + self.has[p[0]][0] for p in self.order]

    def _starts(self, opens: set[int]) -> DataFrame:
        """(_pid, _idx, _before) of the rows that start a group, partition by partition."""
        rows = self.numbered.rows.select("_pid", "_group", "_idx", "_before")
        # within a group rows are neighbours, so its first row in a partition has the least place
        firsts = rows.groupBy("_pid", "_group").agg(F.min("_idx").alias("_idx"), F.min("_before").alias("_before"))
        shut = [p[0] for p in self.parts if p[0] not in opens]
        return firsts.where(~((F.col("_idx") == 0) & F.col("_pid").isin(shut)) if shut else F.lit(True)).select("_pid", "_idx", "_before").repartitionByRange(max(1, len(self.parts)), "_pid", "_before")

    def within(self, limits: list[int]) -> list[tuple[int, int]]:
        """For each limit the last boundary, as (weight before it, rows before it), not beyond it.

        The end of all rows is a boundary too."""
        found: dict[int, tuple[int, int]] = {}
        asked: dict[int, list[int]] = {}
        for x in set(limits):
            if x >= self.total:
                found[x] = (self.total, self.rows)
                continue
            p = self.order[bisect_right(self.begins, x) - 1]
            low, idx, top, top_idx = self.has[p[0]]
            if x - p[4] >= top:
                found[x] = (p[4] + top, p[3] + top_idx)
            else:
                asked.setdefault(p[0], []).append(x - p[4])
        if asked:
            ask = {k: np.array(sorted(v)) for k, v in asked.items()}

            def run(batches):
                best: dict[tuple[int, int], tuple[int, int]] = {}
                for b in batches:
                    pid, idx, before = (c.to_numpy(zero_copy_only=False) for c in b.columns)
                    for k in np.unique(pid):
                        mine = np.flatnonzero(pid == k)
                        mine = mine[np.argsort(before[mine])]
                        for x, at in zip(ask[int(k)].tolist(), np.searchsorted(before[mine], ask[int(k)], "right").tolist(), strict=True):
                            if at:
                                got = (int(before[mine[at - 1]]), int(idx[mine[at - 1]]))
                                best[int(k), x] = max(got, best.get((int(k), x), got))
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in best], pa.int32()), pa.array([x for _, x in best], pa.int64()), pa.array([v[0] for v in best.values()], pa.int64()), pa.array([v[1] for v in best.values()], pa.int64())], names=["_pid", "x", "before", "idx"])

            near = " or ".join(f"(_pid = {k} and _before <= {v[-1]})" for k, v in ask.items())
            offset = {p[0]: p for p in self.parts}
            for r in self.starts.where(near).select("_pid", "_idx", "_before").mapInArrow(run, "_pid int, x long, before long, idx long").collect():
                p = offset[r["_pid"]]
                x, got = r["x"] + p[4], (r["before"] + p[4], r["idx"] + p[3])
                found[x] = max(got, found.get(x, got))
        return [found[x] for x in limits]


def cuts(bounds: Boundaries, shards: int, at_once: int = AT_ONCE) -> tuple[int, list[tuple[int, int]]]:
    """The smallest feasible capacity, and where each shard begins under it: (weight, rows) before it."""

    def fill(capacities: list[int]) -> list[list[tuple[int, int]]]:
        at = [[(0, 0)] for _ in capacities]
        for _ in range(shards):
            for path, new in zip(at, bounds.within([p[-1][0] + c for p, c in zip(at, capacities, strict=True)]), strict=True):
                path.append(new)
        return at

    done = lambda path: path[-1][0] >= bounds.total
    least = max(1, -(-bounds.total // shards))
    tried = [least, *(least + (1 << k) for k in range(max(1, bounds.total - least).bit_length()))]
    tried = [c for c in tried if c < bounds.total] + [max(1, bounds.total)]
    below, found = least - 1, None
    while True:
        paths = fill(tried)
        k = next(i for i, p in enumerate(paths) if done(p))  # the last one always is
        below, found = (tried[k - 1] if k else below), (tried[k], paths[k])
        gap = found[0] - below
        if gap <= 1:
            return found[0], found[1][:-1]
        step = max(1, -(-gap // at_once))
        tried = [*range(below + step, found[0], step), found[0]]


def shard(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row, shards equal in bytes but for group sizes.

    A row's size is its text's UTF-8 bytes plus 1; a null text counts as an empty one and is in one
    group with it. Rows of equal text share a shard. Slots count from 0 in each shard, by (hash of
    the text, doc_id). With fewer groups than shards, shards stay empty; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # two texts of one hash would share a group, which does no harm
    rows = pick(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.substring(F.md5(text.cast("binary")), 1, 16).alias("_group"))
    numbered = number_rows(rows, ["_group", "doc_id"], "size", "sharding")
    if not numbered.parts:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")).where("false")
    _, begins = cuts(Boundaries(numbered), shards)
    place = sum(((F.col("_weight_at") >= w).cast("int") for w, _ in begins[1:]), F.lit(0))
    first = F.array(*[F.lit(r).cast("long") for _, r in begins])
    return numbered.placed().withColumn("shard", place).select("doc_id", "size", "text_crc32", "shard", (F.col("_at") - first[F.col("shard")]).alias("slot"))


def op7_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: The same in DuckDB's SQL: the smallest capacity by dynamic programming over the groups, the cuts by
#: greedy filling. DuckDB has no CRC-32, so it is worked out byte by byte.
ORACLE = f"""
with recursive crc_table as (
  select list(list_reduce([b::ubigint, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end) order by b) t from range(256) r(b)),
texts as (select doc_id, coalesce(text, '') x, string_split(hex(encode(coalesce(text, ''))), '') h from documents),
raw as (select doc_id, x, strlen(x) + 1 size, case when x = '' then [] else list_transform(list_zip(h[1:len(h):2], h[2:len(h):2]), lambda p: (16 * (instr('0123456789ABCDEF', p[1]) - 1) + instr('0123456789ABCDEF', p[2]) - 1)::ubigint) end b from texts),
rows_ as (select doc_id, size, substr(md5(x), 1, 16) g, xor(list_reduce(list_prepend(4294967295::ubigint, b), lambda a, y: xor(a >> 8, t[((xor(a, y) & 255) + 1)::int])), 4294967295::ubigint)::bigint text_crc32 from raw, crc_table),
groups as (select g, row_number() over (order by g) j, (sum(sum(size)) over (order by g))::bigint s from rows_ group by g),
dp(k, j, cost) as (
  select 1, j, s from groups
  union all
  select k + 1, j, min(cost) from (
    select d.k, q.j, greatest(d.cost, q.s - e.s) cost from dp d join groups e on e.j = d.j join groups q on q.j >= d.j where d.k < {SHARDS}) group by 1, 2),
capacity as (select min(cost) c from dp where j = (select max(j) from groups)),
walk(k, w) as (
  select 0, 0::bigint
  union all
  select k + 1, (select max(s) from groups where s <= walk.w + (select c from capacity)) from walk where k < {SHARDS} - 1),
placed as (select r.*, (select count(*) from walk where k > 0 and q.s - q.n >= w)::int shard
  from rows_ r join (select g.*, n from groups g join (select g, sum(size)::bigint n from rows_ group by g) using (g)) q using (g))
select doc_id, size::bigint size, text_crc32, 'bytes' law, shard, row_number() over (partition by shard order by g, doc_id nulls first) - 1 slot, null::int grown_shard from placed
"""
