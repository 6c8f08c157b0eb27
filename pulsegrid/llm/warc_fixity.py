"""Merkle fixity audit of a WARC archive and a replica of it.

Pages become WARC records in one order, cut into files of FILE_RECORDS. Each archive gets two trees of
its own, from its own records alone.

The layout tree hashes offset, length and hash of every record in the order of offsets: ranges of FANOUT
records, then files, then ranges of FANOUT files. So records that are swapped, files in another order and
offsets that lie change its root, and `displaced` goes down into differing files and ranges only.

In the tree of ids a leaf hashes all records of one page_id, and ids are spread over branches by a hash, so
it has log64(n) levels whatever the ids are. A record that is missing or added changes its own branch only
and shifts nothing. The audit compares the roots and goes down only into branches that differ; only
records of ids that differ are laid side by side.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, number_rows, pick, remove, table

#: A power of two, since a node's parent is found by a shift.
FANOUT_BITS = 6
FANOUT = 1 << FANOUT_BITS
FILE_RECORDS = 4096
#: Bits of the hash that spreads ids over branches.
SPREAD_BITS = 60
#: The pages have no date of their own.
DATE = "2024-01-01T00:00:00Z"
#: Records of one id are hashed in groups of this many first hex digits, so that no task gets all of a very common id.
DIGITS = 3


def record(page_id: Column, url: Column, body: Column, date: str = DATE) -> Column:
    """A resource record as text; nulls are empty."""
    body = F.coalesce(body.cast("string"), F.lit(""))
    head = F.concat(F.lit(f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Date: {date}\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url.cast("string"), F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, body, F.lit("\r\n\r\n"))


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """(page_id, record) of every page."""
    p = pick(pages, page_id=id_col, url=url_col, body=body_col)
    return p.select(F.col("page_id").cast("long").alias("page_id"), record(F.col("page_id"), F.col("url"), F.col("body")).alias("record"))


def manifest(recs: DataFrame, label: str = "warc") -> DataFrame:
    """(page_id, length, hash, at, file, seq, offset) of (page_id, record): every record's place in the
    archive, by page_id, nulls first, then hash. `at` counts all records, `offset` bytes within the file. Where
    the records have their own `file` and `offset`, as `read_files` gives them, these stay, and `seq` counts a
    file's records by offset; rows that repeat are records of their own."""
    if {"file", "offset"} <= set(recs.columns):
        own = recs.select("page_id", F.octet_length("record").cast("long").alias("length"), F.sha2(F.concat(F.lit("leaf:"), "record"), 256).alias("hash"), F.col("file").cast("long").alias("file"), F.col("offset").cast("long").alias("offset"))
        numbered = number_rows(own, ["page_id", "hash", "file", "offset"], "length", label).placed()
        seq = F.row_number().over(Window.partitionBy("file").orderBy("offset", "hash")).cast("long") - 1  # a file's records
        return numbered.select("page_id", "length", "hash", F.col("_at").alias("at"), "file", seq.alias("seq"), "offset")
    hashed = recs.select("page_id", F.octet_length("record").cast("long").alias("length"), F.sha2(F.concat(F.lit("leaf:"), "record"), 256).alias("hash"))
    placed = number_rows(hashed, ["page_id", "hash"], "length", label).placed().withColumn("file", F.expr(f"_at div {FILE_RECORDS}")).withColumn("seq", F.expr(f"_at % {FILE_RECORDS}"))
    starts = placed.groupBy("file").agg(F.min("_weight_at").alias("start"))
    return placed.join(starts, "file").select("page_id", "length", "hash", F.col("_at").alias("at"), "file", "seq", (F.col("_weight_at") - F.col("start")).alias("offset"))


def write_files(recs: DataFrame, path: str) -> None:
    """Uncompressed WARC files, one for each `file` of the manifest, records in its order: folders
    file=0, file=1 and so on with one file each. Records of equal page_id and bytes are alike, so any
    of them takes any of their places."""
    hashed = recs.withColumn("hash", F.sha2(F.concat(F.lit("leaf:"), "record"), 256))
    numbered = number_rows(hashed.withColumn("length", F.octet_length("record").cast("long")), ["page_id", "hash"], "length", "warc-files")
    out = numbered.placed().select(F.expr(f"_at div {FILE_RECORDS}").alias("file"), "_at", F.expr("substring(record, 1, length(record) - 4)").alias("value"))
    # a record ends with two line ends, which the text writer puts behind every row
    out.repartition("file").sortWithinPartitions("file", "_at").select("file", "value").write.partitionBy("file").option("lineSep", "\r\n\r\n").text(path)


_HEAD = re.compile(rb"WARC/1\.1\r\n(.*?)\r\n\r\n", re.S)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record, file, offset) of every record of the files that `write_files` wrote.

    Each record's end follows from its Content-Length. What is no record raises an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content, file in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                raw, at, rows = content.as_py(), 0, []
                while at < len(raw):
                    head = _HEAD.match(raw, at)
                    fields = dict(x.split(b": ", 1) for x in head[1].split(b"\r\n")) if head else {}
                    end = head.end() + int(fields[b"Content-Length"]) + 4 if head else -1
                    if not head or raw[end - 4 : end] != b"\r\n\r\n":
                        raise ValueError(f"no record at {at} of file {file}")
                    name = fields[b"WARC-Record-ID"].decode().removeprefix("<urn:page:").removesuffix(">")
                    rows.append((int(name) if name else None, raw[at:end].decode(), file, at))
                    at = end
                yield pa.RecordBatch.from_pylist([dict(zip(("page_id", "record", "file", "offset"), r, strict=True)) for r in rows], schema=pa.schema([("page_id", pa.int64()), ("record", pa.string()), ("file", pa.int64()), ("offset", pa.int64())]))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
    named = files.select("content", F.regexp_extract("path", r"/file=(\d+)/", 1).cast("long").alias("file"))
    return named.mapInArrow(run, "page_id long, record string, file long, offset long")


def copies(held: DataFrame) -> DataFrame:
    """(page_id, hash, n, length, first): records of one id and hash are copies; `first` is their first place."""
    return held.groupBy("page_id", "hash").agg(F.count("*").alias("n"), F.max("length").alias("length"), F.min("at").alias("first"))


def _spread(page_id: Column) -> Column:
    """A number of SPREAD_BITS bits by a hash of the id."""
    return F.conv(F.substring(F.sha2(F.coalesce(page_id.cast("string"), F.lit("")), 256), 1, SPREAD_BITS // 4), 16, 10).cast("long")


def _up(level: int, depth: int) -> Column:
    """The node above one of this level."""
    if level == 0:
        return F.shiftright(_spread(F.col("idx")), SPREAD_BITS - FANOUT_BITS * depth)
    return F.shiftright("idx", FANOUT_BITS) if level < depth else F.lit(0).cast("long")


def depth_for(rows: int) -> int:
    """Levels between ids and root, so that the lowest have about FANOUT ids a node."""
    return next(d for d in range(1, SPREAD_BITS // FANOUT_BITS + 1) if FANOUT ** (d + 1) >= rows or d == SPREAD_BITS // FANOUT_BITS)


def layout(held: DataFrame, label: str = "warc-layout") -> list[DataFrame]:
    """Of a manifest: (file, range, hash) of ranges of FANOUT records, (file, hash) of files, then (idx, hash)
    by FANOUT files, and the root. Each is a written table, but for the records themselves."""
    leaf = F.concat_ws(":", "offset", "length", "hash")
    ranges = held.groupBy("file", F.shiftright("seq", FANOUT_BITS).alias("range")).agg(F.array_sort(F.collect_list(F.struct("seq", leaf.alias("leaf")))).alias("kids"))
    ranges = materialize(ranges.select("file", "range", F.sha2(F.concat_ws("|", F.lit("range"), "kids.leaf"), 256).alias("hash")), label)
    kids = ranges.groupBy("file").agg(F.array_sort(F.collect_list(F.struct(F.col("range").alias("k"), "hash"))).alias("kids"))
    node = lambda word: F.sha2(F.concat_ws("|", F.lit(word), F.transform("kids", lambda k: F.concat_ws(":", k["k"], k["hash"]))), 256).alias("hash")
    levels = [ranges, materialize(kids.select("file", node("file")), label)]
    most = levels[1].agg(F.max("file")).first()[0]
    nodes, left = levels[1].withColumnRenamed("file", "idx"), most or 0
    while True:
        left >>= FANOUT_BITS
        up = nodes.groupBy(F.shiftright("idx", FANOUT_BITS).alias("up")).agg(F.array_sort(F.collect_list(F.struct(F.col("idx").alias("k"), "hash"))).alias("kids"))
        levels.append(materialize(up.select(F.col("up").alias("idx"), node("files")), label))
        nodes = levels[-1]
        if not left:
            return levels


def displaced(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """(side, page_id, file, offset, length, hash) of the places at which two manifests differ: what only the
    archive (`ours`) or only the replica (`theirs`) has there. Records that have moved are on both sides."""
    trees = layout(ours), layout(theirs)
    empty = ours.select(F.lit("").alias("side"), "page_id", "file", "offset", "length", "hash").where("false")
    if root(trees[0]) == root(trees[1]):
        return empty
    front = None
    for level, key in ((1, ["file"]), (0, ["file", "range"])):
        a, b = (t[level].select(*key, F.col("hash").alias(h)) for t, h in ((trees[0], "ha"), (trees[1], "hb")))
        if front is not None:
            a, b = a.join(front, "file", "left_semi"), b.join(front, "file", "left_semi")
        found = a.join(b, key, "full_outer").where(~F.col("ha").eqNullSafe(F.col("hb"))).select(*key)
        front = materialize(found, "warc-front")
    place = ["file", "offset", "length", "hash"]
    near = [t.withColumn("range", F.shiftright("seq", FANOUT_BITS)).join(front, ["file", "range"], "left_semi") for t in (ours, theirs)]
    sides = [x.join(y.select(*place).distinct(), place, "left_anti").select(F.lit(name).alias("side"), "page_id", *place) for name, x, y in (("ours", *near), ("theirs", *near[::-1]))]
    return sides[0].unionByName(sides[1])


def tree(leaf: DataFrame, depth: int, label: str) -> list[DataFrame]:
    """(idx, bytes, hash) of the nodes, a written table for each level: by id, then by the hash that spreads
    the ids, then `depth` - 1 times by FANOUT nodes, then the root. Built from (page_id, hash, n, length) of
    one archive."""
    some = leaf.groupBy("page_id", F.substring("hash", 1, DIGITS).alias("x")).agg(F.sum(F.col("n") * F.col("length")).alias("bytes"), F.array_sort(F.collect_list(F.concat_ws("x", "hash", F.col("n").cast("string")))).alias("kids"))
    some = some.select("page_id", "x", "bytes", F.sha2(F.array_join("kids", "|"), 256).alias("h"))
    below = some.groupBy(F.col("page_id").alias("idx")).agg(F.sum("bytes").alias("bytes"), F.array_sort(F.collect_list(F.concat_ws(":", "x", "h"))).alias("kids"))
    levels = [materialize(below.select("idx", "bytes", F.sha2(F.concat_ws("|", F.lit("leaf"), F.col("bytes").cast("string"), F.array_join("kids", "|")), 256).alias("hash")), label)]
    for level in range(depth + 1):
        up = levels[-1].groupBy(_up(level, depth).alias("up")).agg(F.sum("bytes").alias("bytes"), F.array_sort(F.collect_list(F.struct("idx", "hash"))).alias("kids"))
        kids = F.expr("concat_ws('|', transform(kids, k -> concat(coalesce(string(k.idx), ''), ':', k.hash)))")
        levels.append(materialize(up.select(F.col("up").alias("idx"), "bytes", F.sha2(F.concat_ws("|", F.lit("node"), F.col("bytes").cast("string"), kids), 256).alias("hash")), label))
    return levels


def root(levels: list[DataFrame]) -> str:
    """The root's hash; empty for an archive without records."""
    found = levels[-1].first()
    return found["hash"] if found else ""


def differing(ours: list[DataFrame], theirs: list[DataFrame]) -> DataFrame:
    """(page_id) of the leaves that differ or that only one tree has, by descent from roots that differ
    into differing branches only."""
    front, depth = None, len(ours) - 2
    for level in range(depth, -1, -1):
        a, b = (t[level].select("idx", F.col("hash").alias(h)) for t, h in ((ours, "ha"), (theirs, "hb")))
        if front is not None:
            a, b = (x.join(front, _up(level, depth).eqNullSafe(F.col("up")), "left_semi") for x in (a, b))
        b = b.withColumnRenamed("idx", "idb")
        found = a.join(b, F.col("idx").eqNullSafe(F.col("idb")) & F.col("ha").isNotNull(), "full_outer").where(~F.col("ha").eqNullSafe(F.col("hb")))
        # what differs, no more
        front = materialize(found.select(F.when(F.col("ha").isNull(), F.col("idb")).otherwise(F.col("idx")).alias("up")), "warc-front")
    return front.withColumnRenamed("up", "page_id")


def audit(ours: DataFrame, replica: DataFrame) -> DataFrame:
    """(page_id, file, seq, offset, length, hash, status, root, replica_root, layout_root,
    replica_layout_root) of every record of (page_id, record) `ours`, and after them the replica's records
    that the archive lacks, with their place in the replica. Either may have its own `file` and `offset`.

    status: ok, corrupt (other bytes in the replica), missing, or extra. Of one page_id (null is one
    too) equal records are matched first; what is then left on both sides is paired as corrupt, in the
    order of the hashes, and the rest is missing or extra. Both tables may be empty.
    """
    held, theirs = materialize(manifest(ours, "warc-ours"), "warc-manifest"), materialize(manifest(replica, "warc-replica"), "warc-manifest")
    mine, other = materialize(copies(held), "warc-copies"), materialize(copies(theirs), "warc-copies")
    depth = depth_for(max(mine.count(), other.count()))
    laid = layout(held), layout(theirs)
    trees = tree(mine, depth, "warc-tree"), tree(other, depth, "warc-tree")
    roots = [root(t) for t in trees]
    place = ["page_id", "file", "seq", "offset", "length", "hash", "status"]
    out = held.withColumn("status", F.lit("ok")).select(*place)
    if roots[0] != roots[1]:
        ids = differing(*trees).withColumnRenamed("page_id", "_id")
        near = lambda t, n: t.join(ids, F.col("page_id").eqNullSafe(F.col("_id")), "left_semi").select("page_id", "hash", F.col("n").alias(n), F.col("first").alias(f"f{n}"))
        a, b = near(mine, "n1"), near(other, "n2").withColumnRenamed("page_id", "_id").withColumnRenamed("hash", "_hash")
        both = a.join(b, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")), "full_outer")
        both = both.select(F.coalesce("page_id", "_id").alias("_id"), F.coalesce("hash", "_hash").alias("_hash"), "n1", "fn1", "n2", "fn2", F.greatest(F.coalesce("n1", F.lit(0)) - F.coalesce("n2", F.lit(0)), F.lit(0)).alias("lost"), F.greatest(F.coalesce("n2", F.lit(0)) - F.coalesce("n1", F.lit(0)), F.lit(0)).alias("more"))
        both = materialize(both.where("lost + more > 0"), "warc-bad")
        pairs = both.groupBy(F.col("_id").alias("_p")).agg(F.least(F.sum("lost"), F.sum("more")).alias("pairs"))

        def told(side: str, n: str) -> DataFrame:
            """Of each id and hash: the place of its first bad copy, and how many bad ones of the id come before."""
            before = Window.partitionBy("_id").orderBy("_hash").rowsBetween(Window.unboundedPreceding, -1)
            bad = both.where(f"{side} > 0").withColumn("_before", F.coalesce(F.sum(side).over(before), F.lit(0)))
            return bad.join(pairs, F.col("_id").eqNullSafe(F.col("_p"))).select("_id", "_hash", (F.col(f"f{n}") + F.col(n) - F.col(side)).alias("_from"), "_before", "pairs")

        def with_told(rows: DataFrame, side: str, n: str, how: str) -> DataFrame:
            met = rows.join(told(side, n), F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")), how)
            return met.withColumn("_bad", F.col("at") >= F.col("_from")).withColumn("_paired", F.col("_before") + F.col("at") - F.col("_from") < F.col("pairs"))

        out = with_told(held, "lost", "n1", "left").withColumn("status", F.when(~F.coalesce("_bad", F.lit(False)), "ok").when(F.col("_paired"), "corrupt").otherwise("missing")).select(*place)
        out = out.unionByName(with_told(theirs, "more", "n2", "inner").where("_bad and not _paired").withColumn("status", F.lit("extra")).select(*place))
    heads = {"root": roots[0], "replica_root": roots[1], "layout_root": root(laid[0]), "replica_layout_root": root(laid[1])}
    for t in (*trees[0], *trees[1], *laid[0], *laid[1]):
        remove(ours.sparkSession, t)
    return out.withColumns({k: F.lit(v) for k, v in heads.items()})


def damaged(recs: DataFrame) -> DataFrame:
    """A replica for the registered query: of every 1000 ids the 8th has another first byte, the 14th is
    gone, and the 22nd is there again under a new id."""
    hurt = F.when(F.col("page_id") % 1000 == 7, F.concat(F.lit("w"), F.expr("substring(record, 2)"))).otherwise(F.col("record"))
    kept = recs.where("not coalesce(page_id % 1000 = 13, false)").select("page_id", hurt.alias("record"))
    return kept.unionByName(recs.where("page_id % 1000 = 21").select((F.col("page_id") + 1_000_000_000).alias("page_id"), "record"))


def op6_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = records(table(spark, sf_dir, "pages"))
    return audit(recs, damaged(recs))


def _tree_sql(name: str) -> str:
    """The levels of a tree over the table `{name}_copies`, and its root as `{name}_root`."""
    return f"""{name}_some as (select page_id, substr(hash, 1, {DIGITS}) x, sum(n * length)::bigint bytes, sha256(string_agg(hash || 'x' || n, '|' order by hash)) h from {name}_copies group by 1, 2),
{name}_tree(level, idx, bytes, hash) as (
  select 0, page_id, sum(bytes)::bigint, sha256('leaf|' || sum(bytes)::bigint || '|' || string_agg(x || ':' || h, '|' order by x)) from {name}_some group by page_id
  union all
  select level + 1, up, sum(bytes)::bigint, sha256('node|' || sum(bytes)::bigint || '|' || string_agg(coalesce(idx::varchar, '') || ':' || hash, '|' order by idx nulls first))
  from (select *, case when level = 0 then ('0x' || substr(sha256(coalesce(idx::varchar, '')), 1, {SPREAD_BITS // 4}))::bigint >> ({SPREAD_BITS} - {FANOUT_BITS} * (select d from depth))
    when level < (select d from depth) then idx >> {FANOUT_BITS} else 0 end up from {name}_tree where level <= (select d from depth)) group by 1, 2),
{name}_root as (select hash from {name}_tree where level = (select d + 1 from depth)),
{name}_ranges as (select file, seq >> {FANOUT_BITS} r, sha256('range|' || string_agg("offset" || ':' || length || ':' || hash, '|' order by seq)) hash from {name} group by 1, 2),
{name}_files(level, idx, hash) as (
  select 0, file, sha256('file|' || string_agg(r || ':' || hash, '|' order by r)) from {name}_ranges group by file
  union all
  select level + 1, idx >> {FANOUT_BITS}, sha256('files|' || string_agg(idx || ':' || hash, '|' order by idx)) from {name}_files
  where level = 0 or (select max(file) from {name}) >> ({FANOUT_BITS} * level) > 0 group by 1, 2),
{name}_layout as (select hash from {name}_files order by level desc limit 1)"""


_RECORD = f"""'WARC/1.1' || e || 'WARC-Type: resource' || e || 'WARC-Date: {DATE}' || e || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::varchar, '') || '>' || e || 'WARC-Target-URI: ' || coalesce(url, '') || e
  || 'Content-Type: text/html' || e || 'Content-Length: ' || strlen(coalesce(html, '')) || e || e || coalesce(html, '') || e || e"""


def _archive_sql(name: str) -> str:
    return f"""{name}_hashed as (select page_id, strlen(record) length, sha256('leaf:' || record) hash from {name}_records),
{name} as (select *, n // {FILE_RECORDS} file, n % {FILE_RECORDS} seq, (sum(length) over (partition by n // {FILE_RECORDS} order by n) - length)::bigint "offset",
  row_number() over (partition by page_id, hash order by n) copy, count(*) over (partition by page_id, hash) n_copies from (select *, row_number() over (order by page_id nulls first, hash) - 1 n from {name}_hashed)),
{name}_copies as (select page_id, hash, count(*) n, max(length) length from {name} group by 1, 2)"""


def _status_sql(name: str, other: str) -> str:
    """Rows of one archive with how many copies the other has, and their number among the id's bad ones."""
    return f"""{name}_told as (select a.*, copy > coalesce(o.n, 0) bad, sum((copy > coalesce(o.n, 0))::int) over (partition by a.page_id order by a.hash, copy) nth
  from {name} a left join {other}_copies o on a.page_id is not distinct from o.page_id and a.hash = o.hash),
{name}_bad as (select page_id, count(*) k from {name}_told where bad group by 1)"""


ORACLE = f"""
with recursive p as (select page_id, url, html, chr(13) || chr(10) e from pages),
ours_records as (select page_id, {_RECORD} record from p),
theirs_records as (
  select page_id, case page_id % 1000 when 7 then 'w' || substr(record, 2) else record end record from ours_records where coalesce(page_id % 1000, 0) <> 13
  union all select page_id + 1000000000, record from ours_records where page_id % 1000 = 21),
{_archive_sql("ours")},
{_archive_sql("theirs")},
depth as (select min(k) d from range(1, {SPREAD_BITS // FANOUT_BITS + 1}) t(k) where pow({FANOUT}, k + 1) >= greatest((select count(*) from ours_copies), (select count(*) from theirs_copies))),
{_tree_sql("ours")},
{_tree_sql("theirs")},
{_status_sql("ours", "theirs")},
{_status_sql("theirs", "ours")}
select t.page_id, t.file, t.seq, t."offset", t.length, t.hash, case when not t.bad then 'ok' when t.nth <= coalesce(b.k, 0) then 'corrupt' else 'missing' end status, (select hash from ours_root) root, (select hash from theirs_root) replica_root,
  (select hash from ours_layout) layout_root, (select hash from theirs_layout) replica_layout_root
from ours_told t left join theirs_bad b on t.page_id is not distinct from b.page_id
union all
select t.page_id, t.file, t.seq, t."offset", t.length, t.hash, 'extra', (select hash from ours_root), (select hash from theirs_root), (select hash from ours_layout), (select hash from theirs_layout)
from theirs_told t left join ours_bad b on t.page_id is not distinct from b.page_id where t.bad and t.nth > coalesce(b.k, 0)
"""
