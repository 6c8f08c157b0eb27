"""Edit-distance join of names: positional q-grams, a prefix filter, an inverted index.

1. Equal names go on as one. The q-grams of all names are counted; the global order is rare first.
2. An edit destroys at most q + 1 of a name's grams (an exchange of neighbours that many, others q), so two
   names within `most` edits share all but most * (q + 1) of the longer one's grams, in the same order and at
   positions at most `most` apart. Of the first most * (q + 1) + COMMON grams of each they share COMMON
   (prefix filter). Every COMMON of a name's first grams are a key of the inverted index, with its length.
3. Probes meet the index where the lengths allow it. Of what meets, positions must agree within `most`, and
   bitmaps of all grams may differ in 2 * most * (q + 1) bits (a count filter); both are part of the join.
4. What is left is counted on the grams themselves and then compared. Names too short to share COMMON
   grams with one another bypass all this: they meet in buckets of their lengths, by what `most`
   deletions leave of both.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dealt_anew, materialize, pick, table

#: Length of a gram, and how many first grams make a key together.
GRAM, COMMON = 2, 2
#: Grams are counted in so many classes, by hash: the order's table is no larger, however many grams there are.
CLASSES = 1 << 16
#: The query's largest distance.
MOST = 1
_BITS = 64


def distance(a: str, b: str, most: int) -> int:
    """The fewest insertions, deletions, substitutions and exchanges of neighbours (code points) that turn
    one into the other, substrings edited again where that is shorter; `most` + 1 if that is more than `most`."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if not a or not b:
        return len(a) + len(b)
    # only cells at most `most` off the diagonal can count
    far = most + 1
    row_of: dict[str, int] = {}  # where a character was last seen in a
    cells = [{j: j for j in range(min(len(b), most) + 1)}]
    at = lambda i, j: cells[i].get(j, far) if i >= 0 and j >= 0 else far
    for i, x in enumerate(a, 1):
        now = {0: i} if i <= most else {}
        cells.append(now)
        last = 0  # where x was last seen in b
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            y = b[j - 1]
            i1, j1 = row_of.get(y, 0), last
            best = min(at(i - 1, j - 1) + (x != y), at(i - 1, j) + 1, at(i, j - 1) + 1)
            if i1 and j1:
                best = min(best, at(i1 - 1, j1 - 1) + (i - i1 - 1) + 1 + (j - j1 - 1))
            if x == y:
                last = j
            now[j] = min(best, far)
        row_of[x] = i
    return at(len(a), len(b))


def _grams(name: str, q: int) -> list[str]:
    return [name[k : k + q] for k in range(len(name) - q + 1)]


def shares_enough(a: str, b: str, most: int, q: int = GRAM) -> bool:
    """The count filter, on the grams themselves."""
    x, y = Counter(_grams(a, q)), Counter(_grams(b, q))
    return (x & y).total() >= max(x.total(), y.total()) - most * (q + 1)


def residues(name: str, most: int) -> set[str]:
    """What is left of a name after at most `most` deletions."""
    return {"".join(c for k, c in enumerate(name) if k not in out) for n in range(min(most, len(name)) + 1) for out in map(set, combinations(range(len(name)), n))}


def _class(gram: Column) -> Column:
    return F.pmod(F.crc32(gram.cast("binary")), F.lit(CLASSES)).cast("int")


def gram_counts(names: DataFrame, q: int = GRAM) -> np.ndarray:
    """How often the grams of each class occur in `names` (name): CLASSES numbers, whatever the input."""
    grams = names.where(F.length("name") >= q).select(F.explode(F.expr(f"transform(sequence(1, length(name) - {q - 1}), k -> substring(name, k, {q}))")).alias("g"))
    out = np.zeros(CLASSES, np.int64)
    for k, n in grams.groupBy(_class(F.col("g")).alias("k")).agg(F.count("*")).collect():  # CLASSES rows at most
        out[k] = n
    return out


def keys(names: DataFrame, counts: np.ndarray, most: int, q: int, common: int, probe: bool) -> DataFrame:
    """(short, length, key, at, bits, name): the index rows of each name, or its probes of all lengths
    that can match. `at` are the positions of the key's grams, `bits` the bitmap of all grams."""
    first = most * (q + 1) + common

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in range(0, b.num_rows, 1000):
                rows: list[tuple] = []
                for name in b.column(0).slice(some, 1000).to_pylist():
                    grams = _grams(name, q)
                    hashes = [zlib.crc32(g.encode()) for g in grams]
                    bits = 0
                    for h in hashes:
                        bits |= 1 << (h >> 16) % _BITS
                    bits -= (bits >> 63) << 64
                    prefix = sorted((int(counts[h % CLASSES]), g, k) for k, (g, h) in enumerate(zip(grams, hashes, strict=True)))[:first]
                    lengths = range(max(1, len(name) - most), len(name) + most + 1) if probe else (len(name),)
                    own = [(False, "".join(g for _, g, _ in some), [k for _, _, k in some]) for some in combinations(prefix, common)]
                    if len(grams) < first:
                        own += [(True, r, []) for r in residues(name, most)]
                    rows += [(short, n, key, at, bits, name) for short, key, at in own for n in lengths]
                kinds = (pa.bool_(), pa.int32(), pa.string(), pa.list_(pa.int32()), pa.int64(), pa.string())
                columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["short", "length", "key", "at", "bits", "name"])

    return names.mapInArrow(run, "short boolean, length int, key string, at array<int>, bits long, name string")


def matches(left: DataFrame, right: DataFrame, most: int = MOST, q: int = GRAM, common: int = COMMON) -> DataFrame:
    """(a, b, distance) of each name of `left` and each of `right` (both: name, distinct, not null, not
    empty) that are at most `most` edits apart; every such pair once."""
    left, right = (materialize(x.select("name"), f"names-{k}") for k, x in (("left", left), ("right", right)))
    counts = gram_counts(left.unionByName(right), q)
    index = keys(left, counts, most, q, common, probe=False).toDF("short", "length", "key", "at_a", "bits_a", "a")
    asked = keys(right, counts, most, q, common, probe=True).toDF("short", "length", "key", "at_b", "bits_b", "b")
    close = F.forall(F.zip_with("at_a", "at_b", lambda x, y: x - y), lambda d: F.abs(d) <= most)
    same_grams = F.bit_count(F.col("bits_a").bitwiseXOR(F.col("bits_b"))) <= 2 * most * (q + 1)
    # merged, never broadcast: Spark takes the probes for as small as the names they come from
    met = index.join(asked.hint("merge"), ["short", "length", "key"]).where(F.col("short") | close & same_grams).select("a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(a, b, d) for a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True) if shares_enough(a, b, most, q) and (d := distance(a, b, most)) <= most]
            columns = zip(*rows, strict=True) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int32()), strict=True)], names=["a", "b", "distance"])

    return met.mapInArrow(run, "a string, b string, distance int").distinct()


def misspelt(name: Column, own_id: Column) -> Column:
    """The name with two neighbours exchanged, where and whether by the id's hash."""
    h = F.crc32(own_id.cast("string").cast("binary"))
    n = F.length(name)
    p = F.pmod(h, n - 1).cast("int")
    swapped = F.concat(F.substring(name, F.lit(1), p), F.substring(name, p + 2, F.lit(1)), F.substring(name, p + 1, F.lit(1)), F.substring(name, p + 3, n))
    return F.when((h % 2 == 0) & (n >= 2), swapped).otherwise(name)


def join_names(clients: DataFrame, vendors: DataFrame, most: int = MOST) -> DataFrame:
    """(vendor_id, distance, n_clients, first_client_id, clients_crc) of `clients` (client_id, name) and
    `vendors` (vendor_id, name): one row for each vendor and distance at which it has clients.

    Names are compared as they are. Rows whose id or name is null, or whose name is empty, take no part;
    rows that repeat count as often as they come; a vendor_id of several names has the clients of all of
    them. Empty tables give no rows; other columns don't matter.
    """
    named = "name is not null and name <> '' and id is not null"
    own = pick(clients, id="client_id", name="name").selectExpr("cast(id as long) id", "cast(name as string) name").where(named)
    held = materialize(own.groupBy("name").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.sum(F.crc32(F.col("id").cast("string").cast("binary"))).alias("crc")), "names-clients")
    asked = materialize(pick(vendors, id="vendor_id", name="name").selectExpr("cast(id as long) id", "cast(name as string) name").where(named), "names-vendors")
    found = matches(held, asked.select("name").distinct(), most)
    each = found.join(held.hint("merge"), found["a"] == held["name"]).groupBy("b", "distance").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.sum("crc").alias("crc"))
    # vendors of one name, many perhaps, meet its two totals at most: both sides are dealt out for the join, so a hot name is split
    rows = asked.join(each.withColumn("b", F.concat("b", F.lit(""))).hint("merge"), asked["name"] == F.col("b"))
    out = rows.groupBy("id", "distance").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.sum("crc").alias("crc"))
    return out.select(F.col("id").alias("vendor_id"), "distance", F.col("n").alias("n_clients"), F.col("first").alias("first_client_id"), F.col("crc").alias("clients_crc"))


def op11_name_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    vendors = table(spark, sf_dir, "vendors")
    return join_names(table(spark, sf_dir, "clients"), vendors.select("vendor_id", misspelt(F.col("name"), F.col("vendor_id")).alias("name")), MOST)


def _crc_sql(column: str) -> str:
    """CRC-32 of a decimal number in DuckDB's SQL, which has none: digit by digit."""
    digits = f"list_transform(string_split({column}::varchar, ''), lambda c: ascii(c)::ubigint)"
    return f"xor(list_reduce(list_prepend(4294967295::ubigint, {digits}), lambda a, y: xor(a >> 8, t[((xor(a, y) & 255) + 1)::int])), 4294967295::ubigint)::bigint"


#: One edit in DuckDB's SQL, by equality joins alone: nothing changed, one deletion on either side, one
#: position left out of both, or two neighbours exchanged.
ORACLE = f"""
with crc_table as (
  select list(list_reduce([b::ubigint, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end) order by b) t from range(256) r(b)),
held as (select name a, count(*)::bigint n, min(client_id) f, sum({_crc_sql("client_id")})::bigint crc from clients, crc_table where name <> '' and client_id is not null group by 1),
hashed as (select vendor_id, name, {_crc_sql("vendor_id")} h, length(name) l from vendors, crc_table where name <> '' and vendor_id is not null),
asked as (select vendor_id, case when h % 2 = 0 and l >= 2 then name[1:h % (l - 1)] || name[h % (l - 1) + 2:h % (l - 1) + 2] || name[h % (l - 1) + 1:h % (l - 1) + 1] || name[h % (l - 1) + 3:] else name end b from hashed),
cut_a as (select a, unnest(range(1, length(a) + 1)) i, a[1:i - 1] || a[i + 1:] r from held),
names as (select distinct b from asked),
cut_b as (select b, unnest(range(1, length(b) + 1)) i, b[1:i - 1] || b[i + 1:] r from names),
turned as (select b, unnest(range(1, length(b))) i, b[1:i - 1] || b[i + 1:i + 1] || b[i:i] || b[i + 2:] r from names),
pairs as (
  select a, b, 0 d from held join names on a = b
  union select a, b, 1 from cut_a join names on r = b
  union select a, b, 1 from cut_b join held on r = a
  union select a, b, 1 from cut_a x join cut_b y on x.i = y.i and x.r = y.r where a <> b
  union select a, b, 1 from turned join held on r = a where a <> b)
select vendor_id, d "distance", sum(n)::bigint n_clients, min(f) first_client_id, sum(crc)::bigint clients_crc from asked join pairs using (b) join held using (a) group by 1, 2
"""
