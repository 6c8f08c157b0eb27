"""Near-duplicates: universal hash minima, banding, verification, connected components.

1. Each text's word shingles are hashed; texts of equal words fall together and go on as one.
2. HASHES minima of universal hash functions make a signature, cut into bands of ROWS minima.
   With 32 bands of 5, two texts of similarity 0.8 share no band with probability 3e-6.
3. Each bucket of a band links its members to its smallest one: as many links as members, never
   all pairs. Links are checked on the full shingle sets, of hashes first and then of the words
   themselves, and components are formed.
4. Buckets whose members are still in different components are looked at again: members outside
   the bucket's largest component are compared by signature, in blocks, with the members of other
   components whose sets are of like size (a link needs sizes within 4 to 5). What the signatures allow is gathered into families (a block reports no more links
   than it has members), and in each family, in blocks again, members of different components are
   compared on their full sets. So a link is lost only if no band shows it, or if the signature is
   off by five deviations.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dealt_anew, materialize, maybe_in, pick, raw_texts, remove, table
from .components import components

#: Words of a shingle; an operator's default. The query takes 2.
WORDS = 5
#: Least similarity, in hundredths.
PERCENT = 80
HASHES, ROWS = 160, 5
BANDS = HASHES // ROWS
#: Members of a family that one comparison block holds.
BLOCK = 512
#: Shingles that the full sets of one comparison block hold, where its texts are long.
SHINGLES = 1 << 20
#: Links of one text that are checked together.
LINKS = 128
#: Members of a bucket that one block compares by signature.
SIGNATURES = 1024
_CHUNK = 1 << 19
_rng = np.random.default_rng(20240607)
_LEFT, _FIRST, _BAND, _SEED = (int(x) | 1 for x in _rng.integers(1 << 40, 1 << 63, 4, np.uint64))
_A = _rng.integers(1, 1 << 32, HASHES, np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, HASHES, np.uint32)
_M = _rng.integers(1 << 40, 1 << 63, ROWS, np.uint64) | np.uint64(1)
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_space = np.zeros(256, bool)
_space[[32, *range(9, 14)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(texts: list[bytes], words: int) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles."""
    out: list[np.ndarray] = []
    group: list[bytes] = []
    size = 0
    for t in [*texts, None]:
        if group and (t is None or size + len(t) > _CHUNK):
            out += _hash_group(group, words)
            group, size = [], 0
        if t is not None:
            group.append(t)
            size += len(t) + 1
    return out


def _words(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of all texts, equal ones coded alike, and where each begins in the texts with a byte between them."""
    raw = _lower[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    gap = _space[raw]
    edge = np.diff(gap.astype(np.int8), prepend=1)
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    ends = np.concatenate([[0], np.cumsum(last - first)]).astype(np.int64)
    held = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(raw[~gap])])
    return held.dictionary_encode(), first


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, and where it begins."""
    coded, first = _words(texts)
    each = b"".join(xxhash.xxh3_64_digest(w, _SEED) for w in coded.dictionary.to_pylist())
    return np.frombuffer(each, np.uint64)[coded.indices.to_numpy(zero_copy_only=False)], first


def _hash_group(texts: list[bytes], words: int) -> list[np.ndarray]:
    word, first = _word_hashes(texts)
    starts = np.cumsum([0, *[len(t) + 1 for t in texts]])
    edges = np.searchsorted(first, starts)
    code = word.copy()
    for k in range(1, words):
        code = code[:-1] * np.uint64(_LEFT) + word[k:] if len(code) else code
    code = _mix(code)
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(code[a : b - words + 1]))
        elif b > a:  # too few words: the whole sequence is the only shingle
            x = np.array([_FIRST], np.uint64)
            for w in word[a:b]:
                x = x * np.uint64(_LEFT) + w
            out.append(_mix(x))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_set(text: bytes, words: int) -> set:
    w = text.lower().split()  # bytes: only A-Z, and the six ASCII blanks
    return set(zip(*(w[k:] for k in range(words)), strict=False)) if len(w) >= words else {tuple(w)} if w else set()


def similar(a: bytes, b: bytes, words: int, percent: int) -> bool:
    """Whether the shingle sets of two texts reach the similarity, on their words, not on hashes: every
    distinct word of the two gets a number, and so does every distinct run of 2, 3, ... words."""
    coded, first = _words([a, b])
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    own = first < len(a) + 1
    n = int(own.sum())
    if min(n, len(ids) - n) < words:  # a text of too few words is one shingle, and only like itself
        return n > 0 and np.array_equal(ids[:n], ids[n:])
    kinds, run = len(coded.dictionary), ids
    for k in range(1, words):
        run = np.unique(run[:-1] * kinds + ids[k:], return_inverse=True)[1]
    x, y = np.unique(run[: n - words + 1]), np.unique(run[n:])
    both = in_common(x, y)
    return 100 * both >= percent * (len(x) + len(y) - both)


def minima(hashes: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    h = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(h), 2048):
        out = np.minimum(out, (_A[:, None] * h[None, at : at + 2048] + _B[:, None]).min(1))
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    x = (signatures.reshape(-1, BANDS, ROWS).astype(np.uint64) * _M).sum(2, dtype=np.uint64)
    return _mix(x + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(_BAND)).view(np.int64)


def shingled(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, fingerprint, bands) of (doc_id, text); no fingerprint and no bands
    where there is no word. Equal fingerprints mean equal words, one after another: they are
    128 bits of a cryptographic hash of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                texts = raw_texts(part.column(1))
                sets = shingle_hashes(texts, words)
                keys = [band_keys(minima(s))[0] if len(s) else np.zeros(0, np.int64) for s in sets]
                ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(b" ".join(t.lower().split()), digest_size=16).digest() if len(s) else None for t, s in zip(texts, sets, strict=True)], pa.binary()),
                    pa.ListArray.from_arrays(ends, np.concatenate(keys) if keys else np.zeros(0, np.int64)),
                ], names=["doc_id", "n_shingles", "fingerprint", "bands"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, fingerprint binary, bands array<long>")


def signed(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, signature, text) of (doc_id, text) with at least one word each. Texts are moved rather
    than hashes of their shingles, which no shuffle can compress."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                sets = shingle_hashes(raw_texts(part.column(1)), words)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([minima(s).tobytes() for s in sets], pa.binary()), part.column(1)], names=["doc_id", "n", "signature", "text"])

    return docs.mapInArrow(run, "doc_id long, n long, signature binary, text string")


def in_common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Of distinct pairs (u, v) those whose full shingle sets, of (doc_id, text), reach the similarity.

    u's text meets its partners' in groups of about LINKS partners, one text at a time.
    """
    degree = pairs.groupBy("u").agg(F.ceil(F.count("*") / LINKS).cast("int").alias("parts"))
    dealt = pairs.join(dealt_anew(degree, "u"), "u").withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int"))
    partners = dealt.join(texts.withColumnRenamed("doc_id", "v"), "v").select("u", "part", "v", "text")
    centers = degree.select("u", F.explode(F.expr("sequence(0, parts - 1)")).alias("part")).join(texts.withColumnRenamed("doc_id", "u"), "u").select("u", "part", F.lit(None).cast("long").alias("v"), "text")
    met = centers.unionByName(partners).repartition("u", "part").sortWithinPartitions("u", "part", F.col("v").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at = [], None  # the text at hand and its set: more than one if rows repeat its id
        for b in batches:
            us, vs = [], []
            for u, part, v, text in zip(*(b.column(k) for k in range(4)), strict=True):
                u, part, v, text = u.as_py(), part.as_py(), v.as_py(), text.as_py().encode()
                s = _hash_group([text], words)[0]
                if v is None:
                    own = [*own, (text, s)] if at == (u, part) else [(text, s)]
                    at = (u, part)
                    continue
                for t, o in own:
                    both = in_common(o, s)
                    if 100 * both >= percent * (len(o) + len(s) - both) and similar(t, text, words, percent):
                        us.append(u)
                        vs.append(v)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return met.mapInArrow(run, "u long, v long")


class _Sets:
    """A union-find over what one block has seen."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _meet(rows: DataFrame, group: str, sets: DataFrame, column: str, percent: int, block: int, written: list[DataFrame]) -> DataFrame:
    """Members dealt to the blocks of their group and size class, and after them the probes, which go
    to every block of the classes that a link can reach.

    `rows` has the group (a long), doc_id, component and n (the set's size), `sets` (doc_id, n, column).
    Sizes of one link differ by a factor of 100 / percent at most, so its classes are neighbours.
    Members of the group's largest component are no probes; groups within one component are left out
    before anything large is moved. A block of full sets holds about SHINGLES shingles (texts fall into
    blocks by hash) or `block` rows, one of signatures `block` rows. `written` gets what can be removed afterwards."""
    each = rows.groupBy(group, "component").agg(F.count("*").alias("of"))
    kinds = each.groupBy(group).agg(F.max_by("component", F.struct("of", "component")).alias("largest"), F.count("*").alias("kinds")).where("kinds > 1").select(group, "largest")
    rows = rows.join(dealt_anew(kinds, group), group).withColumn("probe", F.col("component") != F.col("largest")).drop("largest")
    rows = materialize(rows.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int")), "minhash-crowd")
    written.append(rows)
    held = F.count("*") / block
    if column == "text":
        held = F.greatest(held, F.sum("n") / SHINGLES)
    blocks = dealt_anew(rows.groupBy(group, "class").agg(F.ceil(held).cast("int").alias("blocks")), group)
    keep = [group, "class", "block", "ask", "doc_id", "component", "n"]
    members = rows.join(blocks, [group, "class"]).withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")).withColumn("ask", F.lit(False))
    near = rows.where("probe").withColumn("class", F.explode(F.expr("array(class - 1, class, class + 1)")))
    probes = near.join(blocks, [group, "class"]).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn("ask", F.lit(True))
    met = members.select(*keep).unionByName(probes.select(*keep)).join(sets.select("doc_id", "n", column), ["doc_id", "n"])
    return met.select(*keep, column).repartition(group, "class", "block").sortWithinPartitions(group, "class", "block", "ask")


def agreement(percent: int) -> int:
    """Signature agreements, of HASHES, below which a pair of this similarity is five deviations off."""
    p = percent / 100
    return math.ceil(HASHES * p - 5 * math.sqrt(HASHES * p * (1 - p)))


def _alike(met: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that span, in each block, the pairs of a probe and a member of another component
    whose signatures agree often enough."""
    least = agreement(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, comps, sigs, table, joined = None, [], [], [], None, _Sets()
        for b in batches:
            us, vs = [], []
            for *key, ask, doc, comp, _, sig in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if at != key:
                    at, ids, comps, sigs, table, joined = key, [], [], [], None, _Sets()
                s = np.frombuffer(sig, np.uint32)
                if not ask:
                    ids.append(doc)
                    comps.append(comp)
                    sigs.append(s)
                    continue
                if table is None:
                    table = np.array(ids, np.int64), np.array(comps, np.int64), np.array(sigs, np.uint32).reshape(-1, HASHES)
                i, c, m = table
                for k in i[(c != comp) & ((m == s).sum(1) >= least)].tolist():
                    if joined.join(doc, k):
                        us.append(doc)
                        vs.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return met.mapInArrow(run, "u long, v long")


def _compared(met: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (u, v) that span, in each block, the pairs of a probe and a member of another component
    whose full sets reach the similarity, on hashes and then on the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, comps, sets, texts, table, joined = None, [], [], [], [], None, _Sets()
        for b in batches:
            us, vs = [], []
            for *key, ask, doc, comp, _, text in zip(*b.columns, strict=True):
                key, ask, doc, comp, text = [x.as_py() for x in key], ask.as_py(), doc.as_py(), comp.as_py(), text.as_py().encode()
                if at != key:
                    at, ids, comps, sets, texts, table, joined = key, [], [], [], [], None, _Sets()
                own = _hash_group([text], words)[0]
                if not ask:
                    ids.append(doc)
                    comps.append(comp)
                    sets.append(own)
                    texts.append(text)
                    continue
                if not ids or not len(own):
                    continue
                if table is None:
                    sizes = np.array([len(x) for x in sets])
                    table = np.array(ids, np.int64), np.array(comps, np.int64), sizes, np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)[:-1]])
                i, c, n, flat, starts = table
                where = np.minimum(np.searchsorted(own, flat), len(own) - 1)
                both = np.add.reduceat((own[where] == flat).astype(np.int64), np.minimum(starts, max(len(flat) - 1, 0))) if len(flat) else np.zeros(len(i), np.int64)
                for k in np.flatnonzero((c != comp) & (n > 0) & (100 * both >= percent * (n + len(own) - both))).tolist():
                    if joined.find(comp) != joined.find(int(c[k])) and similar(texts[k], text, words, percent):
                        joined.join(comp, int(c[k]))
                        us.append(doc)
                        vs.append(int(i[k]))
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return met.mapInArrow(run, "u long, v long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, block: int = BLOCK, signatures: int = SIGNATURES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    `block` and `signatures` bound the rows that one comparison holds; they change no result.

    component_id is the smallest id reachable over links of similarity percent/100 or more, kept
    tells whether it is the row's own. Texts that are null, empty or without words have 0 shingles
    and no links. doc_id names a document: rows that repeat an id count as one document with all
    their links. Rows without id take no part: component_id null, kept true, so none is lost.
    """
    spark = df.sparkSession
    docs = pick(df, doc_id=id_col, text=text_col).selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    sigs = materialize(shingled(docs, words), "minhash-shingled")
    named = sigs.where("doc_id is not null and fingerprint is not null").withColumn("print", F.xxhash64("fingerprint"))

    # equal words: one goes on, the others are linked to it
    twins = named.groupBy("print", "fingerprint").agg(F.min("doc_id").alias("v"), F.max("doc_id").alias("most")).where("v < most").drop("most")
    copies = materialize(named.select("doc_id", "print", "fingerprint").join(dealt_anew(twins, "print"), ["print", "fingerprint"]).where("doc_id <> v").select(F.col("doc_id").alias("u"), "v", "fingerprint").distinct(), "minhash-copies")

    # a bucket links its members to its smallest; of an id that repeats with other texts only the copied text stays out
    banded = named.select("doc_id", F.col("n_shingles").alias("n"), "fingerprint", "bands").join(copies.select(F.col("u").alias("doc_id"), "fingerprint"), ["doc_id", "fingerprint"], "left_anti").select("doc_id", "n", F.explode("bands").alias("key"))
    crowded = banded.groupBy("key").agg(F.min("doc_id").alias("center"), F.max("doc_id").alias("most"), F.count("*").alias("size")).where("center < most").drop("most")
    members = materialize(banded.join(dealt_anew(crowded, "key"), "key").where("doc_id <> center"), "minhash-buckets")
    stars = materialize(members.select(F.col("center").alias("u"), F.col("doc_id").alias("v")).distinct(), "minhash-stars")
    # from here on only what shares a bucket with another text is moved
    needed = materialize(stars.select(F.col("u").alias("doc_id")).unionByName(stars.select(F.col("v").alias("doc_id"))).distinct(), "minhash-needed")
    sets = materialize(signed(maybe_in(docs.where("text is not null"), needed).join(needed, "doc_id").select("doc_id", "text"), words), "minhash-sets")
    links = materialize(verified(stars, sets.select("doc_id", "text"), words, percent), "minhash-links")
    label = components(copies.select("u", "v").unionByName(links), "minhash-components")

    # members that their bucket's smallest did not bring together
    labelled = lambda rows: rows.join(label.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    written = [members, stars, needed, sets, links]
    crowd = labelled(members.where("size > 2").select("doc_id", "n", "key"))
    alike = materialize(_alike(_meet(crowd, "key", sets, "signature", percent, signatures, written), percent).distinct(), "minhash-alike")
    written.append(alike)
    if not alike.isEmpty():
        family = components(alike, "minhash-families").select(F.col("node").alias("doc_id"), F.col("component").alias("family"))
        more = materialize(_compared(_meet(labelled(family).join(sets.select("doc_id", "n"), "doc_id"), "family", sets, "text", percent, block, written), words, percent), "minhash-more")
        written += [family, more]
        if not more.isEmpty():
            before = label
            label = components(before.where("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more), "minhash-joined")
            written.append(before)

    out = sigs.select("doc_id", "n_shingles").join(label.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    for x in (*written, copies):
        remove(spark, x)
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2)


#: The exact similarity join in DuckDB's SQL: only texts that share one of their rarest shingles can reach
#: the similarity, and those are compared on their full sets. For doc_ids that don't repeat.
ORACLE = rf"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
s as (select doc_id, list_distinct(case when len(w) >= 2 then list_transform(list_zip(w[1:len(w) - 1], w[2:]), lambda p: p[1] || ' ' || p[2]) else w end) s from w),
one as (select doc_id, len(s) n, unnest(s) x from s),
ranked as (select doc_id, x, n, row_number() over (partition by doc_id order by df, x) r from one join (select x, count(*) df from one group by x) using (x)),
prefix as (select doc_id, x from ranked where r <= n - ceil(0.8 * n) + 1),
pairs as (select distinct a.doc_id u, b.doc_id v from prefix a join prefix b on a.x = b.x and a.doc_id < b.doc_id),
shared as (select u, v, len(a.s) + len(b.s) n, len(list_intersect(a.s, b.s)) c from pairs join s a on a.doc_id = u join s b on b.doc_id = v),
links as (select u, v from shared where 100 * c >= {PERCENT} * (n - c)),
edges as (select u, v from links union all select v, u from links),
reach(u, v) as (select u, v from edges union select r.u, e.v from reach r join edges e on e.u = r.v),
least_ as (select u, min(v) m from reach group by u)
select s.doc_id, len(s.s)::bigint n_shingles, least(s.doc_id, coalesce(m, s.doc_id)) component_id, s.doc_id = least(s.doc_id, coalesce(m, s.doc_id)) kept from s left join least_ on u = s.doc_id
"""
