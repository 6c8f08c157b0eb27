"""A positional inverted index of training texts, searched for the passages of a benchmark.

The index is a written table: documents are gathered into shards of about CHUNK bytes, and a row holds
one word's places in one shard, counted through the shard's documents. A search takes the benchmark's
word windows; each is led by its rarest word over all shards, goes to the shards that have that word, and
there the word's places are intersected with those of the next rarer ones, shifted by their offsets. What
is left are exact occurrences. Words are compared as they are, never by hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, maybe_in, pick, raw_texts, table

#: Words of a window; an item of fewer is one window.
WINDOW = 10
#: Bytes of text in a shard; a longer text is a shard of its own.
CHUNK = 4 << 20
#: Bytes of words that are looked up in memory; more are looked up by a shuffle.
SMALL = 8 << 20
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_in_word = np.zeros(256, bool)
_in_word[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def words_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts, and where each text's begin among them (one more entry at the end)."""
    raw = _lower[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    inside = _in_word[raw]
    edge = np.diff(inside.astype(np.int8), prepend=0)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ends = np.concatenate([[0], np.cumsum(last - first)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(ends), pa.py_buffer(raw[inside]))
    starts = np.cumsum([0, *[len(t) + 1 for t in texts]])
    return words, np.searchsorted(first, starts)


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(values.astype(np.int32)))


_INDEX = "shard long, word string, n int, places array<int>, ids array<long>"


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """The index: (shard, word, n, places) with the n places of a word in a shard, each as the distance
    from the one before; and for each shard a row without word, whose `ids` are its documents and whose
    `places` are where each begins, and where the last one ends. Null and empty texts are documents
    without words, rows that repeat are documents of their own."""
    rows = pick(docs, doc_id=id_col, text=text_col).selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")

    def shard(number: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
        words, begins = words_of(texts)
        coded = words.dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(index, kind="stable")
        counts = np.bincount(index, minlength=len(coded.dictionary))
        ends = np.concatenate([[0], np.cumsum(counts)])
        steps = np.diff(order, prepend=0)
        heads = ends[:-1][counts > 0]
        steps[heads] = order[heads]
        n = len(counts)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(n + 1, number)),
            pa.concat_arrays([coded.dictionary.cast(pa.string()), pa.array([None], pa.string())]),
            pa.array(np.append(counts, len(words)).astype(np.int32)),
            _lists(np.concatenate([steps, begins]), np.append(ends, len(order) + len(begins))),
            pa.ListArray.from_arrays(pa.array([0] * (n + 1) + [len(ids)], pa.int32()), pa.array(ids, pa.int64())),
        ], names=["shard", "word", "n", "places", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), raw_texts(b.column(1)), strict=True):
                if ids and size + len(t) > chunk:
                    yield shard(number, ids, texts)
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t) + 1
        if ids:
            yield shard(number, ids, texts)

    return materialize(rows.mapInArrow(run, _INDEX), "phrases-index")


def windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, phrase) of every window of every item, once each; a phrase is its words, blanks between.
    Items without id or without words have none."""
    rows = pick(items, item=id_col, text=text_col).selectExpr("cast(item as string) item", "cast(text as string) text").where("item is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), raw_texts(b.column(1)), strict=True):
                w = words_of([text])[0].to_pylist()
                found = list({" ".join(w[k : k + window]) for k in range(max(1, len(w) - window + 1))}) if w else []
                for at in range(0, len(found), 10_000):
                    some = found[at : at + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(some), pa.string()), pa.array(some, pa.string())], names=["item", "phrase"])

    return rows.mapInArrow(run, "item string, phrase string").distinct()


def queries(index: DataFrame, phrases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is sent to the shards: (shard, phrase, words, offsets) of each of `phrases` (phrase) in every
    shard that has its rarest word, words rarest first; and the index's rows of words that are asked for.
    A phrase with a word that no text has is asked for nowhere."""
    terms = materialize(phrases.select("phrase", F.posexplode(F.split("phrase", " ")).alias("offset", "word")), "phrases-words")
    asked = materialize(terms.select("word").distinct(), "phrases-asked")
    size = asked.agg(F.sum(F.octet_length("word") + 64)).first()[0] or 0
    postings = index.where("word is not null")
    if size <= SMALL:
        postings = postings.join(F.broadcast(asked), "word", "left_semi")
    else:  # a filter of bounded size first, so that few rows are moved for the join
        postings = maybe_in(postings, asked, "word").join(asked, "word", "left_semi")
    totals = postings.groupBy("word").agg(F.sum("n").alias("total"))
    led = terms.join(totals, "word").groupBy("phrase").agg(F.array_sort(F.collect_list(F.struct("total", "word", "offset"))).alias("_w"))
    led = led.where(F.size("_w") == F.size(F.split("phrase", " "))).select("phrase", F.col("_w.word").alias("words"), F.col("_w.offset").alias("offsets"), F.col("_w")[0]["word"].alias("word"))
    return postings.select("shard", "word").join(led, "word").select("shard", "phrase", "words", "offsets"), postings


def _starts(places: list[np.ndarray], offsets: list[int]) -> np.ndarray:
    """Where a phrase begins: the intersection of its words' places, each shifted by its offset."""
    found = places[0] - offsets[0]
    for p, o in zip(places[1:], offsets[1:], strict=True):
        if not len(found):
            break
        p = p - o
        found = found[p[np.minimum(np.searchsorted(p, found), len(p) - 1)] == found]
    return found


def spans_near(places: dict[str, np.ndarray], words: list[str], within: int) -> list[tuple[int, int]]:
    """(start, length) of the shortest spans, at most `within` words long, that hold every word as often
    as `words` does. Only surroundings of the first (rarest) word are looked at that have all others."""
    need = {w: words.count(w) for w in words}
    anchors = places[words[0]]
    for w in need:
        p = places[w]
        k = np.searchsorted(p, anchors - within + 1)
        anchors = anchors[(k < len(p)) & (p[np.minimum(k, len(p) - 1)] < anchors + within)]
    if not len(anchors):
        return []
    near = []
    for w in need:
        p = places[w]
        k = np.searchsorted(anchors, p)
        left, right = anchors[np.maximum(k - 1, 0)], anchors[np.minimum(k, len(anchors) - 1)]
        near += [(x, w) for x in p[(np.abs(p - left) < within) | (np.abs(right - p) < within)].tolist()]
    near.sort()
    held, lacking, begin, out = dict.fromkeys(need, 0), len(words), 0, []
    for x, w in near:
        held[w] += 1
        lacking -= held[w] <= need[w]
        while held[near[begin][1]] > need[near[begin][1]]:
            held[near[begin][1]] -= 1
            begin += 1
        if not lacking:
            start = near[begin][0]
            if x - start < within:
                out.append((start, x - start + 1))
            held[near[begin][1]] -= 1
            lacking += 1
            begin += 1
    return out


class _Shard:
    """One shard while its phrases are looked for."""

    def __init__(self):
        self.begins, self.ids, self.steps, self.held = np.zeros(1, np.int64), [], {}, {}

    def places(self, word: str) -> np.ndarray:
        if word not in self.held:
            self.held[word] = np.cumsum(self.steps[word])
        return self.held[word]

    def inside(self, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The document of each span, and whether it holds all of it."""
        doc = np.searchsorted(self.begins, start, "right") - 1
        return doc, (start >= 0) & (start + length <= self.begins[np.clip(doc + 1, 0, len(self.begins) - 1)])


def _by_shard(index: DataFrame, asked: DataFrame, postings: DataFrame) -> DataFrame:
    """Each shard's documents, then its postings, then what is asked of it, in one task each."""
    empty = lambda kind: F.lit(None).cast(kind)
    docs = index.where("word is null").select("shard", F.lit(0).alias("kind"), empty("string").alias("word"), "places", "ids", empty("array<string>").alias("words"), empty("array<int>").alias("offsets"))
    lists = postings.select("shard", F.lit(1).alias("kind"), "word", "places", empty("array<long>").alias("ids"), empty("array<string>").alias("words"), empty("array<int>").alias("offsets"))
    sent = asked.select("shard", F.lit(2).alias("kind"), F.col("phrase").alias("word"), empty("array<int>").alias("places"), empty("array<long>").alias("ids"), "words", "offsets")
    return docs.unionByName(lists).unionByName(sent).repartition("shard").sortWithinPartitions("shard", "kind")


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, _Shard, str | None, list[str], list[int]]]:
    """(number, shard, phrase, words, offsets) of what is asked, shard by shard; phrase None at a shard's end."""
    at, now = None, _Shard()
    for b in batches:
        places, ids = b.column(3), b.column(4)
        for k, (number, kind, word, words, offsets) in enumerate(zip(*(b.column(c).to_pylist() for c in (0, 1, 2, 5, 6)), strict=True)):
            if number != at:
                if at is not None:
                    yield at, now, None, [], []
                at, now = number, _Shard()
            if kind == 0:
                now.begins, now.ids = places[k].values.to_numpy(zero_copy_only=False).astype(np.int64), ids[k].as_py()
            elif kind == 1:
                now.steps[word] = places[k].values.to_numpy(zero_copy_only=False).copy()  # the batch itself goes
            elif all(w in now.steps for w in words):
                yield at, now, word, words, offsets
    if at is not None:
        yield at, now, None, [], []


def exact(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """(shard, place, doc_id, n_words, n_hit, phrases) of every document: its words, those inside any
    occurrence of one of `phrases` (phrase, distinct), and the phrases that occur in it."""
    asked, postings = queries(index, phrases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit, found = [], {}
        for number, shard, phrase, words, offsets in _shards(batches):
            if phrase is not None:
                start = _starts([shard.places(w) for w in words], offsets)
                doc, ok = shard.inside(start, np.full(len(start), len(words)))
                hit += [(x, len(words)) for x in start[ok].tolist()]
                for d in np.unique(doc[ok]).tolist():
                    found.setdefault(d, []).append(phrase)
                continue
            deep = np.zeros(int(shard.begins[-1]) + 1, np.int64)
            if hit:
                x = np.array(hit)
                np.add.at(deep, x[:, 0], 1)
                np.add.at(deep, x[:, 0] + x[:, 1], -1)
            covered = np.concatenate([[0], np.cumsum(np.cumsum(deep) > 0)])
            n = len(shard.ids)
            lists = [found.get(d, []) for d in range(n)]
            columns = [np.full(n, number), np.arange(n, dtype=np.int32), pa.array(shard.ids, pa.int64()), np.diff(shard.begins), covered[shard.begins[1:]] - covered[shard.begins[:-1]], pa.array(lists, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shard", "place", "doc_id", "n_words", "n_hit", "phrases"])
            hit, found = [], {}

    return _by_shard(index, asked, postings).mapInArrow(run, "shard long, place int, doc_id long, n_words long, n_hit long, phrases array<string>")


def near(index: DataFrame, phrases: DataFrame, within: int) -> DataFrame:
    """(doc_id, phrase, start, length) of the shortest spans of a document, at most `within` words long, that
    hold all words of one of `phrases` (phrase, distinct), in any order and each as often as the phrase
    has it; an exact occurrence is one of them. `start` counts the document's words from 0."""
    asked, postings = queries(index, phrases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, shard, phrase, words, _ in _shards(batches):
            spans = spans_near({w: shard.places(w) for w in words}, words, within) if phrase is not None else []
            if not spans:
                continue
            start, length = np.array(spans).T
            doc, ok = shard.inside(start, length)
            ids = pa.array([shard.ids[d] for d in doc[ok].tolist()], pa.int64())
            columns = [ids, pa.array([phrase] * len(ids), pa.string()), pa.array(start[ok] - shard.begins[doc[ok]]), pa.array(length[ok])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "phrase", "start", "length"])

    return _by_shard(index, asked, postings).mapInArrow(run, "doc_id long, phrase string, start long, length long")


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated) of every row of `docs` (doc_id, text) against
    `items` (item_id, text): its words, those inside an occurrence of any item's window, and the items of
    those windows, sorted as strings.

    Null and empty texts have no words; rows that repeat an id, or have none, are documents of their own.
    Items without id or words are ignored, and those that repeat an id are one. Empty tables are fine;
    other columns don't matter.
    """
    index = build(docs, chunk=chunk)
    of_items = materialize(windows(items, window=window), "phrases-windows")
    found = materialize(exact(index, of_items.select("phrase").distinct()), "phrases-found")
    each = found.select("shard", "place", F.explode("phrases").alias("phrase"))
    # a passage in very many documents meets its items in a join of two plain exchanges, which can be split
    named = each.join(of_items, "phrase").groupBy("shard", "place").agg(F.array_sort(F.collect_set("item")).alias("items"))
    out = found.drop("phrases").join(named, ["shard", "place"], "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated"))


def op13_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


#: The same in DuckDB's SQL: every run of words of a document, of each length that windows have, joined
#: with the windows. For doc_ids that don't repeat.
ORACLE = rf"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
i as (select item_id::varchar item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark where item_id is not null),
v as (select distinct item, array_to_string(w[k:k + {WINDOW} - 1], ' ') p, least(len(w), {WINDOW}) n from i, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) t(k) where len(w) > 0),
lengths as (select distinct n from v),
runs as (select doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') p from d, lengths, unnest(range(1, len(w) - n + 2)) t(k)),
met as (select distinct doc_id, k, n, item from runs join v using (p, n)),
hits as (select doc_id, count(distinct x) n_hit from met, unnest(range(k, k + n)) t(x) group by 1),
named as (select doc_id, count(distinct item) n_items, string_agg(distinct item, ',' order by item) items from met group by 1)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items, sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join hits using (doc_id) left join named using (doc_id)
"""
