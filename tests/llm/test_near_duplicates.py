"""Near-duplicates, components and the pipeline."""

import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from pulsegrid.llm import bpe_automaton, minhash_dedup, packing, quality_nbsvm, secret_scan
from pulsegrid.llm.components import components


def brute(rows, words):
    """(component, size) by comparing every pair."""
    sets = {i: minhash_dedup.shingle_set((t or "").encode(), words) for i, t in rows}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: (find(i), len(sets[i])) for i in ids}


def result(df):
    return {r.doc_id: (r.component_id, r.n_shingles) for r in df.collect()}


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_by_brute_force(documents, words):
    want = brute([(r.doc_id, r.text) for r in documents.collect()], words)
    assert result(minhash_dedup.near_duplicates(documents, words=words)) == want


def test_near_duplicates_sql(spark, same):
    """On the larger table, so that groups of many members are in it."""
    import duckdb

    want = duckdb.sql(minhash_dedup.ORACLE.replace("from documents", "from '/root/testdata/sf0.01/documents.parquet'")).fetchall()
    got = minhash_dedup.op3_minhash_dedup(spark, "/root/testdata/sf0.01").collect()
    assert sorted(map(tuple, got)) == sorted(want) and sum(not r.kept for r in got) > 50


def test_a_chain_that_no_star_brings_together(spark):
    """Each text is near its neighbours only, and the smallest ids are no centers."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    rows, text = [], words[:100]
    for i in range(120):
        rows.append((i * 37 % 120, " ".join(text)))
        text = [*text]
        for _ in range(3):
            text[rng.randrange(100)] = rng.choice(words)
    rows += [(1000 + k, rows[5][1]) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(minhash_dedup.near_duplicates(df, words=2)) == brute(rows, 2)


def test_an_id_that_repeats_keeps_the_links_of_all_its_texts(spark):
    """One text of id 2 equals that of 1, another is near that of 3; 4 is like none."""
    a, b, c = (" ".join(f"{k}{i}" for i in range(60)) for k in "abc")
    df = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b + " more"), (4, c)], "doc_id long, text string")
    rows = minhash_dedup.near_duplicates(df, words=2).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [(1, 1), (2, 1), (2, 1), (3, 1), (4, 4)]


def test_awkward(awkward, nothing):
    rows = minhash_dedup.near_duplicates(awkward, words=2).collect()
    assert len(rows) == awkward.count()
    got = {r.doc_id: r for r in rows}
    assert got[9].component_id == 8 and not got[9].kept and got[8].kept
    assert [got[i].n_shingles for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert all(got[i].component_id == i for i in (1, 2, 3)) and got[None].component_id is None and got[None].kept
    assert sum(r.doc_id == 4 and r.kept for r in rows) == 2
    assert minhash_dedup.near_duplicates(nothing).count() == 0


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 9), (9, 9), (20, 21), (21, 20), (None, 3), *[(100 + k, 101 + k) for k in range(60)], *[(200, 300 + k) for k in range(50)]]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {k: got[k] for k in (3, 4, 5, 9, 20, 21, 160, 349)} == {3: 3, 4: 3, 5: 3, 9: 3, 20: 20, 21: 20, 160: 100, 349: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_pipeline(spark, sf_dir, documents):
    stages = dict(corpus_pipeline.STAGES)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "packing"]
    good = stages["quality"](spark, documents, sf_dir)
    assert good.columns == documents.columns and 0 < good.count() < documents.count()
    once = stages["near_duplicates"](spark, documents, sf_dir)
    want = brute([(r.doc_id, r.text) for r in documents.collect()], 5)
    assert {r.doc_id for r in once.collect()} == {i for i, (c, _) in want.items() if c == i} and once.schema == documents.schema
    clean = stages["secrets"](spark, documents, sf_dir)
    assert clean.schema == documents.schema and clean.count() == documents.count()
    assert clean.where(F.col("text").rlike("AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}") | (F.length("text") != F.col("n_chars"))).count() == 0
    packed = stages["packing"](spark, clean, sf_dir).select("bucket_len", F.explode(F.arrays_zip("doc_ids", "lengths", "input_ids")).alias("r")).cache()
    want = bpe_automaton.encode(clean).agg(F.count("*"), F.sum(F.size("ids"))).first()
    assert packed.select("r.doc_ids").distinct().count() == want[0] and packed.agg(F.sum("r.lengths")).first()[0] == want[1]
    assert packed.where("bucket_len != size(r.input_ids) or r.lengths > bucket_len").count() == 0
    found = corpus_pipeline.run(spark, sf_dir)
    assert 0 < found.select(F.explode("doc_ids")).distinct().count() < once.count()


def test_pipeline_by_brute_force(spark, sf_dir, documents):
    """All four stages once more, row by row: which documents stay, and the token ids of each in the end."""
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    rows = documents.select("doc_id", "text").collect()
    model = quality_nbsvm.train(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = [(r.doc_id, r.text) for r in rows if model.score(r.text) >= quality_nbsvm.REJECT_BELOW]
    kept = {i for i, (c, _) in brute(good, 5).items() if c == i}
    found = secret_scan.scan(documents.select("doc_id", "text"), secret_scan.train(secret_scan.default_samples(spark)), out_col="s")
    want = {}
    for r in found.collect():
        if r.doc_id in kept:
            text = r.text or ""
            hidden = {k for s in r.s for k in range(s.start, s.end)}
            runs = itertools.groupby(enumerate(text), lambda kx: kx[0] in hidden)  # every stretch that spans cover is one mark
            clean = "".join(secret_scan.MARK if h else "".join(x for _, x in run) for h, run in runs)
            want[r.doc_id] = library.encode(clean, add_special_tokens=False).ids
    got = {}
    for b in corpus_pipeline.run(spark, sf_dir).collect():
        assert len(b.doc_ids) * b.bucket_len <= packing.BUDGET and all(len(x) == b.bucket_len for x in b.input_ids)
        for i, p, n, ids in zip(b.doc_ids, b.pieces, b.lengths, b.input_ids, strict=True):
            assert not any(ids[n:]) and (i, p) not in got
            got[i, p] = ids[:n]
    joined = {}
    for (i, _), ids in sorted(got.items()):
        joined.setdefault(i, []).extend(ids)
    assert joined == want and 0 < len(joined) < len(rows)


def test_scratch_can_be_cleared(spark):
    from pulsegrid.llm.common import _own_scratch, clear_scratch, materialize

    materialize(spark.range(3), "some")
    clear_scratch(spark)
    p = spark._jvm.org.apache.hadoop.fs.Path(_own_scratch(spark))
    assert not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def test_pipeline_stages_take_awkward_rows(spark, sf_dir, awkward, nothing):
    for docs in (awkward, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf_dir).columns == docs.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count()


def crowd(n, seed=7):
    """Texts of one long common passage and own parts, so that buckets have many members of many components."""
    rng = random.Random(seed)
    common = [f"c{k}" for k in range(120)]
    out = []
    for i in range(n):
        own = [f"o{rng.randrange(60)}" for _ in range(rng.choice([20, 30, 45]))]
        out.append((i, " ".join([*common, *own])))
        if i % 7 == 0:
            out.append((n + i, " ".join([*common, *own[:-1]])))
    return out


def test_small_blocks_change_nothing(spark, monkeypatch):
    rows = crowd(150)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 2)
    assert len({c for c, _ in want.values()}) > 20
    for block, signatures in ((512, 8192), (2, 3)):
        assert result(minhash_dedup.near_duplicates(df, words=2, block=block, signatures=signatures)) == want
    monkeypatch.setattr(minhash_dedup, "SHINGLES", 40)
    assert result(minhash_dedup.near_duplicates(df, words=2)) == want


def test_hot_keys_can_be_split(spark):
    """A join of a table with its own totals has two plain exchanges, so a hot key is split."""
    from pulsegrid.llm.common import dealt_anew

    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor")}
    try:
        for k, v in zip(kept, ("-1", "4k", "2k", "1.5"), strict=True):
            spark.conf.set(k, v)
        rows = spark.range(0, 200_000, 1, 16).selectExpr("if(id % 3 = 0, 7L, id) u", "id v")
        least = dealt_anew(rows.groupBy("u").agg(F.min("v").alias("m")), "u")
        found = rows.join(least, "u")
        assert found.agg(F.sum("m")).first()[0] == sum(0 if i % 3 == 0 else min(i, 0 if i == 7 else i) for i in range(200_000))
        found.write.format("noop").mode("overwrite").save()
        df = rows.join(least, "u").select("v", "m")
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_pipeline_stages_take_any_column_names(spark, sf_dir):
    docs = spark.createDataFrame([(1, "a b c d e f", 1, "x"), (2, "a b c d e f", 2, "y"), (3, "token=abcdefgh", 3, "z")], "doc_id long, text string, `a.b` int, _spans0 string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, sf_dir)
        assert got.columns == docs.columns and got.collect() is not None


def _thue_morse(n):
    """The sequence of n letters, and its complement: words that every polynomial hash modulo 2^64 takes for equal."""
    bits = [bin(k).count("1") % 2 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_words_that_hash_alike_are_no_links(spark, n):
    """As whole texts, inside near texts, and among a crowd of copies."""
    one, other = _thue_morse(n)
    frame = " ".join(f"w{k}" for k in range(12))
    rows = [(1, one), (2, other), (3, f"{one} {one}"), (4, f"{other} {other}"), (10, f"{frame} {one} {one} {one} {one}"), (11, f"{frame} {other} {other} {other} {other}")]
    mixed = [" ".join((one, other)[(j >> k) & 1] for k in range(8)) for j in range(40)]
    rows += [(100 + j, t) for j, t in enumerate(mixed)] + [(200 + j, one) for j in range(30)] + [(300 + j, other) for j in range(30)]
    for words in (1, 2, 5):
        sets = {i: minhash_dedup.shingle_set(t.encode(), words) for i, t in rows}
        up = {i: i for i in sets}
        for i in sorted(sets):
            for j in sorted(sets):
                if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    a, b = up[i], up[j]
                    up = {k: min(a, b) if v in (a, b) else v for k, v in up.items()}
        found = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), words=words, block=8, signatures=8).collect()
        assert {r.doc_id: (r.component_id, r.n_shingles) for r in found} == {i: (up[i], len(sets[i])) for i in sets}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "b", "é", "cc"]), max_size=9), st.lists(st.sampled_from(["a", "B", "b", "é", "cc"]), max_size=9), st.integers(1, 5), st.sampled_from([50, 80]))
def test_similar_is_what_sets_of_words_say(a, b, words, percent):
    x, y = "\t ".join(a).encode(), " ".join(b).encode()
    s, t = minhash_dedup.shingle_set(x, words), minhash_dedup.shingle_set(y, words)
    assert minhash_dedup.similar(x, y, words, percent) == (bool(s and t) and 100 * len(s & t) >= percent * len(s | t))
