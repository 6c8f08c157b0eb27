"""Packing, sharding, fixity, and the two vector searches."""

from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegrid.llm import ann_ivfpq, bpe_automaton, packing, sharding, topk_kdtree, warc_fixity

from .conftest import AWKWARD


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 9), min_size=1, max_size=8), st.integers(1, 5))
def test_boundaries_by_brute_force(hist, k):
    bins = sorted(hist)
    pad = lambda ends: sum(hist[b] * (min(e for e in ends if e >= b) - b) for b in bins)
    got = packing.boundaries(bins, [hist[b] for b in bins], k)
    best = min(pad([*c, bins[-1]]) for c in combinations(bins[:-1], min(k, len(bins)) - 1))
    assert pad(got) == best and len(got) == min(k, len(bins))


def test_packing_sql(spark, sf_dir, same):
    same(packing.op1_length_buckets(spark, sf_dir), packing.pack_sql())


def test_packing_awkward(awkward, nothing):
    rows = packing.pack(packing.word_counts(awkward)).collect()
    long = sorted((r.start, r.n_tokens) for r in rows if r.doc_id == 5)
    assert sum(n for _, n in long) == 150_000 and long[-1][0] + long[-1][1] == 150_000
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {0} and sum(r.doc_id is None for r in rows) == 1
    assert sum(r.doc_id == 4 for r in rows) == 2
    seen = {}
    for r in rows:
        assert r.n_tokens + r.padding == r.bucket_len
        seen.setdefault((r.bucket, r.batch), []).append(r)
    for (_, _), b in seen.items():
        assert sorted(r.slot for r in b) == list(range(len(b))) and len(b) * b[0].bucket_len <= packing.BUDGET
    assert packing.pack(packing.word_counts(nothing)).count() == 0


def test_token_batches_hold_all_ids(awkward, nothing):
    """Real token ids, padded and batched; put together again they are the texts' tokens."""
    coded = bpe_automaton.encode(awkward)
    want = sorted((str(r.doc_id), tuple(r.ids)) for r in coded.collect())
    got = {}
    for b in packing.token_batches(coded, pad=-1, max_length=1000, budget=4000).collect():
        assert all(len(x) == b.bucket_len for x in b.input_ids) and len(b.input_ids) * b.bucket_len <= max(4000, b.bucket_len)
        for i, p, n, ids in zip(b.doc_ids, b.pieces, b.lengths, b.input_ids, strict=True):
            assert set(ids[n:]) <= {-1} and -1 not in ids[:n]
            got.setdefault(str(i), []).append((p, ids[:n]))
    assert sum(len(x) for v in got.values() for _, x in v) == sum(len(x) for _, x in want)
    once = {i: t for i, t in want}
    assert all([x for _, p in sorted(v) for x in p] == list(once[i]) for i, v in got.items() if i != "4")
    assert packing.token_batches(bpe_automaton.encode(nothing)).count() == 0


def _capacity(groups, shards):
    """The smallest one for which greedy filling is enough."""
    low, high = max(groups), sum(groups)
    while low < high:
        mid, used, room = (low + high) // 2, 1, (low + high) // 2
        for g in groups:
            if g > room:
                used, room = used + 1, mid
            room -= g
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


@pytest.mark.parametrize("table", ["documents", "awkward"])
def test_sharding_by_brute_force(request, spark, table):
    from pyspark.sql import functions as F

    docs = request.getfixturevalue(table)
    rows = sharding.shard(docs).collect()
    by = {}
    for r in docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"), F.substring(F.md5(F.coalesce("text", F.lit(""))), 1, 16).alias("h")).collect():
        by.setdefault(r.h, []).append(len(r.t.encode()) + 1)
    sizes = {}
    for r in rows:
        sizes.setdefault(r.shard, []).append(r)
    got = max(sum(r.size for r in v) for v in sizes.values())
    assert got == _capacity([sum(by[h]) for h in sorted(by)], 8)
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in sizes.values())
    assert len(rows) == docs.count() and len({r.shard for r in rows if r.doc_id in (1, 2)}) <= (1 if table == "awkward" else 2)


def test_sharding_sql(spark, sf_dir, same):
    same(sharding.op7_minimax_shards(spark, sf_dir), sharding.ORACLE)


def test_sharding_nothing(nothing):
    assert sharding.shard(nothing).count() == 0


def test_fixity_sql(spark, sf_dir, same):
    same(warc_fixity.op6_warc_fixity(spark, sf_dir), warc_fixity.ORACLE)


def test_fixity_finds_all_damage(spark, tmp_path):
    page = "page_id long, url string, html string, hash string, at long"
    pages = spark.createDataFrame([*[(i, f"u{i}", "x" * (i % 50), "h", 1) for i in range(5000)], (None, None, None, None, None), (None, "other", None, None, None), (7, "u7", "again", "h", 1), (7, "u7", "again", "h", 1), (-5, "", "", "h", 1)], page)
    ours = warc_fixity.records(pages)
    same = warc_fixity.audit(ours, ours.repartition(3))
    assert same.where("status <> 'ok' or root <> replica_root").count() == 0 and same.count() == 5005
    theirs = ours.where("coalesce(page_id, -1) <> 4999").selectExpr("page_id", "if(page_id in (0, 4097), concat(record, '!'), record) record").unionByName(spark.createDataFrame([(9999, "new")], "page_id long, record string"))
    got = warc_fixity.audit(ours, theirs)
    assert sorted((r.page_id, r.status) for r in got.where("status <> 'ok'").collect()) == [(0, "corrupt"), (4097, "corrupt"), (4999, "missing"), (9999, "extra")]
    assert got.where("root = replica_root").count() == 0
    none = ours.where("false")
    assert warc_fixity.audit(none, none).count() == 0 and warc_fixity.audit(none, ours.limit(3)).where("status = 'extra'").count() == 3
    assert warc_fixity.audit(ours.limit(3), none).where("status = 'missing'").count() == 3


def test_fixity_of_repeated_ids(spark):
    """Equal records of an id are matched first, whatever the order; only what is left is damage."""
    make = lambda *rows: spark.createDataFrame(list(rows), "page_id long, record string")
    ours = make((1, "a"), (1, "b"), (1, "b"), (1, "c"), (2, "z"), (None, "n"), (None, "n"))
    theirs = make((1, "c"), (1, "x"), (1, "b"), (2, "z"), (2, "z"), (None, "n"), (3, "q"))
    got = sorted((str(r.page_id), r.status) for r in warc_fixity.audit(ours, theirs).collect())
    assert got == [("1", "corrupt"), ("1", "missing"), ("1", "ok"), ("1", "ok"), ("2", "extra"), ("2", "ok"), ("3", "extra"), ("None", "missing"), ("None", "ok")]


def test_warc_files_match_the_manifest(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc_fixity, "FILE_RECORDS", 64)
    pages = spark.createDataFrame([*[(i, f"u{i}", "é\r\n\r\nWARC/1.1\r\n" * (i % 5)) for i in range(300)], (None, None, None), (7, "u", "again")], "page_id long, url string, html string").repartition(3)
    recs = warc_fixity.records(pages)
    warc_fixity.write_files(recs, f"file://{tmp_path}/w")
    back = warc_fixity.read_files(spark, f"file://{tmp_path}/w")
    assert sorted(map(str, back.select("page_id", "record").collect())) == sorted(map(str, recs.collect()))
    places = lambda df: sorted((str(r.page_id), r.file, r.offset) for r in df.select("page_id", "file", "offset").collect())
    assert places(back) == places(warc_fixity.manifest(recs)) and len(list(tmp_path.glob("w/file=*/part-*"))) == 5
    assert warc_fixity.audit(recs, back.select("page_id", "record")).where("status <> 'ok'").count() == 0
    text = next(tmp_path.glob("w/file=0/part-*")).read_bytes()
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Date: ") and text.endswith(b"\r\n\r\n")


def test_layout_of_files(spark, tmp_path, monkeypatch):
    """Real files and offsets: records that change places, files in another order and offsets that lie have the
    same contents and another layout, and only their places are told."""
    monkeypatch.setattr(warc_fixity, "FILE_RECORDS", 100)
    pages = spark.createDataFrame([(i * i, f"u{i}", "x" * (i % 9 + 1)) for i in range(700)], "page_id long, url string, html string").repartition(3)
    recs = warc_fixity.records(pages)
    warc_fixity.write_files(recs, f"file://{tmp_path}/w")
    back = warc_fixity.read_files(spark, f"file://{tmp_path}/w").cache()
    intact = warc_fixity.audit(recs, back)
    assert intact.where("status <> 'ok' or root <> replica_root or layout_root <> replica_layout_root").count() == 0 and intact.count() == 700
    ours = warc_fixity.manifest(recs)
    assert warc_fixity.displaced(ours, warc_fixity.manifest(back)).count() == 0
    a, b = (r for r in back.where("file = 3").orderBy("offset").collect()[4:6])
    pairs = {
        "swapped": (back.selectExpr("page_id", "record", "file", f"case when file = 3 and offset = {a.offset} then {a.offset + len(b.record.encode())} when file = 3 and offset = {b.offset} then {a.offset} else offset end offset"), {(3, a.page_id), (3, b.page_id)}),
        "reordered": (back.selectExpr("page_id", "record", "case file when 1 then 2 when 2 then 1 else file end file", "offset"), {(i // 100, i * i) for i in range(100, 300)}),
        "lying": (back.selectExpr("page_id", "record", "file", "offset + if(file = 6 and page_id > 680 * 680, 1, 0) offset"), {(6, i * i) for i in range(681, 700)}),
    }
    for name, (replica, want) in pairs.items():
        found = warc_fixity.audit(recs, replica)
        assert found.where("status <> 'ok' or root <> replica_root or layout_root = replica_layout_root").count() == 0, name
        told = warc_fixity.displaced(ours, warc_fixity.manifest(replica)).collect()
        assert {(r.file, r.page_id) for r in told if r.side == "ours"} == want, name
        assert {r.page_id for r in told if r.side == "theirs"} == {i for _, i in want}, name


def test_ids_of_63_bits_need_few_levels(spark):
    ids = [(1 << 62) + k * 7_000_000_007 * (-1) ** k for k in range(2000)]
    recs = spark.createDataFrame([(i, f"record {i}") for i in ids], "page_id long, record string").repartition(4)
    assert warc_fixity.depth_for(2000) == 1 and warc_fixity.depth_for(64**3 + 1) == 3
    leaf = warc_fixity.copies(warc_fixity.manifest(recs))
    levels = [t.count() for t in warc_fixity.tree(leaf, warc_fixity.depth_for(2000), "levels")]
    assert levels == [2000, 64, 1]
    hurt = recs.selectExpr("page_id", f"if(page_id = {ids[77]}, 'other', record) record")
    assert [(r.page_id, r.status) for r in warc_fixity.audit(recs, hurt).where("status <> 'ok'").collect()] == [(ids[77], "corrupt")]


VECTORS = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (20, [0.0, 1.0]), (50, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (9, [])]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in VECTORS], "vec_id long, embedding array<float>, list int, shard string")


def test_ann_recall(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], float)
    got = {}
    for r in ann_ivfpq.op2_ann_ivfpq(spark, sf_dir).orderBy("query_id", "rank").collect():
        assert abs(r.score - x[r.query_id] @ x[r.vec_id]) < 1e-9
        got.setdefault(r.query_id, []).append(r.vec_id)
    hits = []
    for q in range(0, len(x), 20):
        s = x @ x[q]
        s[q] = -9
        hits.append(len(set(np.argsort(-s, kind="stable")[:20].tolist()) & set(got[q])) / 20)
    assert len(got) == len(hits) and np.mean(hits) >= 0.9


def _near(x, asked, k):
    """Exact neighbours, by the same sums."""
    out = []
    for q in asked:
        s = (x * x[q]).sum(1)
        order = [i for i in np.lexsort((np.arange(len(x)), -s)).tolist() if i != q][:k]
        out += [(q, n + 1, i, float(s[i])) for n, i in enumerate(order)]
    return out


def _clusters(n, seed=8):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(60, 24))
    middles /= np.linalg.norm(middles, axis=1)[:, None]
    x = middles[rng.integers(60, size=n)] + rng.normal(size=(n, 24)) * 0.05
    return x / np.linalg.norm(x, axis=1)[:, None]


def test_ann_of_clusters_scans_few_rows(spark):
    x = _clusters(6000)
    asked = list(range(0, 6000, 100))
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>").repartition(4)
    got = {(r.query_id, r.vec_id) for r in ann_ivfpq.search(df, lambda i: i % 100 == 0, block=500).collect()}
    want = {(q, i) for q, _, i, _ in _near(x, asked, 20)}
    assert len(got & want) >= 0.9 * len(want) and len(got) == len(want)
    model = ann_ivfpq.fit(x, len(x))
    sizes = np.bincount(model.lists(x), minlength=len(model.centroids))
    assert np.mean([sizes[k].sum() for k in ann_ivfpq.probed(model, x[asked], sizes, 20, None)]) < 0.2 * len(x)


def _queries_elsewhere(rng):
    """Rows in clusters, asked for from anywhere."""
    x = _clusters(4000)
    x[::20] = rng.normal(size=(200, 24))
    return x / np.linalg.norm(x, axis=1)[:, None]


def _tight(rng):
    """Clusters that are smaller than what a code tells apart."""
    x = rng.normal(size=(20, 64))[rng.integers(20, size=8000)] * 0.125 + rng.normal(size=(8000, 64)) * 0.0025
    return x / np.linalg.norm(x, axis=1)[:, None]


def _wide(rng):
    """Many components for each part of a code."""
    x = rng.normal(size=(3000, 384))
    return x / np.linalg.norm(x, axis=1)[:, None]


def _few_long(rng):
    """A few long rows, near to half of all queries, of which the drawn sample has hardly any."""
    x = rng.normal(size=(8000, 24))
    x[rng.choice(8000, 40, replace=False)] *= 50
    return x


@pytest.mark.parametrize("made", [_queries_elsewhere, _tight, _wide, _few_long])
def test_ann_recall_on_other_rows(spark, made, monkeypatch):
    monkeypatch.setattr(ann_ivfpq, "LEAST_SAMPLE", 2048)
    monkeypatch.setattr(ann_ivfpq, "SAMPLE_A_LIST", 4)
    x = made(np.random.default_rng(6))
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>").repartition(4)
    got = {(r.query_id, r.vec_id) for r in ann_ivfpq.search(df, lambda i: i % 20 == 0).collect()}
    want = {(q, i) for q, _, i, _ in _near(x, range(0, len(x), 20), 20)}
    assert len(got & want) >= 0.93 * len(want) and len(got) == len(want)


@pytest.mark.parametrize("block", [64, 4096])
def test_ann_can_be_exact(spark, block):
    x = _clusters(700, 3)
    x[100:350] = x[5]
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>").repartition(3)
    got = [tuple(r) for r in ann_ivfpq.search(df, lambda i: i % 35 == 0, probes=0, rerank=None, block=block).orderBy("query_id", "rank").collect()]
    want = _near(x, range(0, 700, 35), 20)
    assert [g[:3] for g in got] == [w[:3] for w in want] and max(abs(g[3] - w[3]) for g, w in zip(got, want, strict=True)) < 1e-12


def test_ann_awkward(spark, vectors):
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann_ivfpq.search(vectors, lambda i: i % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 50, 0.5), (0, 4, 20, 0.0), (20, 1, 50, 0.5), (20, 2, 0, 0.0), (20, 3, 1, 0.0), (20, 4, 2, 0.0)]
    assert ann_ivfpq.search(vectors.where("false"), lambda i: i % 20 == 0).count() == 0


def test_ann_ties_of_very_many_equal_vectors(spark):
    """More copies than a block holds: the smallest ids of them are the nearest, whoever asks."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(9000, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    copies = np.sort(rng.choice(9000, 5000, replace=False))
    x[copies] = x[copies[0]]
    asked = set(copies[::1000].tolist())
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(4)
    got = {}
    for r in ann_ivfpq.search(table, lambda i: i.isin(list(asked))).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [i for i in copies.tolist() if i != q][:20] for q in asked}


def test_kdtree_sql(spark, sf_dir, same):
    same(topk_kdtree.op10_topk_kdtree(spark, sf_dir), topk_kdtree.ORACLE)


def test_kdtree_awkward(vectors):
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in topk_kdtree.search(vectors, lambda i: i % 50 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 65536), (0, 2, 2, 65536), (0, 3, 50, 32768), (0, 4, 4, 0), (0, 5, 20, 0), (50, 1, 0, 32768), (50, 2, 1, 32768), (50, 3, 2, 32768), (50, 4, 20, 32768), (50, 5, 4, 0)]
    assert topk_kdtree.search(vectors.where("false"), lambda i: i % 50 == 0).count() == 0


@pytest.mark.parametrize("spread", [3, 1 << 30])
def test_kdtree_by_brute_force(spread):
    rng = np.random.default_rng(1)
    x = rng.integers(-spread, spread + 1, (900, 6))
    tree = topk_kdtree.KdTree(np.arange(900), x)
    for q in range(0, 900, 90):
        s = [(-int(a), i) for i, a in enumerate((x @ x[q]).tolist()) if i != q]
        want = [(-a, i) for a, i in sorted(s)[:5]]
        assert tree.search(q, x[q], 5, -(1 << 62)) == want
        assert tree.search(q, x[q], 5, want[-1][0]) == want


def _exact(x, asked, k):
    out = []
    rows = [[int(c) for c in r] for r in x]
    for q in asked:
        s = sorted((-sum(a * b for a, b in zip(rows[q], rows[i], strict=True)), i) for i in range(len(rows)) if i != q)
        out += [(q, n + 1, i, -v) for n, (v, i) in enumerate(s[:k])]
    return out


@pytest.mark.parametrize("spread", [1, 1 << 22, 1 << 29])
def test_kdtree_of_many_shards(spark, spread):
    """Shards of 40 rows, a third of all rows equal, small and big components."""
    rng = np.random.default_rng(4)
    x = rng.integers(-spread, spread + 1, (600, 5))
    x[rng.choice(600, 200, replace=False)] = x[0]
    df = spark.createDataFrame([(i, (r / 256).tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>").repartition(5)
    got = [tuple(r) for r in topk_kdtree.search(df, lambda i: i % 50 == 0, shard_rows=40).orderBy("query_id", "rank").collect()]
    assert got == _exact(x, range(0, 600, 50), 5)


def test_kdtree_shards_are_left_out(spark):
    """Where boxes are apart, a query goes to few shards, and its result is still exact."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.integers(0, 20, (100, 2)) + c for c in ([1000, 0], [0, 1000], [-1000, 0], [0, -1000])])
    splits = topk_kdtree.Splits(x, 4)
    where = splits.place(x)
    assert splits.leaves == 4 and np.bincount(where).min() >= 90
    df = spark.createDataFrame([(i, (r / 256).tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk_kdtree.search(df, lambda i: i % 50 == 0, shard_rows=110).orderBy("query_id", "rank").collect()]
    assert got == _exact(x, range(0, 400, 50), 5)


def test_kdtree_too_large_is_an_error(spark):
    rows = lambda *v: spark.createDataFrame([(i, [x, 1.0]) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    ask = lambda i: i % 50 == 0
    big = float(1 << 40) / 256
    with pytest.raises(Exception, match="score is too large"):
        topk_kdtree.search(rows(big, big, 1.0), ask).collect()
    assert [tuple(r) for r in topk_kdtree.search(rows(1.0, big, -big), ask).orderBy("rank").collect()] == [(0, 1, 1, 65536 + 256 * (1 << 40)), (0, 2, 2, 65536 - 256 * (1 << 40))]
    with pytest.raises(Exception, match="component is too large"):
        topk_kdtree.search(rows(1e300, 1.0), ask).collect()


def test_awkward_has_all_cases():
    assert {i for i, _ in AWKWARD} >= {None, 1, 2}
