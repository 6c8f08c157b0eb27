"""The edit-distance name join, vector codes, and the phrase index, against plain versions."""

import random
import re
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegrid.llm import code_compression, name_join, phrase_index


def edits(text, letters):
    """All texts one edit away."""
    out = {text[:k] + text[k + 1 :] for k in range(len(text))}
    out |= {text[:k] + c + text[k:] for k in range(len(text) + 1) for c in letters}
    out |= {text[:k] + c + text[k + 1 :] for k in range(len(text)) for c in letters}
    return out | {text[:k] + text[k + 1] + text[k] + text[k + 2 :] for k in range(len(text) - 1)}


def by_search(a, b, most):
    """The distance by its definition: single edits, one after another."""
    letters, seen, now = set(a + b), {a}, {a}
    for n in range(most + 1):
        if b in now:
            return n
        now = {y for x in now for y in edits(x, letters)} - seen
        seen |= now
    return most + 1


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=5), st.text("abc", max_size=5), st.integers(0, 3))
def test_distance_by_single_edits(a, b, most):
    assert name_join.distance(a, b, most) == by_search(a, b, most)


def test_distance_edits_again_what_was_exchanged():
    assert name_join.distance("ca", "abc", 3) == 2 and name_join.distance("ca", "abc", 1) == 2
    assert name_join.distance("x" * 5000 + "ab" + "y" * 5000, "x" * 5000 + "ba" + "y" * 5000, 1) == 1


def _names(seed, n, letters, longest):
    """Random names, and names one or two edits from them."""
    r = random.Random(seed)
    made = ["".join(r.choices(letters, k=r.randint(1, longest))) for _ in range(n)]
    for name in made[: n // 2]:
        near = name
        for _ in range(r.randint(1, 2)):
            near = r.choice(sorted(edits(near, letters)))
        made.append(near)
    return sorted({x for x in made if x})


@pytest.mark.parametrize(("letters", "longest", "most"), [("abé", 9, 1), ("ab", 7, 2), ("abcdefgh\U0001f600", 16, 1), ("abcdefgh", 14, 2)])
def test_matches_by_brute_force(spark, letters, longest, most):
    left, right = _names(1, 120, letters, longest), _names(2, 60, letters, longest) + _names(1, 60, letters, longest)
    right = sorted(set(right))
    found = name_join.matches(*(spark.createDataFrame([(x,) for x in side], "name string") for side in (left, right)), most)
    want = {(a, b, d) for a in left for b in right if (d := name_join.distance(a, b, most)) <= most}
    rows = [tuple(r) for r in found.collect()]
    assert set(rows) == want and len(rows) == len(want) > 20


def test_name_join_sql(spark, same):
    same(name_join.op11_name_join(spark, "/root/testdata/sf0.01"), name_join.ORACLE.replace("from clients", "from '/root/testdata/sf0.01/clients.parquet'").replace("from vendors", "from '/root/testdata/sf0.01/vendors.parquet'"))


def test_names_are_misspelt_by_rule(spark):
    names = [(i, n) for i in range(40) for n in ("", "x", "ab", "añb\U0001f600c")]
    got = {(r.i, r.n): r.m for r in spark.createDataFrame(names, "i long, n string").select("i", "n", name_join.misspelt(name_join.F.col("n"), name_join.F.col("i")).alias("m")).collect()}
    for i, n in names:
        h, want = crc32(str(i).encode()), n
        if h % 2 == 0 and len(n) >= 2:
            p = h % (len(n) - 1)
            want = n[:p] + n[p + 1] + n[p] + n[p + 2 :]
        assert got[i, n] == want


def test_name_join_awkward(spark):
    long = "long name " * 2000
    clients = [(1, "Ann"), (2, "Ann"), (2, "Ann"), (3, None), (4, ""), (None, "Ann"), (5, "Anna"), (6, long), (7, "x"), (8, "Ann Lee Miller")] + [(100 + k, "Zoe Quentin") for k in range(500)]
    vendors = [(1, "Ann"), (2, "x"), (3, None), (4, ""), (None, "Ann"), (5, long + "s"), (6, "Zoe Quetnin"), (7, "Zoe Quetnin"), (8, "y"), (1, "Ana")]
    c = spark.createDataFrame([(*x, 1, "d") for x in clients], "client_id long, name string, distance int, `a.b` string")
    v = spark.createDataFrame([(*x, 1) for x in vendors], "vendor_id long, name string, n int")
    got = {tuple(r)[:4] for r in name_join.join_names(c, v).collect()}
    # vendor 1 has two names: "Ann" meets three rows of "Ann", "Ana" is one edit from them and from "Anna"
    assert got == {(1, 0, 3, 1), (1, 1, 5, 1), (2, 0, 1, 7), (5, 1, 1, 6), (6, 1, 500, 100), (7, 1, 500, 100), (8, 1, 1, 7)}
    assert name_join.join_names(c.where("false"), v).count() == 0 and name_join.join_names(c, v.where("false")).count() == 0


def _lloyd(ids, x, labels, parts, entries, rounds):
    """Codes, errors, errors by label and codebooks by plain rounds over all pairs."""
    y = np.floor(x * 1024).astype(np.int64)
    first = np.argsort(ids, kind="stable")[:entries]
    cut = np.split(y, parts, axis=1)
    books = [p[first] for p in cut]
    near = lambda p, b: ((p[:, None, :] - b[None]) ** 2).sum(2)
    for _ in range(rounds):
        for k, p in enumerate(cut):
            own = near(p, books[k]).argmin(1)
            books[k] = np.array([p[own == e].sum(0) // (own == e).sum() if (own == e).any() else books[k][e] for e in range(len(books[k]))])
    d = [near(p, b) for p, b in zip(cut, books, strict=True)]
    code = ["".join(f"{x.argmin():02x}" for x in row) for row in zip(*d, strict=True)]
    error = sum(x.min(1) for x in d)
    by = {}
    for label, e in zip(labels, error.tolist(), strict=True):
        by[label] = by.get(label, 0) + e
    return {(int(i), c, int(e), by[b]) for i, c, e, b in zip(ids, code, error, labels, strict=True)}, np.stack(books)


@pytest.mark.parametrize(("spread", "entries", "chunk", "leaf"), [(0.1, 16, 40, 4), (3.0, 16, 8192, 32), (0.002, 7, 100, 1), (2000.0, 16, 64, 8)])
def test_codes_by_plain_rounds(spark, spread, entries, chunk, leaf):
    """In clusters, as equal vectors for a third of all rows, on a coarse grid with many ties, and of numbers too large for doubles."""
    r = np.random.default_rng(7)
    x = (r.normal(0, 1, (8, 8))[r.integers(0, 8, 400)] + r.normal(0, 0.05, (400, 8))) * spread
    x[:130] = x[0]
    if spread == 2000.0:
        x *= 10
    x[200] = 0
    ids, labels = r.permutation(400) * 3, [None if k % 5 == 0 else k % 3 for k in range(400)]
    rows = [(int(i), v.tolist(), b) for i, v, b in zip(ids, x, labels, strict=True)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got, books = code_compression.compress(df, parts=4, entries=entries, rounds=4, chunk=chunk, leaf=leaf)
    want, plain = _lloyd(ids, x, labels, 4, entries, 4)
    assert (books == plain).all()
    assert {(r.vec_id, r.code, r.error, r.label_error) for r in got.collect()} == want


def test_whole_subtrees_are_assigned_at_once():
    """Of two far clusters no part is looked at by itself."""
    x = np.concatenate([np.arange(0, 600).reshape(-1, 2), 100_000 + np.arange(0, 600).reshape(-1, 2)])
    tree = code_compression.Tree.from_bytes(code_compression.Tree.build(x).to_bytes())
    tree.x = np.full_like(tree.x, 10**6)  # would be far off, were it read
    owner, number, total = tree.assign(np.array([[300, 300], [100_300, 100_300]]))
    assert number.tolist() == [300, 300] and sorted(owner.tolist()) == [0] * 300 + [1] * 300
    assert (total == [x[:300].sum(0), x[300:].sum(0)]).all()


def test_codes_sql(spark, sf_dir, same):
    same(code_compression.op12_code_compression(spark, sf_dir), code_compression.ORACLE)


def test_codes_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0] * 4, "a"), (2, [1.0] * 4, None), (2, [1.0] * 4, "a"), (3, None, "a"), (4, [nan, 0.0, 0.0, 0.0], "a"), (5, [inf, 0.0, 0.0, 0.0], "a"), (6, [None, 0.0, 0.0, 0.0], "a"), (7, [], "a"), (8, [1.0], "a"), (None, [1.0] * 4, "a"), (9, [-0.5, 0.0, 0.0, 2.0], None)]
    df = spark.createDataFrame([(*x, "c", 1) for x in rows], "vec_id long, embedding array<double>, label string, code string, error int")
    found = code_compression.compress(df)[0].collect()
    assert sorted(r.vec_id for r in found) == [1, 2, 2, 9] and {r.code for r in found if r.vec_id == 2} == {"01010101"}
    assert all(r.error == 0 == r.label_error for r in found)
    assert code_compression.compress(df.where("false"))[0].count() == 0
    with pytest.raises(ValueError, match="cannot be cut"):
        code_compression.compress(df.where("vec_id = 8"))
    with pytest.raises(Exception, match="do not fit a long"):
        code_compression.compress(spark.createDataFrame([(1, [1e300] * 4, "a")], "vec_id long, embedding array<double>, label string"))


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _plain_hits(docs, items, window):
    """(n_words, n_hit, items) of each document, by looking everywhere."""
    seen = {}
    for item, text in items:
        w = _words(text)
        for k in range(max(1, len(w) - window + 1)) if w and item is not None else ():
            seen.setdefault(tuple(w[k : k + window]), set()).add(str(item))
    out = []
    for i, text in docs:
        w, hit, found = _words(text), set(), set()
        for n in {len(p) for p in seen}:
            for k in range(len(w) - n + 1):
                if (own := seen.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= own
        out.append((i, len(w), len(hit), tuple(sorted(found)), bool(hit)))
    return sorted(out, key=str)


def _texts(seed, n):
    r = random.Random(seed)
    vocabulary = ["the", "Of", "é", "x1", "日本", "rare", "and", "b", "zz"]
    return [(k, " ".join(r.choices(vocabulary, (9, 8, 4, 3, 2, 1, 6, 5, 2), k=r.randint(0, 60)))) for k in range(n)]


@pytest.mark.parametrize(("window", "chunk", "small"), [(3, 200, 0), (10, 1 << 20, 1 << 23), (4, 1, 1 << 23)])
def test_phrases_by_brute_force(spark, monkeypatch, window, chunk, small):
    """With words looked up in memory, and by a shuffle."""
    monkeypatch.setattr(phrase_index, "SMALL", small)
    docs, items = _texts(1, 80), [*_texts(2, 12), (12, "the, of"), (13, "rare"), (None, "the"), (14, None), (15, "..."), (3, "zz zz zz zz zz")]
    docs += [(100, items[3][1]), (101, f"x {items[5][1]}. {items[5][1]}!"), (102, None), (None, items[4][1]), (3, docs[3][1])]
    d = spark.createDataFrame([(*x, "w", 1) for x in docs], "doc_id long, text string, word string, shard int").repartition(3)
    found = phrase_index.contaminated(d, spark.createDataFrame([(*x, "p") for x in items], "item_id long, text string, phrase string"), window, chunk).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in found), key=str) == _plain_hits(docs, items, window)
    assert all(r.n_items == len(r["items"]) for r in found)


def test_phrases_sql(spark, sf_dir, same):
    same(phrase_index.op13_phrase_index(spark, sf_dir), phrase_index.ORACLE)


def test_phrases_awkward(spark, awkward, nothing):
    items = spark.createDataFrame([(1, "word of a long text word of a long text word"), (2, "SIX seven"), (3, "é\U0001f600 日本")], "item_id long, text string")
    got = {(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in phrase_index.contaminated(awkward, items).collect()}
    assert {(5, 150_000, 150_000, ("1",)), (8, 7, 2, ("2",)), (9, 7, 2, ("2",)), (1, 0, 0, ()), (2, 0, 0, ()), (3, 0, 0, ())} <= got
    assert next(x for x in got if x[0] == 6)[2:] == (2, ("3",))
    assert phrase_index.contaminated(nothing, items).count() == 0
    clean = phrase_index.contaminated(awkward, items.where("false"))
    assert clean.count() == awkward.count() and clean.where("contaminated or n_items > 0").count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("aabbcd"), min_size=1, max_size=25), st.lists(st.sampled_from("abc"), min_size=1, max_size=4), st.integers(1, 9))
def test_spans_near_by_brute_force(text, words, within):
    places = {w: np.array([k for k, x in enumerate(text) if x == w], np.int64) for w in "abcd"}
    lead = min(words, key=lambda w: len(places[w]))
    order = sorted(words, key=lambda w: (len(places[w]), w != lead))
    holds = lambda a, z: all(text[a:z].count(w) >= words.count(w) for w in words)
    want = [(a, z - a) for a in range(len(text)) for z in range(a + 1, len(text) + 1) if z - a <= within and holds(a, z) and not holds(a + 1, z) and not holds(a, z - 1)]
    got = phrase_index.spans_near(places, order, within) if all(len(places[w]) for w in words) else []
    assert sorted(got) == sorted(want)


def test_near_matches(spark):
    docs = spark.createDataFrame([(1, "a quick fox saw the lazy dog"), (2, "dog lazy the fox"), (3, "the fox"), (4, "fox x x x x x x lazy dog the")], "doc_id long, text string")
    phrases = spark.createDataFrame([("the lazy dog fox",), ("none of it",)], "phrase string")
    index = phrase_index.build(docs)
    assert sorted(map(tuple, phrase_index.near(index, phrases, 6).collect())) == [(1, "the lazy dog fox", 2, 5), (2, "the lazy dog fox", 0, 4)]
    assert phrase_index.near(index, phrases, 10).count() == 3
