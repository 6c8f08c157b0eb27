"""Running figures and cycles, whose keys are spread by day, against plain loops."""

import random

from pulsegrid.operators import aggregates


def _rows(seed=4, n=400):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = rng.choice([1, 1, 1, 2, 0, None])
        t = None if rng.random() < 0.05 else f"2024-01-0{rng.randrange(1, 6)} {rng.randrange(24):02}:{rng.randrange(3):02}:00"
        out.append((key, t, i, None if rng.random() < 0.2 else rng.randrange(10000) / 100, rng.choice("se")))
    return out


def _by_key(rows):
    keys = {}
    for r in sorted(rows, key=lambda r: (r[1] or "", r[2])):
        keys.setdefault(r[0], []).append(r)
    return keys


def _frame(spark, rows):
    return spark.createDataFrame(rows, "opc_tag_id long, t string, id long, value double, kind string").selectExpr("opc_tag_id", "cast(t as timestamp) timestamp", "id", "value", "kind").repartition(5)


def test_running(spark):
    rows = _rows()
    want = {}
    for series in _by_key(rows).values():
        total = n = 0
        for _, _, i, v, _ in series:
            if v is not None:
                total, n = total + round(v * 100), n + 1
            want[i] = (total if n else None, n)
    got = {r.id: (None if r.running_sum is None else int(r.running_sum * 100), r.running_count) for r in aggregates.running(_frame(spark, rows)).collect()}
    assert got == want
    assert aggregates.running(_frame(spark, rows).where("false")).count() == 0


def test_cycles(spark):
    rows = _rows(5)
    want = sorted((str(k), a[2], a[1], b[1]) for k, series in _by_key(rows).items() for a, b in zip(series, series[1:], strict=False) if a[4] == "s" and b[4] == "e")
    found = aggregates.cycles(_frame(spark, rows), "opc_tag_id", "timestamp", "kind", "s", "e", "id").collect()
    assert sorted((str(r.opc_tag_id), r.id, r.started and str(r.started), r.ended and str(r.ended)) for r in found) == want


def test_weighted_average(spark):
    pairs = spark.createDataFrame([("a", 10.0, 4), ("a", 2.0, 2), ("b", 0.0, 0)], "k string, sum double, count long")
    assert sorted(map(tuple, aggregates.weighted_average(pairs, "k").collect())) == [("a", 12.0, 6, 2.0), ("b", 0.0, 0, None)]
