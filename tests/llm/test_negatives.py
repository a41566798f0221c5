"""Hard negatives against all pairs in Python integers; Strassen against plain products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import negatives, strassen


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 3, 7), (33, 40, 65), (100, 64, 90), (0, 64, 3), (3, 0, 2)])
@pytest.mark.parametrize("top", [5, 1 << 28])
def test_products(shape, top):
    m, k, n = shape
    rng = np.random.default_rng(m)
    a, b = rng.integers(-top, top, (m, k)), rng.integers(-top, top, (k, n))
    want = (a.astype(object) @ b.astype(object)).astype(np.int64) if k else np.zeros((m, n), np.int64)
    for leaf in (1, 4, 32):
        assert np.array_equal(strassen.multiply(a, b, leaf), want)


def brute(rows, anchor, positives=5, negatives_=3):
    use = []
    for k, (i, v, label) in enumerate(rows):
        if label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.append((math.inf if i is None else i, k, label, [math.floor(256 * float(x)) for x in v]))
    out = []
    for a in use:
        if not anchor(a[0]):
            continue
        scored = [(-sum(x * y for x, y in zip(a[3], b[3], strict=True)), b[0], b[1], b[2]) for b in use if b[1] != a[1] and len(b[3]) == len(a[3])]
        scored.sort(key=lambda x: x[:3])
        for s, i, _, _ in [x for x in scored if x[3] == a[2]][:positives]:
            fits = [x for x in scored if x[3] != a[2] and 50 * -s <= 100 * -x[0] <= 95 * -s][:negatives_]
            out += [(a[0], i, r + 1, x[1], -s, -x[0]) for r, x in enumerate(fits)]
    return sorted(out)


def vectors(n, dim, labels, seed):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((4, dim))
    v = np.float32(0.2 * (centre[rng.integers(0, 4, n)] + 0.7 * rng.standard_normal((n, dim))))
    return [(i, [float(x) for x in w], int(rng.integers(0, labels))) for i, w in enumerate(v)]


def mined(spark, rows, every=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("row", F.lit("clash")).withColumn("key", F.lit(1))
    got = negatives.hard_negatives(df.coalesce(1), F.col("vec_id") % every == 0).collect()
    back = lambda x: math.inf if x is None else x
    return sorted((back(r.anchor_id), back(r.positive_id), r.rank, back(r.negative_id), r.positive_score, r.negative_score) for r in got)


@pytest.mark.parametrize("tile", [7, 2048])
def test_vectors(spark, monkeypatch, tile):
    monkeypatch.setattr(negatives, "TILE", tile)
    monkeypatch.setattr(negatives, "ANCHORS", tile)
    rows = vectors(150, 6, 3, 1) + [(200 + i, v, k) for i, v, k in vectors(20, 3, 2, 2)]
    rows += [rows[0], rows[5], rows[5], (None, rows[1][1], 0), (None, rows[2][1], 1)]  # repeats, ties, null ids
    rows += [(300 + k, v, 0) for k, v in enumerate([None, [], [0.0] * 6, [float("nan")] * 6, [float("inf")] * 6, [None] + [1.0] * 5, [3e38] * 6, [1.0]])]
    rows += [(310, [1.0] * 6, None), (315, [-1.0] * 6, 9)]  # no label; a label of its own
    want = brute([r for r in rows if r[0] != 306], lambda i: i != math.inf and i % 5 == 0)  # too large for 64 bits: takes no part
    got = mined(spark, rows)
    assert got == want and got


def test_all_equal(spark):
    """Ties everywhere, one label with most rows."""
    rows = [(i, [0.5, 0.25], 0 if i % 7 else 1) for i in range(60)] + [(100 + i, [0.3, 0.2], i % 2) for i in range(10)]
    got = mined(spark, rows)
    assert got == brute(rows, lambda i: i % 5 == 0) and got
    assert mined(spark, rows[:0] or [(1, [1.0], 0)]) == []


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.hard_negatives(df, F.lit(True)).collect() == []
