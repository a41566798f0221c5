"""Importance resampling against plain Python; the quickselect against a sort."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.llm import resampling
from quire.llm.textwords import Words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(docs, target, percent=5):
    s, t = Counter(b for _, x in docs for b in buckets(x)[1]), Counter(b for x in target for b in buckets(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    out = []
    for k, (i, x) in enumerate(docs):
        n, f = buckets(x)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        out.append([i, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, k])
    fit = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[6]))
    for rank, r in enumerate(fit[: percent * len(fit) // 100]):
        r[5] = rank + 1
    return [tuple(r[:6]) for r in out]


order = lambda rows: sorted(rows, key=str)


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = resampling.op11_importance_resampling(spark, sf)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = [(r[0], *r[2:]) for r in brute(docs, target)]
    got = [tuple(r) for r in got.collect()]
    assert order(got) == order(want) and any(r[4] for r in got)


def test_edge_cases(spark, odd, empty):
    more = spark.createDataFrame([(i % 40, f"word{i % 3} " * 25) for i in range(80)] + [(None, "x y " * 15)] * 3, "doc_id long, text string")
    rows = odd.select("doc_id", "text").union(more).withColumn("row", F.lit(1)).withColumn("rank", F.lit(1)).withColumn("weight", F.lit("w")).coalesce(1)
    docs = [(r.doc_id, r.text) for r in rows.collect()]
    target = [r.text for r in odd.collect()][:5]
    got = resampling.resample(rows, odd.limit(0).union(spark.createDataFrame([(None, x, *[None] * 8) for x in target], odd.schema)), percent=40)
    assert order(tuple(r) for r in got.collect()) == order(brute(docs, target, 40))
    got = resampling.resample(rows, empty, percent=100).collect()
    assert order(tuple(r) for r in got) == order(brute(docs, [], 100))
    assert resampling.resample(empty, odd).collect() == []


@pytest.mark.parametrize("step", [1, 2, 5, 1000])
def test_features(step):
    texts = ["The cat sat-on 42 mats", None, "", "A", "b c", "über Straße 你好" + "\x00x", "long" * 500 + " y " + "z" * 70 + " " + "q" * 31 + " " + "r" * 32]
    words = Words(pa.array(texts), lower=True, outside=resampling.OUTSIDE)
    got = Counter((int(r), int(b)) for bucket, row in resampling.feature_buckets(words, 3, 10000, step) for b, r in zip(bucket, row, strict=True))
    assert got == Counter((i, b) for i, t in enumerate(texts) for b in buckets(t)[1])


def test_quickselect(spark):
    rng = np.random.default_rng(4)
    rows = [(int(a), None if b == 3 else int(b), i) for i, (a, b) in enumerate(zip(rng.integers(-3, 3, 700), rng.integers(0, 6, 700), strict=True))]
    df = spark.createDataFrame(rows, "a long, b long, c long")
    key = F.struct("a", F.col("b").isNull().alias("n"), "b", "c")
    want = sorted(rows, key=lambda r: (r[0], r[1] is None, r[1] or 0, r[2]))
    for k in (1, 2, 33, 350, 699, 700):
        got = resampling.kth_key(df, key, k, pivots=4)
        assert (got["a"], got["b"], got["c"]) == want[k - 1]
    assert resampling.kth_key(df, key, 701, pivots=4) is None
    assert resampling.kth_key(df.limit(0), key, 1) is None
