"""Suffix-array removal against a dictionary of all byte strings."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from quire.llm import suffixdedup, suffixes


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, texts, length):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in suffixdedup.remove_repeats(df, length).collect()}
    assert got == dict(enumerate(brute(texts, length)))


@pytest.mark.parametrize(("alphabet", "length", "parts"), [("ab", 8, "4"), ("abcd", 12, "9"), ("ab", 5, "1"), ("abcdefgh", 30, "9")])
def test_random_texts(spark, monkeypatch, alphabet, length, parts):
    """Small alphabets repeat strings everywhere; one or many buckets, many blocks."""
    monkeypatch.setattr(suffixdedup, "BLOCK_BYTES", 100)
    monkeypatch.setattr(suffixdedup, "BUCKET_BYTES", {"1": 1 << 30, "4": 2000, "9": 500}[parts])
    rng = np.random.default_rng(length)
    pool = ["".join(rng.choice(list(alphabet), int(n))) for n in rng.integers(0, 3 * length, 40)]
    texts = ["".join(pool[i] for i in rng.integers(0, len(pool), int(k))) for k in rng.integers(0, 6, 60)]
    texts += [texts[0], "a" * 50 * length, "ab" * 7 * length, None, "", "x" + "a" * length]
    conf = {"spark.sql.shuffle.partitions": parts, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        check(spark, texts, length)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_one_passage_in_most_texts(spark):
    """A passage shorter than the limit in every text, with other bytes around it: one hot gram, few repeats."""
    rng = np.random.default_rng(3)
    word = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))
    passage = word(36)
    texts = [word(30) + passage + word(30) for _ in range(300)]
    texts += [x[:20] + passage + texts[(i * 7) % 300][66:] for i, x in enumerate(texts[:40])]
    check(spark, texts, 40)


def test_edge_cases(odd, empty):
    rows = odd.collect()
    got = suffixdedup.remove_repeats(odd, with_text=True).collect()
    want = brute([r.text for r in rows], suffixdedup.LENGTH)
    assert sorted((r.doc_id or -1, *tuple(r)[1:5]) for r in got) == sorted((r.doc_id or -1, *w) for r, w in zip(rows, want, strict=True))
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed for r in got)
    assert suffixdedup.remove_repeats(empty).collect() == []


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in suffixdedup.op12_suffix_dedup(spark, sf).collect()}
    assert got == dict(zip([r.doc_id for r in docs], brute([r.text for r in docs], 400), strict=True))


def test_multikey_quicksort():
    rng = np.random.default_rng(5)
    for n, m, top in ((0, 3, 2), (1, 3, 2), (500, 4, 3), (500, 2, 1000), (64, 5, 1)):
        rows = rng.integers(0, top, (n, m)).astype(np.uint64)
        want = sorted(range(n), key=lambda i: (tuple(rows[i]), i))  # noqa: B023
        assert suffixes.multikey_quicksort(rows).tolist() == want
