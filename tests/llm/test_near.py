"""SimHash and embedding near-duplicates against all pairs; the pipeline against its own stages' rules."""

import re

import numpy as np
import xxhash

from quire.llm import simhash, vectors
from quire.llm.components import components, forest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def smallest(ids, linked):
    i, j = np.nonzero(linked)
    label = forest(len(ids), i, j)
    return [min(x for x, g in zip(ids, label, strict=True) if g == label[k]) for k in range(len(ids))]


def test_simhash_documents(odd, empty):
    got = simhash.near_duplicates(odd).collect()
    want = {r.text: fingerprint(r.text) for r in odd.collect()}
    texts = {r.doc_id: r.text for r in odd.collect()}
    assert len(got) == odd.count()
    assert all(r.fp % 2**64 == want[texts[r.doc_id]] for r in got)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(odd).columns == odd.columns


def test_hamming_groups(spark):
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 2**64, 300, dtype=np.uint64)
    fps = [int(s) for s in seeds] + [int(s) ^ sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for s in seeds[:150] for k in (3, 4, 5)]
    fps += [int(seeds[0]) ^ (1 << a) ^ (1 << b) for a in range(48) for b in range(a)]  # one large group
    fps = np.unique(np.array(fps, np.uint64))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    label = {r.node % 2**64: r.label for r in components(simhash.hamming_links(df)).collect()}
    i, j = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None]) <= 4)
    want = forest(len(fps), i, j)
    groups = {}
    for k, f in enumerate(fps.tolist()):
        groups.setdefault(want[k], set()).add(label.get(f, ("alone", f)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((60, 16))
    vs = [*base, *(base[:30] + 0.08 * rng.standard_normal((30, 16))), base[3], base[3] * 2]
    rows = [(i, [float(x) for x in v], i % 2 if i < 60 else (i - 60) % 2 if i < 90 else 1) for i, v in enumerate(vs)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 3]
    rows += [(100 + k, v, 0) for k, v in enumerate(odd)] + [(200, [1.0] * 16, None), (201, [1.0] * 16, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in vectors.near_vectors(df).collect()}
    x = np.array([np.float32(r[1]).astype(float) if r[0] < 100 else np.zeros(16) for r in rows])
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    same = np.array([[a[2] is not None and a[2] == b[2] for b in rows] for a in rows])
    linked = (x @ x.T >= 0.93) & same
    np.fill_diagonal(linked, False)
    for k, (r, c) in enumerate(zip(rows, smallest([r[0] for r in rows], linked), strict=True)):
        assert (got[r[0]].n_links, got[r[0]].component_id, got[r[0]].kept) == (linked[k].sum(), c, r[0] == c)
    assert vectors.near_vectors(df.where("false")).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    got = corpus_pipeline.run(spark, sf).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    kept = {r.doc_id for r in got}
    assert kept and kept <= set(docs)
    at = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    fps = np.array([fingerprint(docs[i]) for i in sorted(kept)], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= 4
    assert near.sum() == len(fps)  # one of each group stays
