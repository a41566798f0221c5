"""Memory of the steps in which texts are worked on: workers live on beside the next stage's, so every step counts."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from quire.llm import repetition, simhash

MB = 1 << 20


@pytest.mark.parametrize("module", ["repetition", "simhash"])
def test_a_step_takes_bounded_memory(spark, monkeypatch, module):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghij"), int(n))) for n in rng.integers(2, 10, 5000)]
    texts = [" ".join(words[i] for i in rng.integers(0, len(words), 700)) for _ in range(1024)]
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    got = []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema: got.append(f) or self.selectExpr("doc_id"))
    if module == "simhash":
        simhash.fingerprints(df)
        name = "text"
    else:
        with pytest.raises(Exception, match="__n_words"):  # its columns come from the function
            repetition.repetition(df)
        name = "__text"
    batch = pa.RecordBatch.from_arrays([pa.array(range(1024), pa.int64()), pa.array(texts)], ["doc_id", name])
    assert batch.nbytes > 4 * MB
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in got[0](iter([batch]))) == 1024
        assert tracemalloc.get_traced_memory()[1] < 75 * MB
    finally:
        tracemalloc.stop()
