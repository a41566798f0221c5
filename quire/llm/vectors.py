"""Embedding near-duplicates by collision-counting projections.

Every vector, scaled to length 1, is projected on many random directions.
Two vectors collide in a projection if one lies in the window centred on the
other.  For a pair at the similarity limit the chance of a collision is known
(the projected difference is close to normal), so the count that such a pair
reaches with a given recall is a binomial quantile; pairs of that count or
more are verified by their exact cosine.

Within a label, vectors are sorted by their first projection and cut into
pages of bounded size.  Two pages meet only if the ranges of their projections
come within a window often enough for the required count; collisions are then
counted for a page pair at a time in numpy.  A meeting returns link counts and
a spanning forest, never all pairs, so a group of thousands of copies costs
memory for one page pair only.  Equal vectors are compared once.

Defined results: vectors that are null, empty, zero or hold null or
non-finite components, and rows with a null label, link with nothing; vectors
of different length never link; rows that share an id are rows of their own;
an empty table gives no rows.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import land, table
from quire.llm.components import components, forest

COSINE = 0.93
PROJECTIONS = 32
#: Half a window, in standard deviations of the projected difference of a pair at the limit.
WIDTH = 1.75
#: Share of pairs at the limit that must reach the count.
RECALL = 0.99999
PAGE = 1024
SALT = 16


def calibrated(projections: int, width: float, recall: float) -> int:
    """The largest count that a pair at the limit reaches with this probability."""
    p = math.erf(width / math.sqrt(2))
    below = 0.0
    for count in range(projections + 1):
        below += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if below > 1 - recall:
            return count
    return projections


@functools.lru_cache(maxsize=64)
def directions(dim: int, projections: int, seed: int = 8) -> np.ndarray:
    """Random unit directions, the same on every worker; orthogonal as far as the dimension goes."""
    rng = np.random.default_rng([seed, dim])
    out = []
    while sum(len(x) for x in out) < projections:
        q, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
        out.append(q)
    return np.concatenate(out)[:projections]


def half_window(dim: int, cosine: float, width: float) -> float:
    return width * math.sqrt(2 * (1 - cosine) / dim) + 1e-9


def page_pairs(a: np.ndarray, b: np.ndarray, pa_: np.ndarray, pb: np.ndarray, window: float, count: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose projections collide often enough and whose exact cosine is high enough."""
    out_i, out_j = [], []
    m = pa_.shape[1]
    for s in range(0, len(a), 128):
        p = pa_[s : s + 128]
        hits = np.zeros((len(p), len(b)), np.uint8)
        for k in range(m):
            hits += np.abs(p[:, k, None] - pb[None, :, k]) <= window
        i, j = np.nonzero(hits >= count)
        for t in range(0, len(i), 1 << 16):
            x, y = i[t : t + (1 << 16)] + s, j[t : t + (1 << 16)]
            ok = np.einsum("ij,ij->i", a[x], b[y]) >= cosine
            out_i.append(x[ok])
            out_j.append(y[ok])
    return (np.concatenate(out_i), np.concatenate(out_j)) if out_i else (np.zeros(0, int), np.zeros(0, int))


def near_vectors(rows: DataFrame, cosine: float = COSINE, projections: int = PROJECTIONS, width: float = WIDTH, recall: float = RECALL) -> DataFrame:
    """Rows (vec_id, embedding, label) to vec_id, n_links, component_id, kept."""
    count = calibrated(projections, width, recall)
    rows = rows.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v")).withColumn("row", F.monotonically_increasing_id())
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists("v", lambda x: x != 0)
    rows = land(rows.withColumn("ok", F.coalesce(usable, F.lit(False))).withColumn("v", F.when(F.col("ok"), F.col("v"))), "vectors")
    # Equal vectors of a label are one class; its number is its smallest row.
    classes = rows.where("ok").groupBy("label", "v").agg(F.min("row").alias("class"), F.count("*").alias("n"), F.min("vec_id").alias("rep"))
    classes = land(classes.select("*", F.size("v").alias("dim")), "classes")

    def first_projection(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = [float(directions(len(v), 1)[0] @ v / np.linalg.norm(v)) for v in (np.asarray(x.values) for x in batch.column("v"))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("label", "dim", "class", "n", "v")), pa.array(p, pa.float64())], ["label", "dim", "class", "n", "v", "p"])

    kind = classes.schema["label"].dataType.simpleString()
    projected = classes.select("label", "dim", "class", "n", "v").mapInArrow(first_projection, f"label {kind}, dim int, class long, n long, v array<double>, p double")
    order = ["label", "dim", "p", "class"]

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, held = TaskContext.get().partitionId() << 32, []

        def page() -> pa.RecordBatch:
            nonlocal seq
            seq += 1
            label, dim = held[0][:2]
            v = np.array([x[4] for x in held])
            v /= np.linalg.norm(v, axis=1, keepdims=True)
            p = v @ directions(dim, projections).T
            ids = np.array([[x[2], x[3]] for x in held], np.int64)
            out = [pa.array([seq], pa.int64()), pa.array([label], schema_label), pa.array([dim], pa.int32()), pa.array([p.min(0)], pa.list_(pa.float64())), pa.array([p.max(0)], pa.list_(pa.float64())), pa.array([ids.tobytes()], pa.binary()), pa.array([v.tobytes()], pa.binary())]
            held.clear()
            return pa.RecordBatch.from_arrays(out, ["page", "label", "dim", "low", "high", "ids", "vs"])

        for batch in batches:
            schema_label = batch.column("label").type
            for row in zip(*(batch.column(c).to_pylist() for c in ("label", "dim", "class", "n")), (np.asarray(x.values) for x in batch.column("v")), strict=True):
                if held and (row[:2] != held[0][:2] or len(held) == PAGE):
                    yield page()
                held.append(row)
        if held:
            yield page()

    paged = projected.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pages, f"page long, label {kind}, dim int, low array<double>, high array<double>, ids binary, vs binary")
    paged = land(paged, "vector-pages")
    # Pages of a label meet on a salt: one side has one value, the other all, so a label with a third of the rows is many tasks' work.
    side = paged.select("page", "label", "dim", "low", "high")
    left = side.select("label", "dim", (F.col("page") % SALT).alias("salt"), F.col("page").alias("l"), F.col("low").alias("l0"), F.col("high").alias("l1"))
    right = side.select("label", "dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))).alias("salt"), F.col("page").alias("r"), F.col("low").alias("r0"), F.col("high").alias("r1"))
    window = F.lit(width) * F.sqrt(2 * (1 - F.lit(cosine)) / F.col("dim")) + 1e-9
    met = F.zip_with(F.arrays_zip("l0", "l1"), F.arrays_zip("r0", "r1"), lambda x, y: ((x["l0"] <= y["r1"] + window) & (y["r0"] <= x["l1"] + window)).cast("int"))
    often = F.aggregate(met, F.lit(0), lambda s, x: s + x) >= count
    pairs = left.join(right, ["label", "dim", "salt"]).where((F.col("l") <= F.col("r")) & often).select("l", "r", "dim")
    blobs = lambda c: paged.select(F.col("page").alias(c), F.col("ids").alias(f"{c}_ids"), F.col("vs").alias(f"{c}_vs"))
    both = pairs.join(blobs("l"), "l").join(blobs("r"), "r").repartition("l", "r")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                get = lambda c: batch.column(c)[k]  # noqa: B023, E731
                dim, same = get("dim").as_py(), get("l").as_py() == get("r").as_py()
                ids, other = (np.frombuffer(get(c).as_buffer(), np.int64).reshape(-1, 2) for c in ("l_ids", "r_ids"))
                a, b = (np.frombuffer(get(c).as_buffer(), np.float64).reshape(-1, dim) for c in ("l_vs", "r_vs"))
                to = directions(dim, projections).T
                i, j = page_pairs(a, b, a @ to, b @ to, half_window(dim, cosine, width), count, cosine)
                if same:
                    i, j = i[i < j], j[i < j]
                    links = np.bincount(i, ids[j, 1], len(ids)) + np.bincount(j, ids[i, 1], len(ids))
                    nodes, label = ids[:, 0], forest(len(ids), i, j)
                else:
                    links = np.concatenate([np.bincount(i, other[j, 1], len(ids)), np.bincount(j, ids[i, 1], len(other))])
                    nodes = np.concatenate([ids[:, 0], other[:, 0]])
                    label = forest(len(nodes), i, j + len(ids))
                at = np.flatnonzero(links > 0)
                yield pa.RecordBatch.from_arrays([pa.array(nodes[at]), pa.array(nodes[label[at]]), pa.array(links[at].astype(np.int64))], ["class", "root", "links"])

    schema = "class long, root long, links long"
    found = land(both.select("l", "r", "dim", "l_ids", "l_vs", "r_ids", "r_vs").mapInArrow(meet, schema), "vector-links")
    label = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    more = found.groupBy("class").agg(F.sum("links").alias("more"))
    of = classes.select("label", "v", "class", "n", "rep").join(more, "class", "left").join(label.withColumnRenamed("node", "class").withColumnRenamed("label", "root"), "class", "left")
    of = land(of.select("label", "v", "n", "rep", F.coalesce("more", F.lit(0)).alias("more"), F.coalesce("root", "class").alias("root")), "vector-classes")
    small = of.groupBy("root").agg(F.min("rep").alias("component_id"))
    of = of.join(small, "root").select(F.col("label").alias("c_label"), F.col("v").alias("c_v"), (F.col("n") - 1 + F.col("more")).alias("n_links"), "component_id")
    out = rows.join(of, rows["ok"] & (rows["label"] == of["c_label"]) & (rows["v"] == of["c_v"]), "left")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op8_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
