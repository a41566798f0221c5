"""Hard-negative mining: exact integer scores by Strassen's recursion, heaps that merge.

Rows become int64 tiles of bounded size, anchors blocks of them.  A block
meets its tiles in a stream: both are dealt by (block, slot), so a task holds
one block, one tile and the block's heaps.

1. Positives: blocks meet tiles of their own label; each anchor keeps a heap
   of its best rows.
2. Negatives: blocks meet all tiles; each (anchor, positive) keeps a heap of
   the best rows of another label inside the window that the positive's score
   sets.

Heaps leave a task at their full size at most and are merged by rank.  The
anchors are a stated query set; every row is scored against them.

Defined results: rows with a null label, a null or empty vector or a null or
non-finite component take no part, nor do rows whose own bound
(components * largest square) reaches 2^56, where 64-bit arithmetic could
overflow.  Vectors of different length never meet.  A null id is never an
anchor unless the caller marks it, and comes last among ties; rows that share
an id are rows of their own, ordered by their place in the table.  An anchor
without positives, or a window without negatives, gives no rows; so does an
empty table.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import land, ship, table
from quire.llm.strassen import Heaps, multiply, top_entries, windows_in
from quire.operators.sizing import bounded_broadcast

SCALE = 256
ANCHORS, TILE = 1024, 2048
#: Values in a tile or block; long vectors make shorter tiles.
TILE_VALUES = 1 << 19
#: A block's tiles are dealt over so many tasks.
SLOTS = 64
_LAST = np.iinfo(np.int64).max


def quantised(rows: DataFrame, anchor: Column, scale: int = SCALE) -> DataFrame:
    """Landed usable rows: row, id, label, dim, anchor, and q = floor(scale * component)."""
    v = F.col("embedding").cast("array<double>")
    rows = rows.select(F.col("vec_id").cast("long").alias("id"), "label", v.alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    q = F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x).cast("long"))
    rows = rows.where(F.col("label").isNotNull() & (F.size("v") > 0) & ~F.coalesce(bad, F.lit(False)))
    rows = rows.select("id", "label", "anchor", F.size("v").alias("dim"), q.alias("q"))
    largest = F.array_max(F.transform("q", lambda x: F.abs(x.cast("double"))))
    rows = rows.where(F.col("dim") * largest * largest < float(1 << 56))
    return land(rows.withColumn("row", F.monotonically_increasing_id()), "quantised")


def tiles(rows: DataFrame, most: int, extra: tuple[str, str] | None = None) -> DataFrame:
    """Rows as landed tiles of at most ``most`` rows that agree on ``dim`` and ``key``.

    Tile columns: tile, dim, key, lists id, row and label (and ``extra``), and
    the integers row by row in the narrowest type that holds them.
    """
    kind = rows.schema["label"].dataType.simpleString()
    lists = [("id", "long"), ("row", "long"), ("label", kind), *([extra] if extra else [])]

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, held, n, now = TaskContext.get().partitionId() << 32, [], 0, None

        def out() -> pa.RecordBatch:
            nonlocal seq, n
            whole = pa.Table.from_batches(held)
            one = lambda c: pa.concat_arrays(whole.column(c).chunks)
            values = one("q").flatten().to_numpy()
            narrow = np.result_type(np.int8, np.min_scalar_type(int(values.min())), np.min_scalar_type(int(values.max())))
            values = values.astype(narrow if narrow.kind == "i" else np.int64)
            cols = [pa.array([seq], pa.int64()), held[0].column("dim")[:1], held[0].column("key")[:1]]
            cols += [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), one(c)) for c, _ in lists]
            cols += [pa.array([values.itemsize], pa.int32()), pa.array([values.tobytes()], pa.binary())]
            held.clear()
            seq, n = seq + 1, 0
            return pa.RecordBatch.from_arrays(cols, ["tile", "dim", "key", *(c for c, _ in lists), "width", "q"])

        for batch in batches:
            dim, key = (batch.column(c).to_numpy() for c in ("dim", "key"))
            edge = np.flatnonzero((dim[1:] != dim[:-1]) | (key[1:] != key[:-1])) + 1
            for a, b in zip([0, *edge.tolist()], [*edge.tolist(), batch.num_rows], strict=True):
                if a == b:
                    continue
                if held and now != (dim[a], key[a]):
                    yield out()
                now, limit = (dim[a], key[a]), min(most, max(16, TILE_VALUES // int(dim[a])))
                while a < b:
                    take = min(b - a, limit - n)
                    held.append(batch.slice(a, take))
                    a, n = a + take, n + take
                    if n == limit:
                        yield out()
        if held:
            yield out()

    schema = "tile long, dim int, key long, " + "".join(f"{c} array<{t}>, " for c, t in lists) + "width int, q binary"
    order = ["dim", "key", "id", "row"]
    placed = rows.select("dim", "key", *(c for c, _ in lists), "q").repartitionByRange(*order).sortWithinPartitions(*order)
    return land(placed.mapInArrow(tile, schema), "tiles")


def meetings(blocks: DataFrame, tiled: DataFrame, extra: str | None = None) -> DataFrame:
    """Blocks and the tiles of their (dim, key) as one stream: of each (block, slot) the block first, then its tiles."""
    cols = ["id", "row", "label", "width", "dim", "q"]
    more = [F.col(extra) if extra else F.lit(None).cast("array<int>").alias("extra")]
    slots = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SLOTS - 1).cast("long")))
    own = blocks.select(F.col("tile").alias("block"), slots.alias("slot"), F.lit(-1).cast("long").alias("tile"), *cols, *more)
    to = bounded_broadcast(blocks.select(F.col("tile").alias("block"), F.col("dim").alias("_d"), F.col("key").alias("_k")))
    met = tiled.join(to, (tiled["dim"] == to["_d"]) & (tiled["key"] == to["_k"]))
    none = F.lit(None).cast(own.schema[-1].dataType)
    met = met.select("block", F.pmod(F.xxhash64("tile"), F.lit(SLOTS)).alias("slot"), "tile", *cols, none)
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return own.union(met).repartition(n, "block", "slot").sortWithinPartitions("block", "slot", "tile")


class _Tile:
    def __init__(self, batch: pa.RecordBatch, k: int):
        get = lambda c: batch.column(c)[k]
        self.block, self.tile = get("block").as_py(), get("tile").as_py()
        ids = pc.fill_null(get("id").values, _LAST).to_numpy()
        self.id, self.row, self.label = ids, get("row").values.to_numpy(), get("label").values
        q = np.frombuffer(get("q").as_buffer(), np.dtype(f"i{get('width').as_py()}"))
        self.q = q.astype(np.int64).reshape(len(ids), get("dim").as_py())
        self.extra = batch.column(batch.num_columns - 1)[k]

    def by_id(self) -> _Tile:
        """Columns in tie order."""
        by = np.lexsort((self.row, self.id))
        self.id, self.row, self.label, self.q = self.id[by], self.row[by], self.label.take(pa.array(by)), self.q[by]
        return self


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Tile, _Tile | None, np.ndarray, np.ndarray]]:
    """(block, tile, scores, whether labels are equal) of each meeting; (block, None, ..) when a block's tiles end."""
    block, none = None, np.zeros((0, 0))
    for batch in batches:
        for k in range(batch.num_rows):
            one = _Tile(batch, k)
            if one.tile < 0:
                if block is not None and block.block != one.block:
                    yield block, None, none, none
                block = one
                continue
            one.by_id()
            codes = pa.chunked_array([block.label, one.label]).dictionary_encode().combine_chunks()
            codes = (codes.chunk(0) if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy()
            same = codes[: len(block.id), None] == codes[None, len(block.id) :]
            yield block, one, multiply(block.q, one.q.T), same
    if block is not None:
        yield block, None, none, none


def _heap_batch(heaps: Heaps, names: list[str], of: list[pa.Array]) -> pa.RecordBatch:
    ids = pa.array(heaps.id, pa.int64(), mask=heaps.id == _LAST)
    return pa.RecordBatch.from_arrays([*of, pa.array(heaps.score), ids, pa.array(heaps.row)], names)


def _ranked(found: DataFrame, of: list[str], most: int) -> DataFrame:
    """The ``most`` best of each heap, from the heaps of all tasks."""
    best = Window.partitionBy(*of).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)


def best_positives(rows: DataFrame, most: int) -> DataFrame:
    """Landed (anchor row, rank, score, id, row) of each anchor's ``most`` best other rows of its label."""
    keyed = rows.withColumn("key", F.xxhash64("label"))
    blocks, tiled = tiles(keyed.where("anchor"), ANCHORS), tiles(keyed, TILE)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = None
        for block, one, scores, same in _units(batches):
            heaps = heaps or Heaps(len(block.id), most)
            if one is None:
                yield _heap_batch(heaps, ["anchor", "score", "id", "row"], [pa.array(block.row[heaps.of])])
                heaps = None
                continue
            allowed = same & (block.row[:, None] != one.row[None])
            i, j = top_entries(scores, allowed, heaps.floor(), most)
            heaps.merge(i, scores[i, j], one.id[j], one.row[j])

    found = meetings(blocks, tiled).mapInArrow(scan, "anchor long, score long, id long, row long")
    return land(_ranked(found, ["anchor"], most), "positives")


def best_negatives(rows: DataFrame, positives: DataFrame, most: int, low: float, high: float) -> DataFrame:
    """(anchor row, positive, rank, score, id, row) of the ``most`` best rows of another label in each positive's window.

    ``low`` and ``high`` are hundredths of the positive's score.
    """
    goals = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(F.col("rank").alias("p"), F.col("score").alias("s")))).alias("goals"))
    anchors = rows.withColumn("key", F.lit(0).cast("long"))
    wanted = anchors.where("anchor").drop("anchor").join(goals.withColumnRenamed("anchor", "row"), "row")
    blocks = tiles(wanted, ANCHORS, ("goals", "array<struct<p:int,s:long>>"))
    tiled = tiles(anchors, TILE)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = None
        for block, one, scores, same in _units(batches):
            if heaps is None:
                each = block.extra.values
                of = np.repeat(np.arange(len(block.id)), each.value_lengths().to_numpy())
                flat = each.flatten()
                rank, score = flat.field("p").to_numpy(), flat.field("s").to_numpy()
                # low * score <= 100 * s <= high * score, in integers.
                least, top = -((-low * score) // 100), (high * score) // 100
                heaps = Heaps(len(of), most)
            if one is None:
                yield _heap_batch(heaps, ["anchor", "p", "score", "id", "row"], [pa.array(block.row[of[heaps.of]]), pa.array(rank[heaps.of])])
                heaps = None
                continue
            w, j = windows_in(scores, ~same, of, least, top, most)
            heaps.merge(w, scores[of[w], j], one.id[j], one.row[j])

    found = meetings(blocks, tiled, "goals").mapInArrow(scan, "anchor long, p int, score long, id long, row long")
    return _ranked(found, ["anchor", "p"], most)


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """Rows (vec_id, embedding, label) to anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` marks the anchors; negatives score ``low`` to ``high``
    hundredths of their positive.
    """
    ship(rows.sparkSession)
    rows = quantised(rows, anchor)
    found = best_positives(rows, positives)
    misses = best_negatives(rows, found, negatives, low, high)
    ids = rows.where("anchor").select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    named = found.join(ids, "anchor").select("anchor", F.col("rank").alias("p"), "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = misses.join(named, ["anchor", "p"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


#: The components as doubles, floors and sums of whole numbers: all exact in both engines.
OP13_SQL = """
WITH moved AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM moved a JOIN moved b ON len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INT AS rank, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
  AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 3
"""
