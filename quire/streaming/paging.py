"""F5 over a stream: which listing responses of each wiki space give pages, as they arrive.

Responses may arrive late, out of order and more than once.  The state of a
space is the offset that its listing waits for, whether the listing has
ended, and the sizes of responses that came early.  Sizes and offsets alone
pass through it; pages are read from the landed responses by the rows it
gives out.

A response that failed counts as one that has not come: a later copy that
didn't fail takes its place, as in the batch rule.  Of several copies that
didn't fail the first one counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quire.operators.wiki import API_BATCH_SIZE

KEPT = "source_dir string, start int, n int, copy string"


class PagingStop(StatefulProcessor):
    def __init__(self, batch_size: int = API_BATCH_SIZE):
        self.batch_size = batch_size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.at = handle.getValueState("at", "next int, ended boolean")
        self.early = handle.getMapState("early", "start int", "n int, copy string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        due, ended = self.at.get() if self.at.exists() else (0, False)
        for pdf in rows:
            for start, n, copy in zip(pdf["start"].tolist(), pdf["n"].tolist(), pdf["copy"].tolist(), strict=True):
                if not ended and start >= due and not self.early.containsKey((start,)):
                    self.early.updateValue((start,), (n, copy))
        kept = []
        while not ended and self.early.containsKey((due,)):
            n, copy = self.early.getValue((due,))
            kept.append((key[0], due, n, copy))
            self.early.removeKey((due,))
            ended, due = n < self.batch_size, due + self.batch_size
        if ended:
            self.early.clear()
        self.at.update((due, ended))
        yield pd.DataFrame(kept, columns=["source_dir", "start", "n", "copy"])

    def close(self) -> None:
        pass


def kept_responses(batches: DataFrame, batch_size: int = API_BATCH_SIZE) -> DataFrame:
    """A stream of ``schemas.CONTENT_BATCHES`` with a ``copy`` that names each response -> the responses that give pages.

    Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
    """
    good = F.coalesce(F.col("status").between(200, 299), F.lit(False)) & F.coalesce(F.col("parsed"), F.lit(False))
    placed = (F.col("start") >= 0) & (F.col("start") % batch_size == 0)
    sizes = batches.where(good & placed).select("source_dir", "start", F.size(F.coalesce("results", F.array())).alias("n"), "copy")
    return sizes.groupBy("source_dir").transformWithStateInPandas(PagingStop(batch_size), outputStructType=KEPT, outputMode="append", timeMode="none")
