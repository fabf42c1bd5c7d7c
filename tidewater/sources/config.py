"""Polled configuration tables (S9) and newest-row-per-key.

The reference re-reads a small table every 30 minutes and broadcasts it.
Here a ``PolledTable`` is re-read from inside ``foreachBatch`` once its
time-to-live has passed; between reloads the same DataFrame (a small,
size-checked table) is joined to each micro-batch.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key by ``order`` (later rows overwrite earlier ones,
    as in broadcast map state).  A ``max_by`` aggregate: combined map-side."""
    row = F.struct(*[F.col(c) for c in df.columns])
    o = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*keys).agg(F.max_by(row, o).alias("_tw_row")).select("_tw_row.*")


class PolledTable:
    """A table re-loaded by ``loader(spark)`` when older than ``ttl`` seconds.

    A load is materialised (cached on the executors and counted), so the
    micro-batches in between join the loaded copy instead of re-reading the
    source; the previous copy is released on reload.  Meant for small
    configuration tables (the joins that use it check its size before
    broadcasting)."""

    def __init__(self, loader: Callable[[SparkSession], DataFrame], ttl: float = 30 * 60,
                 clock: Callable[[], float] = time.monotonic):
        self.loader, self.ttl, self.clock = loader, ttl, clock
        self._df: DataFrame | None = None
        self._at = float("-inf")
        self.loads = 0

    def get(self, spark: SparkSession) -> DataFrame:
        now = self.clock()
        if self._df is None or now - self._at >= self.ttl:
            fresh = self.loader(spark).cache()
            fresh.count()
            if self._df is not None:
                self._df.unpersist()
            self._df, self._at = fresh, now
            self.loads += 1
        return self._df


def static_lookup(loader: Callable[[SparkSession], DataFrame], ttl: float = 30 * 60) -> PolledTable:
    """A polled lookup table for use inside ``foreachBatch``."""
    return PolledTable(loader, ttl)
