"""Last-N statistics as state that the engine keeps."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from skywell.schema import LIVE_WINDOWS, POLLUTANTS
from skywell.sources.files import write_by_batch
from skywell.streaming.event_time import started

AT = "at_micros"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LastN(StatefulProcessor):
    """The newest readings of a key, one row of state each; `at_micros` orders them and tells a repeated one.

    Of two readings of one time the later delivered stays, so a replayed batch changes nothing. State that no
    batch has touched for `keep` is dropped by the store.
    """

    def __init__(self, keys: list, cols: list, sizes: dict, keep: int | None):
        self.keys, self.cols, self.sizes, self.keep = keys, cols, sizes, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = ", ".join([f"{AT} bigint", *(f"`{c}` double" for c in self.cols)])
        self.rows = handle.getListState("rows", fields, self.keep)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = [AT, *self.cols]
        held = [tuple(r) for r in self.rows.get()] if self.rows.exists() else []
        table = pd.DataFrame(held, columns=names)
        for part in rows:
            both = part[names] if table.empty else pd.concat([table, part[names]])
            table = both.drop_duplicates(AT, keep="last").nlargest(max(self.sizes.values()), AT)
        table = table.astype({c: float for c in self.cols})
        self.rows.put([(int(r[0]), *(None if np.isnan(v) else float(v) for v in r[1:])) for r in table.itertuples(index=False)])
        out = []
        for window, n in self.sizes.items():
            newest = table.head(n)
            for c in self.cols:
                v = newest[c].dropna()
                if len(v):
                    deviation = float(v.std()) if len(v) > 1 else None
                    out.append((*key, window, c, float(v.mean()), deviation, float(v.min()), float(v.max()), len(v)))
        yield pd.DataFrame(out, columns=[*self.keys, "window", "channel", "mean", "std", "min", "max", "count"])

    def close(self) -> None:
        pass


def last_n_stats(rows: DataFrame, ts: str, keys, cols=POLLUTANTS, sizes=LIVE_WINDOWS, keep: int | None = None) -> DataFrame:
    """For each key of a batch, the statistics of its last-N windows after the batch.

    The stream is shuffled by key once; what is kept is at most the largest window's readings for each key.
    """
    keys, cols = list(keys), list(cols)
    at = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', CAST({ts} AS TIMESTAMP_NTZ))").alias(AT)
    wanted = rows.filter(F.col(ts).isNotNull()).select(*keys, at, *[F.col(c).cast("double").alias(c) for c in cols])
    kinds = "".join(f"`{k}` {dict(rows.dtypes)[k]}, " for k in keys)
    out = f"{kinds}window string, channel string, mean double, std double, min double, max double, `count` bigint"
    processor = LastN(keys, cols, dict(sizes), keep)
    return wanted.groupBy(*keys).transformWithStateInPandas(processor, out, "Update", "ProcessingTime" if keep else "None")


def run_last_n(rows: DataFrame, out: str, checkpoint: str, ts: str, keys, cols=POLLUTANTS, once: bool = True,
               interval: str = "5 seconds", keep: int | None = None) -> StreamingQuery:
    """The statistics of every key a batch touches, a folder for each batch."""
    spark = rows.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        stats = last_n_stats(rows, ts, keys, cols, keep=keep)
        writer = stats.writeStream.outputMode("update").foreachBatch(lambda batch, i: write_by_batch(batch, out, i))
        return started(writer, checkpoint, once, interval)
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
