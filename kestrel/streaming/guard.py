"""Page guard of a paged source as a stream: what the source repeats is caught across micro-batches and restarts.

Pages arrive as rows (dataset, page, payload). Per dataset the state store keeps the signature of the last
page and the page each signature was first seen on:

* a page whose signature equals that of the page before it is ``failed`` (``repeated_page``): the source has
  stopped paging;
* a page seen earlier is ``skipped`` (``duplicate_checksum``);
* any other is ``success``.

Only signatures reach the stateful operator, never payloads, so a dataset with very many pages costs
it one short row each. The state is the stream's own: it survives a restart from the same checkpoint, and a
lost executor's share is rebuilt from the shared folder. Pages of one micro-batch are taken in page order.

Defined results: a null payload has the signature of an empty one; a null page comes first; equal page
numbers are taken in the order of their signatures; null datasets are one dataset; other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from kestrel.sources.ingest import FAILED, SKIPPED, SUCCESS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DECISIONS = "dataset string, page bigint, signature string, status string, notes string, first_page bigint"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class PageGuard(StatefulProcessor):
    """State per dataset: the last page's signature, and the first page of every signature."""

    def __init__(self, words: tuple[str, str, str], keep_ms: int | None):
        self.words, self.keep_ms = words, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "signature string")
        self.seen = handle.getMapState("seen", "signature string", "page bigint", self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        success, skipped, failed = self.words
        pages = sorted(((r.page, r.signature) for batch in rows for r in batch.itertuples(index=False)),
                       key=lambda r: (not pd.isna(r[0]), 0 if pd.isna(r[0]) else r[0], r[1]))
        last = self.last.get()[0] if self.last.exists() else None
        out = []
        for page, signature in pages:
            number = None if pd.isna(page) else int(page)
            first = self.seen.getValue((signature,))[0] if self.seen.containsKey((signature,)) else None
            if signature == last:
                status, notes = failed, "repeated_page"
            elif self.seen.containsKey((signature,)):
                status, notes = skipped, "duplicate_checksum"
            else:
                status, notes = success, ""
                self.seen.updateValue((signature,), (number,))
            out.append((key[0], number, signature, status, notes, first))
            last = signature
        if out:
            self.last.update((last,))
            frame = pd.DataFrame(out, columns=["dataset", "page", "signature", "status", "notes", "first_page"])
            yield frame.astype({"page": "Int64", "first_page": "Int64"})

    def close(self) -> None:
        pass


def page_decisions(pages: DataFrame, keep_ms: int | None = None) -> DataFrame:
    """DECISIONS of a stream of pages (dataset, page, payload). ``keep_ms``: how long a signature is
    remembered (default: for good). The stream's state store must be ROCKSDB."""
    slim = pages.select(F.col("dataset").cast("string").alias("dataset"), F.col("page").cast("bigint").alias("page"),
                        F.sha2(F.coalesce(F.col("payload").cast("string"), F.lit("")), 256).alias("signature"))
    return slim.groupBy("dataset").transformWithStateInPandas(
        statefulProcessor=PageGuard((SUCCESS, SKIPPED, FAILED), keep_ms), outputStructType=DECISIONS, outputMode="Append", timeMode="ProcessingTime" if keep_ms else "None")


def guard(pages: DataFrame, path: str, checkpoint: str, keep_ms: int | None = None) -> StreamingQuery:
    """Append the decisions on all pages available now to ``path``; call it again to go on."""
    spark = pages.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)  # read when the query starts
    try:
        return (page_decisions(pages, keep_ms).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
                .outputMode("append").trigger(availableNow=True).start())
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)
