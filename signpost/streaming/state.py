"""Positives as keyed state: the last receipt of every domain, kept by the stream itself."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from signpost.session import ship_package

STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
LAST = "last"
CHANGE = "domain string, pos long, is_positive boolean"


class LastReceipt(StatefulProcessor):
    """Of a domain: the receipt with the highest position seen. Receipts that come late change nothing.

    A last receipt without a signal stays too, without being one of the positives, so that an older one that
    comes later cannot bring the domain back.
    """

    def __init__(self, schema: StructType, signal: str) -> None:
        self.schema, self.signal = schema, signal
        self.names = schema.fieldNames()
        self.place, self.flag = self.names.index("pos"), self.names.index(signal)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState(LAST, self.schema)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        known = self.last.get()
        best = None if known is None else tuple(known)
        before = best
        for row in rows:
            if best is None or row["pos"] > best[self.place]:
                best = tuple(row[n] for n in self.names)
        if best is not before:
            self.last.update(best)
            was, now = before is not None and bool(before[self.flag]), bool(best[self.flag])
            if was or now:
                yield Row(domain=key[0], pos=best[self.place], is_positive=now)

    def close(self) -> None:
        pass


def _last_of_batch(names: list[str]):
    def reduce(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.sort_values("pos", kind="stable").drop_duplicates("domain", keep="last")[names]

    return reduce


def positive_changes(receipts: DataFrame, signal: str = "is_interesting") -> DataFrame:
    """(domain, pos, is_positive) of a receipt stream, whenever a domain becomes, stays or ceases to be a positive.

    `receipts` has domain, pos, the signal and whatever is to be remembered. Before the shuffle only the last
    receipt of a domain in each batch of rows goes on. The state takes plain rows: most domains have one in a batch,
    and a frame for each of them costs far more than the look into the state.
    """
    ship_package(receipts.sparkSession)
    names = receipts.columns
    kept = StructType([f for f in receipts.schema.fields if f.name != "domain"])
    fewer = receipts.mapInPandas(_last_of_batch(names), receipts.schema)
    return fewer.groupBy("domain").transformWithState(LastReceipt(kept, signal), CHANGE, "Update", "None")


def keep_positive_state(receipts: DataFrame, checkpoint: str, signal: str = "is_interesting", trigger: dict | None = None) -> StreamingQuery:
    """Run the state; it lives in the checkpoint, and a restart goes on where the last batch ended."""
    for name, value in STORE.items():
        receipts.sparkSession.conf.set(name, value)
    writer = positive_changes(receipts, signal).writeStream.outputMode("update").format("noop")
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_positive_state(spark: SparkSession, checkpoint: str, signal: str = "is_interesting") -> DataFrame:
    """The positives as of the last finished batch, read from the state."""
    state = spark.read.format("statestore").option("stateVarName", LAST).load(checkpoint)
    return state.select(F.col("key.domain").alias("domain"), "value.*").where(F.col(signal))
