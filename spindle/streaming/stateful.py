"""Stream dedup whose state ends by timers, with late rows kept apart (STR-02).

Spark's own watermark dedup drops late rows without a trace.  Here every row
comes out once, marked ``kept``, ``duplicate`` or ``late``, so that a table of late
rows can be written and nothing is lost.  Keys are remembered in slots of event
time; a slot's timer removes it once the watermark has passed its end, from where
on every copy of its rows is late.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

# the processor is also set up on the driver, in a Python process that doesn't get the shipped package: it travels whole
cloudpickle.register_pickle_by_value(sys.modules[__name__])
#: Columns that the job adds: the event time in milliseconds, what became of the row, and the watermark that it met.
TIME, OUTCOME, WATERMARK = "event_ms", "outcome", "watermark_ms"
_KEY = np.dtype([("a", "<i8"), ("b", "<i8")])  # two independent hashes of a row's keys
_OWN = ("dedup_a", "dedup_b", "dedup_bucket", "dedup_slot", "dedup_us")


class DedupSlots(StatefulProcessor):
    """Per bucket of keys and slot of event time: which keys have been kept.

    A row is late when its event time is below the watermark of its batch; of the
    others the first of each key is kept.  One read and one write of state and at
    most one timer serve all rows of a group in a batch."""

    def __init__(self, slot_ms: int):
        self.slot_ms = slot_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.keys = handle.getValueState("keys", StructType([StructField("packed", BinaryType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        held = self.keys.get()
        known = np.frombuffer(bytes(held[0]) if held else b"", _KEY)
        before = len(known)
        for batch in rows:
            outcome = np.full(len(batch), "late", object)
            on_time = np.flatnonzero(batch[TIME].to_numpy() >= mark)
            if len(on_time):
                arrived = np.zeros(len(on_time), _KEY)
                arrived["a"], arrived["b"] = (batch[c].to_numpy()[on_time] for c in _OWN[:2])
                every = np.concatenate([known, arrived])
                first = np.unique(every, return_index=True)[1]
                outcome[on_time] = "duplicate"
                outcome[on_time[first[first >= len(known)] - len(known)]] = "kept"
                known = every[first]
            yield batch.assign(**{OUTCOME: outcome, WATERMARK: np.int64(mark)})
        if len(known) > before:
            self.keys.update((known.tobytes(),))
            if not before:
                self.handle.registerTimer((int(key[1]) + 1) * self.slot_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.keys.clear()
        return iter([])

    def close(self) -> None:
        pass


def dedup_with_late_rows(df: DataFrame, keys: Sequence[str], event_time: str, delay: str, slot_ms: int, buckets: int | None = None) -> DataFrame:
    """STR-02: every row of a stream with ``event_ms``, ``outcome`` (``kept``, ``duplicate`` or ``late``) and the ``watermark_ms`` it met.

    The watermark of a batch is the newest event time of the batches before it,
    less ``delay``.  Copies of a row have its keys and its event time; the first that
    is not late is kept (within a batch: any one of them).  State holds the keys of
    the slots (``slot_ms`` of event time each) that the watermark has not passed and
    no more: 16 bytes a key, a state row per slot and each of ``buckets`` (default:
    four a shuffle partition) hash buckets of keys.  Rows without an event time are
    late.  Columns of these names are replaced; the event time comes back as
    ``timestamp``.  Copies with another event time are rows of their own."""
    buckets = buckets or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = [c for c in df.columns if c not in (event_time, TIME, OUTCOME, WATERMARK)]
    marked = df.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay)
    # the watermark's own column stays behind: Spark would drop late rows by it
    rows = marked.select(*rest, F.coalesce(F.unix_micros(event_time), F.lit(-1)).alias("dedup_us"), F.xxhash64(*keys, event_time).alias("dedup_a"),
                         F.xxhash64(F.lit(1), event_time, *keys).alias("dedup_b"))
    rows = rows.withColumn(TIME, F.floor(F.col("dedup_us") / 1000).cast("long"))
    rows = rows.withColumns({"dedup_bucket": F.pmod("dedup_a", F.lit(buckets)).cast("long"), "dedup_slot": F.floor(F.col(TIME) / slot_ms).cast("long")})
    schema = StructType([*rows.schema.fields, StructField(OUTCOME, StringType()), StructField(WATERMARK, LongType())])
    out = rows.groupBy("dedup_bucket", "dedup_slot").transformWithStateInPandas(DedupSlots(slot_ms), schema, outputMode="Append", timeMode="EventTime")
    return out.select(*rest, F.when(F.col("dedup_us") >= 0, F.timestamp_micros("dedup_us")).alias(event_time), TIME, OUTCOME, WATERMARK)


def state_rows(progress: list) -> list[tuple[int, int]]:
    """``(batch_id, rows of state after it)`` from the progress of a query."""
    return [(p["batchId"], sum(o["numRowsTotal"] for o in p["stateOperators"])) for p in progress]
