"""Each id once, by a stateful processor with a primed list and forgetting.

The primed list is the initial state: it is read once, when the stream is first started, and
is part of the checkpoint from then on, so that the backlog is not sent and no batch joins
the list. An id is forgotten once it has been absent from the feed for `ttl_seconds`, so the
state holds the ids of that time only, whatever the stream's age. State lies in RocksDB on
the executors, by hash of the id, with a change log in the checkpoint: after a restart
or a lost executor the same ids are known.

`jobs.new_ids` stays in the JVM and fits feeds whose own time tells when an id is done with;
this one is for feeds that list the same ids for an unknown time.

With `ttl_seconds`, batches without rows keep running to clear out old ids. A run that is to end once
all input is read needs `spark.sql.streaming.noDataMicroBatches.enabled` off; old ids are
then cleared by the batches that have rows.

Defined results: of rows that share an id within a batch one is sent; rows without id
count as one id; further columns are kept; an empty batch sends nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues


class FirstSeen(StatefulProcessor):
    """Sends the first row of an id; every sighting renews what is known of it."""

    def __init__(self, ttl_seconds: int | None):
        self._ttl = None if ttl_seconds is None else ttl_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getValueState("seen", "known boolean", self._ttl)

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        self._seen.update((True,))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        known = self._seen.exists()
        if not known or self._ttl is not None:
            self._seen.update((True,))
        for i, batch in enumerate(rows):  # a hot id comes in many batches: only one is looked at
            if i == 0 and not known:
                yield batch.head(1)

    def close(self) -> None:
        pass


def first_seen(items: DataFrame, primed: DataFrame, ttl_seconds: int | None = None, id_col: str = "id") -> DataFrame:
    """The streaming `items` whose id is neither primed nor seen within `ttl_seconds` (None: ever)."""
    return items.groupBy(id_col).transformWithStateInPandas(
        statefulProcessor=FirstSeen(ttl_seconds),
        outputStructType=items.schema,
        outputMode="Append",
        timeMode="None" if ttl_seconds is None else "ProcessingTime",
        initialState=primed.select(id_col).groupBy(id_col),
    )
