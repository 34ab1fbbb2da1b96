"""Sessions of a stream, repaired when late rows extend or join them.

State holds a key's open sessions. Rows of a batch, in any order, extend them, begin new ones, or
close the gap between two, which then become one. Each change is given out as it is made: a
session under its key and start, or that the session of a start is gone. A timer drops a session
from the state when the watermark shows that no row can reach it any more, so the state holds
what is younger than the lateness and the gap.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class SessionRepair(StatefulProcessor):
    """Rows of (key, at in microseconds) to changes (key, first, last, n; n is 0 for a session that is gone)."""

    def __init__(self, key: str, gap: int):
        self.key, self.gap = key, gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("sessions", "first long", "last long, n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        before = {k[0]: (v[0], v[1]) for k, v in self.open.iterator()}
        spans = [(first, last, n) for first, (last, n) in before.items()]
        for batch in rows:
            counts = batch["micros"].value_counts()
            spans += [(int(at), int(at), int(n)) for at, n in counts.items()]
        after: dict[int, tuple[int, int]] = {}
        current = None
        for first, last, n in sorted(spans):
            if current is not None and first < current[1] + self.gap:
                current = (current[0], max(current[1], last), current[2] + n)
            else:
                if current is not None:
                    after[current[0]] = current[1:]
                current = (first, last, n)
        if current is not None:
            after[current[0]] = current[1:]
        changes = [(first, 0, 0) for first in before if first not in after]
        for first, _, _ in changes:
            self.open.removeKey((first,))
        for first, now in after.items():
            if before.get(first) != now:
                self.open.updateValue((first,), now)
                self.handle.registerTimer((now[0] + self.gap) // 1000 + 1)
                changes.append((first, *now))
        if changes:
            yield pd.DataFrame({self.key: [key[0]] * len(changes), "first": [c[0] for c in changes], "last": [c[1] for c in changes], "n": [c[2] for c in changes]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        for first in [k[0] for k, v in self.open.iterator() if v[0] + self.gap <= passed]:
            self.open.removeKey((first,))
        return iter(())

    def close(self) -> None:
        pass


def session_changes(stream: DataFrame, key: str, at: str, gap_seconds: int) -> DataFrame:
    """Changes of sessions of a stream with a watermark on at: key, first, last (microseconds), n. Rows with a null key or time are left out."""
    kind = dict(stream.dtypes)[key]
    rows = stream.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(key, at, F.unix_micros(at).alias("micros"))
    return rows.groupBy(key).transformWithStateInPandas(SessionRepair(key, gap_seconds * 1_000_000), f"`{key}` {kind}, first long, last long, n long", "Update", "EventTime")


def numbered(batch: DataFrame, number: int) -> DataFrame:
    return batch.withColumn("batch", F.lit(number))


def sessions_of(changes: DataFrame, key: str) -> DataFrame:
    """The sessions that numbered changes add up to: key, first_ts, last_ts, n_events."""
    now = changes.groupBy(key, "first").agg(F.max_by(F.struct("last", "n"), "batch").alias("v")).where("v.n > 0")
    return now.select(key, F.timestamp_micros("first").alias("first_ts"), F.timestamp_micros("v.last").alias("last_ts"), F.col("v.n").alias("n_events"))
