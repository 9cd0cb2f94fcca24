"""I5 with bounded state: the first record per key, until the key has been quiet to the stream for a while.

A kept record silences its key for ``delay`` of event time.  A record of the key inside that
time is a duplicate; the first one after it is kept and silences the key anew.  State is one
timestamp per key that was kept within the last ``delay``: an event-time timer evicts it as
soon as the watermark has passed, so the state follows the keys of one delay, not of the
stream.  The answer depends on the records' times alone, not on where micro-batches are cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def _first_after(times: np.ndarray, last: int | None, delay: int) -> list[int]:
    """Places in the sorted ``times`` (microseconds) of the records that are kept."""
    kept, at = [], 0
    while True:
        if last is not None:
            at = int(np.searchsorted(times, last + delay, side="right"))
        if at >= len(times):
            return kept
        kept.append(at)
        last = int(times[at])


def keep_first(stream: DataFrame, key: str, event_time: str, delay_seconds: int, lateness: str = "0 seconds") -> DataFrame:
    """The stream's records that no kept record of their key precedes by ``delay_seconds`` or less.

    Records later than ``lateness`` behind the watermark are dropped, as everywhere in
    Structured Streaming; records of equal key and time are one.  Null keys are a key,
    null times are dropped.  Other columns come along.
    """
    delay = int(delay_seconds * 1_000_000)
    out = stream.schema
    names = out.fieldNames()

    def run(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        # Only the records that can still be kept are held: the first of each time, after the last kept one.
        frames = list(frames)
        rows = frames[0] if len(frames) == 1 else pd.concat(frames)
        times = rows[event_time].to_numpy().astype("datetime64[us]").astype(np.int64)
        if len(rows) > 1:
            # By time; the other columns only decide between records of one time, and are only sorted if there are any.
            order = np.argsort(times, kind="stable")
            if (np.diff(times[order]) == 0).any():
                order = rows.reset_index(drop=True).sort_values([event_time, *[c for c in names if c not in (event_time, key)]], kind="stable").index.to_numpy()
            rows, times = rows.iloc[order], times[order]
        kept = _first_after(times, last, delay)
        if kept:
            last = int(times[kept[-1]])
            state.update((last,))
        if last is not None:
            # A timer must lie ahead of the watermark; one that is due at once fires with the next batch.
            state.setTimeoutTimestamp(max((last + delay) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        if kept:
            yield rows.iloc[kept][names]

    held = T.StructType([T.StructField("last", T.LongType())])
    return (stream.filter(f"`{event_time}` IS NOT NULL").withWatermark(event_time, lateness).groupBy(key)
            .applyInPandasWithState(run, out, held, "append", GroupStateTimeout.EventTimeTimeout))
