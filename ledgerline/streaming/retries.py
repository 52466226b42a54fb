"""The next success of every failed attempt, kept in event-time order by state and timers.

A user's undecided failures and the successes ahead of the watermark are the state. A failure is
decided when the watermark reaches its next success, or the end of the interval it may come in; it
is then given out once, with that success or with none, and leaves the state. A success behind the
watermark can serve no later failure and leaves too. So a user holds no more than what happened
within the watermark's delay and the interval.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OUT = "of string, failed_id long, failed_us long, success_id long, success_us long"


class NextSuccess(StatefulProcessor):
    """Per user: rows (event_id, us, failed) in, a row per decided failure out."""

    def __init__(self, within_us: int):
        self.within = within_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.failed = handle.getListState("failed", "id long, us long")
        self.won = handle.getListState("won", "id long, us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        failed, won = list(self.failed.get()), list(self.won.get())
        for frame in rows:
            for event, us, is_failed in zip(frame["event_id"].tolist(), frame["us"].tolist(), frame["failed"].tolist()):
                (failed if is_failed else won).append((event, us))
        yield self._decide(key, failed, won, timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._decide(key, list(self.failed.get()), list(self.won.get()), timerValues.getCurrentWatermarkInMs() * 1000)

    def _decide(self, key, failed, won, watermark: int) -> pd.DataFrame:
        user = None if pd.isna(key[0]) else key[0]
        won = sorted((us, event) for event, us in won) if user is not None else []  # nobody's success serves nobody
        times = [us for us, _ in won]
        out, open_, due = [], [], []
        for event, us in failed:
            at = bisect_right(times, us)
            found = won[at] if at < len(won) and times[at] <= us + self.within else None
            decided_at = found[0] if found else us + self.within
            if decided_at <= watermark:
                out.append((user, event, us, *(reversed(found) if found else (None, None))))
            else:
                open_.append((event, us))
                due.append(decided_at)
        ahead = [(event, us) for us, event in won if us > watermark]
        for state, held in ((self.failed, open_), (self.won, ahead)):
            if held:
                state.put(held)
            else:
                state.clear()
        moments = due + [us for _, us in ahead]  # a success alone leaves when the watermark passes it
        if moments:
            self.handle.registerTimer(-(-min(moments) // 1000))
        kinds = dict(field.split() for field in OUT.split(", "))
        return pd.DataFrame(out, columns=list(kinds)).astype({name: "Int64" if kind == "long" else "object" for name, kind in kinds.items()})

    def close(self) -> None:
        pass
