"""Custom keyed state for stream operators Spark has no built-in for.

Each processor keeps O(1) state per key (a ValueState), never the key's rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def _epoch_micros(s: pd.Series) -> np.ndarray:
    """Epoch microseconds of a pandas timestamp column, aware or naive (naive = UTC)."""
    if getattr(s.dt, "tz", None) is not None:
        s = s.dt.tz_convert("UTC").dt.tz_localize(None)
    return s.astype("datetime64[us]").astype(np.int64).to_numpy()


class KeyedLateSplit(StatefulProcessor):
    """Tag rows late / ok against a per-key watermark (max event time - delay - 1 ms).

    Spark's own watermark drops late rows one micro-batch later and cannot
    route them to a side output, so the watermark is held in keyed state.
    Rows of a key are taken in arrival order (``arrival_ts``, ``event_id``).
    """

    delay_ms = 300_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.max_ts = handle.getValueState("max_ts", "us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values(
            ["arrival_ts", "event_id"], kind="stable")
        ts_us = _epoch_micros(batch["ts"])
        prev = np.maximum.accumulate(ts_us)
        start = int(self.max_ts.get()[0]) if self.max_ts.exists() else None
        before = np.empty_like(prev)
        before[0] = start if start is not None else np.iinfo(np.int64).min
        before[1:] = prev[:-1]
        if start is not None:
            before = np.maximum(before, start)
        has_wm = before != np.iinfo(np.int64).min
        wm_us = before - (self.delay_ms + 1) * 1000
        late = has_wm & (ts_us < wm_us)
        self.max_ts.update((int(max(prev[-1], start if start is not None else prev[-1])),))
        wm = pd.to_datetime(np.where(has_wm, wm_us, 0), unit="us").where(has_wm)
        yield pd.DataFrame({"event_id": batch["event_id"].to_numpy(dtype=np.int64),
                            "ts": batch["ts"].to_numpy(), "wm": wm,
                            "status": np.where(late, "late", "ok")})

    def close(self) -> None:
        pass


class ArrivalAlarm(StatefulProcessor):
    """Per key: report each arrival at once, and raise an alarm ``delay_ms`` of
    processing time after it (a processing-time timer per arrival).

    Output rows are (key, kind, at_ms) with kind ``arrival`` or ``alarm``.
    Alarms need a live query (a processing-time trigger); a run-to-completion
    query stops before they are due. A key has one timer per instant: arrivals of one instant share an alarm.
    """

    delay_ms = 10_000

    def __init__(self, delay_ms: int | None = None) -> None:
        if delay_ms is not None:
            self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        out = []
        for _ in rows:
            out.append(Row(key=key[0], kind="arrival", at_ms=now))
        self.handle.registerTimer(now + self.delay_ms)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return iter([Row(key=key[0], kind="alarm", at_ms=expiredTimerInfo.getExpiryTimeInMs())])

    def close(self) -> None:
        pass


class Reconciler(StatefulProcessor):
    """Match an order with its first payment within ``within_ms`` of event time.

    The first side of a key to arrive waits, with an event-time timer at its
    time + ``within_ms``.  A partner in time gives ``matched`` and deletes the
    pending timer; a timer that fires reports ``order_timeout`` or
    ``payment_timeout``.  A side whose deadline has passed when the next event
    of its key arrives times out at once, so the outcome does not depend on how
    events fall into micro-batches.  Only the first payment of an order counts;
    two ``done`` flags per key make later ones no-ops.  Those flags are the only
    state kept after a key is decided (state TTL needs processing-time mode).

    Each call reads and writes the key's state once and touches timers only for
    sides still waiting when the call ends (every state or timer operation is a
    round trip to the JVM).  Grouped by (key, ``is_end``); input: ``side`` ('order' / 'pay'), ``ts_ms``.
    """

    within_ms = 90 * 86_400_000

    def __init__(self, within_ms: int | None = None) -> None:
        if within_ms is not None:
            self.within_ms = within_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(
            "match", "order_ts long, pay_ts long, order_done boolean, pay_done boolean")

    def _load(self):
        got = self.state.get()
        return list(got) if got is not None else [None, None, False, False]

    def _expire(self, key, st, now, out) -> None:
        """Time out the waiting sides whose deadline lies before ``now``."""
        for side, status in ((0, "order_timeout"), (1, "payment_timeout")):
            if st[side] is not None and now > st[side] + self.within_ms:
                out.append(Row(o_orderkey=key, status=status, at_ms=st[side]))
                st[side], st[2 + side] = None, True

    def _sync_timers(self, before, st) -> None:
        """Register / delete timers so exactly the waiting sides have one."""
        for side in (0, 1):
            if before[side] != st[side]:
                if before[side] is not None:
                    self.handle.deleteTimer(before[side] + self.within_ms)
                if st[side] is not None:
                    self.handle.registerTimer(st[side] + self.within_ms)

    def handleInputRows(self, key, rows, timerValues):
        k, is_end = key
        if is_end:  # the end-of-input marker only moves the watermark
            return iter([])
        st, out = self._load(), []
        before = list(st)
        for ts, side in sorted((r.ts_ms, r.side) for r in rows):
            self._expire(k, st, ts, out)
            mine, other = (0, 1) if side == "order" else (1, 0)
            if st[2 + mine] or st[mine] is not None:
                continue  # a later duplicate of a side already seen
            if st[other] is not None:  # the partner is waiting and still in time
                at = st[0] if other == 0 else ts
                out.append(Row(o_orderkey=k, status="matched", at_ms=at))
                st[other] = None
                st[2], st[3] = True, True
            else:
                st[mine] = ts
        self._sync_timers(before, st)
        self.state.update(tuple(st))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        k = key[0]
        st, out = self._load(), []
        before = list(st)
        self._expire(k, st, expiredTimerInfo.getExpiryTimeInMs() + 1, out)
        # The fired timer is gone already; only other changes need syncing.
        fired = expiredTimerInfo.getExpiryTimeInMs() - self.within_ms
        before = [None if b == fired else b for b in before[:2]] + before[2:]
        self._sync_timers(before, st)
        self.state.update(tuple(st))
        return iter(out)

    def close(self) -> None:
        pass
