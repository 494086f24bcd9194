"""Window results before, at and after the end of a window.

A pane is one emission of a window's result. Early panes fire before the end of a window, one fires at the end, and late panes fire
for rows within the allowed lateness. Accumulating panes carry the whole result so far, discarding panes what is new.

``window_panes`` fires early and late panes by counts of rows, on the watermark. Spark has one delay where other engines tell watermark
and allowed lateness apart. The delay given to Spark is the allowed lateness, and the end-of-window pane uses a timer that much before
the window's end on Spark's clock, which is the moment the undelayed watermark passes the end. Whether a row is too late is decided
by its window and not by its own time, so rows can be added up before the shuffle.

``clock_panes`` fires them by time: so long after the first row that no pane has shown yet, on the clock of arrivals (the broker's
timestamps). That clock is what Spark takes as event time, so timers fire for keys without new rows as well, and a replay gives the
same panes as the live stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PANE_SCHEMA = (
    "key string, window_start timestamp, window_end timestamp, pane string, pane_no bigint, n bigint, total double"
)
STATE_SCHEMA = "n bigint, cents bigint, shown_n bigint, shown_cents bigint, panes bigint, closed boolean, due bigint"
MODES = ("accumulating", "discarding")
_PARTIAL = "key string, window_ms bigint, at_ms bigint, n bigint, cents bigint"
_EMPTY = (0, 0, 0, 0, 0, False, 0)


def _combine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Add up the rows of each key, window and arrival inside an Arrow batch, so a hot key shuffles one row per batch and moment."""
    for pdf in frames:
        yield pdf.groupby(["key", "window_ms", "at_ms"], as_index=False, dropna=False).agg(n=("n", "sum"), cents=("cents", "sum"))


class _Panes(StatefulProcessor):
    """State of one key and window: totals, what has been shown of them, whether the window has ended, when the next pane is due."""

    def __init__(self, window_ms: int, accumulating: bool):
        self.window_ms, self.accumulating = window_ms, accumulating

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("totals", STATE_SCHEMA)

    def close(self) -> None:
        pass

    def load(self) -> None:
        self.n, self.cents, self.shown_n, self.shown_cents, self.no, self.closed, self.due = self.state.get() if self.state.exists() else _EMPTY

    def save(self) -> None:
        self.state.update((self.n, self.cents, self.shown_n, self.shown_cents, self.no, self.closed, self.due))

    def pane(self, kind: str) -> tuple:
        """One emission; all that has come is shown after it."""
        out = (kind, self.no, *((self.n, self.cents) if self.accumulating else (self.n - self.shown_n, self.cents - self.shown_cents)))
        self.no, self.shown_n, self.shown_cents, self.due = self.no + 1, self.n, self.cents, 0
        return out

    def frame(self, key, shown: list[tuple]) -> Iterator[pd.DataFrame]:
        if shown:
            name, start = key
            bounds = [pd.Timestamp(start + x, unit="ms", tz="UTC") for x in (0, self.window_ms)]
            yield pd.DataFrame([(name, *bounds, kind, no, n, cents / 100.0) for kind, no, n, cents in shown], columns=["key", "window_start", "window_end", "pane", "pane_no", "n", "total"])


class PaneProcessor(_Panes):
    """Panes by counts, on the watermark."""

    def __init__(self, window_ms: int, lateness_ms: int, early: int, late: int, accumulating: bool):
        super().__init__(window_ms, accumulating)
        self.lateness_ms, self.early, self.late = lateness_ms, early, late

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        end, now, shown = key[1] + self.window_ms, timerValues.getCurrentWatermarkInMs(), []
        if now >= end:  # the allowed lateness has run out: these rows are dropped
            return
        known = self.state.exists()
        self.load()
        if not known:
            self.handle.registerTimer(max(1, end - self.lateness_ms))
            self.handle.registerTimer(end)
        if not self.closed and now >= end - self.lateness_ms:
            # The window ended before these rows came: they are late, and what was there comes out first.
            if known:
                shown.append(self.pane("on_time"))
            self.closed = True
        for pdf in rows:
            self.n += int(pdf["n"].sum())
            self.cents += int(pdf["cents"].sum())
        if self.n - self.shown_n >= (self.late if self.closed else self.early):
            shown.append(self.pane("late" if self.closed else "early"))
        self.save()
        yield from self.frame(key, shown)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        self.load()
        shown = []
        if not self.closed:
            shown.append(self.pane("on_time"))
            self.closed = True
        if expiredTimerInfo.getExpiryTimeInMs() >= key[1] + self.window_ms:
            if self.n > self.shown_n:  # late rows that did not reach the count
                shown.append(self.pane("late"))
            self.state.clear()
        else:
            self.save()
        yield from self.frame(key, shown)


class ClockPaneProcessor(_Panes):
    """Panes by time, on the clock of arrivals. A window ends ``skew_ms`` after its end on that clock."""

    def __init__(self, window_ms: int, skew_ms: int, lateness_ms: int, early_ms: int, late_ms: int, accumulating: bool):
        super().__init__(window_ms, accumulating)
        self.skew_ms, self.lateness_ms, self.early_ms, self.late_ms = skew_ms, lateness_ms, early_ms, late_ms

    def advance(self, end: int, now: int, shown: list) -> bool:
        """Let the clock run to ``now``; whether the window is still open for late rows."""
        closing, over = end + self.skew_ms, end + self.skew_ms + self.lateness_ms
        if self.due and self.due <= now and (self.closed or self.due < closing):
            shown.append(self.pane("late" if self.closed else "early"))
        if not self.closed and closing <= now:
            if self.n:
                shown.append(self.pane("on_time"))
            self.closed, self.due = True, 0
        if over <= now:
            if self.n > self.shown_n:
                shown.append(self.pane("late"))
            return False
        return True

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        end, shown, known = key[1] + self.window_ms, [], self.state.exists()
        self.load()
        came = pd.concat(list(rows)).groupby("at_ms")[["n", "cents"]].sum().sort_index()
        open_ = True
        for at, n, cents in zip(came.index.tolist(), came["n"].tolist(), came["cents"].tolist()):
            open_ = self.advance(end, at, shown)
            if not open_:
                break
            self.n, self.cents = self.n + n, self.cents + cents
            if not self.due:
                self.due = min(at + (self.late_ms if self.closed else self.early_ms), end + self.skew_ms + self.lateness_ms)
                self.handle.registerTimer(self.due)
        if open_:
            if not known:
                self.handle.registerTimer(max(1, end + self.skew_ms))
                self.handle.registerTimer(end + self.skew_ms + self.lateness_ms)
            self.save()
        elif known:
            self.state.clear()
        yield from self.frame(key, shown)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        self.load()
        shown: list = []
        if self.advance(key[1] + self.window_ms, expiredTimerInfo.getExpiryTimeInMs(), shown):
            self.save()
        else:
            self.state.clear()
        yield from self.frame(key, shown)


def _accumulating(mode: str) -> bool:
    if mode not in MODES:
        raise ValueError(f"panes are accumulating or discarding; {mode} is not supported")
    return mode == "accumulating"


def _partials(events: DataFrame, key: str, ts: str, at, value: str, window_ms: int) -> DataFrame:
    ms = F.unix_millis(F.col(ts))
    rows = events.filter(F.col(ts).isNotNull()).select(
        F.coalesce(F.col(key).cast("string"), F.lit("unknown")).alias("key"), (ms - F.pmod(ms, F.lit(window_ms))).alias("window_ms"), at.alias("at_ms"),
        F.lit(1).cast("bigint").alias("n"), F.coalesce((F.col(value).cast("decimal(18,2)") * 100).cast("bigint"), F.lit(0)).alias("cents"))
    return rows.mapInPandas(_combine, _PARTIAL)


def window_panes(
    events: DataFrame, key: str, ts: str, value: str, *, window_seconds: int = 3600, lateness_seconds: int = 600,
    early_count: int = 10, late_count: int = 5, mode: str = "accumulating",
) -> DataFrame:
    """Panes of count and sum per key and fixed window. ``ts`` must be a zoned timestamp."""
    processor = PaneProcessor(window_seconds * 1000, lateness_seconds * 1000, early_count, late_count, _accumulating(mode))
    partial = _partials(events.withWatermark(ts, f"{lateness_seconds} seconds"), key, ts, F.lit(0).cast("bigint"), value, window_seconds * 1000)
    return partial.groupBy("key", "window_ms").transformWithStateInPandas(processor, PANE_SCHEMA, "append", "eventTime")


def clock_panes(
    events: DataFrame, key: str, ts: str, arrived: str, value: str, *, window_seconds: int = 3600, skew_seconds: int = 0,
    lateness_seconds: int = 600, early_seconds: int = 60, late_seconds: int = 300, mode: str = "accumulating",
) -> DataFrame:
    """Panes of count and sum per key and fixed window, fired by the clock of ``arrived``; both times must be zoned timestamps.

    An early pane comes ``early_seconds`` after the first row that is not shown yet, a late one ``late_seconds`` after it.
    """
    processor = ClockPaneProcessor(window_seconds * 1000, skew_seconds * 1000, lateness_seconds * 1000, early_seconds * 1000, late_seconds * 1000, _accumulating(mode))
    partial = _partials(events.withWatermark(arrived, "0 seconds"), key, ts, F.unix_millis(F.col(arrived)), value, window_seconds * 1000)
    return partial.groupBy("key", "window_ms").transformWithStateInPandas(processor, PANE_SCHEMA, "append", "eventTime")
