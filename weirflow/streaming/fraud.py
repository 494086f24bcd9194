"""Fraud rules on a stream, in one pass of keyed state.

A user's events wait until the watermark has passed the end of their time bucket; then the bucket is judged in the order of event time.
State per user is the waiting events, the running sum and number of amounts, and the types seen. Each call of the state is a message
to Spark and back, so events wait packed, those of a micro-batch in one entry.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

NO_TYPE = "\0"


class FraudProcessor(StatefulProcessor):
    """A user has one timer, at the end of the earliest bucket that waits; when it fires, all that the watermark has passed is judged."""

    def __init__(self, bucket_ms: int, burst: int, factor: float):
        self.bucket_ms, self.burst, self.factor = bucket_ms, burst, factor

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.totals = handle.getValueState("totals", "cents bigint, n bigint, timer bigint, seen binary")

    def close(self) -> None:
        pass

    def _end(self, us: int) -> int:
        return (us // 1000 // self.bucket_ms + 1) * self.bucket_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if not key[1]:
            return iter(())
        now = timerValues.getCurrentWatermarkInMs()
        new = [(r.us, r.event_id, r.kind, r.cents, r.value) for r in rows if self._end(r.us) > now]
        if new:
            self.waiting.appendValue((pickle.dumps(new),))
            first = self._end(min(r[0] for r in new))
            cents, n, timer, seen = self.totals.get() or (0, 0, None, pickle.dumps(set()))
            if timer is None or first < timer:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(first)
                self.totals.update((cents, n, first, seen))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        held = [r for packed in self.waiting.get() for r in pickle.loads(packed[0])]
        due = sorted((r for r in held if self._end(r[0]) <= now), key=lambda r: (r[0], r[1] is None, r[1]))
        rest = [r for r in held if self._end(r[0]) > now]
        if rest:
            self.waiting.put([(pickle.dumps(rest),)])
            timer = self._end(min(r[0] for r in rest))
            self.handle.registerTimer(timer)
        else:
            self.waiting.clear()
            timer = None
        yield from self._judged(key[0], due, timer)

    def _judged(self, user: int, due: list, timer: int | None) -> Iterator[Row]:
        sizes = Counter(self._end(r[0]) for r in due)
        total, n, _, packed = self.totals.get()
        seen = pickle.loads(packed)
        found = []
        for us, event, kind, cents, value in due:
            rules = []
            if sizes[self._end(us)] > self.burst:
                rules.append("velocity")
            if n and value is not None and value > self.factor * (total / 100.0 / n):
                rules.append("amount")
            if kind not in seen:
                rules.append("new_type")
                seen.add(kind)
            if cents is not None:
                total, n = total + cents, n + 1
            if rules:
                found.append(Row(event_id=event, user_id=user, rules=",".join(rules)))
        self.totals.update((total, n, timer, pickle.dumps(seen)))
        yield from found


def fraud_stream(
    events: DataFrame, event_id: str, user: str, ts: str, kind: str, value: str, *, late_after: str = "10 minutes", bucket_seconds: int = 21_600, burst: int = 3, factor: float = 3.0,
) -> DataFrame:
    """(event_id, user_id, rules): events that break a rule: more than ``burst`` in a bucket, above ``factor`` times the user's mean so
    far, first of its kind. Events without user or time are not judged; rows later than ``late_after`` are left out."""
    # A filter would move below the watermark, which then never sees the rows left out. They go, spread by hash, to keys without state.
    known = F.col(user).isNotNull() & F.col(ts).isNotNull()
    rows = events.withWatermark(ts, late_after).select(
        F.when(known, F.col(user).cast("bigint")).otherwise(F.xxhash64(event_id, ts)).alias("user_id"), known.alias("known"), F.unix_micros(F.col(ts)).alias("us"), F.col(event_id).cast("bigint").alias("event_id"),
        F.coalesce(F.col(kind), F.lit(NO_TYPE)).alias("kind"), (F.col(value).cast("decimal(18,2)") * 100).cast("bigint").alias("cents"), F.col(value).cast("double").alias("value"))
    processor = FraudProcessor(bucket_seconds * 1000, burst, factor)
    return rows.groupBy("user_id", "known").transformWithState(processor, "event_id bigint, user_id bigint, rules string", "append", "eventTime")
