"""Streaming detection: one keyed stateful operator over (rule, key).

Spark allows one such operator per query, so an event is turned into one row per rule it
counts for and both rules share one shuffle, one state store and one checkpoint.

State of a key is its recent milliseconds with their number of events: at most one entry per
millisecond of the window, however many events arrive. Within a micro-batch a key's events
are taken in order of (event time, ``ingest_seq``); late ones are counted against what is
still stored, never dropped.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from doorledger.functions.events import alert_json, log_events
from doorledger.operators.detect import (Rule, alerts_from_counts, brute_force_rule, rule_rows,
                                         spam_rule)

WATERMARK = "5 seconds"
_STATE = "ms array<bigint>, n array<bigint>"
_OUT = "rule int, key string, source_ip string, timestamp string, count bigint"


def _stored(state: GroupState) -> tuple[np.ndarray, np.ndarray]:
    if not state.exists:
        return np.array([], dtype=np.int64), np.array([], dtype=np.int64)
    ms, n = state.get
    return np.asarray(ms, dtype=np.int64), np.asarray(n, dtype=np.int64)


def trailing_counts(stored_ms: np.ndarray, stored_n: np.ndarray, ms: np.ndarray, window_ms: int
                    ) -> np.ndarray:
    """Counts for a batch in order, given what is stored: both parts by binary search."""
    left = ms - window_ms
    batch = np.arange(1, len(ms) + 1) - np.searchsorted(ms, left, side="right")
    upto = np.concatenate(([0], np.cumsum(stored_n)))
    return batch + upto[-1] - upto[np.searchsorted(stored_ms, left, side="right")]


def _remaining(stored_ms: np.ndarray, stored_n: np.ndarray, ms: np.ndarray, window_ms: int
               ) -> tuple[list[int], list[int]]:
    """What stays in the window that ends with the batch's last event."""
    both = np.concatenate((stored_ms, ms))
    n = np.concatenate((stored_n, np.ones(len(ms), dtype=np.int64)))
    keep = both > ms[-1] - window_ms
    values, place = np.unique(both[keep], return_inverse=True)
    return values.tolist(), np.bincount(place, weights=n[keep]).astype(np.int64).tolist()


def count_stream(rows: DataFrame, rules: Sequence[Rule], evict_idle: bool = False) -> DataFrame:
    """Rule rows of a stream to their counts above the rule's threshold.

    ``evict_idle`` also forgets keys that stopped sending, once event time has passed their
    window. Use it in jobs that run all the time: the timeouts it needs keep starting batches,
    so a query with the ``availableNow`` trigger would not end.
    """
    windows = [r.window_ms for r in rules]
    limits = [r.threshold for r in rules]

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
             ) -> Iterator[pd.DataFrame]:
        window = windows[key[0]]
        ms0, n0 = _stored(state)
        if state.hasTimedOut:
            # idle for a while: forget the key once event time has passed its window
            if len(ms0) == 0 or state.getCurrentWatermarkMs() > int(ms0[-1]) + window:
                state.remove()
            else:
                state.setTimeoutDuration(window)
            return
        pdf = pd.concat(list(frames), ignore_index=True).sort_values(
            ["event_ms", "ingest_seq"], kind="stable")
        ms = pdf["event_ms"].to_numpy(dtype=np.int64)
        counts = trailing_counts(ms0, n0, ms, window)
        state.update(_remaining(ms0, n0, ms, window))
        if evict_idle:
            state.setTimeoutDuration(window)
        over = counts > limits[key[0]]
        if over.any():
            hit = pdf[over]
            yield pd.DataFrame({"rule": key[0], "key": key[1], "source_ip": hit["source_ip"],
                                "timestamp": hit["timestamp"], "count": counts[over]})

    # the event time is kept so that the operator knows the watermark
    return (rows.select("rule", "key", "event_ms", "ingest_seq", "source_ip", "timestamp",
                        "event_ts")
            .groupBy("rule", "key")
            .applyInPandasWithState(step, _OUT, _STATE, "append",
                                    GroupStateTimeout.ProcessingTimeTimeout if evict_idle
                                    else GroupStateTimeout.NoTimeout))


def fraud_stream(events: DataFrame, rules: Sequence[Rule] | None = None,
                 watermark: str = WATERMARK, evict_idle: bool = False,
                 timers: bool = False) -> DataFrame:
    """Flat events (with ``event_ts``) to alerts.

    With ``timers`` keys are forgotten by event time, also under the ``availableNow`` trigger.
    """
    rules = list(rules) if rules is not None else [spam_rule(), brute_force_rule()]
    rows = rule_rows(events.withWatermark("event_ts", watermark), rules, ["event_ts"])
    if timers:
        from doorledger.streaming.timers import timed_counts
        return alerts_from_counts(timed_counts(rows, rules), rules)
    return alerts_from_counts(count_stream(rows, rules, evict_idle), rules)


def fraud_job(values: DataFrame, rules: Sequence[Rule] | None = None, watermark: str = WATERMARK,
              bad_time: str = "now", evict_idle: bool = False, timers: bool = False) -> DataFrame:
    """The whole job on raw topic values: parse, detect, alerts as JSON values.

    An event with an unreadable time counts at its processing time, so that none escapes.
    """
    return alert_json(fraud_stream(log_events(values, bad_time=bad_time), rules, watermark,
                                   evict_idle, timers))
