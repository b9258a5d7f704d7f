"""Keyed streaming operators whose state lives by event-time timers.

* ``timed_counts``: the trailing counts of the detection rules. Every event is counted when it comes, late
  ones too; a timer forgets a key as soon as the watermark has passed its last event's window.
* ``InOrder``: a reorder buffer. Rows wait until the watermark passes them and are then folded in
  event-time order, so that results do not depend on how the input was cut into batches or shuffled within
  the watermark's delay. Rows behind the watermark are dropped by Spark and show up in the progress
  as ``numRowsDroppedByWatermark``.
* ``condition_events``: sustained conditions per series, with events for their beginning and end, also when a
  series stops sending.
* ``counter_increases``, ``counter_rates``: counters as increases and windowed rates.

The timers need the RocksDB state store, which ``use_timers`` sets for the session's new queries. A
timer at t fires once the watermark is beyond t. With the ``availableNow`` trigger a last batch without data lets
the timers up to the final watermark fire.
"""

from __future__ import annotations

import os
import pickle
from collections.abc import Iterator, Sequence
from itertools import pairwise
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from doorledger.operators.detect import Rule
from doorledger.streaming.fraud import _OUT, _remaining, trailing_counts

_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_timers(spark: SparkSession) -> None:
    """Set what these operators need: the state store, and the package for the worker they start on the driver.

    State is then saved as a log of changes per batch, with whole copies in the background.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


class _Counts(StatefulProcessor):
    """State of a key: recent milliseconds, their numbers of events, and the timer that is set."""

    def __init__(self, windows: Sequence[int], limits: Sequence[int]):
        self.windows, self.limits = list(windows), list(limits)

    def init(self, handle) -> None:
        self.handle = handle
        self.recent = handle.getValueState("recent", "ms array<bigint>, n array<bigint>, timer bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        window = self.windows[key[0]]
        old = self.recent.get() if self.recent.exists() else ([], [], None)
        ms0, n0 = (np.asarray(x, dtype=np.int64) for x in old[:2])
        # frames come in any order, so a key's rows of a batch are put in order first
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["event_ms", "ingest_seq"], kind="stable")
        ms = pdf["event_ms"].to_numpy(dtype=np.int64)
        counts = trailing_counts(ms0, n0, ms, window)
        newest = max(int(ms[-1]), int(ms0[-1]) if len(ms0) else int(ms[-1]))
        kept = _remaining(ms0, n0, ms, window)
        timer = old[2]
        if timer is None:  # later events do not move it; when it fires, it looks again
            timer = newest + window + 1
            self.handle.registerTimer(timer)
        self.recent.update((*kept, timer))
        over = counts > self.limits[key[0]]
        if over.any():
            hit = pdf[over]
            yield pd.DataFrame({"rule": key[0], "key": key[1], "source_ip": hit["source_ip"],
                                "timestamp": hit["timestamp"], "count": counts[over]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ms, n, _ = self.recent.get()
        window, now = self.windows[key[0]], timerValues.getCurrentWatermarkInMs()
        keep = [i for i, t in enumerate(ms) if t + window + 1 >= now]
        if keep:
            timer = ms[keep[-1]] + window + 1
            self.handle.registerTimer(timer)
            self.recent.update(([ms[i] for i in keep], [n[i] for i in keep], timer))
        else:
            self.recent.clear()
        return iter(())

    def close(self) -> None:
        pass


def timed_counts(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rule rows of a stream that has a watermark, to their counts above the rule's threshold."""
    use_timers(rows.sparkSession)
    # without the watermarked column no row counts as too late
    return (rows.select("rule", "key", "event_ms", "ingest_seq", "source_ip", "timestamp").groupBy("rule", "key")
            .transformWithStateInPandas(_Counts([r.window_ms for r in rules], [r.threshold for r in rules]),
                                        _OUT, "append", "eventTime"))


#: Series are dealt over so many groups; saved state depends on it. Rows of a saved chunk, and rows folded at a time.
_SHARDS, _CHUNK, _STEP = 256, 8192, 1 << 18


def _series(columns: list[pa.ChunkedArray]) -> tuple[np.ndarray, list[tuple]]:
    """A number per row and, by number, the key columns' values of its series."""
    codes = np.zeros(len(columns[0]), dtype=np.int64)
    for column in columns:
        encoded = column.combine_chunks().dictionary_encode("encode")
        codes = pd.factorize(codes * len(encoded.dictionary) + encoded.indices.to_numpy())[0]
    _, first = np.unique(codes, return_index=True)
    return codes, list(zip(*[column.take(pa.array(first)).to_pylist() for column in columns], strict=True))


def _packed(rows: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema) as writer:
        writer.write_table(rows)
    return out.getvalue().to_pybytes()


def _unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(bytes(blob)).read_all()


class InOrder(StatefulProcessor):
    """Folds the rows (``us``, ``v``) of series in order of time, once the watermark has passed them.

    A group holds many series, so that calls and saved values do not grow with their number. Rows wait in
    chunks sorted by time, which are read one after the other: a fold holds a step's rows, whatever a series' length.
    A subclass gives ``OUT`` (names of its columns) and ``fold``, or ``fold_all``.
    """

    VALUE, OUT = np.float64, ()

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "n bigint", "packed binary")
        self.index = handle.getValueState("index", "timer bigint, n array<bigint>, first array<bigint>")
        self.folded = handle.getValueState("folded", "states binary")

    def fold(self, state: tuple | None, us: list[int], values: list, limit: int) -> tuple[tuple | None, list[tuple], int | None]:
        """State after a series' rows, which lie before ``limit``; rows out; when to look again without new rows."""
        raise NotImplementedError

    def fold_all(self, names: list[tuple], codes: np.ndarray, us: np.ndarray, values: np.ndarray, states: dict, limit: int) -> Iterator[pd.DataFrame]:
        """Rows out of many series, whose rows come by number and time; ``states`` gets their states and when to look again."""
        cuts = np.searchsorted(codes, np.arange(len(names) + 1)).tolist()
        us, values, found = us.tolist(), values.tolist(), []
        for name, (a, b) in zip(names, pairwise(cuts), strict=True):
            state, out, again = self.fold(states.get(name, (None,))[0], us[a:b], values[a:b], limit)
            if state is None:
                states.pop(name, None)
            else:
                states[name] = (state, again)
            found += [(*name, *row) for row in out]
        if found:
            columns = [*[f"k{i}" for i in range(len(names[0]))], *self.OUT]
            yield pd.DataFrame({c: [row[i] for row in found] for i, c in enumerate(columns)})

    def _fold_rows(self, rows: pa.Table, states: dict, limit: int) -> Iterator[pd.DataFrame]:
        codes, names = _series(rows.columns[:-2])
        us, values = (rows[c].to_numpy() for c in ("us", "v"))
        order = np.lexsort((values, us, codes))
        yield from self.fold_all(names, codes[order], us[order], values[order], states, limit)

    def _hold(self, rows: pa.Table, ids: list[int], firsts: list[int]) -> None:
        rows = rows.take(pa.array(np.argsort(rows["us"].to_numpy(), kind="stable")))
        for at in range(0, rows.num_rows, _CHUNK):
            chunk = rows.slice(at, _CHUNK)
            ids.append(max(ids, default=-1) + 1)
            firsts.append(chunk["us"][0].as_py())
            self.held.updateValue((ids[-1],), (_packed(chunk),))

    def _remember(self, timer: int | None, ids: list[int], firsts: list[int], again: int | None = None) -> None:
        """Look at this group when the watermark reaches its first chunk, or what its states wait for."""
        wake = firsts if again is None else [*firsts, again]
        ms = min(wake) // 1000 - 1 if wake else None  # a timer fires when the watermark is beyond it
        if timer is not None and (ms is None or ms < timer):
            self.handle.deleteTimer(timer)
        if ms is not None and (timer is None or ms < timer):
            self.handle.registerTimer(ms)
            timer = ms
        if wake:
            self.index.update((timer, ids, firsts))
        elif self.index.exists():
            self.index.clear()

    def _known(self) -> tuple[int | None, list[int], list[int]]:
        timer, ids, firsts = self.index.get() if self.index.exists() else (None, [], [])
        return timer, list(ids), list(firsts)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        timer, ids, firsts = self._known()
        run, n = [], 0
        for pdf in rows:
            keys = [c for c in pdf.columns if c.startswith("k")]
            run.append(pa.table({**{c: pa.array(pdf[c], pa.string(), from_pandas=True) for c in keys},
                                 "us": pdf["us"].to_numpy(np.int64), "v": pdf["v"].to_numpy(self.VALUE)}))
            n += len(pdf)
            if n >= _STEP:
                self._hold(pa.concat_tables(run), ids, firsts)
                run, n = [], 0
        if n:
            self._hold(pa.concat_tables(run), ids, firsts)
        self._remember(timer, ids, firsts)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        limit = (timerValues.getCurrentWatermarkInMs() + 1) * 1000
        _, ids, firsts = self._known()
        states = pickle.loads(self.folded.get()[0]) if self.folded.exists() else {}
        due = sorted((first, n) for first, n in zip(firsts, ids, strict=True) if first < limit)
        later = [(n, first) for first, n in zip(firsts, ids, strict=True) if first >= limit]
        ids, firsts = [n for n, _ in later], [first for _, first in later]
        run, size, room = [], 0, _STEP
        for (_, n), following in zip(due, [*due[1:], None], strict=False):
            run.append(_unpacked(self.held.getValue((n,))[0]))
            self.held.removeKey((n,))
            size += run[-1].num_rows
            if following is not None and size < room:
                continue
            bound = limit if following is None else following[0]  # no chunk to come holds an earlier row
            rows = pa.concat_tables(run)
            now = rows["us"].to_numpy() < bound
            if now.any():
                yield from self._fold_rows(rows.filter(pa.array(now)), states, bound)
            run = [rows.filter(pa.array(~now))]
            size = run[0].num_rows
            room = size + _STEP
        if size:
            self._hold(run[0], ids, firsts)
        idle = [name for name, (_, again) in states.items() if again is not None and again < limit]
        if idle:
            none = np.array([], dtype=np.int64)
            yield from self.fold_all(idle, none, none, none, states, limit)
        if states:
            self.folded.update((pickle.dumps(states, protocol=5),))
        elif self.folded.exists():
            self.folded.clear()
        self._remember(None, ids, firsts, min((again for _, again in states.values() if again is not None), default=None))

    def close(self) -> None:
        pass


def _as_text(rows: DataFrame, key: str) -> Column:
    kind, value = rows.schema[key].dataType, F.col(key)
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.to_json(F.struct(value.alias("k")))
    # zeros are equal, whatever their sign
    return (value + F.lit(0.0) if isinstance(kind, (T.FloatType, T.DoubleType)) else value).cast("string")


def _from_text(text: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.BinaryType):
        return F.unhex(text)
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.from_json(text, T.StructType([T.StructField("k", kind)]))["k"]
    return F.col(text).cast(kind)


def in_order(rows: DataFrame, keys: Sequence[str], ts: str, value: Column, processor: InOrder, out: T.StructType,
             event_time: str = "") -> DataFrame:
    """``processor`` over the stream's rows by ``keys``; ``ts`` must carry the watermark."""
    use_timers(rows.sparkSession)
    # the operator's frames keep no names that begin with an underscore
    names = [f"k{i}" for i in range(len(keys))]
    named = rows.select(*[_as_text(rows, k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(ts).alias("marked"),
                        F.unix_micros(F.col(ts)).alias("us"), value.alias("v"))
    folded = named.withColumn("shard", F.pmod(F.xxhash64(*names), F.lit(_SHARDS)).cast("int")).groupBy("shard").transformWithStateInPandas(
        processor, T.StructType([*[T.StructField(n, T.StringType()) for n in names], *out]), "append", "eventTime", None, event_time)
    return folded.select(*[_from_text(n, rows.schema[k].dataType).alias(k) for k, n in zip(keys, names, strict=True)], *out.names)


def _time(us: int) -> pd.Timestamp:
    return pd.Timestamp(us, unit="us", tz="UTC")


def _times(us: np.ndarray) -> pd.Series:
    return pd.Series(us.astype("datetime64[us]")).dt.tz_localize("UTC")


class _Condition(InOrder):
    """Whether a series' condition holds, since when, and whether that was reported."""

    VALUE, OUT = np.bool_, ("event", "started", "at")

    def __init__(self, hold_us: int, stale_us: int, absent: bool):
        self.hold_us, self.stale_us, self.absent = hold_us, stale_us, absent

    def fold(self, state, us, values, limit):
        last, since, fired, stale = state or (None, None, False, False)
        out = []

        def now(at: int, holds: bool) -> None:
            nonlocal since, fired
            if holds and since is None:
                since, fired = at, False
            elif not holds and since is not None:
                if fired:
                    out.append(("resolved", _time(since), _time(at)))
                since, fired = None, False

        def due() -> tuple[float, float]:
            gone = float("inf") if stale or last is None else last + self.stale_us
            return gone, float("inf") if since is None or fired else since + self.hold_us

        def pass_(before: int) -> None:
            """What happens by itself before this time."""
            nonlocal stale, fired
            while True:
                gone, fires = due()
                if min(gone, fires) >= before:
                    return
                if gone <= fires:
                    stale = True
                    now(last + self.stale_us, self.absent)
                else:
                    fired = True
                    out.append(("firing", _time(since), _time(since + self.hold_us)))

        samples: dict[int, bool] = {}
        for t, v in zip(us, values, strict=True):  # of one moment any sample may hold
            samples[t] = samples.get(t, False) or bool(v)
        for t, holds in samples.items():
            pass_(t)
            last, stale = t, False
            now(t, holds)
        pass_(limit)
        if stale and not self.absent:
            return None, out, None  # nothing to remember of a series that is gone
        nxt = min(due())
        return (last, since, fired, stale), out, int(nxt) if nxt < float("inf") else None


def condition_events(samples: DataFrame, keys: Sequence[str], holds: Column, seconds: float, stale_seconds: float = 300,
                     absent: bool = False, ts: str = "ts") -> DataFrame:
    """(keys, event, started, at): when a condition has held for ``seconds``, and when it ended after that.

    A sample counts until the series' next one, at most ``stale_seconds``. After that the series is absent, and the condition
    ends; with ``absent=True`` it holds then, as for a job that is down: such an alert fires although no sample
    comes any more. ``samples`` needs a watermark on ``ts``.
    """
    out = T.StructType.fromDDL("event string, started timestamp, at timestamp")
    return in_order(samples, keys, ts, F.coalesce(holds, F.lit(False)),
                    _Condition(int(seconds * 1e6), int(stale_seconds * 1e6), absent), out)


class _Increase(InOrder):
    """The last sample of a counter."""

    OUT = ("ts", "prev_ts", "increase")

    def __init__(self, forget_us: int | None):
        self.forget_us = forget_us

    def fold_all(self, names, codes, us, values, states, limit):
        if not len(us):  # silent series
            for name in names:
                del states[name]
            return
        starts = np.searchsorted(codes, np.arange(len(names)))
        ends = np.append(starts[1:], len(us)) - 1
        none = (0, np.nan)
        known = [name in states for name in names]
        before = [states[name][0] if name in states else none for name in names]
        prev_us, prev = np.roll(us, 1), np.roll(values, 1)
        prev_us[starts], prev[starts] = [t for t, _ in before], [v for _, v in before]
        has = np.ones(len(us), dtype=bool)
        has[starts] = known
        if self.forget_us is not None:
            has &= us - prev_us <= self.forget_us
        for name, t, v in zip(names, us[ends].tolist(), values[ends].tolist(), strict=True):
            again = None if self.forget_us is None else t + self.forget_us
            if again is not None and again < limit:
                states.pop(name, None)
            else:
                states[name] = ((t, v), again)
        columns = zip(*names, strict=True)
        yield pd.DataFrame({**{f"k{i}": np.array(c, dtype=object)[codes] for i, c in enumerate(columns)},
                            "ts": _times(us), "prev_ts": _times(prev_us).where(has),
                            "increase": np.where(has, np.where(values < prev, values, values - prev), np.nan)})


def counter_increases(samples: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value",
                      forget_seconds: float | None = None) -> DataFrame:
    """(keys, ts, prev_ts, increase) of each sample against the series' sample before it, resets as in the batch form.

    Rows come in order of time once the watermark has passed them, and keep it for what follows. A series
    that is silent for ``forget_seconds`` begins anew.
    """
    out = T.StructType.fromDDL("ts timestamp, prev_ts timestamp, increase double")
    forget = None if forget_seconds is None else int(forget_seconds * 1e6)
    return in_order(samples, keys, ts, F.col(value).cast("double"), _Increase(forget), out, "ts")


def counter_rates(samples: DataFrame, keys: Sequence[str], by: Sequence[str], window: str, seconds: float, ts: str = "ts",
                  value: str = "value", forget_seconds: float | None = None) -> DataFrame:
    """Per ``by`` and tumbling window: total increase and increase per second, when the watermark has passed its end."""
    inc = counter_increases(samples, keys, ts, value, forget_seconds)
    return (inc.groupBy(*by, F.window("ts", window).alias("_w"))
            .agg(F.coalesce(F.sum("increase"), F.lit(0)).alias("increase"))
            .select(*by, F.col("_w.start").alias("window_start"), "increase",
                    (F.col("increase") / F.lit(float(seconds))).alias("rate")))
