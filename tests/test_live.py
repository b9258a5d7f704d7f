"""Streaming operators with event-time timers, restarts and late rows."""

import json
import random
import time
from collections import defaultdict
from datetime import datetime, timedelta, timezone
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from doorledger.functions import events as ev
from doorledger.operators import detect
from doorledger.streaming import (alert_sink, batch_sink, condition_events, counter_increases, fraud_job, read_batches,
                                  route_late, timers)

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
DDL = "k string, ts timestamp, v double"


def at(ms):
    return START + timedelta(milliseconds=ms)


def arriving(spark, folder, batches, ddl=DDL):
    """Each list of rows is a file and a micro-batch."""
    for rows in batches:
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.01)
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(str(folder))


def drained(spark, rows, folder):
    q = alert_sink(rows, {"format": "parquet", "path": str(folder / "out")}, str(folder / "cp"), {"availableNow": True})
    q.awaitTermination()
    return spark.read.schema(rows.schema).parquet(str(folder / "out")).collect(), q


def log(seq, user, ms, status="success", ip="ip"):
    return json.dumps({"user_id": user, "action": "prediction", "timestamp": at(ms).replace(tzinfo=None).isoformat(timespec="milliseconds"),
                       "metadata": {"prediction_status": status, "source_ip": ip}})


@pytest.mark.parametrize("split", [1, 4])
def test_timer_state_is_exact_and_ends(spark, tmp_path, split):
    """Counts equal the batch form however the input is cut, and no key is left once the watermark has passed."""
    rnd = random.Random(7)
    ms, lines = 0, []
    for i in range(120):
        ms += rnd.randrange(1, 4000)
        lines.append(log(i, rnd.choice("ab"), ms, rnd.choice(["success", "success", "no_match"]), rnd.choice(["x", "y"])))
    # a last event long after; its own window is passed by nothing
    lines.append(log(999, "last", ms + 600_000))
    rules = [detect.spam_rule(3, 20), detect.brute_force_rule(4, 60)]
    size = -(-len(lines) // split)
    values = arriving(spark, tmp_path / "in", [[(x,) for x in lines[i:i + size]] for i in range(0, len(lines), size)], "value string")
    got, q = drained(spark, fraud_job(values, rules, timers=True), tmp_path)
    df = spark.createDataFrame(list(enumerate(lines)), "ingest_seq bigint, value string")
    want = ev.alert_json(detect.fraud_alerts(ev.log_events(df), rules)).collect()
    key = lambda r: json.dumps(json.loads(r.value), sort_keys=True)
    assert len(want) > 20 and sorted(map(key, got)) == sorted(map(key, want))
    rows = [p.stateOperators[0].numRowsTotal for p in q.recentProgress]
    assert max(rows) >= 1 and rows[-1] == 1  # only the last event's key


def test_late_events_count_until_their_window_is_gone(spark, tmp_path):
    files = [[log(0, "a", 100_000), log(1, "a", 101_000)], [log(2, "a", 60_000)], [log(3, "a", 102_000)],
             [log(4, "b", 900_000)], [log(5, "a", 103_000)], [log(6, "a", 100_500)]]
    values = arriving(spark, tmp_path / "in", [[(x,) for x in f] for f in files], "value string")
    got, q = drained(spark, fraud_job(values, [detect.spam_rule(0, 60)], timers=True), tmp_path)
    counts = sorted((json.loads(r.value)["timestamp"][17:23], json.loads(r.value)["count"]) for r in got if json.loads(r.value)["user_id"] == "a")
    # 60 s meets both later ones as in the other form. The watermark passes the key's window in the batch of 103 s, whose
    # rows are counted before it is forgotten; 100.5 s then begins anew
    assert counts == [("00.000", 3), ("40.000", 1), ("40.500", 1), ("41.000", 2), ("42.000", 4), ("43.000", 5)]


def replay(samples, hold, stale, absent, limit):
    """(us, holds) of one series to its events, by stepping through every moment at which something can change."""
    merged = {}
    for t, h in samples:
        if t < limit:
            merged[t] = merged.get(t, False) or h
    times = sorted(merged)
    states = []
    for i, t in enumerate(times):
        states.append((t, merged[t]))
        nxt = times[i + 1] if i + 1 < len(times) else None
        if nxt is None or nxt > t + stale:
            states.append((t + stale, absent))
    out, since = [], None
    for i, (t, h) in enumerate(states):
        if h and since is None:
            since = t
        if since is not None and (not h or i == len(states) - 1):
            end = t if not h else float("inf")
            if end > since + hold:
                if since + hold < limit:
                    out.append(("firing", since, since + hold))
                if end < limit:
                    out.append(("resolved", since, end))
            since = None
    return sorted(out)


@pytest.mark.parametrize("seed", range(30))
def test_condition_fold_in_any_steps(seed):
    rnd = random.Random(seed)
    hold, stale, absent = rnd.choice([3000, 10_000]), rnd.choice([2000, 5000, 50_000]), rnd.random() < 0.5
    samples = [(rnd.randrange(0, 120_000, 1000), rnd.random() < 0.7) for _ in range(rnd.randrange(1, 40))]
    marks = sorted(rnd.sample(range(1000, 160_000, 1000), 6)) + [200_000]
    fold = timers._Condition(hold, stale, absent).fold
    state, out, low = None, [], 0
    for limit in marks:
        now = sorted(s for s in samples if low <= s[0] < limit)
        state, rows, again = fold(state, [t for t, _ in now], [h for _, h in now], limit)
        assert again is None or again >= limit
        out += rows
        low = limit
    got = sorted((e, int(a.timestamp() * 1e6 + 0.5), int(b.timestamp() * 1e6 + 0.5)) for e, a, b in out)
    assert got == replay(samples, hold, stale, absent, marks[-1])


def test_a_series_that_stops_fires_and_comes_back(spark, tmp_path):
    s = 1000
    up = [("api", at(t * s), 1.0) for t in range(0, 100, 10)]
    batches = [up[:5], up[5:] + [("db", at(95 * s), 1.0)], [("db", at(300 * s), 1.0)], [("api", at(400 * s), 1.0)], [("db", at(900 * s), 1.0)]]
    samples = arriving(spark, tmp_path / "in", batches).withWatermark("ts", "0 seconds")
    got, q = drained(spark, condition_events(samples, ["k"], F.col("v") == 0, 120, 15, absent=True), tmp_path)
    seen = sorted((r.k, r.event, r.started, r["at"]) for r in got)
    utc = lambda t: datetime(2024, 1, 1) + timedelta(seconds=t)
    # api is gone from 105 s, fires at 225 s, back at 400 s; gone again from 415 s, fires at 535 s. The last
    # sample of db, at 900 s, lies inside the duration
    assert seen == [("api", "firing", utc(105), utc(225)), ("api", "firing", utc(415), utc(535)), ("api", "resolved", utc(105), utc(400)),
                    ("db", "firing", utc(110), utc(230)), ("db", "firing", utc(315), utc(435)), ("db", "resolved", utc(110), utc(300)),
                    ("db", "resolved", utc(315), utc(900))]


def test_gone_series_are_forgotten(spark, tmp_path):
    batches = [[("a", at(0), 1.0), ("b", at(0), 1.0)], [("c", at(900_000), 0.0)], [("c", at(901_000), 0.0)]]
    samples = arriving(spark, tmp_path / "in", batches).withWatermark("ts", "0 seconds")
    got, q = drained(spark, condition_events(samples, ["k"], F.col("v") > 0, 10, 60), tmp_path)
    assert sorted((r.k, r.event) for r in got) == [("a", "firing"), ("a", "resolved"), ("b", "firing"), ("b", "resolved")]
    assert q.recentProgress[-1].stateOperators[0].numRowsTotal <= 3  # of c: its state and timer


def test_increases_of_shuffled_samples(spark, tmp_path):
    """Arrival in any order within the delay, resets across batches, a null key, ties."""
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None]), at(t * 500), float((t * 7) % 90)) for t in range(200)]
    rows += [("a", at(5000), 3.0), ("a", at(5000), 1.0)]
    order = sorted(rows, key=lambda r: r[1].timestamp() + rnd.random() * 5)
    batches = [order[i:i + 45] for i in range(0, len(order), 45)] + [[("end", at(3_600_000), 0.0)]]
    samples = arriving(spark, tmp_path / "in", batches).withWatermark("ts", "30 seconds")
    got, q = drained(spark, counter_increases(samples, ["k"], value="v"), tmp_path)
    series, want = defaultdict(list), []
    for k, t, v in rows:
        series[k].append((t, v))
    for k, ts in series.items():
        ts.sort()
        for i, (t, v) in enumerate(ts):
            p = ts[i - 1] if i else None
            want.append((str(k), t.replace(tzinfo=None), None if p is None else v if v < p[1] else v - p[1]))
    assert sorted(((str(r.k), r.ts, r.increase) for r in got if r.k != "end"), key=str) == sorted(want, key=str)
    assert sum(o["numRowsDroppedByWatermark"] for p in q.recentProgress for o in p["stateOperators"]) == 0


class _Saved(dict):
    """State variables of one group, and its timers."""

    def __init__(self):
        self.timers = set()
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.remove

    def getValueState(self, name, schema):
        return SimpleNamespace(exists=lambda: name in self, get=lambda: self[name], clear=lambda: self.pop(name),
                               update=lambda v: self.__setitem__(name, v))

    def getMapState(self, name, key, schema):
        return SimpleNamespace(getValue=lambda k: self[name, k], removeKey=lambda k: self.pop((name, k)),
                               updateValue=lambda k, v: self.__setitem__((name, k), v))


def test_a_group_is_folded_in_steps():
    """Many series share one group's saved values, and a fold holds some steps' rows, however long a series is."""
    n, limit = 2_000_000, 900_000_000
    ids = np.arange(n)
    rows = pd.DataFrame({"k0": np.where(ids % 4 == 0, "k" + (ids % 5000).astype(str).astype(object), "hot"),
                         "us": ids * 7919 % 1_000_000 * 1000, "v": ids % 100 * 1.0})
    saved, sizes = _Saved(), []
    increase = timers._Increase(None)
    increase.init(saved)
    fold_all = increase.fold_all
    increase.fold_all = lambda names, codes, us, *rest: (sizes.append(len(us)), *fold_all(names, codes, us, *rest))[1:]
    for part in (rows[:n // 2], rows[n // 2:]):
        assert list(increase.handleInputRows((0,), iter([part[i:i + 10_000] for i in range(0, len(part), 10_000)]), None)) == []
    mark = SimpleNamespace(getCurrentWatermarkInMs=lambda: limit // 1000 - 1)
    assert len(saved) < n / 5000 and saved.timers == {-1}
    saved.timers.clear()  # the timer of the first moment fires
    got = pd.concat(increase.handleExpiredTimer((0,), mark, None))
    assert max(sizes) < n / 3 and len(got) == (rows["us"] < limit).sum() and saved.timers == {limit // 1000 - 1}
    want = rows[rows["us"] < limit].sort_values(["k0", "us", "v"])
    same = want["k0"] == want["k0"].shift()
    before = want["v"].shift().where(same)
    want = pd.DataFrame({"k0": want["k0"], "us": want["us"], "prev": want["us"].shift().where(same),
                         "increase": np.where(want["v"] < before, want["v"], want["v"] - before)})
    micros = lambda ts: (ts - pd.Timestamp(0, tz="UTC")) / pd.Timedelta(1, "us")
    got = pd.DataFrame({"k0": got["k0"], "us": micros(got["ts"]), "prev": micros(got["prev_ts"]), "increase": got["increase"]})
    names = list(want.columns)
    pd.testing.assert_frame_equal(got.sort_values(names, ignore_index=True), want.sort_values(names, ignore_index=True), check_dtype=False)


@pytest.mark.parametrize("moment", ["before write", "after write"])
def test_restart_loses_and_doubles_nothing(spark, tmp_path, moment):
    """A job that ends after its state was computed, before or after its output was written, but before the commit."""
    rnd = random.Random(1)
    ms, lines = 0, []
    for i in range(90):
        ms += rnd.randrange(1, 3000)
        lines.append(log(i, rnd.choice("ab"), ms))
    values = arriving(spark, tmp_path / "in", [[(x,) for x in lines[i:i + 30]] for i in range(0, 90, 30)], "value string")
    alerts = fraud_job(values, [detect.spam_rule(3, 20)], timers=True)
    path, fail = str(tmp_path / "out"), {"on": True}

    def run():
        def written(number):
            if fail["on"] and number == 1:
                fail["on"] = False
                raise RuntimeError("stopped")

        if moment == "after write":
            return batch_sink(alerts, {"a": (path, None)}, str(tmp_path / "cp"), {"availableNow": True}, written)

        def write(batch, number):
            if number == 1 and fail["on"]:
                batch.count()  # the state of this batch is committed by its tasks
                written(number)
            batch.write.mode("overwrite").parquet(f"{path}/batch_id={number}")
        return alerts.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()

    with pytest.raises(Exception, match="stopped"):
        run().awaitTermination()
    run().awaitTermination()
    got = [json.loads(r.value) for r in read_batches(spark, path, alerts.schema).collect()]
    df = spark.createDataFrame(list(enumerate(lines)), "ingest_seq bigint, value string")
    want = [json.loads(r.value) for r in ev.alert_json(detect.fraud_alerts(ev.log_events(df), [detect.spam_rule(3, 20)])).collect()]
    key = lambda a: json.dumps(a, sort_keys=True)
    assert len(want) > 10 and sorted(map(key, got)) == sorted(map(key, want))


def test_late_rows_go_aside(spark, tmp_path):
    ddl = "k string, ts timestamp, v double, `class` int, _odd string"
    batches = [[("a", at(100_000), 1.0, 1, "x")], [("b", at(94_999), 2.0, 2, "y"), ("c", at(95_000), 3.0, 3, None), ("d", at(95_001), None, 4, "z")],
               [("e", at(200_000), 5.0, None, "u"), ("f", at(0), 6.0, 6, "v")]]
    rows = arriving(spark, tmp_path / "in", batches, ddl).withWatermark("ts", "5 seconds")
    paths = [str(tmp_path / x) for x in ("on_time", "late")]
    route_late(rows, "ts", *paths, str(tmp_path / "cp"), {"availableNow": True}).awaitTermination()
    on_time, late = ({(r.k, r.v, r["class"], r._odd) for r in read_batches(spark, p, rows.schema).collect()} for p in paths)
    assert late == {("b", 2.0, 2, "y"), ("c", 3.0, 3, None), ("f", 6.0, 6, "v")}  # at or before the batch's watermark
    assert on_time == {("a", 1.0, 1, "x"), ("d", None, 4, "z"), ("e", 5.0, None, "u")}
