"""Trailing counts, batch and streaming, against a sequential replay."""

import json
import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from doorledger.functions import events as ev
from doorledger.operators import detect
from doorledger.streaming import alert_sink, fraud_job


def replay(rows, window_ms):
    """rows: (key, ms, seq) -> {seq: count}, one event after the other."""
    kept, out = defaultdict(list), {}
    for key, ms, seq in sorted(rows, key=lambda r: (r[1], r[2])):
        kept[key] = [t for t in kept[key] if t > ms - window_ms] + [ms]
        out[seq] = len(kept[key])
    return out


@pytest.mark.parametrize("block_ms", [7_000, 10_000])  # carried totals, one pass
def test_trailing_count_equals_replay(spark, block_ms):
    rnd = random.Random(3)
    rows = [(rnd.choice("aab"), rnd.randrange(-20_000, 40_000, 500), i) for i in range(400)]
    df = spark.createDataFrame(rows, "key string, ms bigint, seq bigint")
    got = {r.seq: r["count"] for r in detect.trailing_count(
        df, ["key"], "ms", "seq", 10_000, block_ms=block_ms).collect()}
    assert got == replay(rows, 10_000)


def test_dense_keys_get_shorter_blocks(spark):
    from doorledger.operators.ordered import fitting_block_ms
    df = spark.createDataFrame([("hot", i * 10, i) for i in range(2000)] + [("cold", 5, 9999)],
                               "key string, ms bigint, seq bigint")
    width = fitting_block_ms(df, ["key"], "ms", most_rows=100)
    assert width == 180_000
    assert fitting_block_ms(df, ["key"], "ms") == 3_600_000
    counts = detect.trailing_count(df, ["key"], "ms", "seq", 200_000, block_ms=width)
    assert {r.seq: r["count"] for r in counts.collect()} == replay(
        [(r.key, r.ms, r.seq) for r in df.collect()], 200_000)


def _logs(spark, rows):
    return spark.createDataFrame(
        rows, "ingest_seq bigint, user_id string, action string, source_ip string, "
              "prediction_status string, timestamp string, event_ms bigint")


def _success(seq, ms, user="u", action="prediction", status="success", ip="1.1.1.1"):
    return (seq, user, action, ip, status, f"t{seq}", ms)


def test_window_bound_is_strict(spark):
    rows = [_success(i, ms) for i, ms in enumerate([0, 60_000])]
    out = detect.spam_alerts(_logs(spark, rows), threshold=1).collect()
    assert out == []  # exactly one window apart
    rows = [_success(i, ms) for i, ms in enumerate([1, 60_000])]
    assert len(detect.spam_alerts(_logs(spark, rows), threshold=1).collect()) == 1


def test_threshold_and_severity_edges(spark):
    rows = [_success(i, 1000 + i) for i in range(11)]
    out = {r["count"]: r for r in detect.spam_alerts(_logs(spark, rows)).collect()}
    assert sorted(out) == [6, 7, 8, 9, 10, 11]          # 5 is not above the threshold
    assert out[10].severity == "warning" and out[11].severity == "critical"
    assert out[6].message == "User u logged in successfully 6 times in 60s"
    assert out[6].timestamp == "t5"


def test_predicates_and_keys(spark):
    rows = ([_success(i, 1000, user="anonymous") for i in range(10)]
            + [_success(20 + i, 1000, user=None) for i in range(10)]
            + [_success(40 + i, 1000, user="v", action="registration") for i in range(6)]
            + [_success(60 + i, 1000, ip=None, status="no_match") for i in range(11)]
            + [_success(80 + i, 1000, ip=None, status="no_match", action="x") for i in range(9)])
    out = detect.fraud_alerts(_logs(spark, rows)).collect()
    assert [(r.alert_type, r.user_id) for r in out if r.user_id] == [("spam_detection", "v")]
    brute = [r for r in out if r.user_id is None]
    assert [(r.source_ip, r["count"], r.severity) for r in brute] == [("unknown", 11, "critical")]
    assert brute[0].message == "IP unknown had 11 failed matches in 300s"


def test_parse_is_tolerant(spark):
    good = {"user_id": "u", "action": "prediction", "metadata": {"prediction_status": "success"},
            "timestamp": "2024-01-01T00:00:00.575"}
    texts = [json.dumps(good), json.dumps({**good, "timestamp": "2024-01-01T00:00:00.575Z"}),
             json.dumps({**good, "timestamp": "2024-01-01T07:00:00.575+07:00"}),
             json.dumps({**good, "metadata": None}), json.dumps({**good, "timestamp": "soon"}),
             "{not json", "[1, 2]", json.dumps({"action": "x"}),
             json.dumps({**good, "user_id": None})]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    rows = {r.i: r for r in ev.log_events(df, bad_time="keep").collect()}
    assert len(rows) == len(texts)
    ms = int(datetime(2024, 1, 1, tzinfo=timezone.utc).timestamp() * 1000) + 575
    assert [rows[i].event_ms for i in range(4)] == [ms] * 4
    assert rows[4].event_ms is None and rows[5]._corrupt and rows[5].user_id is None
    assert rows[6].user_id is None and rows[7].user_id is None
    assert {r.i for r in ev.log_events(df).collect()} == {0, 1, 2, 3, 8}
    with pytest.raises(ValueError):
        ev.log_events(df, bad_time="guess")
    assert ev.log_events(df, bad_time="now").where("event_ms is null").count() == 0


def test_messages(spark):
    df = spark.createDataFrame([("alice",)], "username string")
    event = ev.build_event(df.select(
        F.lit("face_registered").alias("event_type"),
        F.struct(F.lit(1).alias("user_id"), "username").alias("payload"),
        F.lit("t").alias("timestamp"))).first()
    assert event.key is None
    assert json.loads(event.value) == {"event_type": "face_registered", "timestamp": "t",
                                       "payload": {"user_id": 1, "username": "alice"}}
    alert = ev.build_alert(df.select(
        F.lit("system_error").alias("alert_type"), F.lit("critical").alias("severity"),
        F.lit("DB connection lost").alias("message"), F.lit(None).alias("metadata"),
        F.lit("t").alias("timestamp"))).first()
    assert json.loads(alert.value)["metadata"] == {}


def _values(rows):
    start = datetime(2024, 1, 1)
    return [json.dumps({
        "user_id": r[1], "action": "prediction", "timestamp":
        (start + timedelta(milliseconds=r[2])).isoformat(timespec="milliseconds"),
        "metadata": {"prediction_status": r[4], "source_ip": r[3]}}) for r in rows]


def _stream(spark, tmp_path, files, **kw):
    """Each list of lines becomes one file, read one per micro-batch."""
    import os
    src = tmp_path / "in"
    src.mkdir()
    for i, lines in enumerate(files):
        (src / f"{i:03d}.txt").write_text("\n".join(lines) + "\n")
        os.utime(src / f"{i:03d}.txt", (1_700_000_000 + i, 1_700_000_000 + i))
    values = (spark.readStream.format("text").option("maxFilesPerTrigger", "1").load(str(src)))
    q = alert_sink(fraud_job(values, **kw), {"format": "parquet", "path": str(tmp_path / "out")},
                   str(tmp_path / "cp"), {"availableNow": True})
    q.awaitTermination(120)
    assert not q.isActive
    out = spark.read.schema("value string").parquet(str(tmp_path / "out")).collect()
    return [json.loads(r.value) for r in out], len([p for p in q.recentProgress
                                                    if p.numInputRows])


@pytest.mark.parametrize("split", [1, 5])
def test_stream_equals_batch_for_any_split(spark, tmp_path, split):
    rnd = random.Random(5)
    at, rows = 0, []
    for i in range(240):
        at += rnd.randrange(1, 4000)
        status = rnd.choice(["success", "success", "no_match"])
        rows.append((i, rnd.choice(["a", "b"]) if status == "success" else "anonymous", at,
                     rnd.choice(["ip1", "ip2"]), status))
    rules = [detect.spam_rule(3, 20), detect.brute_force_rule(4, 60)]
    lines = _values(rows)
    size = len(lines) // split
    got, batches = _stream(spark, tmp_path, [lines[i:i + size]
                                             for i in range(0, len(lines), size)], rules=rules)
    assert batches == split
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)],
                               "ingest_seq bigint, value string")
    want = [json.loads(r.value) for r in
            ev.alert_json(detect.fraud_alerts(ev.log_events(df), rules)).collect()]
    key = lambda a: json.dumps(a, sort_keys=True)
    assert len(want) > 20 and sorted(map(key, got)) == sorted(map(key, want))
    assert all("user_id" not in a for a in got if a["alert_type"] == "brute_force_detection")


def test_late_event_is_counted(spark, tmp_path):
    """An event behind the watermark meets what is still stored, newer events included."""
    files = [[(0, "a", 100_000, "ip", "success"), (1, "a", 101_000, "ip", "success")],
             [(2, "a", 60_000, "ip", "success")], [(3, "a", 102_000, "ip", "success")]]
    rules = [detect.spam_rule(2, 60)]
    got, _ = _stream(spark, tmp_path, [_values(f) for f in files], rules=rules)
    assert sorted(a["count"] for a in got) == [3, 4]


def test_state_is_one_entry_per_millisecond():
    import numpy as np
    from doorledger.streaming import fraud
    ms, n = fraud._remaining(np.array([1, 5]), np.array([2, 1]), np.array([5, 9]), 6)
    assert (ms, n) == ([5, 9], [2, 1])
    counts = fraud.trailing_counts(np.array([1, 5]), np.array([2, 1]), np.array([5, 9]), 6)
    assert counts.tolist() == [4, 3]


def test_idle_keys_are_forgotten(spark, tmp_path):
    """A key is dropped once event time has passed its window, the newest key stays."""
    import time
    src = tmp_path / "in"
    src.mkdir()
    rows = [(0, "a", 1000, "ip", "success"), (1, "b", 3_600_000, "ip", "success")]
    (src / "0.txt").write_text("\n".join(_values(rows)) + "\n")
    values = spark.readStream.format("text").load(str(src))
    q = alert_sink(fraud_job(values, rules=[detect.spam_rule(0, 1)], evict_idle=True),
                   {"format": "parquet", "path": str(tmp_path / "out")}, str(tmp_path / "cp"),
                   {"processingTime": "0 seconds"})
    try:
        keys, until = [], time.time() + 90
        while time.time() < until and (not keys or keys[-1] != 1):
            time.sleep(1)
            assert q.exception() is None
            keys = [p.stateOperators[0].numRowsTotal for p in q.recentProgress
                    if p.stateOperators]
        assert 2 in keys and keys[-1] == 1
    finally:
        q.stop()
    assert spark.read.schema("value string").parquet(str(tmp_path / "out")).count() == 2


def test_null_keys_count_alike_in_both_forms(spark):
    from doorledger.operators import detect, ordered
    hour = 3_600_000
    df = spark.createDataFrame([(None, i * hour // 4, i) for i in range(12)] + [("a", i * hour, 20 + i) for i in range(3)],
                               "k string, ms bigint, seq bigint")
    forms = [{r.seq: r.n for r in detect.trailing_count(df, ["k"], "ms", "seq", 2 * hour, out="n", block_ms=b).collect()}
             for b in (hour, 4 * hour)]
    assert forms[0] == forms[1] and [forms[0][i] for i in range(12)] == [1, 2, 3, 4, 5, 6, 7, 8, 8, 8, 8, 8]
    total = ordered.running_total(df.withColumn("one", F.lit(1)), ["k"], "ms", ["ms", "seq"], "one", "n")
    assert {r.seq: r.n for r in total.where("k is null").collect()} == {i: i + 1 for i in range(12)}


def test_times_need_a_date(spark):
    from doorledger.functions.events import iso_timestamp
    df = spark.createDataFrame([("12:30",), ("T12",), ("2024-01-02T03:04:05Z",), ("junk",), (None,)], "t string")
    assert [r[0] is None for r in df.select(iso_timestamp("t")).collect()] == [True, True, False, True, True]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from doorledger.session import scratch_dir
    far = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError):
        scratch_dir(far, "x")
