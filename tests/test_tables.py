"""Feature table, onboarding gates and upsert, metrics."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from doorledger.functions import outcomes as oc
from doorledger.functions import objects as ob
from doorledger.operators import features, metrics, onboarding, summary
from doorledger.schemas import FACE, USERS

T0 = datetime(2024, 1, 1)
FEATS = "employee_id string, x int, event_timestamp timestamp, created_at timestamp"


def _feats(spark, rows):
    """rows: (id, x, event hour, creation hour)"""
    return spark.createDataFrame(
        [(i, x, T0 + timedelta(hours=e), T0 + timedelta(hours=c)) for i, x, e, c in rows], FEATS)


def _as_set(df, *cols):
    return {tuple(r) for r in df.select(*cols).collect()}


def test_latest_prefers_event_then_creation_time(spark):
    df = _feats(spark, [("a", 1, 1, 9), ("a", 2, 2, 1), ("a", 3, 2, 2), ("b", 4, 0, 0)])
    assert _as_set(features.latest_features(df), "employee_id", "x") == {("a", 3), ("b", 4)}


def test_incremental_equals_rebuild(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("abcd"), i, rnd.randrange(0, 200), i) for i in range(60)]
    off = _feats(spark, rows)
    at = [None, *(str(T0 + timedelta(hours=h)) for h in (50, 51, 120, 200))]
    online = None
    for last, now in zip(at, at[1:]):
        online = features.materialize_incremental(off, online, last, now)
    full = features.materialize(off, str(T0 - timedelta(days=364)), at[-1])
    assert _as_set(online, *off.columns) == _as_set(full, *off.columns)
    # an older row never replaces a newer one
    back = features.materialize(off, str(T0), str(T0 + timedelta(hours=20)), online)
    assert _as_set(back, *off.columns) == _as_set(full, *off.columns)


def test_online_features_expire(spark):
    online = _feats(spark, [("a", 1, 0, 0), ("b", 2, 24, 24)])
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("b",)], "employee_id string")
    now = str(T0 + timedelta(days=2))
    got = features.online_features(keys, online, now, ["x"], ttl_days=1).collect()
    assert sorted((r.employee_id, r.x) for r in got if r.x) == [("b", 2), ("b", 2)]
    assert len(got) == 4
    assert len(features.online_lookup(keys, online, ["x"]).where("x is null").collect()) == 1
    with pytest.raises(ValueError):
        features.push(online, to="nowhere")


@pytest.mark.parametrize("block_ms", [3_600_000, 60_000_000])
def test_point_in_time_join_equals_search(spark, block_ms):
    rnd = random.Random(2)
    facts = [(rnd.choice(["a", "b", "h"]), i, rnd.randrange(0, 100), rnd.randrange(100))
             for i in range(80)]
    spine = [(i, rnd.choice(["a", "b", "h", "x", None]), T0 + timedelta(hours=rnd.randrange(-5, 130)))
             for i in range(120)]
    sdf = spark.createDataFrame(spine, "i int, employee_id string, event_timestamp timestamp")
    got = {r.i: r.x for r in features.historical_features(
        sdf, _feats(spark, facts), ["x"], ttl_days=1, block_ms=block_ms).collect()}
    for i, key, at in spine:
        hits = [(e, c, x) for k, x, e, c in facts if k == key
                and timedelta(0) <= at - (T0 + timedelta(hours=e)) <= timedelta(days=1)]
        assert got[i] == (max(hits)[2] if hits else None)
    assert len(got) == len(spine)


# --- onboarding -------------------------------------------------------------------------

def _user(i, name, mail):
    return (i, f"uuid{i}", mail, name, f"old {i}", "[0]", T0, T0)


def _apply(users, regs):
    """Registrations one after the other, as the row-by-row job does."""
    table = [dict(zip(USERS.fieldNames(), u)) for u in users]
    for seq, name, mail, full, emb in regs:
        hit = [u for u in table if u["username"] == name or u["email"] == mail]
        for u in hit or [dict(username=name, email=mail)]:
            u.update(full_name=full, face_embedding=emb)
            if not hit:
                table.append(u)
    return {(u["username"], u["email"], u["full_name"], u["face_embedding"]) for u in table}


@pytest.mark.parametrize("seed", range(3))
def test_upsert_equals_sequential(spark, seed):
    rnd = random.Random(seed)
    users = [_user(i, f"u{i}", f"m{i}") for i in range(5)]
    regs = [(i, f"u{rnd.randrange(14)}", f"m{rnd.randrange(14)}", f"new {i}", f"[{i}]")
            for i in range(25)]
    shuffled = regs[:]
    rnd.shuffle(shuffled)
    udf = spark.createDataFrame(users, USERS)
    rdf = spark.createDataFrame(shuffled, "seq bigint, username string, email string, "
                                          "full_name string, face_embedding string")
    out = onboarding.upsert_users(udf, rdf, "2024-06-01 00:00:00").collect()
    assert {(r.username, r.email, r.full_name, r.face_embedding) for r in out} == _apply(users, regs)
    assert len({r.id for r in out}) == len(out) and len({r.uuid for r in out}) == len(out)
    new = [r for r in out if r.id > 4]
    assert all(r.created_at == r.updated_at == datetime(2024, 6, 1) for r in new)


REG = "seq bigint, username string, email string, full_name string, face_embedding string"


@pytest.mark.parametrize("largest", [1_000_000, 3])
def test_upsert_settles_whole_rows(spark, monkeypatch, largest):
    """Ids, uuids and times as one by one would give them, in one pass or in rounds."""
    from doorledger.operators.onboarding import _new_users
    rnd = random.Random(9)
    regs = [(10 + i, f"u{rnd.randrange(40)}", f"m{rnd.randrange(40)}", f"n{i}", f"[{i}]") for i in range(60)]
    regs += [(100 + i, None if i % 2 else "lone", None, f"x{i}", "[]") for i in range(4)]
    users = [_user(i, f"u{i}", f"m{i}") for i in range(3)]
    udf, rdf = spark.createDataFrame(users, USERS), spark.createDataFrame(regs, REG).repartition(3)
    names, mails, inserted = {f"u{i}" for i in range(3)}, {f"m{i}" for i in range(3)}, []
    for seq, name, mail, *_ in regs:
        if (name is None or name not in names) and (mail is None or mail not in mails):
            inserted.append(seq)
            names |= {name} - {None}
            mails |= {mail} - {None}
    assert sorted(r.seq for r in _new_users(rdf, udf, largest).collect()) == inserted
    out = {r.id: r for r in onboarding.upsert_users(udf, rdf, "2024-06-01 00:00:00").collect()}
    assert sorted(out) == sorted([0, 1, 2, *(seq - 10 + 3 for seq in inserted)])
    again = {r.id: r for r in onboarding.upsert_users(udf, rdf.orderBy("email"), "2024-06-01 00:00:00").collect()}
    assert out == again and len({r.uuid for r in out.values()}) == len(out)
    for i in range(3):
        assert out[i].created_at == datetime(2024, 1, 1) and out[i].uuid == users[i][1]
    assert all(out[s - 7].created_at == datetime(2024, 6, 1) for s in inserted)


def test_a_long_chain_takes_no_more_jobs(spark):
    """Each registration shares its address with the one before and its name with the next."""
    from doorledger.operators.onboarding import _new_users
    users = spark.createDataFrame([_user(1, "nobody", "none")], USERS)

    def jobs(n):
        regs = [(i, f"u{i // 2}", f"m{(i + 1) // 2}", "x", "[]") for i in range(n)]
        rows = spark.createDataFrame(regs, REG).coalesce(1)
        spark.sparkContext.setJobGroup(f"chain{n}", "chain")
        got = sorted(r.seq for r in _new_users(rows, users).collect())
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert got == list(range(0, n, 2))
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"chain{n}"))

    assert jobs(500) <= jobs(20) + 2


def test_components(spark):
    from doorledger.operators.components import components
    rnd = random.Random(4)
    pairs = [(f"a{i}", f"a{i + 1}") for i in range(300)] + [(f"b{rnd.randrange(90)}", f"b{rnd.randrange(90)}") for _ in range(70)]
    pairs += [("hub", f"leaf{i}") for i in range(200)] + [("same", "same")]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "src string, dst string").repartition(7)).collect()}
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for x, y in pairs:
        a, b = sorted((root(x), root(y)))
        up[b] = a
    want = {x: root(x) for p in pairs for x in p}
    want.pop("same")  # a loop joins nothing
    lonely = {x for x in want if sum(1 for y in want.values() if y == want[x]) == 1}
    assert got == {x: c for x, c in want.items() if x not in lonely}
    assert components(spark.createDataFrame([], "src string, dst string")).count() == 0


def test_duplicates_and_ambiguity(spark):
    users = spark.createDataFrame([_user(1, "ann", "a@x"), _user(2, "bob", "b@x")], USERS)
    reqs = spark.createDataFrame(
        [(1, "ann", "z@x"), (2, "zoe", "b@x"), (3, "ann", "a@x"), (4, "ann", "b@x"),
         (5, "new", "n@x")], "seq bigint, username string, email string")
    dup = onboarding.duplicate_users(reqs, users)
    assert sorted(r.seq for r in dup.collect()) == [1, 2, 3, 4]
    assert [r.seq for r in onboarding.ambiguous_requests(reqs, users).collect()] == [4]


def _faces(spark, faces):
    df = spark.createDataFrame([(faces,)], "faces array<struct<confidence:double,x:int,y:int,"
                                           "w:int,h:int>>")
    assert df.schema["faces"].dataType.elementType == FACE
    return df.select(oc.face_reject_reason("faces").alias("r")).first().r


def test_face_gate_rules(spark):
    def face(c, w=100, h=100):
        return (c, 0, 0, w, h)
    assert _faces(spark, []) == "no face detected" == _faces(spark, None)
    assert _faces(spark, [face(0.90)]) is None
    assert _faces(spark, [face(0.8)]) == "face confidence too low (0.800 < 0.9)"
    assert _faces(spark, [face(0.6675)]) == f"face confidence too low ({0.6675:.3f} < 0.9)"
    assert _faces(spark, [face(0.95, 80, 80)]) is None
    assert _faces(spark, [face(0.95, 79, 80)]) == "face too small (79x80 < 80x80)"
    assert _faces(spark, [face(0.5), face(0.95)]) is None
    assert _faces(spark, [face(0.5), face(0.6)]) == "expected 1 face, found 0 (high-confidence)"
    assert _faces(spark, [face(0.91), face(0.95)]) == "expected 1 face, found 2 (high-confidence)"
    assert _faces(spark, [face(0.5, 10), face(0.95, 20)]) == "face too small (20x100 < 80x80)"


def test_fixed_decimals_rounds_like_exact_values(spark):
    rnd = random.Random(0)
    xs = [rnd.randrange(0, 20_001) / 20_000 for _ in range(500)] + [rnd.random() for _ in range(200)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for digits in (3, 4):
        got = df.select("x", oc.fixed_decimals(F.col("x"), digits).alias("t")).collect()
        assert all(r.t == f"{r.x:.{digits}f}" for r in got)


def test_detection_gate(spark):
    df = spark.createDataFrame(
        [(1, [[10.0, 10.0, 50.0, 50.0]], [0.95]), (2, [[10.0, 10.0, 50.0, 50.0]], [0.8]),
         (3, None, None), (4, [], []), (5, [[0.9, 0.0, 10.8, 9.0], [0.0] * 4], [0.9, 1.0])],
        "i int, boxes array<array<double>>, probs array<double>")
    got = {r.i: r.f for r in df.select("i", oc.first_face("boxes", "probs").alias("f")).collect()}
    assert tuple(got[1]) == (10, 10, 40, 40, 0.95)
    assert got[2] is None and got[3] is None and got[4] is None
    assert tuple(got[5])[:4] == (0, 0, 9, 9)


def test_upload_and_request_rules(spark):
    limit = 10 * 1024 * 1024
    df = spark.createDataFrame([("image/png", limit), ("image/png", limit + 1),
                                ("text/plain", 1), (None, 1)], "c string, n bigint")
    got = [r.r for r in df.select(oc.upload_reject_reason("c", "n").alias("r")).collect()]
    assert got == [None, "File too large. Maximum size is 10MB.",
                   *["Invalid file type. Only JPEG and PNG are supported."] * 2]
    df = spark.createDataFrame(
        [("1", "u", "e", "f", ["p"]), ("1", "u", "", "f", ["p"]), ("1", "u", "e", "f", []),
         ("1", "u", "e", "f", None), (None, "u", "e", "f", [])],
        "user_id string, username string, email string, full_name string, image_paths array<string>")
    got = [r.r for r in df.select(oc.request_reject_reason().alias("r")).collect()]
    missing = "Missing required fields: user_id, username, email, full_name"
    assert got == [None, missing, *["Need at least 1 image, got 0"] * 2, missing]


def test_outcomes(spark):
    df = spark.createDataFrame(
        [(False, False, None, None), (True, False, None, None), (True, True, "7", None),
         (True, True, None, None), (True, True, "7", "boom")],
        "face boolean, emb boolean, hit string, err string")
    got = [tuple(r) for r in df.withColumn("s", oc.prediction_status("face", "emb", "hit", "err"))
           .select("s", oc.log_user(F.when(F.col("s") == "success", F.col("hit"))).alias("u"),
                   oc.response_message("s", "hit").alias("m")).collect()]
    assert got == [("no_face", "anonymous", "No face detected in image"),
                   ("error", "anonymous", "Failed to extract face embedding"),
                   ("success", "7", "Match found: 7"),
                   ("no_match", "anonymous", "No match found"),
                   ("error", "anonymous", "Failed to extract face embedding")]


def test_object_names(spark):
    df = spark.createDataFrame([("s3://b/k/x.jpg",), ("s3://b",), ("k/x",)], "u string")
    got = [tuple(r.o) for r in df.select(ob.parse_object_uri("u", "raw").alias("o")).collect()]
    assert got == [("b", "k/x.jpg"), ("b", ""), ("raw", "k/x")]
    df = spark.createDataFrame([("ann", 0, "me.tar.PNG"), ("ann", 1, "me")],
                               "u string, i int, f string")
    got = [r.p for r in df.select(ob.onboarding_object_path("u", "i", "f").alias("p")).collect()]
    assert got == ["onboarding/ann/ann_0.PNG", "onboarding/ann/ann_1.jpg"]


# --- metrics ----------------------------------------------------------------------------

def _samples(spark, rows):
    return spark.createDataFrame([(k, T0 + timedelta(seconds=s), float(v)) for k, s, v in rows],
                                 "k string, ts timestamp, value double")


def test_counter_reset_gap_and_single_sample(spark):
    s = _samples(spark, [("a", 0, 10), ("a", 30, 15), ("a", 60, 4), ("a", 9000, 6), ("b", 5, 7)])
    inc = {(r.k, r.value): r.increase for r in metrics.counter_increase(s, ["k"]).collect()}
    assert inc == {("a", 10): None, ("a", 15): 5, ("a", 4): 4, ("a", 6): 2, ("b", 7): None}
    rate = {(r.k, r.window_start): (r.increase, r.rate)
            for r in metrics.counter_rate(s, ["k"], ["k"], "1 minute", 60).collect()}
    assert rate["a", T0] == (5, 5 / 60) and rate["b", T0] == (0, 0)
    assert {r.k: r.rate for r in metrics.instant_rate(s, ["k"]).collect()} == {
        "a": pytest.approx(2 / 8940), "b": None}


def test_quantile_edges(spark):
    inf = float("inf")
    rows = [("x", 1.0, 10), ("x", 2.0, 20), ("x", inf, 20), ("top", 1.0, 1), ("top", inf, 100),
            ("none", 1.0, 0), ("none", inf, 0), ("low", 1.0, 100), ("low", inf, 100)]
    b = spark.createDataFrame(rows, "k string, le double, n bigint")
    got = {r.k: r.quantile for r in metrics.histogram_quantile(b, ["k"], 0.95).collect()}
    assert got == {"x": pytest.approx(1.9), "top": 1.0, "none": None, "low": pytest.approx(0.95)}


def test_ratios_bands_and_gauges(spark):
    s = _samples(spark, [("total", 0, 100), ("free", 1, 40), ("free", 2, 25)])
    m = s.withColumnRenamed("k", "metric").withColumn("host", F.lit("h"))
    assert metrics.memory_usage(m, ["host"], "total", "free").first().memory_usage == 75
    zero = m.withColumn("value", F.lit(0.0))
    assert metrics.memory_usage(zero, ["host"], "total", "free").first().memory_usage is None
    assert {r.k: r.value for r in metrics.gauge_latest(s, ["k"]).collect()} == {
        "total": 100, "free": 25}
    steps = [(None, "green"), (300, "yellow"), (500, "red")]
    df = spark.createDataFrame([(299.0,), (300.0,), (500.0,), (None,)], "v double")
    assert [r.b for r in df.select(metrics.threshold_band("v", steps).alias("b")).collect()] == [
        "green", "yellow", "red", None]
    ids = spark.createDataFrame([({"a": "1", "b": "2"},), ({"b": "2", "a": "1"},)],
                                "labels map<string,string>")
    assert ids.select(metrics.series_id("labels").alias("s")).distinct().count() == 1


def test_sustained_condition(spark):
    s = _samples(spark, [("up", t, v) for t, v in
                         [(0, 0), (60, 0), (120, 0), (130, 1), (200, 0), (319, 0)]])
    got = metrics.sustained_alert(s, ["k"], F.col("value") == 0, 120).collect()
    assert [(r.start, r.end, r.samples, r.fires_at) for r in got] == [
        (T0, T0 + timedelta(seconds=120), 3, T0 + timedelta(seconds=120))]


def test_summary_counts_null_and_anonymous_as_users(spark):
    logs = spark.createDataFrame([("a", "prediction"), ("anonymous", "prediction"), (None, "x"),
                                  ("a", "x")], "user_id string, action string")
    r = summary.daily_summary(logs, "2024-01-01").first()
    assert (r.date, r.total_events, r.total_predictions, r.unique_users) == ("2024-01-01", 4, 2, 3)
    r = summary.daily_summary(logs.limit(0), "2024-01-01").first()
    assert (r.total_events, r.total_predictions, r.unique_users) == (0, 0, 0)
    flags = spark.createDataFrame([("True",), ("true",), ("False",)], "detected string")
    assert {tuple(r) for r in summary.detection_counts(flags).collect()} == {(True, 2), (False, 1)}
