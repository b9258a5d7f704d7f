"""Lake files, generated data and the composed jobs."""

import json
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from doorledger.functions.events import flatten_log
from doorledger.operators import features, generate
from doorledger.plans import daily, onboarding, recognition
from doorledger.schemas import USERS
from doorledger.sources import images, lake, relational

LINE = {"user_id": "u", "action": "prediction", "timestamp": "2024-03-04T05:06:07",
        "metadata": {"prediction_status": "success", "confidence": 0.9}}


def _write_day(base, folder, lines):
    d = base / folder
    d.mkdir(parents=True)
    (d / "part.json").write_text("\n".join(json.dumps(x) for x in lines) + "\n")


def test_day_is_chosen_by_path(spark, tmp_path):
    base = tmp_path / "logs"
    _write_day(base, "Year=2024/Month=03/05", [LINE, {**LINE, "user_id": None}])
    _write_day(base, "Year=2024/Month=03/Day=06", [LINE])
    assert lake.read_access_logs(spark, str(base), "2024-03-05").count() == 2
    assert lake.read_access_logs(spark, str(base), "2024-03-06").count() == 1
    empty = lake.read_access_logs(spark, str(base), "2024-03-07")
    assert empty.count() == 0 and "metadata" in empty.columns
    assert lake.day_has_data(spark, str(base), "2024-03-05")
    assert not lake.day_has_data(spark, str(base), "2024-03-07")
    assert flatten_log(lake.read_access_logs(spark, str(base), "2024-03-05")).first().confidence == 0.9


def test_daily_job_replaces_only_its_day(spark, tmp_path):
    base, out = tmp_path / "logs", str(tmp_path / "reports")
    _write_day(base, "Year=2024/Month=03/05", [LINE] * 3)
    _write_day(base, "Year=2024/Month=03/06", [LINE, {**LINE, "action": "x", "user_id": None}])
    for day in ("2024-03-05", "2024-03-06", "2024-03-06"):
        daily.run_daily(spark, str(base), out, day)
    assert daily.run_daily(spark, str(base), out, "2024-03-07") is None
    daily.process_day(spark, str(base), out, "2024-03-08")
    got = {r.date: (r.total_events, r.total_predictions, r.unique_users)
           for r in lake.read_daily_summaries(spark, out).collect()}
    assert got == {"2024-03-05": (3, 3, 1), "2024-03-06": (2, 1, 2), "2024-03-08": (0, 0, 0)}


def test_retention(spark, tmp_path):
    import os
    for name, age in (("old", 100), ("new", 10)):
        f = tmp_path / f"{name}.parquet"
        f.write_text("x")
        at = (datetime(2024, 6, 1) - timedelta(days=age)).timestamp()
        os.utime(f, (at, at))
    objs = lake.list_objects(spark, str(tmp_path))
    old = lake.retention_candidates(objs, "2024-06-01")
    assert [r.path.rsplit("/", 1)[1] for r in old.collect()] == ["old.parquet"]
    assert lake.apply_retention(old) == {"objects": 1, "bytes": 1, "deleted": 0}
    assert (tmp_path / "old.parquet").exists()
    assert lake.apply_retention(old, dry_run=False)["deleted"] == 1
    assert not (tmp_path / "old.parquet").exists() and (tmp_path / "new.parquet").exists()


def test_snapshots_never_overwrite(spark, tmp_path):
    df = spark.range(3)
    one = relational.write_snapshot(df, str(tmp_path))
    two = relational.write_snapshot(relational.read_table(spark, one).union(df), str(tmp_path))
    assert relational.read_table(spark, one).count() == 3
    assert relational.read_table(spark, two).count() == 6


def test_generated_logs(spark):
    a = generate.generate_access_logs(spark, 4000, 50, seed=3).repartition(7)
    b = generate.generate_access_logs(spark, 4000, 50, seed=3).coalesce(1)
    assert a.exceptAll(b).count() == 0
    m = a.select("user_id", "timestamp", "metadata.*")
    r = m.agg(F.avg((F.col("prediction_status") == "success").cast("int")).alias("ok"),
              F.min("confidence").alias("lo"), F.max("confidence").alias("hi"),
              F.min(F.when(F.col("prediction_status") == "success", F.col("confidence"))).alias("s"),
              F.min("processing_time_ms").alias("fast"), F.max("processing_time_ms").alias("slow"),
              F.count_distinct("device_id").alias("dev"), F.min("timestamp").alias("t0"),
              F.max("timestamp").alias("t1"), F.count_distinct("prediction_id").alias("ids"),
              F.count_distinct("user_id").alias("users")).first()
    assert abs(r.ok - 0.75) < 0.03 and 0.3 <= r.lo < 0.31 and 0.99 < r.hi < 1 and r.s >= 0.6
    assert 50 <= r.fast < 52 and 498 < r.slow < 500 and r.dev == 50 and r.ids == 4000
    assert "2020-01" <= r.t0 < "2020-02" and "2025-12" <= r.t1 < "2026" and r.users == 51
    assert m.where("user_id = 'anonymous' and matched_user is not null").count() == 0
    assert generate.generate_access_logs(spark, 100, 50, seed=4).exceptAll(a).count() == 100
    pool = generate.generate_users(spark, 50, seed=3).select("user_id")
    assert m.where("user_id <> 'anonymous'").select("user_id").exceptAll(
        m.join(pool, "user_id").select("user_id")).count() == 0


def test_generated_lake_and_manifest(spark, tmp_path):
    base = str(tmp_path / "lake")
    generate.write_generated_lake(spark, base, total=1050, batch_size=100, users=20)
    day = lake.read_access_logs(spark, base, "2022-03-03")  # batch 2
    assert day.count() == 100
    m = lake.dataset_manifest(spark, base, lake.read_lake(spark, base)).first()
    assert (m.total_records, m.total_files, m.num_users) == (1050, 11, 20) and m.total_bytes > 0
    assert generate.batch_count(5, 100) == 1 and generate.user_count(50) == 10


def test_bulk_inference_keeps_order_and_nulls(spark, tmp_path):
    for name, data in (("a", b"1"), ("b", b"bad"), ("c", b"2")):
        (tmp_path / f"{name}.jpg").write_bytes(data)

    def factory():
        def model(data):
            return None if data == b"0" else [float(data)]
        return model

    df = images.read_images(spark, str(tmp_path))
    got = images.bulk_infer(df, factory, ["path"]).orderBy("path").collect()
    assert [r.embedding for r in got] == [[1.0], None, [2.0]]


def _vec(rnd, base, noise=0.01):
    return (base + noise * rnd.normal(size=base.shape)).astype("f4").tolist()


def test_onboarding_end_to_end(spark):
    rnd = np.random.default_rng(0)
    base = {k: rnd.normal(size=16) for k in "abcdxy"}
    users = spark.createDataFrame(
        [(1, "u1", "a@x", "ann", "Ann", None, datetime(2024, 1, 1), datetime(2024, 1, 1)),
         (2, "u2", "b@x", "bob", "Bob", json.dumps(_vec(rnd, base["b"])), datetime(2024, 1, 1),
          datetime(2024, 1, 1))], USERS)
    reqs = spark.createDataFrame(
        [("ok", 1, "1", "ann", "a@x", "Ann New", ["p0", "p1", "p2"]),
         ("blank", 2, "3", "", "c@x", "Cy", ["p0"]),
         ("nofaces", 3, "4", "dan", "d@x", "Dan", ["p0", "p1"]),
         ("mixed", 4, "5", "eve", "e@x", "Eve", ["p0", "p1", "p2"]),
         ("noemb", 5, "6", "fay", "f@x", "Fay", ["p0"])],
        "request_id string, seq bigint, user_id string, username string, email string, "
        "full_name string, image_paths array<string>")
    good, low = [(0.95, 0, 0, 90, 90)], [(0.5, 0, 0, 90, 90)]
    dets = spark.createDataFrame(
        [("ok", 0, low), ("ok", 1, good), ("ok", 2, good), ("nofaces", 0, []),
         ("mixed", 0, low), ("mixed", 1, good), ("mixed", 2, good), ("noemb", 0, good)],
        "request_id string, pos int, faces array<struct<confidence:double,x:int,y:int,w:int,h:int>>")
    embs = spark.createDataFrame(
        [("ok", 0, _vec(rnd, base["x"])), ("ok", 1, _vec(rnd, base["a"])),
         ("ok", 2, _vec(rnd, base["a"])), ("mixed", 1, _vec(rnd, base["x"])),
         ("mixed", 2, _vec(rnd, base["y"])), ("noemb", 0, None)],
        "request_id string, pos int, embedding array<float>")
    out = onboarding.run_onboarding(reqs, dets, embs, users, "2024-06-01 00:00:00")
    why = {r.request_id: (r.stage, r.reason) for r in out.rejected.collect()}
    assert set(why) == {"blank", "nofaces", "mixed", "noemb"}
    assert why["nofaces"] == ("faces", "Only 0 images passed face detection (need >= 1). "
                                       "First: p0: no face detected")
    assert why["mixed"][1].startswith("Images 0 and 1 may not be the same person (cosine_distance=")
    assert why["noemb"][0] == "embedding"
    assert out.images.where("reject_reason = 'p1: download failed'").count() == 1
    assert [(r.request_id, r.images) for r in out.registered.collect()] == [("ok", 2)]
    after = {r.username: r for r in out.users.collect()}
    assert set(after) == {"ann", "bob"} and after["ann"].full_name == "Ann New"
    assert len(json.loads(after["ann"].face_embedding)) == 16
    v = out.verified.first()
    assert v.verified and v.match_id == "1" and v.score > 0.99
    _, online = features.push(out.features)
    assert online.first().employee_id == "1"


def test_recognition_messages(spark):
    gallery = spark.createDataFrame([("7", [1.0, 0.0]), ("8", [0.0, 1.0])],
                                    "match_id string, embedding array<float>")
    box = [[1.0, 2.0, 31.0, 42.0]]
    rows = [("p1", box, [0.95], [0.9, 0.1], "9.9.9.9", None), ("p2", None, None, None, None, None),
            ("p3", box, [0.95], None, "9.9.9.9", None), ("p4", box, [0.95], [-1.0, -1.0], "i", None),
            ("p5", box, [0.95], [0.9, 0.1], "i", "boom")]
    df = spark.createDataFrame(
        [(a, datetime(2024, 2, 3, 4), b, p, e, ip, 5.0, err) for a, b, p, e, ip, err in rows],
        "prediction_id string, ts timestamp, boxes array<array<double>>, probs array<double>, "
        "embedding array<float>, source_ip string, processing_time_ms double, error string")
    out = recognition.bulk_recognition(df, gallery)
    assert {r.prediction_id: r.status for r in out.collect()} == {
        "p1": "success", "p2": "no_face", "p3": "error", "p4": "no_match", "p5": "error"}
    p = {r.uuid: r for r in recognition.recognition_predictions(out).collect()}
    assert set(p) == {"p1", "p4"} and p["p1"].user_id == 7 and p["p4"].user_id is None
    assert p["p1"].image_path == "predictions/Year=2024/Month=02/03/p1.jpg"
    logs = {json.loads(r.value)["metadata"]["prediction_id"]: (r.key, json.loads(r.value))
            for r in recognition.recognition_logs(out).collect()}
    assert logs["p1"][0] == "7" and logs["p2"][0] == "anonymous"
    assert logs["p2"][1]["metadata"]["source_ip"] == "unknown"
    assert logs["p1"][1]["timestamp"] == "2024-02-03T04:00:00.000000"
    with pytest.raises(Exception):
        recognition.bulk_recognition(df.drop("boxes"), gallery)


def test_registrations_without_name_and_address_end(spark):
    from doorledger.operators.onboarding import _new_users
    users = spark.createDataFrame([(1, "a", "a@x")], "id bigint, username string, email string")
    rows = spark.createDataFrame([(1, None, None), (2, None, None), (3, "b", None), (4, "b", "b@x"), (5, "a", None)],
                                 "seq bigint, username string, email string")
    assert sorted(r.seq for r in _new_users(rows, users).collect()) == [1, 2, 3]


def test_streams_read_folder_tables(spark, tmp_path):
    from doorledger.catalog import streams
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    whole = streams.stream_to_lake(spark, str(tmp_path)).agg(F.sum("events")).first()[0]
    assert whole == events.count()
