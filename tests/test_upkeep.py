"""Deletion of expired objects, batched inference, the default day."""

import os
from datetime import datetime, timedelta, timezone

from doorledger.plans.daily import yesterday
from doorledger.sources import images, lake


def test_expired_objects_are_told_with_what_became_of_them(spark, tmp_path):
    base = tmp_path / "lake"
    for day, age in (("01", 120), ("02", 100), ("03", 5)):
        (base / day).mkdir(parents=True)
        for k in range(40):
            f = base / day / f"{k}.json"
            f.write_text("x" * (k + 1))
            at = (datetime(2024, 6, 1) - timedelta(days=age)).timestamp()
            os.utime(f, (at, at))
    (base / "01" / "empty.json").touch()  # not listed, so it stays
    os.utime(base / "01" / "empty.json", (0, 0))
    before = {r.path for r in lake.list_objects(spark, str(base)).collect()}
    rows = lake.expire_objects(spark, str(base), "2024-06-01", threads=4).collect()
    left = {r.path for r in lake.list_objects(spark, str(base)).collect()}
    assert len(rows) == 80 and all(r.deleted for r in rows) and sum(r.length for r in rows) == 2 * sum(range(1, 41))
    assert before - left == {r.path for r in rows} and len(left) == 40 and os.listdir(base / "01") == ["empty.json"]
    assert lake.expire_objects(spark, str(base), "2024-06-01").count() == 0
    assert lake.expire_objects(spark, str(tmp_path / "none"), "2024-06-01").count() == 0


def test_what_cannot_be_deleted_is_told(spark, tmp_path, monkeypatch):
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text("x")
        os.utime(tmp_path / f"{name}.json", (0, 0))
    real = lake._deleter(spark)
    monkeypatch.setattr(lake, "_deleter", lambda _: lambda path: not path.endswith("a.json") and real(path))
    rows = {os.path.basename(r.path): r.deleted for r in lake.expire_objects(spark, str(tmp_path), "2024-06-01").collect()}
    assert rows == {"a.json": False, "b.json": True}


def test_runs_are_bounded_by_number_and_bytes():
    contents = [b"12345", None, b"1", b"1", b"1", b"123456789", b"", b"1"]
    assert list(images.runs_of(contents, 3, 6)) == [[0, 2], [3, 4], [5], [6, 7]]
    assert list(images.runs_of([], 3, 6)) == [] and list(images.runs_of([None], 3, 6)) == []


def test_batches_with_broken_images(spark):
    def factory():
        def model(batch):
            assert len(batch) <= 4
            if b"bad" in batch:
                raise ValueError("bad")
            return [None if b == b"" else [len(b), len(batch)] for b in batch]
        return model

    rows = [(i, b"bad" if i == 2 else None if i == 5 else b"" if i == 6 else b"x" * i) for i in range(1, 13)]
    df = spark.createDataFrame(rows, "k int, content binary").coalesce(1)
    got = {r.k: r.embedding for r in images.batch_infer(df, factory, ["k"], batch_size=4).collect()}
    assert got == {1: [1, 1], 2: None, 3: [3, 1], 4: [4, 1], 5: None, 6: None, 7: [7, 4], 8: [8, 4], 9: [9, 4],
                   10: [10, 3], 11: [11, 3], 12: [12, 3]}


def test_default_day():
    assert yesterday() in {(datetime.now(timezone.utc) - timedelta(days=1, seconds=s)).strftime("%Y-%m-%d") for s in (0, 60)}
