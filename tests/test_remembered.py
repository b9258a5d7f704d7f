"""Jobs that remember their runs, and exact quantiles."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from doorledger.operators.quantiles import quantiles
from doorledger.plans.remembered import last_run, materialize_run, refresh_summaries
from doorledger.sources import lake


class Died(Exception):
    pass


def die():
    raise Died


def test_a_dead_run_leaves_the_state_before(spark, tmp_path):
    base, day = str(tmp_path), datetime(2024, 1, 1)
    rows = [(f"e{i % 7}", float(i), i, day + timedelta(hours=3 * i)) for i in range(80)]
    off = (spark.createDataFrame(rows, "employee_id string, score double, version bigint, event_timestamp timestamp")
           .withColumn("created_at", F.col("event_timestamp")))
    assert last_run(spark, base) is None

    def want(first, last):
        best = {}
        for e, s, v, t in rows:
            if first < t <= last and (e not in best or t > best[e][1]):
                best[e] = (s, t)
        return {e: s for e, (s, _) in best.items()}

    got = lambda df: {r.employee_id: r.score for r in df.collect()}
    one = materialize_run(off, base, "2024-01-03", ttl_days=1)
    assert got(one) == want(day + timedelta(days=1), day + timedelta(days=2))
    with pytest.raises(Died):
        materialize_run(off, base, "2024-01-05", written=die)
    run = last_run(spark, base)
    assert (run.number, run.end[:10]) == (1, "2024-01-03")
    three = materialize_run(off, base, "2024-01-07 06:00:00")
    assert got(three) == want(day + timedelta(days=1), datetime(2024, 1, 7, 6))  # no gap, no overlap
    assert last_run(spark, base).number == 2
    assert got(materialize_run(off, base, "2024-01-06")) == got(three) and last_run(spark, base).number == 2


def test_only_changed_days_are_summarised_again(spark, tmp_path):
    base = str(tmp_path)
    rnd = random.Random(2)

    def write(days, n):
        rows = [("2024", "01", f"{d:02d}", f'{{"user_id":{rnd.choice(["null", chr(34) + "u" + str(rnd.randrange(9)) + chr(34)])},"action":"{rnd.choice(["prediction", "x"])}"}}')
                for d in days for _ in range(n)]
        (spark.createDataFrame(rows, "Year string, Month string, Day string, value string").repartition("Day")
         .write.mode("append").partitionBy("Year", "Month", "Day").text(f"{base}/lake"))

    def refresh(**kw):
        return refresh_summaries(spark, f"{base}/lake", f"{base}/state", f"{base}/reports", **kw)

    def full():
        return {(f"2024-01-{r.Day}", r.n, r.p, r.u) for r in lake.read_lake(spark, f"{base}/lake").groupBy("Day").agg(
            F.count("*").alias("n"), F.count_if(F.col("action") == "prediction").alias("p"),
            (F.count_distinct("user_id") + F.max(F.col("user_id").isNull().cast("int"))).alias("u")).collect()}

    def reports():
        return {(r.date, r.total_events, r.total_predictions, r.unique_users) for r in lake.read_daily_summaries(spark, f"{base}/reports").collect()}

    write(range(1, 31), 6)
    done = refresh()
    assert done.files == 30 and len(done.days) == 30 and reports() == full()
    write([4, 17], 5)
    with pytest.raises(Died):  # what it added counts for nobody
        refresh(written=die)
    done = refresh()
    assert (done.files, done.days) == (2, ["2024-01-04", "2024-01-17"]) and reports() == full()
    assert refresh().files == 0 and reports() == full()


@pytest.mark.parametrize("seed", range(2))
def test_quantiles_are_exact(spark, seed):
    rnd = random.Random(seed)
    make = [lambda: rnd.gauss(0, 1), lambda: rnd.lognormvariate(3, 2), lambda: float(rnd.randrange(4)), lambda: -rnd.random() * 1e-9, lambda: rnd.choice([1e300, -1e300, 0.0])]
    rows = [(rnd.choice(["hot"] * 18 + ["a", None]), rnd.randrange(2), rnd.choice(make)()) for _ in range(3000)]
    rows += [("one", 0, 5.0), ("none", 0, None), ("nan", 1, math.nan), ("a", 0, None), ("hot", 1, math.nan)]
    df = spark.createDataFrame(rows, "k string, part int, value double").repartition(5)
    qs = [0.0, 0.37, 0.5, 0.95, 0.99, 1.0]
    got = {(r.k, r.part, r.q): r.value for r in quantiles(df, ["k", "part"], "value", qs).collect()}
    groups = {}
    for k, p, v in rows:
        if v is not None and not math.isnan(v):
            groups.setdefault((k, p), []).append(v)
    assert got.keys() == {(*g, q) for g in groups for q in qs}
    for (k, p, q), v in got.items():
        assert v == pytest.approx(np.quantile(groups[k, p], q), rel=1e-12, abs=1e-15)
    assert [r.value for r in quantiles(df.where("k = 'one'"), [], "value", [0.5]).collect()] == [5.0]
    with pytest.raises(ValueError):
        quantiles(df, ["k"], "value", [1.5])
