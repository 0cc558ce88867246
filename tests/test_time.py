"""As-of lookups, control charts, streams and the batch flow."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartwright.operators.timeline import as_of_join, cusum
from cartwright.session import materialise
from cartwright.streaming import alarms, live
from cartwright.streaming.run import drain


@pytest.mark.parametrize("slice_seconds", [600, 86_400, 10**9])
def test_as_of_join_matches_pandas(spark, slice_seconds):
    rng = np.random.default_rng(0)
    stamp = lambda n: pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 40 * 86400, n), unit="s")
    hot = lambda n: np.where(rng.random(n) < 0.4, 0, rng.integers(0, 8, n))
    facts = pd.DataFrame({"k": hot(300), "at": stamp(300), "f": np.arange(300)})
    feats = pd.DataFrame({"k": hot(120), "ts": stamp(120), "v": np.arange(120)}).drop_duplicates(["k", "ts"])
    want = pd.merge_asof(facts.sort_values("at"), feats.sort_values("ts"), left_on="at", right_on="ts", by="k")
    got = as_of_join(spark.createDataFrame(facts), spark.createDataFrame(feats), "k", "at", "ts", slice_seconds).toPandas()
    assert len(got) == 300
    assert got.set_index("f")["v"].sort_index().equals(want.set_index("f")["v"].sort_index())


def shifted():
    rng = np.random.default_rng(42)
    return np.concatenate([rng.normal(100, 10, 50), rng.normal(115, 10, 20)])


def test_cusum_equals_recursion_and_flags_shift(spark):
    values = shifted()
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(values)], "k string, t int, v double")
    got = cusum(df, ["k"], "t", "v").orderBy("t").toPandas()
    z = (values - values[:50].mean()) / values[:50].std(ddof=1)
    up = down = 0.0
    for i, v in enumerate(z):
        up, down = max(0.0, up + v - 0.5), max(0.0, down - v - 0.5)
        assert got["cusum_upper"][i] == pytest.approx(up, abs=1e-9)
        assert got["cusum_lower"][i] == pytest.approx(down, abs=1e-9)
    assert got["is_anomaly"][50:].any() and set(got["anomaly_type"].dropna()) == {"increase"}


def events(spark, path, n=400, files=4):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame(
        {
            "event_id": np.arange(n),
            "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.sort(rng.integers(0, 7200, n)), unit="s"),
            "user_id": np.where(rng.random(n) < 1 / 3, 0, rng.integers(0, 20, n)),
            "event_type": rng.choice(["view", "purchase"], n),
            "value": rng.gamma(2, 10, n).round(2),
        }
    )
    for part in np.array_split(pdf, files):
        spark.createDataFrame(part).coalesce(1).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def test_streams_equal_batch(spark, tmp_path):
    path = str(tmp_path / "events")
    batch = events(spark, path)
    stream = lambda: spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(path)
    cutoff = batch.agg(F.max("ts") - F.expr("INTERVAL 10 MINUTES")).first()[0]

    got = drain(live.minute_metrics(stream(), "1 day")).count()
    assert got == 0  # nothing closes before the watermark passes

    # All files are read in one micro-batch or in time order, so no row is late.
    ordered = lambda: spark.readStream.schema(batch.schema).parquet(path)
    minutes = drain(live.minute_metrics(ordered())).toPandas().sort_values("minute").reset_index(drop=True)
    want = live.minute_metrics(batch).filter(F.col("minute") + F.expr("INTERVAL 1 MINUTE") <= F.lit(cutoff))
    pd.testing.assert_frame_equal(minutes, want.toPandas().sort_values("minute").reset_index(drop=True))

    users = drain(live.running_rfm(stream()), "update", ["user_id"]).toPandas().sort_values("user_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(users, live.running_rfm(batch).toPandas().sort_values("user_id").reset_index(drop=True))

    twice = ordered().unionByName(ordered())
    assert drain(live.deduplicated(twice).select("event_id")).count() == batch.count()

    closed = drain(live.sessions(ordered(), "5 minutes")).count()
    every = live.sessions(batch, "5 minutes").filter(F.col("session_end") <= F.lit(cutoff)).count()
    assert closed == every


def test_batch_sessions_equal_session_windows_and_split_a_hot_customer(spark):
    rng = np.random.default_rng(4)
    n = 4000
    user = np.where(rng.random(n) < 0.5, 1, rng.integers(2, 60, n))
    at = pd.Timestamp("2024-03-01") + pd.to_timedelta(rng.integers(0, 3 * 86_400, n), unit="s")
    pdf = pd.DataFrame({"user_id": user, "ts": at, "value": rng.random(n).round(2)})
    edge = pd.Timestamp("2024-04-01")  # exactly one gap between two events
    pdf = pd.concat((pdf, pd.DataFrame({"user_id": [70, 70, 71, 71], "ts": [edge, edge + pd.Timedelta("5min"), edge, edge + pd.Timedelta("299s")],
                                        "value": [1.0, 2.0, 3.0, 4.0]})))
    batch = spark.createDataFrame(pdf).repartition(6).withColumn("ts", F.col("ts").cast("timestamp"))
    order = ["user_id", "session_start"]
    got = live.batch_sessions(batch, "5 minutes").toPandas().sort_values(order).reset_index(drop=True)
    want = []
    for u, g in pdf.sort_values("ts").groupby("user_id"):
        number = (g["ts"].diff() >= pd.Timedelta("5min")).cumsum()
        want += [(u, s["ts"].min(), s["ts"].max() + pd.Timedelta("5min"), len(s), round(s["value"].sum(), 4)) for _, s in g.groupby(number)]
    assert [tuple(r) for r in got.round({"value": 4}).itertuples(index=False)] == sorted(want)
    # Folded before the shuffle: no window or session is computed on single events.
    plan = live.batch_sessions(batch)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "SessionWindow" not in plan and "MergingSessions" not in plan
    odd = spark.createDataFrame([(None, None, 1.0), (5, None, 1.0), (None, edge.to_pydatetime(), None)], "user_id long, ts timestamp, value double")
    assert [(r["user_id"], r["events"], r["value"]) for r in live.batch_sessions(odd).collect()] == [(None, 1, None)]
    assert live.batch_sessions(batch.limit(0)).count() == 0


def test_sketched_unique_customers_within_their_error(spark, tmp_path):
    rng = np.random.default_rng(5)
    start = pd.Timestamp("2024-05-01")
    pdf = pd.DataFrame({"user_id": rng.integers(0, 20_000, 60_000), "ts": start + pd.to_timedelta(rng.integers(0, 900, 60_000), unit="s")})
    path = str(tmp_path / "visits")
    spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp")).repartition(5).write.parquet(path)
    stream = spark.readStream.schema("user_id long, ts timestamp").option("maxFilesPerTrigger", 2).parquet(path)
    minutes = drain(live.minute_sketches(stream, "1 hour"), "update", ["minute"])
    assert minutes.count() == 15
    got = {r["window_start"]: r["unique_customers"] for r in live.sliding_unique_customers(minutes).collect()}
    assert len(got) == 19
    for window, estimate in got.items():
        low = pd.Timestamp(window)
        exact = pdf.loc[(pdf["ts"] >= low) & (pdf["ts"] < low + pd.Timedelta("5min")), "user_id"].nunique()
        assert abs(estimate - exact) <= 4 * 0.0163 * exact + 1


def test_alarm_state_carries_over_batches(spark, tmp_path):
    values, path = shifted(), str(tmp_path / "points")
    rows = [("s", pd.Timestamp("2024-01-01") + pd.Timedelta(hours=i), float(v)) for i, v in enumerate(values)]
    pdf = pd.DataFrame(rows, columns=["series", "at", "value"])
    spark.createDataFrame(pdf).coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    got = drain(alarms.cusum_stream(stream, 100.0, 10.0)).orderBy("at").toPandas()
    want, _, _ = alarms._advance(pdf, 0.0, 0.0, 100.0, 10.0, 0.5, 5.0)
    assert np.allclose(got["cusum_upper"], [r[2] for r in want])
    assert (got["anomaly_type"] == "increase").any()
    # The same points in two halves end in the same state.
    first, u, l = alarms._advance(pdf[:30], 0.0, 0.0, 100.0, 10.0, 0.5, 5.0)
    second, _, _ = alarms._advance(pdf[30:], u, l, 100.0, 10.0, 0.5, 5.0)
    assert first + second == want


def batch_alarms(pdf, warmup, slack=0.5, threshold=5.0):
    """Level from the first points, then the plain recursion over each sorted series."""
    out = []
    for series, g in pdf.sort_values(["at", "value"]).groupby("series", dropna=False):
        values = g["value"].to_numpy()
        mean, deviation = values[:warmup].mean(), values[:warmup].std(ddof=1) or 1.0
        up = down = 0.0
        for i, (at, v) in enumerate(zip(g["at"], values)):
            if i < warmup:
                out.append((series, at, v, None, None, None))
                continue
            z = (v - mean) / deviation
            up, down = max(0.0, up + z - slack), max(0.0, down - z - slack)
            kind = "increase" if up > threshold else "decrease" if down > threshold else None
            out.append((series, at, v, round(up, 9), round(down, 9), kind))
            if kind:
                up = down = 0.0
    return sorted(out, key=str)


def test_alarms_of_late_and_unordered_points_are_those_of_the_sorted_batch(spark, tmp_path):
    rng = np.random.default_rng(11)
    start = pd.Timestamp("2024-01-01")
    n = 240
    pdf = pd.concat(
        [
            pd.DataFrame({"series": [name] * n, "at": start + pd.to_timedelta(np.arange(n), unit="h"), "value": rng.normal(100, 10, n).round(3)})
            for name in ("a", "b", None)
        ],
        ignore_index=True,
    )
    pdf.loc[(pdf["series"] == "a") & (pdf["at"] > start + pd.Timedelta("150h")), "value"] += 25
    pdf.loc[pdf["series"] == "b", "value"] = np.where(np.arange(n) < 200, 7.0, 9.0)  # no deviation at first
    twice = pdf[pdf["series"] == "a"].iloc[[60]].assign(value=1.0)  # two points of one time
    pdf = pd.concat([pdf, twice], ignore_index=True)
    arrival = pdf["at"] + pd.to_timedelta(rng.integers(0, 20, len(pdf)), unit="h")
    order = pdf.iloc[np.argsort(arrival.to_numpy(), kind="stable")]
    parts = [order.iloc[i : i + 150] for i in range(0, len(order), 150)]
    too_late = pd.DataFrame({"series": ["a"], "at": [start + pd.Timedelta("1min")], "value": [1e6]})
    last = pd.DataFrame({"series": ["end", "a", "a"], "at": [start + pd.Timedelta("900D"), None, start], "value": [1.0, 5.0, None]})
    schema = "series string, at timestamp, value double"
    path = str(tmp_path / "points")
    for part in [*parts, pd.concat([too_late, last])]:
        rows = [(s, None if pd.isna(at) else at.to_pydatetime(), None if pd.isna(v) else float(v)) for s, at, v in part.itertuples(index=False)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = drain(alarms.cusum_stream(stream, warmup=50, delay="48 hours")).filter("series is distinct from 'end'").collect()
    digits = lambda x: None if x is None else round(x, 9)
    rows = [(r["series"], pd.Timestamp(r["at"]), r["value"], digits(r["cusum_upper"]), digits(r["cusum_lower"]), r["anomaly_type"]) for r in got]
    clean = pdf.assign(series=pdf["series"].astype(object).where(pdf["series"].notna(), None))
    want = [(None if pd.isna(s) else s, *rest) for s, *rest in batch_alarms(clean, 50)]
    assert sorted(rows, key=str) == sorted(want, key=str)
    assert {r[5] for r in rows} >= {"increase"}
    empty = str(tmp_path / "none")
    spark.createDataFrame([], schema).write.parquet(empty)
    assert drain(alarms.cusum_stream(spark.readStream.schema(schema).parquet(empty))).count() == 0
    with pytest.raises(ValueError):
        alarms.cusum_stream(stream, target=1.0)


def test_quiet_series_leave_the_state_and_start_anew(spark, tmp_path):
    start, schema, path = pd.Timestamp("2024-01-01"), "series string, at timestamp, value double", str(tmp_path / "points")
    hours = lambda name, *hs: [(name, (start + pd.Timedelta(hours=h)).to_pydatetime(), float(h)) for h in hs]
    for part in (hours("a", 0, 1, 2), hours("b", 100), hours("b", 101), hours("a", 200, 201, 202)):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    unscored = lambda **kw: drain(alarms.cusum_stream(stream(), warmup=3, **kw)).filter("series = 'a' and cusum_upper is null").count()
    assert unscored() == 3
    assert unscored(forget=3600) == 6
