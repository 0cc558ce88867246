"""Control chart with per-series state that resets after each alarm."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "series string, us long, value double, cusum_upper double, cusum_lower double, anomaly_type string"
STATE = "n long, mean double, squares double, upper double, lower double, us array<long>, waiting array<double>"


def _advance(points: pd.DataFrame, upper: float, lower: float, target: float, deviation: float, slack: float, threshold: float):
    """CUSUM over points in time order; both sums return to zero after an alarm."""
    rows = []
    for at, value in zip(points["at"], points["value"]):
        z = (value - target) / deviation
        upper, lower = max(0.0, upper + z - slack), max(0.0, lower - z - slack)
        kind = "increase" if upper > threshold else "decrease" if lower > threshold else None
        rows.append((at, value, upper, lower, kind))
        if kind:
            upper = lower = 0.0
    return rows, upper, lower


def cusum_stream(
    points: DataFrame,
    target: float | None = None,
    deviation: float | None = None,
    slack: float = 0.5,
    threshold: float = 5.0,
    warmup: int = 50,
    delay: str = "0 seconds",
    forget: int | None = None,
) -> DataFrame:
    """``points`` has series, at, value: one aggregated point per series and period, in any order of arrival.

    A point waits in its series' buffer until the watermark (the latest time seen, less ``delay``) has reached it; points are then
    scored in time order, those of one time by value. The result is that of the sorted table as long as no point arrives more than
    ``delay`` late; later ones are dropped by the watermark. The buffer holds the points of the delay, a timer at the first of them
    wakes the series when nothing new arrives.

    Without ``target`` and ``deviation``, mean and sample deviation of the series' first ``warmup`` points in time are its level;
    those points come out with null sums. A deviation of zero counts as one. After ``forget`` seconds of event time without a
    point, a series is dropped from the state and starts anew with its next point; None keeps all.

    Points without time or value are left out; a null series is one of its own; points before 1970 count as late.
    """
    if (target is None) != (deviation is None):
        raise ValueError("give target and deviation or neither")
    learn = 0 if target is not None else warmup
    if target is None and warmup < 2:
        raise ValueError("a level needs at least two points")

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, mean, squares, upper, lower, us, waiting = state.get if state.exists else (0, 0.0, 0.0, 0.0, 0.0, [], [])
        mark = state.getCurrentWatermarkMs()
        if state.hasTimedOut and not len(us):
            state.remove()
            return
        us, waiting = list(us), list(waiting)
        if not state.hasTimedOut:
            for pdf in batches:
                us += pdf["us"].tolist()
                waiting += pdf["value"].tolist()
        points = sorted(zip(us, waiting))
        due = sum(at <= mark * 1000 for at, _ in points)
        rows = []
        settled = pd.DataFrame(points[:due], columns=["at", "value"])
        first = settled.iloc[: max(0, learn - n)]
        for at, value in zip(first["at"], first["value"]):
            n += 1
            step = value - mean
            mean += step / n
            squares += step * (value - mean)
            rows.append((at, value, None, None, None))
        if len(first) < len(settled):
            spread = deviation if target is not None else (squares / (n - 1)) ** 0.5
            level = target if target is not None else mean
            scored, upper, lower = _advance(settled.iloc[len(first) :], upper, lower, level, spread or 1.0, slack, threshold)
            rows += scored
        left = points[due:]
        state.update((n, mean, squares, upper, lower, [at for at, _ in left], [v for _, v in left]))
        if left:  # fires once the watermark is at the first waiting point
            state.setTimeoutTimestamp(max(1, -(-left[0][0] // 1000) - 1))
        elif forget is not None:
            state.setTimeoutTimestamp(mark + 1000 * forget)
        if rows:
            out = pd.DataFrame(rows, columns=["us", "value", "cusum_upper", "cusum_lower", "anomaly_type"])
            out = out.astype({"us": "int64", "cusum_upper": "float64", "cusum_lower": "float64"})
            out.insert(0, "series", pd.Series([key[0]] * len(out), dtype=object))
            yield out

    timed = points.filter(F.col("at").isNotNull() & F.col("value").isNotNull()).select(
        F.col("series").cast("string").alias("series"), F.col("at").cast("timestamp").alias("at"), F.col("value").cast("double").alias("value")
    )
    scored = (
        timed.withWatermark("at", delay)
        .withColumn("us", F.unix_micros("at"))
        .groupBy("series")
        .applyInPandasWithState(update, OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )
    return scored.select("series", F.timestamp_micros("us").alias("at"), "value", "cusum_upper", "cusum_lower", "anomaly_type")
