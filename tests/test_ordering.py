"""Distributed ranks, running sums, order statistics and percentiles against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartwright.operators.ordering import (
    grouped_percentiles,
    rank_within,
    rows_at_ranks,
    running_within,
    with_global_order,
)
from cartwright.operators.rfm import equal_count_scores, ntile_descending, recency_score
from cartwright.session import materialise


def table(spark, n=997, seed=3):
    rng = np.random.default_rng(seed)
    # A third of the rows share one value and one group.
    v = np.where(rng.random(n) < 1 / 3, 7, rng.integers(0, 50, n))
    g = np.where(rng.random(n) < 1 / 3, "hot", rng.choice(list("abc"), n))
    pdf = pd.DataFrame({"id": np.arange(n), "g": g, "v": v, "x": rng.normal(size=n).round(3)})
    return pdf, spark.createDataFrame(pdf)


def test_rank_and_running_sum(spark):
    pdf, df = table(spark)
    out = with_global_order(df, [F.desc("v"), "id"], sums={"cum": "v"}).toPandas().sort_values("rank")
    want = pdf.sort_values(["v", "id"], ascending=[False, True])
    assert out["id"].tolist() == want["id"].tolist()
    assert out["rank"].tolist() == list(range(1, len(pdf) + 1))
    assert out["cum"].tolist() == want["v"].cumsum().tolist()


def test_rank_and_sums_within_groups(spark):
    pdf, df = table(spark)
    want = pdf.sort_values(["g", "v", "id"])
    want = want.assign(r=want.groupby("g").cumcount() + 1, c=want.groupby("g")["v"].cumsum()).set_index("id")
    ranked = rank_within(df, ["g"], ["v", "id"], rank="r").toPandas().set_index("id")
    assert (ranked["r"] == want["r"].reindex(ranked.index)).all()
    running = running_within(df, ["g"], ["v", "id"], {"c": "v"}, rank="r").toPandas().set_index("id")
    assert (running["c"] == want["c"].reindex(running.index)).all()


def test_rank_within_keeps_null_group(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, g string")
    got = {r["id"]: r["rank"] for r in rank_within(df, ["g"], ["id"]).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_rows_at_ranks(spark):
    pdf, df = table(spark)
    want = pdf.sort_values(["v", "id"]).reset_index(drop=True)
    got = rows_at_ranks(df, ["v", "id"], [1, 500, 997])
    assert {k: r["id"] for k, r in got.items()} == {k: int(want.loc[k - 1, "id"]) for k in (1, 500, 997)}


@pytest.mark.parametrize("groups", [["g"], []])
def test_percentiles(spark, groups):
    pdf, df = table(spark)
    probs = {"p10": 0.1, "med": 0.5, "p99": 0.99}
    got = grouped_percentiles(df, groups, "x", probs).toPandas()
    if groups:
        want = pdf.groupby("g")["x"].quantile(list(probs.values())).unstack()
        got = got.set_index("g").sort_index()
    else:
        want = pdf["x"].quantile(list(probs.values())).to_frame().T
    assert np.allclose(got[list(probs)].to_numpy(float), want.to_numpy(float))


@pytest.mark.parametrize("n", [2, 5, 6, 11, 233])
def test_equal_count_scores_match_qcut(spark, n):
    rng = np.random.default_rng(n)
    pdf = pd.DataFrame({"id": np.arange(n), "v": rng.integers(0, 5, n)})
    want = pd.qcut(pdf["v"].rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int)
    df = materialise(spark.createDataFrame(pdf))
    got = equal_count_scores(df, {"s": "v"}, "id").toPandas().sort_values("id")
    assert got["s"].tolist() == want.tolist()


def test_recency_score_matches_qcut(spark):
    pdf = pd.DataFrame({"id": np.arange(400), "recency": np.random.default_rng(1).permutation(4000)[:400]})
    want = pd.qcut(pdf["recency"], 5, labels=[5, 4, 3, 2, 1]).astype(int)
    got = recency_score(spark.createDataFrame(pdf)).toPandas().sort_values("id")
    assert got["R_score"].tolist() == want.tolist()


@pytest.mark.parametrize("n", [3, 10, 57])
def test_ntile(spark, n):
    pdf = pd.DataFrame({"id": np.arange(n), "v": np.random.default_rng(n).integers(0, 4, n).astype(float)})
    df = materialise(spark.createDataFrame(pdf))
    got = ntile_descending(df, "v", "id", 10, "tile").toPandas().sort_values("id")["tile"].tolist()
    df.createOrReplaceTempView("nt")
    want = spark.sql("SELECT id, ntile(10) OVER (ORDER BY v DESC, id) AS t FROM nt").toPandas().sort_values("id")
    assert got == want["t"].tolist()
