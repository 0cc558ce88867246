"""Co-occurrence, recommendations and neighbours against brute force, with one group holding a third of all rows."""

from itertools import combinations, permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartwright.operators import blocks, nearest, products
from cartwright.operators.cooccurrence import frequent_pairs
from cartwright.operators.predictive import recommend as R
from cartwright.session import materialise


def baskets(seed=0, n_groups=60, n_items=40):
    """Small groups plus two that hold most items."""
    rng = np.random.default_rng(seed)
    rows = set()
    for g in range(n_groups):
        rows |= {(g, int(i)) for i in rng.choice(n_items, rng.integers(1, 5), replace=False)}
    rows |= {(1000, i) for i in range(n_items)} | {(1001, i) for i in range(0, n_items, 2)}
    pdf = pd.DataFrame(sorted(rows), columns=["user", "item"])
    pdf["w"] = rng.integers(1, 6, len(pdf)).astype(float)
    return pdf


def brute_pairs(pdf):
    out = {}
    for _, part in pdf.groupby("user"):
        for (a, wa), (b, wb) in combinations(sorted(zip(part["item"], part["w"])), 2):
            out[(a, b)] = out.get((a, b), 0.0) + wa * wb
    return out


@pytest.fixture(params=[7, 512])
def block_size(request, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_IDS", request.param)
    return request.param


@pytest.mark.parametrize("limit", [3, 10, 1000])
def test_similar_items_are_complete(spark, limit, block_size):
    pdf = baskets()
    m = pdf.pivot(index="user", columns="item", values="w").fillna(0).to_numpy()
    unit = m / np.linalg.norm(m, axis=0)
    want = unit.T @ unit
    np.fill_diagonal(want, 0)
    cells = materialise(spark.createDataFrame(pdf))
    got = R.similar_items(R.item_similarity(cells, limit), n=5).toPandas()
    assert len(got) == 5 * want.shape[0]
    for i, part in got.groupby("item"):
        rounded = np.floor(want[i] * 1e7 + 0.5)
        top = sorted(range(len(rounded)), key=lambda j: (-rounded[j], j))[:5]
        assert part.sort_values("rank")["other"].tolist() == top
        assert np.allclose(part.sort_values("rank")["similarity"], want[i][top], atol=1e-7)


@pytest.mark.parametrize("limit", [3, 1000])
def test_frequent_pairs(spark, limit, block_size):
    pdf = baskets(seed=4).assign(w=1.0)
    txn = spark.createDataFrame(pdf).select(
        F.col("user").alias("order_id"), F.col("item").alias("product_id"), F.lit("c").alias("category"), F.lit(1.0).alias("revenue")
    )
    want = sorted(brute_pairs(pdf).items(), key=lambda kv: (-kv[1], kv[0]))[:20]
    got = frequent_pairs(txn, 20, light_limit=limit).collect()
    assert [((r["product_a"], r["product_b"]), float(r["co_occurrences"])) for r in got] == want
    freq = pdf.groupby("item")["user"].nunique()
    first = got[0]
    assert first["support"] == pytest.approx(first["co_occurrences"] / pdf["user"].nunique())
    assert first["confidence"] == pytest.approx(first["co_occurrences"] / freq[first["product_a"]])


@pytest.mark.parametrize("limit", [2, 10, 1000])
@pytest.mark.parametrize("exclude", [True, False])
def test_scores_match_dense_computation(spark, limit, exclude, block_size):
    pdf = baskets(seed=2)
    cells = materialise(spark.createDataFrame(pdf))
    m = pdf.pivot(index="user", columns="item", values="w").fillna(0)
    a = m.to_numpy()
    unit = a / np.linalg.norm(a, axis=0)
    scores = a @ (unit.T @ unit) / ((a > 0).sum(axis=1, keepdims=True) + 1)
    if exclude:
        scores[a > 0] = -np.inf
    got = R.score_users(cells, R.item_similarity(cells, limit), n=3, exclude_purchased=exclude).toPandas()
    full = ((scores > 0).sum(axis=1).clip(max=3)).sum()
    assert len(got) == full
    for row in got.itertuples():
        u = m.index.get_loc(row.user)
        assert row.score == pytest.approx(scores[u, m.columns.get_loc(row.item)], abs=1e-6)
        assert row.score >= np.sort(scores[u])[::-1][row.rank - 1] - 1e-6
    assert (1000 in set(got["user"])) != exclude  # bought everything


def test_cold_start_gets_popular_items(spark):
    cells = materialise(spark.createDataFrame(baskets()))
    users = spark.createDataFrame([(0,), (5555,)], "user long")
    got = R.recommend(users, cells, R.item_similarity(cells), n=4).toPandas()
    cold = got[got.user == 5555].sort_values("rank")
    top = baskets().groupby("item")["w"].sum().reset_index().sort_values(["w", "item"], ascending=[False, True])["item"].head(4)
    assert cold["item"].tolist() == top.tolist() and cold["cold_start"].all()
    assert not got[got.user == 0]["cold_start"].any()


def test_neighbours_in_blocks(spark, block_size):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(25, 4))
    features = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "item long, features array<double>")
    sims = spark.createDataFrame([(0, 1, 1.0), (1, 0, 1.0)], "item long, other long, similarity double")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = 0.5 * unit @ unit.T
    want[0, 1] += 0.5
    want[1, 0] += 0.5
    np.fill_diagonal(want, -np.inf)
    heavy = spark.createDataFrame([(9, 4, 0.6), (9, 5, 0.5), (9, 6, 0.4)], "user long, item long, w double")
    for (i, x_i), (j, x_j) in permutations({4: 0.6, 5: 0.5, 6: 0.4}.items(), 2):
        want[i, j] += 0.5 * x_i * x_j
    got = R.blended_neighbours(features, R.Similarity(sims, heavy), 0.5, n=3).toPandas()
    for i, part in got.groupby("item"):
        assert part.sort_values("rank")["other"].tolist() == np.argsort(-want[i])[:3].tolist()


def test_ranking_quality(spark):
    recs = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 12, 1)], "user long, item long, rank int")
    test = spark.createDataFrame([(1, 11), (1, 99), (2, 50), (3, 7)], "user long, item long")
    got = R.ranking_quality(recs, test, k=2).first()
    assert got["users"] == 3
    assert got["precision_at_k"] == pytest.approx((1 / 2 + 0 + 0) / 3)
    assert got["recall_at_k"] == pytest.approx((1 / 2) / 3)
    assert got["ndcg_at_k"] == pytest.approx((1 / np.log2(3)) / (1 + 1 / np.log2(3)) / 3)


def test_small_cosines_keep_their_order(spark):
    """Cosines near 1e-9 that grow with the id: the order of scores is not that of ids, at every limit."""
    rows = [(f"u{i}", f"i{i}", 30_000.0) for i in range(6)] + [("all", f"i{i}", 1.0 + i / 10) for i in range(6)]
    cells = spark.createDataFrame(rows, "user string, item string, w double")
    pdf = cells.toPandas().pivot(index="user", columns="item", values="w").fillna(0)
    unit = pdf.to_numpy() / np.linalg.norm(pdf.to_numpy(), axis=0)
    cos = unit.T @ unit
    np.fill_diagonal(cos, -1)
    assert 1e-10 < cos[0].max() < 3e-9
    for limit in (1, 1000):
        got = R.similar_items(R.item_similarity(cells, light_limit=limit), n=3).toPandas()
        for i, part in got.groupby("item"):
            best = [pdf.columns[j] for j in np.argsort(-cos[pdf.columns.get_loc(i)])[:3]]
            assert part.sort_values("rank")["other"].tolist() == best
            assert part["similarity"].to_numpy() == pytest.approx([cos[pdf.columns.get_loc(i), pdf.columns.get_loc(o)] for o in part["other"]], rel=1e-6)


def test_small_cosines_are_the_same_at_every_limit(spark):
    rows = [(f"u{i}", f"i{i}", 30_000.0) for i in range(4)] + [("all", f"i{i}", 1.0) for i in range(4)]  # cosines near 1e-9
    cells = spark.createDataFrame(rows, "user string, item string, w double")
    near, scores = [], []
    for limit in (1, 1000):
        similarity = R.item_similarity(cells, light_limit=limit)
        near.append(sorted(map(tuple, R.similar_items(similarity).collect())))
        scores.append(sorted(map(tuple, R.score_users(cells, similarity).collect())))
    assert len(near[0]) == 12 and near[0] == near[1]
    assert len(scores[0]) == 12 and scores[0] == scores[1]


@pytest.mark.parametrize("cells_per_block", [15, 4_000_000])
def test_scores_and_neighbours_need_no_pairs(spark, cells_per_block, monkeypatch):
    """The unit cells alone give what the pairs give, in one block or many."""
    monkeypatch.setattr(products, "BLOCK_CELLS", cells_per_block)
    cells = materialise(spark.createDataFrame(baskets(seed=5)))
    known = R.item_similarity(cells)
    pairs, alone = R.Similarity(known.light, None), R.Similarity(None, None, known.cells)
    for fn in (lambda s: R.similar_items(s, n=4), lambda s: R.score_users(cells, s, n=3)):
        want = sorted((r[0], r[1], round(r[2], 6), r[3]) for r in fn(pairs).collect())
        assert sorted((r[0], r[1], round(r[2], 6), r[3]) for r in fn(alone).collect()) == want


def test_dense_and_ruled_out_products(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(40, 6)), rng.normal(size=(150, 6))
    sides = [
        spark.createDataFrame([(f"k{k}", i, float(m[i, k])) for i in range(len(m)) for k in range(6)], "k string, id long, w double")
        for m in (x, y)
    ]
    scores = x @ y.T
    out = [(i, int(np.argmax(scores[i]))) for i in range(40)]
    for i, j in out:
        scores[i, j] = -np.inf
    got = products.best_of_products(*sides, 3, spark.createDataFrame(out, "l long, r long"), positive_only=False, same_ids=False)
    want = {(i, int(j)) for i in range(40) for j in np.argsort(-scores[i])[:3]}
    assert {(r["l"], r["r"]) for r in got.collect()} == want


def test_an_item_without_a_feature_takes_nothing_from_others(spark):
    rows = [(i, [1.0, None if i == 3 else float(i)]) for i in range(90)]
    features = spark.createDataFrame(rows, "item long, features array<double>")
    got = R.blended_neighbours(features, n=2).toPandas()
    assert set(got["item"]) == set(range(90)) - {3} == set(got["item"]) | set(got["other"])
    assert len(got) == 89 * 2


@pytest.mark.parametrize("held, buffer", [(1, 300_000), (4, 20)])
def test_scores_by_bucket_equal_all_sums(held, buffer, monkeypatch):
    """Sparse rows over several right blocks, a user with many cells, more products than are held at a time."""
    monkeypatch.setattr(products, "BUFFER", buffer)
    rng = np.random.default_rng(3)
    x = np.where(rng.random((90, 700)) < 0.02, rng.integers(1, 9, (90, 700)), 0.0)
    x[7] = rng.random(700) < 0.2
    own = x * (rng.random(x.shape) < 0.6)
    user, item = np.nonzero(own)
    left = products._Left(
        products._left_block({"id": pa.array(user), "k": pa.array(item.astype(np.int32)), "w": pa.array(own[user, item]), "r": pa.array(item)}), 3
    )
    u, i = np.nonzero(x)
    for b in range(3):
        m = i % 3 == b
        cells = {"j": (i[m] // 3).astype(np.int32), "via": u[m].astype(np.int32), "w": x[u[m], i[m]]}
        left.extend(products._through_block({c: pa.array(v) for c, v in cells.items()}), b)
    left.close()
    for b in range(held):
        m = i % held == b
        cells = {"id": pa.array(i[m]), "k": pa.array(u[m].astype(np.int32)), "w": pa.array(x[u[m], i[m]])}
        pair = products._Pair(left, products._right_block(cells), len(x), 5, True, False)
        pair.few = True
        pair.best()
    want = blocks._significant(own @ x.T @ x)
    want[own > 0] = -np.inf
    got = list(zip(left.ids.take(pa.array(left.row)).to_pylist(), left.partner.to_pylist()))
    for row in np.unique(user):
        best = [j for j in np.lexsort((np.arange(700), -want[row]))[:5] if want[row, j] > 0]
        assert [j for r, j in got if r == row] == best


@pytest.mark.parametrize("exclude", [True, False])
def test_ways_over_buyers_are_walked_inside_a_task(spark, exclude, monkeypatch):
    """Users buy more than items are bought; one item is bought by all. Left blocks are cut by the ways."""
    monkeypatch.setattr(products, "BLOCK_CELLS", 150)
    monkeypatch.setattr(products, "LEFT_WAYS", 300)
    rng = np.random.default_rng(6)
    rows = [(f"u{u}", int(i), float(rng.integers(1, 9))) for u in range(15) for i in {0, *rng.choice(300, 50, replace=False).tolist()}]
    pdf = pd.DataFrame(rows, columns=["user", "item", "w"])
    cells = materialise(spark.createDataFrame(pdf))
    known = R.item_similarity(cells)
    assert R._by_buyers(cells, known) == (pdf.groupby("item").size() ** 2).sum()
    found = R.score_users(cells, known, n=3, exclude_purchased=exclude)
    assert found.count() == 45
    m = pdf.pivot(index="user", columns="item", values="w").fillna(0)
    a = m.to_numpy()
    unit = a / np.linalg.norm(a, axis=0)
    scores = a @ (unit.T @ unit) / ((a > 0).sum(axis=1, keepdims=True) + 1)
    scores[(a > 0) & exclude] = -np.inf
    for row in found.collect():
        u = m.index.get_loc(row["user"])
        assert row["score"] == pytest.approx(scores[u, m.columns.get_loc(row["item"])], rel=1e-6)
        assert row["score"] >= np.sort(scores[u])[::-1][row["rank"] - 1] * (1 - 1e-6)


def test_nearest_by_boxes_equals_all_pairs(spark, monkeypatch):
    """Points on a sphere, many of them twice, zeros among them, in several blocks: ties go to the smaller id."""
    monkeypatch.setattr(nearest, "BLOCK_VALUES", 900)
    monkeypatch.setattr(nearest, "LEFT_POINTS", 150)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 3)) * [1, 1, 0.2]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = np.concatenate([x, x[:300], np.zeros((3, 3))])[rng.permutation(703)]
    got = nearest.nearest(spark.createDataFrame([(f"i{i:03}", v.tolist()) for i, v in enumerate(x)], "id string, x array<double>"), 4).collect()
    scores = nearest._rounded(x @ x.T)
    np.fill_diagonal(scores, -np.inf)
    want = [(f"i{i:03}", f"i{j:03}", k + 1) for i in range(703) for k, j in enumerate(np.lexsort((np.arange(703), -scores[i]))[:4])]
    assert sorted((r["l"], r["r"], r["rank"]) for r in got) == sorted(want)


def test_boxes_far_away_are_not_read():
    """The boxes that a box must read hardly grow with their number."""
    rng = np.random.default_rng(9)
    read = []
    for size in (2_000, 16_000):
        x = rng.normal(size=(size, 3))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        boxes = nearest._Boxes(nearest._points({"id": pa.array(range(size)), "x": pa.array(x.tolist())}))
        seen = []
        row, col, score = nearest._search(boxes, boxes, np.full(size, -np.inf), 5)
        for box in range(len(boxes.at) - 1):
            points = slice(boxes.at[box], boxes.at[box + 1])
            least = score[(row >= points.start) & (row < points.stop)].min()
            seen.append((boxes.bounds(boxes.low[box], boxes.high[box], boxes.square[box]) >= least).sum())
        read.append(np.mean(seen))
    assert read[1] < 2 * read[0] < len(boxes.at) / 4


def test_blended_pairs_with_and_without_a_common_customer(spark, monkeypatch):
    monkeypatch.setattr(products, "BLOCK_CELLS", 80)
    rng = np.random.default_rng(10)
    x = rng.normal(size=(60, 3))
    bought = np.where(rng.random((25, 60)) < 0.06, rng.integers(1, 9, (25, 60)), 0.0)
    bought[:, 5] = 0
    rows = [(int(u), int(i), float(bought[u, i])) for u, i in zip(*np.nonzero(bought))]
    cells = materialise(spark.createDataFrame(rows, "user long, item long, w double"))
    features = spark.createDataFrame([(i, [None if i == 7 else float(v) for v in row]) for i, row in enumerate(x)], "item long, features array<double>")
    got = R.blended_neighbours(features, R.item_similarity(cells), 0.3, n=4).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cosine = bought / np.maximum(np.linalg.norm(bought, axis=0), 1e-300)
    want = np.floor((0.7 * unit @ unit.T + 0.3 * cosine.T @ cosine) * 1e7 + 0.5)
    np.fill_diagonal(want, -np.inf)
    want[7] = want[:, 7] = -np.inf
    best = {i: np.lexsort((np.arange(60), -want[i]))[:4].tolist() for i in range(60) if i != 7}
    assert {i: [r["other"] for r in sorted(got, key=lambda r: r["rank"]) if r["item"] == i] for i in {r["item"] for r in got}} == best
