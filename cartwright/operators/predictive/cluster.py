"""Customer clustering: scaling, choice of k, business labels, profiles and a two-dimensional projection."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, RobustScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.functions import exact_avg, exact_sum
from cartwright.operators.ordering import grouped_percentiles
from cartwright.session import materialise

FEATURES = ["log_recency", "log_frequency", "log_monetary", "avg_order_value", "purchase_rate", "distinct_categories"]
# Labels from the highest composite score to the lowest.
LABELS = [
    "Champions",
    "Loyal Customers",
    "Potential Loyalists",
    "Recent Customers",
    "Promising",
    "Needs Attention",
    "At Risk",
    "Cannot Lose Them",
    "Hibernating",
    "Lost",
]


def scale_features(rfm: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Median-centred, IQR-scaled vector column ``x``; nulls count as zero."""
    filled = rfm.fillna(0, subset=features)
    assembled = VectorAssembler(inputCols=features, outputCol="_raw").transform(filled)
    scaler = RobustScaler(inputCol="_raw", outputCol="x", withCentering=True, withScaling=True)
    return scaler.fit(assembled).transform(assembled).drop("_raw")


def fit_kmeans(scaled: DataFrame, k: int, restarts: int = 20, max_iter: int = 500, seed: int = 42) -> KMeansModel:
    """Best of several k-means|| starts by training cost."""
    models = (
        KMeans(k=k, maxIter=max_iter, seed=seed + i, featuresCol="x", predictionCol="cluster").fit(scaled)
        for i in range(restarts)
    )
    return min(models, key=lambda m: m.summary.trainingCost)


@dataclass(frozen=True)
class ClusterQuality:
    k: int
    inertia: float
    silhouette: float
    calinski_harabasz: float
    davies_bouldin: float


def cluster_quality(model: KMeansModel, scaled: DataFrame) -> ClusterQuality:
    """Validation measures from one aggregate over the assigned table plus the silhouette job.

    The silhouette is MLlib's squared-Euclidean one over all rows.
    """
    assigned = model.transform(scaled)
    centers = [c.tolist() for c in model.clusterCenters()]
    x = vector_to_array("x")
    center = F.array(*[F.array(*[F.lit(v) for v in c]) for c in centers])[F.col("cluster")]
    squared = F.aggregate(
        F.zip_with(x, center, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v
    )
    dims = len(centers[0])
    per = assigned.select("cluster", x.alias("v"), squared.alias("d2")).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("d2").alias("within"),
        F.avg(F.sqrt("d2")).alias("spread"),
        *[F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dims)],
    )
    rows = sorted(per.collect(), key=lambda r: r["cluster"])  # k rows
    n = np.array([r["n"] for r in rows], float)
    within = sum(r["within"] for r in rows)
    means = np.array([[r[f"s{i}"] for i in range(dims)] for r in rows]) / n[:, None]
    grand = (means * n[:, None]).sum(axis=0) / n.sum()
    between = float((n * ((means - grand) ** 2).sum(axis=1)).sum())
    used = len(rows)
    ch = (between / max(used - 1, 1)) / (within / max(n.sum() - used, 1)) if within > 0 else float("inf")
    spread = np.array([r["spread"] for r in rows])
    gap = np.linalg.norm(means[:, None, :] - means[None, :, :], axis=2)
    np.fill_diagonal(gap, np.inf)
    db = float(((spread[:, None] + spread[None, :]) / gap).max(axis=1).mean())
    silhouette = ClusteringEvaluator(featuresCol="x", predictionCol="cluster").evaluate(assigned)
    return ClusterQuality(model.getK(), float(within), float(silhouette), float(ch), db)


def knee(ks: list[int], costs: list[float]) -> int:
    """Point of a falling convex curve farthest below the line between its ends."""
    x = (np.array(ks, float) - ks[0]) / (ks[-1] - ks[0])
    y = (np.array(costs) - min(costs)) / ((max(costs) - min(costs)) or 1.0)
    return ks[int(np.argmax(1 - x - y))]


def choose_k(scaled: DataFrame, ks: range = range(2, 12), restarts: int = 20, max_iter: int = 500) -> DataFrame:
    """One row per k with its measures, the composite of the normalised ones, and flags for the picks."""
    scaled = materialise(scaled.select("x"), "scaled")
    quality = [cluster_quality(fit_kmeans(scaled, k, restarts, max_iter), scaled) for k in ks]
    top = {m: max(getattr(q, m) for q in quality) for m in ("silhouette", "calinski_harabasz", "davies_bouldin")}
    composite = [
        (
            q.silhouette / top["silhouette"]
            + q.calinski_harabasz / top["calinski_harabasz"]
            + 1
            - q.davies_bouldin / top["davies_bouldin"]
        )
        / 3
        for q in quality
    ]
    elbow = knee([q.k for q in quality], [q.inertia for q in quality])
    best_sil = max(quality, key=lambda q: q.silhouette).k
    best = quality[int(np.argmax(composite))].k
    rows = [
        (q.k, q.inertia, q.silhouette, q.calinski_harabasz, q.davies_bouldin, c, q.k == elbow, q.k == best_sil, q.k == best)
        for q, c in zip(quality, composite)
    ]
    return scaled.sparkSession.createDataFrame(
        rows,
        "k int, inertia double, silhouette double, calinski_harabasz double, davies_bouldin double, composite double,"
        " is_elbow boolean, is_best_silhouette boolean, is_recommended boolean",
    )


def label_clusters(assigned: DataFrame) -> DataFrame:
    """Business label per cluster by falling mean composite; clusters beyond the label list stay unlabelled."""
    means = assigned.groupBy("cluster").agg(F.avg("RFM_composite").alias("_m"))  # k rows
    position = F.row_number().over(Window.orderBy(F.desc("_m"), "cluster"))
    names = F.array(*[F.lit(x) for x in LABELS])
    labels = means.select("cluster", F.try_element_at(names, position).alias("segment"))
    return assigned.drop("segment").join(F.broadcast(labels), "cluster")


def cluster_profiles(labelled: DataFrame) -> DataFrame:
    """Means, medians, deviations and shares per cluster. Medians are exact and not gathered per cluster."""
    base = labelled.groupBy("cluster", "segment").agg(
        F.count("customer_id").alias("n_customers"),
        *[exact_avg(c).alias(f"{c}_mean") for c in ("recency", "frequency", "monetary", "avg_order_value")],
        F.avg("RFM_composite").alias("RFM_composite_mean"),
        *[F.stddev(c).alias(f"{c}_std") for c in ("recency", "frequency", "avg_order_value")],
        exact_sum("monetary").alias("monetary_sum"),
    )
    for c in ("recency", "frequency", "monetary"):
        medians = grouped_percentiles(labelled.select("cluster", c), ["cluster"], c, {f"{c}_median": 0.5})
        base = base.join(medians, "cluster", "left")
    everything = Window.partitionBy()
    return base.withColumns(
        {
            "pct_customers": F.col("n_customers") / F.sum("n_customers").over(everything) * 100,
            "pct_revenue": F.col("monetary_sum") / F.sum("monetary_sum").over(everything) * 100,
        }
    )


def project_2d(scaled: DataFrame, keep: list[str]) -> tuple[DataFrame, list[float]]:
    """First two principal components per row and their shares of variance."""
    model = PCA(k=2, inputCol="x", outputCol="_pc").fit(scaled)
    pc = vector_to_array("_pc")
    points = model.transform(scaled).select(*keep, pc[0].alias("pc1"), pc[1].alias("pc2"))
    return points, [float(v) for v in model.explainedVariance]
