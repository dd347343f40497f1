"""Clusters of pickup locations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.session import settle

# Features standardised before clustering.
FEATURES = ("total_trips", "avg_fare", "avg_distance", "avg_tip_percent", "avg_speed")


def location_clusters(
    profile: DataFrame, n_clusters: int = 5, seed: int = 42, features: Sequence[str] = FEATURES
) -> DataFrame:
    """``profile`` (one row per location) with a ``cluster`` label.

    Labels are numbered by cluster centre, so equal clusterings get equal
    labels. Rows with a missing feature stay, with a null label. The profile is
    stored first, as scaling and every k-means iteration read it.
    """
    profile = settle(profile, "profile")
    complete = reduce(lambda left, right: left & right, [F.col(c).isNotNull() for c in features])
    usable = VectorAssembler(inputCols=list(features), outputCol="_raw").transform(profile.where(complete))
    scaler = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True).fit(usable)
    scaled = scaler.transform(usable)
    model = KMeans(k=n_clusters, seed=seed, featuresCol="_scaled", predictionCol="_label").fit(scaled)
    order = sorted(range(len(model.clusterCenters())), key=lambda i: tuple(model.clusterCenters()[i]))
    ranks = F.array(*[F.lit(order.index(i)) for i in range(len(order))])
    labelled = (
        model.transform(scaled)
        .withColumn("cluster", F.element_at(ranks, F.col("_label") + 1))
        .drop("_raw", "_scaled", "_label")
    )
    return labelled.unionByName(profile.where(~complete), allowMissingColumns=True)
