"""Embeddings: centroids, distances, anchors, k-means."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType
from pyspark.sql.window import Window

BOOST = r"exclusive|scoop|breaking|단독"


def centroids(rows: DataFrame, key: str, vector: str = "embedding", weight: str | None = None) -> DataFrame:
    """``key, centroid``: weighted mean by dimension; NULL vectors and non-positive total weights give none."""
    w = F.col(weight) if weight else F.lit(1.0)
    dims = rows.where(F.col(vector).isNotNull()).select(key, w.cast("double").alias("w"), F.posexplode(vector).alias("d", "v"))
    means = dims.groupBy(key, "d").agg(F.try_divide(F.sum(F.col("v") * F.col("w")), F.sum("w")).alias("m"))
    return means.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "m"))), lambda x: x["m"]).alias("centroid"))


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    """1 - cosine; the Euclidean distance where a vector is zero."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    dot = lambda x, y: total(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")))
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    far = F.sqrt(total(F.zip_with(a, b, lambda p, q: (p.cast("double") - q.cast("double")) * (p.cast("double") - q.cast("double")))))
    return F.when(norm > 0, 1 - dot(a, b) / norm).otherwise(far)


def anchors(rows: DataFrame, key: str, id_column: str = "id", vector: str = "embedding", title: str | None = None, boost: float = 0.1) -> DataFrame:
    """``key, id, distance, n``: the row nearest to its group's centroid; titles with an exclusive mark count ``boost`` times their distance. Rows without a key have no group."""
    grouped = rows.where(F.col(key).isNotNull())
    distance = cosine_distance(vector, "centroid")
    if title:
        distance = F.when(F.lower(title).rlike(BOOST), distance * boost).otherwise(distance)
    placed = grouped.join(centroids(grouped, key, vector), key, "left").withColumn("distance", distance)
    best = F.min_by(F.struct(F.col(id_column).alias("id"), "distance"), F.struct(F.coalesce("distance", F.lit(float("inf"))), id_column))
    return placed.groupBy(key).agg(best.alias("b"), F.count("*").alias("n")).select(key, "b.id", "b.distance", "n")


def kmeans(rows: DataFrame, k: int | None = None, seed: int = 42, vector: str = "embedding") -> DataFrame:
    """``rows`` with ``cluster``. Without ``k``: 3 below 20 rows, else 5."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    good = rows.where(F.col(vector).isNotNull()).withColumn("_v", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))
    n = good.count()
    k = min(k or (3 if n < 20 else 5), n)
    if k < 2:
        return rows.where(F.col(vector).isNotNull()).withColumn("cluster", F.lit(0))
    return KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="cluster").fit(good).transform(good).drop("_v")


def top_members(rows: DataFrame, key: str, order: list, most: int) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("pick_number", F.row_number().over(w)).where(F.col("pick_number") <= most)


@F.pandas_udf(ArrayType(FloatType()))
def unpack_floats(packed: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Little-endian float32 bytes to an array."""
    for s in packed:
        yield s.map(lambda b: np.frombuffer(b, "<f4") if b is not None and len(b) % 4 == 0 else None)
