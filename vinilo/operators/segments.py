"""Customer segments: standardise the features, KMeans, profile the clusters."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed parameters of the fits.
SEED = 42
FINAL_ITERATIONS = 100
DEFAULT_K = 5
K_RANGE = range(2, 11)
FITS_AT_ONCE = 4
MAX_LABELS = 10_000

CUSTOMER_COLUMNS = (
    "CustomerId",
    "FirstName",
    "LastName",
    "Country",
    "total_purchases",
    "total_spent",
)


@dataclass(frozen=True)
class KScore:
    """Quality of a clustering; no silhouette where only one cluster came out.

    ``asked`` is the number of clusters asked for, ``k`` the one used: less where
    there are fewer distinct points.
    """

    k: int
    silhouette: float | None
    cost: float
    asked: int | None = None


def assemble(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(
        inputCols=list(columns), outputCol="raw_features", handleInvalid="error"
    ).transform(features)


def scale(
    features: DataFrame, columns: Sequence[str]
) -> tuple[DataFrame, StandardScalerModel]:
    """Adds ``features``: each column less its mean, over its sample deviation."""
    assembled = assemble(features, columns)
    model = StandardScaler(
        inputCol="raw_features", outputCol="features", withMean=True, withStd=True
    ).fit(assembled)
    return model.transform(assembled), model


def scaled_columns(scaled: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The scaled vector as one column per feature."""
    values = vector_to_array("features")
    return scaled.select(
        "CustomerId", *[values[i].alias(name) for i, name in enumerate(columns)]
    )


def distinct_points(scaled: DataFrame, enough: int) -> int:
    """Number of distinct points, or some number of at least ``enough``.

    A count over a few hash buckets can only be too low and needs next to no
    shuffle; the exact count runs where that leaves a doubt.
    """
    point = F.transform(vector_to_array("features"), lambda x: x + F.lit(0.0))
    bucket = F.pmod(F.xxhash64(point), F.lit(64 * enough))
    at_least = scaled.agg(F.count_distinct(bucket)).first()[0]
    if at_least >= enough:
        return at_least
    return scaled.select(point.alias("point")).distinct().count()


def clamp_k(scaled: DataFrame, k: int) -> int:
    """``k``, or the number of distinct points where there are fewer."""
    points = distinct_points(scaled, max(k, 2))
    if points < 2 or k < 2:
        raise ValueError(f"k={k} needs at least 2 clusters and 2 distinct points, have {points}")
    return min(k, points)


def _silhouette(predictions: DataFrame, clusters: int) -> float | None:
    """Of a single clustering, by Spark's evaluator."""
    if clusters < 2:
        return None
    return ClusteringEvaluator(
        predictionCol="cluster",
        featuresCol="features",
        metricName="silhouette",
        distanceMeasure="squaredEuclidean",
    ).evaluate(predictions)


def silhouettes(labelled: DataFrame, group: str, label: str) -> DataFrame:
    """(group, label, n, silhouette): mean silhouette by squared distance of each label's points.

    ``labelled`` has a row per point and group, such as the clusterings of several k,
    with the point in ``features``; points without a label are left out. The mean
    squared distance of x to a label of n points with sum S and squared norms Q is
    |x|^2 + Q / n - 2 x S / n, so a pass sums up each label and another rates the
    points against these sums. A point alone under its label rates 0; where a group
    has a single label, the silhouette is NULL. Each point meets all labels of its
    group, of which there may be ``MAX_LABELS`` in all; more are an error.
    """
    spark = labelled.sparkSession
    points = labelled.filter(F.col(group).isNotNull() & F.col(label).isNotNull()).select(
        group, label, "features", vector_to_array("features").alias("_x")
    )
    points = points.withColumn("_norm", _dot(F.col("_x"), F.col("_x")))
    sums = points.groupBy(group, label).agg(
        F.count(F.lit(1)).alias("_n"),
        vector_to_array(Summarizer.sum(F.col("features"))).alias("_sums"),
        F.sum("_norm").alias("_norms"),
    )
    found = sums.limit(MAX_LABELS + 1).collect()
    if len(found) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    labels = (
        spark.createDataFrame(found, sums.schema)
        .groupBy(group)
        .agg(
            F.collect_list(
                F.struct(F.col(label).alias("_label"), "_n", "_sums", "_norms")
            ).alias("_labels")
        )
    )

    # Written out term by term, since nested lambdas cost several times as much.
    width = max((len(f["_sums"]) for f in found), default=0)

    def distance(other: Column) -> Column:
        """Mean squared distance to the points of a label."""
        n, dot = other["_n"], F.lit(0.0)
        for i in range(width):
            dot = dot + F.get("_x", F.lit(i)) * F.get(other["_sums"], F.lit(i))
        mean = F.col("_norm") + other["_norms"] / n - 2 * dot / n
        return F.greatest(mean, F.lit(0.0))

    apart = F.transform(
        "_labels",
        lambda o: F.struct(o["_label"].alias("label"), o["_n"].alias("n"), distance(o).alias("d")),
    )
    own = F.get(F.filter("_apart", lambda o: o["label"] == F.col(label)), F.lit(0))
    others = F.filter("_apart", lambda o: o["label"] != F.col(label))
    # The point itself is among its label's points, at distance 0.
    inside = own["d"] * own["n"] / F.nullif(own["n"] - 1, F.lit(0))
    outside = F.array_min(F.transform(others, lambda o: o["d"]))
    worse = F.greatest("_inside", "_outside")
    rating = (
        F.when(F.col("_outside").isNull(), None)
        .when(F.col("_inside").isNull() | (worse == 0), 0.0)
        .otherwise((F.col("_outside") - F.col("_inside")) / F.nullif(worse, F.lit(0.0)))
    )
    return (
        points.join(F.broadcast(labels), group)
        .select(group, label, apart.alias("_apart"))
        .select(group, label, inside.alias("_inside"), outside.alias("_outside"))
        .groupBy(group, label)
        .agg(F.count(F.lit(1)).alias("n"), F.avg(rating).alias("silhouette"))
    )


def _dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)


def _rated(scaled: DataFrame, models: Sequence[KMeansModel]) -> dict[int, float | None]:
    """Silhouette of each model by its place in the list, all in the same passes."""
    labelled = scaled.select("features")
    for i, model in enumerate(models):
        labelled = model.transform(labelled, {model.predictionCol: f"_c{i}"})
    each = [F.struct(F.lit(i).alias("i"), F.col(f"_c{i}").alias("cluster")) for i in range(len(models))]
    rows = labelled.select("features", F.inline(F.array(*each)))
    weighed = silhouettes(rows, "i", "cluster").groupBy("i").agg(
        (F.sum(F.col("silhouette") * F.col("n")) / F.sum("n")).alias("silhouette")
    )
    return {r["i"]: r["silhouette"] for r in weighed.collect()}


def _model(scaled: DataFrame, k: int, **params) -> KMeansModel:
    return KMeans(
        k=k, seed=SEED, featuresCol="features", predictionCol="cluster", **params
    ).fit(scaled)


def sweep_models(
    scaled: DataFrame, ks: Iterable[int] = K_RANGE, at_once: int = FITS_AT_ONCE
) -> list[tuple[KMeansModel, KScore]]:
    """Model, silhouette and cost for each ``k`` that has enough distinct points.

    A warning names the others. ``scaled`` is read many times: pass a checkpointed
    frame. Fits of different k run side by side, since each waits for its own short
    jobs; all of them are then rated in the same two passes.
    """
    ks = sorted(ks)
    most = clamp_k(scaled, ks[-1])
    used = [k for k in ks if k <= most]
    if used != ks:
        warnings.warn(f"no fit for k in {ks[len(used):]}: {most} distinct points", stacklevel=2)
    if not used:
        return []
    # Each fit takes a copy of the caller's job properties with it.
    session = scaled.sparkSession
    fits = [inheritable_thread_target(session)(partial(_model, scaled, k)) for k in used]
    with ThreadPool(min(at_once, len(used))) as pool:
        models = pool.map(lambda fit: fit(), fits, chunksize=1)
    ratings = _rated(scaled, models)
    return [
        (m, KScore(k, ratings[i], m.summary.trainingCost, k))
        for i, (k, m) in enumerate(zip(used, models, strict=True))
    ]


def sweep_k(scaled: DataFrame, ks: Iterable[int] = K_RANGE) -> list[KScore]:
    """The scores of ``sweep_models``."""
    return [score for _, score in sweep_models(scaled, ks)]


def best_k(scores: Iterable[KScore]) -> int:
    """The ``k`` with the highest silhouette, the smaller one on a tie."""
    rated = [s for s in scores if s.silhouette is not None]
    if not rated:
        raise ValueError("no k gave more than one cluster")
    return max(rated, key=lambda s: (s.silhouette, -s.k)).k


def train_kmeans(
    scaled: DataFrame, k: int = DEFAULT_K
) -> tuple[KMeansModel, DataFrame, KScore]:
    """Final model, the rows with their ``cluster``, and the quality reached."""
    used = clamp_k(scaled, k)
    if used < k:
        warnings.warn(f"k={k} lowered to the {used} distinct points", stacklevel=2)
    model = _model(scaled, used, maxIter=FINAL_ITERATIONS)
    predictions = model.transform(scaled)
    silhouette = _silhouette(predictions, len(model.clusterCenters()))
    return model, predictions, KScore(used, silhouette, model.summary.trainingCost, k)


def cluster_profile(predictions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Size of each cluster with mean and sample deviation of every feature."""
    measures = [F.count(F.lit(1)).alias("customer_count")]
    for column in columns:
        measures += [
            F.avg(F.col(column).cast("double")).alias(f"{column}_mean"),
            F.stddev_samp(F.col(column).cast("double")).alias(f"{column}_std"),
        ]
    return predictions.groupBy("cluster").agg(*measures)


def cluster_examples(predictions: DataFrame, per_cluster: int = 5) -> DataFrame:
    """The customers with the lowest ids of each cluster."""
    in_cluster = Window.partitionBy("cluster").orderBy("CustomerId")
    return (
        predictions.select("cluster", *CUSTOMER_COLUMNS)
        .withColumn("rk", F.row_number().over(in_cluster))
        .filter(F.col("rk") <= per_cluster)
    )


def _center_distances(
    centers: Sequence[Sequence[float]], cluster: str
) -> tuple[Column, Column]:
    """Squared distances of ``features`` to the own cluster's centre and to the nearest one."""
    point = vector_to_array("features")
    distances = []
    for c in centers:
        apart = F.zip_with(point, F.array(*map(F.lit, map(float, c))), lambda x, y: x - y)
        distances.append(_dot(apart, apart))
    own = F.element_at(F.array(*distances), F.col(cluster) + 1)
    return own, F.least(*distances) if len(distances) > 1 else distances[0]


def _wrong_profiles(predictions: DataFrame, profile: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(profile): number of clusters told wrongly, or on one side only."""
    measures = []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        measures += [
            F.avg(value).alias(f"_mean_{i}"),
            F.sqrt(F.var_samp(value)).alias(f"_std_{i}"),
        ]
    again = predictions.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n"), *measures)
    differs = F.col("_n") != F.col("customer_count")
    for i, c in enumerate(columns):
        for kind in ("mean", "std"):
            value, told = F.col(f"_{kind}_{i}"), F.col(f"{c}_{kind}")
            # Sums of other orders differ by a share of large values; two nulls do not differ.
            apart = F.abs(value - told) > 1e-6 + 1e-9 * F.abs(value)
            differs = differs | F.coalesce(apart, ~value.eqNullSafe(told))
    return profile.join(again, "cluster", "full").agg(
        F.count_if(F.coalesce(differs, F.lit(True))).alias("profile")
    )


def sweep_checks(
    scaled: DataFrame, rated: Sequence[tuple[KMeansModel, KScore]]
) -> DataFrame:
    """(asked, k, customers, far, cheap, unrated): what must hold of each fit of a sweep.

    far: customers nearer to another centre than to their own. cheap: whether the cost
    told is below that of the centres. unrated: whether the silhouette is missing or
    out of its bounds. All fits are looked at in one pass over all customers.
    """
    labelled, measures = scaled.select("features"), [F.count(F.lit(1)).alias("n")]
    for i, (model, _) in enumerate(rated):
        labelled = model.transform(labelled, {model.predictionCol: f"_c{i}"})
        own, least = _center_distances(model.clusterCenters(), f"_c{i}")
        measures += [
            F.count_if(own > least + 1e-9).alias(f"far_{i}"),
            F.coalesce(F.sum(least), F.lit(0.0)).alias(f"cost_{i}"),
        ]
    told = labelled.agg(*measures).first()
    rows = []
    for i, (_, score) in enumerate(rated):
        cheap = score.cost < told[f"cost_{i}"] * (1 - 1e-9) - 1e-9
        unrated = score.silhouette is None or not -1 <= score.silhouette <= 1
        rows.append((score.asked, score.k, told["n"], told[f"far_{i}"], cheap, unrated))
    return scaled.sparkSession.createDataFrame(
        rows, "asked int, k int, customers long, far long, cheap boolean, unrated boolean"
    )


def saved_checks(
    features: DataFrame, columns: Sequence[str], k: int, output_path: str
) -> DataFrame:
    """(check_name, value) of results that ``save_results`` left, read back from their folder.

    customers: those saved. clusters: by how many their number differs from ``k``.
    profile: clusters whose saved statistics are not those of their customers. moved:
    customers whom the saved models, applied to the features, give another cluster.
    missing: customers with features that were not saved, or the reverse.
    """
    spark = features.sparkSession
    saved = spark.read.parquet(f"{output_path}/customer_clusters").select("CustomerId", "cluster")
    profile = spark.read.parquet(f"{output_path}/cluster_statistics")
    scaler = StandardScalerModel.load(f"{output_path}/scaler_model")
    model = KMeansModel.load(f"{output_path}/kmeans_model")
    again = model.transform(
        scaler.transform(assemble(features, columns)), {model.predictionCol: "_again"}
    )
    both = again.join(saved, "CustomerId", "full")
    totals = both.agg(
        F.count("cluster").alias("customers"),
        F.abs(F.count_distinct("cluster") - k).alias("clusters"),
        F.count_if(F.col("cluster") != F.col("_again")).alias("moved"),
        F.count_if(F.col("cluster").isNull() | F.col("_again").isNull()).alias("missing"),
    )
    known = both.filter(F.col("cluster").isNotNull())
    names = ("customers", "clusters", "profile", "moved", "missing")
    return totals.join(_wrong_profiles(known, profile, columns)).select(
        F.explode(
            F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*names))
        ).alias("check_name", "value")
    )


def segmentation_checks(
    predictions: DataFrame,
    profile: DataFrame,
    centers: Sequence[Sequence[float]],
    columns: Sequence[str],
) -> DataFrame:
    """(check_name, value): customers, and counts of what must not happen in a clustering.

    far: customers nearer to another centre than to their own. profile: clusters
    whose size, means or deviations differ from those of their customers. examples: customers
    among the five lowest ids of their cluster without being an example, or the
    reverse. Computed over all customers; only the centres travel.
    """
    own, least = _center_distances(centers, "cluster")
    totals = predictions.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(own > least + 1e-9).alias("far"),
    )
    wrong = _wrong_profiles(predictions, profile, columns)
    examples = cluster_examples(predictions)
    others = predictions.join(examples.select("CustomerId"), "CustomerId", "left_anti")
    lowest = others.groupBy("cluster").agg(F.min("CustomerId").alias("_lowest"))
    misplaced = examples.join(lowest, "cluster").agg(
        F.count_if(F.col("CustomerId") > F.col("_lowest")).alias("examples")
    )
    return totals.join(wrong).join(misplaced).select(
        F.explode(
            F.map_from_arrays(
                F.array(*[F.lit(n) for n in ("customers", "far", "profile", "examples")]),
                F.array("customers", "far", "profile", "examples"),
            )
        ).alias("check_name", "value")
    )


def save_results(
    predictions: DataFrame,
    profile: DataFrame,
    model: KMeansModel,
    scaler: StandardScalerModel,
    output_path: str,
) -> None:
    predictions.select(*CUSTOMER_COLUMNS, "cluster").write.mode("overwrite").parquet(
        f"{output_path}/customer_clusters"
    )
    profile.write.mode("overwrite").parquet(f"{output_path}/cluster_statistics")
    model.write().overwrite().save(f"{output_path}/kmeans_model")
    scaler.write().overwrite().save(f"{output_path}/scaler_model")
