import math
import statistics

import numpy as np
import pytest
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScalerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from vinilo.operators import segments
from vinilo.plans.segmentation_job import (
    arguments,
    load_tables,
    main,
    run_segmentation,
    segment_features,
)
from vinilo.sources.lake import write_snapshot
from vinilo.sources.layout import LakeLayout

COLUMNS = ["total_purchases", "total_spent", "flat"]


@pytest.fixture(scope="module")
def features(spark):
    """Three well separated groups of customers; one column never varies."""
    rows = [
        (i, "f", "l", "c", 10 * (i % 3) + (i % 5) / 10, 100.0 * (i % 3) + i % 7, 1.0)
        for i in range(60)
    ]
    return spark.createDataFrame(
        rows,
        "CustomerId int, FirstName string, LastName string, Country string, "
        "total_purchases double, total_spent double, flat double",
    )


@pytest.fixture(scope="module")
def scaled(features):
    return segments.scale(features, COLUMNS)[0]


def points(df, *others):
    rows = df.select(vector_to_array("features").alias("x"), *others).collect()
    return np.array([r["x"] for r in rows]), rows


def silhouette_by_hand(x, labels):
    scores = []
    for i, label in enumerate(labels):
        distance = ((x - x[i]) ** 2).sum(axis=1)
        own = labels == label
        if own.sum() == 1:
            scores.append(0.0)
            continue
        inside = distance[own].sum() / (own.sum() - 1)
        outside = min(distance[labels == o].mean() for o in set(labels) - {label})
        scores.append((outside - inside) / max(inside, outside))
    return float(np.mean(scores))


def test_scaling(features, scaled):
    values = segments.scaled_columns(scaled, COLUMNS).orderBy("CustomerId").collect()
    source = [r["total_spent"] for r in features.orderBy("CustomerId").collect()]
    mean, deviation = statistics.mean(source), statistics.stdev(source)
    assert [r["total_spent"] for r in values] == pytest.approx(
        [(v - mean) / deviation for v in source]
    )
    assert {r["flat"] for r in values} == {0.0}


def test_missing_feature_is_an_error(features):
    broken = features.withColumn("flat", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="null"):
        segments.scale(broken, COLUMNS)[0].collect()


def test_sweep_finds_the_groups(scaled):
    scores = segments.sweep_k(scaled, range(2, 5))
    assert [s.k for s in scores] == [2, 3, 4]
    assert segments.best_k(scores) == 3
    assert scores[0].cost > scores[1].cost


def test_sweep_rates_like_the_evaluator_and_one_at_a_time(scaled):
    """All k in the same passes, side by side or in turn, against Spark's evaluator."""
    rated = segments.sweep_models(scaled, range(2, 6))
    for model, score in rated:
        evaluator = ClusteringEvaluator(predictionCol="cluster", featuresCol="features")
        assert score.silhouette == pytest.approx(evaluator.evaluate(model.transform(scaled)), abs=1e-9)
        assert score.asked == score.k == len(model.clusterCenters())
    alone = segments.sweep_models(scaled, range(2, 6), at_once=1)
    for (_, one), (_, other) in zip(alone, rated, strict=True):
        assert (one.k, one.asked) == (other.k, other.asked)
        assert (one.silhouette, one.cost) == pytest.approx((other.silhouette, other.cost))


def test_silhouettes_of_labels_against_counting_by_hand(scaled):
    """Two labellings at once: one with a label of a single point, one with one label."""
    single = F.when(F.col("CustomerId") == 7, "alone").otherwise(
        F.concat(F.lit("c"), F.col("CustomerId") % 4)
    )
    groups = scaled.withColumn("g", F.lit("many")).withColumn("label", single)
    one = scaled.withColumn("g", F.lit("one")).withColumn("label", F.lit("same"))
    none = scaled.limit(3).withColumn("g", F.lit("many")).withColumn("label", F.lit(None).cast("string"))
    rows = segments.silhouettes(groups.union(one).union(none), "g", "label").collect()
    found = {(r["g"], r["label"]): r for r in rows}
    assert found["one", "same"]["silhouette"] is None and found["one", "same"]["n"] == 60
    x, with_labels = points(groups, "label")
    labels = np.array([r["label"] for r in with_labels])
    assert found["many", "alone"]["silhouette"] == 0.0
    mean = sum(r["n"] * r["silhouette"] for (g, _), r in found.items() if g == "many") / 60
    assert mean == pytest.approx(silhouette_by_hand(x, labels))
    assert len(found) == 6


def test_too_many_labels_are_an_error(scaled, monkeypatch):
    monkeypatch.setattr(segments, "MAX_LABELS", 59)
    each = scaled.withColumn("g", F.lit(1))
    with pytest.raises(ValueError, match="labels"):
        segments.silhouettes(each, "g", "CustomerId")


def test_smaller_k_wins_a_tie():
    tie = [segments.KScore(4, 0.5, 1.0), segments.KScore(3, 0.5, 2.0)]
    assert segments.best_k(tie) == 3


def test_clusters_against_counting_by_hand(scaled):
    model, predictions, quality = segments.train_kmeans(scaled, 3)
    x, rows = points(predictions, "cluster")
    labels = np.array([r["cluster"] for r in rows])
    centres = np.array(model.clusterCenters())
    distance = ((x[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    assert (labels == distance.argmin(axis=1)).all()
    assert quality.cost == pytest.approx(distance.min(axis=1).sum())
    assert quality.silhouette == pytest.approx(silhouette_by_hand(x, labels))
    for label in range(3):
        assert centres[label] == pytest.approx(x[labels == label].mean(axis=0))


def test_profile_and_examples(scaled):
    predictions = segments.train_kmeans(scaled, 3)[1]
    rows = predictions.collect()
    profile = {r["cluster"]: r for r in segments.cluster_profile(predictions, COLUMNS).collect()}
    examples = segments.cluster_examples(predictions).collect()
    assert sum(r["customer_count"] for r in profile.values()) == 60
    for cluster, row in profile.items():
        spent = [r["total_spent"] for r in rows if r["cluster"] == cluster]
        assert row["total_spent_mean"] == pytest.approx(statistics.mean(spent))
        assert row["total_spent_std"] == pytest.approx(statistics.stdev(spent))
        ids = sorted(r["CustomerId"] for r in rows if r["cluster"] == cluster)
        assert [r["CustomerId"] for r in examples if r["cluster"] == cluster] == ids[:5]


def test_checks_compare_the_means_of_all_columns(scaled):
    model, predictions, _ = segments.train_kmeans(scaled, 3)
    profile = segments.cluster_profile(predictions, COLUMNS)
    centers = [c.tolist() for c in model.clusterCenters()]

    def wrong(told):
        rows = segments.segmentation_checks(predictions, told, centers, COLUMNS).collect()
        return {r["check_name"]: r["value"] for r in rows}["profile"]

    assert wrong(profile) == 0
    for column in [f"{c}_{kind}" for c in COLUMNS for kind in ("mean", "std")]:
        value = F.col(column)
        off = F.when(F.col("cluster") == 1, value + 0.01).otherwise(value)
        assert wrong(profile.withColumn(column, off)) == 1


def test_checks_of_a_sweep_see_wrong_scores(scaled):
    rated = segments.sweep_models(scaled, range(2, 4))
    (first, score), (second, other) = rated
    good = segments.sweep_checks(scaled, rated).collect()
    assert [tuple(r) for r in good] == [(2, 2, 60, 0, False, False), (3, 3, 60, 0, False, False)]
    cheap = segments.KScore(2, None, score.cost / 2, 2)
    bad = segments.sweep_checks(scaled, [(first, cheap), (second, other)]).collect()
    assert [(r["cheap"], r["unrated"]) for r in bad] == [(True, True), (False, False)]


def test_checks_of_saved_results_see_changes(spark, features, tmp_path):
    result = segment_features(features, COLUMNS, k=3, output_path=str(tmp_path))

    def checks(k=3, rows=features):
        found = segments.saved_checks(rows, COLUMNS, k, str(tmp_path)).collect()
        return [r["value"] for r in sorted(found, key=lambda r: r["check_name"])]

    # clusters, customers, missing, moved, profile
    assert checks() == [0, 60, 0, 0, 0]
    assert checks(k=5)[0] == 2
    assert checks(rows=features.filter("CustomerId <> 1"))[2] == 1
    moved = result.predictions.withColumn(
        "cluster", F.when(F.col("CustomerId") == 4, (F.col("cluster") + 1) % 3).otherwise(F.col("cluster"))
    )
    moved.select(*segments.CUSTOMER_COLUMNS, "cluster").write.mode("overwrite").parquet(
        f"{tmp_path}/customer_clusters"
    )
    assert checks() == [0, 60, 0, 1, 2]


def test_cluster_of_one_has_no_deviation(scaled, spark):
    one = scaled.limit(1).withColumn("cluster", F.lit(0))
    row = segments.cluster_profile(one, COLUMNS).first()
    assert row["total_spent_std"] is None


def test_examples_are_cut_before_the_shuffle(scaled):
    predictions = scaled.withColumn("cluster", F.col("CustomerId") % 3)
    plan = segments.cluster_examples(predictions)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_k_is_bounded_by_distinct_points(spark):
    rows = [(i, float(i % 3), float(i % 3), 0.0) for i in range(30)]
    few = spark.createDataFrame(rows, "CustomerId int, total_purchases double, total_spent double, flat double")
    scaled = segments.scale(few, COLUMNS)[0]
    assert segments.distinct_points(scaled, 5) == 3
    with pytest.warns(UserWarning, match="k=5 lowered to the 3 distinct points"):
        score = segments.train_kmeans(scaled, 5)[2]
    assert (score.k, score.asked) == (3, 5)
    with pytest.warns(UserWarning, match=r"no fit for k in \[4, 5\]: 3 distinct points"):
        assert [s.k for s in segments.sweep_k(scaled, range(2, 6))] == [2, 3]


def test_one_point_is_too_few(spark):
    rows = [(i, 1.0, 1.0, 0.0) for i in range(3)]
    same = spark.createDataFrame(rows, "CustomerId int, total_purchases double, total_spent double, flat double")
    with pytest.raises(ValueError, match="distinct points"):
        segments.train_kmeans(segments.scale(same, COLUMNS)[0], 3)


def test_saved_results_and_models(spark, features, tmp_path):
    result = segment_features(features, COLUMNS, ks=range(2, 5), output_path=str(tmp_path))
    assert result.k == 3
    assert [s.k for s in result.sweep] == [2, 3, 4]
    saved = spark.read.parquet(f"{tmp_path}/customer_clusters")
    assert saved.columns == [*segments.CUSTOMER_COLUMNS, "cluster"]
    profile = spark.read.parquet(f"{tmp_path}/cluster_statistics")
    assert len(profile.columns) == 2 + 2 * len(COLUMNS)
    counts = {r["cluster"]: r["count"] for r in saved.groupBy("cluster").count().collect()}
    assert counts == {r["cluster"]: r["customer_count"] for r in profile.collect()}

    scaler = StandardScalerModel.load(f"{tmp_path}/scaler_model")
    model = KMeansModel.load(f"{tmp_path}/kmeans_model")
    again = model.transform(scaler.transform(segments.assemble(features, COLUMNS)))
    assert {(r["CustomerId"], r["cluster"]) for r in again.collect()} == {
        (r["CustomerId"], r["cluster"]) for r in saved.collect()
    }


def test_default_k(features):
    assert segment_features(features, COLUMNS, find_optimal=False).k == segments.DEFAULT_K


@pytest.fixture
def lake_layout(spark, tmp_path):
    layout = LakeLayout(str(tmp_path))
    tables = {
        "Customer": spark.range(1, 13).select(
            F.col("id").alias("CustomerId"),
            F.lit("f").alias("FirstName"),
            F.lit("l").alias("LastName"),
            F.lit("c").alias("Country"),
        ),
        "Invoice": spark.range(1, 37).select(
            F.col("id").alias("InvoiceId"), (F.col("id") % 12 + 1).alias("CustomerId")
        ),
        "InvoiceLine": spark.range(1, 145).select(
            F.col("id").alias("InvoiceLineId"),
            (F.col("id") % 36 + 1).alias("InvoiceId"),
            (F.col("id") % 10).alias("TrackId"),
            (F.col("id") % 7 / 10).cast("decimal(10,2)").alias("UnitPrice"),
        ),
        "Track": spark.range(0, 10).select(
            F.col("id").alias("TrackId"),
            (F.col("id") % 3).alias("GenreId"),
            (F.col("id") * 1000).alias("Milliseconds"),
        ),
        "Genre": spark.createDataFrame(
            [(0, "Rock"), (1, "Jazz"), (2, "Folk")], "GenreId long, Name string"
        ),
    }
    for name, table in tables.items():
        write_snapshot(table, layout.raw(name), "20240101_000000")
    return layout


def test_whole_run_from_the_lake(spark, lake_layout):
    result = run_segmentation(load_tables(spark, "s3", lake_layout), k=3)
    assert result.predictions.count() == 12
    assert len(result.profile.columns) == 26
    clusters = {r["cluster"] for r in result.predictions.collect()}
    assert clusters <= {0, 1, 2}
    assert not math.isnan(result.quality.silhouette)


def test_main(spark, lake_layout, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    monkeypatch.setattr(LakeLayout, "from_bucket", lambda bucket: lake_layout)
    output = str(tmp_path / "out")
    main(["--s3-bucket", "any", "--k", "2", "--output-path", output])
    assert "k=2" in capsys.readouterr().out
    assert spark.read.parquet(f"{output}/customer_clusters").count() == 12


def test_unknown_source(spark):
    with pytest.raises(ValueError, match="unknown data source"):
        load_tables(spark, "ftp")


def test_command_line():
    args = arguments(["--s3-bucket", "b", "--k", "4", "--no-optimize"])
    assert (args.data_source, args.s3_bucket, args.k, args.no_optimize) == ("s3", "b", 4, True)
    with pytest.raises(SystemExit):
        arguments([])
    with pytest.raises(SystemExit):
        arguments(["--data-source", "mysql", "--jdbc-url", "u"])
    assert arguments(
        ["--data-source", "mysql", "--jdbc-url", "u", "--db-user", "a", "--db-password", "p"]
    ).jdbc_url


def test_ratings_compare_without_nested_lambdas(spark):
    """Only the norm of a point folds over it; distances to labels, many per point, do not."""
    rows = [(1, i % 3, [float(i), float(i * i % 7)]) for i in range(30)]
    points = spark.createDataFrame(rows, "g int, c int, x array<double>")
    points = points.select("g", "c", array_to_vector("x").alias("features"))
    rated = segments.silhouettes(points, "g", "c")
    plan = rated._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with(") == 1
    assert rated.count() == 3
