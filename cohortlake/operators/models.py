"""Feature vectors, the four classifiers, their comparison, scoring and importances."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake import schema
from cohortlake.operators import metrics, records, sampling
from cohortlake.session import discard, stored

WEIGHT = "class_weight"

#: Forests draw their samples by partition, so the number of partitions is part of the model. It follows
#: from the number of labelled rows alone: no partition holds more than ``ROWS_AT_MOST`` of them in
#: expectation, and up to ``SPREAD`` partitions are made as long as each has ``ROWS_AT_LEAST``. A fit has
#: hundreds of passes, and in each every partition reports to the driver and a forest's sends the
#: statistics of all open nodes, so tasks are made by rows that are worth one and not by the dozen.
ROWS_AT_MOST, ROWS_AT_LEAST, SPREAD = 1 << 20, 1 << 16, 48


def training_partitions(rows: int) -> int:
    return max(1, -(-rows // ROWS_AT_MOST), min(SPREAD, -(-rows // ROWS_AT_LEAST)))


def assemble(columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features_raw", handleInvalid="skip")


def scale_minmax() -> MinMaxScaler:
    return MinMaxScaler(inputCol="features_raw", outputCol="features")


def fit_features(train: DataFrame, columns: Sequence[str]) -> PipelineModel:
    """Assembler and scaler, the ranges taken from training rows: one aggregation for all models."""
    assembler = assemble(columns)
    scaler = scale_minmax().fit(assembler.transform(train))
    return PipelineModel(stages=[assembler, scaler])


def feature_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per feature with its smallest and largest value."""
    spread = df.agg(
        F.array(
            *(
                F.struct(
                    F.lit(name).alias("feature"),
                    F.min(F.col(name).cast("double")).alias("low"),
                    F.max(F.col(name).cast("double")).alias("high"),
                )
                for name in columns
            )
        ).alias("ranges")
    )
    return spread.select(F.inline("ranges"))


def random_forest(weight: str | None = WEIGHT, seed: int = schema.SEED) -> Estimator:
    # Trees, depth, feature choice and smallest node. More memory for split statistics
    # means fewer passes over the data per tree level.
    forest = RandomForestClassifier(
        labelCol="label",
        featuresCol="features",
        numTrees=100,
        maxDepth=10,
        featureSubsetStrategy="sqrt",
        minInstancesPerNode=5,
        seed=seed,
        maxMemoryInMB=1024,
    )
    return forest.setWeightCol(weight) if weight else forest


def logistic_regression(weight: str | None = WEIGHT) -> Estimator:
    # Iterations and family.
    regression = LogisticRegression(
        labelCol="label", featuresCol="features", maxIter=100, family="multinomial"
    )
    return regression.setWeightCol(weight) if weight else regression


def decision_tree(seed: int = schema.SEED) -> Estimator:
    # Fixed value: depth.
    return DecisionTreeClassifier(labelCol="label", featuresCol="features", maxDepth=10, seed=seed)


def gaussian_nb() -> Estimator:
    return NaiveBayes(labelCol="label", featuresCol="features", modelType="gaussian")


# Report name to estimator, in report order. Forest and regression are weighted by class.
MODELS: dict[str, Callable[[], Estimator]] = {
    "Random Forest": random_forest,
    "Logistic Regression": logistic_regression,
    "Decision Tree": decision_tree,
    "Naive Bayes": gaussian_nb,
}


@dataclass
class TrainingSet:
    """Training vectors with class weights, kept on executors, and what made them."""

    features: PipelineModel
    columns: list[str]
    train: DataFrame
    test: DataFrame
    path: str
    fit_seconds: dict[str, float] = field(default_factory=dict)

    def close(self) -> None:
        """Release the vectors and the written rows, which ``test`` reads too."""
        self.train.unpersist()
        discard(self.train.sparkSession, self.path)


def prepare_training(
    df: DataFrame,
    key: str = "event_seq",
    columns: Sequence[str] = tuple(schema.FEATURES),
    partitions: int | None = None,
) -> TrainingSet:
    """Split labelled rows by key, weight the classes and fit the feature stages once.

    The used columns are written first: ranges, weights, vectors and tests then read finished columns,
    whose derivations would otherwise be planned and computed again in each of these passes. The
    training rows are dealt by a hash of key and row into ``partitions``, by default as many as
    ``training_partitions`` makes of the labelled rows, and sorted, whatever the input's partitions are. Every tree level and gradient step reads their vectors, so these are kept
    in memory with overflow to disk.
    """
    used = records.resolve_features(df, columns)
    rows, path = stored(records.known_labels(df).select(*dict.fromkeys([key, "label", *used])), "training-rows")
    train, test = sampling.split(rows, key)
    # Weights count all training rows; the assembler then skips those with a missing feature.
    weighted = sampling.apply_weights(train, sampling.class_weights(train), name=WEIGHT)
    place = F.xxhash64(*rows.columns)
    parts = training_partitions(rows.count()) if partitions is None else partitions
    dealt = weighted.repartition(parts, F.col(key), place).sortWithinPartitions(key, place)
    features = fit_features(train, used)
    vectors = features.transform(dealt).select(key, "label", WEIGHT, "features")
    return TrainingSet(features, used, vectors.persist(StorageLevel.MEMORY_AND_DISK), test, path)


def timed_fit(estimator: Estimator, df: DataFrame) -> tuple[Model, float]:
    started = time.time()
    model = estimator.fit(df)
    return model, round(time.time() - started, 2)


def score(model: Model, features: PipelineModel, df: DataFrame, name: str = "prediction") -> DataFrame:
    """``df`` with its prediction. Rows with a missing feature are skipped by the assembler."""
    bare = model.copy().setPredictionCol(name).setRawPredictionCol("").setProbabilityCol("")
    return bare.transform(features.transform(df)).drop("features_raw", "features")


def score_all(models: dict[str, Model], features: PipelineModel, df: DataFrame) -> DataFrame:
    """One row per input row and model: all models score the same pass over the data."""
    vectors = features.transform(df)
    for position, model in enumerate(models.values()):
        bare = model.copy().setPredictionCol(f"_p{position}")
        vectors = bare.setRawPredictionCol("").setProbabilityCol("").transform(vectors)
    scored = F.array(
        *(
            F.struct(F.lit(name).alias("model"), F.col(f"_p{position}").alias("prediction"))
            for position, name in enumerate(models)
        )
    )
    return vectors.select("label", F.inline(scored))


def compare_models(
    training: TrainingSet, models: dict[str, Model], with_times: bool = False
) -> DataFrame:
    """One row of metrics per model, from one pass over the test rows and one shuffle of counts."""
    scored = score_all(models, training.features, training.test)
    table = metrics.classification_metrics(scored, by=["model"])
    if with_times:
        times = [(name, training.fit_seconds.get(name)) for name in models]
        spark = training.test.sparkSession
        seconds = spark.createDataFrame(times, "model string, training_time_s double")
        table = table.join(seconds, "model", "left")
    return table


def fit_models(training: TrainingSet, names: Sequence[str] = tuple(MODELS)) -> dict[str, Model]:
    """Fit the named classifiers one after the other on the shared vectors and note the times."""
    fitted = {}
    for name in names:
        fitted[name], training.fit_seconds[name] = timed_fit(MODELS[name](), training.train)
    return fitted


def best_model(comparison: DataFrame, by_f1: bool = False) -> str:
    """The forest, or on request the model with the highest F1."""
    if not by_f1:
        return "Random Forest"
    return comparison.orderBy(F.col("f1_score").desc(), "model").first()["model"]


def name_importances(spark: SparkSession, importances: Sequence[float], columns: Sequence[str]) -> DataFrame:
    """Feature names beside their importances: as many rows as the model has features."""
    pairs = [(name, float(value)) for name, value in zip(columns, importances, strict=True)]
    return spark.createDataFrame(pairs, "feature string, importance double")


def feature_importance(spark: SparkSession, model: Model, columns: Sequence[str]) -> DataFrame:
    return name_importances(spark, model.featureImportances.toArray(), columns)


def top_features(importances: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` most important features, rounded for the report."""
    return (
        importances.orderBy(F.col("importance").desc(), "feature")
        .limit(n)
        .withColumn("importance", F.round("importance", 4))
    )


def scaled_columns(features: PipelineModel, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The scaled vector's elements as columns again, named after their features."""
    values = features.transform(df).withColumn("_values", vector_to_array("features"))
    kept = [name for name in df.columns if name not in columns]
    return values.select(
        *kept, *(F.col("_values")[position].alias(name) for position, name in enumerate(columns))
    )
