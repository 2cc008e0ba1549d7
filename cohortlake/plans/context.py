"""Training sets and fitted models of the driver's tables, fitted once per session and scale."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession

from cohortlake.fixtures import students
from cohortlake.operators import models, records
from cohortlake.session import compiled_methods, fresh_path, scan_partitions
from cohortlake.sources import batches

_contexts: dict[tuple[str, str], "StudyContext"] = {}


class StudyContext:
    """Labelled records of one data set with the models asked for so far.

    Training reads a written table of enriched records, as it does behind an ingest: the many
    passes of the fits then read finished columns. The two columns that a record is derived from are
    dealt by the number of rows, because a large file may come in few splits.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        compiled_methods(spark)
        path = fresh_path(spark, "training-records")
        dealt = scan_partitions(spark) or models.training_partitions(students(spark, sf_dir).count())
        enriched = records.enrich(students(spark, sf_dir, partitions=dealt))
        batches.write_batches(records.project_record(enriched, ["event_seq"]), path)
        self.labelled = records.known_labels(batches.scan_parquet(spark, path))
        self._training: models.TrainingSet | None = None
        self._models: dict[str, Model] = {}

    @property
    def training(self) -> models.TrainingSet:
        if self._training is None:
            self._training = models.prepare_training(self.labelled)
        return self._training

    def model(self, name: str) -> Model:
        if name not in self._models:
            self._models |= models.fit_models(self.training, [name])
        return self._models[name]

    def models(self) -> dict[str, Model]:
        return {name: self.model(name) for name in models.MODELS}

    def scored(self, name: str, df: DataFrame | None = None) -> DataFrame:
        rows = self.labelled if df is None else df
        return models.score(self.model(name), self.training.features, rows)

    def comparison(self, *names: str) -> DataFrame:
        return models.compare_models(self.training, {name: self.model(name) for name in names})


def context(spark: SparkSession, sf_dir: str) -> StudyContext:
    """The one context of a session and data set; those of ended sessions are dropped."""
    application = spark.sparkContext.applicationId
    for ended in [key for key in _contexts if key[0] != application]:
        del _contexts[ended]
    key = (application, sf_dir)
    if key not in _contexts:
        _contexts[key] = StudyContext(spark, sf_dir)
    return _contexts[key]
