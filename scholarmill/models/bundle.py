"""A scoring model: the fitted features, the pipeline and the few numbers scoring needs."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmill.models.assemble import FittedFeatures, metadata_medians
from scholarmill.models.regress import Fitted
from scholarmill.operators.score import Z95
from scholarmill.operators.tfidf import Vocabulary

_SETTINGS = ("categories array<string>, keywords array<string>, terms array<string>, tf array<bigint>, "
             "df array<bigint>, n_documents bigint, stop_words array<string>, medians map<string,double>, "
             "sigma double, y_mean double, y_std double")


@dataclass(frozen=True)
class ScoringModel:
    features: FittedFeatures
    pipeline: PipelineModel
    medians: dict[str, float]
    sigma: float
    y_mean: float
    y_std: float

    def predict(self, papers: DataFrame, keep: list[str]) -> DataFrame:
        """Adds ``pred`` to the kept columns.  Narrow throughout, so it also runs on a stream."""
        prepared = self.features.prepare(papers, keep, self.medians)
        return self.pipeline.transform(prepared).select(*keep, "pred")

    def predict_upload(self, upload: DataFrame, keep: list[str]) -> DataFrame:
        """Scores title and abstract alone: missing metadata takes the training medians."""
        blank = {c: F.lit(None).cast(t) for c, t in
                 (("authors", "string"), ("category", "string"), ("submitted", "date")) if c not in upload.columns}
        return self.predict(upload.withColumns(blank) if blank else upload, keep)

    def with_bounds(self, predictions: DataFrame) -> DataFrame:
        """Raw prediction and 95 % bounds from the residual deviation."""
        half = Z95 * self.sigma
        return predictions.withColumns({"predicted_citations": F.expm1("pred"),
                                        "ci_lower": F.expm1(F.col("pred") - half),
                                        "ci_upper": F.expm1(F.col("pred") + half)})

    def save(self, path: str, spark: SparkSession) -> None:
        self.pipeline.write().overwrite().save(f"{path}/stages")
        v = asdict(self.features.vocabulary)
        row = (list(self.features.categories), list(self.features.keywords), list(v["terms"]), list(v["tf"]),
               list(v["df"]), v["n_documents"], list(v["stop_words"]), self.medians, self.sigma, self.y_mean, self.y_std)
        spark.createDataFrame([row], _SETTINGS).write.mode("overwrite").json(f"{path}/settings")

    @staticmethod
    def load(path: str, spark: SparkSession) -> ScoringModel:
        r = spark.read.schema(_SETTINGS).json(f"{path}/settings").first()
        vocabulary = Vocabulary(tuple(r["terms"]), tuple(r["tf"]), tuple(r["df"]), r["n_documents"],
                                tuple(r["stop_words"]))
        features = FittedFeatures(tuple(r["categories"]), tuple(r["keywords"]), vocabulary)
        return ScoringModel(features, PipelineModel.load(f"{path}/stages"), dict(r["medians"]), r["sigma"],
                            r["y_mean"], r["y_std"])


def bundle(fitted: Fitted, features: FittedFeatures, papers: DataFrame, table: DataFrame) -> ScoringModel:
    """Joins the feature stages and the fitted model into one pipeline."""
    stats = fitted.score(table).agg(F.stddev_pop(F.col("y") - F.col("pred")).alias("sigma"),
                                    F.avg("y").alias("m"), F.stddev_pop("y").alias("s")).first()
    return ScoringModel(features, PipelineModel([*features.stages(), *fitted.model.stages]),
                        metadata_medians(papers, features), stats["sigma"], stats["m"], stats["s"])
