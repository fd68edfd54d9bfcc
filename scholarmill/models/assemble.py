"""From papers to one feature vector per row, the same way for training and scoring."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import ElementwiseProduct, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.functions.text import KEYWORDS
from scholarmill.operators.features import feature_columns, feature_table, impute_zero
from scholarmill.operators.quantiles import count_percentiles
from scholarmill.operators.split import with_fold, with_split
from scholarmill.operators.tfidf import Vocabulary, combined_text, fit_vocabulary
from scholarmill.session import write_once

#: Bytes of training rows that one scan task takes at the least.
ROW_GROUP = 1 << 20


@dataclass(frozen=True)
class FittedFeatures:
    """The category list, keywords and vocabulary a model was trained with."""

    categories: tuple[str, ...]
    keywords: tuple[str, ...]
    vocabulary: Vocabulary

    @property
    def base(self) -> list[str]:
        return feature_columns(self.categories, self.keywords)

    @property
    def names(self) -> list[str]:
        """Feature names in vector order."""
        return [*self.base, *(f"tfidf_{t}" for t in self.vocabulary.terms)]

    @property
    def columns(self) -> dict[str, str]:
        """Column name per base feature: a category such as ``cs.LG`` would read as a nested field."""
        return {c: f"base_{i}" for i, c in enumerate(self.base)}

    @property
    def unknown_when_uploaded(self) -> list[str]:
        """Features that title and abstract alone do not give."""
        return [c for c in self.base if c.startswith(("author_", "submission_", "cat_"))]

    def prepare(self, papers: DataFrame, keep: Sequence[str],
                medians: dict[str, float] | None = None) -> DataFrame:
        """Base features beside the kept columns, and the text the TF-IDF stages read.

        With ``medians``, features of missing metadata take the training median first.
        """
        table = feature_table(papers.withColumn("tfidf_text", combined_text()), self.categories,
                              self.keywords, keep=[*dict.fromkeys([*keep, "tfidf_text", "category"])])
        if medians:
            known = {c: F.col("category").isNotNull() if c.startswith("cat_") else F.col(f"`{c}`").isNotNull()
                     for c in self.unknown_when_uploaded}
            table = table.withColumns({c: F.when(ok, F.col(f"`{c}`").cast("double")).otherwise(F.lit(medians[c]))
                                       for c, ok in known.items()})
        filled = impute_zero(table, self.base)
        return filled.select(*keep, "tfidf_text", *(F.col(f"`{c}`").alias(n) for c, n in self.columns.items()))

    def stages(self, output: str = "raw") -> list:
        return [*self.vocabulary.stages("tfidf"),
                VectorAssembler(inputCols=[*self.columns.values(), "tfidf"], outputCol=output)]


def fit_categories(papers: DataFrame, most: int = 1000) -> list[str]:
    """The categories that occur, in alphabetical order; more than ``most`` are no categories but an error."""
    found = papers.select("category").where(F.col("category").isNotNull()).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} categories")
    return sorted(r["category"] for r in found)


def fit_features(papers: DataFrame, categories: Sequence[str], keywords: Sequence[str] = KEYWORDS,
                 stop_words: Sequence[str] | None = None) -> FittedFeatures:
    return FittedFeatures(tuple(sorted(categories)), tuple(keywords), fit_vocabulary(papers, stop_words))


def training_table(papers: DataFrame, fitted: FittedFeatures, keep: Sequence[str] = ("paper_id",)) -> DataFrame:
    """Key, label, split, fold and feature vector, written once by fold.

    Every fit and evaluation starts from these files; one that needs a single fold reads only it. Rows are few bytes
    and much work, so their scans are split finely: a fold's one file would be one task of every round of a fit.
    """
    rows = with_fold(with_split(papers)).withColumn("y", F.log1p("citations_24mo"))
    kept = [*dict.fromkeys([*keep, "citations_24mo", "y", "split", "fold"])]
    vectors = PipelineModel(fitted.stages()).transform(fitted.prepare(rows, kept))
    return write_once(vectors.select(*kept, "raw"), "training", by="fold", row_group=ROW_GROUP)


def population_scaler(rows: DataFrame, source: str = "raw", output: str = "scaled") -> ElementwiseProduct:
    """Divides each feature by its population deviation and leaves a constant one as it is.

    Nothing is centred, so sparse vectors stay sparse; the regressions fit an intercept.
    """
    s = rows.select(Summarizer.metrics("count", "std").summary(F.col(source)).alias("s")).select(
        "s.count", "s.std").first()
    shrink = ((s["count"] - 1) / s["count"]) ** 0.5 if s["count"] > 1 else 1.0
    return scaler_of([1.0 / (v * shrink) if v > 0 else 1.0 for v in s["std"].toArray()], source, output)


def scaler_of(factors: Sequence[float], source: str = "raw", output: str = "scaled") -> ElementwiseProduct:
    return ElementwiseProduct(inputCol=source, outputCol=output, scalingVec=Vectors.dense(list(factors)))


def metadata_medians(papers: DataFrame, fitted: FittedFeatures) -> dict[str, float]:
    """Training median per feature that an upload may lack: a handful of values."""
    columns = fitted.unknown_when_uploaded
    table = feature_table(papers, fitted.categories, fitted.keywords)
    long = table.select(*(F.col(f"`{c}`").cast("long").alias(c) for c in columns)).unpivot(
        [], [F.col(f"`{c}`") for c in columns], "feature", "v")
    rows = count_percentiles(long, "v", [0.5], ["feature"]).collect()
    return {r["feature"]: r["points"][0] for r in rows}
