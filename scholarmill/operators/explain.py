"""Coefficients: which features carry weight, and which words of a text do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.functions.labels import feature_group, pretty_feature
from scholarmill.operators.terms import terms_in

# Fixed value: a coefficient above this size counts as non-zero in the model card.
NONZERO = 1e-6


def _term_weights(coefficients: DataFrame) -> list[tuple[str, float]]:
    """Terms with a coefficient that is not zero, greatest size first.

    There are at most as many as the vocabulary holds, which its fit bounds.
    """
    terms = (coefficients.where(F.startswith("feature", F.lit("tfidf_")) & (F.col("coef") != 0))
             .select(F.expr("substring(feature, 7)").alias("term"), "coef"))
    return sorted(map(tuple, terms.collect()), key=lambda t: (-abs(t[1]), t[0], t[1]))


def _with_terms(papers: DataFrame, weights: list[tuple[str, float]], first: int | None = None) -> DataFrame:
    """``(paper_id, rank, term, coef)`` of the terms that the lower-cased text holds, inside words too."""
    texts = papers.select(F.col("paper_id").alias("key"), F.lower(F.concat_ws(" ", "title", "abstract")).alias("text"))
    at = F.col("place")
    terms = F.array(*(F.lit(t) for t, _ in weights)).cast("array<string>")
    sizes = F.array(*(F.lit(float(c)) for _, c in weights)).cast("array<double>")
    return terms_in(texts, [t for t, _ in weights], first).select(
        F.col("key").alias("paper_id"), "rank", F.get(terms, at).alias("term"), F.get(sizes, at).alias("coef"))


def word_contributions(papers: DataFrame, coefficients: DataFrame) -> DataFrame:
    """(paper_id, term, coef) for every weighted term a paper's text contains.

    Each text is read once, where it lies: no join, no shuffle, and no cost for each further term.
    """
    return _with_terms(papers, _term_weights(coefficients)).select("paper_id", "term", "coef")


def top_words(papers: DataFrame, coefficients: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` weightiest terms per paper, with the direction of each."""
    return _with_terms(papers, _term_weights(coefficients), n).select(
        "paper_id", "rank", "term", "coef", F.when(F.col("coef") > 0, "increases").otherwise("decreases").alias("direction"))


def feature_importance(coefficients: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` most negative and the ``n`` most positive coefficients."""
    low = coefficients.where("coef < 0").orderBy("coef", "feature").limit(n)
    high = coefficients.where("coef > 0").orderBy(F.desc("coef"), "feature").limit(n)
    return low.unionByName(high).withColumn("label", pretty_feature(F.col("feature")))


def model_card(coefficients: DataFrame) -> DataFrame:
    """Features per group and how many carry weight."""
    return (coefficients.groupBy(feature_group(F.col("feature")).alias("feature_group"))
            .agg(F.count("*").alias("n_features"),
                 F.count_if(F.abs("coef") > NONZERO).alias("n_nonzero")))
