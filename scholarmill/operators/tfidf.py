"""TF-IDF over words and word pairs: a distributed vocabulary fit and a shuffle-free transform."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (CountVectorizerModel, ElementwiseProduct, NGram, Normalizer,
                                RegexTokenizer, SQLTransformer, StopWordsRemover)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmill.operators.frequent import FEW_AT_ONCE, most_frequent
from scholarmill.session import settings, write_once

MAX_TERMS = 500
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def min_document_frequency(n_documents: int) -> int:
    """A tenth of the documents, kept within 1 and 5."""
    return max(1, min(5, max(1, n_documents // 10)))


def combined_text() -> Column:
    return F.concat_ws(" ", "abstract", "title")


def default_stop_words() -> list[str]:
    """Spark's English list; pass another list to match another tokenizer."""
    return StopWordsRemover.loadDefaultStopWords("english")


def _word_stages(stop_words: Sequence[str]) -> list:
    return [
        RegexTokenizer(inputCol="tfidf_text", outputCol="tfidf_raw", pattern=TOKEN_PATTERN, gaps=False),
        StopWordsRemover(inputCol="tfidf_raw", outputCol="tfidf_words", stopWords=list(stop_words),
                         caseSensitive=True),
        NGram(inputCol="tfidf_words", outputCol="tfidf_pairs", n=2),
    ]


@dataclass(frozen=True)
class Vocabulary:
    """Fitted terms in alphabetical order with their counts; at most ``max_terms`` of them."""

    terms: tuple[str, ...]
    tf: tuple[int, ...]
    df: tuple[int, ...]
    n_documents: int
    stop_words: tuple[str, ...]

    @property
    def idf(self) -> list[float]:
        return [math.log((1 + self.n_documents) / (1 + d)) + 1.0 for d in self.df]

    def stages(self, output: str = "tfidf") -> list:
        """Stages from ``tfidf_text`` to a sparse unit vector.  All are narrow."""
        return [
            *_word_stages(self.stop_words),
            SQLTransformer(statement="SELECT *, concat(tfidf_words, tfidf_pairs) AS tfidf_terms FROM __THIS__"),
            CountVectorizerModel.from_vocabulary(list(self.terms), inputCol="tfidf_terms",
                                                 outputCol="tfidf_counts"),
            ElementwiseProduct(inputCol="tfidf_counts", outputCol="tfidf_weighted",
                               scalingVec=Vectors.dense(self.idf)),
            Normalizer(inputCol="tfidf_weighted", outputCol=output, p=2.0),
        ]


def fit_vocabulary(papers: DataFrame, stop_words: Sequence[str] | None = None,
                   max_terms: int = MAX_TERMS) -> Vocabulary:
    """The ``max_terms`` most frequent words and pairs among those in enough documents, ties by term.

    Texts are read and cut into words once; the words are counted where they lie (see ``frequent``).
    """
    stop_words = default_stop_words() if stop_words is None else list(stop_words)
    texts = papers.select(combined_text().alias("tfidf_text"))
    *to_words, _ = _word_stages(stop_words)
    words = PipelineModel(to_words).transform(texts).select(F.col("tfidf_words").alias("words"))
    # the document count comes from the written files' footers
    tokens = write_once(words, "tokens", row_group=4 << 20)
    n_documents = tokens.count()
    with settings(papers.sparkSession, FEW_AT_ONCE):
        top = most_frequent(tokens, max_terms, min_document_frequency(n_documents))
        rows = sorted(top.collect(), key=lambda r: r["term"])
    return Vocabulary(tuple(r["term"] for r in rows), tuple(r["tf"] for r in rows),
                      tuple(r["df"] for r in rows), n_documents, tuple(stop_words))


def vocabulary_table(papers: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    schema = "term string, tf bigint, df bigint"
    rows = list(zip(vocabulary.terms, vocabulary.tf, vocabulary.df))
    return papers.sparkSession.createDataFrame(rows, schema)


def tfidf_weights(papers: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Long form (paper_id, term, weight); only cells that are not zero."""
    vectors = (PipelineModel(vocabulary.stages()).transform(
        papers.select("paper_id", combined_text().alias("tfidf_text")))
        .select("paper_id", F.unwrap_udt("tfidf").alias("v")))
    names = F.array(*(F.lit(t) for t in vocabulary.terms))
    return (vectors.select("paper_id", F.explode(F.arrays_zip("v.indices", "v.values")).alias("x"))
            .select("paper_id", F.get(names, F.col("x.indices")).alias("term"),
                    F.col("x.values").alias("weight")))
