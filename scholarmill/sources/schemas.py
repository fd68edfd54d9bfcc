"""Schemas of the stored tables and the landed documents."""

from __future__ import annotations

from pyspark.sql import types as T

PAPERS = T.StructType([
    T.StructField("paper_id", T.StringType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("abstract", T.StringType()),
    T.StructField("authors", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("submitted", T.DateType()),
])

CITATIONS = T.StructType([
    T.StructField("paper_id", T.StringType(), False),
    T.StructField("citations_12mo", T.IntegerType()),
    T.StructField("citations_24mo", T.IntegerType()),
    T.StructField("fetched", T.DateType()),
])

FEED_ENTRY = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("published", T.StringType()),
    T.StructField("author", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
])

WORKS = T.StructType([
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("cited_by_count", T.LongType()),
        T.StructField("publication_date", T.StringType()),
    ]))),
])

UPLOAD = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("abstract", T.StringType()),
])

SCORING_INPUT = T.StructType([
    T.StructField("seq", T.LongType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("abstract", T.StringType()),
    T.StructField("authors", T.IntegerType()),
    T.StructField("category", T.StringType()),
])
