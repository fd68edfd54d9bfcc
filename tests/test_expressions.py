import math

import pytest
from pyspark.sql import functions as F

from scholarmill.functions import labels as L
from scholarmill.functions import numbers as N
from scholarmill.functions import text as T
from scholarmill.functions.keys import fold_number, hash_bucket


def values(spark, rows, make):
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    return [r[0] for r in df.select(make(F.col("t"))).collect()]


TEXTS = ["", "  ", "one two", "a b c\x1fd", None, "x\n\ny\tz ", "ünï çode wörds"]


def test_word_count_is_a_whitespace_split(spark):
    assert values(spark, TEXTS, T.word_count) == [None if t is None else len(t.split()) for t in TEXTS]


def test_marks(spark):
    assert values(spark, ["$x$ and $", None, ""], T.dollar_count) == [3, 0, 0]
    assert values(spark, ["see [1] and [23], not [a] or []", None], T.bracket_refs) == [2, 0]
    assert values(spark, ["A, B, C", "", "Solo", None], T.author_count) == [3, 1, 1, None]


def test_reading_ease(spark):
    text = "The cat sat. Rhythm brr zzz!"
    words, syllables, sentences = 6, 6, 2
    expected = 206.835 - 1.015 * words / sentences - 84.6 * syllables / words
    got = values(spark, [text, None, ""], T.reading_ease)
    assert got[0] == pytest.approx(expected)
    assert got[1] is None and got[2] == pytest.approx(206.835)


def test_keyword_flags_are_literal_and_cover_title_and_abstract(spark):
    df = spark.createDataFrame([("A Survey", "state-of-the-art"), ("x", "we  propose stateXofXtheXart"), (None, "novel")],
                               "title string, abstract string")
    flags = T.keyword_flags(F.col("title"), F.col("abstract"))
    assert list(flags) == ["has_survey", "has_benchmark", "has_state_of_the_art", "has_novel", "has_we_propose"]
    rows = df.select(*(c.alias(n) for n, c in flags.items())).collect()
    assert [tuple(r) for r in rows] == [(1, 0, 1, 0, 0), (0, 0, 0, 0, 0), (0, 0, 0, 1, 0)]


def test_normal_cdf(spark):
    zs = [-8.0, -3.1, -1.0, -0.01, 0.0, 0.5, 1.96, 6.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double").select(N.normal_cdf(F.col("z")))
    for z, r in zip(zs, df.collect()):
        assert r[0] == pytest.approx(0.5 * math.erfc(-z / math.sqrt(2)), abs=1e-7)


def test_log_inverse_and_clamp(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 5, 10, 100)], "v double")
    for v, back in df.select("v", F.expm1(F.log1p("v"))).collect():
        assert back == pytest.approx(v)
    assert spark.range(1).select(N.raw_count(F.lit(-2.0))).first()[0] == 0.0


def test_verdicts(spark):
    df = spark.createDataFrame([(0.5, 0.48), (0.5, 0.30), (0.5, 0.40)], "a double, b double")
    assert [r[0] for r in df.select(L.fit_gap(F.col("a"), F.col("b"))).collect()] == ["good", "overfit", "moderate"]
    df = spark.createDataFrame([(4.9,), (-80.0,), (15.1,), (10.0,)], "p double")
    assert [r[0] for r in df.select(L.ablation_verdict(F.col("p"))).collect()] == \
        ["none", "moderate", "substantial", "moderate"]


def test_one_hot_sums_to_one_and_decodes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "category string")
    hot = df.select("category", *(c.alias(n) for n, c in L.one_hot(F.col("category"), ["b", "a"]).items()))
    rows = hot.withColumn("back", L.decode_one_hot(["b", "a"])).collect()
    assert hot.columns == ["category", "cat_a", "cat_b"]
    assert [(r["cat_a"] + r["cat_b"], r["back"]) for r in rows] == [(1, "b"), (1, "a"), (0, None), (0, None)]


def test_feature_labels(spark):
    names = ["tfidf_deep learning", "has_novel", "cat_cs.LG", "author_count"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(L.feature_group(F.col("n"))).collect()] == ["tfidf", "has", "cat", "other"]
    assert [r[0] for r in df.select(L.pretty_feature(F.col("n"))).collect()] == \
        ["deep learning", "has:novel", "cat:cs.LG", "author_count"]
    assert [r[0] for r in df.select(L.tagged_feature(F.col("n"))).collect()][1:3] == ["[kw] novel", "[cat] cs.LG"]


def test_assignment_does_not_depend_on_partitions(spark):
    def assigned(parts):
        return spark.range(500).repartition(parts).select(
            "id", hash_bucket(F.col("id"), 5), fold_number(F.col("id"))).orderBy("id").collect()

    first = assigned(1)
    assert first == assigned(7)
    assert {r[2] for r in first} == {0, 1, 2, 3, 4}
