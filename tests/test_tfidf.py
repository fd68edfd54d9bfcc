import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from scholarmill.operators import explain as W
from scholarmill.operators import tfidf as T
from scholarmill.operators.frequent import BLOCK_WORDS, FEW_AT_ONCE, counted, most_frequent, summaries
from scholarmill.operators.terms import terms_in
from scholarmill.session import settings

STOP = ["the", "of"]


def brute(texts, limit):
    docs = []
    for t in texts:
        words = [w for w in re.findall(r"\w{2,}", t.lower()) if w not in STOP]
        docs.append(Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])]))
    tf, df = Counter(), Counter()
    for d in docs:
        tf.update(d)
        df.update(d.keys())
    least = max(1, min(5, max(1, len(texts) // 10)))
    top = sorted((t for t in tf if df[t] >= least), key=lambda t: (-tf[t], t))[:limit]
    idf = {t: math.log((1 + len(texts)) / (1 + df[t])) + 1 for t in top}
    weights = {}
    for i, d in enumerate(docs):
        row = {t: d[t] * idf[t] for t in top if d[t]}
        norm = math.sqrt(sum(w * w for w in row.values()))
        weights.update({(i, t): w / norm for t, w in row.items()})
    return {t: (tf[t], df[t]) for t in top}, weights


@pytest.mark.parametrize("limit", [3, 12, 40, 500])
def test_vocabulary_and_weights_match_a_full_count(spark, limit):
    """The pairs pruned before the shuffle never change the outcome, whatever the limit."""
    rnd = random.Random(1)
    words = ["the", "of", "graph", "deep", "net", "learning", "éclair", "x1", "of", "a_b", "zeta", "q"]
    texts = [" ".join(rnd.choices(words, weights=range(12, 0, -1), k=rnd.randint(0, 30))) for _ in range(60)]
    texts[0], texts[1] = "", "deep net " * 30
    papers = spark.createDataFrame([(i, "", t) for i, t in enumerate(texts)], "paper_id long, title string, abstract string")
    want, weights = brute(texts, limit)
    fitted = T.fit_vocabulary(papers, STOP, limit)
    assert {t: (a, b) for t, a, b in zip(fitted.terms, fitted.tf, fitted.df)} == want
    got = {(r["paper_id"], r["term"]): r["weight"] for r in T.tfidf_weights(papers, fitted).collect()}
    assert got.keys() == weights.keys()
    assert all(got[k] == pytest.approx(weights[k]) for k in got)


@pytest.mark.parametrize("wanted,k,least_df", [(5, 5, 1), (5, None, 3), (40, 2, 2), (300, 300, 1), (3, 1, 60)])
def test_frequent_terms_from_short_summaries_equal_a_full_count(spark, wanted, k, least_df):
    """Ties, terms that a block leaves out, flat counts that need longer summaries, and more terms wanted than there are."""
    rnd = random.Random(wanted)
    words = [f"w{i}" for i in range(60)]
    docs = [rnd.choices(words, weights=[1 + 60 // (i + 1) for i in range(60)], k=rnd.randint(0, 12)) for _ in range(200)] + [None, []]
    tf, df = Counter(), Counter()
    for d in docs:
        own = Counter([*(d or []), *(f"{a} {b}" for a, b in zip(d or [], (d or [])[1:]))])
        tf.update(own)
        df.update(own.keys())
    expected = sorted((t for t in tf if df[t] >= least_df), key=lambda t: (-tf[t], t))[:wanted]
    tokens = spark.createDataFrame([(d,) for d in docs], "words array<string>").repartition(6)
    found = most_frequent(tokens, wanted, least_df, k, block_words=70).collect()
    assert [(r["term"], r["tf"], r["df"]) for r in found] == [(t, tf[t], df[t]) for t in expected]


def test_summaries_carry_few_terms(spark):
    """What leaves a task is bounded by the summary, not by its words."""
    rows = spark.range(3000).selectExpr("transform(sequence(1, 40), i -> concat('t', cast(pmod(hash(id, i), 20000) as string))) AS words")
    found = summaries(rows.repartition(3), 100, 10_000_000).groupBy(F.spark_partition_id()).agg(F.count("term").alias("n")).collect()
    assert {r["n"] for r in found} == {100}


def test_a_block_of_words_takes_little_memory(spark, shelf, monkeypatch):
    drawn = np.random.default_rng(3).integers(0, 5000, BLOCK_WORDS)
    words = pa.array([f"w{i}" for i in range(5000)]).take(pa.array(drawn))
    tracemalloc.start()
    counted(words, np.arange(BLOCK_WORDS) // 300)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20

    # a block ends with the batch that fills it, so batches are small while the words are counted
    seen = []

    def found(tokens, *_):
        seen.append(int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
        return spark.createDataFrame([], "term string, tf long, df long")

    monkeypatch.setattr(T, "most_frequent", found)
    T.fit_vocabulary(shelf[0])
    assert seen[0] <= 256 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))


def test_long_texts_are_not_handed_over_together(spark):
    """A batch is bounded by size too: 256 documents of 20,000 words would make a block ten times as large."""
    rows = spark.range(300).coalesce(1).selectExpr("transform(sequence(1, 20000), i -> concat('word', cast(i as string))) AS words")

    def lengths(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(batch.column(0).flatten())]})

    with settings(spark, FEW_AT_ONCE):
        found = rows.mapInArrow(lengths, "n long").agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    assert found["n"] == 300 * 20000 and found["most"] <= BLOCK_WORDS


def test_term_search_equals_containment(spark):
    rnd = random.Random(5)
    terms = ["a", "ab", "b ab", "é", "aba", "", "ab", "zz z", "😀b", *("".join(rnd.choices("abé ", k=rnd.randint(1, 5))) for _ in range(80))]
    texts = [None, "", "😀b", *("".join(rnd.choices("abé z", k=rnd.randint(0, 40))) for _ in range(200))]
    frame = spark.createDataFrame(list(enumerate(texts)), "key int, text string").repartition(3)
    got = {}
    for r in terms_in(frame, terms).orderBy("key", "rank").collect():
        got.setdefault(r["key"], []).append(r["place"])
    assert got == {i: own for i, t in enumerate(texts) if (own := [j for j, term in enumerate(terms) if t is not None and term in t])}
    first = {(r["key"], r["rank"], r["place"]) for r in terms_in(frame, terms, 3).collect()}
    assert first == {(i, j + 1, p) for i, own in got.items() for j, p in enumerate(own[:3])}
    assert terms_in(frame, []).count() == 0 and terms_in(frame, [""]).count() == len(texts) - 1


def test_minimum_document_frequency():
    assert [T.min_document_frequency(n) for n in (1, 19, 20, 49, 50, 10**9)] == [1, 1, 2, 4, 5, 5]


def test_words_match_inside_words_and_rank_by_size(spark):
    papers = spark.createDataFrame([(1, "Deep Networks", "networking"), (2, "", None)],
                                   "paper_id long, title string, abstract string")
    coefs = spark.createDataFrame([("tfidf_network", -0.5), ("tfidf_deep", 0.2), ("tfidf_zero", 0.0), ("tfidf_working", 0.2),
                                   ("has_deep", 9.0), ("tfidf_absent", 3.0)], "feature string, coef double")
    found = [(r["term"], r["coef"]) for r in W.word_contributions(papers, coefs).collect()]
    assert sorted(found) == [("deep", 0.2), ("network", -0.5), ("working", 0.2)]
    top = W.top_words(papers, coefs, 2).orderBy("rank").collect()
    assert [(r["rank"], r["term"], r["direction"]) for r in top] == [(1, "network", "decreases"), (2, "deep", "increases")]


def test_importance_takes_both_ends(spark):
    coefs = spark.createDataFrame([(f"tfidf_w{i}", float(i - 5)) for i in range(11)], "feature string, coef double")
    rows = W.feature_importance(coefs, 2).collect()
    assert [r["label"] for r in rows] == ["w0", "w1", "w10", "w9"]
