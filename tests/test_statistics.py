import shutil
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from scholarmill.operators import evaluate as E
from scholarmill.operators import features as X
from scholarmill.operators import quantiles as P
from scholarmill.operators import trends as T
from scholarmill.operators.ranks import percentile_of_score
from scholarmill.operators.sketches import add_day, rank_error, sketched_percentiles
from scholarmill.operators.split import with_fold, with_split
from scholarmill.operators.univariate import score_line, score_out_of_fold

POINTS = [0.0, 0.25, 0.33, 0.5, 0.67, 0.9, 1.0]


def test_percentiles_of_many_rows(spark):
    """More rows than the sketch tells apart, at the setting in use."""
    df = spark.range(130_000).selectExpr("sin(id) * exp(id % 17) AS v", "id % 2 AS g")
    values = np.array([r["v"] for r in df.collect()])
    got = P.measured_percentiles(df, "v", POINTS).first()
    assert got["n"] == 130_000
    np.testing.assert_allclose(got["points"], np.percentile(values, np.array(POINTS) * 100), rtol=1e-12)


@pytest.mark.parametrize("accuracy,margin", [(20_000, 4.0), (200, 4.0), (50, 0.01)])
def test_measured_percentiles_match_numpy(spark, monkeypatch, accuracy, margin):
    """The last setting makes brackets miss, so that they are widened."""
    monkeypatch.setattr(P, "SKETCH_ACCURACY", accuracy)
    monkeypatch.setattr(P, "MARGIN", margin)
    rng = np.random.default_rng(3)
    groups = {"normal": rng.normal(size=4000), "hot": np.repeat([1.5, -2.0, 7.25], [2500, 1000, 1]),
              "heavy": np.exp(rng.normal(size=3000) * 4), "two": np.array([1.0, 4.0]), "one": np.array([3.0])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    for r in P.measured_percentiles(df, "v", POINTS, ["g"]).collect():
        assert r["n"] == len(groups[r["g"]])
        np.testing.assert_allclose(r["points"], np.percentile(groups[r["g"]], np.array(POINTS) * 100), rtol=1e-12)
    everything = np.concatenate(list(groups.values()))
    got = P.measured_percentiles(df, "v", POINTS).first()["points"]
    np.testing.assert_allclose(got, np.percentile(everything, np.array(POINTS) * 100), rtol=1e-12)


def test_count_percentiles_match_numpy(spark):
    counts = np.random.default_rng(5).negative_binomial(1, 0.05, 2000)
    df = spark.createDataFrame([(int(c),) for c in counts] + [(None,)], "c int")
    got = P.count_percentiles(df, "c", POINTS).first()
    np.testing.assert_allclose(got["points"], np.percentile(counts, np.array(POINTS) * 100))
    assert got["n"] == 2000 and got["mean"] == pytest.approx(counts.mean())


def test_percentile_among_measured_values(spark):
    """Ties on both sides, a value that most rows share, values apart by one bit, and scores beyond both ends."""
    rng = np.random.default_rng(17)
    observed = np.concatenate([np.round(rng.normal(size=400), 1), np.full(900, 0.25), [1.0, np.nextafter(1.0, 2), 1e300, -1e300, -0.0, 0.0]])
    scores = [*np.round(rng.normal(size=200), 1).tolist(), 0.25, 0.25, 1.0, float(np.nextafter(1.0, 2)), float(np.nextafter(1.0, 0)), 2e300, -2e300, 0.0, None]
    o = spark.createDataFrame([(float(v),) for v in observed] + [(None,)], "v double").repartition(5)
    s = spark.createDataFrame([(i, v) for i, v in enumerate(scores)], "i int, score double").repartition(3)
    got = {r["i"]: r["percentile"] for r in percentile_of_score(s, "score", o, "v").collect()}
    assert len(got) == len(scores) and got[len(scores) - 1] is None
    for i, v in enumerate(scores[:-1]):
        left, right = (observed < v).sum(), (observed <= v).sum()
        assert got[i] == pytest.approx((left + right + (left < right)) * 50 / len(observed))
    none = percentile_of_score(s, "score", o.where("false"), "v").collect()
    assert len(none) == len(scores) and all(r["percentile"] is None for r in none)


def test_sketches_are_merged_by_day(spark, tmp_path):
    rng = np.random.default_rng(8)
    values = {(g, d): rng.lognormal(size=3000) for g in "ab" for d in (1, 2, 3)}
    path = str(tmp_path / "sketches")
    for d in (1, 2, 3):
        rows = [(g, float(v)) for g in "ab" for v in values[g, d]] + [("a", None)]
        add_day(spark.createDataFrame(rows, "g string, v double").repartition(4), f"2020-01-0{d}", "v", "g", path, k=400)
    points = [0.01, 0.25, 0.5, 0.9, 0.99]

    def check(days, **bounds):
        for r in sketched_percentiles(spark, path, points, **bounds).collect():
            own = np.sort(np.concatenate([values[r["group"], d] for d in days]))
            assert r["n"] == len(own)
            rank = np.searchsorted(own, r["points"], side="right") / len(own)
            assert np.abs(rank - points).max() < 2 * rank_error(400)

    check((1, 2, 3))
    check((2,), first="2020-01-02", last="2020-01-02")
    # the first day's files are not needed for the others, and a day that is stored again replaces itself
    shutil.rmtree(f"{path}/day=2020-01-01")
    check((2, 3))
    add_day(spark.createDataFrame([("a", 1.0), ("b", 5.0), ("b", 3.0)], "g string, v double"), "2020-01-02", "v", "g", path)
    assert {r["group"]: (r["n"], r["points"]) for r in sketched_percentiles(spark, path, [0.0, 0.5, 1.0], last="2020-01-02").collect()} == {
        "a": (1, [1.0, 1.0, 1.0]), "b": (2, [3.0, 3.0, 5.0])}


def test_scores_that_differ_in_the_last_bits_when_computed_again_have_ranks(spark, tmp_path):
    """As a fit over several executors does, whose parts are added up in any order."""
    def again(v):
        (tmp_path / uuid.uuid4().hex).touch()
        return float(v) + 1e-9 * len(list(tmp_path.iterdir()))

    s = spark.range(8).repartition(1).select("id", F.udf(again, "double").asNondeterministic()("id").alias("score"))
    got = percentile_of_score(s, "score", spark.range(8).toDF("c"), "c")
    assert {r["id"]: r["percentile"] for r in got.collect()} == {i: (i + 1) * 12.5 for i in range(8)}


def test_percentile_of_score_by_brute_force(spark):
    rng = np.random.default_rng(7)
    observed = np.concatenate([rng.integers(0, 40, 300), [900, 900, 5000, 70_000, 10**12]])
    scores = [-3.5, 0.0, 0.5, 12.0, 39.999, 64.0, 900.0, 901.2, 5000.0, 69_999.5, 70_000.0, 1e6, 5e8, 1e12 - 1, 1e12, 1e15, None]
    o = spark.createDataFrame([(int(v),) for v in observed], "c long")
    s = spark.createDataFrame([(v,) for v in scores], "score double")
    for r in percentile_of_score(s, "score", o, "c").collect():
        if r["score"] is None:
            assert r["percentile"] is None
            continue
        left, right = (observed < r["score"]).sum(), (observed <= r["score"]).sum()
        assert r["percentile"] == pytest.approx((left + right + (left < right)) * 50 / len(observed))


def scored(spark, rows):
    return spark.createDataFrame(rows, "paper_id long, category string, author_count int, citations_24mo long, y double, pred double")


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(11)
    c = rng.integers(0, 60, 500)
    y = np.log1p(c)
    pred = y * 0.6 + 1 + rng.normal(size=500) * 0.4
    return scored(spark, [(i, "abc"[i % 3], i % 9, int(c[i]), float(y[i]), float(pred[i])) for i in range(500)]), y, pred


def test_r2_edges(spark):
    rows = [(1, "same", 1, 1, 2.0, 2.0), (2, "same", 1, 1, 2.0, 2.0), (3, "off", 1, 1, 2.0, 1.0), (4, "off", 1, 1, 2.0, 2.0),
            (5, "single", 1, 1, 2.0, 2.0)]
    got = {r["category"]: r["r2"] for r in E.metrics_by_category(scored(spark, rows)).collect()}
    assert got == {"same": 1.0, "off": 0.0, "single": None}


def test_r2_of_a_constant_in_several_parts(spark):
    """log(2) / 11 * 11 is not log(2), so means of parts differ from one another."""
    rows = spark.range(0, 33, 1, 3).select(F.log1p(F.lit(1.0)).alias("y"), (F.col("id") % 3).cast("double").alias("pred"))
    assert E.regression_metrics(rows).first()["r2"] == 0.0
    assert E.regression_metrics(rows.withColumn("pred", F.col("y"))).first()["r2"] == 1.0


def test_metrics_and_strata_cover_all_rows(sample):
    df, y, pred = sample
    m = E.regression_metrics(df).first()
    assert m["r2"] == pytest.approx(1 - ((y - pred) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert m["rmse"] == pytest.approx(np.sqrt(((y - pred) ** 2).mean()))
    for strata in (E.metrics_by_category(df), E.metrics_by_citation_level(df), E.metrics_by_uncertainty(df),
                   E.metrics_by_author_count(df)):
        assert strata.agg(F.sum("n")).first()[0] == 500
    assert E.metrics_by_author_count(df, least=56).count() == 5
    bins = E.actual_vs_predicted_bins(df, 10)
    assert bins.agg(F.sum("n_papers")).first()[0] == 500


def test_coverage_grows_with_width(sample):
    rows = E.calibration(sample[0]).orderBy("z").collect()
    shares = [r["empirical"] for r in rows]
    assert shares == sorted(shares) and rows[0]["residual_std"] == pytest.approx((sample[1] - sample[2]).std())


def test_calibration_names_the_right_direction(spark):
    """Nine residuals of ten are small, so far more than 68 % lie inside one deviation: too wide."""
    rows = [(i, "a", 1, 1, 0.0, float((-1) ** i * (2 if i < 10 else 1))) for i in range(100)]
    first = E.calibration(scored(spark, rows)).orderBy("z").first()
    assert first["empirical"] == 0.9 and first["verdict"] == "too_wide"


def test_diagnostics_flags(sample):
    r = E.residual_diagnostics(sample[0]).first()
    assert r["varies"] and r["two_sided"] and r["few_far"] and r["beats_mean"]


def test_folds_partition_the_rows(spark, sample):
    rows = with_fold(with_split(sample[0])).withColumn("x", F.col("y"))
    assert score_out_of_fold(rows).count() == 500
    assert score_out_of_fold(rows).where("pred is null").count() == 0
    line = score_line(rows).where(F.abs(F.col("pred") - F.col("y")) > 1e-9)
    assert line.count() == 0
    stability = E.fold_stability(score_out_of_fold(rows)).first()
    assert stability["n_folds"] == 5 and not stability["is_unstable"]


def test_velocity_uses_real_counts_and_marks_estimates(spark):
    df = spark.createDataFrame([(10, 30), (None, 100), (0, 0)], "citations_12mo int, citations_24mo int")
    r = T.citation_velocity(df).first()
    assert r["n_estimated"] == 1 and r["first_mean"] == pytest.approx((10 + 60 + 0) / 3)


def test_keywords_overlap_and_empty_ones_vanish(spark):
    df = spark.createDataFrame([(1, 1, 0, 10), (1, 0, 0, 20), (0, 1, 0, 40)],
                               "has_a int, has_b int, has_c int, citations_24mo int")
    got = {r["keyword"]: (r["n"], r["median"]) for r in T.keyword_trend(df, ["has_a", "has_b", "has_c"]).collect()}
    assert got == {"a": (2, 15.0), "b": (2, 25.0)}


def test_histogram_keeps_the_greatest_value_in_the_last_bin(spark):
    df = spark.createDataFrame([("a", v) for v in (0, 1, 29, 30)], "category string, v int")
    bins = {r["bin"]: r["n_papers"] for r in T.histogram_by_category(df, "v").collect()}
    assert bins == {0: 1, 1: 1, 29: 2}


def test_scaling_and_imputation(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0), (3, float("nan"), None)], "paper_id int, a double, b double")
    filled = X.impute_zero(df, ["a", "b"])
    assert [tuple(r) for r in filled.orderBy("paper_id").collect()] == [(1, 1.0, 5.0), (2, 3.0, 5.0), (3, 0.0, 0.0)]
    z = X.standardize(df.where("paper_id < 3"), ["a", "b"]).orderBy("paper_id").collect()
    assert [(r["a"], r["b"]) for r in z] == [(-1.0, 0.0), (1.0, 0.0)]


def test_features_of_a_shelf(shelf):
    papers, citations = shelf
    row = X.feature_table(papers, ["ocean", "desert", "polar"]).orderBy("paper_id").first()
    assert (row["citation_count"], row["equation_count"], row["author_count"]) == (2, 2, 3)
    assert all(row[f"has_{k}"] == 1 for k in ("survey", "benchmark", "state_of_the_art", "novel", "we_propose"))
    targets = X.targets(citations.where("citations_24mo is not null")).orderBy("paper_id").collect()
    assert [r["top_quartile"] for r in targets] == [0, 0, 0, 1, 0]
