import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from scholarmill.models import assemble
from scholarmill.models import moments as M
from scholarmill.models import regress as R
from scholarmill.models.assemble import fit_features, population_scaler, training_table
from scholarmill.models.bundle import ScoringModel, bundle
from scholarmill.operators.split import with_fold, with_split
from scholarmill.session import fresh_path, settings, write_once

P = 6


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, P)) * np.array([1, 5, 0.1, 2, 1, 1]) + 3
    x[:, 5] = 4.0
    y = 2 + 0.8 * x[:, 0] - 0.1 * x[:, 1] + rng.normal(size=300) * 0.3
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                               "paper_id long, " + ", ".join(f"f{j} double" for j in range(P)) + ", y double")
    rows = VectorAssembler(inputCols=[f"f{j}" for j in range(P)], outputCol="raw").transform(with_fold(with_split(df)))
    return write_once(rows.select("paper_id", "split", "fold", "y", "raw"), "model-test"), x, y


def scaled(x):
    s = x.std(axis=0)
    return x / np.where(s > 0, s, 1.0)


def solve(x, y, l1, l2):
    """Plain coordinate descent on centred data, the textbook form."""
    xc, yc, n = x - x.mean(axis=0), y - y.mean(), len(y)
    b = np.zeros(x.shape[1])
    for _ in range(3000):
        for j in range(len(b)):
            c = xc[:, j] @ xc[:, j] / n
            if c + l2 > 0:
                rho = xc[:, j] @ (yc - xc @ b + xc[:, j] * b[j]) / n
                b[j] = np.sign(rho) * max(abs(rho) - l1, 0) / (c + l2)
    return b


def test_moments_of_folds_merge_to_the_whole(data):
    table, x, y = data
    whole = M.merge(M.fold_moments(table))
    joint = np.column_stack([x, y])
    assert whole.n == 300
    np.testing.assert_allclose(whole.mean, joint.mean(axis=0))
    np.testing.assert_allclose(whole.cov, np.cov(joint.T, bias=True), atol=1e-9)


def test_vectors_reach_the_sums_in_blocks(spark, monkeypatch):
    """What keeps matrices apart between the steps must not cut the rows of the first one into pairs."""
    whole = M.dense_blocks

    def large(batches, width):
        for fold, block in whole(batches, width):
            if len(block) < 500:
                raise ValueError(f"a block of {len(block)} rows")
            yield fold, block

    monkeypatch.setattr(M, "dense_blocks", large)
    rows = VectorAssembler(inputCols=["y", "z"], outputCol="raw").transform(
        spark.range(0, 3000, 1, 2).select((F.col("id") % 3).alias("fold"), F.col("id").cast("double").alias("y"), F.sin("id").alias("z")))
    assert [m.n for m in M.fold_moments(rows)] == [1000, 1000, 1000, 0, 0]


def test_training_rows_of_a_fold_are_read_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(assemble, "ROW_GROUP", 20_000)
    papers = spark.range(4000).select(
        F.col("id").alias("paper_id"), F.lit("Some title").alias("title"), F.concat_ws(" ", *(F.sha2(F.concat("id", F.lit(str(i))), 256) for i in range(9)), F.lit("same words")).alias("abstract"),
        F.lit("A, B").alias("authors"), F.lit("x").alias("category"), F.lit("2020-01-01").cast("date").alias("submitted"), (F.col("id") % 7).alias("citations_24mo"))
    table = training_table(papers, fit_features(papers, ["x"]))
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "10000", "spark.sql.files.openCostInBytes": "0"}):
        held = [r["rows"] for r in table.where("fold = 0").groupBy(F.spark_partition_id()).agg(F.count("*").alias("rows")).collect()]
    assert sum(held) > 600 and len(held) > 1


def test_moments_of_sparse_and_dense_rows_in_one_pass(spark):
    """Large means, sparse and dense vectors side by side, small blocks, a fold without rows."""
    rng = np.random.default_rng(3)
    x = np.where(rng.random((400, 7)) < 0.5, rng.normal(size=(400, 7)) * 3 + 1e6, 0.0)
    y = rng.normal(size=400) - 1e5
    rows = [(i % 3, Vectors.dense(v) if i % 2 else Vectors.sparse(7, np.flatnonzero(v).tolist(), v[np.flatnonzero(v)].tolist()), float(t))
            for i, (v, t) in enumerate(zip(x, y))]
    frame = spark.createDataFrame(rows, ["fold", "raw", "y"]).repartition(5)
    parts = M.fold_moments(frame, 4)
    for k in range(3):
        joint = np.column_stack([x, y])[np.arange(400) % 3 == k]
        assert parts[k].n == len(joint)
        np.testing.assert_allclose(parts[k].mean, joint.mean(axis=0), rtol=1e-12)
        np.testing.assert_allclose(parts[k].cov, np.cov(joint.T, bias=True), rtol=1e-9, atol=1e-6)
    assert parts[3].n == 0
    np.testing.assert_allclose(M.merge(parts).cov, np.cov(np.column_stack([x, y]).T, bias=True), rtol=1e-9, atol=1e-6)
    assert [p.n for p in M.fold_moments(frame.where("false"), 2)] == [0, 0]


def test_solver_and_library_agree(data):
    """Coefficients from the moments against the library's own fit on the rows."""
    table, x, y = data
    whole = M.merge(M.fold_moments(table))
    for alpha, share, ridge in ((0.05, 1.0, False), (0.1, 0.5, False), (25.0, 0.0, True)):
        solved, fitted = R.fit_linear("m", table, alpha, share, ridge=ridge, whole=whole), R.fit_linear("m", table, alpha, share, ridge=ridge)
        np.testing.assert_allclose(solved.coefficients, fitted.coefficients, atol=1e-6)
        both = solved.score(table).select("paper_id", "pred").join(fitted.score(table).select("paper_id", F.col("pred").alias("other")), "paper_id")
        assert both.where("abs(pred - other) > 1e-5").count() == 0


def test_more_features_than_the_matrix_holds(spark, data):
    """6,000 features, most of them empty, are searched on the data; on few features both searches agree."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(240):
        at = np.unique(np.append([3, 5999], rng.integers(0, 6000, 12)))
        v = rng.normal(size=len(at))
        rows.append((i, "train" if i % 6 else "test", i % 5, Vectors.sparse(6000, at.tolist(), v.tolist()),
                     float(2 * v[at == 3][0] - v[at == 5999][0] + 0.05 * rng.normal())))
    wide = write_once(spark.createDataFrame(rows, ["paper_id", "split", "fold", "raw", "y"]), "wide", by="fold")
    fitted = R.fit_lasso(wide, points=2)
    assert len(fitted.coefficients) == 6000 and {3, 5999} <= set(np.flatnonzero(np.abs(fitted.coefficients) > 0.3))
    by = {r["split"]: r["r2"] for r in R.split_metrics(fitted, wide).collect()}
    assert by["test"] > 0.8
    with pytest.raises(ValueError):
        M.fold_moments(wide)
    table = data[0]
    for few, many in ((R.fit_lasso(table, points=3), R.fit_lasso(table, points=3, max_features=2)),
                      (R.fit_ridge(table, path=(-1, 2, 2)), R.fit_ridge(table, path=(-1, 2, 2), max_features=2))):
        assert few.alpha == pytest.approx(many.alpha)
        np.testing.assert_allclose(few.coefficients, many.coefficients, atol=1e-4)


def test_scaler_uses_population_deviation(data):
    table, x, _ = data
    rows = population_scaler(table).transform(table).orderBy("paper_id").collect()
    np.testing.assert_allclose(np.array([r["scaled"].toArray() for r in rows]), scaled(x))


@pytest.mark.parametrize("alpha,share", [(0.05, 1.0), (0.3, 1.0), (0.1, 0.5), (0.2, 0.1)])
def test_fit_equals_coordinate_descent(data, alpha, share):
    table, x, y = data
    fitted = R.fit_linear("m", table, alpha, share)
    np.testing.assert_allclose(fitted.coefficients, solve(scaled(x), y, alpha * share, alpha * (1 - share)), atol=1e-4)
    cov = np.cov(np.column_stack([scaled(x), y]).T, bias=True)
    path = M.descend(cov[:-1, :-1], cov[:-1, -1], np.array([alpha * share, 9.0]), np.array([alpha * (1 - share), 0.0]), 
                     float(cov[-1, -1]))
    np.testing.assert_allclose(path[:, 0], fitted.coefficients, atol=1e-4)
    assert not path[:, 1].any()


def test_search_solves_wide_problems_exactly_or_says_so():
    """More, correlated features than rows, at the settings in use: no slope of the objective is left."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 8)) @ rng.normal(size=(8, 90)) + 0.05 * rng.normal(size=(60, 90))
    y = x[:, 0] - x[:, 5] + rng.normal(size=60)
    cov = np.cov(np.column_stack([x, y]).T, bias=True)
    top = np.abs(cov[:-1, -1]).max()
    alphas = np.geomspace(top, top * 1e-3, 50)
    beta = M.descend(cov[:-1, :-1], cov[:-1, -1], alphas, np.zeros(50), float(cov[-1, -1]))
    slope = cov[:-1, [-1]] - cov[:-1, :-1] @ beta
    assert (np.abs(slope) <= alphas * (1 + 1e-3) + 1e-4).all()
    assert (np.abs(slope - alphas * np.sign(beta))[beta != 0] <= 2e-3 * top).all()
    with pytest.raises(ArithmeticError):
        M.descend(cov[:-1, :-1], cov[:-1, -1], alphas, np.zeros(50), float(cov[-1, -1]), steps=2)


def test_ridge_equals_closed_form(data):
    table, x, y = data
    fitted = R.fit_linear("m", table, 25.0, 0.0, ridge=True)
    xc = scaled(x) - scaled(x).mean(axis=0)
    want = np.linalg.solve(xc.T @ xc + 25.0 * np.eye(P), xc.T @ (y - y.mean()))
    np.testing.assert_allclose(fitted.coefficients, want, atol=1e-5)


def test_search_picks_the_least_held_out_error(data):
    table, x, y = data
    parts = R.scaled_moments(table)
    fold = np.array([r["fold"] for r in table.orderBy("paper_id").select("fold").collect()])
    xs, grid = scaled(x), [(0.5, 1.0), (0.05, 1.0), (0.002, 1.0)]
    errors = []
    for alpha, _ in grid:
        mse = []
        for k in range(5):
            a, h = fold != k, fold == k
            b = solve(xs[a], y[a], alpha, 0.0)
            mse.append(np.mean((y[h] - y[a].mean() - (xs[h] - xs[a].mean(axis=0)) @ b) ** 2))
        errors.append(np.mean(mse))
    assert M.search(parts, grid) == grid[int(np.argmin(errors))]


def test_ablation_skips_and_completes(data):
    table, names = data[0], [f"f{j}" for j in range(P)]
    assert R.ablation(table, names, "nope").first()["status"] == "skipped"
    row = R.ablation(table, names, "f0").first()
    assert row["status"] == "completed" and row["verdict"] == "substantial" and row["r2_full"] > 0.8


def test_out_of_fold_covers_each_row_once(data):
    oof = R.out_of_fold(data[0], 0.01)
    assert oof.select("paper_id").distinct().count() == oof.count() == 300
    assert oof.where("pred is null").count() == 0


def test_trees_beat_the_mean(data):
    table = data[0]
    for fitted in (R.fit_forest(table, numTrees=10), R.fit_boosted(table, maxIter=5)):
        by = {r["split"]: r for r in R.split_metrics(fitted, table).collect()}
        assert by["test"]["r2"] > 0.3 and by["train"]["r2"] > by["test"]["r2"] - 0.1


@pytest.fixture(scope="module")
def scoring(spark, shelf):
    papers, _ = shelf
    many = papers.crossJoin(spark.range(6).select(F.col("id").alias("copy"))).select(
        F.concat("paper_id", F.lit("-"), "copy").alias("paper_id"),
        F.concat("title", F.lit(" part "), F.array(*map(F.lit, ["alpha", "beta", "gamma"]))[(F.col("copy") % 3).cast("int")]).alias("title"),
        "abstract", "authors", "category", "submitted", (F.col("copy") * 3 + F.length("category")).alias("citations_24mo"))
    features = fit_features(many, ["ocean", "desert", "polar"], stop_words=["the"])
    table = training_table(many, features)
    return bundle(R.fit_linear("lasso", R.train_rows(table), 0.01, 1.0), features, many, table), many, table


def test_features_align_with_names(scoring):
    model, _, table = scoring
    assert len(model.features.names) == len(table.first()["raw"])
    assert "tfidf_gamma" in model.features.names


def test_reloaded_model_scores_the_same(spark, scoring):
    model, papers, _ = scoring
    path = fresh_path(spark, "bundle")
    model.save(path, spark)
    again = ScoringModel.load(path, spark)
    assert again.medians == model.medians and again.features == model.features
    a, b = (sorted(m.predict(papers, ["paper_id"]).collect()) for m in (model, again))
    assert a == b


def test_upload_takes_training_medians(scoring):
    model, papers, _ = scoring
    assert model.medians["author_count"] == 1.5
    bounded = model.with_bounds(model.predict_upload(papers.select("title", "abstract"), ["title"]))
    assert bounded.where("pred is null or not (ci_lower < predicted_citations and predicted_citations < ci_upper)").count() == 0
