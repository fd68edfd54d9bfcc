import os
from types import SimpleNamespace

import pytest

from scholarmill.session import fresh_path, release, shared_dir, write_once


def test_written_tables_go_when_released(spark):
    rows = write_once(spark.range(5), "numbers")
    path = fresh_path(spark, "other")
    folder = os.path.dirname(path).removeprefix("file:")
    assert rows.count() == 5 and spark.sparkContext.applicationId in folder
    kept = sorted(os.listdir(folder))
    assert any(name.startswith("numbers-") for name in kept)


def test_release_deletes_the_applications_folder_only(spark, tmp_path):
    context = SimpleNamespace(applicationId="another", master="local[2]", _jvm=spark.sparkContext._jvm, _jsc=spark.sparkContext._jsc)
    other = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: str(tmp_path)))
    (tmp_path / "scholarmill-another" / "table").mkdir(parents=True)
    (tmp_path / "kept").mkdir()
    release(other)
    assert os.listdir(tmp_path) == ["kept"]


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "yarn", "spark://host:7077"])
def test_a_cluster_names_its_folder(master):
    session = SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=SimpleNamespace(get=lambda key, default=None: None))
    with pytest.raises(ValueError):
        shared_dir(session)


def test_one_folder_per_value(spark):
    rows = spark.range(30).selectExpr("id", "id % 3 AS fold")
    written = write_once(rows, "by-fold", by="fold")
    assert sorted(written.columns) == ["fold", "id"] and written.where("fold = 1").count() == 10
    assert "PartitionFilters: [isnotnull(fold" in written.where("fold = 1")._jdf.queryExecution().toString()
